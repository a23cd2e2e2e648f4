"""kitloom: a Spark-native engine for reading, reconciling and scoring engineering documentation kits."""
