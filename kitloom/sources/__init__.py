"""kitloom.sources"""
