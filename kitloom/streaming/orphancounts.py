"""A table of reference and existence counts kept from a stream of changes.

Every micro-batch reads the last version of the counts, adds its changes and writes the next version beside it; a version
is named by its batch, so a batch that is run again after a failure finds the same base and writes the same counts. Two
versions are kept.

Defined cases: no version yet means no counts; null keys are no changes; a batch without changes keeps the counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.orphans import merged_counts

KEPT = 2


def _filesystem(spark: SparkSession, path: str):  # noqa: ANN202
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions of the counts, oldest first."""
    folder, fs = _filesystem(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    done = [int(n.removeprefix("batch=")) for n in names if n.startswith("batch=")]
    return sorted(v for v in done if fs.exists(_filesystem(spark, f"{path}/batch={v}/_SUCCESS")[0]))


def counts_at(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """The counts of the last version, or of the last before a batch."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    return spark.read.schema("key string, refs bigint, exists bigint").parquet(f"{path}/batch={known[-1]}") if known else None


def applied(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: adds changes (key, refs, exists: signed, either may be null) to the counts in path."""

    def apply(changes: DataFrame, batch: int) -> None:
        spark = changes.sparkSession
        none = F.lit(0)
        merged = merged_counts(counts_at(spark, path, batch), changes.select("key", F.coalesce("refs", none).alias("refs")), changes.select("key", F.coalesce("exists", none).alias("exists")))
        merged.write.mode("overwrite").parquet(f"{path}/batch={batch}")
        for old in versions(spark, path)[:-KEPT]:
            folder, fs = _filesystem(spark, f"{path}/batch={old}")
            fs.delete(folder, True)

    return apply


def keep_counts(changes: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Starts a stream of changes that keeps the counts in path."""
    writer = changes.writeStream.foreachBatch(applied(path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
