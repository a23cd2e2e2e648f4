"""A job queue as a table of events: batch views of its state, and the same state as a stream.

events: (event_id, ts, user_id = job, event_type = state, value, props). State is the latest event of a key; nothing is
updated in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Suffixes of files that go to the drawing lane, and of note files.
VECTOR_SUFFIXES = ("dwg", "dxf")


def lane(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(suffix.isin(*VECTOR_SUFFIXES), "vector").otherwise("model")


def latest_state(events: DataFrame, key: str, at: str = "ts", order: str = "event_id") -> DataFrame:
    """The last event of each key; map-side combined, so a hot key is no task of its own."""
    rest = [c for c in events.columns if c not in (key, at, order)]
    return events.groupBy(key).agg(F.max(F.struct(at, order, *rest)).alias("e")).select(key, "e.*")


def next_in_lane(jobs: DataFrame, lane_column: str, order: str) -> DataFrame:
    """The first waiting job of each lane; jobs without an order wait for none."""
    return jobs.filter(F.col(order).isNotNull()).groupBy(lane_column).agg(F.min(F.struct(order, *[c for c in jobs.columns if c not in (lane_column, order)])).alias("j")).select(lane_column, "j.*")


def reconciled(state: Column) -> Column:
    """After a restart, what was being processed waits again."""
    return F.when(state == "processing", "queued").otherwise(state)


def missing_pages(requested: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Pages to resume with."""
    return requested.join(done.select(*keys).distinct(), keys, "left_anti")


def page_delta(rows: DataFrame, after: int, limit: int, order: str) -> DataFrame:
    """The next page of a keyset pagination, with whether more follow."""
    some = rows.filter(F.col(order) > after).orderBy(order).limit(limit + 1)
    n = F.row_number().over(Window.orderBy(order))  # of limit + 1 rows
    return some.withColumn("__n", n).withColumn("more", F.max("__n").over(Window.partitionBy()) > limit).filter(F.col("__n") <= limit).drop("__n")


def merged_usage(usages: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Element-wise sums of maps of numbers."""
    return usages.select(*keys, F.explode(column).alias("name", "value")).groupBy(*keys, "name").agg(F.sum("value").alias("value"))


def job_outcome(total: Column, done: Column, failed: Column, cancelled: Column) -> Column:
    return F.when(cancelled, "cancelled").when(done + failed < total, "processing").when(failed == 0, "completed").when(done > 0, "partial").otherwise("failed")


def sessions(events: DataFrame, key: str, at: str = "ts", gap: str = "30 minutes") -> DataFrame:
    """Sessions of a key separated by a pause, batch or streaming (extension)."""
    return events.groupBy(F.session_window(at, gap).alias("w"), key).agg(F.count("*").alias("events")).select(key, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "events")


def tumbling(events: DataFrame, key: str, at: str = "ts", width: str = "1 hour") -> DataFrame:
    """Events per window and key, batch or streaming (extension)."""
    return events.groupBy(F.window(at, width).alias("w"), key).agg(F.count("*").alias("events")).select(F.col("w.start").alias("started"), key, "events")


def stream(spark, path: str, schema: str, watermark: str = "1 hour", at: str = "ts") -> DataFrame:  # noqa: ANN001
    """The event table as a stream with a watermark; repeated deliveries inside it count once."""
    return spark.readStream.schema(schema).parquet(path).withWatermark(at, watermark).dropDuplicatesWithinWatermark(["event_id"])


def budgeted(stream_of_pages: DataFrame, budget: int) -> DataFrame:
    """(job, page, verdict): of each job's pages the first `budget` that need the model are accepted, later ones refused."""
    from collections.abc import Iterator

    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def judge(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        (used,) = state.get if state.exists else (0,)
        out = []
        for frame in frames:
            for page, needs in zip(frame["page"], frame["needs_model"], strict=True):
                if not needs:
                    out.append((key[0], int(page), "layer"))
                elif used < budget:
                    used += 1
                    out.append((key[0], int(page), "model"))
                else:
                    out.append((key[0], int(page), "over budget"))
        state.update((used,))
        yield pd.DataFrame(out, columns=["job", "page", "verdict"])

    return stream_of_pages.groupBy("job").applyInPandasWithState(judge, "job string, page int, verdict string", "used int", "append", GroupStateTimeout.NoTimeout)
