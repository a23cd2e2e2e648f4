"""References to records that do not exist, from signed counts over change deltas.

Every record is two changes of its key's existence count: +1 when it becomes visible, -1 when it is deleted; every
reference is +1 on the key's reference count at its own time. The running sums over a key's changes tell, at the time of
each reference, how many live records it can mean; a reference with a live count of 0 is an orphan.

References and changes are summed by key and time before anything is ordered, so a key that is loaded at one time is one
row; what identifies a reference stays behind and is joined back to the orphans' (key, time) alone. A key's changes are
summed up in order of time. For keys with very many rows that takes two steps, so that none needs one task: first by key
and time slot, the slots of a key (as many as the time span has) in order, then inside one slot.

The counts can be kept: `merged_counts` adds changes to a table of counts per key, `current_orphans` reports the keys with
references and no existence (`streaming/orphancounts.py` keeps such a table from a stream of changes).

Defined cases: null keys are no references and name no record; ids match without outer spaces and case; a record with no
load time is never visible; a reference with no time sees no record; repeated reference rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import HOT_ROWS, broadcast_if_small, salted_join

SLOT_SECONDS = 6 * 3600
GRACE_SECONDS = 86400
#: Orphan (key, time) rows that are broadcast at most.
SMALL_TIMES = 200_000


def folded_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""))


def existence_deltas(records: DataFrame, *, key: str = "id", loaded: str = "loaded_at", deleted: str = "deleted_at", grace_seconds: int = GRACE_SECONDS) -> DataFrame:
    """(key, at, exists): +1 from grace_seconds before the load, -1 at the deletion; at in microseconds."""
    start = F.unix_micros(F.col(loaded).cast("timestamp")) - F.lit(grace_seconds * 1_000_000)
    end = F.unix_micros(F.col(deleted).cast("timestamp"))
    live = records.select(folded_key(F.col(key)).alias("key"), start.alias("start"), end.alias("end")).filter("key is not null and start is not null and (end is null or end > start)")
    return live.select("key", F.explode(F.array_compact(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("exists")), F.when(F.col("end").isNotNull(), F.struct(F.col("end").alias("at"), F.lit(-1).alias("exists")))))).alias("d")).select("key", "d.at", "d.exists")


def _running(events: DataFrame) -> DataFrame:
    """events (key, at, exists, refs) with live and references up to their time, a key in one window."""
    so_far = Window.partitionBy("key").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.select("key", "at", "refs", F.sum("exists").over(so_far).alias("live"), F.sum("refs").over(so_far).alias("references"))


def _running_by_slots(events: DataFrame, slot_seconds: int) -> DataFrame:
    """The same with a key's slots in one window, and a slot's events in another."""
    zero = F.lit(0).cast("long")
    events = events.withColumn("slot", F.floor(F.col("at") / F.lit(slot_seconds * 1_000_000)).cast("long"))
    by_slot = events.groupBy("key", "slot").agg(F.sum("exists").alias("slot_exists"), F.sum("refs").alias("slot_refs"))
    before = Window.partitionBy("key").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    base = by_slot.select("key", "slot", "slot_refs", F.coalesce(F.sum("slot_exists").over(before), zero).alias("base_exists"), F.coalesce(F.sum("slot_refs").over(before), zero).alias("base_refs")).filter("slot_refs > 0").drop("slot_refs")
    inside = Window.partitionBy("key", "slot").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return events.join(base, ["key", "slot"]).select("key", "at", "refs", (F.col("base_exists") + F.sum("exists").over(inside)).alias("live"), (F.col("base_refs") + F.sum("refs").over(inside)).alias("references"))


def orphan_times(references: DataFrame, deltas: DataFrame, *, slot_seconds: int = SLOT_SECONDS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, at, refs, references): the times at which a key is referred to while its live count is 0, how many references
    that time has, and how many the key has had until then."""
    zero = F.lit(0).cast("long")
    named = references.filter("key is not null and at is not null").select("key", "at", zero.alias("exists"), F.lit(1).cast("long").alias("refs"))
    events = deltas.select("key", "at", F.col("exists").cast("long").alias("exists"), zero.alias("refs")).unionByName(named)
    # at most (all rows / hot_rows) keys
    hot = cut_lineage(events.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > hot_rows).select("key"))
    summed = events.groupBy("key", "at").agg(F.sum("exists").alias("exists"), F.sum("refs").alias("refs"))
    if hot.isEmpty():
        running = _running(summed)
    else:
        few = broadcast_if_small(hot)
        running = _running(summed.join(few, "key", "left_anti")).unionByName(_running_by_slots(summed.join(few, "key", "left_semi"), slot_seconds))
    return running.filter("refs > 0 and live = 0").select("key", "at", "refs", "references")


def orphan_references(references: DataFrame, deltas: DataFrame, *, slot_seconds: int = SLOT_SECONDS, hot_rows: int = HOT_ROWS, small_rows: int = SMALL_TIMES) -> DataFrame:
    """Rows of references (key, at, payload struct) with a live count of 0, with that key's reference count so far."""
    timeless = references.filter(F.col("key").isNotNull() & F.col("at").isNull()).select("key", "at", "payload", F.lit(1).cast("long").alias("references"))
    times = cut_lineage(orphan_times(references, deltas, slot_seconds=slot_seconds, hot_rows=hot_rows))
    asked = references.filter("key is not null and at is not null").select("key", "at", "payload")
    if times.count() <= small_rows:
        back = asked.join(F.broadcast(times), ["key", "at"])
    else:
        # a (key, time) of many references is split by what tells them apart
        one = F.xxhash64("key", "at")
        marked = times.select(one.alias("__kt"), F.col("key").alias("__key"), F.col("at").alias("__at"), "refs", "references")
        back = salted_join(asked.withColumn("__kt", one), marked, "__kt", weight="refs", spread=F.xxhash64("payload"), hot_rows=hot_rows).filter("key = __key and at = __at")
    return back.select("key", "at", "payload", "references").unionByName(timeless)


def merged_counts(counts: DataFrame | None, references: DataFrame, deltas: DataFrame) -> DataFrame:
    """(key, refs, exists): counts per key with the changes added; references: key, refs (signed), deltas: key, exists (signed).

    Keys whose counts are both 0 leave the table. Changes may come in any order, and a reference before its record."""
    zero = F.lit(0).cast("long")
    parts = references.select("key", F.col("refs").cast("long").alias("refs"), zero.alias("exists")).unionByName(deltas.select("key", zero.alias("refs"), F.col("exists").cast("long").alias("exists")))
    if counts is not None:
        parts = parts.unionByName(counts.select("key", "refs", "exists"))
    return parts.filter("key is not null").groupBy("key").agg(F.sum("refs").alias("refs"), F.sum("exists").alias("exists")).filter("refs <> 0 or exists <> 0")


def current_orphans(counts: DataFrame) -> DataFrame:
    """(key, refs) of keys that are referred to and have no record."""
    return counts.filter("refs > 0 and exists = 0").select("key", "refs")


def reference_rows(df: DataFrame, table_name: str, ref_id: str, fields: list[str], at: str = "loaded_at") -> DataFrame:
    """One row per referring row's id and field: key, at, payload<table_name, ref_id, field_name, period>."""
    when = F.col(at).cast("timestamp")
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields]))
    flat = df.select(F.col(ref_id).alias("ref_id"), when.alias("t"), each.alias("e")).filter("e.value is not null")
    payload = F.struct(F.lit(table_name).alias("table_name"), F.col("ref_id"), F.col("e.field_name").alias("field_name"), F.date_format("t", "yyyy-MM").alias("period"))
    return flat.select(folded_key(F.col("e.value")).alias("key"), F.unix_micros("t").alias("at"), payload.alias("payload"))


def symbol_orphans(bindings: DataFrame, relationships: DataFrame, instances: DataFrame, legends: DataFrame) -> DataFrame:
    """(table_name, ref_id, field_name, period) of references that lead to no live instance or legend entry."""
    deltas = existence_deltas(instances).unionByName(existence_deltas(legends))
    references = reference_rows(bindings, "symbol_bindings", "id", ["instance_id", "legend_entry_id"]).unionByName(reference_rows(relationships, "relationships", "id", ["target_id"]))
    return orphan_references(references, deltas).select("payload.*").distinct()


def symbol_counts(bindings: DataFrame, relationships: DataFrame, instances: DataFrame, legends: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Reference and existence counts per key over the symbol tables, added to counts."""
    references = reference_rows(bindings, "symbol_bindings", "id", ["instance_id", "legend_entry_id"]).unionByName(reference_rows(relationships, "relationships", "id", ["target_id"]))
    return merged_counts(counts, references.select("key", F.lit(1).alias("refs")), existence_deltas(instances).unionByName(existence_deltas(legends)))


def orphan_report(orphans: DataFrame) -> DataFrame:
    return orphans.groupBy("table_name", "field_name", "period").agg(F.count("*").alias("orphans"))
