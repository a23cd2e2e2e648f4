"""Binding symbol instances to legend entries, and what is left over.

Every step fails closed: a signature that two entries own, a needle that two labels hold or a point in two boxes binds
nothing and says why.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .matching import mutual_pairs, points_in_boxes

OPEN = ("unresolved", "unclassified")


def latest_rows(df: DataFrame, key: str = "id", at: str = "loaded_at") -> DataFrame:
    """The last loaded row of each id."""
    rest = [c for c in df.columns if c not in (key, at)]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(at, *rest)).alias("r")).select(key, "r.*")


def is_open(role: Column, status: Column) -> Column:
    return (role == "field_candidate") & status.isin(*OPEN)


def block_matches(instances: DataFrame, legends: DataFrame, *, cell: float = 50.0) -> DataFrame:
    """(id, legend_id, reason) of instances: exemplar (in one legend box), in several boxes, signature, ambiguous, missing."""
    keys = ["document_id", "page"]
    boxes = legends.filter("bbox is not null").select(*keys, F.col("id").alias("legend_id"), "bbox.*")
    placed = points_in_boxes(instances.select(*keys, "id", "x", "y"), boxes, keys, cell=cell, half_open=True)
    exemplars = placed.groupBy("id").agg(F.min("legend_id").alias("box_id"), (F.min("legend_id") == F.max("legend_id")).alias("one"))
    owners = legends.filter("signature is not null").groupBy("document_id", "signature").agg(F.min("id").alias("sig_id"), (F.min("id") == F.max("id")).alias("sole"))
    joined = instances.select("id", "document_id", "signature").join(exemplars, "id", "left").join(owners, ["document_id", "signature"], "left")
    reason = F.when(F.col("one"), "exemplar").when(F.col("box_id").isNotNull(), "several boxes").when(F.col("sole"), "signature").when(F.col("sig_id").isNotNull(), "ambiguous").otherwise("missing")
    out = joined.withColumn("reason", reason)
    return out.select("id", F.when(F.col("reason") == "exemplar", F.col("box_id")).when(F.col("reason") == "signature", F.col("sig_id")).alias("legend_id"), "reason")


def project_matches(instances: DataFrame, legends: DataFrame) -> DataFrame:
    """Open instances whose signature no legend row of their file owns, but exactly one label of the other files does."""
    named = legends.filter("signature is not null and label is not null").select("document_id", "signature", T.label_key(F.col("label")).alias("label")).distinct()
    catalogue = named.groupBy("signature").agg(F.min("label").alias("label"), (F.min("label") == F.max("label")).alias("sole"), F.count_distinct("document_id").alias("files"))
    waiting = instances.filter(is_open(F.col("role"), F.col("status")) & F.col("signature").isNotNull()).select("id", "document_id", "signature")
    return waiting.join(named.select("document_id", "signature").distinct(), ["document_id", "signature"], "left_anti").join(catalogue.filter("sole"), "signature").select("id", "label", "files")


def needle_matches(instances: DataFrame, legends: DataFrame, needles: dict[str, str]) -> DataFrame:
    """Instances whose block family names a phrase that exactly one legend label of the file holds.

    The labels are reduced per file and needle first, so no instance meets more than one of them.
    """
    hits = None
    for family, needle in needles.items():
        part = legends.filter(F.contains(T.yo(F.lower("label")), F.lit(needle))).groupBy("document_id").agg(F.min("id").alias("legend_id"), F.count_distinct("id").alias("n")).filter("n = 1").select("document_id", F.lit(family).alias("family"), "legend_id")
        hits = part if hits is None else hits.unionByName(part)
    family = F.lower(F.regexp_extract("block_name", "^([^_]+)", 1))
    return instances.filter("block_name is not null").select("id", "document_id", family.alias("family")).join(hits, ["document_id", "family"]).select("id", "legend_id")


def unknown_clusters(instances: DataFrame) -> DataFrame:
    """Open candidates by file and signature with a representative."""
    waiting = instances.filter(is_open(F.col("role"), F.col("status")))
    return waiting.groupBy("document_id", F.coalesce("signature", F.lit("")).alias("signature")).agg(F.count("*").alias("members"), F.min("id").alias("representative"), F.count_distinct("page").alias("pages"))


def review_counts(instances: DataFrame, by: str) -> DataFrame:
    """Counts by a column and in total: inserts, open, bound, ignored, distinct signatures of open ones."""
    waiting = is_open(F.col("role"), F.col("status"))
    marked = instances.withColumn("open", F.coalesce(waiting, F.lit(False)))
    return marked.rollup(by).agg(F.count("*").alias("inserts"), F.count_if("open").alias("open"), F.count_if(F.col("legend_entry_id").isNotNull()).alias("bound"), F.count_if(F.col("status") == "ignored").alias("ignored"), F.count_distinct(F.when(F.col("open"), F.col("signature"))).alias("open_signatures"))


def evidence_summary(bindings: DataFrame) -> DataFrame:
    """Evidence of bindings by kind: how often, the best score, and the bindings it is the only kind of."""
    each = bindings.select("id", F.array_distinct(F.transform("evidence", lambda e: e["kind"])).alias("kinds"), F.explode("evidence").alias("e"))
    return each.groupBy(F.col("e.kind").alias("kind")).agg(F.count("*").alias("n"), F.max("e.score").alias("best"), F.count_distinct(F.when(F.size("kinds") == 1, F.col("id"))).alias("sole"))


def axis_pairs(texts: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """Letters and digits of axis marks that have exactly each other within a radius."""
    kind = T.value_class(F.col("text"))
    marks = texts.filter("x is not null and y is not null and text is not null").select(*keys, "item_id", "x", "y", kind.alias("kind"))
    cell = lambda c: F.floor(F.col(c) / radius).cast("long")
    around = F.array(*[F.lit(k).cast("long") for k in (-1, 0, 1)])
    letters = marks.filter("kind = 'letter'").select(*keys, F.col("item_id").alias("letter_id"), F.col("x").alias("lx"), F.col("y").alias("ly"), cell("x").alias("cx"), cell("y").alias("cy"))
    digits = marks.filter("kind = 'digit'").select(*keys, F.col("item_id").alias("digit_id"), F.col("x").alias("dx"), F.col("y").alias("dy"), F.explode(F.transform(around, lambda k: cell("x") + k)).alias("cx"), F.transform(around, lambda k: cell("y") + k).alias("cys")).withColumn("cy", F.explode("cys")).drop("cys")
    near = letters.join(digits, [*keys, "cx", "cy"]).filter((F.col("lx") - F.col("dx")) * (F.col("lx") - F.col("dx")) + (F.col("ly") - F.col("dy")) * (F.col("ly") - F.col("dy")) <= radius * radius)
    return mutual_pairs(near.select(*keys, "letter_id", "digit_id").distinct(), "letter_id", "digit_id")


def merged_field(attribute: Column, geometry: Column) -> Column:
    """A field read twice: the attribute wins; conflict says whether both differ."""
    a, g = F.nullif(F.trim(attribute), F.lit("")), F.nullif(F.trim(geometry), F.lit(""))
    return F.struct(F.coalesce(a, g).alias("value"), F.coalesce(T.fold(a) != T.fold(g), F.lit(False)).alias("conflict"))
