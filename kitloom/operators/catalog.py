"""Symbol catalogues, rule classification, integrity checks and quality findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Layers and block names that tell what a drawing's insert is, in the order of the rules.
SERVICE_LAYERS = ("razmer", "otmetki", "nadpisi", "подписи", "linkeddata", "размеры", "отметки")
GEOLOGY_LAYERS = ("skv", "probe", "грунт")
CONSTRUCTION_LAYERS = ("металл фахверк", "стойки", "fachverk", "metall", "metal", "fundament", "фундамент", "beton")
AXIS_LAYERS = ("osi", "оси")


def file_catalog(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Legend entries of a file by normalised label; a signature that two labels own blocks both."""
    label = T.label_key(F.col("label"))
    named = entries.filter("label is not null").withColumn("key_label", label).filter("key_label <> ''")
    shared = named.filter("signature is not null").groupBy(*keys, "signature").agg(F.count_distinct("key_label").alias("n")).filter("n > 1").drop("n")
    blocked = named.join(shared, [*keys, "signature"], "left_semi").select(*keys, "key_label").distinct().withColumn("__c", F.lit(True))
    grouped = named.groupBy(*keys, "key_label").agg(F.min("label").alias("label"), F.count_distinct("label").alias("variants"), F.count_distinct("page").alias("pages"), F.count_distinct("signature").alias("signatures"))
    return grouped.join(blocked, [*keys, "key_label"], "left").withColumn("status", F.when(F.col("__c"), "conflicting").otherwise("consistent")).drop("__c")


def project_catalog(entries: DataFrame) -> DataFrame:
    """Catalogue over all files: a label is conflicting, external_only, text_only or consistent, in this precedence."""
    named = entries.filter("label is not null").withColumn("key_label", T.label_key(F.col("label"))).filter("key_label <> ''")
    shared = named.filter("signature is not null").groupBy("signature").agg(F.count_distinct("key_label").alias("n")).filter("n > 1").drop("n")
    conflict = named.join(shared, "signature", "left_semi").select("key_label").distinct().withColumn("__c", F.lit(True))
    grouped = named.groupBy("key_label").agg(F.count_distinct("document_id").alias("files"), F.count_distinct("signature").alias("signatures"), F.count_if(F.col("status") == "unmatched").alias("unmatched"), F.count("*").alias("entries"))
    status = F.when(F.col("__c"), "conflicting").when(F.col("unmatched") == F.col("entries"), "external_only").when(F.col("signatures") == 0, "text_only").otherwise("consistent")
    return grouped.join(conflict, "key_label", "left").withColumn("status", status).drop("__c", "unmatched", "entries")


def unique_signatures(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Signatures that exactly one label owns."""
    named = entries.filter("label is not null and signature is not null").withColumn("key_label", T.label_key(F.col("label")))
    return named.groupBy(*keys, "signature").agg(F.count_distinct("key_label").alias("n"), F.min("key_label").alias("key_label")).filter("n = 1").drop("n")


def symbol_types(instances: DataFrame) -> DataFrame:
    """Per signature: inserts, files, the most common block name (ties to the smaller name), confirmed share."""
    names = instances.filter("signature is not null").groupBy("signature", "block_name").agg(F.count("*").alias("n"))
    top = names.filter("block_name is not null").groupBy("signature").agg(F.min_by("block_name", F.struct(-F.col("n"), "block_name")).alias("name"))
    totals = instances.filter("signature is not null").groupBy("signature").agg(F.count("*").alias("inserts"), F.count_distinct("document_id").alias("files"), F.count_if(F.col("status") == "confirmed").alias("confirmed"))
    return totals.join(top, "signature", "left")


def insert_role(layer: Column, block: Column, role: Column, status: Column) -> Column:
    """The role of an insert by the first rule that fits; only open field candidates are judged."""
    lay, name = F.lower(F.trim(F.coalesce(layer, F.lit("")))), F.lower(F.trim(F.coalesce(block, F.lit(""))))
    open_ = (role == "field_candidate") & status.isin("unresolved", "unclassified")
    rules = (
        (lay == "format", "sheet_furniture"),
        (lay.isin(*GEOLOGY_LAYERS), "geology_mark"),
        (name.startswith("трап") & (lay == "технология"), "drawing_object"),
        (lay.isin(*CONSTRUCTION_LAYERS) & name.startswith("*"), "drawing_object"),
        (lay.isin(*AXIS_LAYERS), "specification_mark"),
        ((lay == "0") & name.startswith("номерация"), "specification_mark"),
        (lay.isin(*SERVICE_LAYERS), "drawing_annotation"),
        ((lay == "0") & (name.startswith("высоты") | name.startswith("новый абк")), "drawing_annotation"),
    )
    out = role
    for fits, becomes in reversed(rules):
        out = F.when(fits, becomes).otherwise(out)
    return F.when(open_, out).otherwise(role)


def integrity(instances: DataFrame, legends: DataFrame, bindings: DataFrame, relationships: DataFrame) -> DataFrame:
    """(check, violations) of the symbol tables: unique ids, references, agreement of bindings, ranges."""
    dup = lambda df, name: df.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("violations")).select(F.lit(f"duplicate_{name}").alias("check"), "violations")
    missing = lambda df, col, target, name: df.filter(F.col(col).isNotNull()).join(target.select(F.col("id").alias(col)).distinct(), col, "left_anti").agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    count = lambda df, cond, name: df.filter(cond).agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
    one = instances.groupBy("id").agg(F.max("legend_entry_id").alias("own"))
    agree = bindings.select("id", "instance_id", "legend_entry_id").distinct().join(one.withColumnRenamed("id", "instance_id"), "instance_id").filter("own is not null and legend_entry_id is not null and own <> legend_entry_id")
    parts = [
        dup(instances, "instances"), dup(legends, "legends"), dup(bindings, "bindings"), dup(relationships, "relationships"),
        missing(bindings, "instance_id", instances, "binding_without_instance"), missing(bindings, "legend_entry_id", legends, "binding_without_legend"),
        missing(instances, "legend_entry_id", legends, "instance_without_legend"), missing(relationships, "source_id", instances, "relationship_without_source"),
        count(agree, F.lit(True), "binding_disagrees"), count(instances, "status = 'confirmed' and legend_entry_id is null", "confirmed_without_legend"),
        count(bindings, "confidence < 0 or confidence > 1", "confidence_out_of_range"), count(legends, "bbox is not null and (bbox.x0 > bbox.x1 or bbox.y0 > bbox.y1)", "box_inverted"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def number_findings(items: DataFrame) -> DataFrame:
    """Impossible numbers of drawing texts by kind: how many, and the first three texts by id."""
    box = items.groupBy("document_id", "sheet").agg(F.min("y").alias("y0"), F.max("y").alias("y1"))
    wide = items.filter("text is not null").join(box, ["document_id", "sheet"])
    kinds = [
        F.when(F.col("height") <= 0, "zero height").when(F.col("height") > (F.col("y1") - F.col("y0")) / 3, "too tall"),
        F.when((F.col("width") > 0) & (F.col("width") < F.col("height")), "narrower than a sign"),
        F.when(~F.coalesce("factor", F.lit(1.0)).between(0.3, 3.0), "squeezed"),
    ]
    flat = wide.select("item_id", F.explode(F.array_compact(F.array(*kinds))).alias("kind"))
    return flat.groupBy("kind").agg(F.count("*").alias("n"), F.min("item_id").alias("first_item"))


def layer_stats(items: DataFrame) -> DataFrame:
    """Texts, characters and box of documents and sheets with totals over sheets and all."""
    return items.rollup("document_id", "sheet").agg(F.count("*").alias("texts"), F.sum(F.length("text")).alias("chars"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.grouping_id().cast("long").alias("level"))


def changed_findings(before: DataFrame, after: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose count grew against a snapshot."""
    joined = after.join(before.select(*keys, F.col(value).alias("before")), keys, "left")
    return joined.filter(F.col(value) > F.coalesce("before", F.lit(0)))


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one run that the other lacks, with multiplicity."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))


def orphan_definitions(definitions: DataFrame, inserts: DataFrame, key: str, least: int = 1) -> DataFrame:
    """Definitions that are never inserted and hold enough rows, one per content."""
    unused = definitions.filter(F.col(key).isNotNull()).join(inserts.select(key).distinct(), key, "left_anti")
    content = unused.groupBy(key).agg(F.count("*").alias("n"), F.sha2(F.concat_ws("|", F.sort_array(F.collect_set("label"))), 256).alias("content")).filter(F.col("n") >= least)
    return content.groupBy("content").agg(F.min(key).alias(key), F.max("n").alias("n"))


def field_loss(source: DataFrame, parsed: DataFrame, keys: list[str], flag: str, least: int = 10) -> DataFrame:
    """Keys whose share of rows with a field fell: lost if none is left, weak if under a quarter stayed."""
    share = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(f"{name}_rows"), F.count_if(F.col(flag)).alias(f"{name}_with"))
    both = share(source, "source").join(share(parsed, "parsed"), keys, "left").fillna(0)
    before = F.col("source_with") / F.col("source_rows")
    after = F.when(F.col("parsed_rows") > 0, F.col("parsed_with") / F.col("parsed_rows")).otherwise(0.0)
    verdict = F.when(F.col("parsed_with") == 0, "lost").when(after < before / 4, "weak")
    return both.filter((F.col("source_with") >= least) & (before >= 0.02)).withColumn("verdict", verdict).filter("verdict is not null")


def is_soil_fill(label: Column) -> Column:
    """A lithology row of a legend, no water, date, level or border."""
    low = T.yo(F.lower(label))
    return low.rlike("песок|песч|суглин|супес|глин|насып|почв|торф|щебен|гравий") & ~low.rlike("вод|дата|уровень|границ|скважин")


def is_wrapped_label(lines: Column) -> Column:
    """A label of several lines: a long one or one that ends in a connector."""
    return F.exists(lines, lambda x: (F.length(x) >= 40) | F.lower(F.trim(x)).rlike("(,|-| и| в| на| с| для| из| по)$"))
