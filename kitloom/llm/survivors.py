"""Best representative of each duplicate group, its missing fields filled by whole bundles of dependent fields.

A group's survivor and what fills it are one choice. Its bundles are the record itself (kind, stamp, reading time and
index of one row) and sets of dependent stamp fields, which may share a field (the stage belongs to the volume and to the
project). A bundle is taken whole, as some row of the group has it, or not at all. A branch and bound takes the choice of
the greatest trust: first the record's own (the stated order of kind, fullness, reading time, index, id), then the sum of
the fills'. Chosen bundles agree in every field they share, and keep the functional dependencies learned from the group:
what the most trusted row with an object or a stage says of its organisation or number of sheets holds for all.

Candidates are reduced before a group is collected, never by a cap. Records: the best of each kind of source. Fills: equal
values are one candidate; those that contradict the leading record or the learned dependencies, or add nothing, are
infeasible. Of the rest, with the stage as the one field that two bundles share, an optimum needs of each bundle only the
best of all, the best without a stage, and those of the stage with the greatest joint trust.

Defined cases: rows without a group key or an id belong to no group; ties end with the smaller id; repeated rows are
members like others, and their group still has one survivor; null, blank and a lone dash are unfilled; bundles nobody
fills stay as they are; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, salted_join
from ..session import cut_lineage

KIND_RANK = {"DWG": 0, "PDF": 1, "DOCX": 2}
FILLED_FIELDS = ("code", "sheet", "sheets_total", "stage", "title", "object_name", "org")
#: Dependent fields are chosen together; SHARED is the only field that belongs to more than one bundle.
BUNDLES: Mapping[str, tuple[str, ...]] = {"project": ("stage", "object_name", "org"), "volume": ("stage", "sheets_total"), "heading": ("title",), "reading": ("source", "note")}
SHARED = "stage"
#: determinant -> dependent that it fixes within a group
DEPENDENCIES: Mapping[str, str] = {"object_name": "org", "stage": "sheets_total"}
FIELDS = tuple(sorted({f for b in BUNDLES.values() for f in b}))
FAR_MICROS = 1 << 62


def filled(c: Column) -> Column:
    return F.coalesce(~F.regexp_replace(c, r"(?U)\s+", "").isin("", "-", "–", "—"), F.lit(False))


def squeezed(c: Column) -> Column:
    return F.nullif(F.lower(F.regexp_replace(c, r"(?U)\s+", "")), F.lit(""))


def sheet_number(c: Column) -> Column:
    digits = F.regexp_extract(c, r"([0-9]+)", 1)
    return F.nullif(F.regexp_replace(digits, r"^0+(?=[0-9])", ""), F.lit(""))


def kind_rank(c: Column) -> Column:
    kind = F.upper(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    out = F.lit(len(KIND_RANK))
    for name, rank in KIND_RANK.items():
        out = F.when(kind == name, F.lit(rank)).otherwise(out)
    return out


Fields = dict[str, str]
#: (determinant, its value) -> the value of its dependent
Facts = Mapping[tuple[str, str], str]


def keeps(known: Fields, added: Fields, facts: Facts) -> bool:
    """Whether added values contradict neither known ones nor a learned dependency."""
    if any(known.get(f, v) != v for f, v in added.items()):
        return False
    joint = known | added
    new = joint.keys() - known.keys()
    for determinant, dependent in DEPENDENCIES.items():
        if determinant in joint and dependent in joint and (determinant in new or dependent in new) and facts.get((determinant, joint[determinant]), joint[dependent]) != joint[dependent]:
            return False
    return True


def choose(records: Sequence[tuple[tuple[int, ...], Fields]], bundles: Sequence[Sequence[tuple[int, Fields]]], facts: Facts) -> tuple[int, list[int | None]]:
    """Branch and bound: the index of the chosen record and, per bundle, of its chosen candidate or None.

    A record's trust is a tuple and goes before the sum of the candidates' trusts. A branch is left when even the best
    trusts of all bundles not yet decided can't bring it past the best choice found.
    """
    bound = [0] * (len(bundles) + 1)
    for k in range(len(bundles) - 1, -1, -1):
        bound[k] = bound[k + 1] + max((t for t, _ in bundles[k]), default=0)
    best: tuple[tuple[int, ...], int] | None = None
    chosen: tuple[int, list[int | None]] = (0, [None] * len(bundles))

    def branch(record: int, k: int, trust: int, taken: list[int | None], known: Fields) -> None:
        nonlocal best, chosen
        own = records[record][0]
        if best is not None and (own, trust + bound[k]) <= best:
            return
        if k == len(bundles):
            best, chosen = (own, trust), (record, taken)
            return
        for i, (t, fields) in enumerate(bundles[k]):
            if keeps(known, fields, facts):
                branch(record, k + 1, trust + t, [*taken, i], known | fields)
        branch(record, k + 1, trust, [*taken, None], known)

    for r in range(len(records)):
        branch(r, 0, 0, [], dict(records[r][1]))
    return chosen


def best_representatives(variants: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per group of two or more: code_key, sheet_no, members, survivor_id, the completed stamp fields, filled_from."""
    group = ["code_key", "sheet_no"]
    n_filled = sum((filled(F.col(f"stamp.{f}")).cast("int") for f in FILLED_FIELDS), F.lit(0))
    order = F.struct(
        kind_rank(F.col("source_kind")).alias("k"),
        (-n_filled).alias("f"),
        F.coalesce(-F.unix_micros(F.col("read_at").cast("timestamp")), F.lit(FAR_MICROS)).alias("t"),
        F.coalesce(F.col("idx").cast("long"), F.lit(FAR_MICROS)).alias("i"),
        F.col("variant_id").alias("id"),
    )
    rows = variants.select(squeezed(F.col("stamp.code")).alias("code_key"), sheet_number(F.col("stamp.sheet")).alias("sheet_no"), order.alias("o"), *[F.when(filled(F.col(f"stamp.{f}")), F.col(f"stamp.{f}")).alias(f) for f in FIELDS])
    rows = rows.filter("code_key is not null and sheet_no is not null and o.id is not null")
    # the records: the best of each kind, with what they say
    kinds = rows.groupBy(*group, F.col("o.k").alias("kind")).agg(F.count("*").alias("n"), F.min(F.struct("o", *FIELDS)).alias("r"))
    heads = kinds.groupBy(*group).agg(F.sum("n").alias("members"), F.min("r").alias("lead"), F.collect_list("r").alias("records")).filter("members >= 2")
    heads = cut_lineage(heads.withColumn("grp", F.xxhash64(*group)))
    # the fills: rows meet their group's leading record first, so that only values that can fill it are shuffled again
    lead = heads.select("grp", F.col("code_key").alias("g_code"), F.col("sheet_no").alias("g_sheet"), "members", *[F.col(f"lead.{f}").alias(f"own_{f}") for f in FIELDS])
    joined = salted_join(rows.withColumn("grp", F.xxhash64(*group)), lead, "grp", weight="members", spread=F.col("o.id"), hot_rows=hot_rows).filter("code_key = g_code and sheet_no = g_sheet")
    owned = [f"own_{f}" for f in FIELDS]
    each = []
    for name, fields in BUNDLES.items():
        complete = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
        trust = ((F.lit(len(KIND_RANK)) - F.col("o.k")) + F.lit(10) * complete).cast("int")
        agrees, adds = F.lit(True), F.lit(False)
        for f in fields:
            agrees &= F.coalesce(F.col(f) == F.col(f"own_{f}"), F.lit(True))
            adds |= F.col(f).isNotNull() & F.col(f"own_{f}").isNull()
        each.append(F.when(agrees & adds, F.struct(F.lit(name).alias("bundle"), trust.alias("trust"), *[F.col(f) if f in fields else F.lit(None).cast("string").alias(f) for f in FIELDS])))
    split = joined.select(*group, *owned, F.explode(F.array_compact(F.array(*each))).alias("c")).select(*group, *owned, "c.*")
    useful = split.groupBy(*group, *owned, "bundle", *FIELDS).agg(F.max("trust").alias("trust"), F.count("*").alias("support"))
    # what the most trusted row says of a determinant, for groups whose record lacks it or its dependent
    said = F.array_compact(F.array(*[F.when(F.col(d).isNotNull() & F.col(x).isNotNull() & (F.col(f"own_{d}").isNull() | F.col(f"own_{x}").isNull()), F.struct(F.lit(d).alias("of"), F.col(d).alias("value"), F.col(x).alias("says"))) for d, x in DEPENDENCIES.items()]))
    learned = joined.select(*group, "o", F.explode(said).alias("s")).groupBy(*group, "s.of", "s.value").agg(F.min(F.struct("o", "s.says")).alias("m")).select(*group, "of", "value", F.col("m.says").alias("says"))
    for determinant, dependent in DEPENDENCIES.items():
        at, says = f"at_{determinant}", f"said_{determinant}"
        own = learned.filter(F.col("of") == determinant).select(*group, F.col("value").alias(at), F.col("says").alias(says))
        useful = useful.withColumn(at, F.coalesce(determinant, f"own_{determinant}")).join(own, [*group, at], "left")
        joint = F.coalesce(F.col(dependent), F.col(f"own_{dependent}"))
        fresh = (F.col(determinant).isNotNull() & F.col(f"own_{determinant}").isNull()) | (F.col(dependent).isNotNull() & F.col(f"own_{dependent}").isNull())
        useful = useful.filter(F.coalesce(~fresh | (joint == F.col(says)), F.lit(True)))
    # of each bundle and value of the shared field the best, then what an optimum can need of them
    facts = F.array_compact(F.array(*[F.when(F.col(f"at_{d}").isNotNull() & F.col(f"said_{d}").isNotNull(), F.struct(F.lit(d).alias("d"), F.col(f"at_{d}").alias("v"), F.col(f"said_{d}").alias("w"))) for d in DEPENDENCIES]))
    option = F.struct("trust", "support", F.struct(*FIELDS).alias("fields"), facts.alias("facts"))
    by_stage = useful.groupBy(*group, F.col(SHARED).alias("at"), "bundle").agg(F.max(option).alias("o"))
    joint = by_stage.groupBy(*group, "at").agg(F.sum("o.trust").alias("sum"), F.collect_list(F.struct("bundle", "o")).alias("each"))
    stages = joint.groupBy(*group).agg(F.max(F.when(F.col("at").isNotNull(), F.struct("sum", "at", "each"))).alias("pair"), F.max(F.when(F.col("at").isNull(), F.struct("each"))).alias("bare"))
    tops = by_stage.groupBy(*group, "bundle").agg(F.max("o").alias("o")).groupBy(*group).agg(F.collect_list(F.struct("bundle", "o")).alias("each"))
    none = F.array().cast(tops.schema["each"].dataType)
    options = stages.join(tops, group).select(*group, F.array_distinct(F.concat(F.coalesce("pair.each", none), F.coalesce("bare.each", none), "each")).alias("options"))

    @F.pandas_udf("struct<survivor_id bigint," + ",".join(f"{f} string" for f in FIELDS) + ",filled_from string>")
    def search(records: pd.Series, options: pd.Series) -> pd.DataFrame:
        import json

        names, out = list(BUNDLES), []
        for own, found in zip(map(json.loads, records), map(json.loads, options), strict=True):
            ranked = [((-r["o"]["k"], -r["o"]["f"], -r["o"]["t"], -r["o"]["i"], -r["o"]["id"]), {f: r[f] for f in FIELDS if f in r}) for r in own]
            bundles = [sorted(((o["o"]["trust"], o["o"]["support"], o["o"]["fields"]) for o in found if o["bundle"] == b), key=lambda x: (-x[0], -x[1], sorted(x[2].items()))) for b in names]
            facts = {(f["d"], f["v"]): f["w"] for o in found for f in o["o"].get("facts", ())}
            record, picked = choose(ranked, [[(t, fields) for t, _, fields in b] for b in bundles], facts)
            fields, took = dict(ranked[record][1]), []
            for b, held, i in zip(names, bundles, picked, strict=True):
                if i is not None:
                    if held[i][2].keys() - fields.keys():
                        took.append(b)
                    fields = held[i][2] | fields
            out.append({"survivor_id": own[record]["o"]["id"], "filled_from": ",".join(took)} | {f: fields.get(f) for f in FIELDS})
        return pd.DataFrame(out, columns=["survivor_id", *FIELDS, "filled_from"])

    asked = heads.join(options, group, "left").select(*group, "members", F.to_json("records").alias("records"), F.coalesce(F.to_json("options"), F.lit("[]")).alias("options"))
    return asked.select(*group, "members", search("records", "options").alias("golden")).select(*group, "members", "golden.*")
