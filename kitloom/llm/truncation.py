"""Values that stop before their end, by a backward character n-gram model.

For the final contexts of all values (their last 3 to 26 characters) the model counts how often the context ends a value
and how often it occurs at all. A value's chance of ending there is interpolated from short to long contexts, itself left
out. Values are brought to one spelling first (restored encoding, consistent letters, lower case), integers count as one
sign, so that their length says nothing. Per column and language (told by its script) a value is cut if the log odds of
ending after its final context fall below the valley between the log odds of cut and of whole values; at lengths at which
many values are cut, as at a field limit, the chance of ending must exceed a multiple of the rate of such cuts.

Nothing is cut without evidence. A column has cuts only if its log odds have two modes and most values are whole ones, and
a value is cut only if its final five characters are known to go on elsewhere. So codes that all differ are whole.

Contexts are counted everywhere, but only those that end some value matter; a Bloom filter keeps the others from being
shuffled. It is sized by their count, up to BLOOM_MOST bits (128 MiB); its false positives only cost rows, never change a
count.

Defined cases: null and empty values are not cut; equal values are judged alike; a column of few values has few contexts
and flags nothing that it can't compare; other input columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import HOT_ROWS, broadcast_if_small, salted_join
from ..session import cut_lineage
from . import encodings, uniform
from .batches import larger

LEVELS = (3, 5, 8, 12, 18, 26)
PRIOR = 8.0
#: Bits of the Bloom filter a context and at most, and of one of its chunks, in which both bits of a context lie.
BLOOM_RATE, BLOOM_MOST, CHUNK_BITS = 12, 1 << 30, 1 << 20
#: Where the valley between cut and whole values is looked for, in log odds, and the width of a bin.
VALLEY, BIN = (-4.0, 0.0), 0.5
LIMIT_FACTOR, LIMIT_MOST = 4.0, 0.6
LOW = 0.1
#: The level whose context must go on elsewhere, and how often.
KNOWN_LEVEL, GOES_ON = 1, 3

_INTEGER = re.compile(r"(?<![0-9.,])[0-9]+")
_DIGIT = re.compile(r"[0-9]")
#: Signs for lost letters count as Cyrillic ones.
_CYRILLIC = re.compile("[Ѐ-ԯ?\ufffd]")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def normal(text: str) -> str:
    text = text.lower().replace("ё", "е")
    if _DIGIT.search(text):
        text = _DIGIT.sub("0", _INTEGER.sub("0", text))
    return text


def language(text: str) -> str:
    latin = len(_LATIN.findall(text))
    return "latin" if latin and latin > len(_CYRILLIC.findall(text)) else "cyrillic"


def _mixed(x: np.ndarray, salt: np.ndarray | np.uint64) -> np.ndarray:
    x = x ^ salt
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def context_hashes(texts: list[str], groups: np.ndarray, ends_only: bool) -> list[np.ndarray]:
    """Per level the hashes of the contexts at the ends of texts, or at all their positions; groups: a hash each."""
    pad = "\x02" * LEVELS[-1]
    codes = np.frombuffer(("".join(pad + t for t in texts)).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(lengths + LEVELS[-1])
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(codes), _BASE)]), dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[:-1], dtype=np.uint64)])
        inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(codes), _INVERSE)]), dtype=np.uint64)
        if ends_only:
            at, salt = ends, groups
        else:
            at = np.repeat(ends - lengths, lengths) + (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)) + 1
            salt = np.repeat(groups, lengths)
        return [_mixed((sums[at] - sums[at - k]) * inverse[at - k], salt + np.uint64(k)) for k in LEVELS]


def _places(hashes: np.ndarray, chunks: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits in the chunk of each hash."""
    base = ((hashes >> np.uint64(44)) & np.uint64(chunks - 1)).astype(np.int64) * CHUNK_BITS
    mask = np.uint64(CHUNK_BITS - 1)
    return base + (hashes & mask).astype(np.int64), base + ((hashes >> np.uint64(20)) & mask).astype(np.int64)


def _group_hash(names: list[str]) -> np.ndarray:
    known = {n: np.uint64(pd.util.hash_array(np.array([n], dtype=object))[0]) for n in set(names)}
    return np.array([known[n] for n in names], dtype=np.uint64)


def _batches(batches: Iterator[pa.RecordBatch], chars: int = 3_000_000) -> Iterator[tuple[list[str], list[str]]]:
    """(groups, texts) of several batches at once."""
    groups: list[str] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for g, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            groups.append(g)
            texts.append(t)
            size += len(t) + LEVELS[-1]
            if size > chars:
                yield groups, texts
                groups, texts, size = [], [], 0
    if texts:
        yield groups, texts


def prepared(values: DataFrame, pairs: list[tuple[int, int, int]]) -> DataFrame:
    """values (table_name, record_id, part, text) with model group, length and normalised text."""

    shared = values.sparkSession.sparkContext.broadcast(pairs)

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = uniform.word_form(shared.value), encodings.built(shared.value)
        for batch in larger(batches):
            texts = batch.column(4).to_pylist()
            spans = model.spans(texts)
            plain = [words.text(encodings.restore(t, spans[i])[0] if i in spans else t) for i, t in enumerate(texts)]
            groups = [f"{c}|{language(t)}" for c, t in zip(batch.column(3).to_pylist(), plain, strict=True)]
            normals = [normal(t) for t in plain]
            ends = context_hashes(normals, _group_hash(groups), ends_only=True)[-1].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(3)), pa.array(groups, pa.string()), pa.array([len(t) for t in plain], pa.int32()), pa.array(ends, pa.int64()), pa.array(normals, pa.string())],
                names=["table_name", "record_id", "part", "grp", "len", "ctx", "normal"],
            )

    asked = values.select("table_name", "record_id", "part", "model", "text").filter("text is not null and text <> ''")
    return asked.mapInArrow(prepare, "table_name string, record_id string, part string, grp string, len int, ctx bigint, normal string")


def _bloom(hashes: DataFrame, n: int) -> np.ndarray:
    """Bloom filter of n distinct hashes (h), built chunk by chunk; its size is bounded by BLOOM_MOST."""
    chunks = 1
    while chunks * CHUNK_BITS < min(BLOOM_RATE * n, BLOOM_MOST):
        chunks *= 2

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(CHUNK_BITS, dtype=bool)
        for place in _places(frame["h"].to_numpy().view(np.uint64), 1):
            bits[place] = True
        return pd.DataFrame({"chunk": [int(frame["chunk"].iloc[0])], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    placed = hashes.select(F.shiftrightunsigned("h", 44).bitwiseAND(F.lit(chunks - 1)).cast("int").alias("chunk"), "h")
    out = np.zeros(chunks * CHUNK_BITS // 8, dtype=np.uint8)
    for row in placed.groupBy("chunk").applyInPandas(build, "chunk int, bits binary").collect():
        at = row["chunk"] * CHUNK_BITS // 8
        out[at : at + CHUNK_BITS // 8] = np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return out


def context_chances(texts: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(ctx, n_values, chance, goes_on): of each final context at the longest level how many values have it, the chance that
    a value ends there, one value left out, and how often its last characters go on elsewhere."""

    def endings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, found in _batches(batches):
            levels = np.stack(context_hashes(found, _group_hash(groups), ends_only=True), axis=1)
            _, first, n = np.unique(levels[:, -1], return_index=True, return_counts=True)
            own = levels[first]
            yield pa.RecordBatch.from_arrays([pa.array(own[:, -1].view(np.int64)), pa.array(own.view(np.int64).tolist(), pa.list_(pa.int64())), pa.array(n, pa.int64())], names=["ctx", "levels", "n"])

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filter_bits.value
        chunks = len(bits) * 8 // CHUNK_BITS
        for groups, found in _batches(batches):
            for hashes in context_hashes(found, _group_hash(groups), ends_only=False):
                one, two = _places(hashes, chunks)
                there = (bits[one >> 3] >> (one & 7).astype(np.uint8)) & (bits[two >> 3] >> (two & 7).astype(np.uint8)) & 1
                own, n = np.unique(hashes[there.astype(bool)], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    rows = texts.select("grp", "normal")
    distinct = cut_lineage(rows.mapInArrow(endings, "ctx bigint, levels array<bigint>, n bigint").groupBy("ctx").agg(F.sum("n").alias("n"), F.any_value("levels").alias("levels")))
    each = distinct.select("ctx", "n", F.posexplode("levels").alias("level", "h"))
    ends = cut_lineage(each.groupBy("h").agg(F.sum("n").alias("ends"), F.count("*").alias("n_ctx")))
    filter_bits = texts.sparkSession.sparkContext.broadcast(_bloom(ends, ends.count()))
    total = rows.mapInArrow(occurrences, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("occurs"))
    known = cut_lineage(ends.join(total, "h").select("h", "n_ctx", (F.col("ends") - 1).alias("e"), (F.col("occurs") - 1).alias("o")))
    # short contexts are shared by very many long ones
    found = salted_join(each.select("ctx", "n", "level", "h"), known, "h", weight="n_ctx", spread=F.col("ctx"), hot_rows=hot_rows)
    joined = found.groupBy("ctx").agg(F.max("n").alias("n_values"), F.array_sort(F.collect_list(F.struct("level", "e", "o"))).alias("s"))
    chance = F.aggregate("s", F.lit(0.05).cast("double"), lambda acc, x: (x["e"] + F.lit(PRIOR) * acc) / (x["o"] + F.lit(PRIOR)))
    known = F.element_at("s", KNOWN_LEVEL + 1)
    return joined.select("ctx", "n_values", F.greatest(chance, F.lit(1e-9)).alias("chance"), (known["o"] - known["e"]).alias("goes_on"))


def cut_values(values: DataFrame, pairs: list[tuple[int, int, int]], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(table_name, record_id, part, chance, threshold, cut) of every value.

    values: table_name, record_id, part (what the rate of cuts is reported for), model (what is modelled together), text.
    """
    texts = cut_lineage(prepared(values, pairs))
    chances = cut_lineage(context_chances(texts, hot_rows))
    scored = salted_join(texts.drop("normal"), chances, "ctx", weight="n_values", spread=F.col("record_id"), hot_rows=hot_rows).drop("n_values")
    odds = F.log(F.col("chance") / F.greatest(1 - F.col("chance"), F.lit(1e-9)))
    scored = cut_lineage(scored.withColumn("odds", odds))
    # the valley of each model group, from a histogram
    first, last = int(VALLEY[0] / BIN), int(VALLEY[1] / BIN) - 1
    histogram = scored.groupBy("grp", F.floor(F.col("odds") / BIN).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    ranges = histogram.groupBy("grp").agg(F.least(F.min("bin"), F.lit(first)).alias("a"), F.greatest(F.max("bin"), F.lit(last)).alias("b"))
    grid = ranges.select("grp", F.explode(F.sequence(F.col("a") - 1, F.col("b") + 1)).alias("bin"))
    side = Window.partitionBy("grp").orderBy("bin")
    smooth = grid.join(histogram, ["grp", "bin"], "left").fillna(0, ["n"]).withColumn("s", F.col("n") + 0.5 * F.coalesce(F.lag("n").over(side), F.lit(0)) + 0.5 * F.coalesce(F.lead("n").over(side), F.lit(0)))
    lowest = smooth.filter(F.col("bin").between(first, last)).groupBy("grp").agg(F.min(F.struct("s", F.abs(F.col("bin") * BIN + 2.0).alias("off"), "bin")).alias("v")).select("grp", "v.s", "v.bin")
    below = F.col("h.bin") < F.col("v.bin")
    sides = smooth.alias("h").join(lowest.alias("v"), "grp").groupBy("grp", F.col("v.bin").alias("bin"), F.col("v.s").alias("s")).agg(F.max(F.when(below, F.col("h.s"))).alias("low_mode"), F.max(F.when(~below, F.col("h.s"))).alias("high_mode"), F.sum(F.when(below, F.col("h.n")).otherwise(0)).alias("n_low"), F.sum("h.n").alias("n"))
    two_modes = (F.col("low_mode") > F.col("s")) & (F.col("high_mode") > F.col("s")) & (F.col("n_low") <= 0.5 * F.col("n"))
    valley = sides.select("grp", ((F.col("bin") + 0.5) * BIN).alias("valley"), two_modes.alias("two_modes"))
    # the rate of cuts at each length
    lengths = scored.groupBy("part", "len").agg(F.count("*").alias("n"), F.count_if(F.col("chance") < LOW).alias("low"))
    longer = Window.partitionBy("part").orderBy(F.desc("len"))
    hazard = lengths.select("part", "len", (F.col("low") / (F.sum("n").over(longer) + 20)).alias("hazard"))
    # one row a group, and one a source and length: few, but checked
    judged = scored.join(broadcast_if_small(valley), "grp").join(broadcast_if_small(hazard), ["part", "len"])
    threshold = F.greatest(1 / (1 + F.exp(-F.col("valley"))), F.least(F.lit(LIMIT_MOST), F.lit(LIMIT_FACTOR) * F.col("hazard")))
    return judged.select("table_name", "record_id", "part", "grp", "len", "chance", threshold.alias("threshold"), (F.col("two_modes") & (F.col("goes_on") >= GOES_ON) & (F.col("chance") < threshold)).alias("cut"))


def cut_rates(judged: DataFrame) -> DataFrame:
    """How often each source or tool cuts."""
    return judged.groupBy("table_name", "part").agg(F.count("*").alias("n_values"), F.count_if("cut").alias("n_cut")).withColumn("rate", F.col("n_cut") / F.col("n_values"))
