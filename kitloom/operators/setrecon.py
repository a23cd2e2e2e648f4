"""Differences between two copies of a table by characteristic-polynomial set reconciliation.

Each copy is reduced to a set of row hashes, split into buckets by key hash. On its own side a bucket's set S is summed up
as a sketch: the values of its characteristic polynomial prod(z - h) over GF(p) at agreed points, its size and a checksum.
Sketches of parts of a bucket combine by multiplication. Only sketches are exchanged: the quotient of both copies' values
is a rational function whose numerator and denominator vanish at exactly the hashes that one side lacks; a linear system
modulo p gives both for a bound on their degree, which is doubled until the points left over agree. The polynomials go back
to the rows of their bucket, whose hashes are the roots; the 64-bit checksums of what is left must be equal. Buckets that
fail are sketched again with four times the points and other hashes. Then the rows found are fetched and compared field by
field.

Buckets refine the partitions into which rows are hashed by key to find the latest of each, so a bucket's sketch is made
where its rows are; only (key, time, hash) move for that.

Defined cases: rows without a key are no part of either set; of several rows with one key the latest counts (of equally
late ones that of the greatest hash), so repeated rows are one row; null equals the empty string; empty tables give only
one-sided rows; other columns of the inputs are ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .skew import broadcast_if_small

PRIME = (1 << 31) - 1
#: Hashes lie below this; the points at which the polynomials are evaluated lie above.
HASH_TOP = PRIME - (1 << 20)
BUCKET_ROWS = 16
#: Buckets decoded by one call; the first bound on the degree, that of the first sketches, and the points that verify.
BUCKETS_PER_CALL, FIRST_BOUND, SKETCH_BOUND, CHECKS = 4096, 8, 32, 2
#: Rows of polynomials that may be broadcast, a few hundred bytes each.
SMALL_POLYNOMIALS = 200_000


def _mulmod(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a * b % np.uint64(PRIME)


def _powmod(a: np.ndarray, e: int) -> np.ndarray:
    out, base = np.ones_like(a), a.copy()
    while e:
        if e & 1:
            out = _mulmod(out, base)
        base = _mulmod(base, base)
        e >>= 1
    return out


def _padded(bucket: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """values by bucket as a matrix of one row a bucket, and the rows' lengths."""
    order = np.argsort(bucket, kind="stable")
    lengths = np.bincount(bucket, minlength=n)
    start = np.cumsum(lengths) - lengths
    place = np.arange(len(bucket)) - np.repeat(start, lengths)
    matrix = np.zeros((n, max(1, int(lengths.max(initial=0)))), dtype=values.dtype)
    matrix[bucket[order], place] = values[order]
    return matrix, lengths


def sketch(hashes: np.ndarray, lengths: np.ndarray, points: np.ndarray) -> np.ndarray:
    """prod(point - hash) for every bucket and point."""
    out = np.ones((len(lengths), len(points)), dtype=np.uint64)
    for k in range(hashes.shape[1]):
        there = lengths > k
        factor = (points[None, :] + np.uint64(PRIME) - hashes[there, k][:, None]) % np.uint64(PRIME)
        out[there] = _mulmod(out[there], factor)
    return out


def _solve(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan over GF(p) for many systems at once; free unknowns become 0."""
    g, rows, width = matrix.shape
    unknowns, every = width - 1, np.arange(g)
    rank = np.zeros(g, dtype=np.int64)
    owner = np.full((g, unknowns), -1, dtype=np.int64)
    for col in range(unknowns):
        usable = (matrix[:, :, col] != 0) & (np.arange(rows)[None, :] >= rank[:, None])
        pivot, has = usable.argmax(axis=1), usable.any(axis=1)
        at = every[has]
        if not len(at):
            continue
        r, p = rank[at], pivot[at]
        held = matrix[at, r].copy()
        matrix[at, r] = matrix[at, p]
        matrix[at, p] = held
        lead = _mulmod(matrix[at, r], _powmod(matrix[at, r, col], PRIME - 2)[:, None])
        matrix[at, r] = lead
        factor = matrix[at, :, col].copy()
        factor[np.arange(len(at)), r] = 0
        minus = (np.uint64(PRIME) - factor)[:, :, None]
        matrix[at] = (matrix[at] + minus * lead[:, None, :] % np.uint64(PRIME)) % np.uint64(PRIME)
        owner[at, col] = r
        rank[at] += 1
    out = np.zeros((g, unknowns), dtype=np.uint64)
    for col in range(unknowns):
        has = owner[:, col] >= 0
        out[has, col] = matrix[every[has], owner[has, col], width - 1]
    return out


def decode(fa: np.ndarray, fb: np.ndarray, na: np.ndarray, nb: np.ndarray, points: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numerator and denominator of fa / fb for a difference of at most bound hashes."""
    delta = na.astype(np.int64) - nb
    da = np.clip((bound + delta) // 2, 0, bound)
    db = np.clip(da - delta, 0, bound)
    da = np.clip(db + delta, 0, bound)
    f = _mulmod(fa, _powmod(fb, PRIME - 2))
    powers = np.ones((len(points), bound + 1), dtype=np.uint64)
    for k in range(1, bound + 1):
        powers[:, k] = _mulmod(powers[:, k - 1], points)
    g, m = f.shape
    system = np.zeros((g, m, 2 * bound + 1), dtype=np.uint64)
    ka = np.arange(bound)[None, :] < da[:, None]
    kb = np.arange(bound)[None, :] < db[:, None]
    system[:, :, :bound] = powers[None, :, :bound] * ka[:, None, :].astype(np.uint64)
    system[:, :, bound : 2 * bound] = (np.uint64(PRIME) - _mulmod(f[:, :, None], powers[None, :, :bound])) % np.uint64(PRIME) * kb[:, None, :].astype(np.uint64)
    top_b = _mulmod(f, powers[:, db].T)
    top_a = powers[:, da].T
    system[:, :, -1] = (top_b + np.uint64(PRIME) - top_a) % np.uint64(PRIME)
    solution = _solve(system)
    return solution[:, :bound], da, solution[:, bound:], db


def _values(coefficients: np.ndarray, degree: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Values of each bucket's monic polynomial (coefficients from degree 0 up) at the points."""
    value = np.zeros((len(degree), len(points)), dtype=np.uint64)
    width = coefficients.shape[1]
    for k in range(width, -1, -1):
        own = np.where(k == degree, 1, np.where(k < degree, coefficients[:, min(k, width - 1)], 0)).astype(np.uint64)
        value = (_mulmod(value, points[None, :]) + own[:, None]) % np.uint64(PRIME)
    return value


def polynomials(fa: np.ndarray, fb: np.ndarray, na: np.ndarray, nb: np.ndarray, points: np.ndarray) -> dict[int, tuple[list[int], list[int]]]:
    """By bucket the numerator and denominator (without their leading 1), for those that a bound below the points fits."""
    out: dict[int, tuple[list[int], list[int]]] = {}
    open_, bound = np.arange(len(na)), FIRST_BOUND
    while len(open_) and bound + CHECKS <= len(points):
        p, da, q, db = decode(fa[open_, :bound], fb[open_, :bound], na[open_], nb[open_], points[:bound], bound)
        rest = points[bound:]
        good = (_mulmod(fa[open_][:, bound:], _values(q, db, rest)) == _mulmod(fb[open_][:, bound:], _values(p, da, rest))).all(axis=1)
        for k in np.flatnonzero(good):
            out[int(open_[k])] = (p[k, : da[k]].tolist(), q[k, : db[k]].tolist())
        open_, bound = open_[~good], bound * 2
    return out


def _points(bound: int) -> np.ndarray:
    return (HASH_TOP + 1 + np.arange(bound + CHECKS)).astype(np.uint64)


def sketches(rows: DataFrame, bound: int) -> DataFrame:
    """(bucket, n, chk, values) of rows (bucket, h, chk) that are sorted by bucket within partitions; a bucket may have several."""
    points = _points(bound)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, h, chk = (np.asarray(batch.column(k)) for k in range(3))
            names, inverse, n = np.unique(bucket, return_inverse=True, return_counts=True)
            values = sketch(*_padded(inverse, h.astype(np.uint64), len(names)), points).astype(np.uint32)
            order = np.argsort(inverse, kind="stable")
            checks = np.bitwise_xor.reduceat(chk[order], np.cumsum(n) - n)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n, pa.int64()), pa.array(checks), pa.array([v.tobytes() for v in values], pa.binary())], names=["bucket", "n", "chk", "values"])

    return rows.select("bucket", "h", "chk").mapInArrow(fold, "bucket bigint, n bigint, chk bigint, values binary")


def _combined(frame: pd.DataFrame, names: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, checksums and values by bucket, partial sketches multiplied."""
    n, chk, values = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), np.ones((len(names), width), np.uint64)
    if len(frame):
        at = np.searchsorted(names, frame["bucket"].to_numpy())
        parts = np.frombuffer(b"".join(frame["values"]), dtype=np.uint32).reshape(-1, width).astype(np.uint64)
        np.add.at(n, at, frame["n"].to_numpy())
        np.bitwise_xor.at(chk, at, frame["chk"].to_numpy())
        turn = pd.Series(at).groupby(at).cumcount().to_numpy()
        for k in range(int(turn.max()) + 1):
            now = turn == k
            values[at[now]] = _mulmod(values[at[now]], parts[now])
    return n, chk, values


def compared(left: pd.DataFrame, right: pd.DataFrame, bound: int) -> pd.DataFrame:
    """Of the buckets whose sketches differ: left_poly and right_poly, or whole (all its rows are to be compared), or neither."""
    names = np.unique(np.concatenate([left["bucket"].to_numpy(np.int64), right["bucket"].to_numpy(np.int64)]))
    points = _points(bound)
    (na, ca, fa), (nb, cb, fb) = (_combined(f, names, len(points)) for f in (left, right))
    differ = np.flatnonzero((na != nb) | (ca != cb) | (fa != fb).any(axis=1))
    whole = (na[differ] == 0) | (nb[differ] == 0) | ((na + nb)[differ] <= bound // 2)
    asked = differ[~whole]
    found = polynomials(fa[asked], fb[asked], na[asked], nb[asked], points)
    by = {int(asked[k]): v for k, v in found.items()}
    rows = [(int(names[k]), bool(w), *by.get(int(k), (None, None)), int(na[k] - nb[k]), int(ca[k] ^ cb[k])) for k, w in zip(differ, whole, strict=True)]
    return pd.DataFrame(rows, columns=["bucket", "whole", "left_poly", "right_poly", "n_diff", "chk_diff"])


def _judge(bound: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def judge(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return compared(left, right, bound)

    return judge


COMPARED = "bucket bigint, whole boolean, left_poly array<bigint>, right_poly array<bigint>, n_diff bigint, chk_diff bigint"


def is_root(coefficients: Column, h: Column) -> Column:
    """Whether the monic polynomial vanishes at h, by Horner's scheme."""
    value = F.aggregate(F.reverse(coefficients), F.lit(1).cast("bigint"), lambda acc, c: (acc * h + c) % F.lit(PRIME))
    return (F.size(coefficients) > 0) & (value == 0)


def differing_hashes(left: DataFrame, right: DataFrame, bound: int = SKETCH_BOUND) -> DataFrame:
    """(side, key, chk) of the rows that the other side lacks; left and right: key, chk, bucket, sorted by bucket in partitions."""
    sides = {"left": left, "right": right}
    found = todo = None
    turn = 0
    while True:
        rows = {}
        for side, df in sides.items():
            held = df if todo is None else df.join(todo, "bucket", "left_semi").sortWithinPartitions("bucket")
            rows[side] = held.withColumn("h", F.pmod(F.xxhash64("chk", F.lit(turn)), F.lit(HASH_TOP)))
        a, b = (sketches(r, bound).withColumn("grp", F.floor(F.col("bucket") / BUCKETS_PER_CALL).cast("bigint")).groupBy("grp") for r in rows.values())
        verdicts = broadcast_if_small(a.cogroup(b).applyInPandas(_judge(bound), COMPARED), SMALL_POLYNOMIALS)
        hits = None
        for side, r in rows.items():
            judged = r.join(verdicts.select("bucket", "whole", F.col(f"{side}_poly").alias("poly")), "bucket").filter(F.col("whole") | is_root(F.col("poly"), F.col("h")))
            part = judged.select("bucket", "whole", F.lit(side).alias("side"), "key", "chk")
            hits = part if hits is None else hits.unionByName(part)
        hits = cut_lineage(hits)
        both = hits.filter("whole").groupBy("bucket", "chk").agg(F.count("*").alias("n"), F.first("side").alias("side"), F.first("key").alias("key")).filter("n = 1").select("bucket", "side", "key", "chk")
        roots = hits.filter("not whole")
        left_over = roots.groupBy("bucket").agg(F.bit_xor("chk").alias("x"), F.sum(F.when(F.col("side") == "left", 1).otherwise(-1)).alias("n"))
        failed = cut_lineage(verdicts.filter("not whole").join(left_over, "bucket", "left").filter(F.col("left_poly").isNull() | (F.coalesce("x", F.lit(0)) != F.col("chk_diff")) | (F.coalesce("n", F.lit(0)) != F.col("n_diff"))).select("bucket"))
        good = both.unionByName(roots.join(failed, "bucket", "left_anti").select("bucket", "side", "key", "chk")).select("side", "key", "chk")
        found = good if found is None else found.unionByName(good)
        if not (n_failed := failed.count()):
            return found
        todo = F.broadcast(failed) if n_failed <= SMALL_POLYNOMIALS else failed
        turn, bound = turn + 1, bound * 4


def reconcile(left: DataFrame, right: DataFrame, *, key: str, left_at: str, right_at: str, fields: Mapping[str, Column], left_name: str = "left", right_name: str = "right", bucket_rows: int = BUCKET_ROWS, bound: int = SKETCH_BOUND) -> DataFrame:
    """(key, difference): only_<left_name>, only_<right_name>, or a field whose normalised values differ.

    fields maps a reported name to the normalised column to compare; the same expressions apply to both copies.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * max(1, -(-max(left.count(), right.count()) // (bucket_rows * parts)))

    def hashed(df: DataFrame, at: str) -> DataFrame:
        own = F.struct(*[F.coalesce(c, F.lit("")).alias(n) for n, c in fields.items()])
        rows = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(at).alias("at"), own.alias("own"))
        return rows.withColumn("chk", F.xxhash64(F.lit("row"), "key", *[F.col(f"own.{n}") for n in fields]))

    copies = {"left": hashed(left, left_at), "right": hashed(right, right_at)}
    sets = []
    for rows in copies.values():
        latest = rows.groupBy("key").agg(F.max(F.struct("at", "chk")).alias("m")).select("key", F.col("m.chk").alias("chk"))
        # the hash by which rows are sent to partitions, so that buckets refine them
        sets.append(cut_lineage(latest.withColumn("bucket", F.pmod(F.hash("key"), F.lit(buckets)).cast("bigint")).sortWithinPartitions("bucket")))
    found = cut_lineage(differing_hashes(*sets, bound=bound))
    fetched = []
    for side, rows in copies.items():
        asked = broadcast_if_small(found.filter(F.col("side") == side).select("chk"))
        fetched.append(rows.join(asked, "chk", "left_semi").groupBy("key").agg(F.max("own").alias(side)))
    both = fetched[0].join(fetched[1], "key", "full_outer")
    verdicts = [F.when(F.col("right").isNull(), F.lit(f"only_{left_name}")).when(F.col("left").isNull(), F.lit(f"only_{right_name}"))]
    verdicts += [F.when(F.col("left").isNotNull() & F.col("right").isNotNull() & (F.col(f"left.{n}") != F.col(f"right.{n}")), F.lit(n)) for n in fields]
    return both.select(F.col("key"), F.explode(F.array_compact(F.array(*verdicts))).alias("difference"))


def squeezed(c: Column) -> Column:
    """Without spaces and case."""
    return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))


def loose_title(c: Column) -> Column:
    """Without case, quotes, outer and repeated spaces, ё as е."""
    bare = F.translate(F.lower(c), "ё«»\"'„“”‘’`", "е")
    return F.trim(F.regexp_replace(bare, r"(?U)\s+", " "))


def loose_number(c: Column) -> Column:
    """Trimmed; digits only as a number."""
    bare = F.trim(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))
    return F.when(bare.rlike(r"^[0-9]+$"), F.regexp_replace(bare, r"^0+(?=[0-9])", "")).otherwise(bare)


def stamp_differences(kit: DataFrame, archive: DataFrame) -> DataFrame:
    """Sheets missing in one copy of the stamps and differing code, title and sheets_total."""
    fields = {"code": squeezed(F.col("code")), "title": loose_title(F.col("title")), "sheets_total": loose_number(F.col("sheets_total"))}
    return reconcile(kit, archive, key="sheet_key", left_at="read_at", right_at="synced_at", fields=fields, left_name="kit", right_name="archive").withColumnRenamed("key", "sheet_key")
