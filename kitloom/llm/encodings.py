"""Restoring texts that were decoded with a wrong encoding.

A hidden Markov model labels the characters of a text: one clean state, one state per pair of the true and the wrongly
assumed encoding, and states for characters lost to a replacement sign. The clean state emits a character given the one
before as the corpus does; a pair's state emits what the corpus would look like after that wrong decoding, computed from
the same pair counts. The best labelling (Viterbi) marks spans; a span gets the inverse transform of its state.

The search is exact and leaves out what can't matter: a garbled span of the best path gains at least the cost of entering
it, so a place that lies in no interval of such a gain is clean, and the places left fall into stretches between clean
places that are searched one by one, however long the text is.

Defined cases: null and empty texts are clean; a span whose inverse transform fails or holds replacement signs is garbled
but not restorable; characters outside the alphabet count as one of their category; other input columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import larger
from .charmodel import CODE_PAGES, EDGE, GAP, OTHERS, pair_counts, signs

# Encodings that Cyrillic text is written in, and those it is wrongly read with.
TRUE_ENCODINGS = ("utf-8", "cp1251", "koi8_r", "cp866")
WRONG_ENCODINGS = CODE_PAGES
LOST_SIGNS = ("?", "�")
#: Log probabilities of starting or turning garbled, and of turning clean again.
START_GARBLED, ENTER, LEAVE = math.log(0.02), math.log(2e-5), math.log(1e-2)
SMOOTHING, FLOOR = 4.0, 1e-8


def read_wrong(data: bytes, wrong: str, lost: bool) -> str:
    """Undefined bytes become replacement signs or keep their value as control characters."""
    if lost:
        return data.decode(wrong, "replace")
    out = []
    for b in data:
        try:
            out.append(bytes([b]).decode(wrong))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


def write_wrong(text: str, wrong: str, strict: bool = True) -> bytes:
    """The bytes that were read wrongly, by the inverse of read_wrong."""
    out = bytearray()
    for c in text:
        try:
            out += c.encode(wrong)
        except UnicodeEncodeError:
            if ord(c) <= 0xFF:
                out.append(ord(c))
            elif strict:
                raise
            else:
                out += b"\x00"
    return bytes(out)


@dataclass(frozen=True)
class Garbling:
    true: str
    wrong: str
    times: int = 1

    def apply(self, text: str, lost: bool = False) -> str:
        for _ in range(self.times):
            text = read_wrong(text.encode(self.true, "replace"), self.wrong, lost)
        return text

    def undo(self, text: str, strict: bool = True) -> str | None:
        """The text before, None if bytes are missing; without strict, a replacement sign for each lost character."""
        try:
            for _ in range(self.times):
                text = write_wrong(text, self.wrong, strict).decode(self.true, "strict" if strict else "replace").replace("\x00", "�")
        except UnicodeError:
            return None
        return text


@dataclass(frozen=True)
class Loss:
    sign: str

    def apply(self, text: str, lost: bool = False) -> str:
        return "".join(c if c < "\x80" else self.sign for c in text)

    def undo(self, text: str, strict: bool = True) -> str | None:
        return None if strict and self.sign in text else text


GARBLINGS: tuple[Garbling | Loss, ...] = (
    *(Garbling(t, w) for t in TRUE_ENCODINGS for w in WRONG_ENCODINGS if t != w),
    *(Garbling("utf-8", w, 2) for w in WRONG_ENCODINGS),
    *(Loss(s) for s in LOST_SIGNS),
)


class EncodingModel:
    """Emission tables of all states from the counts of character pairs."""

    def __init__(self, pairs: list[tuple[int, int, int]]) -> None:
        clean: Counter[tuple[str, str]] = Counter()
        for a, b, n in pairs:
            clean[chr(a), chr(b)] += n
        # characters that are hardly ever used in clean text don't shape the garbled states
        singles: Counter[str] = Counter()
        for (_, b), n in clean.items():
            singles[b] += n
        total = max(1, sum(singles.values()))
        common = {c for c, n in singles.items() if n >= 3 and n > 2e-7 * total and c not in (EDGE, GAP) and ord(c) < OTHERS}
        joints: list[dict[tuple[str, str], float]] = [dict(clean)]
        for g in GARBLINGS:
            joint: dict[tuple[str, str], float] = defaultdict(float)
            images: dict[str, tuple[str, str]] = {c: (g.apply(c), g.apply(c, lost=True)) for c in common} | {EDGE: (EDGE, EDGE), GAP: (GAP, GAP)}
            for (a, b), n in clean.items():
                if a in images and b in images:
                    for k in (0, 1):
                        ia, ib = images[a][k], images[b][k]
                        joint[ia[-1], ib[0]] += n / 2
                        for x, y in zip(ib, ib[1:], strict=False):
                            joint[x, y] += n / 2
            joints.append(joint)
        # the fixed alphabet bounds the tables; signs that no state emits share one place
        seen = sorted({c for j in joints for p in j for c in p} - {EDGE, GAP})
        letters = [EDGE, GAP, "", *seen]
        place_of = np.full(0x10000, 2, dtype=np.int32)
        place_of[[ord(c) for c in letters if c]] = [k for k, c in enumerate(letters) if c]
        self.index = place_of[signs()]
        v = len(letters)
        place = {c: i for i, c in enumerate(letters)}
        tables = []
        for joint in joints:
            count = np.zeros((v, v), dtype=np.float64)
            for (a, b), n in joint.items():
                if a in place and b in place:
                    count[place[a], place[b]] += n
            before, after = count.sum(axis=1, keepdims=True), count.sum(axis=0)
            single = np.maximum(after / max(1.0, after.sum()), FLOOR)
            tables.append(np.log((count + SMOOTHING * single[None, :]) / (before + SMOOTHING)))
        self.v = v
        self.emit = np.stack(tables, axis=2).astype(np.float32)  # before, after, state
        self.garbled_emit = np.ascontiguousarray(self.emit[:, :, 1:]).reshape(-1, len(joints) - 1)
        self.gain = (self.emit[:, :, 1:].max(axis=2) - self.emit[:, :, 0]).astype(np.float32)
        self.states = len(joints)

    def _pairs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all pairs (before, after) in the tables, text after text, and where each text starts."""
        starts = np.cumsum([0, *map(len, texts)])
        ids = self.index[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
        before = np.concatenate([np.zeros(1, np.int32), ids[:-1]])
        before[starts[:-1][starts[:-1] < len(ids)]] = 0  # EDGE
        return before * self.v + ids, starts

    def stretches(self, pairs: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
        """Where a best path can be garbled: the union of intervals whose greatest gain pays for the cheapest way in."""
        gain = self.gain.ravel()[pairs].astype(np.float64)
        texts = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        # a fall between texts that no gain within one can make up for, so that no interval reaches over a border
        fall = 1.0 + np.bincount(texts, np.maximum(gain, 0), len(starts) - 1).max(initial=0)
        sums = np.cumsum(gain) - fall * texts
        before = sums - gain
        most = np.maximum.accumulate(sums[::-1])[::-1]
        near = most - np.minimum.accumulate(before) > -START_GARBLED
        edges = np.flatnonzero(np.diff(np.concatenate([[0], near.view(np.int8), [0]])))
        out = []
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            cuts = starts[np.searchsorted(starts, a, "right") : np.searchsorted(starts, b, "left")].tolist()
            out += [(x, y) for x, y in zip([a, *cuts], [*cuts, b], strict=True) if x < y]
        return out

    def _viterbi(self, pairs: np.ndarray, lengths: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The states of the best labelling, one row a stretch.

        first, last: whether a stretch begins, or ends, with its text; elsewhere its neighbour is clean. Garbled states are
        entered from the clean one and left to it, so a garbled state's way back is one bit a step.
        """
        n, t = pairs.shape
        garbled = self.states - 1
        clean_emit, emit = self.emit[:, :, 0].ravel(), self.garbled_emit
        enter = np.float32(ENTER - math.log(garbled))
        clean = clean_emit[pairs[:, 0]]
        other = emit[pairs[:, 0]] + np.where(first, np.float32(START_GARBLED - math.log(garbled)), enter)[:, None]
        entered = np.zeros((t, n, -(-garbled // 8)), dtype=np.uint8)
        left_from = np.zeros((t, n), dtype=np.int8)  # 0: clean before, else the garbled state left
        final = np.zeros(n, dtype=np.int8)
        for k in range(t):
            if k:
                way_in = (clean + enter)[:, None]
                entered[k] = np.packbits(way_in > other, axis=1)
                leave = other.max(axis=1) + np.float32(LEAVE)
                back = np.flatnonzero(leave > clean)
                if len(back):
                    left_from[k, back] = other[back].argmax(axis=1) + 1
                    clean[back] = leave[back]
                np.maximum(other, way_in, out=other)
                clean = clean + clean_emit[pairs[:, k]]
                other += emit[pairs[:, k]]
            done = np.flatnonzero(lengths == k + 1)
            if len(done):
                best = other[done].argmax(axis=1)
                final[done] = np.where(other[done, best] + np.where(last[done], np.float32(0), np.float32(LEAVE)) > clean[done], best + 1, 0)
        path = np.zeros((n, t), dtype=np.int8)
        state = final.astype(np.int64)
        rows = np.arange(n)
        for k in range(t - 1, -1, -1):
            inside = lengths > k
            path[inside, k] = state[inside]
            if k:
                own = np.maximum(state, 1) - 1
                came_in = entered[k, rows, own >> 3] >> (7 - (own & 7)) & 1
                before = np.where(state == 0, left_from[k], np.where(came_in == 1, 0, state))
                state = np.where(inside, before, state)
        return path

    def spans(self, texts: list[str]) -> dict[int, list[tuple[int, int, int]]]:
        """By place in texts the garbled spans as (start, end, state)."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) <= 2_000_000):
                size += len(texts[end])
                end += 1
            if size:
                self._search(texts[at:end], at, out)
            at = end
        return out

    def _search(self, texts: list[str], base: int, out: dict[int, list[tuple[int, int, int]]]) -> None:
        pairs, starts = self._pairs(texts)
        found = sorted(self.stretches(pairs, starts), key=lambda s: (s[1] - s[0], s))
        spans: list[tuple[int, int, int]] = []
        at = 0
        while at < len(found):
            # stretches of about one length together, as many as fit
            longest = max(40, 2 * (found[at][1] - found[at][0]))
            end = at + 1
            while end < len(found) and (size := found[end][1] - found[end][0]) <= longest and (end + 1 - at) * size <= 1_000_000:
                end += 1
            part = np.array(found[at:end])
            at = end
            lengths = part[:, 1] - part[:, 0]
            cells = np.minimum(part[:, :1] + np.arange(int(lengths.max()))[None, :], len(pairs) - 1)
            first, last = np.isin(part[:, 0], starts), np.isin(part[:, 1], starts)
            for row, n, (a, _) in zip(self._viterbi(pairs[cells], lengths, first, last), lengths, part.tolist(), strict=True):
                states = row[:n]
                if states.any():
                    edges = [0, *(np.flatnonzero(np.diff(states)) + 1).tolist(), int(n)]
                    spans += [(a + x, a + y, int(states[x])) for x, y in zip(edges, edges[1:], strict=False) if states[x]]
        for a, b, state in sorted(spans):
            i = int(np.searchsorted(starts, a, "right")) - 1
            own, shift = out.setdefault(base + i, []), int(starts[i])
            own.append((a - shift, b - shift, state))


def restore(text: str, spans: list[tuple[int, int, int]]) -> tuple[str, bool]:
    """The text with every span transformed back, as far as it can be, and whether all of it could be."""
    out, end, whole = [], 0, True
    for a, b, state in spans:
        out.append(text[end:a])
        # the model may put a character that both sides share on the wrong side of a border
        back = None
        for grow in (0, 1, 2):
            if (back := GARBLINGS[state - 1].undo(text[a : min(b + grow, len(text))])) is not None:
                b = min(b + grow, len(text))
                break
        if back is None:
            whole, back = False, GARBLINGS[state - 1].undo(text[a:b], strict=False)
        out.append(back)
        end = b
    out.append(text[end:])
    return "".join(out), whole


def train(*texts: DataFrame) -> list[tuple[int, int, int]]:
    """The counts over all rows of one-column tables, from which each worker builds the same model."""
    union = texts[0]
    for t in texts[1:]:
        union = union.unionByName(t)
    return pair_counts(union)


_built: dict[int, EncodingModel] = {}


def built(pairs: list[tuple[int, int, int]]) -> EncodingModel:
    """The model of a worker process, built once for each set of counts."""
    key = hash(tuple(pairs))
    if key not in _built:
        _built.clear()
        _built[key] = EncodingModel(pairs)
    return _built[key]


def garbled_records(records: DataFrame, pairs: list[tuple[int, int, int]]) -> DataFrame:
    """Of records (table_name, record_id, text) the garbled ones, with restored and restorable."""

    shared = records.sparkSession.sparkContext.broadcast(pairs)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = built(shared.value)
        for batch in larger(batches):
            texts = batch.column(2).to_pylist()
            found = model.spans(texts)
            rows = pa.array(sorted(found), pa.int64())
            fixed = [restore(texts[i], found[i]) for i in sorted(found)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(2).take(rows), pa.array([t for t, _ in fixed], pa.string()), pa.array([w for _, w in fixed], pa.bool_())],
                names=["table_name", "record_id", "text", "restored", "restorable"],
            )

    asked = records.select("table_name", F.col("record_id").cast("string").alias("record_id"), "text").filter("text is not null and text <> ''")
    return asked.mapInArrow(label, "table_name string, record_id string, text string, restored string, restorable boolean")
