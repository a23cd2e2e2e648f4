"""Cleaners whose every step depends on the steps before: plain functions of one text, run in Arrow batches.

A text is the unit of work, so these scale with the number of texts; none of them looks across texts.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPEAT_MARK = "[truncated-repeat]"
_NUMBER = re.compile(r"-?[0-9]+(?:[.,][0-9]+)?")
# What counts as a loop in a text: units of a cell or line and of any signs, with their numbers of copies.
CELL_LOOP = re.compile(r"((?:[^\n]{2,40}?(?:;|\n))\s*)\1{5,}")
ANY_LOOP = re.compile(r"(.{6,80}?)\1{6,}")
LONG_SPACE = re.compile(r"\s{20}")
TAIL_UNITS, TAIL_COPIES, LEAST_TEXT = range(12, 121), 3, 40


def periodic(values: np.ndarray, period: int) -> list[tuple[int, int]]:
    """Maximal stretches (start, end) in which every value equals the one a period before it, at least two periods long."""
    same = np.concatenate([[0], (values[period:] == values[:-period]).view(np.int8), [0]])
    edges = np.flatnonzero(np.diff(same))
    return [(a, b + period) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= period]


def has_copies(codes: np.ndarray, units: range, copies: int) -> bool:
    """Whether some unit stands so many times in a row."""
    for unit in units:
        least = unit * (copies - 1)
        if least + unit > len(codes):
            return False
        same = codes[unit:] == codes[:-unit]
        if np.count_nonzero(same) >= least:
            breaks = np.flatnonzero(~same)
            if np.diff(np.concatenate([[-1], breaks, [len(same)]])).max() > least:
                return True
    return False


def looping_tail(codes: np.ndarray, text: str) -> tuple[int, int] | None:
    """(start, unit) of the copies of the longest unit that a text ends with often enough."""
    for unit in reversed(TAIL_UNITS):
        if unit * (TAIL_COPIES + 1) > len(codes):
            continue
        other = np.flatnonzero(codes[unit:] != codes[:-unit])
        periods = (len(codes) - (int(other[-1]) + 1 if len(other) else 0)) // unit
        if periods >= TAIL_COPIES and not text[-unit:].isspace():
            return len(codes) - periods * unit, unit
    return None


def without_loops(text: str) -> str:
    """Loops of a cell or line keep two copies, looping tails three, other loops two; a run of empty cells is no loop."""
    if len(text) < LEAST_TEXT:
        return text
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    # the patterns are tried only where their copies can be: a unit of a cell is longer than that by spaces alone
    cell = CELL_LOOP.search(text) if has_copies(codes, range(3, 64), 6) or LONG_SPACE.search(text) else None
    tail = looping_tail(codes, text) if cell is None else None
    any_loop = ANY_LOOP.search(text) if cell is None and tail is None and has_copies(codes, range(6, 81), 7) else None
    if tail is not None:
        start, unit = tail
        return f"{text[: start + TAIL_COPIES * unit].rstrip()}\n{REPEAT_MARK}"
    loop = cell or any_loop
    if loop is None or not loop[1].strip(" |\t\n"):
        return text
    before, after, kept = text[: loop.start()], text[loop.end() :], loop[1] * 2
    return f"{before}{kept.rstrip() if cell else kept}\n{REPEAT_MARK}\n{after}".strip()


def without_progressions(text: str, min_run: int = 12, gap: int = 3) -> str:
    """In a line, the longest run of numbers with a constant step keeps its first two and its last."""
    return "\n".join(_progression(line, min_run, gap) for line in text.split("\n"))


def _progression(line: str, min_run: int, gap: int) -> str:
    found = list(_NUMBER.finditer(line))
    if len(found) < min_run:
        return line
    values = [float(m[0].replace(",", ".")) for m in found]
    best, start = (0, 0), 0
    for i in range(1, len(found)):
        near = found[i].start() - found[i - 1].end() <= gap
        even = i - start < 2 or abs((values[i] - values[i - 1]) - (values[i - 1] - values[i - 2])) < 1e-6
        if not near:
            start = i
        elif not even:
            start = i - 1
        if i - start > best[1] - best[0]:
            best = (start, i)
    first, last = best
    if last - first + 1 < min_run:
        return line
    return f"{line[: found[first + 1].end()]} … {line[found[last].start() :]}"


def without_cycles(text: str, longest: int = 6, cycles: int = 4) -> str:
    """Blocks of two to `longest` lines that repeat `cycles` times or more keep one copy and a note.

    Of overlapping stretches the one that starts first goes first, of equal starts the one of the shorter block.
    """
    lines = text.split("\n")
    numbers: dict[str, int] = {}
    keys = np.array([numbers.setdefault(" ".join(x.lower().split()), len(numbers)) for x in lines])
    open_ = [(start, period, end) for period in range(2, longest + 1) if period < len(keys) for start, end in periodic(keys, period) if end - start >= period * cycles]
    heapq.heapify(open_)
    blank, done, out = numbers.get(""), 0, []
    while open_:
        start, period, end = heapq.heappop(open_)
        if start < done:
            if end - done >= period * cycles:
                heapq.heappush(open_, (done, period, end))
            continue
        if (keys[start : start + period] == blank).all():
            continue
        times = (end - start) // period
        out += [*lines[done : start + period], f"[truncated-cycle: блок из {period} строк повторён {times} раз]"]
        done = start + times * period
    return "\n".join([*out, *lines[done:]])


def without_phrase_repeats(text: str, min_len: int = 60, min_repeats: int = 4, phrase: int = 6) -> str:
    """In long lines, and in long cells of a table row where they stand, phrases between commas that recur stay once."""

    def thinned(found: re.Match[str]) -> str:
        whole = found[0]
        bare = whole.strip()
        pieces = [p.strip() for p in re.split("[,;]", bare)]
        times = Counter(p.lower() for p in pieces)
        if len(bare) < min_len or max((n for p, n in times.items() if len(p) >= phrase), default=0) < min_repeats:
            return whole
        first = {p.lower(): p for p in reversed(pieces)}
        kept = ", ".join(first[k] for k in times)
        return whole.replace(bare, kept) if whole.startswith(" ") else kept

    return re.sub(r"(?m)^(?!\s*\|).{%d,}$|(?<=\|)[^|\n]{%d,}(?=\||$)" % (min_len, min_len), thinned, text)


def without_error_stubs(text: str, start: str = "[error") -> tuple[str, int]:
    """Error stubs with balanced brackets go; how many there were."""
    out, n, i = [], 0, 0
    low = text.lower()
    while (at := low.find(start, i)) >= 0:
        depth, end = 0, at
        for end in range(at, len(text)):
            depth += (text[end] in "[(") - (text[end] in "])")
            if depth == 0:
                break
        out.append(text[i:at])
        n += 1
        i = end + 1
    return "".join(out) + text[i:], n


def wrapped(text: str, width: float, size: float, ratio: float = 0.6) -> str:
    """Greedy wrapping by the width that a sign takes."""
    most = max(1, int(width / (size * ratio))) if width > 0 and size > 0 else len(text) + 1
    out = []
    for line in text.split("\n"):
        row = ""
        for word in line.split(" "):
            if row and len(row) + 1 + len(word) > most:
                out.append(row)
                row = word
            else:
                row = f"{row} {word}" if row else word
        out.append(row)
    return "\n".join(out)


def unescaped(text: str) -> str:
    """\\U+XXXX escapes as characters; \\M+nXXXX as the character of its byte pair."""
    text = re.sub(r"\\U\+([0-9A-Fa-f]{4})", lambda m: chr(int(m[1], 16)), text)
    return re.sub(r"\\M\+[0-9]([0-9A-Fa-f]{4})", lambda m: bytes.fromhex(m[1]).decode("cp932", "replace"), text)


def sanitized(text: str) -> str:
    """Control signs become spaces, private-use signs go, mathematical letters become plain ones."""
    out = []
    for c in text:
        kind = unicodedata.category(c)
        if c == "\n":
            out.append(c)
        elif kind == "Cc":
            out.append(" ")
        elif kind in ("Co", "Cs") or c == "�":
            continue
        elif "\U0001d400" <= c <= "\U0001d7ff":
            out.append(unicodedata.normalize("NFKC", c))
        else:
            out.append(c)
    return "".join(out)


def joined_tiers(lines: Iterable[str]) -> str:
    """Tiers of a cell: broken words joined, wrapped lines joined by a space, other tiers by a break."""
    out = ""
    for line in filter(None, map(str.strip, lines)):
        if not out:
            out = line
        elif out.endswith("-") and line[0].islower():
            out = out[:-1] + line
        elif len(line) <= 2 and line.isalpha() and line.islower():
            out += line
        elif line[0].islower():
            out = f"{out} {line}"
        else:
            out = f"{out}<br>{line}"
    return out


def tile_grid(width: int, height: int, tile: int, most: int) -> tuple[int, int]:
    """Columns and rows of tiles of at most `tile`, the larger side given up first until `most` suffice."""
    columns, rows = max(1, -(-width // tile)), max(1, -(-height // tile))
    while columns * rows > max(1, most):
        if columns >= rows:
            columns -= 1
        else:
            rows -= 1
    return columns, rows


class KnownTokens:
    """A growing set of tokens that tells whether a token is one of them or a piece of one, by their runs of three signs."""

    def __init__(self, tokens: Iterable[str]) -> None:
        self.tokens: set[str] = set()
        self.having: dict[str, list[str]] = {}
        self.add(tokens)

    def add(self, tokens: Iterable[str]) -> None:
        for t in tokens:
            if t not in self.tokens:
                self.tokens.add(t)
                for run in {t[k : k + 3] for k in range(len(t) - 2)}:
                    self.having.setdefault(run, []).append(t)

    def holds(self, token: str) -> bool:
        """For tokens of three signs or more."""
        if token in self.tokens:
            return True
        rarest = min((self.having.get(token[k : k + 3], ()) for k in range(len(token) - 2)), key=len)
        return any(token in t for t in rarest)


class OpenTexts:
    """Texts of which each goes as soon as it stands inside a text that is met; what stays is what is iterated.

    A text is looked for by the rarest of its runs of so many signs, a shorter one as a whole. Runs are counted by a hash in so
    many slots, which bounds the memory; a run taken for a common one costs time only.
    """

    SLOTS = 1 << 18

    def __init__(self, texts: list[str], size: int) -> None:
        runs = lambda t: [t[k : k + size] for k in range(max(1, len(t) - size + 1))]
        counts = Counter(hash(r) % self.SLOTS for t in texts for r in runs(t))
        self.by_run: dict[str, list[str]] = {}
        for t in texts:
            self.by_run.setdefault(min(runs(t), key=lambda r: counts[hash(r) % self.SLOTS]), []).append(t)
        self.sizes = {len(r) for r in self.by_run}

    def __iter__(self) -> Iterator[str]:
        return (t for ts in self.by_run.values() for t in ts)

    def meet(self, whole: str) -> None:
        if len(self.by_run) <= len(whole):
            near = [r for r in self.by_run if r in whole]
        else:
            near = self.by_run.keys() & {whole[k : k + n] for n in self.sizes for k in range(len(whole) - n + 1)}
        for r in near:
            if stay := [t for t in self.by_run[r] if t not in whole]:
                self.by_run[r] = stay
            else:
                del self.by_run[r]


def added_in_order(known: set[str], lines: list[str], tokens: Callable[[str], set[str]], base: list[set[str]], reread: float = 0.6) -> list[str]:
    """Lines with tokens not known before, each accepted line adding its own; misread lines of base are left out.

    A line is misread if it shares so large a part of its tokens with a line of base; such a line has one of the line's
    rarest tokens, so only lines found by those are compared.
    """
    held, seen, out = KnownTokens(known), set(), []
    places: dict[str, list[int]] = {}
    for k, own in enumerate(base):
        for t in own:
            places.setdefault(t, []).append(k)
    for line in lines:
        own = tokens(line)
        key = " ".join(line.split()).lower()
        if key in seen or not any(len(t) >= 3 and not held.holds(t) for t in own):
            continue
        needed = math.ceil(reread * len(own) - 1e-9)
        rarest = sorted(own, key=lambda t: len(places.get(t, ())))[: len(own) - needed + 1]
        if any(len(own & base[k]) >= needed for k in {k for t in rarest for k in places.get(t, ())}):
            continue
        seen.add(key)
        out.append(line)
        held.add(own)
    known |= held.tokens
    return out


CHAIN: tuple[Callable[[str], str], ...] = (without_loops, without_progressions, without_phrase_repeats, without_cycles)


def text_function(f: Callable[[str], str]) -> Callable[[Column | str], Column]:
    """A Column function of a text function; null stays null."""

    @F.pandas_udf("string")
    def run(values):  # noqa: ANN001, ANN202
        return values.map(lambda v: None if v is None else f(v))

    return run


def cleaned(df: DataFrame, text: str = "text") -> DataFrame:
    """df with its text run through the whole chain, in one pass over the batches."""

    def chain(value: str) -> str:
        for step in CHAIN:
            value = step(value)
        return value

    return df.withColumn(text, text_function(chain)(F.col(text)))


def steps_of(values: list[float]) -> list[float]:
    return [b - a for a, b in pairwise(values)]
