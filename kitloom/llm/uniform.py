"""One consistent form for texts that look alike.

Compatibility variants become ordinary characters, ignorable ones are deleted, accents are composed, spaces and hyphens
become plain. What is left are look-alike letters: every word is a lattice of all letters, of both alphabets, that each of
its characters looks like. Viterbi searches it: a path with fewer changes of alphabet is better, and of these one with a
better score by the character pairs counted over the corpus, where a pair counts within one alphabet only. So the scores
decide between letters of one alphabet that look alike (a Greek υ may be y, u or v) and where a word that needs both
alphabets changes. Between a wholly Cyrillic and a wholly Latin path the Cyrillic one is taken.

Defined cases: null stays null and empty stays empty; signs that are ordinary in the texts (№, ², ³, Ø, ×, «, », –) stay;
digits belong to their word and stay; words without letters stay; repeated rows are treated alike.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import encodings
from .batches import larger
from .charmodel import EDGE, PLAIN_CLASS

# Letters that look alike, Latin and Cyrillic; then Greek and other letters with their Latin look.
PAIRS = dict(zip("ABCEHKMOPTXYaceopxyëË", "АВСЕНКМОРТХУасеорхуёЁ", strict=True))
OTHER_LOOKS = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορνυχικЅІЈѕіјһԁԛԝԌӀӏɑɡ", "ABEZHIKMNOPTYXaopvyxikSIJsijhdqwGIlag", strict=True))
# Latin letters that some of these look like as well.
MORE_LOOKS = {"υ": "uv", "ν": "u", "Ι": "l", "І": "l", "Ӏ": "l", "ӏ": "I", "ι": "l"}
# Signs that compatibility normalization must not touch, and hyphens.
ORDINARY_SIGNS = frozenset("№²³Ø×«»–")
HYPHENS = frozenset("\u2010\u2011\u2012\u2212\ufe63\uff0d")
WORD = re.compile(r"[^\W_]+")
#: Nothing to choose: plain signs, digits and Russian letters only.
SINGLE_PATH = re.compile(f"[{PLAIN_CLASS}]*")
NOT_RUSSIAN = re.compile("[^А-Яа-яЁё0-9]")
CHANGE_LETTER = -1.0


class _Compat(dict):
    """Translation table of single characters, filled as characters come up."""

    def __missing__(self, code: int) -> int | str | None:
        c = chr(code)
        kind = unicodedata.category(c)
        if c in ORDINARY_SIGNS or c < "\x80":
            out: int | str | None = code
        elif kind == "Cf" or c in "\u034f\u115f\u1160\u3164" or "\ufe00" <= c <= "\ufe0f":
            out = None
        elif kind == "Zs":
            out = " "
        elif c in HYPHENS:
            out = "-"
        else:
            plain = unicodedata.normalize("NFKC", c)
            out = plain if plain and not plain.startswith(" ") else code
        self[code] = out
        return out


_COMPAT = _Compat()


def compatible(text: str) -> str:
    """Ordinary-width composed characters without ignorable ones, look-alike letters untouched."""
    return unicodedata.normalize("NFC", text.translate(_COMPAT))


def script(letter: str) -> str:
    return "c" if "Ѐ" <= letter <= "ԯ" else "l" if letter.isalpha() else ""


def looks(letter: str) -> list[tuple[str, str]]:
    """(alphabet, letter) of all that one may stand for; no alphabet for what is no letter."""
    latin = OTHER_LOOKS.get(letter, letter)
    more = [("l", x) for x in MORE_LOOKS.get(letter, "")]
    if latin in PAIRS:
        return [("c", PAIRS[latin]), ("l", latin), *more]
    if letter in _CYRILLIC_LOOKS:
        return [("c", letter), ("l", _CYRILLIC_LOOKS[letter])]
    if latin != letter:
        return [("l", latin), *more]
    return [(script(letter), letter)]


_CYRILLIC_LOOKS = {c: a for a, c in PAIRS.items()}


class WordForm:
    """Best spelling of a word by the lattice of its letters' looks."""

    def __init__(self, pairs: list[tuple[int, int, int]]) -> None:
        before: dict[str, int] = {}
        for a, _, n in pairs:
            before[chr(a)] = before.get(chr(a), 0) + n
        total = max(1, sum(before.values()))
        self.score = {(chr(a), chr(b)): log((n + 0.1) / (before[chr(a)] + 100)) for a, b, n in pairs}
        self.unseen = log(0.1 / (total + 100))
        self.best = lru_cache(maxsize=1 << 17)(self._best)

    def _best(self, word: str) -> str:
        # the state is the alphabet of the last letter with the last sign; its value the changes, then the score
        paths = {("", EDGE): (0, 0.0, "")}
        for c in word:
            new: dict[tuple[str, str], tuple[int, float, str]] = {}
            for alphabet, letter in looks(c):
                kept = 0.0 if letter == c else CHANGE_LETTER
                for (last, before), (changes, score, text) in paths.items():
                    turn = alphabet != "" and last != "" and alphabet != last
                    pair = self.unseen if turn else self.score.get((before, letter), self.unseen)
                    way = (changes - turn, score + kept + pair, text + letter)
                    at = (alphabet or last, letter)
                    if at not in new or way > new[at]:
                        new[at] = way
            paths = new
        end = max(((changes, changes == 0 and alphabet == "c", score + self.score.get((letter, " "), self.unseen), text) for (alphabet, letter), (changes, score, text) in paths.items()))
        return end[3]

    def text(self, text: str) -> str:
        """The consistent form of a text."""
        if SINGLE_PATH.fullmatch(text):
            return text
        return WORD.sub(lambda m: self.best(m[0]) if NOT_RUSSIAN.search(m[0]) else m[0], compatible(text))


_forms: dict[int, WordForm] = {}


def word_form(pairs: list[tuple[int, int, int]]) -> WordForm:
    key = hash(tuple(pairs))
    if key not in _forms:
        _forms.clear()
        _forms[key] = WordForm(pairs)
    return _forms[key]


def uniform_texts(df: DataFrame, pairs: list[tuple[int, int, int]], *, text: str = "text", out: str = "uniform") -> DataFrame:
    """df with the consistent form of a text column added."""

    shared = df.sparkSession.sparkContext.broadcast(pairs)

    @F.pandas_udf("string")
    def form(values):  # noqa: ANN001, ANN202
        words = word_form(shared.value)
        return values.map(lambda v: None if v is None else words.text(v))

    return df.withColumn(out, form(F.col(text)))


def inconsistent_records(records: DataFrame, pairs: list[tuple[int, int, int]], *, garbled_tables: tuple[str, ...] = ()) -> DataFrame:
    """Of records (table_name, record_id, text) those that are not in the consistent form, with that form.

    Records of garbled_tables whose text is garbled are not counted: their characters are those of a wrong decoding.
    """

    shared = records.sparkSession.sparkContext.broadcast(pairs)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = word_form(shared.value), encodings.built(shared.value) if garbled_tables else None
        for batch in larger(batches):
            names, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            changed = [(i, u) for i, t in enumerate(texts) if (u := words.text(t)) != t]
            if model and changed:
                garbled = model.spans([texts[i] if names[i] in garbled_tables else "" for i, _ in changed])
                changed = [c for k, c in enumerate(changed) if k not in garbled]
            rows = pa.array([i for i, _ in changed], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows), batch.column(2).take(rows), pa.array([u for _, u in changed], pa.string())],
                names=["table_name", "record_id", "text", "uniform"],
            )

    asked = records.select("table_name", F.col("record_id").cast("string").alias("record_id"), "text").filter("text is not null and text <> ''")
    return asked.mapInArrow(check, "table_name string, record_id string, text string, uniform string")
