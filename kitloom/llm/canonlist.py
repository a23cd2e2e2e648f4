"""Mapping freely typed values to the entries of a reference list.

Every entry of the list is an object and a state. A multi-pattern automaton over the canonical names, their
transliterations and their abbreviations finds mentions embedded in a value; the longest mentions that do not overlap win.
A value in which the automaton finds exactly one object and one state is mapped at once. The others go to token-set
similarity: every token of the object must have its own token in the value, equal, abbreviated or within an edit distance
that grows with its length, and so must the state; the entry with the smallest distance wins, and equally small distances
to several entries mean no match. Only objects can win whose tokens are all near some token of the value; an index finds
them: the list's tokens by their beginnings and by the deletions of their beginnings, objects by their rarest token.

A list of at most `block_entries` entries is sent to the workers. A larger one is cut into blocks by object; distinct
values meet every block, each block gives its mentions and its two best objects, and the value is decided from all of
them, so the result is that of the whole list.

Defined cases: null and empty values match nothing; a null label is replaced by the vote of its variants, ties going to
the smaller reference id; several rows of one id give one row, of the latest matched one; a list with two equal labels
uses the smaller id; an empty list matches nothing; other input columns are ignored.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Entries of a list that are searched together, and values that meet a block in one call.
BLOCK_ENTRIES, VALUES_PER_CALL = 20_000, 50_000
#: Deletions are taken from the first so many letters.
BEGINNING = 7
IGNORED = frozenset("в из на и с к по".split()) | frozenset("v iz na i s k po".split())
TOKEN = re.compile(r"[^\W_]+\.?")
# Transliteration of Russian letters.
LATIN = dict(zip("абвгдезийклмнопрстуфхцыэ", "a b v g d e z i y k l m n o p r s t u f h c y e".split(), strict=True)) | {"ж": "zh", "ч": "ch", "ш": "sh", "щ": "sch", "ю": "yu", "я": "ya", "ъ": "", "ь": "", "ё": "e"}


@dataclass(frozen=True)
class Terms:
    """What is known of a list besides its entries. The defaults are the states of the problem and usual abbreviations."""

    # States of a sign by the stems that name them, their short forms and endings; a word no rule shortens.
    stems: Mapping[str, str] = field(default_factory=lambda: {"designed": "проектируем", "existing": "существующ", "demolished": "демонтируем"})
    short: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"designed": ("проект", "проектир"), "existing": ("сущ", "существ"), "demolished": ("демонт", "дем")})
    endings: tuple[str, ...] = ("ый", "ая", "ое", "ые", "ий", "ее", "ие")
    aliases: Mapping[str, tuple[str, ...]] = field(default_factory=lambda: {"железобетонный": ("ж б", "жб")})

    def words(self, state: str) -> list[str]:
        return [*(self.stems[state] + e for e in self.endings), *self.short[state]]


TERMS = Terms()


def transliterated(text: str) -> str:
    return "".join(LATIN.get(c, c) for c in text)


def folded(text: str) -> str:
    return text.lower().replace("ё", "е")


def tokens(text: str) -> list[tuple[str, bool]]:
    """Folded tokens and whether a full stop marks each as an abbreviation."""
    return [(t.rstrip("."), t.endswith(".")) for t in TOKEN.findall(folded(text))]


def distance(a: str, b: str, most: int) -> int:
    """Edit distance with transpositions, most + 1 if it is larger."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        before, last = last, row
    return min(last[-1], most + 1)


def allowed(length: int) -> int:
    return 0 if length < 3 else 1 if length < 6 else 2 if length < 10 else 3


def deletions(word: str, most: int) -> set[str]:
    """The word's beginning with up to `most` letters left out: two words within that distance share one."""
    word = word[:BEGINNING]
    return {"".join(word[i] for i in kept) for n in range(max(0, len(word) - most), len(word) + 1) for kept in combinations(range(len(word)), n)}


def parsed(entries: Iterable[tuple[int, str]], terms: Terms = TERMS) -> list[tuple[tuple[str, ...], str, int]]:
    """(object, state, id) of labels; of equal ones the smaller id."""
    ids: dict[tuple[tuple[str, ...], str], int] = {}
    for ref, label in entries:
        found = [t for t, _ in tokens(label)]
        states = [s for s, stem in terms.stems.items() if any(t.startswith(stem) for t in found)]
        state = states[0] if len(states) == 1 else ""
        rest = tuple(t for t in found if not (state and t.startswith(terms.stems[state])))
        ids[rest, state] = min(ref, ids.get((rest, state), ref))
    return [(o, s, ref) for (o, s), ref in ids.items()]


#: What a block says of a value: mentions (start, end, object, ids by state), the two best objects (score, object, id).
Evidence = tuple[list[tuple[int, int, str, dict[str, int]]], list[tuple[int, str, int | None]]]


class SignMatcher:
    """Automaton, token sets and their index of a list, or of a block of one."""

    def __init__(self, entries: list[tuple[tuple[str, ...], str, int]], terms: Terms = TERMS) -> None:
        self.terms = terms
        self.ids: dict[str, dict[str, int]] = defaultdict(dict)
        for o, state, ref in entries:
            self.ids[" ".join(o)][state] = ref
        self.objects = {name: [t for t in name.split() if t not in IGNORED] for name in sorted(self.ids)}
        # a run of words may be written as its initials, where the list has one such run
        runs: dict[str, set[str]] = defaultdict(set)
        for name in self.objects:
            words = name.split()
            for k in range(len(words)):
                for n in (2, 3):
                    if len(part := words[k : k + n]) == n and not IGNORED & set(part):
                        runs["".join(w[0] for w in part)].add(" ".join(part))
        self.phrases = {short: phrase for phrase, shorts in terms.aliases.items() for short in shorts}
        self.phrases |= {short: next(iter(phrases)) for short, phrases in runs.items() if len(phrases) == 1 and short not in self.phrases}
        self.phrases |= {transliterated(short): phrase for short, phrase in self.phrases.items()}
        self.state_words = [(state, w) for state in terms.stems for word in terms.words(state) for w in (word, transliterated(word))]
        patterns: dict[str, set[tuple[str, str]]] = defaultdict(set)
        shorter = defaultdict(list)
        for short, phrase in self.phrases.items():
            shorter[phrase.split()[0]].append((phrase, short))
        for name in self.objects:
            names = [name, transliterated(name)]
            for word in name.split():
                names += [f" {name} ".replace(f" {phrase} ", f" {short} ").strip() for phrase, short in shorter[word] if phrase != name and f" {phrase} " in f" {name} "]
            for n in names:
                patterns[n].add(("object", name))
        for state, word in self.state_words:
            patterns[word].add(("state", state))
        self.automaton = ahocorasick.Automaton()
        for pattern, meant in patterns.items():
            if len(meant) == 1 and pattern:
                self.automaton.add_word(f" {pattern} ", (len(pattern) + 2, *next(iter(meant))))
        if len(self.automaton):
            self.automaton.make_automaton()
        # the index: spellings in order, by deletions, by their beginnings' deletions; objects by their rarest token
        uses = Counter(t for wanted in self.objects.values() for t in set(wanted))
        self.by_token: dict[str, list[str]] = defaultdict(list)
        for name, wanted in self.objects.items():
            if wanted:
                self.by_token[min(wanted, key=lambda t: (uses[t], t))].append(name)
        self.spelled: dict[str, set[str]] = defaultdict(set)
        for t in uses:
            for s in {t, transliterated(t)}:
                self.spelled[s].add(t)
        self.ordered = sorted(self.spelled)
        self.deleted: dict[str, set[str]] = defaultdict(set)
        for s in self.ordered:
            for d in deletions(s, allowed(len(s))):
                self.deleted[d].add(s)
        self.begun: dict[int, dict[str, set[str]]] = {}
        self.states = SignMatcher([], terms) if entries else self
        self.find = lru_cache(maxsize=1 << 17)(lambda value: decided(value, [self.evidence(value)], self.states))
        self.near = lru_cache(maxsize=1 << 18)(self._near)
        self.close = lru_cache(maxsize=1 << 17)(self._close)

    def mentions(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, meaning) of all patterns in the text's tokens."""
        if not len(self.automaton):
            return []
        single = " " + " ".join(t for t, _ in tokens(text)) + " "
        return [(end - size + 1, end, kind, value) for end, (size, kind, value) in self.automaton.iter(single)]

    def _near(self, token: str, dotted: bool, wanted: str) -> int | None:
        """Cost of token for wanted: 0 equal, 1 abbreviated, else the edit distance if it is allowed."""
        if token == wanted:
            return 0
        if (dotted and len(token) >= 2 or 3 <= len(token) <= 5) and len(token) < len(wanted) and wanted.startswith(token):
            return 1
        if dotted and len(token) >= 3 and distance(token, wanted[: len(token)], 1) <= 1 and len(wanted) > len(token) + 1:
            return 2
        most = allowed(min(len(token), len(wanted)))
        d = distance(token, wanted, most)
        return d if d <= most else None

    def _close(self, token: str, dotted: bool) -> dict[str, int]:
        """The list's tokens that this one can stand for, and the cost of each."""
        asked: set[str] = set()
        if dotted and len(token) >= 2 or 3 <= len(token) <= 5:
            k = bisect_left(self.ordered, token)
            while k < len(self.ordered) and self.ordered[k].startswith(token):
                asked.add(self.ordered[k])
                k += 1
        if dotted and len(token) >= 3:
            if len(token) not in self.begun:
                own = self.begun[len(token)] = defaultdict(set)
                for s in self.ordered:
                    if len(s) > len(token) + 1:
                        for d in deletions(s[: len(token)], 1):
                            own[d].add(s)
            for d in deletions(token, 1):
                asked |= self.begun[len(token)].get(d, set())
        for d in deletions(token, allowed(len(token))):
            asked |= self.deleted.get(d, set())
        out: dict[str, int] = {}
        for s in asked:
            if (c := self.near(token, dotted, s)) is not None:
                for t in self.spelled[s]:
                    out[t] = min(c, out.get(t, c))
        return out

    def _cover(self, costs: list[dict[str, int]], wanted: list[str]) -> tuple[int, set[int]] | None:
        cost, used = 0, set()
        for w in sorted(wanted, key=len, reverse=True):
            best = min(((c[w], i) for i, c in enumerate(costs) if i not in used and w in c), default=None)
            if best is None:
                return None
            cost += best[0]
            used.add(best[1])
        return cost, used

    def _state(self, found: list[tuple[str, bool]], used: set[int]) -> list[tuple[int, str]]:
        """Cost and state for the states that the remaining tokens can mean."""
        best: dict[str, int] = {}
        for i, (t, dot) in enumerate(found):
            if i not in used:
                for state, w in self.state_words:
                    if (c := self.near(t, dot and len(w) < 9, w)) is not None:
                        best[state] = min(c, best.get(state, c))
        return sorted((c, s) for s, c in best.items())

    def evidence(self, value: str) -> Evidence:
        hits = [(start, end, name, self.ids[name]) for start, end, kind, name in self.mentions(value) if kind == "object"]
        found = [(t, dot) for t, dot in tokens(value) if t not in IGNORED]
        # abbreviated phrases may stand for their words
        words: list[tuple[str, bool]] = []
        k = 0
        while k < len(found):
            pair = " ".join(t for t, _ in found[k : k + 2])
            short = pair if pair in self.phrases else found[k][0]
            words += [(t, False) for t in self.phrases[short].split()] if short in self.phrases else [found[k]]
            k += 2 if short == pair and " " in pair else 1
        best: dict[str, tuple[int, str, int | None]] = {}
        for reading in (found, words) if words != found else (found,):
            for one in self._scored(reading):
                best[one[1]] = min(one, best.get(one[1], one), key=lambda b: (b[0], b[2] is None))
        return hits, sorted(best.values(), key=lambda b: b[:2])[:2]

    def _scored(self, words: list[tuple[str, bool]]) -> list[tuple[int, str, int | None]]:
        """The two best objects by token sets (score, object, id)."""
        costs = [self.close(t, dot) for t, dot in words]
        near = set().union(*costs) if costs else set()
        scored = []
        for name in {n for t in near for n in self.by_token.get(t, ())}:
            wanted = self.objects[name]
            if near.issuperset(wanted) and (covered := self._cover(costs, wanted)) is not None:
                scored.append((covered[0] - 100 * len(covered[1]), name, covered[1]))
        scored.sort(key=lambda s: s[:2])
        best = []
        for score, name, used in scored[:2]:
            options = self._state(words, used)
            clear = options and not (len(options) > 1 and options[1][0] == options[0][0])
            best.append((score, name, self.ids[name].get(options[0][1]) if clear else None))
        return best


def decided(value: str, evidence: list[Evidence], states: SignMatcher) -> int | None:
    """The entry of a value by what all blocks say of it; states: a matcher of no entries, for the states in the value."""
    every = [(start, end, "object", (name, tuple(sorted(ids.items())))) for hits, _ in evidence for start, end, name, ids in hits]
    every += [(start, end, kind, (meant, ())) for start, end, kind, meant in states.mentions(value)]
    taken: list[tuple[int, int]] = []
    meant: dict[str, set] = {"object": set(), "state": set()}
    for start, end, kind, what in sorted(every, key=lambda h: (h[0] - h[1], h[0], h[2], h[3])):
        # longest first; mentions that do not overlap, but for the space between two
        if not any(start < e and s < end for s, e in taken):
            taken.append((start, end))
            meant[kind].add(what)
    if len(meant["object"]) == 1 and len(meant["state"]) == 1:
        ((_, ids),), ((state, _),) = meant["object"], meant["state"]
        return dict(ids).get(state)
    best = sorted((tuple(b) for _, scored in evidence for b in scored), key=lambda b: b[:2])
    if not best or len(best) > 1 and best[1][0] == best[0][0]:
        return None
    return best[0][2]


def _decided_in_blocks(values: DataFrame, listed: DataFrame, n_listed: int, block_entries: int, terms: Terms) -> DataFrame:
    """(value, ref_id) of distinct values, for a list of any size."""
    blocks = -(-n_listed // block_entries)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = parsed(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), terms)
            yield pa.RecordBatch.from_arrays([pa.array([" ".join(o) for o, *_ in rows], pa.string()), pa.array([s for _, s, _ in rows], pa.string()), pa.array([r for *_, r in rows], pa.int32())], names=["object", "state", "ref_id"])

    entries = listed.mapInArrow(parse, "object string, state string, ref_id int").groupBy("object", "state").agg(F.min("ref_id").alias("ref_id"))
    entries = cut_lineage(entries.withColumn("block", F.pmod(F.xxhash64("object"), F.lit(blocks)).cast("int")))
    values = cut_lineage(values)
    lanes = max(1, -(-values.count() // VALUES_PER_CALL))
    lane = F.pmod(F.xxhash64("value"), F.lit(lanes)).cast("int")
    asked = values.withColumn("lane", lane).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    copies = entries.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))

    def judge(own: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        matcher = SignMatcher([(tuple(o.split()), s, int(r)) for o, s, r in zip(block["object"], block["state"], block["ref_id"], strict=True)], terms)
        return pd.DataFrame({"value": own["value"], "said": [json.dumps(matcher.evidence(v)) for v in own["value"]]})

    said = asked.groupBy("block", "lane").cogroup(copies.groupBy("block", "lane")).applyInPandas(judge, "value string, said string")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = SignMatcher([], terms)
        for batch in batches:
            out = [decided(v, [json.loads(s) for s in each], states) for v, each in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int32())], names=["value", "ref_id"])

    return said.groupBy("value").agg(F.collect_list("said").alias("said")).mapInArrow(decide, "value string, ref_id int")


def _vote(own: str | None, own_ref: int | None, refs: Iterable[int | None]) -> int | None:
    if own is not None:
        return own_ref
    votes = Counter(r for r in refs if r is not None)
    return min(votes, key=lambda r: (-votes[r], r)) if votes else None


def matched_labels(entries: DataFrame, reference: DataFrame, *, key: str = "id", label: str = "label", variants: str = "label_variants", at: str = "loaded_at", block_entries: int = BLOCK_ENTRIES, terms: Terms = TERMS) -> DataFrame:
    """(legend_id, ref_id) with ref_id null for values that match nothing; one row per id."""
    kind = entries.schema[key].dataType.simpleString()
    listed = reference.select(F.col("ref_id").cast("int").alias("ref_id"), F.col("label").alias("label")).filter("ref_id is not null and label is not null")
    rows = entries.select(F.col(key).alias("legend_id"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(label).alias("label"), F.col(variants).alias("variants")).filter("legend_id is not null")
    n_listed = listed.count()
    if n_listed <= block_entries:
        shared = entries.sparkSession.sparkContext.broadcast(parsed([(r["ref_id"], r["label"]) for r in listed.collect()], terms))

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            find = SignMatcher(shared.value, terms).find
            for batch in batches:
                out = [_vote(own, find(own) if own is not None else None, (find(v) for v in others or () if v is not None) if own is None else ()) for own, others in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int32())], names=["legend_id", "at", "ref_id"])

        found = rows.mapInArrow(match, f"legend_id {kind}, at bigint, ref_id int")
    else:
        # the values of a row: its label or, if null, its variants
        meant = F.when(F.col("label").isNotNull(), F.array("label")).otherwise(F.coalesce("variants", F.array().cast("array<string>")))
        each = cut_lineage(rows.select("legend_id", "at", F.explode_outer(meant).alias("value")))
        refs = _decided_in_blocks(each.select("value").filter("value is not null").distinct(), listed, n_listed, block_entries, terms)
        votes = each.join(refs, "value", "left").groupBy("legend_id", "at", "ref_id").agg(F.count("*").alias("n"))
        voted = F.max(F.when(F.col("ref_id").isNotNull(), F.struct("n", (-F.col("ref_id")).alias("r"))))
        found = votes.groupBy("legend_id", "at").agg(voted.alias("v")).select("legend_id", "at", (-F.col("v.r")).alias("ref_id"))
    return found.groupBy("legend_id").agg(F.max(F.struct(F.col("ref_id").isNotNull().alias("ok"), "at", (-F.col("ref_id")).alias("r"))).alias("m")).select("legend_id", (-F.col("m.r")).alias("ref_id"))
