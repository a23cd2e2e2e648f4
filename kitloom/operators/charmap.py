"""Repair of texts whose font maps characters to wrong ones: a substitution solved like a crossword.

A broken word of which exactly one known word has its length and its known letters votes for each of its open letters.
The mapping is small, the word tables are not: they stay distributed, only votes come back, one row per pair of characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROUNDS = 12
MIN_VOCABULARY = 40
BROKEN = "[^A-Za-zА-Яа-яЁё]"


def word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    w = F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}{3,})"), 1))
    return df.filter(F.col(text).isNotNull()).select(w.alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def votes(broken: DataFrame, known: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """(broken_char, char, n, longest) of words with a single fitting known word."""
    decoded = F.translate("word", "".join(mapping), "".join(mapping.values())) if mapping else F.col("word")
    masked = broken.select(F.col("word").alias("raw"), decoded.alias("seen")).withColumn("len", F.length("seen")).withColumn("mask", F.regexp_replace("seen", BROKEN, "."))
    letters = F.filter(F.transform(F.split("mask", ""), lambda c, i: F.struct((i + 1).alias("at"), c.alias("letter"))), lambda x: x["letter"] != ".")
    anchored = masked.withColumn("known", letters).filter(F.size("known") > 0).withColumn("n_known", F.size("known")).withColumn("a", F.element_at("known", 1)).withColumn("b", F.element_at("known", -1))
    words = known.select(F.col("word").alias("target"), F.length("word").alias("len"))
    spots = words.withColumn("each", F.transform(F.split("target", ""), lambda c, i: F.struct((i + 1).alias("at"), c.alias("letter"))))
    one, ends = spots.select("target", "len", F.explode("each").alias("a"), "each"), ["len", "a", "b"]
    # one known letter: what counts is how many words have it at its place
    single_owner = one.groupBy("len", "a").agg(F.count("*").alias("n"), F.min("target").alias("target"))
    lone = anchored.filter("n_known = 1").join(single_owner, ["len", "a"]).select("raw", "seen", "n", "target")
    # more: words meet on the first and the last of them, as many letters apart; with two that is all
    two = one.select("target", "len", "a", F.explode(F.expr("filter(each, x -> x.at > a.at)")).alias("b"))
    pair_owner = two.groupBy(*ends).agg(F.count("*").alias("n"), F.min("target").alias("target"))
    pair = anchored.filter("n_known = 2").join(pair_owner, ends).select("raw", "seen", "n", "target")
    wanted = anchored.filter("n_known > 2")
    fits = wanted.join(two.join(wanted.select(*ends).distinct(), ends, "left_semi"), ends).filter(F.rlike("target", F.concat(F.lit("^"), F.col("mask"), F.lit("$"))))
    many = fits.groupBy("raw", "seen").agg(F.count("*").alias("n"), F.min("target").alias("target"))
    single = lone.unionByName(pair).unionByName(many.select("raw", "seen", "n", "target")).filter("n = 1")
    pairs = single.select("raw", F.explode(F.zip_with(F.split("seen", ""), F.split("target", ""), lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p")).filter(F.col("p.a").rlike(f"^{BROKEN}$"))
    return pairs.groupBy(F.col("p.a").alias("broken_char"), F.col("p.b").alias("char")).agg(F.count("*").alias("n"), F.max(F.length("raw")).alias("longest"))


def build_mapping(broken: DataFrame, known: DataFrame, rounds: int = ROUNDS) -> dict[str, str]:
    """Broken character -> character; a pair needs two witness words or one of six letters, and twice the other votes."""
    if known.limit(MIN_VOCABULARY).count() < MIN_VOCABULARY:
        return {}
    mapping: dict[str, str] = {}
    for _ in range(rounds):
        found: dict[str, list[tuple[int, int, str]]] = {}
        for r in votes(broken, known, mapping).collect():
            found.setdefault(r["broken_char"], []).append((r["n"], r["longest"], r["char"]))
        new = {}
        for c, options in sorted(found.items()):
            options.sort(reverse=True)
            n, longest, target = options[0]
            others = sum(o[0] for o in options[1:])
            if c not in mapping and target not in mapping.values() and target not in new.values() and (n >= 2 or longest >= 6) and n >= 2 * others:
                new[c] = target
        if not new:
            break
        mapping |= new
    return mapping


def shifts(broken: DataFrame, known: DataFrame, min_votes: int = 3) -> DataFrame:
    """(delta, n, low, high): constant code-point distances between broken words and known words of their length."""
    a = broken.select(F.col("word").alias("raw"), F.length("word").alias("len")).filter(F.col("raw").rlike(f"^{BROKEN}+$"))
    b = known.select(F.col("word").alias("target"), F.length("word").alias("len"))
    # the first letter's delta must hold for all letters: words meet on length and on differences of neighbours
    steps = lambda c: F.array_join(F.transform(F.sequence(F.lit(2), F.length(c)), lambda i: (F.ascii(F.substring(c, i, F.lit(1))) - F.ascii(F.substring(c, i - 1, F.lit(1)))).cast("string")), ",")
    hit = a.withColumn("shape", steps(F.col("raw"))).join(b.withColumn("shape", steps(F.col("target"))), ["len", "shape"])
    first = lambda c: F.ascii(F.substring(c, 1, 1))
    return hit.groupBy((first(F.col("target")) - first(F.col("raw"))).alias("delta")).agg(F.count("*").alias("n"), F.min(first(F.col("raw"))).alias("low"), F.max(first(F.col("raw"))).alias("high")).filter(F.col("n") >= min_votes)


# When a font's shift counts: letters of a lone witness, and weights of known words and numbers.
LONE_LETTERS, WORD_WEIGHT, NUMBER_WEIGHT, FONT_SHIFTS = 12, 3, 1, range(1, 96)


def font_tokens(spans: DataFrame, font: str = "font", text: str = "text") -> DataFrame:
    """(font, token, n): tokens of each font's spans."""
    token = F.explode(F.filter(F.split(F.col(text), r"\s+"), lambda t: t != "")).alias("token")
    return spans.filter(F.col(font).isNotNull() & F.col(text).isNotNull()).select(F.col(font).alias("font"), token).groupBy("font", "token").agg(F.count("*").alias("n"))


def shifted_word(c: Column, shift: Column) -> Column:
    """A word of the basic plane with every code point moved by shift."""
    codes = F.transform(F.split(c, ""), lambda x: F.lpad(F.hex((F.ascii(x) + shift).cast("bigint")), 4, "0"))
    return F.decode(F.unhex(F.array_join(codes, "")), "UTF-16BE")


def font_shifts(broken: DataFrame, known: DataFrame, shifts: range = FONT_SHIFTS) -> DataFrame:
    """(font, shift, weight, witnesses): the shift of code points that makes a font's broken tokens words or numbers.

    broken: font, token; known: word. A shift needs two witnesses or one long one, and twice the weight of the next best.
    The shifts are few, so a token meets them as rows of its own; words are met by an equi-join.
    """
    moved = broken.select("font", "token").distinct().withColumn("shift", F.explode(F.array(*map(F.lit, shifts)))).withColumn("word", F.lower(shifted_word(F.col("token"), F.col("shift"))))
    words = known.select(F.lower("word").alias("word"), F.lit(True).alias("is_word")).distinct()
    weighed = moved.join(words, "word", "left").withColumn("weight", F.when(F.col("is_word"), WORD_WEIGHT).when(F.col("word").rlike("^[0-9]+([.,][0-9]+)?$"), NUMBER_WEIGHT))
    votes_ = weighed.filter("weight is not null").groupBy("font", "shift").agg(F.sum("weight").alias("weight"), F.count("*").alias("witnesses"), F.max(F.length("token")).alias("longest"))
    order = Window.partitionBy("font").orderBy(F.desc("weight"), "shift")
    ranked = votes_.withColumn("place", F.row_number().over(order)).withColumn("next", F.coalesce(F.lead("weight").over(order), F.lit(0)))
    sure = (F.col("place") == 1) & ((F.col("witnesses") >= 2) | (F.col("longest") >= LONE_LETTERS)) & (F.col("weight") >= 2 * F.col("next"))
    return ranked.filter(sure).select("font", "shift", "weight", "witnesses")


def glyph_codes(glyphs: DataFrame, known: DataFrame) -> DataFrame:
    """(font, code, char): codes of a font whose outline occurs with a single character elsewhere; glyphs: font, code, outline; known: outline, char."""
    single = known.filter("outline is not null").groupBy("outline").agg(F.min("char").alias("char"), (F.min("char") == F.max("char")).alias("one")).filter("one")
    found = glyphs.filter("outline is not null").join(single.select("outline", "char"), "outline").groupBy("font", "code").agg(F.min("char").alias("char"), (F.min("char") == F.max("char")).alias("one"))
    return found.filter("one").select("font", "code", "char")


def coverage(df: DataFrame, mapping: dict[str, str], keys: list[str], text: str = "text") -> DataFrame:
    """Broken characters per key and how many of them the mapping knows."""
    broken = F.regexp_count(F.col(text), F.lit("[^ -~А-Яа-яЁё№²³Ø×«»–\n\r\t]"))
    fixed = F.translate(F.col(text), "".join(mapping), "".join(mapping.values())) if mapping else F.col(text)
    left = F.regexp_count(fixed, F.lit("[^ -~А-Яа-яЁё№²³Ø×«»–\n\r\t]"))
    return df.groupBy(*keys).agg(F.sum(broken).alias("broken"), F.sum(broken - left).alias("recovered"))
