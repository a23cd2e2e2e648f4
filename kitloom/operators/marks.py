"""Reading what a mark on a drawing says: the letter and digit of an axis, the number of a size or level.

A mark's own attributes go first, then captions near it. Everything fails closed: two values of one kind, or captions equally
near that differ, leave the field empty with a note. Marks have unique ids; attributes are a map from tag to value.

Defined cases: null attributes and texts are none; marks without a place read no captions; a mark that is neither an axis nor
a size gives no row; other input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from .matching import greedy_claims

# Layers, tags, reasons and block names that tell marks, the notes, and how near (mm) a caption must be.
AXIS_LAYERS, AXIS_TAGS, AXIS_REASONS = ("osi",), ("ось",), ("axis-layer", "axis-attribute")
ROOM_REASONS, ROOM_BLOCK = ("room-number-block",), "номерация"
HEIGHT_REASONS, HEIGHT_BLOCK, LABEL_REASONS = ("height-mark-block",), "высоты", ("building-label-block",)
LEVEL_LAYERS, SIZE_LAYERS = ("otmetki",), ("razmer",)
LEVEL_TAGS, SIZE_TAGS, IGNORED_TAGS = ("отметка",), ("размер", "значение", "value", "длина"), ("в", "г", "вг", "гг", "прим")
NO_LETTER, NO_DIGIT, NO_AXIS, SEVERAL_TEXTS, UNSORTED = "буква не прочитана", "цифра не прочитана", "ось не прочитана", "несколько подписей рядом", "буква и цифра не разошлись по полям"
NO_LEVEL, NO_NUMBER, SEVERAL_NUMBERS = "отметка не прочитана", "число не прочитано", "несколько чисел рядом"
RADIUS, TIE = 8.0, 0.2


def _folded(c: Column) -> Column:
    return T.yo(F.lower(F.trim(F.coalesce(c, F.lit("")))))


def _tag(c: Column) -> Column:
    """A tag without its number in brackets and trailing quotes."""
    return F.regexp_replace(T.yo(F.lower(F.regexp_replace(F.regexp_replace(c, r"\([0-9]+\)$", ""), r"\s+", ""))), "[′'`’\"]+$", "")


def axis_value(c: Column) -> Column:
    """Struct kind (letter, digit) and value of a text that can name an axis, else null."""
    bare = F.trim(c)
    letter = F.translate(F.upper(bare), "Ё", "Е")
    return F.when(bare.rlike("^[0-9]{1,3}$"), F.struct(F.lit("digit").alias("kind"), bare.alias("value"))).when(letter.rlike("^[A-ZА-Я]{1,2}$"), F.struct(F.lit("letter").alias("kind"), letter.alias("value")))


def number_value(c: Column) -> Column:
    """A number without its unit, with a decimal point."""
    return F.trim(F.translate(F.regexp_replace(F.trim(c), r"(?iu)\s*мм$", ""), ",", "."))


def is_level(c: Column) -> Column:
    return F.coalesce(number_value(c).rlike(r"^[+-]?[0-9]+\.[0-9]{1,4}$"), F.lit(False))


def is_size(c: Column) -> Column:
    return F.coalesce(number_value(c).rlike(r"^[+-]?[0-9]{2,6}(\.[0-9]{1,3})?$") & ~c.rlike("[()]"), F.lit(False))


def is_axis_mark(layer: Column, reason: Column, block: Column, attributes: Column) -> Column:
    """An axis by its reason, layer or a tag; never the number of a room."""
    name, why = _folded(block), F.coalesce(reason, F.lit(""))
    room = why.isin(*ROOM_REASONS) | (name == ROOM_BLOCK) | name.startswith(f"{ROOM_BLOCK} ")
    tagged = F.exists(F.coalesce(F.map_keys(attributes), F.array().cast("array<string>")), lambda t: _tag(t).isin(*AXIS_TAGS))
    return ~room & (why.isin(*AXIS_REASONS) | _folded(layer).isin(*AXIS_LAYERS) | tagged)


def dimension_kind(layer: Column, reason: Column, block: Column) -> Column:
    """height, elevation or linear; null for what carries no number."""
    name, why = _folded(block), F.coalesce(reason, F.lit(""))
    high = why.isin(*HEIGHT_REASONS) | (name == HEIGHT_BLOCK) | name.startswith(f"{HEIGHT_BLOCK} ")
    other = F.when(high, "height").when(_folded(layer).isin(*LEVEL_LAYERS), "elevation").when(_folded(layer).isin(*SIZE_LAYERS), "linear")
    return F.when(~why.isin(*LABEL_REASONS), other)


def attribute_axis(attributes: Column) -> Column:
    """Struct letter, digit, note of an axis mark's attributes; what a value is decides, not its tag."""
    entries = F.filter(F.coalesce(F.map_entries(attributes), F.array().cast("array<struct<key:string,value:string>>")), lambda e: _tag(e["key"]).isin(*AXIS_TAGS))
    values = F.filter(F.transform(entries, lambda e: axis_value(e["value"])), lambda v: v.isNotNull())
    of = lambda kind: F.transform(F.filter(values, lambda v: v["kind"] == kind), lambda v: v["value"])
    letters, digits = of("letter"), of("digit")
    unsorted = (F.size(letters) > 1) | (F.size(digits) > 1)
    letter, digit = F.when(~unsorted, F.get(letters, 0)), F.when(~unsorted, F.get(digits, 0))
    lacks = F.concat_ws("; ", F.when(letter.isNull(), NO_LETTER), F.when(digit.isNull(), NO_DIGIT))
    note = F.when(unsorted, UNSORTED).when(letter.isNull() & digit.isNull(), NO_AXIS).otherwise(lacks)
    return F.struct(letter.alias("letter"), digit.alias("digit"), note.alias("note"))


def attribute_number(attributes: Column, kind: Column) -> Column:
    """Struct value, tag, note: the first attribute with a level, or a size where no level is asked for."""
    entries = F.filter(F.coalesce(F.map_entries(attributes), F.array().cast("array<struct<key:string,value:string>>")), lambda e: ~_tag(e["key"]).isin(*IGNORED_TAGS))
    level = lambda e: _tag(e["key"]).isin(*LEVEL_TAGS)
    fits = F.filter(entries, lambda e: (level(e) & is_level(e["value"])) | (_tag(e["key"]).isin(*SIZE_TAGS) & is_size(e["value"]) & (kind != "elevation")))
    empty = F.exists(entries, lambda e: level(e) & (F.trim(F.coalesce(e["value"], F.lit(""))) == ""))
    first = F.get(fits, 0)
    return F.struct(number_value(first["value"]).alias("value"), F.when(first.isNotNull(), first["key"]).when(empty, "ОТМЕТКА").alias("tag"), F.when(first.isNull() & empty, NO_LEVEL).otherwise("").alias("note"))


def _near(marks: DataFrame, texts: DataFrame, keys: list[str], name: str, radius: float) -> DataFrame:
    """(id, <name>, <name>_many): captions claimed by marks in order of their ids, and whether near ones contradict."""
    placed = marks.filter("x is not null and y is not null").select(*keys, "id", "x", "y")
    claims = greedy_claims(placed, texts, keys, left_id="id", right_id="text_id", value="value", radius=radius, tie=TIE)
    return claims.select("id", F.col("value").alias(name), (F.col("status") == "ambiguous").alias(f"{name}_many"))


def _captions(texts: DataFrame, keys: list[str], value: Column) -> DataFrame:
    return texts.filter("text is not null and x is not null and y is not null").select(*keys, "text_id", "x", "y", value.alias("value")).filter("value is not null")


def read_axes(marks: DataFrame, texts: DataFrame, keys: list[str], radius: float = RADIUS) -> DataFrame:
    """(keys, id, letter, digit, source, note) of axis marks.

    marks: keys, id, x, y, layer, reason, block_name, attributes; texts: keys, text_id, x, y, text.
    """
    own = marks.filter(is_axis_mark(F.col("layer"), F.col("reason"), F.col("block_name"), F.col("attributes"))).withColumn("a", attribute_axis(F.col("attributes")))
    value = axis_value(F.col("text"))
    out = own.select(*keys, "id", "a")
    for slot in ("letter", "digit"):
        asked = own.filter(F.col(f"a.{slot}").isNull())
        out = out.join(_near(asked, _captions(texts, keys, F.when(value["kind"] == slot, value["value"])), keys, f"t_{slot}", radius), "id", "left")
    letter, digit = F.coalesce("a.letter", "t_letter"), F.coalesce("a.digit", "t_digit")
    from_text, from_own = F.col("t_letter").isNotNull() | F.col("t_digit").isNotNull(), F.col("a.letter").isNotNull() | F.col("a.digit").isNotNull()
    source = F.when(from_text & from_own, "merged").when(from_text, "text").when(from_own, "attributes").otherwise("")
    many = F.when(F.coalesce("t_letter_many", F.lit(False)) | F.coalesce("t_digit_many", F.lit(False)), SEVERAL_TEXTS)
    note = F.when(letter.isNotNull() & digit.isNotNull(), "").when(letter.isNull() & digit.isNull(), F.coalesce(many, "a.note")).otherwise(F.concat_ws("; ", F.nullif("a.note", F.lit("")), many))
    return out.select(*keys, "id", F.coalesce(letter, F.lit("")).alias("letter"), F.coalesce(digit, F.lit("")).alias("digit"), source.alias("source"), note.alias("note"))


def read_dimensions(marks: DataFrame, texts: DataFrame, keys: list[str], radius: float = RADIUS) -> DataFrame:
    """(keys, id, kind, value, source, note) of marks that carry a number; inputs as of read_axes."""
    own = marks.withColumn("kind", dimension_kind(F.col("layer"), F.col("reason"), F.col("block_name"))).filter("kind is not null").withColumn("a", attribute_number(F.col("attributes"), F.col("kind")))
    out = own.select(*keys, "id", "kind", "a")
    text, asked = F.col("text"), own.filter("a.value is null")
    near = None
    for kind in ("elevation", "height", "linear"):
        fits = is_level(text) if kind == "elevation" else is_size(text) | is_level(text) if kind == "height" else is_size(text)
        part = _near(asked.filter(F.col("kind") == kind), _captions(texts, keys, F.when(fits, number_value(text))), keys, "t_value", radius)
        near = part if near is None else near.unionByName(part)
    out = out.join(near, "id", "left")
    value = F.coalesce("a.value", "t_value")
    note = F.when(value.isNotNull(), "").when(F.col("t_value_many"), SEVERAL_NUMBERS).otherwise(F.coalesce(F.nullif("a.note", F.lit("")), F.lit(NO_NUMBER)))
    source = F.when(F.col("a.value").isNotNull(), "attributes").when(F.col("t_value").isNotNull(), "text").otherwise("")
    return out.select(*keys, "id", "kind", F.coalesce(value, F.lit("")).alias("value"), source.alias("source"), note.alias("note"))
