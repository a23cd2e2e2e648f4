"""Scalar text functions as Column expressions; all of them run inside the JVM.

Null stays null unless a function says otherwise. Character classes are written out, since \\w and \\b differ between
engines for Cyrillic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "A-Za-zА-Яа-яЁё"
# Patterns of tokens, numbers and document codes.
TOKEN = f"[0-9]+(?:[.,][0-9]+)?|[{LETTERS}]{{2,}}(?:[-/][{LETTERS}0-9]+)*"
NUMBER = "[-−]?[0-9]+(?:[.,][0-9]+)?"
WORD = f"[{LETTERS}]{{3,}}"
CODE = f"[{LETTERS}]{{1,6}}[-–/]?[0-9]{{1,4}}(?:[./-][0-9]{{1,4}})*"
DOCUMENT_CODE = "^[A-Za-zА-Яа-яЁё0-9][A-Za-zА-Яа-яЁё0-9./-]{4,40}$"
# Ends of codes that mark a text part, and first words of frame captions.
TEXT_PART = r"(?iu)(\.пз|\.тч|\.пояснительная записка)$"
SERVICE_START = "^(формат|копировал|инв|взам|подпидата|чертил|масштаб)"
FACT = "|".join(("[0-9]{2}-[А-ЯA-Z]{2,4}-[0-9/]+(?:-[А-ЯA-Z0-9]+)?", "[∅ØøφΦ][ ]?[0-9]{1,4}(?:[х×][0-9]{1,3})?", "DN[ ]?[0-9]{1,4}", "[-+]?[0-9]{1,3}[.,][0-9]{3}", "М[ ]?1[ ]?:[ ]?[0-9]{1,4}"))
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩⑪⑫⑬⑭⑮⑯⑰⑱⑲⑳"


def yo(c: Column) -> Column:
    return F.translate(c, "ёЁ", "еЕ")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"[ \t\n\r\f]+", " "))


def fold(c: Column) -> Column:
    """Squeezed and lower-cased."""
    return F.lower(squeeze(c))


def fold_title(c: Column) -> Column:
    """A title for comparison: case, quotes, spaces and outer full stops don't count."""
    bare = F.regexp_replace(yo(F.lower(F.trim(c))), "[«»\"'`]+", "")
    return F.regexp_replace(squeeze(bare), r"^[ .]+|[ .]+$", "")


def fold_caption(c: Column) -> Column:
    """A caption without spaces and full stops."""
    return F.regexp_replace(yo(F.lower(c)), r"[ \t\n\r\f.]+", "")


def normalized(c: Column) -> Column:
    """Without model thinking, squeezed, one case."""
    return squeeze(yo(F.lower(strip_thinking(c))))


def canonical_code(c: Column) -> Column:
    return F.upper(yo(F.regexp_replace(c, r"[ \t\n\r\f]+", "")))


def strip_thinking(c: Column) -> Column:
    """Without closed and dangling thinking blocks."""
    return F.regexp_replace(F.regexp_replace(c, "(?s)<think>.*?</think>", ""), "(?s)<think>.*$", "")


def clean_number(c: Column) -> Column:
    """The first run of digits, else the trimmed text."""
    return F.coalesce(F.nullif(F.regexp_extract(c, "([0-9]+)", 1), F.lit("")), F.trim(c))


def compared_number(c: Column) -> Column:
    """Comma as full stop, plain minus, no zeros at the end of a fraction."""
    plain = F.translate(c, "−,", "-.")
    short = F.when(plain.contains("."), F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", "")).otherwise(plain)
    return F.when(short.isin("", "-"), F.lit("0")).otherwise(short)


def scored_number(c: Column) -> Column:
    """As compared_number, also without zeros in front."""
    plain = F.translate(c, ",", ".")
    short = F.when(plain.contains("."), F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", "")).otherwise(plain)
    bare = F.regexp_replace(short, "^0+", "")
    return F.when(bare == "", F.lit("0")).otherwise(bare)


def scored_word(c: Column) -> Column:
    return F.regexp_replace(yo(F.lower(c)), "^[«»\"'(){}.,;:!?—–\\[\\]-]+|[«»\"'(){}.,;:!?—–\\[\\]-]+$", "")


def glue_numbers(c: Column) -> Column:
    """Thousands written with a space become one number."""
    return F.regexp_replace(c, "(?<=[0-9])[   ](?=[0-9]{3}(?![0-9]))", "")


def skeleton(c: Column) -> Column:
    """The line with every number replaced by #, squeezed, lower case."""
    return squeeze(F.regexp_replace(yo(F.lower(F.regexp_replace(c, NUMBER, "#"))), "[|·•]+", " "))


def numbers(c: Column) -> Column:
    """Comparable numbers of a line in order."""
    return F.transform(F.regexp_extract_all(c, F.lit(f"({NUMBER})"), 1), compared_number)


def tokens(c: Column) -> Column:
    """Distinct lower-case words and numbers in order of appearance."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(f"({TOKEN})"), 1), F.lower))


def longer_tokens(c: Column) -> Column:
    return F.filter(tokens(c), lambda t: F.length(t) >= 2)


def words(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(f"({WORD})"), 1), scored_word))


def scored_numbers(c: Column) -> Column:
    """Distinct numbers of two or more digits."""
    found = F.transform(F.regexp_extract_all(glue_numbers(c), F.lit("([0-9]+(?:[.,][0-9]+)?)"), 1), scored_number)
    return F.array_distinct(F.filter(found, lambda n: F.length(F.translate(n, ".", "")) >= 2))


def codes(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(f"({CODE})"), 1), scored_word))


def fact_key(c: Column) -> Column:
    """Spellings of one fact as one: no spaces, one diameter sign, full stop for comma."""
    return F.lower(F.translate(F.regexp_replace(c, r"[ \t\n\r\f]+", ""), "Ø,", "∅."))


def facts(c: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(f"({FACT})"), 1), fact_key))


def looks_like_code(c: Column) -> Column:
    """A document code: 5 to 40 signs, a dash or slash, at least a quarter digits."""
    t = F.trim(c)
    digits = F.length(F.regexp_replace(t, "[^0-9]", ""))
    return F.length(t).between(5, 40) & t.rlike(DOCUMENT_CODE) & t.rlike("[-/]") & (digits * 4 >= F.length(t))


def is_service_text(c: Column) -> Column:
    return fold_caption(c).rlike(SERVICE_START)


def section_of(c: Column) -> Column:
    """A code without the end that marks a text part."""
    code = F.trim(c)
    return F.when(code.rlike(TEXT_PART), F.regexp_replace(F.regexp_replace(code, TEXT_PART, ""), r"[ .]+$", "")).otherwise(code)


def is_text_part(c: Column) -> Column:
    return F.trim(c).rlike(TEXT_PART)


def slug(c: Column) -> Column:
    """A piece of an address, never empty."""
    piece = F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(c, F.lit(""))), r"[/\\ \t\n\r\f]+", "_"), "[?#%]+", "")
    return F.coalesce(F.nullif(F.regexp_replace(piece, "^[_.]+|[_.]+$", ""), F.lit("")), F.lit("без-имени"))


def sheet_order(c: Column) -> Column:
    """Sort key of sheet numbers: numbers by value, then the rest."""
    digits = F.nullif(F.regexp_extract(F.trim(c), "^([0-9]+)", 1), F.lit(""))
    return F.struct(digits.isNull().cast("int").alias("kind"), F.coalesce(digits.cast("double"), F.lit(0.0)).alias("value"), c.alias("text"))


def strip_page_heading(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "^## Страница[^\n]*\n?", ""))


def code_in_body(c: Column) -> Column:
    """The first token of a text that looks like a document code, '' if there is none."""
    found = F.filter(F.regexp_extract_all(c, F.lit("([A-Za-zА-Яа-яЁё0-9][A-Za-zА-Яа-яЁё0-9./-]{4,40})"), 1), lambda t: looks_like_code(t) & t.rlike("[A-Za-zА-Яа-яЁё]"))
    return F.coalesce(F.get(found, 0), F.lit(""))


def part_order(c: Column) -> Column:
    """begin 0, continue 1, end 2 by the word's root, else null."""
    w = yo(F.lower(c))
    return F.when(w.startswith("нач"), 0).when(w.startswith("прод"), 1).when(w.startswith("окон") | w.startswith("конец"), 2)


def is_level(c: Column) -> Column:
    return F.trim(c).rlike(r"^[-+−]?[0-9]{1,3}[.,][0-9]{3}$")


def is_linear_size(c: Column) -> Column:
    return F.trim(c).rlike("^[0-9]{2,6}$")


def value_class(c: Column) -> Column:
    """letter, digit or other by the value itself."""
    t = F.trim(c)
    return F.when(t.rlike("^[0-9]{1,3}$"), "digit").when(t.rlike(f"^[{LETTERS}]{{1,2}}$"), "letter").otherwise("other")


def strip_tile_markers(c: Column) -> Column:
    """Grounding tags go, table tags become pipes."""
    out = F.regexp_replace(c, r"<\|[^|>]*\|>", "")
    out = F.regexp_replace(out, "(?i)</t[dh]>", " | ")
    out = F.regexp_replace(out, "(?i)</tr>", " |\n")
    return F.regexp_replace(F.regexp_replace(out, "(?i)</?(table|tbody|thead|tr|td|th)[^>]*>", ""), r"^\s+|\s+$", "")


def plural(n: Column, one: str, few: str, many: str) -> Column:
    """The Russian plural form for a count."""
    tens, ones = n % 100, n % 10
    return F.when(tens.between(11, 14), many).when(ones == 1, one).when(ones.between(2, 4), few).otherwise(many)


def markdown_cell(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))


def decoded(c: Column, mapping: dict[str, str]) -> Column:
    return F.translate(c, "".join(mapping), "".join(mapping.values()))


def label_key(c: Column) -> Column:
    """A legend label for comparison: punctuation is a space, a unit sticks to its number."""
    bare = F.regexp_replace(yo(F.lower(c)), f"[^{LETTERS}0-9]+", " ")
    return F.trim(F.regexp_replace(bare, "([0-9]) (мм|см|м|кв|л)( |$)", "$1$2$3"))


def stem(c: Column) -> Column:
    """Without the first matching Russian ending if at least four letters stay."""
    ending = "(иями|ями|ами|ого|его|ому|ему|ыми|ими|ией|иях|ах|ях|ый|ий|ой|ая|яя|ое|ее|ые|ие|ую|юю|ов|ев|ей|ом|ем|ам|ям|а|я|о|е|ы|и|у|ю|ь)$"
    cut = F.regexp_replace(c, ending, "")
    return F.when(F.length(cut) >= 4, cut).otherwise(c)


def context_terms(c: Column) -> Column:
    """Distinct stems of words of four or more letters."""
    found = F.regexp_extract_all(yo(F.lower(c)), F.lit("([а-яa-z]{4,})"), 1)
    return F.array_distinct(F.transform(found, stem))


def circled(n: Column) -> Column:
    return F.when(n.between(1, 20), F.substring(F.lit(CIRCLED), n, F.lit(1))).otherwise(F.concat(F.lit("("), n.cast("string"), F.lit(")")))


def garbled_share(c: Column) -> Column:
    """Letters outside the basic Latin and Cyrillic ranges among all counted letters, null under 30 letters."""
    usual, odd = F.regexp_count(c, F.lit("[А-Яа-яЁё]")), F.regexp_count(c, F.lit("[À-ʯЀЂ-ЏѐђѓєѕіїјљњћќўџҐґ]"))
    return F.when(usual + odd >= 30, odd / (usual + odd))


def page_range(spec: str, total: int) -> list[int]:
    """Pages of a specification such as 1-3,7 in the order first seen, within 1..total."""
    out: dict[int, None] = {}
    for piece in filter(None, (p.strip() for p in spec.split(","))):
        first, _, last = piece.partition("-")
        for page in range(int(first), int(last or first) + 1):
            if 1 <= page <= total:
                out[page] = None
    return list(out)
