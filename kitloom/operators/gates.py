"""Predicates, gates and decisions over pages, readings and captions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

# Words of a title block, shares and lengths at which a gate decides.
STAMP_WORDS = ("изм.", "кол.уч", "кол. уч", "№док", "№ док", "подп.", "инв. № подл", "взам. инв", "взаим. инв", "стадия", "листов", "разраб", "провер", "н.контр", "гип", "согласовано", "формат", "копировал")
HEADING_START = "^(приложение|раздел|подраздел|таблица|рисунок)"
LAYER_CHARS, DRAWING_CHARS, DRAWING_WORDS = 400, 1500, 200
TEXT_ONLY_VECTORS, TEXT_ONLY_IMAGES, TEXT_ONLY_BLOCK, TEXT_ONLY_CHARS = 200, 0.06, 0.05, 600
LONG_SIDE, WIDE_SIDE, SHORT_SIDE = 1100, 900, 700
PLAN_LENGTH_M = 40.0
JUNK = {"escape": r"\\[UM]\+", "markup": r"\{\\[A-Za-z]|\\[fFHWTQ][^;]{0,24};", "stub": "#{3,}", "sign": "[\ufffd\\x01-\\x08]"}
CAD_CODES = (("%%[dD]", "°"), ("%%[pP]", "±"), ("%%[cC]", "∅"), ("%%%", "%"), ("%%[uUoO]", ""))
MTEXT_CODE = r"\\(?:C[0-9]+|H[0-9.]+x?|W[0-9.]+|T[0-9.-]+|Q[0-9.-]+|A[0-9]|[fF][^;\\]*|p[^;\\]*);"
KEYS = "[0-9]{2}-[А-ЯA-Z]{2,5}-[0-9]/[0-9]{2}-[А-ЯA-Z0-9]+|ИГЭ-?[0-9]+|DN[ ]?[0-9]{2,4}|[0-9]{2,4}/[А-ЯA-Z]"
ALPHA = "A-Za-zÀ-ÖØ-öø-ÿА-Яа-яЁё"


def lines_of(c: Column) -> Column:
    """Trimmed non-empty lines."""
    return F.filter(F.transform(F.split(F.regexp_replace(c, "\r", ""), "\n"), F.trim), lambda x: x != "")


def count_lines(c: Column, pattern: str) -> Column:
    return F.size(F.filter(lines_of(c), lambda x: x.rlike(pattern)))


def is_drawing_page(width: Column, height: Column) -> Column:
    long, short = F.greatest(width, height), F.least(width, height)
    return (long >= LONG_SIDE) | ((long >= WIDE_SIDE) & (short >= SHORT_SIDE))


def layer_is_usable(c: Column, kind: Column) -> Column:
    """Readable and long enough; graphic pages need more."""
    t = F.trim(c)
    garbled = F.coalesce(T.garbled_share(c) >= 0.25, F.lit(False))
    words = F.size(F.filter(F.split(t, r"[ \t\n\r\f]+"), lambda x: x != ""))
    graphic = F.coalesce(kind.isin("plan", "scheme", "mixed", "table"), F.lit(False))
    return ~garbled & F.when(graphic, (F.length(t) >= DRAWING_CHARS) & (words >= DRAWING_WORDS)).otherwise(F.length(t) >= LAYER_CHARS)


def is_text_only(chars: Column, vectors: Column, image_share: Column, largest_block: Column) -> Column:
    return (largest_block <= TEXT_ONLY_BLOCK) & (vectors <= TEXT_ONLY_VECTORS) & (image_share <= TEXT_ONLY_IMAGES) & (chars >= TEXT_ONLY_CHARS)


def is_all_errors(c: Column) -> Column:
    """Nothing but passports, service lines and error stubs: fewer than 40 letters and digits."""
    kept = F.filter(F.split(F.concat(F.lit("\n"), c), "\n(?=### )"), lambda s: ~s.rlike("^### (PASS-0|PASS-[^ \n]* пропущен)"))
    lines = F.transform(F.split(F.array_join(kept, "\n"), "\n"), lambda x: F.trim(F.regexp_replace(x, r"\(ошибк[аи][^)]*\)", "")))
    real = F.filter(lines, lambda x: ~x.rlike(r"^(#{1,6} |-{2,} |_[^_]*_ *$)"))
    return F.length(F.regexp_replace(F.array_join(real, ""), f"[^{ALPHA}0-9]", "")) < 40


def stamped_location(c: Column) -> Column:
    """The same ending after a dash on six or more lines."""
    tails = F.transform(F.filter(lines_of(c), lambda x: x.contains(" — ")), lambda x: F.lower(F.trim(F.regexp_replace(x, "^.* — ", ""))))
    tails = F.filter(tails, lambda x: F.length(x) >= 6)
    most = F.array_max(F.transform(F.array_distinct(tails), lambda t: F.size(F.filter(tails, lambda y: y == t))))
    return F.coalesce(most >= 6, F.lit(False))


def is_garbage_tile(c: Column) -> Column:
    """Mostly number cells, axis lines or bare numbers."""
    cells = count_lines(c, r"^\|[ 0-9|]*\|[ ]*[0-9]{1,4}[ ]*\|[ 0-9|]*$")
    axes = count_lines(c, r"(?iu)^([-*•]\s*)?ось\s+[0-9]+")
    bare = count_lines(c, r"^([-*•]\s*)?[0-9]{1,4}$")
    return (F.length(F.trim(c)) >= 20) & ((cells >= 25) | (axes >= 20) | (bare >= 30))


def has_context(c: Column) -> Column:
    return F.exists(lines_of(c), lambda x: (F.length(x) >= 8) & ~x.startswith("|"))


def digit_rows(c: Column) -> Column:
    return count_lines(c, r"^\|.*[0-9]")


def content_rows(c: Column) -> Column:
    """Table rows with a digit and two filled cells."""
    rows = F.filter(lines_of(c), lambda x: x.startswith("|") & x.rlike("[0-9]"))
    filled = lambda x: F.size(F.filter(F.split(F.regexp_replace(x, r"^\|+|\|+$", ""), r"\|"), lambda y: F.trim(y) != ""))
    return F.size(F.filter(rows, lambda x: filled(x) >= 2))


def table_score(c: Column) -> Column:
    """Content rows weigh more than length; a loop of empty cells costs."""
    return content_rows(c) * 1000 + F.least(F.length(c), F.lit(999)) - F.when(c.contains("[петля пустых ячеек]"), 500).otherwise(0)


def looks_repeated(c: Column) -> Column:
    """A looping unit, or one short line that is six or more of twelve or more."""
    lines = lines_of(c)
    most = F.array_max(F.transform(F.array_distinct(F.filter(lines, lambda x: F.length(x) < 80)), lambda t: F.size(F.filter(lines, lambda y: y == t))))
    return (F.length(c) >= 80) & (c.rlike(r"(.{8,50}?)\1{8,}") | ((F.size(lines) >= 12) & F.coalesce(most >= 6, F.lit(False))))


def looks_like_stamp(c: Column) -> Column:
    low = F.lower(c)
    return sum((F.contains(low, F.lit(w)).cast("int") for w in STAMP_WORDS), F.lit(0)) >= 2


def looks_like_heading(c: Column) -> Column:
    t = F.trim(c)
    return (F.length(c) <= 90) & ~t.contains("\n") & (t.rlike(f"^[0-9].*[{ALPHA}]") | F.lower(t).rlike(HEADING_START))


def description_reasons(c: Column, kind: Column) -> Column:
    """Why a short description of a page is not good enough; empty if it is."""
    shortest = F.when(kind == "plan", 2500).when(kind == "scheme", 2000).when(kind == "table", 2000).when(kind == "mixed", 2200).otherwise(1500)
    low = F.lower(c)
    missing = sum(((~F.contains(low, F.lit(w))).cast("int") for w in ("что это", "состав и размещение", "связи")), F.lit(0))
    rows = count_lines(c, r"^\|.+\|$")
    return F.array_compact(
        F.array(
            F.when(stamped_location(c), "stamped_location"),
            F.when(F.length(F.trim(c)) < shortest, "too_short"),
            F.when(c.contains("[truncated-repeat]"), "repetition_loop"),
            F.when((kind == "table") & (rows < 8), "tables_too_thin"),
            F.when(kind.isin("plan", "scheme", "mixed") & (missing >= 2), "missing_sections"),
        )
    )


def trust_level(docx: Column, vector: Column, has_layer: Column, has_model: Column) -> Column:
    """Trust by where the content of a page comes from."""
    return F.when(docx, "docx").when(vector, "drawing").when(has_layer, "layer").when(has_model, "model").otherwise("none")


def trust_warnings(scan: Column, no_layer: Column, skipped: Column, mock: Column, errors: Column, level: Column) -> Column:
    return F.array_compact(F.array(F.when(scan, "scan").when(no_layer, "no layer").when(skipped, "skipped"), F.when(mock, "mock"), F.when(errors > 0, "errors"), F.when(level == "model", "read from image"), F.when(level == "none", "nothing extracted")))


def page_kind(width: Column, height: Column, labels: Column, unique_labels: Column, pipes: Column, axes: Column, section: Column, table_cues: Column, number_lines: Column, chars: Column) -> Column:
    """plan, scheme, table, text or mixed by size and what is written."""
    long, short = F.greatest(width, height), F.least(width, height)
    large = is_drawing_page(width, height)
    wide = (long / F.greatest(short, F.lit(1.0)) >= 1.6) & (long >= 1000)
    small = F.when((table_cues >= 2) | (number_lines >= 40), "table").when((chars > 800) & (unique_labels < 8), "text").when((unique_labels >= 10) & (pipes >= 5), "mixed").otherwise("text")
    return F.when(large & ((labels >= 40) | (unique_labels >= 15) | (pipes >= 8) | wide), "plan").when(large, "scheme").otherwise(small)


def sheet_kind(length_m: Column, entities: Column, texts: Column, inserts: Column) -> Column:
    """A plan by the amount of geometry, else a text sheet."""
    return F.when((length_m <= 0) & (inserts == 0), "text").when((length_m >= PLAN_LENGTH_M) | (inserts >= 3), "plan").when(entities >= 5 * F.greatest(texts, F.lit(1)), "plan").otherwise("text")


def sheet_content(has_text: Column, lost: Column, blank: Column) -> Column:
    return F.when(has_text, "text").when(lost, "lost").when(blank, "blank").otherwise("drawing")


def needs_model(scan: Column, no_layer: Column, kind: Column) -> Column:
    return scan | no_layer | kind.isin("plan", "scheme", "mixed")


def clean_caption(c: Column) -> Column:
    """A caption without control signs, drawing codes and their brackets; field stubs inside it become a dash."""
    plain = F.regexp_replace(c, r"[\x00-\x08\x0B-\x1F]", "")
    bare = F.regexp_replace(plain, MTEXT_CODE, "")
    out = F.when(bare != plain, F.regexp_replace(bare, r"\{([^{}]*)\}", "$1")).otherwise(plain)
    for code, sign in CAD_CODES:
        out = F.regexp_replace(out, code, sign)
    return F.when(F.trim(out).rlike("^#{2,}$"), out).otherwise(F.regexp_replace(out, "#{2,}", "—"))


def junk_kinds(c: Column) -> Column:
    return F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(k)) for k, p in JUNK.items()]))


def caption_part(c: Column) -> Column:
    """name and part (0 begin, 1 continue, 2 end) of a table caption such as `Содержание (окончание)`."""
    t = T.squeeze(c)
    word = F.regexp_extract(t, r"\( *([^)]{3,20}?) *\) *$", 1)
    part = F.when(word != "", T.part_order(word))
    return F.struct(F.when(part.isNotNull(), F.trim(F.regexp_replace(t, r"\([^)]*\) *$", ""))).otherwise(t).alias("name"), F.coalesce(part, F.lit(0)).alias("part"))


def paper_format(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "(?iu)[aа]([0-5])(?![0-9])", 1), F.lit(""))


def written_scale(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "(?iu)м? ?1 ?: ?([0-9]{1,5})", 1), F.lit(""))


def circle_number(block: Column) -> Column:
    n = F.regexp_extract(F.lower(F.trim(block)), "^круг ?([0-9]+)$", 1).try_cast("int")
    return F.when(n.between(1, 20), n)


def room_number(block: Column) -> Column:
    return F.regexp_extract(F.trim(block), r"(?iu)^номерация[ \t]+(.+)$", 1)


def type_label(c: Column) -> Column:
    """A label without the sample number in front."""
    return F.regexp_replace(F.trim(c), "^[0-9]+[ \t]+", "")


def is_view_title(c: Column) -> Column:
    return F.trim(c).rlike(r"(?iu)^(схем[а-яё]*\s+расположен|(геологическ[а-яё]*\s+)?разрез([^а-яё]|$)|по\s+лини|[IVX]+ *[-–] *[IVX]+)")


def fragment_count(c: Column) -> Column:
    return F.greatest(F.regexp_count(F.concat(F.lit("\n"), c, F.lit("\n")), F.lit(r"\n[ \t]*--- +[^ \n]+ +---[ \t]*(?=\n)")), F.lit(1))


def passport_kind(c: Column) -> Column:
    return F.nullif(F.lower(F.coalesce(F.nullif(F.regexp_extract(c, r"(?im)^\s*[-*]?\s*kind:\s*`?([a-z]+)", 1), F.lit("")), F.regexp_extract(c, r"Тип листа \(эвристика\):\s*([a-z]+)", 1))), F.lit(""))


def key_phrases(c: Column) -> Column:
    """Distinct codes and short wordy lines of a reference."""
    found = F.transform(F.regexp_extract_all(c, F.lit(f"({KEYS})"), 1), T.canonical_code)
    wordy = F.filter(lines_of(c), lambda x: F.length(x).between(12, 80) & ~x.rlike("^[|#*]") & x.rlike("[А-Яа-я]{4,}"))
    return F.array_distinct(F.concat(found, F.transform(wordy, F.upper)))


def key_hit(key: Column, text_upper: Column, text_tokens: Column) -> Column:
    """A key stands in a text literally, or seven tenths of its longer tokens do."""
    own = F.filter(T.tokens(key), lambda t: F.length(t) >= 3)
    hits = F.size(F.array_intersect(own, text_tokens))
    return F.contains(text_upper, T.yo(F.upper(key))) | ((F.size(own) > 0) & (hits * 10 >= F.size(own) * 7))


def numbers_sentence(total: Column, found: Column, suspects: Column) -> Column:
    """The outcome of a number check in words; null total means nothing to check against."""
    rest = F.concat(found.cast("string"), F.lit(" из "), total.cast("string"), F.lit(" чисел описания найдены в документе; не найдены: "), F.array_join(F.slice(suspects, 1, 12), "; "))
    return F.when(total.isNull(), "не выполнялась").when(total == 0, "в описании нет чисел").when(F.size(suspects) == 0, F.concat(F.lit("все "), total.cast("string"), F.lit(" чисел описания найдены в документе"))).otherwise(rest)


def text_span(c: Column, size: Column, factor: Column, ratio: float = 0.6) -> Column:
    """Width of a caption: its longest line."""
    return F.array_max(F.transform(F.split(c, "\n"), F.length)) * size * factor * ratio


def sheet_format(long: Column, short: Column) -> Column:
    """Name and scale of the paper that a frame of this size is, as structs, all that fit."""
    sizes = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("w"), F.lit(float(h)).alias("h")) for n, w, h in (("A4", 210, 297), ("A3", 297, 420), ("A2", 420, 594), ("A1", 594, 841), ("A0", 841, 1189))])

    def fit(s: Column) -> Column:
        scale = F.round(long / s["h"])
        good = (scale > 0) & (F.abs(long / s["h"] - scale) <= 0.02 * scale) & (F.abs(short / s["w"] - scale) <= 0.05 * scale)
        return F.when(good, F.struct(s["name"].alias("name"), scale.alias("scale")))

    return F.array_compact(F.transform(sizes, fit))
