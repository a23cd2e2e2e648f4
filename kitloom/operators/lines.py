"""Lines of texts in order: splitting, cleaning by runs, and putting together again.

A text is a table of lines (key..., pos, line); cleaners look at runs of equal keys by gaps and islands, so each is one
window per text. A text is one partition of these windows; texts themselves are the unit that scales.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Marks of the pipeline in a text, and the shape of table separators.
SERVICE_LINE = r"(?iu)^\[(warning|mock|ocr|truncated|inline)|^_?\[mock\]|^\[.{0,40}схлопнут"
SEPARATOR = r"^[ \t:|-]*-[ \t:|-]*$"


def lines(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., pos, line); null texts have no line, line ends may be \\r\\n."""
    return df.select(*keys, F.posexplode(F.split(F.regexp_replace(text, "\r", ""), "\n")).alias("pos", "line"))


def text_of(df: DataFrame, keys: list[str], line: str = "line", order: str = "pos") -> DataFrame:
    """Lines put together in order."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(line).alias("l"))))
    return df.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["l"]), "\n").alias("text"))


def runs(df: DataFrame, keys: list[str], by: Column | str, order: str = "pos") -> DataFrame:
    """df with run_key, run_id, run_pos and run_len for maximal runs of equal run_key."""
    by = F.col(by) if isinstance(by, str) else by
    part = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("run_key", by).withColumn("__new", (~F.col("run_key").eqNullSafe(F.lag("run_key").over(part))).cast("int"))
    marked = marked.withColumn("run_id", F.sum("__new").over(part)).drop("__new")
    inside = Window.partitionBy(*keys, "run_id")
    return marked.withColumn("run_pos", F.row_number().over(inside.orderBy(order))).withColumn("run_len", F.count("*").over(inside))


def limit_equal_lines(df: DataFrame, keys: list[str], keep: int = 2) -> DataFrame:
    """Of equal lines in a row the first ones; blank lines always stay."""
    r = runs(df, keys, F.trim("line"))
    return r.filter((F.col("run_key") == "") | (F.col("run_pos") <= keep)).drop("run_key", "run_id", "run_pos", "run_len")


def _collapse(r: DataFrame, eligible: Column, keep: int, marker: Column) -> DataFrame:
    """Runs that are eligible keep their first lines and a marker in place of the next one."""
    line = F.when(eligible & (F.col("run_pos") == keep + 1), marker).otherwise(F.col("line"))
    kept = r.filter(~eligible | (F.col("run_pos") <= keep + 1)).withColumn("line", line)
    return kept.drop("run_key", "run_id", "run_pos", "run_len")


def collapse_number_bullets(df: DataFrame, keys: list[str], min_run: int = 20) -> DataFrame:
    """Long lists of bare numbers keep three."""
    is_number = F.col("line").rlike(r"^\s*[-*•]\s+[0-9]{1,5}([.,][0-9]+)?\s*$")
    return _collapse(runs(df, keys, is_number), F.col("run_key") & (F.col("run_len") >= min_run), 3, F.lit("[truncated-numeric-list]"))


def list_stem(line: Column) -> Column:
    """What stays of a list line when its numbers become #; null for tables and other lines."""
    body = F.regexp_replace(F.trim(line), r"^([0-9]{1,4}[.)]\s+|[-*•]\s+)", "")
    stem = F.lower(T.squeeze(F.regexp_replace(body, "[0-9]+([.,][0-9]+)?", "#")))
    listed = F.trim(line).rlike(r"^([0-9]{1,4}[.)]\s+|[-*•]\s+)")
    return F.when(listed & (F.length(stem) >= 4), stem)


def collapse_list_stems(df: DataFrame, keys: list[str], min_run: int = 8) -> DataFrame:
    """Lists whose lines differ in numbers only keep two lines."""
    eligible = F.col("run_key").isNotNull() & (F.col("run_len") >= min_run)
    return _collapse(runs(df, keys, list_stem(F.col("line"))), eligible, 2, F.lit("[truncated-numbered-hallucination]"))


def collapse_empty_cells(line: Column, min_cells: int = 15) -> Column:
    """A long row of empty cells in a table line becomes a marker."""
    return F.when(F.ltrim(line).startswith("|"), F.regexp_replace(line, r"(?:\|[ \t]*){%d,}\|" % min_cells, "| [петля пустых ячеек] |")).otherwise(line)


def collapse_table_progressions(df: DataFrame, keys: list[str], min_run: int = 10) -> DataFrame:
    """Table rows of one shape whose first number grows by a constant step keep three."""
    first = F.regexp_extract("line", "(-?[0-9]+(?:[.,][0-9]+)?)", 1)
    is_row = F.ltrim("line").startswith("|") & ~F.trim("line").rlike(SEPARATOR) & (first != "")
    shape = F.when(is_row, F.lower(T.squeeze(F.regexp_replace("line", "-?[0-9]+(?:[.,][0-9]+)?", "#"))))
    r = runs(df, keys, shape).withColumn("__n", F.translate(first, ",", ".").try_cast("double"))
    part = Window.partitionBy(*keys, "run_id")
    step = F.round(F.col("__n") - F.lag("__n").over(part.orderBy("pos")), 4)
    r = r.withColumn("__step", step)
    r = r.withColumn("__same", F.min("__step").over(part) == F.max("__step").over(part)).drop("__n", "__step")
    eligible = F.col("run_key").isNotNull() & (F.col("run_len") >= min_run) & F.coalesce("__same", F.lit(False))
    marker = F.concat(F.lit("[truncated-table-progression: ещё "), F.col("run_len") - 3, F.lit(" однотипных строк с постоянным шагом]"))
    return _collapse(r, eligible, 3, marker).drop("__same")


def join_value_columns(df: DataFrame, keys: list[str], min_run: int = 6, max_len: int = 18) -> DataFrame:
    """Columns of bare values become one line; blank lines between them don't break a column."""
    bare = F.regexp_replace(F.trim("line"), r"^[-*•]\s+", "")
    is_value = (F.length(F.trim("line")) <= max_len) & ~F.trim("line").rlike("^[|#]") & bare.rlike(f"^[{T.LETTERS}0-9_.,/№()+±-]+$")
    kind = F.when(F.trim("line") == "", F.lit(None)).otherwise(is_value)
    filled = df.withColumn("__value", kind).withColumn("__bare", bare)
    solid = runs(filled.filter(F.col("__value").isNotNull()), keys, "__value")
    long_run = F.col("run_key") & (F.col("run_len") >= min_run)
    group = solid.filter(long_run).groupBy(*keys, "run_id").agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col("__bare").alias("b")))), lambda x: x["b"]).alias("vals"))
    unique = F.array_distinct("vals")
    note = F.when(F.size(unique) < F.size("vals"), F.concat(F.lit(" [дубли схлопнуты: "), F.size("vals") - F.size(unique), F.lit("]"))).otherwise("")
    joined = group.select(*keys, F.col("first").alias("pos"), F.concat(F.lit("Значения на фрагменте: "), F.array_join(unique, ", "), note).alias("line"))
    spans = group.groupBy(*keys).agg(F.collect_list(F.struct("first", "last")).alias("spans"))
    rest = df.join(spans, keys, "left").filter(~F.coalesce(F.exists("spans", lambda s: F.col("pos").between(s["first"], s["last"])), F.lit(False))).drop("spans")
    return rest.select(*keys, "pos", "line").unionByName(joined)


def strip_empty_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Blank table rows go unless a separator follows, whose header they are."""
    after = F.lead("line").over(Window.partitionBy(*keys).orderBy("pos"))
    blank = F.trim("line").rlike(r"^\|[| \t]*$")
    return df.withColumn("__next", after).filter(~(blank & ~F.coalesce(F.trim("__next").rlike(r"^\|[ \t:|-]*-[ \t:|-]*$"), F.lit(False)))).drop("__next")


def cap_separators(df: DataFrame, keys: list[str], widest: int = 60) -> DataFrame:
    """Table separators become no wider than their header."""
    pipes = lambda c: F.length(c) - F.length(F.replace(c, F.lit("|")))
    before = F.trim(F.lag("line").over(Window.partitionBy(*keys).orderBy("pos")))
    header = F.when(before.startswith("|"), pipes(F.regexp_replace(before, r"^\|+|\|+$", "")) + 1)
    wide = df.withColumn("__cap", F.greatest(F.coalesce(header, F.lit(widest)), F.lit(2)))
    is_separator = F.trim("line").rlike(r"^\|([ ]*:?-+:?[ ]*\|){3,}[ ]*:?-*$")
    line = F.when(is_separator & (pipes(F.col("line")) - 1 > F.col("__cap")), F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.col("__cap")))).otherwise(F.col("line"))
    return wide.withColumn("line", line).drop("__cap")


def cut_at_repeat(df: DataFrame, keys: list[str], most: int = 6) -> DataFrame:
    """A text ends before the line that repeats a line for the most-th time."""
    key = T.fold(F.col("line"))
    seen = F.row_number().over(Window.partitionBy(*keys, "__k").orderBy("pos"))
    counted = df.withColumn("__k", key).withColumn("__n", F.when(F.col("__k") != "", seen))
    first = F.min(F.when(F.col("__n") >= most, F.col("pos"))).over(Window.partitionBy(*keys))
    return counted.withColumn("__cut", first).filter("__cut is null or pos < __cut").drop("__k", "__n", "__cut")


def first_occurrences(df: DataFrame, keys: list[str], min_len: int = 8) -> DataFrame:
    """Repeated content lines of a text go; short and structural lines stay."""
    key = F.lower(T.squeeze(F.col("line")))
    structural = F.trim("line").rlike(r"^(#|\||---|>|```)")
    counted = df.withColumn("__k", F.when((F.length(key) >= min_len) & ~structural, key))
    nth = F.row_number().over(Window.partitionBy(*keys, "__k").orderBy("pos"))
    return counted.withColumn("__n", nth).filter("__k is null or __n = 1").drop("__k", "__n")


def collapse_label_runs(df: DataFrame, keys: list[str]) -> DataFrame:
    """Runs of equal short labels keep two and a count, of other short lines one and a count."""
    r = runs(df, keys, F.trim("line"))
    key = F.col("run_key")
    label = (F.length(key) <= 20) & (key != "") & ~key.contains(" ") & (F.col("run_len") >= 4)
    copied = ~label & (key != "") & (F.length(key) <= 40) & (F.col("run_len") >= 8)
    keep = F.when(label, 2).when(copied, 1)
    note = F.when(label, F.concat(F.lit("(×"), F.col("run_len"), F.lit(" на плане — схлопнуто)"))).otherwise(F.concat(F.lit("(×"), F.col("run_len"), F.lit(" — схлопнуто)")))
    out = r.withColumn("__keep", keep).filter("__keep is null or run_pos <= __keep + 1")
    out = out.withColumn("line", F.when(F.col("run_pos") == F.col("__keep") + 1, note).otherwise(F.col("line")))
    return out.filter((key != "") | (F.col("run_pos") == 1)).drop("run_key", "run_id", "run_pos", "run_len", "__keep")


# Short labels of networks on plans, how often one must stand on a page to be summed up, and how many stay.
NETWORK_LABEL, LABEL_LEAST, LABEL_KEPT = r"^(?:[A-Za-zА-Яа-яЁё][0-9]{0,3}(?:\.[0-9]+)?|ДРП|ПГ[0-9]+|УП[0-9]+(?:\.[0-9]+)?)$", 15, 2


def sum_up_labels(df: DataFrame, keys: list[str]) -> DataFrame:
    """Labels of networks scattered over a text often enough keep their first two lines and are named in a last line."""
    key = F.trim("line")
    labels = df.filter(key.rlike(NETWORK_LABEL)).groupBy(*keys, key.alias("__k")).agg(F.count("*").alias("__n"), F.min("pos").alias("__first")).filter(F.col("__n") >= LABEL_LEAST)
    nth = F.row_number().over(Window.partitionBy(*keys, "__k").orderBy("pos"))
    body = df.withColumn("__k", key).join(labels.select(*keys, "__k", "__n"), [*keys, "__k"], "left").withColumn("__i", F.when(F.col("__n").isNotNull(), nth))
    body = body.filter(F.col("__i").isNull() | (F.col("__i") <= LABEL_KEPT)).select(df.columns)
    named = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__n")).alias("n"), "__first", "__k"))), lambda x: F.concat(x["__k"], F.lit(" (×"), (-x["n"]).cast("string"), F.lit(")"))), ", ")
    last = df.groupBy(*keys).agg(F.max("pos").alias("__last"))
    summary = labels.groupBy(*keys).agg(named.alias("__s")).join(last, keys)
    lines = F.explode(F.array(F.struct((F.col("__last") + 1).alias("pos"), F.lit("").alias("line")), F.struct((F.col("__last") + 2).alias("pos"), F.concat(F.lit("Метки сетей на плане (сводка): "), F.col("__s"), F.lit(".")).alias("line")))).alias("l")
    return body.unionByName(summary.select(*keys, lines).select(*keys, "l.*"), allowMissingColumns=True)


def content_lines(df: DataFrame) -> DataFrame:
    """Lines of content: no tables, quotes, headings, rules, italic notes and pipeline marks; bullets taken off."""
    t = F.trim("line")
    markup = (t == "") | t.rlike(r"^(\||>|#|---)") | (t.startswith("_") & t.endswith("_")) | t.rlike(SERVICE_LINE)
    return df.filter(~markup).withColumn("line", F.trim(F.regexp_replace(t, r"^[-*•]\s+", ""))).filter(F.length("line") >= 3)


def table_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., table_no, row, line) of pipe tables: runs of three or more lines that begin with a pipe."""
    r = runs(df, keys, F.ltrim("line").startswith("|")).filter("run_key and run_len >= 3")
    number = F.dense_rank().over(Window.partitionBy(*keys).orderBy("run_id"))
    return r.select(*keys, number.alias("table_no"), F.col("run_pos").alias("row"), F.trim("line").alias("line"))


def table_cells(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., table_no, row, col, cell) without separator rows."""
    body = table_rows(df, keys).filter(~F.col("line").rlike(SEPARATOR))
    return body.select(*keys, "table_no", "row", F.posexplode(F.split(F.regexp_replace("line", r"^\||\|$", ""), r"\|")).alias("col", "cell")).withColumn("cell", F.trim("cell"))


def ragged_tables(df: DataFrame, keys: list[str]) -> DataFrame:
    """Tables with a data row wider than their header by more than one cell."""
    widths = table_cells(df, keys).groupBy(*keys, "table_no", "row").agg(F.count("*").alias("cells"))
    return widths.groupBy(*keys, "table_no").agg(F.max("cells").alias("widest"), F.min_by("cells", "row").alias("header")).filter("widest > header + 1")


def pages(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys..., page, body) of a text cut at its page headings; without one the whole text is page 1."""
    whole = F.concat(F.lit("\n"), F.col(text))
    parts = F.split(whole, "\n## Страница (?=[0-9]+[ \t]*(\n|$))")
    cut = df.select(*keys, F.posexplode(parts).alias("n", "part"), (F.size(parts) == 1).alias("only"))
    page = F.when(F.col("only"), 1).otherwise(F.regexp_extract("part", "^([0-9]+)", 1).try_cast("int"))
    body = F.when(F.col("only"), F.trim("part")).otherwise(F.trim(F.regexp_replace("part", "^[0-9]+[ \t]*\n?", "")))
    return cut.filter("only or n > 0").select(*keys, page.alias("page"), body.alias("body"))


def passes(df: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """(keys..., pass, body) of a page's pass sections, the first of each name."""
    parts = F.split(F.concat(F.lit("\n"), F.col(body)), "\n### (?=PASS-)")
    cut = df.select(*keys, F.posexplode(parts).alias("n", "part")).filter("n > 0")
    named = cut.select(*keys, "n", F.regexp_extract("part", "^(PASS-[^ \n]+)", 1).alias("pass"), F.trim(F.regexp_replace("part", "^[^\n]*\n?", "")).alias("body"))
    return named.groupBy(*keys, "pass").agg(F.min_by("body", "n").alias("body"))


def clean_chain(df: DataFrame, keys: list[str]) -> DataFrame:
    """The cleaners of one text in their fixed order."""
    emptied = df.withColumn("line", collapse_empty_cells(F.col("line")))
    out = cap_separators(emptied, keys)
    for step in (collapse_number_bullets, collapse_list_stems, collapse_table_progressions, limit_equal_lines, strip_empty_rows):
        out = step(out, keys)
    return join_value_columns(out, keys)


def heading_blocks(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., block, title, start, end) of pass sections and marked blocks; a text without any is one block."""
    counted = df.groupBy(*keys).agg(F.count("*").cast("int").alias("lines"))
    is_head = F.col("line").rlike(r"^#{2,6} +(PASS-|SRC-|Страница )")
    w = Window.partitionBy(*keys).orderBy("pos")
    heads = df.filter(is_head).select(*keys, "pos", F.trim(F.regexp_replace("line", "^#+ +", "")).alias("title"))
    cut = heads.join(counted, keys).withColumn("end", F.coalesce(F.lead("pos").over(w), F.col("lines"))).withColumn("block", F.row_number().over(w))
    none = counted.join(heads.select(*keys).distinct(), keys, "left_anti").select(*keys, F.lit(1).alias("block"), F.lit("Лист").alias("title"), F.lit(0).alias("start"), F.col("lines").alias("end"))
    return cut.select(*keys, "block", "title", F.col("pos").alias("start"), "end").unionByName(none)


def lines_within(df: DataFrame, keys: list[str], most_chars: int) -> DataFrame:
    """First-seen distinct lines of a text while their summed length stays within a limit."""
    key = T.fold(F.col("line"))
    first = F.row_number().over(Window.partitionBy(*keys, "__k").orderBy("pos"))
    seen = df.withColumn("__k", key).filter("__k <> ''").withColumn("__n", first).filter("__n = 1")
    total = F.sum(F.length("line") + 1).over(Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return seen.withColumn("__t", total).filter(F.col("__t") <= most_chars).drop("__k", "__n", "__t")


def shown_labels(df: DataFrame, keys: list[str], limit: int = 4) -> DataFrame:
    """Labels (keys..., pos, line) of a sheet; one that occurs `limit` times or more is shown once with its count."""
    w = Window.partitionBy(*keys, "line")
    counted = df.withColumn("__n", F.count("*").over(w)).withColumn("__r", F.row_number().over(w.orderBy("pos")))
    shown = F.when(F.col("__n") >= limit, F.concat("line", F.lit(" (×"), F.col("__n"), F.lit(" на листе — схлопнуто)"))).otherwise(F.col("line"))
    return counted.filter((F.col("__n") < limit) | (F.col("__r") == 1)).withColumn("line", shown).drop("__n", "__r")
