"""Table functions for SQL: pages, lines and tokens of a text."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from .text import TOKEN

_HEADING = re.compile(r"^## Страница (\d+)[ \t]*$", re.M)
_TOKEN = re.compile(TOKEN)


@udtf(returnType="page int, body string")
class SplitPages:
    """Pages of a text cut at its headings; without one the whole text is page 1."""

    def eval(self, text: str | None) -> Iterator[tuple[int, str]]:
        if text is None:
            return
        cuts = [*_HEADING.finditer(text)]
        if not cuts:
            yield 1, text.strip()
        for cut, after in zip(cuts, [*cuts[1:], None], strict=False):
            yield int(cut[1]), text[cut.end() : after.start() if after else len(text)].strip()


@udtf(returnType="pos int, line string")
class TextLines:
    def eval(self, text: str | None) -> Iterator[tuple[int, str]]:
        yield from enumerate(() if text is None else text.replace("\r", "").split("\n"))


@udtf(returnType="token string")
class TextTokens:
    """Distinct lower-case tokens in order of appearance."""

    def eval(self, text: str | None) -> Iterator[tuple[str]]:
        for token in dict.fromkeys(t.lower() for t in _TOKEN.findall(text or "")):
            yield (token,)


def register(spark: SparkSession) -> None:
    """Make the functions known to SQL as split_pages, text_lines and text_tokens."""
    for name, function in (("split_pages", SplitPages), ("text_lines", TextLines), ("text_tokens", TextTokens)):
        spark.udtf.register(name, function)
