"""Words of a text: longest runs of letters and digits."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\W_]+")
LINE_BREAK_HYPHEN = re.compile(r"(?<=[^\W_])[-\u00ad\u2010\u2011][ \t\r]*\n[ \t\r]*(?=[^\W_])")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def joined_words(text: str) -> list[str]:
    """Words after joining those broken by a hyphen at a line end, with ё as е."""
    if "\n" in text:
        text = LINE_BREAK_HYPHEN.sub("", text)
    return WORD.findall(text.lower().replace("ё", "е"))
