"""Strict checks of a scoring manifest: its version, gates, and fixtures with what they expect.

A manifest is read as rows of a table, one a manifest; every defect is a row (path, field, problem), so many are checked at
once and none hides another.

Defined cases: a manifest that is no JSON object has that one problem; lists that are absent are empty; a manifest without
problems gives no row.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

# The version, gates with their kinds, and splits of a manifest.
VERSION, SHARES, COUNTS = 1, ("minInstanceRecall", "minBindingPrecision"), ("maxFalseConfirmedBindings",)
SPLITS = ("development", "validation", "holdout")
NAMED = {"bindings": ("instanceKey", "legendLabel"), "relationships": ("sourceKey", "targetKey", "type")}

Problem = tuple[str, str]


def _is_number(v: object) -> bool:
    return isinstance(v, int | float) and not isinstance(v, bool)


def _named(v: object) -> bool:
    return isinstance(v, str) and bool(v.strip())


def gate_problems(gates: object) -> Iterator[Problem]:
    if not isinstance(gates, dict):
        yield "qualityGates", "an object is expected"
        return
    for name, value in gates.items():
        if name in SHARES and not (_is_number(value) and 0 <= value <= 1):
            yield f"qualityGates.{name}", "a number from 0 to 1 is expected"
        elif name in COUNTS and not (_is_number(value) and isinstance(value, int) and value >= 0):
            yield f"qualityGates.{name}", "a whole number from 0 is expected"
        elif name not in SHARES + COUNTS:
            yield f"qualityGates.{name}", "no such gate"


def expectation_problems(expected: object) -> Iterator[Problem]:
    if not isinstance(expected, dict):
        yield "", "an object is expected"
        return
    for name in ("instanceKeys", "unknownInstanceKeys"):
        keys = expected.get(name, [])
        if not (isinstance(keys, list) and all(map(_named, keys))):
            yield f".{name}", "a list of texts is expected"
    for name, fields in NAMED.items():
        rows = expected.get(name, [])
        if not isinstance(rows, list):
            yield f".{name}", "a list is expected"
            continue
        for k, row in enumerate(rows):
            if not isinstance(row, dict):
                yield f".{name}[{k}]", "an object is expected"
                continue
            yield from ((f".{name}[{k}].{f}", "a text is expected") for f in fields if not _named(row.get(f)))
            if name == "relationships" and not isinstance(row.get("directed"), bool):
                yield f".{name}[{k}].directed", "true or false is expected"


def problems(text: str) -> Iterator[Problem]:
    """(field, problem) of a manifest's text."""
    try:
        data = json.loads(text)
    except (ValueError, TypeError):
        data = None
    if not isinstance(data, dict):
        yield "", "a JSON object is expected"
        return
    if data.get("schemaVersion") != VERSION or isinstance(data.get("schemaVersion"), bool):
        yield "schemaVersion", f"{VERSION} is expected"
    yield from gate_problems(data.get("qualityGates", {}))
    fixtures = data.get("fixtures")
    if not isinstance(fixtures, list) or not fixtures:
        yield "fixtures", "a list with fixtures is expected"
        return
    ids = Counter(f["id"] for f in fixtures if isinstance(f, dict) and _named(f.get("id")))
    for k, fixture in enumerate(fixtures):
        at = f"fixtures[{k}]"
        if not isinstance(fixture, dict):
            yield at, "an object is expected"
            continue
        yield from ((f"{at}.{f}", "a text is expected") for f in ("id", "documentPath") if not _named(fixture.get(f)))
        if _named(fixture.get("id")) and ids[fixture["id"]] > 1:
            yield f"{at}.id", "the id occurs more than once"
        page = fixture.get("page")
        if not (_is_number(page) and isinstance(page, int) and page >= 1):
            yield f"{at}.page", "a page number is expected"
        if fixture.get("split") not in SPLITS:
            yield f"{at}.split", "one of " + ", ".join(SPLITS) + " is expected"
        yield from ((f"{at}.expected{f}", p) for f, p in expectation_problems(fixture.get("expected")))


def manifest_problems(manifests: DataFrame) -> DataFrame:
    """(path, field, problem) of manifests (path, text)."""

    def check(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(path, *p) for path, text in zip(frame["path"], frame["text"], strict=True) for p in problems(text)]
            yield pd.DataFrame(rows, columns=["path", "field", "problem"])

    return manifests.select("path", "text").mapInPandas(check, "path string, field string, problem string")
