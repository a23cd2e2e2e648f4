"""Sizes of texts in tokens of a public tokenizer.

A byte-level BPE never merges across the pieces that its pattern cuts a text into, so a text's size is the sum of its
pieces' sizes, and pieces recur: each worker remembers the sizes of pieces it has met.

Defined cases: null and empty texts have 0 tokens.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER_DIR = os.environ.get("KITLOOM_TOKENIZERS", "/opt/tokenizers")
TOKENIZER = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern by which the public byte-level vocabularies cut a text into pieces.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


#: The largest vocabulary file that is sent to the workers.
MOST_BYTES = 64 << 20


def counter(vocabulary: bytes) -> Callable[[str], int]:
    """A function from a text to its number of tokens, by the content of a vocabulary file."""
    import regex
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    encoding = tiktoken.Encoding("counted", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    pieces = regex.compile(PIECES)
    size = lru_cache(maxsize=1 << 18)(lambda piece: len(encoding.encode_ordinary(piece)))
    return lambda text: sum(map(size, pieces.findall(text)))


def token_counts(df: DataFrame, *, key: str, text: str = "text", keep: tuple[str, ...] = (), tokenizer: str | None = None) -> DataFrame:
    """(key, keep..., n_tokens) of every row. The vocabulary is read by the driver and sent to the workers."""
    vocabulary = Path(tokenizer or os.path.join(TOKENIZER_DIR, TOKENIZER)).read_bytes()
    if len(vocabulary) > MOST_BYTES:
        raise ValueError(f"a vocabulary of more than {MOST_BYTES} bytes")
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(shared.value)
        for batch in batches:
            own = pa.array([tokens(t) if t else 0 for t in batch.column(batch.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], own], names=[*batch.schema.names[:-1], "n_tokens"])

    names = [key, *keep]
    schema = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names) + ", n_tokens bigint"
    return df.select(*names, F.col(text).alias("__text")).mapInArrow(count, schema)
