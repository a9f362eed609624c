"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import blocks

#: A rank file of a byte-level tokenizer; any other path can be given.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict[int, object] = {}


def encoder(ranks: bytes):
    """The tokenizer of a rank file's content, built once per worker."""
    key = hash(ranks)
    if key not in _ENCODERS:
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _ENCODERS[key] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _ENCODERS[key]


def token_counts(df: DataFrame, text: str, *keep: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The kept columns and ``tokens`` of the whole text (0 for null or empty).  Every row is kept.

    The driver reads the vocabulary (under 1 MB, whatever the data) and sends it along."""
    with open(vocabulary, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([*(df.schema[k] for k in keep), T.StructField("tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(sent.value).encode_ordinary
        for b in blocks(batches, len(keep)):
            counts = [len(encode(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(counts, pa.int64())], names=schema.names)

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
