"""Token counts by a public tokenizer whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import hashlib
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_slices, texts_of

#: Vocabulary as lines of base64 token and rank.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the splitting pattern that goes with byte-level vocabularies of this kind.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


_loaded: dict[tuple[str, str], object] = {}


def encoder(digest: str, data: bytes, pattern: str):
    """The tokenizer of a vocabulary file's content, made once in each worker."""
    import tiktoken

    if (digest, pattern) not in _loaded:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}
        _loaded[digest, pattern] = tiktoken.Encoding(digest, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _loaded[digest, pattern]


def share_vocabulary(spark: SparkSession, vocabulary: str):
    """The vocabulary file, of a fixed size below a megabyte, broadcast, and its digest."""
    data = Path(vocabulary).read_bytes()
    return spark.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()


def token_counts(df: DataFrame, id_col: str = "doc_id", *carried: str, text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """id, the carried columns and tokens of every row whose text has at least one character.

    Special tokens' names in a text are ordinary text.
    """
    kinds = dict(df.dtypes)
    shared, digest = share_vocabulary(df.sparkSession, vocabulary)

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(digest, shared.value, pattern).encode_ordinary
        counts = [len(encode(t)) for t in part.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(counts, pa.int64())], [*part.schema.names[:-1], "tokens"])

    picked = texts_of(df.select(F.col(id_col).alias(id_col), *carried, F.col(text).alias("text")).where(F.col(id_col).isNotNull()), id_col, *carried)
    return map_slices(picked, "text", make, ", ".join(f"`{c}` {kinds[c]}" for c in (id_col, *carried)) + ", tokens bigint")
