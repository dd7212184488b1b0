"""SQL functions: corpus_normalise, bpe_encode, bpe_decode, and the table function bpe_tokens."""

from __future__ import annotations

import hashlib
import unicodedata

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.bpe import Codec, codec_of, token_bytes


def register(spark: SparkSession, merges: list[tuple[int, int]], pattern: str, ids: list[int] | None = None, unk: int | None = None) -> None:
    """Registers the functions for one tokenizer.  pattern: a regular expression of the `regex` package."""
    shared = spark.sparkContext.broadcast((list(merges), ids, unk, pattern))
    key = hashlib.sha256(repr((list(merges), ids, unk)).encode()).hexdigest()

    def tokens_of(codec: Codec, expression, text: str) -> list[int]:
        return [t for p in expression.findall(text) for t in codec.piece(p.encode())]

    @F.pandas_udf("string")
    def corpus_normalise(text: pd.Series, form: pd.Series) -> pd.Series:
        def one(t, f):
            if t is None:
                return None
            t = " ".join(t.split())
            return t if f in (None, "none") else unicodedata.normalize(f, t)

        return pd.Series([one(t, f) for t, f in zip(text, form)])

    @F.pandas_udf("array<int>")
    def bpe_encode(text: pd.Series) -> pd.Series:
        import regex

        codec, compiled = codec_of(key, lambda: shared.value[:3]), regex.compile(shared.value[3])
        return text.map(lambda t: None if t is None else tokens_of(codec, compiled, t))

    @F.pandas_udf("string")
    def bpe_decode(tokens: pd.Series) -> pd.Series:
        pairs, table, _, _ = shared.value
        known = token_bytes(pairs)
        back = {t: known[i] for i, t in enumerate(table)} if table else dict(enumerate(known))
        return tokens.map(lambda ts: None if ts is None else b"".join(back.get(t, b"") for t in ts).decode("utf-8", "replace"))

    @F.udtf(returnType="pos int, token int")
    class BpeTokens:
        def __init__(self):
            import regex

            self.codec, self.expression = codec_of(key, lambda: shared.value[:3]), regex.compile(shared.value[3])

        def eval(self, text: str):
            if text is not None:
                yield from enumerate(tokens_of(self.codec, self.expression, text))

    spark.udf.register("corpus_normalise", corpus_normalise)
    spark.udf.register("bpe_encode", bpe_encode)
    spark.udf.register("bpe_decode", bpe_decode)
    spark.udtf.register("bpe_tokens", BpeTokens)
