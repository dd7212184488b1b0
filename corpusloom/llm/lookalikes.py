"""Problem 5: visually identical text with different characters.

`consistent_forms` gives each text its one consistent form (see forms.py) by table lookups over
whole batches, once per distinct value of a batch.  `lookalike_pairs` lists the pairs of documents
whose texts differ as character sequences and have the same form.

Defined results: null and empty texts have the null form and belong to no pair; a doc_id that comes
more than once counts once; rows with a null doc_id belong to no pair; other columns of the input,
whatever their names, are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import codepoints as cp
from . import forms
from .common import digests, map_slices, spread, texts_of, written

#: Rows of one form that one part of the join takes.
SALT_ROWS = 20_000


def consistent_forms(df: DataFrame, id_col: str = "doc_id", text: str = "text", fold: bool = False) -> DataFrame:
    """id, form: the consistent form of every row's text; with fold also letter case is set aside."""
    kind = dict(df.dtypes)[id_col]

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(1).to_pylist()
        out = iter(forms.visual_strings([t for t in texts if t], fold))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([next(out) if t else None for t in texts], pa.string())], ["id", "form"])

    rows = map_slices(spread(df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))), "text", make, f"id {kind}, form string")
    return rows.withColumnRenamed("id", id_col)


def form_keys(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, form_key, raw_key: 128-bit keys of the consistent form and of the characters as they are."""
    kind = dict(df.dtypes)[id_col]

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        kinds = part.column(1).cast(pa.large_string()).dictionary_encode()  # once per distinct value
        cps, starts = cp.from_arrow(kinds.dictionary)
        raw, form = digests(cps, starts), digests(*forms.visual(cps, starts))
        at = kinds.indices
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(form, pa.binary()).take(at), pa.array(raw, pa.binary()).take(at)], ["id", "form_key", "raw_key"])

    source = texts_of(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull()), "id")
    return map_slices(source, "text", make, f"id {kind}, form_key binary, raw_key binary").withColumnRenamed("id", id_col)


def lookalike_pairs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id_a < doc_id_b of each pair with one consistent form and different characters.

    Shuffles carry keys and ids only.  Forms with a single writing leave before pairs are built.
    The pairs come from a join salted by the number of rows of the form: a hot form's rows are
    spread over as many parts as it needs, one side in each, the other in all.
    """
    keys = written(form_keys(df, id_col, text).distinct(), "form-keys")
    writings = keys.groupBy("form_key", "raw_key").agg(F.count("*").alias("n"))
    forms_ = writings.groupBy("form_key").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).where("kinds > 1")
    salted = forms_.select("form_key", F.ceil(F.col("n") / SALT_ROWS).cast("int").alias("salts"))
    met = keys.join(salted, "form_key")
    a = met.select("form_key", F.col("raw_key").alias("raw_a"), F.col(id_col).alias("x"), F.pmod(F.xxhash64(id_col), F.col("salts")).cast("int").alias("salt"))
    b = met.select("form_key", F.col("raw_key").alias("raw_b"), F.col(id_col).alias("y"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    both = a.join(b, ["form_key", "salt"]).where(F.col("raw_a") < F.col("raw_b"))
    return both.select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b")).distinct()


def lookalike_links(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, class_id, links: one row for each document whose form has several writings, and how many documents write it otherwise."""
    keys = written(form_keys(df, id_col, text).distinct(), "form-keys")
    writings = keys.groupBy("form_key", "raw_key").agg(F.count("*").alias("n"))
    forms_ = writings.groupBy("form_key").agg(F.sum("n").alias("all")).join(writings, "form_key").where("all > n")
    linked = forms_.select("form_key", "raw_key", (F.col("all") - F.col("n")).alias("links"))
    return keys.join(linked, ["form_key", "raw_key"]).groupBy(id_col).agg(F.lower(F.hex(F.min("form_key"))).alias("class_id"), F.max("links").alias("links"))
