"""Lines of text files with their numbers, from any storage Spark reads, in splits of large files.

The text source gives lines; a line's place is that of its block in the file and its place in the
block.  Blocks are counted first (one row a block), so numbering shuffles no text.  newline
"universal" ends lines at LF, CR and CRLF and drops the end; "lf" ends them at LF only and keeps it.
Gzip by the file's ending.  Bad bytes by decode_errors.  A byte order mark at a file's start is dropped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T


def _plain(path: str) -> str:
    """The path for a reader that takes globs."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", str(path))


def _named(uri: Column) -> Column:
    """The path as a user writes it: no scheme for local files, nothing escaped."""
    return F.url_decode(F.replace(F.regexp_replace(uri, "^file:/+", "/"), F.lit("+"), F.lit("%2B")))


def _ended(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, ended: whether the content of each gzip file ends with a line feed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for content in batch.column("content"):
                rest, last = content.as_buffer().to_pybytes(), b""
                while rest:  # members one after another, in parts of bounded size
                    unzip = zlib.decompressobj(31)
                    while not unzip.eof and (rest or unzip.unconsumed_tail):
                        last = unzip.decompress(unzip.unconsumed_tail or rest, 1 << 20) or last
                        rest = b""
                    rest = unzip.unused_data
                out.append(last.endswith(b"\n"))
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(out)], ["file", "ended"])

    raw = spark.read.format("binaryFile").load([_plain(p) for p in paths])
    return raw.select(F.col("_metadata.file_path").alias("file"), "content").mapInArrow(run, "file string, ended boolean")


def read_lines(spark: SparkSession, paths: list[str], newline: str = "universal", decode_errors: str = "replace") -> DataFrame:
    """source, line_no (from 1), text."""
    if not paths:
        return spark.createDataFrame([], "source string, line_no bigint, text string")
    reader = spark.read if newline == "universal" else spark.read.option("lineSep", "\n")
    raw = reader.text([_plain(p) for p in paths]).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("at"))
    # The rows of a block follow one another in one task.
    blocks = raw.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"), F.max("size").alias("size"))
    file = Window.partitionBy("file")  # a row a block
    placed = blocks.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), "first",
        (F.sum("n").over(file.orderBy("block")) - F.col("n")).alias("before"),
        F.sum("n").over(file).alias("lines"),
        (F.sum("bytes").over(file) - F.col("size")).isin(0, -3).alias("ended"),  # -3: a byte order mark
    )
    zipped = [str(p) for p in paths if str(p).lower().endswith(".gz")]
    if newline != "universal" and zipped:
        flags = _ended(spark, zipped).select(F.col("file").alias("_gz"), F.col("ended").alias("_e"))
        placed = placed.join(flags, F.col("_file") == F.col("_gz"), "left").withColumn("ended", F.coalesce("_e", "ended")).drop("_gz", "_e")
    rows = raw.join(placed, (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block")))
    line = F.col("before") + F.col("at") - F.col("first") + 1
    text = T.decode_bytes(F.col("value").cast("binary"), decode_errors)
    if newline != "universal":
        text = F.when((line == F.col("lines")) & ~F.col("ended"), text).otherwise(F.concat(text, F.lit("\n")))
    return rows.select(_named(F.col("file")).alias("source"), line.alias("line_no"), text.alias("text"))


def json_text(line: Column, field: str = "text") -> Column:
    """The field of a JSON object if it is a string, else null: bad JSON, other types and arrays give null."""
    parsed = F.try_parse_json(line)
    value = F.try_variant_get(parsed, f"$['{field}']" if not field.isidentifier() else f"$.{field}", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(parsed, f"$['{field}']" if not field.isidentifier() else f"$.{field}", "string"))


def corpus_lines(spark: SparkSession, paths: list[str], input_format: str = "text", field: str = "text", decode_errors: str = "replace") -> DataFrame:
    """source, line_no, text.  Of JSON lines, those blank, bad or without a text are left out before anything is counted."""
    lines = read_lines(spark, paths, decode_errors=decode_errors)
    if input_format == "text":
        return lines
    if input_format != "jsonl":
        raise ValueError("input_format must be text or jsonl")
    return lines.where(F.trim("text") != "").withColumn("text", json_text(F.col("text"), field)).where(F.col("text").isNotNull())


def training_lines(spark: SparkSession, paths: list[str], input_format: str = "text", field: str = "text", decode_errors: str = "replace") -> DataFrame:
    """source, line_no, text for counting: line ends kept, and failures of JSON empty instead of left out."""
    lines = read_lines(spark, paths, newline="lf", decode_errors=decode_errors)
    return lines if input_format == "text" else lines.withColumn("text", F.coalesce(json_text(F.col("text"), field), F.lit("")))
