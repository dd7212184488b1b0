"""Problem 2: duplicates hidden by formatting differences.

`canonical_keys` gives each document the 128-bit key of what is left when white space, letter case,
punctuation and look-alike characters are set aside (forms.py); in texts made of named fields also
the order of the fields, while each value stays with its name.  `Ledger` keeps one row per key with
the number of copies and the earliest representative, in buckets of the key, at a path that outlives
the run.  A new batch is aggregated by itself, full-outer-joined with the buckets it touches, and
only those are read and written anew; a manifest names the folder each bucket is in and the batches
that are in, so that a batch that comes again changes nothing and a write that breaks off leaves the
ledger as it was.

Defined results: null and empty texts, and rows without a doc_id, are left out; a doc_id that comes
more than once counts once; texts without any letter or digit have no key; all other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import codepoints as cp
from . import forms
from .common import digests, map_slices, shared_folder, texts_of, written

#: Named fields from which on a text has an order to set aside.
LEAST_FIELDS = 2
_FIELD = re.compile(r"\s*([^:=]{1,48}?)\s*[:=]\s*(.*)", re.S)
_LETTER = re.compile(r"[^\W_]")
_SPLIT = re.compile(r"[\n;|\t]+")


def fields_of(text: str, least: int = 3) -> list[tuple[str, str]] | None:
    """Name and value of each field of a text made of named fields, else None.

    JSON objects, and "name: value" parts between line breaks, semicolons, bars or tabs.  A part
    without a name carries on the value before it.  Names must differ and, outside JSON, be `least` at least.
    """
    a, b = text.find("{"), text.rfind("}")
    if 0 <= a < b and not _LETTER.search(text, 0, a) and not _LETTER.search(text, b):
        try:
            found = json.loads(text[a : b + 1])
        except (ValueError, RecursionError):  # not JSON, or nested too deep
            found = None
        if isinstance(found, dict) and found:
            return [(str(k), v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, sort_keys=True)) for k, v in found.items()]
    out: list[tuple[str, str]] = []
    loose = 0
    for part in _SPLIT.split(text):
        m = _FIELD.fullmatch(part)
        if m and len(m[1].split()) <= 4:
            out.append((m[1], m[2]))
        elif part.strip():
            if not out:
                return None
            loose += 1
            out[-1] = (out[-1][0], out[-1][1] + " " + part)
    if len(out) < least or loose > len(out) or len({n for n, _ in out}) < len(out):
        return None
    return out


def canonical_batch(cps: np.ndarray, starts: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The canonical characters of each text of a folded batch; empty where no letter or digit is left.

    mask: forms.letter_mask of the batch.
    """
    signs = cp.sums((cps == ord(":")) | (cps == ord("=")), starts)
    plain, ends = cp.keep(mask, cps, starts)
    maybe = np.flatnonzero(signs >= 2)
    if not len(maybe):
        return plain, ends
    found = [(i, f) for i in maybe.tolist() if (f := fields_of("".join(map(chr, cps[starts[i] : starts[i + 1]])) if starts[i + 1] - starts[i] < 64 else cps[starts[i] : starts[i + 1]].tobytes().decode("utf-32-le", "surrogatepass"), LEAST_FIELDS)) and (len(f) > 1 or signs[i] > 2)]
    if not found:
        return plain, ends
    clean = iter(forms.letters([s for _, f in found for pair in f for s in pair]))
    texts = cp.to_strings(plain, ends)
    for i, f in found:
        # A control character, which no kept character equals, stands between names and values.
        texts[i] = "\x01".join(sorted(next(clean) + "\x02" + next(clean) for _ in f))
    return cp.from_strings(texts)


def key_digests(cps: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    return [k if n else None for k, n in zip(digests(cps, starts), np.diff(starts).tolist())]


def canonical_keys(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, key: the 128-bit canonical key of every text that has one."""
    kind = dict(df.dtypes)[id_col]

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        cps, starts = forms.folded(*cp.from_arrow(part.column(1)))
        keys = key_digests(*canonical_batch(cps, starts, forms.letter_mask(cps, starts)))
        return pa.RecordBatch.from_arrays([part.column(0), pa.array(keys, pa.binary())], ["id", "key"])

    source = texts_of(df.select(F.col(id_col).alias("id"), F.col(text).alias("text")).where(F.col("id").isNotNull()), "id")
    return map_slices(source, "text", make, f"id {kind}, key binary").where(F.col("key").isNotNull()).withColumnRenamed("id", id_col)


class Ledger:
    """Copies and earliest representative per canonical key, in buckets, at a path all executors share.

    buckets counts for a new ledger only; an existing one keeps its own.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 8, id_type: str = "string"):
        self.spark, self.path = spark, path.rstrip("/")
        self.state = self._newest() or {"buckets": buckets, "id_type": id_type, "batches": [], "folders": {}}

    def _files(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _newest(self) -> dict | None:
        where, fs = self._files(self.path)
        if not fs.exists(where):
            return None
        names = sorted(f.getPath().toString() for f in fs.listStatus(where) if re.fullmatch(r"manifest-\d{8}\.json", f.getPath().getName()))
        return json.loads(self.spark.read.text(names[-1], wholetext=True).first()[0]) if names else None

    def _commit(self, state: dict) -> None:
        """The manifest, written beside and renamed: a ledger is as it was or as it is."""
        name = f"{self.path}/manifest-{len(state['batches']):08d}.json"
        part, fs = self._files(name + ".part")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not fs.rename(part, self._files(name)[0]):
            raise OSError(f"{name} is there already: another run added a batch")
        self.state = state

    @property
    def schema(self) -> str:
        return f"key binary, copies bigint, keep_id {self.state['id_type']}, bucket int"

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The ledger's rows, of some buckets only where given."""
        held = {b: f for b, f in self.state["folders"].items() if buckets is None or int(b) in buckets}
        if not held:
            return self.spark.createDataFrame([], self.schema)
        columns = self.schema.rsplit(",", 1)[0]
        rows = self.spark.read.schema(columns).parquet(*[f"{self.path}/{f}/bucket={b}" for b, f in held.items()])
        return rows.withColumn("bucket", self._bucket("key"))

    def _bucket(self, key: str):
        return F.pmod(F.xxhash64(key), F.lit(self.state["buckets"])).cast("int")

    def batch(self, keys: DataFrame, id_col: str) -> DataFrame:
        """One row per key of the batch.  Spread over (key, id) first, so no hot key meets one task."""
        once = keys.select("key", F.col(id_col).alias("id")).distinct()
        counts = once.groupBy("key").agg(F.count("id").alias("copies"), F.min("id").alias("keep_id"))
        return counts.withColumn("bucket", self._bucket("key"))

    def add(self, keys: DataFrame, name: str, id_col: str = "doc_id") -> Ledger:
        """Brings in the batch of that name; one that is in already changes nothing.  No id may come in two batches."""
        if name in self.state["batches"]:
            return self
        new = written(self.batch(keys, id_col), "ledger-batch")
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most the number of buckets
        old, n = self.read(touched).alias("o"), new.alias("n")
        both = old.join(n, ["bucket", "key"], "full_outer").select(
            "key",
            (F.coalesce("o.copies", F.lit(0)) + F.coalesce("n.copies", F.lit(0))).alias("copies"),
            F.least("o.keep_id", "n.keep_id").alias("keep_id"),  # least() skips nulls
            "bucket",
        )
        folder = f"batch-{len(self.state['batches']):08d}"
        if touched:
            both.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/{folder}")
        self._commit(self.state | {"batches": [*self.state["batches"], name], "folders": self.state["folders"] | {str(b): folder for b in touched}})
        return self


#: Keys of one bucket of a new ledger.
BUCKET_KEYS = 500_000
#: Keys that hold this part of all rows are joined without a shuffle; there are no more of them than its inverse.
HOT = 1000


def copy_ledger(keys: DataFrame, id_col: str = "doc_id", batches: int = 2, buckets: int | None = None, path: str | None = None) -> Ledger:
    """A ledger over all keys, brought in as batches; a doc_id's rows always share a batch.  keys is a written table."""
    spark = keys.sparkSession
    buckets = buckets or max(8, -(-keys.count() // BUCKET_KEYS))
    ledger = Ledger(spark, path or shared_folder(spark, "ledger"), buckets, dict(keys.dtypes)[id_col])
    for b in range(batches):
        ledger.add(keys.where(F.pmod(F.xxhash64(id_col), F.lit(batches)) == b), f"{b} of {batches}", id_col)
    return ledger


def copy_counts(df: DataFrame, id_col: str = "doc_id", text: str = "text", batches: int = 2) -> DataFrame:
    """keep_doc_id, copies: one record for each group of equal documents, single ones included."""
    keys = written(canonical_keys(df, id_col, text), "keys")
    return copy_ledger(keys, id_col, batches).read().select(F.col("keep_id").alias("keep_doc_id"), "copies")


def hidden_copies(df: DataFrame, id_col: str = "doc_id", text: str = "text", batches: int = 2) -> DataFrame:
    """keep_doc_id, copy_doc_id: every further document of each group of equal documents."""
    keys = written(canonical_keys(df, id_col, text), "keys")
    groups = copy_ledger(keys, id_col, batches).read().where("copies > 1")
    # The hot keys, at most HOT of them, are broadcast; of the others none holds more rows than one part in HOT.
    share = keys.count() / HOT
    hot = groups.where(F.col("copies") > share).select(F.col("key").alias("hot_key"), F.col("keep_id").alias("hot_keep"))
    marked = keys.join(F.broadcast(hot), F.col("key") == F.col("hot_key"), "left")
    found = marked.where("hot_key is not null").select(F.col("hot_keep").alias("keep_doc_id"), F.col(id_col).alias("copy_doc_id"))
    rest = marked.where("hot_key is null").select("key", id_col).join(groups.where(F.col("copies") <= share).select("key", "keep_id"), "key")
    found = found.unionByName(rest.select(F.col("keep_id").alias("keep_doc_id"), F.col(id_col).alias("copy_doc_id")))
    return found.where("copy_doc_id <> keep_doc_id").distinct()
