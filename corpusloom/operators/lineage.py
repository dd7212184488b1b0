"""Artifacts: latest and named entries, fallback between types, lineage, checksums."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import sha256
from ..storage import written


def latest(registry: DataFrame) -> DataFrame:
    """The last published entry of each type: by sequence, not by time."""
    cols = registry.columns
    return registry.groupBy("artifact_type").agg(F.max_by(F.struct(*cols), "seq").alias("e")).select(*[f"e.{c}" for c in cols])


def find(registry: DataFrame, artifact_type: str, artifact_id: str | None = None) -> DataFrame:
    """The last entry of a type, or of one id of it; empty if there is none."""
    rows = registry.where(F.col("artifact_type") == artifact_type)
    if artifact_id is not None:
        rows = rows.where(F.col("artifact_id") == artifact_id)
    return rows.orderBy(F.desc("seq")).limit(1)


def resolve(registry: DataFrame, preferred: str, other: str, artifact_id: str | None = None) -> DataFrame:
    """The last entry of the preferred type, else of the other one."""
    rows = registry.where(F.col("artifact_type").isin(preferred, other))
    if artifact_id is not None:
        rows = rows.where(F.col("artifact_id") == artifact_id)
    return rows.withColumn("_p", (F.col("artifact_type") != preferred).cast("int")).orderBy("_p", F.desc("seq")).limit(1).drop("_p")


def edges(registry: DataFrame) -> DataFrame:
    """artifact_id, input_type, input_id: what each artifact was made from, each edge once."""
    rows = registry.select("artifact_id", F.explode("inputs").alias("i"))
    return rows.select("artifact_id", F.col("i.artifact_type").alias("input_type"), F.col("i.artifact_id").alias("input_id")).where("input_id is not null").distinct()


def closure(registry: DataFrame) -> DataFrame:
    """artifact_id, ancestor, steps: everything an artifact was made from, directly or not, by the shortest way.

    Each round joins the known ways with one another, which doubles their length, and keeps what is
    new; so the rounds grow with the logarithm of the depth and end in a graph with cycles, too.
    Lineage is cut by a written table every round.
    """
    known = written(edges(registry).select("artifact_id", F.col("input_id").alias("ancestor"), F.lit(1).alias("steps")).distinct(), "edges")
    while True:
        on = known.select(F.col("artifact_id").alias("_from"), F.col("ancestor").alias("_to"), F.col("steps").alias("_more"))
        further = known.join(on, F.col("ancestor") == F.col("_from")).groupBy("artifact_id", F.col("_to").alias("ancestor")).agg(F.min(F.col("steps") + F.col("_more")).alias("steps"))
        fresh = written(further.join(known, ["artifact_id", "ancestor"], "left_anti"), "lineage")
        if fresh.isEmpty():
            return known
        known = known.unionByName(fresh)


def input_of(registry: DataFrame, artifact_id: str, input_type: str) -> DataFrame:
    """The input of a type that an artifact names, the first listed."""
    entry = registry.where(F.col("artifact_id") == artifact_id).orderBy(F.desc("seq")).limit(1)
    rows = entry.select(F.posexplode("inputs").alias("pos", "i")).where(F.col("i.artifact_type") == input_type)
    return rows.orderBy("pos").limit(1).select(F.col("i.artifact_id").alias("artifact_id"), F.col("i.hash").alias("hash"))


def file_checksums(spark, folder: str, leave_out: tuple[str, ...] = ("artifact_manifest.json",)) -> DataFrame:
    """path, sha256 of each file below a folder, hashed by the executors; path is as a user writes it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    named = files.withColumn("name", F.element_at(F.split("path", "/"), -1))
    return named.where(~F.col("name").isin(*leave_out)).select(_named(F.col("_metadata.file_path")).alias("path"), F.sha2("content", 256).alias("sha256"))


def _named(uri):
    return F.url_decode(F.replace(F.regexp_replace(uri, "^file:/+", "/"), F.lit("+"), F.lit("%2B")))


def digests_of(spark, paths: list[str]) -> DataFrame:
    """path, sha256 of the named files, read in parts by the executors, so files of any size will do.

    Local paths must be on storage that all executors share; others are read by Spark, whole.
    """
    local = [str(p) for p in paths if "://" not in str(p)]
    remote = [str(p) for p in paths if "://" in str(p)]

    def run(batches):
        for batch in batches:
            names = batch.column("path").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sha256(Path(p)) for p in names], pa.string())], ["path", "sha256"])

    listed = spark.createDataFrame([(p,) for p in local], "path string")
    out = listed.repartition(max(1, min(len(local), spark.sparkContext.defaultParallelism * 4)), "path").mapInArrow(run, "path string, sha256 string")
    if remote:
        out = out.unionByName(spark.read.format("binaryFile").load(remote).select("path", F.sha2("content", 256).alias("sha256")))
    return out


def missing(expected: DataFrame, actual: DataFrame, key: str = "path") -> DataFrame:
    return expected.join(actual.select(key), key, "left_anti")


def differing(expected: DataFrame, actual: DataFrame, key: str = "path", value: str = "sha256") -> DataFrame:
    both = expected.join(actual.withColumnRenamed(value, "_actual"), key)
    return both.where(F.col(value) != F.col("_actual")).select(key, F.col(value).alias("expected"), F.col("_actual").alias("actual"))
