"""Problem 8: mixing sources to target weights.

Efraimidis-Spirakis sampling: each document has the key -ln(u) / w, u a uniform number from a hash
of its id and w its quality weight; within a source documents are taken in the order of the keys
while the running sum of tokens stays within the budget.  Complete epochs come before the
fractional selection, which decides who is repeated once more.

Budgets: with no total given, the largest total at which every source that has documents reaches
its share (weights scaled to the sources that have some).  With a total, each source gets its share
of it, at most max_epochs times its tokens; what one lacks goes to the others by weight.

Running sums are two-level (operators/prefix.py): documents are cut into ranges of the keys at sampled
quantiles, as many as the data needs, sums per range are accumulated first, then within each range;
no source, however large, and no crowd of like weights meets in one task.

Defined results: null and empty texts, null ids and sources that are null or not listed are left
out; a source listed without documents, a null or non-positive weight, and max_epochs below 1 give
nothing, with share 0 in the report; a source listed twice counts once, with the larger weight.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.prefix import running_sum
from . import codepoints as cp
from . import quality
from .common import map_slices, texts_of, written
from .tokens import PATTERN, VOCABULARY, encoder, share_vocabulary

#: Documents of one range of keys.
RANGE_ITEMS = 50_000


def weighed(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """source, id, tokens and quality weight of every document, in one pass over the texts.

    The weight lies between 0.05 and 1: the less of a text is items, fields, numbers or odd words,
    the more.
    """
    kinds = dict(df.dtypes)
    parts = [quality.STATS.index(s) for s in ("item_share", "short_line_share", "field_share", "odd_share", "symbol_ratio", "digit_share")]
    shared, digest = share_vocabulary(df.sparkSession, vocabulary)

    def make(part: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(digest, shared.value, pattern).encode_ordinary
        stats, _ = quality.batch_statistics(*cp.from_arrow(part.column("text")))
        tokens = pa.array([len(encode(t)) for t in part.column("text").to_pylist()], pa.int64())
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), tokens, pa.array(np.clip(np.exp(-2.0 * stats[:, parts].sum(1)), 0.05, 1.0))], ["source", "id", "tokens", "weight"])

    picked = texts_of(df.select(F.col(source).alias("source"), F.col(id_col).alias("id"), F.col(text).alias("text")).where("id is not null and source is not null"), "source", "id")
    return map_slices(picked, "text", make, f"source {kinds[source]}, id {kinds[id_col]}, tokens bigint, weight double").withColumnRenamed("id", id_col)


def budgets(tokens: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """Tokens that each source gives.  tokens: of its documents; targets: weight and most epochs."""
    room = {s: float(tokens.get(s, 0)) * max(0, e or 0) for s, (w, e) in targets.items() if w and w > 0}
    room = {s: r for s, r in room.items() if r > 0}
    weight = {s: targets[s][0] for s in room}
    if not room:
        return {}
    scale = sum(weight.values())
    if total is None:
        total = min(room[s] * scale / weight[s] for s in room)
        return {s: total * weight[s] / scale for s in room}
    out: dict[str, float] = {}
    left, open_ = float(total), dict(weight)
    while open_:
        scale = sum(open_.values())
        full = [s for s in open_ if left * open_[s] / scale >= room[s]]
        if not full:
            out |= {s: left * open_[s] / scale for s in open_}
            break
        for s in full:
            out[s] = room[s]
            del open_[s]
        left = max(0.0, float(total) - sum(out.values()))
    return out


def _targets(mixture: DataFrame) -> dict[str, tuple[float, int]]:
    """Weight and epochs by source: a table of a fixed, small number of rows (at most 10000)."""
    rows = mixture.where("source is not null").groupBy("source").agg(F.max(F.struct("target_weight", "max_epochs")).alias("t")).limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10000 sources in the mixture")
    return {r["source"]: (r["t"]["target_weight"] or 0.0, r["t"]["max_epochs"] or 0) for r in rows}


def mix(df: DataFrame, mixture: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", total: float | None = None, seed: int = 42, range_items: int = RANGE_ITEMS) -> tuple[DataFrame, DataFrame]:
    """The chosen documents (source, id, tokens, repeats) and the shares reached (one row a source)."""
    spark = df.sparkSession
    targets = _targets(mixture)
    inside = df.where(F.col(source).isin(*targets)) if targets else df.where("false")
    docs = weighed(inside, id_col, text, source)
    # One uniform number from 52 bits of a hash; never 0.
    u = (F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1))
    docs = written(docs.select("source", id_col, "tokens", (-F.log(u) / F.col("weight")).alias("key")).dropDuplicates([id_col]), "mixture")
    sums = {r["source"]: (r["t"], r["n"]) for r in docs.groupBy("source").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).collect()}  # at most one row a listed source
    budget = budgets({s: t for s, (t, _) in sums.items()}, targets, total)
    plan = spark.createDataFrame([(s, float(b), int(b // sums[s][0]), float(b - b // sums[s][0] * sums[s][0])) for s, b in budget.items()], "source string, budget double, epochs bigint, part double")
    ranges = max(1, -(-sum(n for _, n in sums.values()) // range_items))
    run = running_sum(docs, F.col("tokens"), ["key", id_col], ["source"], name="before", ranges=ranges)
    placed = run.join(F.broadcast(plan), "source")  # one row a listed source, at most 10000
    # The document on the edge is taken if that leaves the sum nearer to the budget.
    more = (F.col("before") + F.col("tokens") / 2) <= F.col("part")
    chosen = placed.select("source", id_col, "tokens", (F.col("epochs") + more.cast("bigint")).alias("repeats")).where("repeats > 0")
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("repeats")).alias("used"), F.max("repeats").alias("most_repeats"), F.count("*").alias("documents"))
    goal = spark.createDataFrame([(s, float(w), int(e)) for s, (w, e) in targets.items()], "source string, target double, max_epochs bigint")
    whole = Window.partitionBy(F.lit(1))  # a row a listed source
    report = goal.join(used, "source", "left").select("source", "target", "max_epochs", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "used", "most_repeats")])
    return chosen, report.withColumn("share", F.coalesce(F.col("used") / F.sum("used").over(whole), F.lit(0.0)))
