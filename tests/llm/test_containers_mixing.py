import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import containers, mixing
from corpusloom.llm.tokens import VOCABULARY, token_counts

needs_vocabulary = pytest.mark.skipif(not Path(VOCABULARY).exists(), reason="no vocabulary file")


@pytest.mark.parametrize(("capacity", "kind"), [(128, "even"), (100, "thirds"), (512, "small"), (64, "large"), (1, "ones")])
def test_pack(capacity, kind):
    rng = np.random.default_rng(0)
    n = 3000
    lengths = {"even": rng.integers(1, capacity + 1, n), "thirds": rng.choice([34, 33, 32, 50], n), "small": rng.integers(1, 20, n), "large": rng.integers(40, 65, n), "ones": np.ones(n, int)}[kind]
    lengths = np.sort(lengths)[::-1].astype(np.int64)
    box = containers.pack(lengths, capacity)
    load = np.bincount(box, weights=lengths)
    assert (box >= 0).all() and load.max() <= capacity and (load > 0).all()
    # Against lower bounds: the space, and items of which no two share a container.
    bound = max(-(-lengths.sum() // capacity), (lengths > capacity // 2).sum())
    assert len(load) <= bound * 1.06 + 2


@pytest.mark.parametrize("n", [1, 2, 3, 9, 40])
def test_few_items_are_packed_the_same_way(n):
    lengths = np.sort(np.random.default_rng(n).integers(20, 101, n))[::-1].astype(np.int64)
    box = containers.pack(lengths, 100)
    assert (box >= 0).all() and np.bincount(box, weights=lengths).max() <= 100


def test_contain(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([0, 1, 5, 60, 100, 129, 1000])) for i in range(400)] + [(None, 3)]
    counts = spark.createDataFrame([(*r, 9, "x") for r in rows], "doc_id bigint, tokens bigint, size int, place string").where("doc_id is not null")
    plans = spark.createDataFrame([(1, 100, True), (2, 64, False), (3, 0, True), (None, 5, True)], "plan_id int, seq_len int, append_eos boolean")
    got = containers.contain(counts.select("doc_id", "tokens"), plans, shard_items=150).cache()
    for plan, cap, eos in ((1, 100, 1), (2, 64, 0)):
        mine = got.where(F.col("plan_id") == plan)
        per_doc = {r["doc_id"]: r["n"] for r in mine.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
        assert per_doc == {i: t + eos for i, t in rows if t and i is not None}
        assert mine.groupBy("container").agg(F.sum("length").alias("n"), F.max(F.col("place") + F.col("length")).alias("m")).where(f"n > {cap} or n <> m").count() == 0
        # A document that fits is never split.
        assert mine.groupBy("doc_id").agg(F.count("*").alias("k"), F.sum("length").alias("n")).where(f"n <= {cap} and k > 1").count() == 0
    assert got.where("plan_id not in (1, 2)").count() == 0
    assert all(0.9 < r["used"] <= 1 for r in containers.usage(got, plans).collect())
    assert containers.contain(counts.where("false").select("doc_id", "tokens"), plans).count() == 0
    assert containers.contain(counts.select("doc_id", "tokens"), plans.where("false")).count() == 0


@needs_vocabulary
def test_token_counts(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, None), (3, ""), (4, "<|endoftext|>"), (None, "x")], "doc_id bigint, text string")
    got = {r["doc_id"]: r["tokens"] for r in token_counts(df).collect()}
    assert set(got) == {1, 4} and got[1] == 2 and got[4] > 1


def test_budgets():
    got = mixing.budgets({"a": 100, "b": 1000}, {"a": (0.5, 2), "b": (0.25, 1), "none": (0.25, 3)})
    assert got["a"] == pytest.approx(200) and got["b"] == pytest.approx(100)
    assert mixing.budgets({"a": 10, "b": 1000}, {"a": (0.5, 2), "b": (0.5, 1)}, total=400) == {"a": 20.0, "b": 380.0}
    assert mixing.budgets({"a": 10}, {"a": (0.5, 2)}, total=400) == {"a": 20.0}
    assert mixing.budgets({}, {"a": (1.0, 1)}) == {} and mixing.budgets({"a": 5}, {"a": (0.0, 1)}) == {} and mixing.budgets({"a": 5}, {"a": (1.0, None)}) == {}


@needs_vocabulary
def test_mix(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["the goose", "a mill", "of rivers", "was found"])
    rows = [(i, " ".join(word() for _ in range(rng.randint(5, 30))), rng.choice("aaaabbc")) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", "b"), (None, "x y", "a"), (1002, "x y", None), (1003, "x y", "unlisted"), rows[0]]
    df = spark.createDataFrame([(*r, 1.0, "k") for r in rows], "doc_id bigint, text string, source string, weight double, tokens string")
    mixture = spark.createDataFrame([("a", 0.3, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("missing", 0.2, 1), ("zero", 0.0, 1), (None, 0.5, 1)], "source string, target_weight double, max_epochs int")
    chosen, report = mixing.mix(df, mixture, range_items=100)
    rows = chosen.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and all(r["doc_id"] is not None and r["doc_id"] < 1000 for r in rows)
    shares = {r["source"]: r for r in report.collect()}
    assert set(shares) == {"a", "b", "c", "missing", "zero"} and shares["missing"]["share"] == shares["zero"]["share"] == 0
    for s, target in (("a", 0.375), ("b", 0.375), ("c", 0.25)):
        assert abs(shares[s]["share"] - target) < 0.01 and shares[s]["most_repeats"] <= shares[s]["max_epochs"]
    for s in "abc":  # complete epochs come first: repeats differ by one at most
        reps = {r["repeats"] for r in rows if r["source"] == s}
        assert max(reps) - min(reps) <= 1
    again = mixing.mix(df.repartition(3), mixture, range_items=7)[0].collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    empty, none = mixing.mix(df.where("false"), mixture)
    assert empty.count() == 0 and none.count() == 5
