import random

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import corpus, evaluation, lineage, shards
from corpusloom.operators.prefix import ordinal, running_sum


def test_running_sum_is_any_order(spark):
    rng = random.Random(1)
    data = [(g, k, rng.choice([None, 0, 1, 5])) for g in ("a", "b", None) for k in range(40)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "g string, k int, v int").repartition(5)
    got = {(r["g"], r["k"]): r["before"] for r in running_sum(df, F.col("v"), ["k"], ["g"], ranges=7).collect()}
    for g in ("a", "b", None):
        total = 0
        for k, v in sorted((k, v) for x, k, v in data if x == g):
            assert got[g, k] == total
            total += v or 0
    assert sorted(r["ord"] for r in ordinal(df.select("k").distinct(), ["k"]).collect()) == list(range(40))
    assert running_sum(df.where("false"), F.col("v"), ["k"]).count() == 0


def test_cap_counts_kept_rows(spark):
    df = spark.createDataFrame([(0, "long enough"), (1, "x"), (2, None), (3, "also long enough"), (4, "y"), (5, "third long one")], "line int, text string")
    got = corpus.kept_prefix(df, 2, ["line"], 5).orderBy("line").collect()
    assert [(r["line"], r["kept"]) for r in got] == [(0, True), (1, False), (2, False), (3, True)]


def test_exact_dedup_keeps_the_smallest_id(spark):
    df = spark.createDataFrame([("b", "t", 1), ("a", "t", 2), ("c", None, 3), ("d", None, 4), ("e", "", 5)], "doc_id string, text string, copies_in int")
    got = {r["doc_id"]: (r["text"], r["copies_in"], r["copies"]) for r in corpus.exact_dedup(df).collect()}
    assert got == {"a": ("t", 2, 2), "c": (None, 3, 2), "e": ("", 5, 1)}
    assert tuple(corpus.dedup_stats(df).first()) == (5, 3, 2)
    assert tuple(corpus.dedup_stats(df.where("false")).first()) == (0, 0, 0)


@pytest.mark.parametrize("seq_len", [1, 4, 7])
def test_packed_blocks_hold_the_stream(spark, seq_len):
    rng = random.Random(seq_len)
    docs = [(f"d{i:03d}", rng.choice(["train", "val"]), [rng.randint(0, 9) for _ in range(rng.randint(0, 23))]) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id string, split string, tokens array<int>").repartition(4)
    got = {(r["split"], r["block_id"]): r["tokens"] for r in shards.packed_blocks(df, seq_len, ["doc_id"]).collect()}
    expect = {}
    for split in ("train", "val"):
        stream = [t for _, s, ts in sorted(docs) if s == split for t in ts]
        expect |= {(split, b): stream[b * seq_len : (b + 1) * seq_len] for b in range(len(stream) // seq_len)}
    assert got == expect


def test_packed_counts_have_both_splits(spark):
    df = spark.createDataFrame([("train", 9), ("train", None)], "split string, length int")
    assert {r["split"]: tuple(r)[1:] for r in shards.packed_counts(df, 4).collect()} == {"train": (9, 2, 8), "val": (0, 0, 0)}


def test_shards(spark):
    df = spark.createDataFrame([(f"d{i}", 10 + i) for i in range(5)], "doc_id string, length int")
    got = [(r["doc_id"], r["shard"], r["start"]) for r in shards.sharded(df, 2, ["doc_id"]).orderBy("doc_id").collect()]
    assert got == [("d0", 0, 0), ("d1", 0, 10), ("d2", 1, 0), ("d3", 1, 12), ("d4", 2, 0)]
    ended = shards.with_end(spark.createDataFrame([([1],)], "tokens array<int>"), None)
    assert tuple(ended.first()) == ([1], False)


def test_block_size_is_checked(spark):
    df = spark.createDataFrame([([1, 2],)], "tokens array<int>")
    assert shards.require_blocks(df, 2).count() == 1
    with pytest.raises(Exception, match="expected 3"):
        shards.require_blocks(df, 3).collect()


REGISTRY = "seq bigint, created_at string, artifact_type string, artifact_id string, inputs array<struct<artifact_type: string, artifact_id: string, hash: string>>"


def test_registry(spark):
    rows = [(0, "2025-03", "corpus", "c1", []), (1, "2025-01", "corpus", "c2", [("raw_files", "raw", None)]), (2, "2025-02", "tokens", "t1", [("corpus", "c2", "h")]), (3, "2025-02", "packed", "p1", [("tokens", "t1", "x")])]
    reg = spark.createDataFrame(rows, REGISTRY)
    assert lineage.find(reg, "corpus").first()["artifact_id"] == "c2"
    assert lineage.find(reg, "corpus", "c1").first()["seq"] == 0
    assert lineage.find(reg, "model").count() == 0
    assert lineage.resolve(reg, "corpus_dedup", "corpus").first()["artifact_id"] == "c2"
    assert {r["artifact_type"]: r["seq"] for r in lineage.latest(reg).collect()} == {"corpus": 1, "tokens": 2, "packed": 3}
    assert {(r["artifact_id"], r["ancestor"], r["steps"]) for r in lineage.closure(reg).collect()} == {("c2", "raw", 1), ("t1", "c2", 1), ("t1", "raw", 2), ("p1", "t1", 1), ("p1", "c2", 2), ("p1", "raw", 3)}
    assert lineage.input_of(reg, "p1", "tokens").first()["artifact_id"] == "t1"
    assert lineage.closure(reg.where("false")).count() == 0


def test_checksums(spark):
    want = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, sha256 string")
    have = spark.createDataFrame([("a", "1"), ("b", "9")], "path string, sha256 string")
    assert [r["path"] for r in lineage.missing(want, have).collect()] == ["c"]
    assert [tuple(r) for r in lineage.differing(want, have).collect()] == [("b", "2", "9")]


def test_evaluation(spark):
    losses = spark.createDataFrame([(1.0,), (3.0,), (None,)], "loss double")
    r = evaluation.perplexity(losses).first()
    assert r["eval_loss"] == 2.0 and abs(r["perplexity"] - 7.389056) < 1e-5 and r["num_samples"] == 2
    assert evaluation.perplexity(losses.where("false")).first()["eval_loss"] is None
    blocks = spark.range(5).withColumnRenamed("id", "block_id")
    drawn = evaluation.batches(blocks, 5, 10, 4)
    assert drawn.count() == 40 and drawn.select("step").distinct().count() == 10
    snaps = spark.createDataFrame([(1, True, "c", "p"), (2, False, "c", "p"), (3, True, "x", "p")], "merge_index int, valid boolean, config_hash string, pattern_hash string")
    assert evaluation.newest_valid(snaps, "c", "p").first()["merge_index"] == 1
    assert [r["merge_index"] for r in evaluation.keep_last(snaps, 2).collect()] == [3, 2]
    texts = spark.createDataFrame([(f"l{i}",) for i in range(30)], "text string")
    assert evaluation.sample_lines(texts, 7).collect() == evaluation.sample_lines(texts.repartition(3), 7).collect()


def test_block_boundaries(spark):
    from corpusloom.operators import shards

    rows = [("a", "train", 3), ("b", "train", 0), ("c", "train", 6), ("d", "train", 2), ("e", "val", 3), ("f", "train", None)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id string, split string, length int, block_id int")
    got = {(r["split"], r["block_id"]): r["starts"] for r in shards.block_boundaries(docs, 4, ["doc_id"]).collect()}
    assert got == {("train", 0): [0, 3]}
    assert shards.block_boundaries(docs.where("false"), 4, ["doc_id"]).count() == 0


def test_work_folders(spark):
    from pathlib import Path

    from corpusloom import storage

    before = spark.conf.get(storage.CLEANUP, None)
    table = storage.written(spark.range(10).repartition(3), "numbers")
    base = Path(storage._base(spark).removeprefix("file://"))
    assert table.count() == 10 and base.is_dir() and spark.conf.get(storage.CLEANUP, None) == before
    storage.clear(spark)
    assert not base.exists()
    assert storage.written(spark.range(3), "numbers").count() == 3  # a new folder
