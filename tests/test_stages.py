import json

import pytest

from corpusloom.plans import configs, pipeline
from corpusloom.plans.cli import main, overrides
from corpusloom.sources import artifacts as A
from corpusloom.sources import interchange


@pytest.fixture
def raw(tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/train.txt").write_text("alpha beta\ngamma\nalpha beta\n")
    (tmp_path / "raw/validation.txt").write_text("delta epsilon\n")
    (tmp_path / "raw/test.txt").write_text("zeta eta\n")
    return tmp_path


def config(raw, stage, **own):
    return A.load_config(None, pipeline.STAGES[stage][0], A.merge_config({"artifacts_root": str(raw / "artifacts"), "run": {"output_dir": str(raw / "runs" / stage)}}, own))


def tokenizer(raw, **bpe):
    small = {"vocab_size": 262, "min_merge_freq": 2, **bpe}
    return config(raw, "tokenizer", data={"input_paths": [str(raw / "raw")], "min_piece_freq": 1}, bpe=small, special_tokens={"tokens": ["<|endoftext|>", "<|pad|>"]}, checkpointing={"snapshot_every_merges": 1})


def test_all_stages(spark, raw):
    root = raw / "artifacts"
    corpus = config(raw, "corpus", data={"input_paths": [str(raw / "raw")], "min_chars": 1})
    name = pipeline.build_corpus(spark, corpus, "r")
    assert A.read_json(root / "corpora" / name / A.MANIFEST)["stats"] == {"docs_kept": 5, "dropped_short": 0, "total_bytes": 46, "num_files": 3}
    with pytest.raises(FileExistsError):
        pipeline.build_corpus(spark, corpus, "r")
    assert pipeline.build_corpus(spark, corpus, "r", resume=True) == name
    deduped = pipeline.dedup(spark, config(raw, "dedup"), "r")
    assert A.read_json(root / "corpora" / deduped / A.MANIFEST)["stats"] == {"total": 5, "kept": 4, "dropped": 1}
    docs = interchange.read_documents(spark, str(root / "corpora" / deduped / "docs"))
    assert [r["doc_id"] for r in docs.select("doc_id").collect()] == sorted(r["doc_id"] for r in docs.collect())
    made = pipeline.train_tokenizer(spark, tokenizer(raw), "r")
    assert len(json.loads((root / "tokenizer/exports" / made / "vocab.json").read_text())) == 262
    tokens = pipeline.tokenize(spark, config(raw, "tokens", output={"docs_per_shard": 2}), "r")
    stats = A.read_json(root / "tokens" / tokens / A.MANIFEST)["stats"]
    assert stats["num_docs"] == 4 and stats["num_shards"] == 2
    packed = pipeline.pack(spark, config(raw, "packed", output={"seq_len": 4, "split_mod": 2}), "r")
    index = A.read_json(root / "packed" / packed / "index.json")["splits"]
    assert sum(s["raw_tokens"] for s in index.values()) == stats["total_tokens"]
    for split, counts in index.items():
        assert (root / "packed" / packed / split / "shards/pack_00000.bin").stat().st_size == counts["packed_tokens"] * 2
    assert [r["artifact_type"] for r in A.registry_rows(root)] == ["corpus", "corpus_dedup", "tokenizer", "tokens", "packed"]


def test_resumed_training_is_whole_training(spark, raw, tmp_path):
    (raw / "raw/train.txt").write_text("banana bandana banana\nbanana banana bandana\ncabana banana\nbanana!\n")
    whole = pipeline.train_tokenizer(spark, tokenizer(raw), "whole")
    folder = raw / "artifacts/tokenizer/exports" / whole
    merges = (folder / "merges.txt").read_text()
    for f in folder.iterdir():
        f.unlink()
    assert pipeline.train_tokenizer(spark, tokenizer(raw), "part", stop_after=2) is None
    assert pipeline.train_tokenizer(spark, tokenizer(raw), "part", resume=True) == whole
    assert (folder / "merges.txt").read_text() == merges and len(merges.splitlines()) == 5


def test_resuming_takes_the_same_inputs_and_reads_snapshots(spark, raw):
    (raw / "raw/train.txt").write_text("banana bandana banana\nbanana banana bandana\ncabana banana\nbanana!\n")
    assert pipeline.train_tokenizer(spark, tokenizer(raw), "part", stop_after=3) is None
    log = raw / "runs/tokenizer/part/merges.wal"
    # The log's first lines are gone; the snapshot of the third merge has them.
    log.write_text("".join(log.read_text().splitlines(keepends=True)[4:]))
    assert A.latest_snapshot(log.parent, {})["merges"]
    made = pipeline.train_tokenizer(spark, tokenizer(raw), "part", resume=True)
    assert len((raw / "artifacts/tokenizer/exports" / made / "merges.txt").read_text().splitlines()) == 5
    with pytest.raises(ValueError):
        pipeline.train_tokenizer(spark, tokenizer(raw, min_merge_freq=3), "part", resume=True)
    cfg = config(raw, "corpus", data={"input_paths": [str(raw / "raw")], "min_chars": 1}, artifact={"id": "mine"})
    assert pipeline.build_corpus(spark, cfg, "r") == pipeline.build_corpus(spark, cfg, "r", resume=True) == "mine"
    (raw / "raw/test.txt").write_text("changed\n")
    with pytest.raises(ValueError):
        pipeline.build_corpus(spark, cfg, "r", resume=True)


def test_interrupted_shards_are_kept(spark, raw):
    root = raw / "artifacts"
    pipeline.build_corpus(spark, config(raw, "corpus", data={"input_paths": [str(raw / "raw")], "min_chars": 1}), "r")
    pipeline.train_tokenizer(spark, tokenizer(raw), "r")
    cfg = config(raw, "tokens", output={"docs_per_shard": 2})
    name = pipeline.tokenize(spark, cfg, "r")
    folder = root / "tokens" / name
    before = A.read_json(folder / "index.json")
    (folder / A.MANIFEST).unlink()
    (folder / "tokens_shard_00001.idx.json").unlink()
    kept = (folder / "tokens_shard_00000.bin").stat().st_mtime_ns
    assert pipeline.tokenize(spark, cfg, "r", resume=True) == name
    assert A.read_json(folder / "index.json") == before
    assert (folder / "tokens_shard_00000.bin").stat().st_mtime_ns == kept


def test_evaluation_files(spark, tmp_path):
    report = spark.createDataFrame([(1.5, 4.48)], "eval_loss double, perplexity double")
    assert interchange.write_evaluation(tmp_path, report, ["a", "b"])["eval_loss"] == 1.5
    assert (tmp_path / "samples.txt").read_text() == "a\n\nb\n"


def test_checks(raw):
    good = tokenizer(raw)
    configs.check_tokenizer(good)
    for bad in ({"data": {"input_format": "csv"}}, {"data": {"decode_errors": "x"}}, {"data": {"normalize": "NFD"}}, {"data": {"input_paths": []}}, {"data": {"max_bytes": -1}}, {"data": {"max_lines": -1}}, {"data": {"max_unique_pieces": 0}}, {"bpe": {"vocab_size": 255}}, {"bpe": {"tie_break": "x"}}, {"bpe": {"max_merges": -1}}, {"bpe": {"max_word_types": 0}}, {"special_tokens": {"placement": "x"}}, {"checkpointing": {"wal_fsync_every_commits": -1}}):
        with pytest.raises(ValueError):
            configs.check_tokenizer(A.merge_config(good, bad))


def test_missing_inputs(spark, raw):
    with pytest.raises(FileNotFoundError):
        pipeline.dedup(spark, config(raw, "dedup"))
    with pytest.raises(FileNotFoundError):
        pipeline.build_corpus(spark, config(raw, "corpus", data={"input_paths": ["/no/such"]}))


def test_cli(spark, raw):
    assert overrides(["a.b=3", "a.c=x", "d=[1]"]) == {"a": {"b": 3, "c": "x"}, "d": [1]}
    args = ["corpus", "--run-id", "r", "--set", f"artifacts_root={raw}/artifacts", "--set", f"run.output_dir={raw}/runs", "--set", f'data.input_paths=["{raw}/raw"]', "--set", "data.min_chars=1"]
    assert main(args).startswith("corpus_")
