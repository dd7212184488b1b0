import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import artifacts as A
from corpusloom.sources import files, interchange, lines


def test_find(tmp_path):
    for name in ("a.txt", "b.TXT.gz", "c.jsonl", "d.bin", "sub/e.jsonl.gz", "sub/f.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"")
    names = lambda fs: [Path(f).relative_to(tmp_path).as_posix() for f in fs]
    assert names(files.find([str(tmp_path), str(tmp_path / "a.txt")], "text")) == ["a.txt", "b.TXT.gz", "sub/f.txt"]
    assert names(files.find([str(tmp_path)], "jsonl")) == ["c.jsonl", "sub/e.jsonl.gz"]
    assert len(files.find([str(tmp_path), "/no/such"])) == 6
    with pytest.raises(FileNotFoundError):
        files.find(["/no/such"], "text", strict=True)
    with pytest.raises(FileNotFoundError):
        files.find([str(tmp_path / "d.bin")], "text", strict=True)


def test_find_by_scheme_and_digests(spark, tmp_path):
    from corpusloom.operators import lineage

    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.txt").write_bytes(b"a" * 3_000_000)
    (tmp_path / "in/sub/b.txt").write_bytes(b"b")
    (tmp_path / "in/c.bin").write_bytes(b"c")
    found = files.find([f"file://{tmp_path}/in"], "text", strict=True, spark=spark)
    assert [f.rsplit("/", 1)[1] for f in found] == ["a.txt", "b.txt"] and files.find([f"file://{tmp_path}/none"], spark=spark) == []
    with pytest.raises(FileNotFoundError):
        files.find([f"file://{tmp_path}/none"], strict=True, spark=spark)
    paths = [str(tmp_path / "in/a.txt"), str(tmp_path / "in/sub/b.txt")]
    expect = {p: files.sha256(Path(p)) for p in paths}
    assert {r["path"]: r["sha256"] for r in lineage.digests_of(spark, paths).collect()} == expect
    assert {r["path"]: r["sha256"] for r in lineage.file_checksums(spark, str(tmp_path / "in"), ("c.bin",)).collect()} == expect
    assert lineage.digests_of(spark, []).count() == 0 and lines.read_lines(spark, found).count() == 2


def test_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"a\r\nb\rc\nlast\xff")
    with gzip.open(tmp_path / "b.txt.gz", "wb") as f:
        f.write("é\n\n".encode())
    paths = [str(tmp_path / "a.txt"), str(tmp_path / "b.txt.gz")]
    got = [(r["source"][-1], r["line_no"], r["text"]) for r in lines.read_lines(spark, paths).orderBy("source", "line_no").collect()]
    assert got == [("t", 1, "a"), ("t", 2, "b"), ("t", 3, "c"), ("t", 4, "last�"), ("z", 1, "é"), ("z", 2, "")]
    kept = [r["text"] for r in lines.training_lines(spark, paths).orderBy("source", "line_no").collect()]
    assert kept == ["a\r\n", "b\rc\n", "last�", "é\n", "\n"]
    assert lines.read_lines(spark, paths[:1], decode_errors="ignore").where("line_no = 4").first()["text"] == "last"
    assert lines.read_lines(spark, []).count() == 0


def test_lines_of_split_files(spark, tmp_path):
    rows = [f"line {i} é" + "x" * (i % 70) for i in range(4000)]
    for name, end in (("a {1}+%20.txt", b""), ("b.txt", b"\n")):
        (tmp_path / name).write_bytes("\n".join(rows).encode() + end)
    (tmp_path / "empty.txt").write_bytes(b"")
    (tmp_path / "bom.txt").write_bytes(b"\xef\xbb\xbfone\ntwo\n")
    paths = [str(tmp_path / n) for n in ("a {1}+%20.txt", "b.txt", "empty.txt", "bom.txt")]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        found = lines.read_lines(spark, paths, newline="lf")
        assert found.rdd.getNumPartitions() > 1
        got = sorted((r["source"], r["line_no"], r["text"]) for r in found.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expect = [(paths[0], i + 1, t + ("\n" if i < 3999 else "")) for i, t in enumerate(rows)] + [(paths[1], i + 1, t + "\n") for i, t in enumerate(rows)] + [(paths[3], 1, "one\n"), (paths[3], 2, "two\n")]
    assert got == sorted(expect)


def test_json_lines(spark, tmp_path):
    body = ['{"text":"hello"}', '{"text":123}', "not-json", "", '["text"]', '{"other":"x"}', '{"text":null}', '{"text":""}']
    (tmp_path / "a.jsonl").write_text("\n".join(body))
    path = [str(tmp_path / "a.jsonl")]
    assert [(r["line_no"], r["text"]) for r in lines.corpus_lines(spark, path, "jsonl").orderBy("line_no").collect()] == [(1, "hello"), (8, "")]
    assert [r["text"] for r in lines.training_lines(spark, path, "jsonl").orderBy("line_no").collect()] == ["hello"] + [""] * 7
    with pytest.raises(ValueError):
        lines.corpus_lines(spark, path, "csv")


def test_atomic_and_log(tmp_path):
    A.write_json(tmp_path / "x/y.json", {"b": 1, "a": "é"})
    assert A.read_json(tmp_path / "x/y.json") == {"b": 1, "a": "é"} and [p.name for p in (tmp_path / "x").iterdir()] == ["y.json"]
    A.append_line(tmp_path / "log.jsonl", {"n": 1})
    A.append_line(tmp_path / "log.jsonl", {"n": 2})
    assert [json.loads(x)["n"] for x in (tmp_path / "log.jsonl").read_text().splitlines()] == [1, 2]
    assert A.stable_hash({"b": 1, "a": {"y": 2, "x": 3}}) == A.stable_hash({"a": {"x": 3, "y": 2}, "b": 1})


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text("data:\n  min_chars: 3\n  input_paths: [x]\nmeta: {note: 1}\n")
    base = {"data": {"min_chars": 20, "input_paths": ["a", "b"], "keep": True}}
    got = A.load_config(tmp_path / "c.yaml", base, {"data": {"keep": False}})
    assert got["data"] == {"min_chars": 3, "input_paths": ["x"], "keep": False}
    assert got["meta"]["config_hash"] == A.stable_hash({"data": got["data"]})
    (tmp_path / "bad.yaml").write_text("- 1\n")
    with pytest.raises(ValueError):
        A.load_config(tmp_path / "bad.yaml", base)


def test_publish_and_verify(spark, tmp_path):
    run = A.Run.start("corpus", tmp_path / "runs", {"a": 1}, "r1")
    folder = A.artifact_folder(tmp_path, "corpus", "c1")
    A.write_atomic(folder / "docs/part", b"x")
    sums = files.checksums(folder)
    A.publish(tmp_path, folder, A.manifest("corpus", "c1", run, [{"artifact_type": "raw_files", "artifact_id": "raw_files", "files": []}], {}, sums))
    with pytest.raises(FileExistsError):
        A.publish(tmp_path, folder, {})
    table = A.registry_table(spark, tmp_path)
    assert table.count() == 1 and table.first()["artifact_id"] == "c1"
    assert A.registry_table(spark, tmp_path / "none").count() == 0
    files.verify(folder, sums)
    (folder / "docs/part").write_bytes(b"y")
    with pytest.raises(ValueError):
        files.verify(folder, sums)
    with pytest.raises(FileNotFoundError):
        files.verify(folder, {"no": "x"})
    run.state({"signature": "s"})
    assert run.may_resume("s") == {"signature": "s"}
    with pytest.raises(ValueError):
        run.may_resume("t")
    run.end("done")
    assert A.read_json(run.folder / "run_meta.json")["status"] == "done"


def test_merge_log_and_snapshots(spark, tmp_path):
    log = A.MergeLog(tmp_path / "m.wal", "c", "p", 1)
    log.add(0, 1, 2, 256, 9)
    log.close()
    (tmp_path / "m.wal").open("a").write("BEGIN\t1\t3\t4\t5\n")
    from corpusloom.operators.bpe import committed

    assert [tuple(r) for r in committed(A.read_merge_log(spark, str(tmp_path / "m.wal"))).collect()] == [(0, 1, 2, 256)]
    with pytest.raises(ValueError, match="another"):
        A.MergeLog(tmp_path / "m.wal", "other", "p")
    (tmp_path / "m.meta.json").unlink()
    with pytest.raises(ValueError, match="no metadata"):
        A.MergeLog(tmp_path / "m.wal", "c", "p")
    for i in range(1, 6):
        A.save_snapshot(tmp_path, i, [(1, 2, 256, i)], {"config_hash": "c"}, keep=3)
    assert len(list(tmp_path.glob("snapshot_*.json"))) == 3
    (tmp_path / "snapshot_00000005.json").write_text("broken")
    assert A.latest_snapshot(tmp_path, {"config_hash": "c"})["merges"][0][3] == 4
    assert A.latest_snapshot(tmp_path, {"config_hash": "z"}) is None


def test_logger(tmp_path):
    log = A.logger("t", tmp_path)
    log.info("hello")
    assert json.loads((tmp_path / "run.jsonl").read_text())["message"] == "hello" and "hello" in (tmp_path / "run.log").read_text()


def test_token_shards(spark, tmp_path):
    rows = [(0, "a", 0, 2, True, [1, 65535]), (0, "b", 2, 1, True, [3]), (1, "c", 0, 3, False, [4, 5, 6])]
    df = spark.createDataFrame(rows, "shard int, doc_id string, start bigint, length int, eos_appended boolean, tokens array<int>")
    made = interchange.write_token_shards(df, str(tmp_path / "t")).collect()
    assert sorted((r["shard"], r["num_docs"], r["num_tokens"]) for r in made) == [(0, 2, 3), (1, 1, 3)]
    assert {r["shard"]: r["tokens"] for r in interchange.read_token_shards(spark, str(tmp_path / "t")).collect()} == {0: [1, 65535, 3], 1: [4, 5, 6]}
    index = interchange.read_token_index(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, index.select("shard", "doc_id", "start", "length", "eos_appended").collect())) == [r[:5] for r in rows]
    with pytest.raises(Exception, match="65536"):
        interchange.write_token_shards(df.withColumn("tokens", F.array(F.lit(65536))), str(tmp_path / "u")).collect()


def test_packed_files(spark, tmp_path):
    df = spark.createDataFrame([("train", 0, [1, 2]), ("train", 1, [3, 4])], "split string, block_id bigint, tokens array<int>")
    interchange.write_packed(df, str(tmp_path)).collect()
    got = interchange.read_packed(spark, str(tmp_path / "train/shards/pack_00000.bin"), 2)
    assert [(r["block_id"], r["tokens"]) for r in got.orderBy("block_id").collect()] == [(0, [1, 2]), (1, [3, 4])]
    assert (tmp_path / "val/shards/pack_00000.bin").read_bytes() == b""
    for seq_len, path in ((3, "train"), (2, "val")):
        with pytest.raises(Exception, match="whole number"):
            interchange.read_packed(spark, str(tmp_path / f"{path}/shards/pack_00000.bin"), seq_len).collect()


def test_tokenizer_folder(spark, tmp_path):
    interchange.write_tokenizer(tmp_path, [(97, 98), (256, 99)], ["<|endoftext|>", "<|pad|>"], "start", {"pattern": "x", "pattern_alias": "custom"})
    assert (tmp_path / "merges.txt").read_text().splitlines() == ["#version: 0.2", "a b", "ab c"]
    loaded = interchange.read_tokenizer(tmp_path)
    assert loaded["merges"] == [(97, 98), (256, 99)] and loaded["eos"] == 0 and loaded["pad"] == 1 and loaded["ids"][0] == 2 and loaded["ids"][257] == 259
    table = interchange.vocabulary_table(spark, loaded)
    assert bytes(table.where("token_id = 259").first()["token_bytes"]) == b"abc"
    with pytest.raises(FileNotFoundError):
        interchange.read_tokenizer(tmp_path / "no")
