"""The data stages end to end: corpus, exact dedup, tokenizer, token shards, packed blocks.

Each stage reads artifacts named in the registry, is one Spark plan with explicit order, writes its
data and commits by manifest and registry line.  A stage whose artifact is there already ends at
once when resumed, and is an error otherwise.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text as T
from ..operators import bpe, corpus, lineage, pieces, shards
from ..session import ship
from ..sources import artifacts as A
from ..sources import files, interchange, lines
from ..storage import written
from . import configs


def _begin(spark: SparkSession, stage: str, cfg: dict, run_id: str | None, kind: str, signature: str, own: str | None, resume: bool):
    """Root, name, folder and run of a stage; no run where its artifact is there already.

    Resuming takes the same inputs and settings: a saved state or an artifact of other ones is an error.
    """
    ship(spark)
    root = Path(cfg["artifacts_root"]).resolve()
    name = own or A.artifact_id(kind, signature)
    folder = A.artifact_folder(root, kind, name)
    output = Path(cfg["run"]["output_dir"]).resolve()
    if (folder / A.MANIFEST).exists():
        if not resume:
            raise FileExistsError(folder)
        if A.read_json(folder / A.MANIFEST).get("signature") != signature:
            raise ValueError(f"{folder} was made of other inputs or settings")
        return root, name, folder, None
    if folder.exists() and any(folder.iterdir()) and not resume:
        raise FileExistsError(folder)
    if resume and run_id and (output / run_id / "state.json").exists():
        A.Run(stage, run_id, output / run_id, "").may_resume(signature)
    run = A.Run.start(stage, output, cfg, run_id)
    run.state({"signature": signature, "artifact_id": name, "status": "running"})
    return root, name, folder, run


def _commit(spark: SparkSession, root: Path, name: str, folder: Path, run: A.Run, kind: str, inputs: list[dict], stats: dict, extra: dict | None = None) -> str:
    signature = A.read_json(run.folder / "state.json")["signature"]
    sums = {Path(r["path"]).relative_to(folder).as_posix(): r["sha256"] for r in lineage.file_checksums(spark, str(folder), (A.MANIFEST,)).collect()}  # a row a file
    record = A.manifest(kind, name, run, inputs, stats, dict(sorted(sums.items())), (extra or {}) | {"signature": signature})
    A.publish(root, folder, record)
    run.state({"signature": signature, "artifact_id": name, "status": "done"})
    run.end("done", stats)
    return name


def _inputs(spark: SparkSession, found: list[str]) -> list[dict]:
    """Path and digest of each input file."""
    return [r.asDict() for r in lineage.digests_of(spark, found).orderBy("path").collect()]  # a row a file


def _manifest(found: dict) -> dict:
    return A.read_json(Path(found["manifest_path"]))


def _as_input(record: dict) -> dict:
    return {"artifact_type": record["artifact_type"], "artifact_id": record["artifact_id"], "hash": record["config_hash"]}


def corpus_frame(spark: SparkSession, paths: list[str], data: dict) -> DataFrame:
    """Normalised lines of the files with kept or not, in (source, line_no) order up to the cap."""
    found = lines.corpus_lines(spark, paths, data["input_format"], data["jsonl_text_field"], data["decode_errors"])
    clean = corpus.normalised(found, form=data["normalize"], collapse=data["collapse_whitespace"])
    if data["max_docs"] is None:
        return clean.withColumn("kept", F.length("text") >= data["min_chars"])
    return corpus.kept_prefix(clean, data["max_docs"], ["source", "line_no"], data["min_chars"])


def build_corpus(spark: SparkSession, cfg: dict, run_id: str | None = None, resume: bool = False) -> str:
    configs.check_corpus(cfg)
    data = cfg["data"]
    found = files.find(data["input_paths"], spark=spark)
    if not found:
        raise FileNotFoundError("no input files")
    listed = _inputs(spark, found)
    signature = A.stable_hash({"config_hash": cfg["meta"]["config_hash"], "input_files": listed})
    root, name, folder, run = _begin(spark, "corpus", cfg, run_id, "corpus", signature, cfg["artifact"]["id"], resume)
    if run is None:
        return name
    rows = written(corpus_frame(spark, found, data), "corpus")
    stats = rows.agg(F.count_if("kept").alias("docs_kept"), F.count_if(~F.col("kept")).alias("dropped_short"), F.coalesce(F.sum(F.when(F.col("kept"), F.octet_length("text"))), F.lit(0)).alias("total_bytes")).first().asDict()
    interchange.write_documents(corpus.records(rows.where("kept")), str(folder / "docs"))
    return _commit(spark, root, name, folder, run, "corpus", [{"artifact_type": "raw_files", "artifact_id": "raw_files", "files": listed}], stats | {"num_files": len(found)}, {"docs_path": "docs"})


def dedup(spark: SparkSession, cfg: dict, run_id: str | None = None, resume: bool = False) -> str:
    root = Path(cfg["artifacts_root"]).resolve()
    source = _manifest(A.entry(root, ["corpus"], cfg["input"]["corpus_id"]))
    signature = A.stable_hash({"config_hash": cfg["meta"]["config_hash"], "corpus": source["artifact_id"], "checksums": source["checksums"]})
    root, name, folder, run = _begin(spark, "dedup", cfg, run_id, "corpus_dedup", signature, cfg["artifact"]["id"], resume)
    if run is None:
        return name
    docs = interchange.read_documents(spark, str(A.artifact_folder(root, "corpus", source["artifact_id"]) / source["docs_path"]))
    kept = written(corpus.exact_dedup(docs), "dedup")
    stats = kept.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("total"), F.count("*").alias("kept")).first().asDict()
    interchange.write_documents(kept.drop("copies"), str(folder / "docs"), order=["doc_id"])
    return _commit(spark, root, name, folder, run, "corpus_dedup", [_as_input(source)], stats | {"dropped": stats["total"] - stats["kept"]}, {"docs_path": "docs"})


def count_words(spark: SparkSession, cfg: dict, paths: list[str], pattern: str) -> DataFrame:
    data = cfg["data"]
    found = lines.training_lines(spark, paths, data["input_format"], data["jsonl_text_field"], data["decode_errors"])
    found = pieces.capped_lines(found, ["source", "line_no"], data["max_lines"], data["max_bytes"])
    clean = found.withColumn("text", T.normalise(F.col("text"), data["normalize"])).where("text <> ''")
    counts = pieces.piece_counts(clean, pattern, specials=cfg["special_tokens"]["tokens"], max_piece_bytes=cfg["bpe"]["max_piece_bytes"])
    if data["max_unique_pieces"]:
        counts = pieces.top_pieces(counts, data["max_unique_pieces"])
    return pieces.word_inventory(counts, data["min_piece_freq"], cfg["bpe"]["max_word_types"])


def counted_words(spark: SparkSession, cfg: dict, run: A.Run, paths: list[str], pattern: str, meta: dict, resume: bool) -> DataFrame:
    """The word inventory, kept in the run's folder; a resumed run of the same inputs and settings reads it again."""
    where, side = run.folder / "words", run.folder / "words.meta.json"
    if not (resume and where.exists() and A.read_json(side) == meta):
        count_words(spark, cfg, paths, pattern).write.mode("overwrite").parquet(str(where))
        A.write_json(side, meta)
    return spark.read.schema(schemas.WORDS).parquet(str(where))


def train_tokenizer(spark: SparkSession, cfg: dict, run_id: str | None = None, resume: bool = False, stop_after: int | None = None) -> str | None:
    """Learns merges and writes the tokenizer; with stop_after it stops early, to be resumed under the same run id."""
    configs.check_tokenizer(cfg)
    pre = cfg["pretokenizer"]
    pattern = T.resolve_pattern(pre["pattern"], pre["custom_pattern"], tuple(pre["flags"]))
    plain = pre["custom_pattern"] if pre["pattern"] == "custom" else T.PATTERNS[pre["pattern"]]
    pattern_hash = A.stable_hash({"pattern": plain, "flags": sorted(pre["flags"]), "normalize": cfg["data"]["normalize"], "engine": "java.util.regex"})
    found = files.find(cfg["data"]["input_paths"], cfg["data"]["input_format"], strict=True, spark=spark)
    print_of = files.fingerprint(found)
    signature = A.stable_hash({"config_hash": cfg["meta"]["config_hash"], "pattern_hash": pattern_hash, "files": print_of})
    root, name, folder, run = _begin(spark, "tokenizer", cfg, run_id, "tokenizer", signature, cfg["artifact"]["id"], resume)
    if run is None:
        return name
    meta = {"config_hash": run.config_hash, "pattern_hash": pattern_hash}
    words = counted_words(spark, cfg, run, found, pattern, meta | {"files": print_of}, resume)
    merges = bpe.target_merges(int(cfg["bpe"]["vocab_size"]), len(cfg["special_tokens"]["tokens"]), cfg["bpe"]["max_merges"])
    log_path = run.folder / "merges.wal"
    if log_path.exists() and not resume:
        log_path.unlink()
        log_path.with_suffix(".meta.json").unlink(missing_ok=True)
    replay = []
    log = A.MergeLog(log_path, run.config_hash, pattern_hash, cfg["checkpointing"]["wal_fsync_every_commits"])
    if resume:
        # The newest whole snapshot, and from the log what came after it.
        snapshot = A.latest_snapshot(run.folder, meta)
        replay = [(a, b, new_id) for a, b, new_id, _ in snapshot["merges"]] if snapshot else []
        done = bpe.committed(A.read_merge_log(spark, str(log_path)).where(F.col("merge_idx") >= len(replay)))
        rows = done.orderBy("merge_idx").collect()  # at most the vocabulary's size
        if [r["merge_idx"] for r in rows] != list(range(len(replay), len(replay) + len(rows))):
            raise ValueError("the merge log has a gap")
        replay += [(r["a"], r["b"], r["new_id"]) for r in rows]
    out: list[tuple[int, int, int, int]] = []

    def keep(rank: int, a: int, b: int, new_id: int, count: int) -> None:
        log.add(rank, a, b, new_id, count)
        out.append((a, b, new_id, count))
        if (rank + 1) % cfg["checkpointing"]["snapshot_every_merges"] == 0:
            run.metric({"merges": rank + 1, "count": count})
            A.save_snapshot(run.folder, rank + 1, out, meta, cfg["checkpointing"]["keep_last_snapshots"])

    learnt = bpe.learn(words, min(merges, stop_after) if stop_after is not None else merges, cfg["bpe"]["min_merge_freq"], replay, keep, cfg["bpe"]["max_word_types"])
    log.close()
    if stop_after is not None and len(learnt) >= stop_after and stop_after < merges:
        run.end("stopped", {"merges": len(learnt)})
        return None
    interchange.write_tokenizer(folder, [(a, b) for a, b, _, _ in learnt], cfg["special_tokens"]["tokens"], cfg["special_tokens"]["placement"], {"pattern": plain, "pattern_alias": pre["pattern"], "pattern_flags": sorted(pre["flags"]), "training_files_fingerprint": print_of, **meta})
    inputs = [{"artifact_type": "raw_files", "artifact_id": "raw_files", "files": _inputs(spark, found)}]
    return _commit(spark, root, name, folder, run, "tokenizer", inputs, {"num_merges": len(learnt)})


def tokenize(spark: SparkSession, cfg: dict, run_id: str | None = None, resume: bool = False) -> str:
    root = Path(cfg["artifacts_root"]).resolve()
    out = cfg["output"]
    source = _manifest(A.entry(root, ["corpus_dedup", "corpus"], cfg["input"]["corpus_id"]))
    tokenizer = _manifest(A.entry(root, ["tokenizer"], cfg["input"]["tokenizer_id"]))
    signature = A.stable_hash({"config_hash": cfg["meta"]["config_hash"], "corpus": source["checksums"], "tokenizer": tokenizer["checksums"], "output": out})
    root, name, folder, run = _begin(spark, "tokens", cfg, run_id, "tokens", signature, out["artifact_id"], resume)
    if run is None:
        return name
    loaded = interchange.read_tokenizer(A.artifact_folder(root, "tokenizer", tokenizer["artifact_id"]))
    alias = loaded["pattern_alias"]
    pattern = T.resolve_pattern(alias) if alias in T.PATTERNS else T.resolve_pattern("custom", loaded["pattern"])
    docs = interchange.read_documents(spark, str(A.artifact_folder(root, source["artifact_type"], source["artifact_id"]) / source["docs_path"]))
    tokens = bpe.encode(docs.select("doc_id", "text"), loaded["merges"], pattern, ids=loaded["ids"], unk=loaded["unk"]).select("doc_id", "tokens")
    ended = shards.with_end(tokens, loaded["eos"], out["append_eos"]).withColumn("length", F.size("tokens"))
    placed = shards.sharded(ended, int(out["docs_per_shard"]), ["doc_id"])
    # Shards that an interrupted run finished stay; their index file is written last.
    done = {d["shard"]: d for d in interchange.finished_shards(folder)} if resume else {}
    todo = placed.where(~F.col("shard").isin(*done)) if done else placed
    index = interchange.write_token_shards(todo, str(folder), out["token_dtype"]).collect()  # a row a shard
    listed = sorted([*done.values(), *(r.asDict() for r in index)], key=lambda r: r["shard"])
    stats = {"num_docs": sum(r["num_docs"] for r in listed), "total_tokens": sum(r["num_tokens"] for r in listed), "num_shards": len(listed)}
    A.write_json(folder / "index.json", {"shards": listed, "token_dtype": out["token_dtype"], **stats})
    return _commit(spark, root, name, folder, run, "tokens", [_as_input(source), _as_input(tokenizer)], stats, {"token_dtype": out["token_dtype"]})


def pack(spark: SparkSession, cfg: dict, run_id: str | None = None, resume: bool = False) -> str:
    root = Path(cfg["artifacts_root"]).resolve()
    out = cfg["output"]
    source = _manifest(A.entry(root, ["tokens"], cfg["input"]["tokens_id"]))
    signature = A.stable_hash({"config_hash": cfg["meta"]["config_hash"], "tokens": source["checksums"]})
    root, name, folder, run = _begin(spark, "packed", cfg, run_id, "packed", signature, out["artifact_id"], resume)
    if run is None:
        return name
    where = str(A.artifact_folder(root, "tokens", source["artifact_id"]))
    index, binary = interchange.read_token_index(spark, where), interchange.read_token_shards(spark, where, source["token_dtype"])
    docs = shards.document_slices(index, binary)
    split = docs.withColumn("split", shards.split_name(F.col("doc_id"), int(out["split_mod"]), int(out["val_remainder"])))
    blocks = written(shards.packed_blocks(split, int(out["seq_len"]), ["shard", "start"]), "packed")
    counts = {r["split"]: r.asDict() for r in shards.packed_counts(split.withColumn("length", F.size("tokens")), int(out["seq_len"])).collect()}  # two rows
    interchange.write_packed(blocks, str(folder), source["token_dtype"]).collect()  # a row a file
    A.write_json(folder / "index.json", {"seq_len": out["seq_len"], "token_dtype": source["token_dtype"], "splits": counts})
    return _commit(spark, root, name, folder, run, "packed", [_as_input(source)], {"seq_len": out["seq_len"], **{f"{s}_blocks": c["num_blocks"] for s, c in counts.items()}})


STAGES = {"corpus": (configs.CORPUS, build_corpus), "dedup": (configs.DEDUP, dedup), "tokenizer": (configs.TOKENIZER, train_tokenizer), "tokens": (configs.TOKENS, tokenize), "packed": (configs.PACKED, pack)}
