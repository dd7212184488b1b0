"""Interchange formats: document lines, binary token shards and packed blocks, tokenizer folders."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.bpe import BASE, ROLES, byte_chars, token_bytes
from . import artifacts, files

# Little-endian widths of the binary token files.
WIDTHS = {"uint16": "<u2", "uint32": "<u4"}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.DOCUMENT).json(path).where("doc_id is not null")


def write_documents(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Gzip JSON lines, keys in alphabetical order; with an order, range-partitioned and sorted by it."""
    cols = sorted(df.columns)
    out = df.orderBy(*order) if order else df
    out.select(*cols).write.mode("errorifexists").option("compression", "gzip").option("ignoreNullFields", False).json(path)


def write_split_text(df: DataFrame, folder: str, split: str = "split", text: str = "text") -> None:
    """One folder of text lines for each split."""
    df.select(F.col(split), F.col(text).alias("value")).write.mode("errorifexists").partitionBy(split).text(folder)


def write_token_shards(df: DataFrame, folder: str, dtype: str = "uint16") -> DataFrame:
    """A .bin of little-endian ids and an .idx.json of documents for each shard, one task a shard.

    df: shard, doc_id, start, length, eos_appended, tokens.  A shard holds a fixed number of
    documents.  The folder must be on storage all executors share.
    """
    kind, top = WIDTHS[dtype], np.iinfo(WIDTHS[dtype]).max
    base = Path(folder)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("start")
        shard = int(pdf["shard"].iloc[0])
        ids = np.concatenate([np.asarray(t, np.int64) for t in pdf["tokens"]]) if len(pdf) else np.zeros(0, np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() > top):
            raise OverflowError(f"token id {ids.max()} doesn't fit {dtype}")
        name = f"tokens_shard_{shard:05d}"
        artifacts.write_atomic(base / f"{name}.bin", ids.astype(kind).tobytes())
        docs = [{"doc_id": d, "start": int(s), "length": int(n), "eos_appended": bool(e)} for d, s, n, e in zip(pdf["doc_id"], pdf["start"], pdf["length"], pdf["eos_appended"])]
        artifacts.write_json(base / f"{name}.idx.json", {"shard": shard, "dtype": dtype, "docs": docs})
        return pd.DataFrame({"shard": [shard], "num_docs": [len(docs)], "num_tokens": [len(ids)], "sha256": [files.sha256(base / f"{name}.bin")]})

    return df.groupBy("shard").applyInPandas(run, "shard int, num_docs bigint, num_tokens bigint, sha256 string")


def finished_shards(folder: Path) -> list[dict]:
    """Shard, documents, tokens and digest of each shard that has its index file."""
    out = []
    for side in sorted(folder.glob("tokens_shard_*.idx.json")):
        record, binary = artifacts.read_json(side), side.with_name(side.name.replace(".idx.json", ".bin"))
        out.append({"shard": record["shard"], "num_docs": len(record["docs"]), "num_tokens": binary.stat().st_size // np.dtype(WIDTHS[record["dtype"]]).itemsize, "sha256": files.sha256(binary)})
    return out


def write_evaluation(folder: Path, report: DataFrame, samples: list[str]) -> dict:
    """eval.json of a one-row report, and the samples as text."""
    row = report.first()
    value = row.asDict() if row else {}
    artifacts.write_json(folder / "eval.json", value)
    artifacts.write_atomic(folder / "samples.txt", ("\n\n".join(samples) + "\n").encode())
    return value


def _ids(width: str, dtype: str):
    @F.pandas_udf("array<int>")
    def run(content: pd.Series) -> pd.Series:
        def one(raw: bytes):
            if len(raw) % np.dtype(width).itemsize:
                raise ValueError(f"{len(raw)} bytes are no whole number of {dtype}")
            return np.frombuffer(raw, width).astype(np.int64)

        return content.map(one)

    return run


def read_token_shards(spark: SparkSession, folder: str, dtype: str = "uint16") -> DataFrame:
    """shard, tokens of the binary files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "tokens_shard_*.bin").load(folder)
    return raw.select(F.regexp_extract("path", r"tokens_shard_(\d+)\.bin$", 1).cast("int").alias("shard"), _ids(WIDTHS[dtype], dtype)("content").alias("tokens"))


def read_token_index(spark: SparkSession, folder: str) -> DataFrame:
    """shard, doc_id, start, length, eos_appended of the index files."""
    one = "shard INT, docs ARRAY<STRUCT<doc_id: STRING, start: BIGINT, length: INT, eos_appended: BOOLEAN>>"
    raw = spark.read.schema(one).option("multiLine", True).option("pathGlobFilter", "*.idx.json").json(folder)
    return raw.select("shard", F.explode("docs").alias("d")).select("shard", "d.*")


def read_packed(spark: SparkSession, path: str, seq_len: int, dtype: str = "uint16") -> DataFrame:
    """block_id, tokens of one packed file; its length must be a whole, positive number of blocks."""
    raw = spark.read.format("binaryFile").load(path).select(_ids(WIDTHS[dtype], dtype)("content").alias("t"))
    if raw.isEmpty():  # Spark passes over empty files
        raise ValueError(f"no whole number of blocks of {seq_len}: {path} is empty")
    n = F.size("t")
    checked = F.when((n > 0) & (n % seq_len == 0), F.col("t")).otherwise(F.raise_error(F.lit(f"no whole number of blocks of {seq_len}")).cast("array<int>"))
    return raw.select(checked.alias("t")).select(F.posexplode(F.expr(f"transform(sequence(0, cast(size(t) div {seq_len} as int) - 1), i -> slice(t, i * {seq_len} + 1, {seq_len}))")).alias("block_id", "tokens"))


def write_packed(blocks: DataFrame, folder: str, dtype: str = "uint16", rows_per_file: int = 100_000) -> DataFrame:
    """Binary files of blocks for each split, a bounded number of blocks each; both splits always have one."""
    kind, top = WIDTHS[dtype], np.iinfo(WIDTHS[dtype]).max
    base = Path(folder)
    for split in ("train", "val"):
        first = base / split / "shards" / "pack_00000.bin"
        if not first.exists():
            artifacts.write_atomic(first, b"")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block_id")
        split, part = pdf["split"].iloc[0], int(pdf["part"].iloc[0])
        ids = np.concatenate([np.asarray(t, np.int64) for t in pdf["tokens"]])
        if len(ids) and ids.max() > top:
            raise OverflowError(f"token id {ids.max()} doesn't fit {dtype}")
        path = base / split / "shards" / f"pack_{part:05d}.bin"
        artifacts.write_atomic(path, ids.astype(kind).tobytes())
        return pd.DataFrame({"split": [split], "part": [part], "num_blocks": [len(pdf)], "sha256": [files.sha256(path)]})

    parts = blocks.withColumn("part", F.expr(f"cast(block_id div {rows_per_file} as int)"))
    return parts.groupBy("split", "part").applyInPandas(run, "split string, part int, num_blocks bigint, sha256 string")


def write_tokenizer(folder: Path, merges: list[tuple[int, int]], specials: list[str], placement: str, extra: dict) -> dict:
    """vocab.json, merges.txt, configuration, special map and statistics; the special map comes back."""
    chars = byte_chars()
    plain = ["".join(chars[x] for x in t) for t in token_bytes(merges)]
    names = specials + plain if placement == "start" else plain + specials
    if len(set(names)) != len(names):
        raise ValueError("a special token has the name of another token")
    vocab = {t: i for i, t in enumerate(names)}
    roles = {}
    for role, candidates in ROLES.items():
        present = [c for c in candidates if c in specials]
        if present or specials:
            roles[role] = present[0] if present else specials[-1 if role == "pad_token" else 0]
    artifacts.write_json(folder / "vocab.json", vocab)
    artifacts.write_atomic(folder / "merges.txt", "".join(["#version: 0.2\n", *(f"{plain[a]} {plain[b]}\n" for a, b in merges)]).encode())
    artifacts.write_json(folder / "special_tokens_map.json", roles)
    counts = {"vocab_size": len(vocab), "num_merges": len(merges)}
    # Fields of the configuration record that readers expect.
    artifacts.write_json(folder / "tokenizer_config.json", {"tokenizer_class": "GPT2Tokenizer", "add_prefix_space": False, "model_max_length": 1024, "byte_to_unicode_version": "gpt2", "special_tokens": specials, **counts, **extra, **roles})
    artifacts.write_json(folder / "training_stats.json", counts | {"final_merge_index": len(merges) - 1, **extra})
    return roles


def read_tokenizer(folder: Path) -> dict:
    """merges (pairs of base ids), ids (token id of each base id), unk, pattern, specials and vocab of a tokenizer folder."""
    for name in ("vocab.json", "merges.txt", "tokenizer_config.json"):
        if not (folder / name).exists():
            raise FileNotFoundError(folder / name)
    vocab = json.loads((folder / "vocab.json").read_text(encoding="utf-8"))
    config = json.loads((folder / "tokenizer_config.json").read_text(encoding="utf-8"))
    roles = artifacts.read_json(folder / "special_tokens_map.json") or {}
    base = {c: i for i, c in enumerate(byte_chars())}
    names = list(base)
    known, merges = dict(base), []
    for line in (folder / "merges.txt").read_text(encoding="utf-8").splitlines():
        if not line or line.startswith("#version"):
            continue
        a, b = line.split(" ")
        merges.append((known[a], known[b]))
        known[a + b] = BASE + len(merges) - 1
        names.append(a + b)
    unk = vocab.get(roles.get("unk_token"))
    return {"merges": merges, "ids": [vocab.get(n) for n in names], "unk": unk, "eos": vocab.get(roles.get("eos_token")), "pad": vocab.get(roles.get("pad_token")), "bos": vocab.get(roles.get("bos_token")), "pattern": config.get("pattern"), "pattern_alias": config.get("pattern_alias"), "specials": [s for s in config.get("special_tokens", []) if s in vocab], "vocab": vocab}


def vocabulary_table(spark: SparkSession, loaded: dict) -> DataFrame:
    """token_id, token, token_bytes, is_special of a loaded tokenizer."""
    back = {c: i for i, c in enumerate(byte_chars())}
    special = set(loaded["specials"])
    rows = [(i, t, t.encode() if t in special else bytes(back[c] for c in t), t in special) for t, i in loaded["vocab"].items()]
    return spark.createDataFrame(sorted(rows), "token_id int, token string, token_bytes binary, is_special boolean")
