"""Driver-side records: configs, hashes, manifests, the registry, runs, logs and snapshots.

Small files only; data goes through Spark's writers.
"""

from __future__ import annotations

import contextlib
import hashlib
import json
import logging
import os
import platform
import subprocess
import tempfile
from dataclasses import dataclass
from datetime import UTC, datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from . import files

# Version of manifests, their file, and the folder of each artifact type.
SCHEMA_VERSION, MANIFEST = "1.0", "artifact_manifest.json"
FOLDERS = {"corpus": "corpora", "corpus_dedup": "corpora", "tokenizer": "tokenizer/exports", "tokens": "tokens", "packed": "packed", "model": "models", "eval": "eval"}


def canonical_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def stable_hash(value: Any) -> str:
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def now() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def write_atomic(path: Path, data: bytes) -> None:
    """A file that is either the old one or the new one, also after a crash."""
    path.parent.mkdir(parents=True, exist_ok=True)
    fd, temp = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(fd, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temp, path)
    except BaseException:
        with contextlib.suppress(OSError):
            os.unlink(temp)
        raise
    with contextlib.suppress(OSError):
        fd = os.open(path.parent, os.O_RDONLY)
        try:
            os.fsync(fd)
        finally:
            os.close(fd)


def write_json(path: Path, value: Any) -> None:
    write_atomic(path, (json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False) + "\n").encode())


def read_json(path: Path) -> Any:
    return json.loads(path.read_text(encoding="utf-8")) if path.exists() else None


def append_line(path: Path, value: Any, sync: bool = True) -> None:
    """One JSON line at the end of a log; a line is short enough for one write."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("ab") as f:
        f.write((json.dumps(value, sort_keys=True, ensure_ascii=False) + "\n").encode())
        f.flush()
        if sync:
            os.fsync(f.fileno())


def merge_config(base: dict, over: dict) -> dict:
    """Mappings merge, everything else is replaced."""
    out = dict(base)
    for k, v in over.items():
        out[k] = merge_config(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def load_config(path: Path | None, defaults: dict, overrides: dict | None = None) -> dict:
    """Defaults, file (YAML or JSON) and overrides, with the hash of the result under meta."""
    own: Any = {}
    if path is not None:
        text = path.read_text(encoding="utf-8")
        if path.suffix == ".json":
            own = json.loads(text)
        else:
            try:
                import yaml
            except ImportError as e:
                raise RuntimeError("YAML configs need PyYAML; JSON works without it") from e
            own = yaml.safe_load(text)
        if own is None:
            own = {}
        if not isinstance(own, dict):
            raise ValueError(f"{path} must hold a mapping")
    out = merge_config(merge_config(defaults, own), overrides or {})
    out.pop("meta", None)
    return out | {"meta": {"config_hash": stable_hash(out)}}


def artifact_folder(root: Path, artifact_type: str, artifact_id: str) -> Path:
    return root / FOLDERS.get(artifact_type, artifact_type) / artifact_id


def artifact_id(artifact_type: str, signature: str) -> str:
    return f"{artifact_type}_{signature[:12]}"


def manifest(artifact_type: str, artifact_id: str, run: Run, inputs: list[dict], stats: dict, checksums: dict, extra: dict | None = None) -> dict:
    return {"schema_version": SCHEMA_VERSION, "artifact_type": artifact_type, "artifact_id": artifact_id, "created_at": now(), "source_run_id": run.run_id, "config_hash": run.config_hash, "git_commit": git_commit(), "inputs": inputs, "stats": stats, "checksums": checksums} | (extra or {})


def publish(root: Path, folder: Path, record: dict) -> Path:
    """Manifest first, then the registry's line, which is the commit."""
    path = folder / MANIFEST
    if path.exists():
        raise FileExistsError(path)
    write_json(path, record)
    keys = ("created_at", "artifact_type", "artifact_id", "source_run_id", "config_hash", "inputs")
    append_line(root / "registry.jsonl", {k: record[k] for k in keys} | {"artifact_path": str(folder), "manifest_path": str(path)})
    return path


def registry_rows(root: Path) -> list[dict]:
    path = root / "registry.jsonl"
    return [json.loads(x) for x in path.read_text(encoding="utf-8").splitlines() if x.strip()] if path.exists() else []


def registry_table(spark: SparkSession, root: Path) -> DataFrame:
    """The registry as a table, seq from the order of lines; absent is empty.  A line per published artifact."""
    rows = [(i, *(r.get(k) for k in ("created_at", "artifact_type", "artifact_id", "artifact_path", "manifest_path", "source_run_id", "config_hash")), [(x.get("artifact_type"), x.get("artifact_id"), x.get("hash")) for x in r.get("inputs") or []]) for i, r in enumerate(registry_rows(root))]
    return spark.createDataFrame(rows, schemas.REGISTRY)


def entry(root: Path, types: list[str], wanted: str | None = None) -> dict:
    """The last entry of the first type that has one (of that id, where given); none is an error."""
    for t in types:
        found = [r for r in registry_rows(root) if r["artifact_type"] == t and (wanted is None or r["artifact_id"] == wanted)]
        if found:
            return found[-1]
    raise FileNotFoundError(f"no artifact {wanted or ''} of {' or '.join(types)}")


def git_commit() -> str | None:
    try:
        return subprocess.run(["git", "rev-parse", "HEAD"], capture_output=True, text=True, timeout=10, check=True).stdout.strip()
    except (OSError, subprocess.SubprocessError):
        return None


@dataclass(frozen=True)
class Run:
    """One run of a stage and its folder of records."""

    stage: str
    run_id: str
    folder: Path
    config_hash: str

    @classmethod
    def start(cls, stage: str, output: Path, config: dict, run_id: str | None = None, inputs: dict | None = None) -> Run:
        run_id = run_id or datetime.now(UTC).strftime("%Y%m%d_%H%M%S")
        run = cls(stage, run_id, output / run_id, config.get("meta", {}).get("config_hash") or stable_hash(config))
        run.folder.mkdir(parents=True, exist_ok=True)
        write_json(run.folder / "run_meta.json", {"stage": stage, "run_id": run_id, "status": "running", "started_at": now(), "ended_at": None, "config_hash": run.config_hash, "git_commit": git_commit(), "host": platform.node(), "pid": os.getpid(), "inputs": inputs or {}})
        return run

    def end(self, status: str, summary: dict | None = None) -> None:
        path = self.folder / "run_meta.json"
        write_json(path, (read_json(path) or {}) | {"status": status, "ended_at": now(), "summary": summary or {}})

    def state(self, value: dict) -> None:
        write_json(self.folder / "state.json", value)

    def metric(self, value: dict) -> None:
        append_line(self.folder / "metrics.jsonl", {"at": now(), "stage": self.stage} | value, sync=False)

    def may_resume(self, signature: str, field: str = "signature") -> dict:
        """The saved state if it is of the same inputs and settings; else an error."""
        saved = read_json(self.folder / "state.json")
        if saved is None:
            raise FileNotFoundError(self.folder / "state.json")
        if saved.get(field) != signature:
            raise ValueError("the saved state is of other inputs or settings")
        return saved


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        return canonical_json({"at": now(), "level": record.levelname, "logger": record.name, "message": record.getMessage()} | ({"error": self.formatException(record.exc_info)} if record.exc_info else {}))


def logger(name: str, folder: Path, level: str = "INFO", structured: bool = True) -> logging.Logger:
    """Console, text file and, if wanted, JSON lines."""
    out = logging.getLogger(name)
    out.handlers.clear()
    out.setLevel(level)
    out.propagate = False
    plain = logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s")
    targets: list[tuple[logging.Handler, logging.Formatter]] = [(logging.StreamHandler(), plain), (logging.FileHandler(folder / "run.log"), plain)]
    if structured:
        targets.append((logging.FileHandler(folder / "run.jsonl"), JsonLines()))
    for handler, form in targets:
        handler.setFormatter(form)
        out.addHandler(handler)
    return out


class MergeLog:
    """Write-ahead log of merges: a BEGIN line before and a COMMIT line after each."""

    def __init__(self, path: Path, config_hash: str, pattern_hash: str, sync_every: int = 0):
        self.path, self.meta, self.sync_every, self.n = path, {"config_hash": config_hash, "pattern_hash": pattern_hash}, sync_every, 0
        side = path.with_suffix(".meta.json")
        if path.exists():
            saved = read_json(side)
            if saved is None:
                raise ValueError("the merge log has no metadata")
            if saved != self.meta:
                raise ValueError("the merge log is of another configuration")
        else:
            write_json(side, self.meta)
        self.file = path.open("ab")

    def add(self, index: int, a: int, b: int, new_id: int, count: int) -> None:
        self.file.write(f"BEGIN\t{index}\t{a}\t{b}\t{count}\nCOMMIT\t{index}\t{new_id}\n".encode())
        self.n += 1
        if self.sync_every and self.n % self.sync_every == 0:
            self.file.flush()
            os.fsync(self.file.fileno())

    def close(self) -> None:
        self.file.flush()
        os.fsync(self.file.fileno())
        self.file.close()


def read_merge_log(spark: SparkSession, path: str) -> DataFrame:
    """line, kind, merge_idx, f1, f2, f3 of a merge log."""
    from pyspark.sql import functions as F

    from .lines import read_lines

    parts = F.split("text", "\t")
    number = lambda i, kind: F.try_element_at(parts, F.lit(i)).try_cast(kind)
    return read_lines(spark, [path]).select(F.col("line_no").alias("line"), parts[0].alias("kind"), number(2, "int").alias("merge_idx"), number(3, "int").alias("f1"), number(4, "int").alias("f2"), number(5, "bigint").alias("f3")).where("kind in ('BEGIN', 'COMMIT') and merge_idx is not null")


def save_snapshot(folder: Path, index: int, merges: list[tuple[int, int, int, int]], meta: dict, keep: int = 3) -> Path:
    """Merges so far, with a checksum; the newest few stay."""
    path = folder / f"snapshot_{index:08d}.json"
    body = canonical_json({"merges": merges, **meta}).encode()
    write_atomic(path, body)
    write_atomic(path.with_suffix(".sha256"), hashlib.sha256(body).hexdigest().encode())
    for old in sorted(folder.glob("snapshot_*.json"))[:-keep] if keep else []:
        old.unlink()
        old.with_suffix(".sha256").unlink(missing_ok=True)
    return path


def latest_snapshot(folder: Path, meta: dict) -> dict | None:
    """The newest snapshot that is whole and of this configuration."""
    for path in sorted(folder.glob("snapshot_*.json"), reverse=True):
        side = path.with_suffix(".sha256")
        body = path.read_bytes()
        if side.exists() and hashlib.sha256(body).hexdigest() == side.read_text().strip():
            found = json.loads(body)
            if all(found.get(k) == v for k, v in meta.items()):
                return found
    return None


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("files",)]
