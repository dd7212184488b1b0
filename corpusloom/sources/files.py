"""Finding input files, and what identifies them."""

from __future__ import annotations

import hashlib
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# The file endings of each input format.
ENDINGS = {"text": (".txt", ".txt.gz"), "jsonl": (".jsonl", ".jsonl.gz")}


def find(paths: list[str], input_format: str | None = None, strict: bool = False, spark: SparkSession | None = None) -> list[str]:
    """Files and the files below folders, resolved, each once, in order of their paths.

    With a format only files of its endings count.  strict: a path that isn't there, or no file at
    all, is an error; else such paths are passed over.  Paths with a scheme are listed by Spark.
    """
    endings = ENDINGS[input_format] if input_format else None
    out: set[str] = set()
    for name in map(str, paths):
        if "://" in name:
            found = _listed(spark, name)
        else:
            p = Path(name)
            found = None if not p.exists() else [str(f.resolve()) for f in ([p] if p.is_file() else p.rglob("*")) if f.is_file()]
        if found is None:
            if strict:
                raise FileNotFoundError(name)
            continue
        out |= {f for f in found if endings is None or f.lower().endswith(endings)}
    if strict and not out:
        raise FileNotFoundError(f"no input files in {paths}")
    return sorted(out)


def _listed(spark: SparkSession | None, path: str) -> list[str] | None:
    """The files at a path of any storage Spark knows, by its (parallel) listing; contents aren't read."""
    if spark is None:
        raise ValueError(f"{path} needs a session to be listed")
    try:
        return [r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect()]  # a row a file
    except AnalysisException:
        return None


def sha256(path: Path, chunk: int = 1 << 20) -> str:
    h = hashlib.sha256()
    with path.open("rb") as f:
        while block := f.read(chunk):
            h.update(block)
    return h.hexdigest()


def fingerprint(files: list[str]) -> str:
    """Digest of paths, sizes and times of change of local files: cheap, and not a digest of the content."""
    lines = [f"{p}|{Path(p).stat().st_size}|{Path(p).stat().st_mtime_ns}" if "://" not in str(p) else str(p) for p in files]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def checksums(folder: Path, leave_out: str = "artifact_manifest.json") -> dict[str, str]:
    """sha256 of each file below a folder, by its path in it."""
    return {p.relative_to(folder).as_posix(): sha256(p) for p in sorted(folder.rglob("*")) if p.is_file() and p.name != leave_out}


def verify(folder: Path, expected: dict[str, str]) -> None:
    for name, digest in expected.items():
        if not (folder / name).is_file():
            raise FileNotFoundError(folder / name)
        if sha256(folder / name) != digest:
            raise ValueError(f"{folder / name} is not what its manifest says")
