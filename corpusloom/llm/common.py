"""What the operators of this package share: Arrow mapping in bounded slices, and keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import removed, shared_folder, spread, written  # noqa: F401

#: Bytes of text that one NumPy slice holds; bounds a worker's memory whatever Arrow's batch size is.
#: A single longer text makes a slice of its own.
SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, *texts: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES of the text columns together."""
    if not batch.num_rows:
        return
    sizes = np.cumsum(sum(pc.fill_null(pc.binary_length(batch.column(t)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts))
    cuts = np.flatnonzero(np.diff(sizes // SLICE_BYTES)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def map_slices(df: DataFrame, text: str | tuple[str, ...], make: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """mapInArrow over slices bounded by their text column or columns."""
    texts = (text,) if isinstance(text, str) else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, *texts):
                yield make(part)

    return df.mapInArrow(run, schema)


def texts_of(df: DataFrame, *columns: str, text: str = "text") -> DataFrame:
    """Only the named columns of rows whose text is neither null nor empty.  df is a plain scan."""
    return spread(df.select(*columns, text).where(F.col(text).isNotNull() & (F.col(text) != "")))


def digests(cps: np.ndarray, starts: np.ndarray) -> list[bytes]:
    """A 128-bit digest of each text's code points."""
    import xxhash

    raw, ends = np.ascontiguousarray(cps, np.uint32).tobytes(), (starts * 4).tolist()
    digest = xxhash.xxh3_128_digest
    return [digest(raw[a:b]) for a, b in zip(ends[:-1], ends[1:])]
