"""Text definitions the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space and words as the result contracts define them (ASCII white space only).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def without_space(text: Column) -> Column:
    """The text without white space; empty for a null text."""
    out = F.coalesce(text, F.lit(""))
    for c in SPACE_CHARS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def unit_hash(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on `key` and `seed` alone: 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("null")), F.lit(str(seed))).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def bounded_sample(df: DataFrame, key: Column, size: int) -> DataFrame:
    """About the `size` rows with the smallest hash of `key`, and never more.

    Most rows are left out by their hash alone before any are ordered, so what the tasks hand on is
    small however many tasks there are.
    """
    total = max(df.count(), 1)
    h = F.xxhash64(key)
    share = min(1.0, (2 * size + 64) / total)
    near = F.pmod(h, F.lit(1 << 32)) < F.lit(int(share * (1 << 32)))
    return df.withColumn("__h", h).where(near).orderBy("__h").limit(size).drop("__h")


def fold_table(extra: bytes = b"") -> bytes:
    """A table for `bytes.translate` of UTF-8: A-Z become a-z, letters, everything beyond ASCII and `extra` stay, the rest is a space."""
    return bytes(
        c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 or c in extra else 32 for c in range(256)
    )


def parts_of(data: bytes, size: int = 1 << 22) -> Iterator[bytes]:
    """`data` in parts of about `size` bytes, cut in front of a space; only a longer word makes one longer."""
    at = 0
    while len(data) - at > size:
        end = data.find(b" ", at + size)
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:]


def by_bytes(batch: pa.RecordBatch, column: int, size: int = 1 << 20, rows: int = 2000) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Slices of at most `rows` rows and, but for a single longer one, `size` bytes of text; with their first row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(ends):
        before = int(ends[at - 1]) if at else 0
        end = min(max(int(np.searchsorted(ends, before + size, side="right")), at + 1), at + rows)
        yield at, batch.slice(at, end - at)
        at = end


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """`work` for `mapInArrow`; memory that a task no longer needs goes back to the system.

    Python workers outlive their tasks, and what they keep adds up with the tables of later tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return run
