"""Helpers shared by the text operators: tables, written intermediates, text buffers and word hashes.

The numpy part works on the raw UTF-8 buffer of an Arrow column: no Python
object per word is made. Words are the runs of bytes outside
``[\\x20\\x09-\\x0D]``; those bytes never occur inside a multi-byte UTF-8
sequence, so byte runs and code-point runs are the same words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.session import shared_scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text handled at once inside a task; a longer document is handled alone.
CHUNK_BYTES = 1 << 19


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, never a recomputation,
    and later steps read only the columns they need. The shuffle files of the
    write are not needed afterwards; Spark is asked to remove them at its end.
    """
    spark = df.sparkSession
    path = shared_scratch(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def keeping_own(docs: DataFrame, added: Iterable[str], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` with the columns of ``docs``, also those that bear the name of a column ``work`` adds."""
    aside = {c: f"__own_{c}" for c in docs.columns if c in set(added)}
    done = work(docs.withColumnsRenamed(aside)).drop(*added)
    return done.withColumnsRenamed({v: k for k, v in aside.items()}).select(*docs.columns)


def n_words(text: Column) -> Column:
    """Number of words; the regular expression never backtracks."""
    return F.regexp_count(text, F.lit(WORD)).cast("long")


# ---------------------------------------------------------------- Arrow text buffers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return buf[offs[0] : offs[-1]] if len(column) else buf[:0], offs - offs[0]


def row_chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``limit`` text bytes, each with its byte buffer and offsets."""
    buf, offs = text_buffer(batch.column(batch.schema.get_field_index(text)))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo), buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


# ---------------------------------------------------------------- words and their hashes

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit integers (public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + (CHUNK_BYTES >> 3))
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


class Words:
    """Words of several documents that lie in one byte buffer.

    ``data`` is the buffer with one space after each document; ``start``,
    ``end`` delimit each word in it; ``first[d]:first[d + 1]`` are the words of
    document ``d``.
    """

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool = False, table: np.ndarray | None = None):
        nd = len(offs) - 1
        data = np.empty(len(buf) + nd, np.uint8)
        gaps = offs[1:] + np.arange(nd)
        keep = np.ones(len(data), bool)
        keep[gaps] = False
        data[keep] = buf
        data[gaps] = 0x20
        if lower:
            data = _LOWER[data]
        if table is not None:
            data = table[data]
        self.data, self.doc_end = data, gaps
        solid = np.zeros(len(data) + 2, np.int8)
        solid[1:-1] = ~_SPACE[data]
        step = np.diff(solid)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.first = np.concatenate(([0], np.searchsorted(self.start, gaps)))

        self._sums: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word (polynomial of its bytes, mixed)."""
        return self.span_hashes(self.start, self.end)

    def span_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges of ``data``; equal bytes have equal hashes."""
        up, down = _powers(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=self._sums[1:])
        h = (self._sums[end] - self._sums[start]) * down[start]
        return mix64(h + (end - start).astype(np.uint64))


_SEATS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` word hashes, or of the whole shorter sequence."""
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, np.uint64(width), np.uint64)
    for k in range(width):
        out += words[k : k + n] * _SEATS[k]
    return mix64(out)
