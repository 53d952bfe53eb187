"""Removal of lines that many documents share.

1. Every document gives one row per distinct long line: a 128-bit hash of its
   key and the numbers of the lines that have it.
2. These rows are range-partitioned by (hash, document, descending) and sorted
   within each partition by the same; a very common line spreads over several
   partitions.
3. Each task streams over its rows and carries the run of equal hashes at the
   end of a batch into the next one. The first row of a run, that of the largest
   document, is kept; as soon as the run has enough documents, the others drop
   the line. Only the first and the last run of a partition may go on beyond it:
   each leaves one row with its number of documents and its largest one, and of
   its rows only those that this piece cannot settle stay open - the largest
   document of a first run, or a piece with too few documents.
4. Open rows are settled by the sums over the pieces of their run: one row per
   piece, so at most one per partition however common the line.
5. The dropped lines of a document become a compressed bitmap. Texts are joined
   with the bitmaps, which are written first, so that Spark knows their size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import text_of, written

BLANK = " \t\n\v\f\r"
_LOWER = {c: c + 32 for c in range(65, 91)}
_NO_ID = -(1 << 63)


def line_key(line: str) -> str:
    return line.strip(BLANK).translate(_LOWER)


def _occurrences(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]

            def made() -> pa.RecordBatch:
                kinds = [pa.int64()] * 4 + [pa.list_(pa.int32())]
                rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["hi", "lo", "doc_id", "text_key", "lines"])
                for c in out:
                    c.clear()
                return rows

            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                own: dict[bytes, list[int]] = {}
                for number, line in enumerate(text.split("\n")):
                    if len(line) >= least and len(line := line_key(line)) >= least:
                        own.setdefault(xxhash.xxh3_128_digest(line.encode()), []).append(number)
                for digest, numbers in own.items():
                    for column, value in zip(out, (int.from_bytes(digest[:8], signed=True), int.from_bytes(digest[8:], signed=True), doc, key, numbers)):
                        column.append(value)
                if len(out[0]) >= 20_000:
                    yield made()
            yield made()

    return run


_FIELDS = ("hi", "lo", "doc_id", "text_key", "lines")
_MARKS = "hi long, lo long, doc_id long, text_key long, lines array<int>, kind int, documents long"
#: Kinds of marked rows: the document loses the lines; to be settled by its run's pieces; a piece of a run.
_DROPPED, _OPEN, _PIECE = 0, 1, 2
#: Rows of one run that are held until the run has enough documents.
_HELD_ROWS = 20_000


class _Run:
    """The run of equal hashes at the end of what a task has read; it goes on from batch to batch."""

    def __init__(self, hi: int, lo: int, doc: int, leads: bool, least: int):
        self.hi, self.lo, self.largest, self.last, self.leads, self.least = hi, lo, doc, None, leads, least
        self.documents, self.held, self.n_held, self.open = 0, [], 0, False

    def add(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        doc = rows.column(2).to_numpy()
        self.documents += int(np.count_nonzero(doc[1:] != doc[:-1])) + int(doc[0] != self.last)
        self.last = int(doc[-1])
        self.held.append(rows)
        self.n_held += rows.num_rows
        if self.documents >= self.least:
            for part in self.held:
                first = part.column(2).to_numpy() == self.largest
                yield _marked(part, np.flatnonzero(~first), _DROPPED)
                if self.leads:  # the partition before may hold a larger document
                    yield _marked(part, np.flatnonzero(first), _OPEN)
        elif self.n_held > _HELD_ROWS:
            yield from self._give_up()
        else:
            return
        self.held, self.n_held = [], 0

    def _give_up(self) -> Iterator[pa.RecordBatch]:
        self.open = True
        for part in self.held:
            yield _marked(part, np.arange(part.num_rows), _OPEN)

    def close(self, ends_partition: bool) -> Iterator[pa.RecordBatch]:
        beyond = self.leads or ends_partition or self.open
        if beyond:
            yield from self._give_up()
            values = [[self.hi], [self.lo], [self.largest], [0], [[]], [_PIECE], [self.documents]]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, _KINDS)], [*_FIELDS, "kind", "documents"])


_KINDS = [pa.int64()] * 4 + [pa.list_(pa.int32()), pa.int32(), pa.int64()]


def _marked(rows: pa.RecordBatch, places: np.ndarray, kind: int) -> pa.RecordBatch:
    taken = rows.take(pa.array(places))
    n = len(places)
    columns = [c.cast(k) for c, k in zip(taken.columns, _KINDS)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(n, kind, np.int32)), pa.nulls(n, pa.int64())], [*_FIELDS, "kind", "documents"])


def _streamed(documents: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: _Run | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            hi, lo, doc = (batch.column(i).to_numpy() for i in range(3))
            begins = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
            ends = np.append(begins[1:], n)
            if at is None or (at.hi, at.lo) != (hi[0], lo[0]):
                if at is not None:
                    yield from at.close(False)
                at = _Run(int(hi[0]), int(lo[0]), int(doc[0]), at is None, documents)
            yield from at.add(batch.slice(0, ends[0]))
            if len(begins) == 1:
                continue
            yield from at.close(False)
            # runs that begin and end inside the batch, all at once
            run_of = np.repeat(np.arange(len(begins)), ends - begins)
            new_doc = np.concatenate(([True], doc[1:] != doc[:-1]))
            new_doc[begins] = True
            many = np.bincount(run_of, new_doc) >= documents
            many[[0, -1]] = False
            yield _marked(batch, np.flatnonzero(many[run_of] & (doc != doc[begins][run_of])), _DROPPED)
            last = int(begins[-1])
            at = _Run(int(hi[last]), int(lo[last]), int(doc[last]), False, documents)
            yield from at.add(batch.slice(last))
        if at is not None:
            yield from at.close(True)

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed, counts = [], []
        for dropped in batch.column(2).to_pylist():
            keep = np.ones((max(dropped) // 8 + 1) * 8, bool)  # whole bytes: lines beyond the last dropped one stay
            keep[dropped] = False
            packed.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
            counts.append(int((~keep).sum()))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())], ["doc_id", "text_key", "n_dropped", "keep_bitmap"])


def _plain(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    body = text_of(text)
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc_id"), F.xxhash64(body).alias("text_key"), body.alias("text"))


def keep_bitmaps(docs: DataFrame, least_chars: int = 40, least_docs: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text_key, n_dropped, keep_bitmap) of the documents that lose lines.

    A line's key is the line without blanks at both ends, A-Z lower-cased. Keys
    of at least ``least_chars`` code points found in at least ``least_docs``
    documents lose their lines except in the largest document that has them. Bit
    i of the inflated bitmap (little-endian) is 1 if line i stays; lines beyond
    its end stay. ``text_key`` is the hash of the text, so that rows that share an
    id but not a text have their own bitmap. A null id counts as the smallest
    one. Null and empty texts have one empty line, which stays.
    """
    found = written(_plain(docs, text, doc_id).mapInArrow(_occurrences(least_chars), "hi long, lo long, doc_id long, text_key long, lines array<int>"), "line-keys")
    order = [F.col("hi"), F.col("lo"), F.col("doc_id").desc()]
    streamed = (
        found.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_streamed(least_docs), _MARKS)
    )
    marked = written(streamed, "line-marks")
    # equal (hash, document) meet in one partition, so the pieces of a run have no document in common
    runs = (
        marked.where(F.col("kind") == _PIECE).groupBy("hi", "lo").agg(F.sum("documents").alias("documents"), F.max("doc_id").alias("largest"))
        .where(F.col("documents") >= least_docs).drop("documents")
    )
    dropped = marked.where(F.col("kind") == _DROPPED).select("doc_id", "text_key", "lines").union(
        marked.where(F.col("kind") == _OPEN).join(runs, ["hi", "lo"]).where("doc_id <> largest").select("doc_id", "text_key", "lines")
    )
    # repeated rows list a line more than once
    of_doc = dropped.groupBy("doc_id", "text_key").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))
    return of_doc.mapInArrow(_bitmaps, "doc_id long, text_key long, n_dropped long, keep_bitmap binary")


def keep_lines(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text) of every row of ``docs``, the lines to keep joined by a line feed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines, kept = [], []
            for body, bitmap in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                lines.append(body.count("\n") + 1)
                if bitmap is not None:
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
                    parts = body.split("\n")
                    body = "\n".join(x for i, x in enumerate(parts) if i >= len(keep) or keep[i])
                kept.append(body)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.int64()), batch.column(2), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_text"])

    bitmaps = written(bitmaps, "line-bitmaps")  # of known size: the texts stay where they are if it is small
    joined = _plain(docs, text, doc_id).join(bitmaps, ["doc_id", "text_key"], "left").select(
        "doc_id", "text", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep_bitmap"
    )
    out = joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_text string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
