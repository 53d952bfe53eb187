"""Removal of repeated byte strings: a suffix array over sampled suffixes, sorted in range partitions.

A string of ``LENGTH`` bytes begins at every byte of a document; sorting all
suffixes would ship the corpus a hundred times. Of each such string one suffix is
sampled: the one whose first ``TOKEN`` bytes have the smallest hash among the
``WINDOW`` possible ones. The choice depends on the string alone, so equal strings
sample suffixes with equal leading tokens, and about one byte in 33 begins a
sampled suffix. Nothing is lost: every string belongs to exactly one suffix.

1. A row per sampled suffix: the hash of its leading token, the hash of all bytes
   covered by its strings, document and position. The rows are range-partitioned
   by sampled splitters and sorted by these keys in turn, each key looked at among
   equal ones only (multikey sort). A task streams over its rows and compares
   neighbours. Suffixes alone with their token are dropped. Of equal coverings all
   but the first are repeats; the first ones of tokens with several coverings go
   on to step 2. Runs that touch the edge of a batch may go on beyond it; their
   rows are passed on and settled by aggregates over the keys.
2. The suffixes that share a token but not their surroundings (the ends of
   repeated passages) are split into blocks of neighbouring strings. The blocks'
   bytes are range-partitioned by the hash of the core that a block's strings
   share, and their strings are compared one by one, again with an exact way for
   runs that touch an edge: their strings' first occurrences by aggregate.
3. The spans of a document are gathered and its other bytes kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Words, mix64, row_chunks, text_of, written

LENGTH = 100
WINDOW = 64  # a power of two
BLOCK = 8
TOKEN = LENGTH - WINDOW + 1
#: Longer documents are read in pieces that share the strings' length.
PIECE = 4 << 20
_PLACE_BITS = 24
_NO_ID = -(1 << 63)


class _Bytes(Words):
    """Span hashes over a plain buffer."""

    def __init__(self, data: np.ndarray):
        self.data, self._sums = data, None


def sampled(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of the documents ``data[begin:end]``: (document, first string, last string, place, token hash, covering hash).

    Strings are given by the position in ``data`` at which they begin.
    """
    n = len(data) - TOKEN + 1
    if n < WINDOW:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),) * 2
    spans = _Bytes(data)
    place = np.arange(n)
    token = spans.span_hashes(place, place + TOKEN)
    low = token >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | place.astype(np.uint64)
    step = 1
    while step < WINDOW:  # smallest of 2, 4, 8, ... neighbours
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    count = np.maximum(end - begin - LENGTH + 1, 0)  # strings of each document
    doc = np.repeat(np.arange(len(begin)), count)
    string = np.repeat(begin - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    chosen = (low[string] & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
    if not len(doc):
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),) * 2
    first = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1]))))
    last = np.append(first[1:], len(doc)) - 1
    s1, s2, at = string[first], string[last], chosen[first]
    shape = ((at - s1) << 8 | (s2 - s1)).astype(np.uint64)
    cover = mix64(spans.span_hashes(s1, s2 + LENGTH) ^ mix64(shape))
    return doc[first], s1, s2, at, token[at], cover


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, offset in the document, data, begin, end) of documents, long ones in pieces."""
    for part, buf, offs in row_chunks(batch, "text"):
        ids = part.column(0).to_numpy()
        if len(buf) <= PIECE:
            yield ids, np.zeros(len(ids), np.int64), buf, offs[:-1], offs[1:]
            continue
        for d, (lo, hi) in enumerate(zip(offs, offs[1:])):
            for at in range(0, hi - lo, PIECE):
                data = buf[lo + at : min(hi, lo + at + PIECE + LENGTH - 1)]
                yield ids[d : d + 1], np.array([at]), data, np.array([0]), np.array([len(data)])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, base, data, begin, end in _pieces(batch):
            doc, s1, s2, at, token, cover = sampled(data, begin, end)
            first = base[doc] + s1 - begin[doc]
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(cover.view(np.int64)), pa.array(ids[doc]), pa.array(first << 16 | (at - s1) << 8 | (s2 - s1))],
                ["token", "cover", "doc_id", "strings"],
            )


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of equal keys begin, and the run of each row."""
    change = np.zeros(len(keys[0]), bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change), np.cumsum(change) - 1


_REPEAT, _OPEN, _UNDECIDED = 0, 1, 2


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with what they are: a repeat, open (to be compared string by string), undecided.

    Of a token's run that touches an edge, only the first row of each covering is undecided.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        token, cover, doc, strings = (batch.column(i).to_numpy() for i in range(4))
        t_begin, t_run = _runs(token)
        c_begin, c_run = _runs(token, cover)
        edge = (t_run == 0) | (t_run == t_run[-1])
        leader = c_begin[c_run]
        first = (doc == doc[leader]) & (strings == strings[leader])  # a row repeated in the table is no repeat of itself
        covers = np.bincount(t_run[c_begin])  # different coverings of each token
        kind = np.full(len(token), -1, np.int8)
        kind[~first] = _REPEAT  # an equal covering stands before it in this batch
        kind[c_begin[covers[t_run[c_begin]] > 1]] = _OPEN
        kind[c_begin[edge[c_begin]]] = _UNDECIDED
        kept = np.flatnonzero(kind >= 0)
        if len(kept):
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(kept)).columns, pa.array(kind[kept])], [*batch.schema.names, "kind"])


def _coverings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, doc_id, first, bytes) of the open suffixes of each document.

    A suffix's strings are split by their distance from the token into blocks of
    ``BLOCK``. The strings of a block share a core of bytes, whose hash is the
    token of the block: equal strings have equal cores, and a block whose core
    stands nowhere else has no repeats.
    """
    for batch in batches:
        token, doc, first, body = [], [], [], []
        for i, text, own in zip(*(batch.column(k).to_pylist() for k in range(3))):
            raw = text.encode()
            for s in own:
                s1 = s["strings"] >> 16
                at, s2 = s1 + (s["strings"] >> 8 & 255), s1 + (s["strings"] & 255)
                for block in range((at - s2) // BLOCK, (at - s1) // BLOCK + 1):
                    near = at - block * BLOCK  # the block's last string begins here
                    lo, hi = max(s1, near - BLOCK + 1), min(s2, near)
                    core = xxhash.xxh3_64_intdigest(raw[near : near + LENGTH - BLOCK + 1], block)
                    token.append(core - (1 << 63)), doc.append(i), first.append(lo), body.append(raw[lo : hi + LENGTH])
        yield pa.RecordBatch.from_arrays(
            [pa.array(token, pa.int64()), pa.array(doc, pa.int64()), pa.array(first, pa.int64()), pa.array(body, pa.binary())], ["token", "doc_id", "first", "body"]
        )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of the strings that stand in the batch before; the first ones of tokens that may go on beyond it, undecided."""
    for batch in batches:
        if not batch.num_rows:
            continue
        token, doc, first = (batch.column(i).to_numpy() for i in range(3))
        body = batch.column(3)
        offs = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
        data = np.frombuffer(body.buffers()[2], np.uint8)[offs[0] : offs[-1]]
        offs = offs - offs[0]
        count = np.maximum(np.diff(offs) - LENGTH + 1, 0)
        row = np.repeat(np.arange(len(token)), count)
        within = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        begin = offs[row] + within
        string = _Bytes(data).span_hashes(begin, begin + LENGTH).view(np.int64)
        at, owner = first[row] + within, doc[row]
        _, run = _runs(token)
        edge = ((run == 0) | (run == run[-1]))[row]

        order = np.lexsort((at, owner, string))
        head, same = _runs(string[order])
        lead = order[head[same]]
        again = order[(owner[order] != owner[lead]) | (at[order] != at[lead])]
        again.sort()  # by row and place: neighbours make one span
        if len(again):
            span, _ = _runs(row[again], at[again] - np.arange(len(again)))
            ends = at[again[np.append(span[1:], len(again)) - 1]] + LENGTH
            n = len(span)
            yield pa.RecordBatch.from_arrays([pa.array(owner[again[span]]), pa.array(at[again[span]]), pa.array(ends), pa.nulls(n, pa.int64())], ["doc_id", "from", "to", "string"])
        outer = order[head]
        outer = outer[edge[outer]]  # first in this batch, but maybe not of all
        if len(outer):
            yield pa.RecordBatch.from_arrays([pa.array(owner[outer]), pa.array(at[outer]), pa.array(at[outer] + LENGTH), pa.array(string[outer])], ["doc_id", "from", "to", "string"])


def _plain(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc_id"), text_of(text).alias("text"))


def _settled(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(repeats, open suffixes), undecided rows settled: the first of each covering, and the coverings of each token."""
    loose = marked.where(F.col("kind") == _UNDECIDED).select("token", "cover", "doc_id", "strings")
    firsts = loose.groupBy("token", "cover").agg(F.min(F.struct("doc_id", "strings")).alias("first"))
    several = firsts.groupBy("token").agg(F.count("*").alias("covers")).where("covers > 1").select("token")
    again = loose.join(firsts, ["token", "cover"]).where("struct(doc_id, strings) <> first").select("doc_id", "strings")
    more = firsts.join(several, "token").select("token", "first.doc_id", "first.strings")
    return (
        marked.where(F.col("kind") == _REPEAT).select("doc_id", "strings").union(again),
        marked.where(F.col("kind") == _OPEN).select("token", "doc_id", "strings").union(more),
    )


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, from, to): byte ranges covered by a string of ``LENGTH`` bytes that also starts earlier.

    Earlier means in a smaller document or before in the same one. Ranges may
    overlap. A null id counts as the smallest one. Rows that share an id are
    taken for one document: those with equal texts do not repeat each other.
    """
    plain = _plain(docs, text, doc_id)
    keys = ["token", "cover", "doc_id", "strings"]
    suffixes = plain.mapInArrow(_suffixes, "token long, cover long, doc_id long, strings long")
    marked = written(suffixes.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(_compared, "token long, cover long, doc_id long, strings long, kind byte"), "repeat-marks")
    repeats, open_ = _settled(marked)

    by_doc = open_.groupBy("doc_id").agg(F.collect_list(F.struct("token", "strings")).alias("own"))
    covered = plain.join(by_doc, "doc_id").mapInArrow(_coverings, "token long, doc_id long, first long, body binary")
    order = ["token", "doc_id", "first"]
    compared = written(covered.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_strings, "doc_id long, from long, to long, string long"), "repeat-strings")
    loose = compared.where("string is not null")
    firsts = loose.groupBy("string").agg(F.min(F.struct("doc_id", "from")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = loose.join(firsts, "string").where("struct(doc_id, from) <> first").select("doc_id", "from", "to")

    whole = repeats.select("doc_id", F.shiftright("strings", 16).alias("from"), (F.shiftright("strings", 16) + F.col("strings").bitwiseAND(F.lit(255)) + LENGTH).alias("to"))
    return whole.union(compared.where("string is null").select("doc_id", "from", "to")).union(again)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, removed, runs, kept = [], [], [], []
        for text, own in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            raw, out, at, n_runs, end = text.encode(), [], 0, 0, -1
            for lo, hi in sorted((s["from"], min(s["to"], len(raw))) for s in own or ()):
                if lo > end or end < 0:
                    if lo >= len(raw):
                        break
                    out.append(raw[at:lo])
                    n_runs += 1
                end = max(end, hi)
                at = end
            out.append(raw[at:])
            body = b"".join(out)
            size.append(len(raw)), removed.append(len(raw) - len(body)), runs.append(n_runs), kept.append(body)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row of ``docs``, ``kept`` being the bytes that stay.

    Spans that touch count as one. Null and empty texts have no bytes; texts
    shorter than ``LENGTH`` bytes stay whole. An empty table gives an empty result.
    """
    spans = repeated_spans(docs, text, doc_id).groupBy("doc_id").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    out = _plain(docs, text, doc_id).join(spans, "doc_id", "left").mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(_NO_ID)))
