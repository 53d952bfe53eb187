"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping segments, so that a passage of an item
is found as well as a whole one: long segments (96 bytes every 48) bear 6 edits,
and short ones (48 bytes every 16) bear 2. Every passage of at least 63 bytes
with at most 2 edits covers a short segment, wherever in the item it begins. Items
under 40 bytes are found where their words stand in the text unchanged. A text region within ``e`` edits of a segment
of ``m`` characters shares at least ``m + 1 - q - q * e`` of its q-grams, and all
of them lie on diagonals at most ``e`` apart. Per document:

1. its q-grams are looked up in the benchmark's (a bit table first, then the
   sorted q-grams);
2. the shared q-grams of each segment are counted in bands of diagonals that
   overlap by half, so that one band holds all of a region's;
3. bands that reach the lemma's bound are verified by banded alignment: the
   segment against the text, free ends, diagonals of the band only.

The benchmark is broadcast in slices of at most ``SLICE_BYTES`` of text; the
documents are read once for each slice. Nothing is shuffled but the matches of
items that have segments in more than one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import row_chunks, text_of

Q = 12
SEGMENT, STEP = 96, 48
#: A passage of SHORT + SHORT_STEP - 1 bytes covers a short segment, whatever its offset.
SHORT, SHORT_STEP = 48, 16
SHORT_EDITS = 2
#: One edit is allowed for so many characters of a segment.
CHARS_PER_EDIT = 16
BAND = 32
#: Items of fewer bytes are matched word for word, without edits.
LEAST_CHARS = 40
#: Each byte of the text is in two long and three short segments.
SLICE_BYTES = 6 << 20
TABLE_BITS = 22

_GAP = b"\0" * 16
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def normalised(text: str) -> bytes:
    """Lower-cased, runs of blanks one space, in UTF-8."""
    return " ".join(text.lower().split()).encode()


def gram_codes(data: np.ndarray) -> np.ndarray:
    """A 64-bit code of the q-gram at every byte that begins one."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    eight = np.empty((len(data) // 8 + 1) * 8, np.uint64)
    for k in range(8):
        part = np.frombuffer(padded[k : k + (len(padded) - k) // 8 * 8].tobytes(), "<u8")[: len(eight) // 8]
        eight[k::8][: len(part)] = part
    eight = eight[: len(data)]
    return eight[:n] * _MIX[0] ^ (eight[Q - 8 : Q - 8 + n] >> np.uint64(64 - 8 * (Q - 8))) * _MIX[1]


class Segments:
    """Index of the q-grams of benchmark segments: plain arrays, so that it can be broadcast."""

    def __init__(self, items: list[tuple[int, str]]):
        texts, of_item, at, most, exact = [], [], [], [], []
        for item, text in items:
            body = normalised(text or "")
            if len(body) < LEAST_CHARS:
                if body:
                    exact.append((item, body))
                continue
            starts = [0] if len(body) <= SEGMENT + STEP else [*range(0, len(body) - SEGMENT, STEP), len(body) - SEGMENT]
            for s in starts:
                texts.append(body if len(starts) == 1 else body[s : s + SEGMENT])
                of_item.append(item), at.append(s), most.append(len(body))
            for s in [*range(0, len(body) - SHORT, SHORT_STEP), len(body) - SHORT] if len(body) > SHORT else []:
                texts.append(body[s : s + SHORT]), of_item.append(item), at.append(s), most.append(SHORT_EDITS)
        self.texts, self.items, self.starts = texts, of_item + [item for item, _ in exact], at
        self.exact: dict[bytes, list[tuple[int, list[bytes]]]] = {}  # by the first word: items matched word for word, numbered after the segments
        for k, (_, body) in enumerate(exact, len(texts)):
            self.exact.setdefault(body.split(b" ")[0], []).append((k, body.split(b" ")))
        length = np.array([len(t) for t in texts], np.int64)
        self.edits = np.minimum(np.minimum(length // CHARS_PER_EDIT, (length - Q) // Q), np.array(most, np.int64))
        self.least = length + 1 - Q - Q * self.edits
        codes = [gram_codes(np.frombuffer(t, np.uint8)) for t in texts]
        flat = np.concatenate(codes) if codes else np.empty(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.segment = np.repeat(np.arange(len(texts)), [len(c) for c in codes])[order].astype(np.int64)
        self.offset = np.concatenate([np.arange(len(c)) for c in codes])[order].astype(np.int64) if codes else order
        self.codes, self.first = np.unique(flat[order], return_index=True)
        self.first = np.append(self.first, len(flat))
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.codes >> np.uint64(64 - TABLE_BITS)] = True

    def state(self) -> dict:
        return self.__dict__

    @classmethod
    def of(cls, state: dict) -> Segments:
        made = cls([])
        made.__dict__.update(state)
        return made

    def shared(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, segment, offset) of every q-gram that the data share with a segment."""
        codes = gram_codes(data)
        hits = np.flatnonzero(self.table[codes >> np.uint64(64 - TABLE_BITS)])
        if not len(hits) or not len(self.codes):
            return (np.empty(0, np.int64),) * 3
        at = np.searchsorted(self.codes, codes[hits])
        at[at == len(self.codes)] = 0
        same = self.codes[at] == codes[hits]
        hits, at = hits[same], at[same]
        n = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        return np.repeat(hits, n), self.segment[entry], self.offset[entry]


def candidate_bands(position: np.ndarray, segment: np.ndarray, offset: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first diagonal, shared q-grams) of the bands that reach the lemma's bound."""
    found = []
    diagonal = position - offset + BAND * 64  # never negative
    for shift in (0, BAND // 2):
        band = (diagonal + shift) // BAND
        # each q-gram of the segment counts once
        key = np.unique(((segment << 32 | band) << 9) | np.minimum(offset, 511))
        place, count = np.unique(key >> 9, return_counts=True)
        own = place >> 32
        enough = count >= least[own]
        found.append((own[enough], (place[enough] & 0xFFFFFFFF) * BAND - shift - BAND * 64, count[enough]))
    return tuple(np.concatenate(x) for x in zip(*found))


def banded_edits(pattern: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edits, last diagonal) of one pattern against regions (rows) of len(pattern) + width - 1 characters.

    Column d of the table is the diagonal that begins at the region's character
    d. The alignment may begin and end on any diagonal of the band.
    """
    m, width = len(pattern), regions.shape[1] - len(pattern) + 1
    slope = np.arange(width)
    cost = np.zeros((len(regions), width), np.int32)
    for j in range(m):
        best = cost + (regions[:, j : j + width] != pattern[j])
        np.minimum(best[:, :-1], cost[:, 1:] + 1, out=best[:, :-1])  # the pattern's character is left out
        cost = np.minimum.accumulate(best - slope, axis=1) + slope  # characters of the text are left out
    return cost.min(axis=1), cost.argmin(axis=1)


def word_matches(index: Segments, docs: list[bytes]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Rows of ``matches`` for the items of fewer than LEAST_CHARS bytes: the first place in each document that has their words."""
    for doc, body in enumerate(docs if index.exact else []):
        words, seen = body.split(b" "), set()
        for i, word in enumerate(words):
            for k, wanted in index.exact.get(word, ()):
                if k not in seen and words[i : i + len(wanted)] == wanted:
                    seen.add(k)
                    begin, length = sum(map(len, words[:i])) + i, len(b" ".join(wanted))
                    yield doc, k, begin, begin + length, 0, max(0, length + 1 - Q)


def matches(index: Segments, docs: list[bytes]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(document, segment, begin, end, edits, shared q-grams) of verified regions, positions in the normalised text."""
    yield from word_matches(index, docs)
    data = np.frombuffer(_GAP.join(docs) + _GAP, np.uint8)
    begins = np.concatenate(([0], np.cumsum([len(d) + len(_GAP) for d in docs])))[:-1]
    ends = begins + [len(d) for d in docs]
    segment, diagonal, shared = candidate_bands(*index.shared(data), index.least)
    for s in np.unique(segment):
        own = segment == s
        pattern, e = np.frombuffer(index.texts[s], np.uint8), int(index.edits[s])
        first, found = diagonal[own] - e, shared[own]
        span = np.arange(len(pattern) + BAND + 2 * e)
        for lo in range(0, len(first), 512):
            start, n_shared = first[lo : lo + 512], found[lo : lo + 512]
            doc = np.clip(np.searchsorted(begins, start + e + BAND // 2 + len(pattern) // 2, side="right") - 1, 0, len(docs) - 1)
            place = start[:, None] + span
            inside = (place >= begins[doc][:, None]) & (place < ends[doc][:, None])
            regions = np.where(inside, data[np.clip(place, 0, len(data) - 1)], 0)
            edits, last = banded_edits(pattern, regions)
            for k in np.flatnonzero(edits <= e):
                end = int(start[k] + last[k] + len(pattern))
                yield int(doc[k]), int(s), max(0, end - len(pattern) - int(begins[doc[k]])), end - int(begins[doc[k]]), int(edits[k]), int(n_shared[k])


_SCHEMA = "doc_id long, item_id long, n_segments int, edits int, shared_grams int, spans array<struct<begin:int,end:int>>"


def _slices(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of about SLICE_BYTES, each bounded before it is collected."""
    total = benchmark.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, -(-2 * total // SLICE_BYTES)) if total > SLICE_BYTES else 1
    for k in range(parts):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        yield [(r.item_id, r.text) for r in part.collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(doc_id, item_id, n_segments, edits, shared_grams, spans): one row for each row of ``docs`` and item of which it has a passage.

    ``n_segments``: segments found, long and short; ``edits``: the fewest of any of them;
    ``shared_grams``: the most shared q-grams of a band; ``spans``: the regions,
    in bytes of the normalised text. Null and empty texts match nothing, a null
    document id is kept, items without id or without words are not used, items
    of fewer than ``LEAST_CHARS`` bytes count where their words stand unchanged. Repeated rows and items have rows of their own.
    Empty tables give an empty result.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), text_of(item_text).alias("text")).where("item_id is not null").distinct()
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    out = None
    for part in _slices(items):
        part = plain.mapInArrow(_searcher(plain.sparkSession.sparkContext.broadcast(Segments(part).state())), _SCHEMA)
        out = part if out is None else out.union(part)
    return out


def _searcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Segments.of(shared.value)
        names = [x.split()[0] for x in _SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))]
        for batch in batches:
            for part, _, _ in row_chunks(batch, "text"):
                docs = [normalised(x or "") for x in part.column(1).to_pylist()]
                found: dict[tuple[int, int], dict[int, tuple]] = {}
                for doc, segment, begin, end, edits, grams in matches(index, docs):
                    own = found.setdefault((doc, index.items[segment]), {})
                    own[segment] = min(own.get(segment, (len(docs[doc]), 0, 0, 0)), (edits, -grams, begin, end))
                if found:
                    ids = part.column(0).to_pylist()
                    rows = [
                        (ids[doc], item, len(own), min(x[0] for x in own.values()), max(-x[1] for x in own.values()),
                         [{"begin": b, "end": e} for b, e in sorted({x[2:] for x in own.values()})])
                        for (doc, item), own in found.items()
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that have no passage of the benchmark; rows that share an id share its fate, a null id is never matched and kept."""
    bad = contaminated(docs, benchmark, text, doc_id).select(F.col("doc_id").alias(doc_id)).where(F.col(doc_id).isNotNull()).distinct()
    return docs.join(bad, doc_id, "left_anti")
