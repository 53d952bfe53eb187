"""Near-duplicate documents: HyperMinHash sketches, banded registers, links confirmed on full shingle sets.

1. One pass makes each document's distinct shingle hashes, a 128-bit digest of
   that set, and the sketch: 256 buckets, each keeping the smallest hash of its
   bucket as a count of leading zeros and 10 mantissa bits (16 bits a bucket).
   Empty buckets borrow from a bucket chosen by a fixed probe sequence, so that
   short documents have full sketches too.
2. Documents with equal sets are one class; from here on only one document per
   class takes part, so copies cost nothing.
3. Bands of registers are hashed; documents that share a band meet in a
   bucket. Every member is paired with the
   bucket's hub, the member that meets most documents over all its bands (the
   original of a group of edited copies).
4. Where confirmed links leave a bucket in several components, its members are
   open: chains may miss the hub. No pairs of them are listed by bucket. Their
   full sets are indexed by the rarest shingles, as many as two sets at the
   threshold cannot avoid to share (prefix filter, by classes of set sizes), and
   members of different components that meet there are confirmed. Copies under
   the threshold that differ by what each adds do not meet at all. Copies that
   differ by what each replaces may meet at the rarest shingles of what is left
   of their common text; a large group of that kind, without a member that most
   of it is linked with, still costs more than its size.
5. Pairs with a hub whose collision-corrected estimate is far below the threshold
   are dropped; the others are confirmed on the full sets. Where a set has under 64
   shingles the registers are filled from a handful of buckets and the estimate
   says little: such pairs are compared by the sets themselves, which the small
   documents carry along.

A band has as many registers as leave two documents at the threshold without a
shared band with a probability below 1e-6: 36 bands of 7 at 0.85, 51 bands of 5
at 0.80. The estimate of larger sets has a standard error of
0.022 there (0.025 at 0.80); the margin is at least six times that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Words, mix64, row_chunks, text_of, window_hashes, written
from panelforge.llm.components import connected_components

BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
VALUE_BITS = 64 - BUCKET_BITS
MANTISSA_BITS = 10
#: Two documents at the threshold share no band with at most this probability.
MISSED = 1e-6
MARGIN = 0.15
#: Pairs in which a set has fewer shingles are compared exactly: few buckets fill the registers of a small set.
SMALL = 64
#: Slots of the table of shingle frequencies; any table gives the same pairs, a coarser one more to confirm. 4 MB.
FREQUENCY_SLOTS = 1 << 20
#: Ratio of neighbouring classes of set sizes.
SIZE_STEP = 1.1
LANES = 4  # registers of 16 bits in a long
#: Constant of the expected share of chance collisions (HyperMinHash paper).
COLLISION = 0.169919487159739

_PROBES = (mix64(np.arange(64 * BUCKETS, dtype=np.uint64)) & np.uint64(BUCKETS - 1)).astype(np.int64).reshape(64, BUCKETS)
_BAND_SEATS = mix64(np.arange(1, BUCKETS + 1, dtype=np.uint64)) | np.uint64(1)


def band_rows(percent: int) -> int:
    """Registers of a band: the most that miss a pair at the threshold with a probability of at most ``MISSED``."""
    alike = percent / 100
    return next((r for r in range(BUCKETS, 1, -1) if (1 - alike**r) ** (BUCKETS // r) <= MISSED), 1)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the document's shingles."""
    h = np.sort(window_hashes(words, width))
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a non-empty sorted set of 64-bit hashes: leading zeros * 1024 + mantissa of each bucket's minimum."""
    bucket = (hashes >> np.uint64(VALUE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    low = hashes[first] & np.uint64((1 << VALUE_BITS) - 1)
    bits = np.frexp(low.astype(np.float64))[1]  # length of the binary number, 0 for 0
    shift = np.maximum(bits - 1 - MANTISSA_BITS, 0).astype(np.uint64)
    mantissa = (low >> shift) & np.uint64((1 << MANTISSA_BITS) - 1)
    found = np.zeros(BUCKETS, np.uint16)
    found[bucket[first]] = ((VALUE_BITS - bits) << MANTISSA_BITS) + mantissa.astype(np.int64)
    filled = np.zeros(BUCKETS, bool)
    filled[bucket[first]] = True
    source = np.where(filled, np.arange(BUCKETS), -1)
    for probe in _PROBES:
        empty = source < 0
        if not empty.any():
            break
        take = empty & filled[probe]
        source[take] = probe[take]
    empty = np.flatnonzero(source < 0)
    if len(empty):  # hardly any bucket is filled: the next filled one, round the circle
        full = bucket[first]
        source[empty] = full[np.searchsorted(full, empty) % len(full)]
    return found[source]


def band_keys(registers: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the bands of ``width`` registers."""
    n = BUCKETS // width
    rows = registers[: n * width].astype(np.uint64).reshape(n, width) + np.uint64(1)
    return mix64((rows * _BAND_SEATS[:width]).sum(axis=1, dtype=np.uint64) + mix64(np.arange(n, dtype=np.uint64)))


def estimate(a: Column, b: Column, n_a: Column, n_b: Column) -> Column:
    """Similarity of two sketches (arrays of longs, four registers each), without the collisions expected by chance.

    Equal registers are the 16-bit lanes in which the exclusive or is zero: its
    bits are folded into the lowest of each lane and counted.
    """

    def unequal(x: Column, y: Column) -> Column:
        bits = x.bitwiseXOR(y)
        for shift in (8, 4, 2, 1):
            bits = bits.bitwiseOR(F.shiftrightunsigned(bits, shift))
        return F.bit_count(bits.bitwiseAND(F.lit(0x0001000100010001)))

    differing = F.aggregate(F.zip_with(a, b, unequal), F.lit(0), lambda n, x: n + x)
    equal = 1 - differing / BUCKETS
    ratio = n_a / n_b
    chance = COLLISION * 4 * ratio / ((1 + ratio) * (1 + ratio)) / (1 << MANTISSA_BITS)
    return (equal - chance) / (1 - chance)


_SKETCH_SCHEMA = "doc_id long, n_shingles long, k1 long, k2 long, sketch array<long>, bands array<long>, small array<long>"


def _sketched(width: int, percent: int):
    in_band, most = band_rows(percent), SMALL * 100 // percent  # a small set has no partner with more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, offs in row_chunks(batch, "text"):
                words = Words(buf, offs, lower=True)
                hashes = words.hashes()
                n, keys, sketches, bands, small = [], [], [], [], []
                for lo, hi in zip(words.first, words.first[1:]):
                    s = shingle_set(hashes[lo:hi], width)
                    n.append(len(s))
                    small.append(s.view(np.int64) if 0 < len(s) <= most else None)
                    if not len(s):
                        keys.append((0, 0)), sketches.append(None), bands.append(None)
                        continue
                    digest = xxhash.xxh3_128_intdigest(s.tobytes())
                    keys.append(((digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)))
                    registers = sketch(s)
                    sketches.append(registers.view(np.int64))
                    bands.append(band_keys(registers, in_band).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                     pa.array(sketches, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64())), pa.array(small, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "k1", "k2", "sketch", "bands", "small"],
                )

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, buf, offs in row_chunks(batch, "text"):
                words = Words(buf, offs, lower=True)
                hashes = words.hashes()
                sets = [shingle_set(hashes[lo:hi], width).view(np.int64) for lo, hi in zip(words.first, words.first[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return run


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether the sizes and sketches, of small sets the shingles, of two sides (column prefixes) leave the threshold a chance."""
    n_a, n_b = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    sizes = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)  # else the union is too large already
    alike = estimate(F.col(f"{a}.sketch"), F.col(f"{b}.sketch"), n_a, n_b) >= percent / 100 - MARGIN
    shared = F.size(F.array_intersect(F.col(f"{a}.small"), F.col(f"{b}.small")))
    return sizes & F.when(F.least(n_a, n_b) < SMALL, 100 * shared >= percent * (n_a + n_b - shared)).otherwise(alike)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    both = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b")), "b")
    )
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(100 * shared >= percent * (F.size("set_a") + F.size("set_b") - shared)).select("a", "b")


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _hub_pairs(entries: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Every member of a bucket with its hub, as far as their sketches are alike."""
    met = entries.groupBy("doc_id").agg(F.sum("members").alias("met"))
    ranked = entries.join(met, "doc_id")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("met", (-F.col("doc_id")).alias("low"))).alias("top")).select("band", (-F.col("top.low")).alias("hub"))
    pairs = _pairs(entries.join(hubs, "band").where("doc_id <> hub").select("doc_id", "hub"), "doc_id", "hub")
    side = nodes.select("doc_id", "n_shingles", "sketch", "small")
    return (
        pairs.join(side.alias("x"), F.col("a") == F.col("x.doc_id")).join(side.alias("y"), F.col("b") == F.col("y.doc_id"))
        .where(_possible("x", "y", percent)).select("a", "b")
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows per slot of the frequency table: one row per slot and partition."""
    counts = np.zeros(FREQUENCY_SLOTS, np.int64)
    for batch in batches:
        counts += np.bincount(_slots(batch.column(0)), minlength=FREQUENCY_SLOTS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])


def _slots(shingles: pa.Array) -> np.ndarray:
    return np.asarray(pc.list_flatten(shingles)).view(np.uint64) & np.uint64(FREQUENCY_SLOTS - 1)


def _prefixes(counts: np.ndarray, percent: int):
    """Of each set and each class of partner sizes, the rarest shingles one of which a partner must share.

    Sets of n and m shingles with ``100 * shared >= percent * union`` share at
    least ``k = percent * (n + m) / (100 + percent)`` shingles, so in any order
    of all shingles the first ``n - k + 1`` of one and ``m - k + 1`` of the other
    meet. Shingles alone in their slot of the frequency table meet nothing.
    """
    edges = np.unique(np.ceil(SIZE_STEP ** np.arange(400)).astype(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for row, shingles in enumerate(batch.column(3)):
                s = np.asarray(shingles.values).view(np.uint64)
                n, often = len(s), counts[s & np.uint64(FREQUENCY_SLOTS - 1)]
                order = np.lexsort((s, often))
                own = int(np.searchsorted(edges, n, "right")) - 1
                least, most = -(-percent * n // 100), 100 * n // percent
                for partner in range(int(np.searchsorted(edges, least, "right")) - 1, int(np.searchsorted(edges, most, "right"))):
                    smallest = max(int(edges[partner]), least)
                    first = order[: n + 1 - -(-percent * (n + smallest) // (100 + percent))]
                    first = first[often[first] > 1]
                    for cells, value in zip(out, (s[first].view(np.int64), min(own, partner), max(own, partner), own, row)):
                        cells.append(value if isinstance(value, np.ndarray) else np.full(len(first), value, np.int64))
            shingle, low, high, own, rows = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)
            taken = [batch.column(k).take(pa.array(rows)) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(shingle), pa.array(low), pa.array(high), pa.array(own)], ["doc_id", "component", "rest", "shingle", "low", "high", "own"])

    return run


def _open_pairs(entries: DataFrame, sets: DataFrame, components: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of different components, of buckets that hold several, which share one of their rarest shingles."""
    labelled = entries.select("band", "doc_id").join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    sizes = labelled.groupBy("band", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("band").agg(F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts")).where("parts > 1").select("band", F.col("top.component").alias("main"))
    members = labelled.join(largest, "band").groupBy("doc_id", "component").agg(F.max(F.col("component") != F.col("main")).alias("rest"))
    open_ = written(members.join(sets, "doc_id").select("doc_id", "component", "rest", "shingles"), "near-open")
    counts = np.zeros(FREQUENCY_SLOTS, np.int32)
    for r in open_.select("shingles").mapInArrow(_counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator():  # at most FREQUENCY_SLOTS rows
        counts[r.slot] = min(r.n, 2**31 - 1)
    rows = open_.mapInArrow(_prefixes(counts, percent), "doc_id long, component long, rest boolean, shingle long, low long, high long, own long")
    rows = written(rows, "near-prefixes")
    x, y = rows.alias("x"), rows.alias("y")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("shingle", "low", "high")]
    apart = (F.col("x.component") != F.col("y.component")) & (F.col("x.rest") | F.col("y.rest")) & (F.col("x.doc_id") < F.col("y.doc_id"))
    of_classes = (F.col("x.low") == F.col("x.high")) | (F.col("x.own") != F.col("y.own"))
    found = x.join(y, reduce(lambda p, q: p & q, [*same, apart, of_classes]))
    return _pairs(found.select(F.col("x.doc_id").alias("p"), F.col("y.doc_id").alias("q")), "p", "q")


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    Words are lower-cased in A-Z only. A document with fewer than ``width``
    words has its whole sequence as one shingle; one without words (null or
    empty text) has none and is linked with nothing. A null id is linked with
    nothing and kept: its component is null. Rows that share an id count as one
    document when components are formed. An empty table gives an empty result.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    sketches = written(plain.mapInArrow(_sketched(width, percent), _SKETCH_SCHEMA), "near-sketches")
    named = sketches.where("n_shingles > 0 and doc_id is not null")
    classes = written(named.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id")), "near-classes")
    nodes = written(named.join(classes, ["k1", "k2", "doc_id"], "left_semi"), "near-nodes")

    bands = nodes.select("doc_id", F.posexplode("bands").alias("place", "band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    entries = written(bands.join(shared, "band"), "near-entries")
    wanted = entries.select("doc_id").distinct()
    sets = written(plain.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(width), "doc_id long, shingles array<long>"), "near-sets")

    pairs = written(_hub_pairs(entries, nodes, percent), "near-pairs")
    links = written(_confirmed(pairs, sets, percent), "near-links")
    more = _open_pairs(entries, sets, connected_components(links), percent).join(pairs, ["a", "b"], "left_anti")
    links = links.union(written(_confirmed(more, sets, percent), "near-links"))
    components = connected_components(links)

    of_class = classes.join(components.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("k1", "k2", F.coalesce("component", "doc_id").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")))
    return (
        sketches.select("doc_id", "n_shingles", "k1", "k2").join(of_class, ["k1", "k2"], "left")
        .withColumn("component_id", component)
        .select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
    )


def drop_near_duplicates(docs: DataFrame, percent: int = 85, width: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose document is kept: of each component that with the smallest id, and all rows without id."""
    found = near_duplicates(docs, percent, width, text, doc_id)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(doc_id)).distinct()
    return docs.join(gone, doc_id, "left_anti")
