"""Sharding into near-equal byte sizes by a histogram sort.

Rows are ordered by a composite key of 32 hexadecimal digits: the hash of the
text, then the hash of the document id. Shards are slices of that order.

1. The keys and sizes are written once, without the texts. Each round counts
   the exact bytes below the candidate boundaries - all prefixes with three more
   digits inside the brackets still open - in one aggregate with map-side
   combine, and narrows every splitter's bracket to one prefix. A round returns
   at most 4096 counts per open bracket, whatever the size of the input.
2. A splitter is fixed as soon as a candidate lies within ``tolerance`` of its
   target. Candidates inside the first 16 digits never part equal texts. Digits
   beyond them, which split a group of equal texts by document id, are tried only
   for a group with more bytes than the tolerance and than the largest row: a
   smaller one cannot be cut finer than a single row may be off anyway. Rows with
   equal text and equal id stay together in any case.
3. The rows are exchanged once, dealt by (shard, chunk). The slot is the row's
   position in its chunk plus the rows of the chunks before it, so that no task
   gets a whole shard.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import text_of, written

#: Prefix lengths of the rounds; the text's hash ends at 16, the id's at 32.
LEVELS = (3, 6, 9, 12, 15, 16, 19, 22, 25, 28, 31, 32)
TEXT_DIGITS = 16
#: Bytes of a chunk, the part of a shard that one task numbers; a shard has at least ``CHUNKS``.
CHUNK_BYTES = 128 << 20
CHUNKS = 64
ROW_BYTES = 16


def _digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def sort_key(text: Column, doc_id: Column) -> Column:
    return F.concat(_digits(F.xxhash64(text)), _digits(F.xxhash64(doc_id)))


def row_size(text: Column) -> Column:
    return (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long")


def _histogram(keys: DataFrame, known: int, digits: int, inside: Iterable[str]) -> dict[str, list[tuple[str, int]]]:
    """Exact bytes under each prefix of ``digits`` digits, by the bracket of ``known`` digits it refines."""
    if known:
        keys = keys.where(F.substring("key", 1, known).isin(sorted(inside)))
    rows = keys.groupBy(F.substring("key", 1, digits).alias("prefix")).agg(F.sum("size").alias("bytes")).collect()
    out: dict[str, list[tuple[str, int]]] = {}
    for r in sorted(rows):
        out.setdefault(r.prefix[:known], []).append((r.prefix, r.bytes))
    return out


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> list[str]:
    """Key prefixes at which shards 1, 2, ... begin; ``keys`` has (key, size)."""
    total, largest = keys.agg(F.sum("size"), F.max("size")).first()
    total, fine = total or 0, max(largest or 0, tolerance * (total or 0) / shards)
    open_at = dict.fromkeys(range(1, shards) if total else (), ("", 0, total))  # splitter -> its bracket: prefix, bytes below it, bytes in it
    best: dict[int, tuple[int, str]] = {}
    for known, digits in zip((0, *LEVELS), LEVELS):
        if not open_at:
            break
        if known == TEXT_DIGITS:
            open_at = {k: v for k, v in open_at.items() if v[2] > fine}
            if not open_at:
                break
        by_bracket = _histogram(keys, known, digits, {p for p, _, _ in open_at.values()})
        narrowed = {}
        for k, (bracket, below, _) in open_at.items():
            target = total * k // shards
            for prefix, n in by_bracket[bracket]:
                for off, at in ((abs(below - target), prefix), (abs(below + n - target), prefix + "~")):
                    if k not in best or off < best[k][0]:
                        best[k] = (off, at)
                if below <= target < below + n:
                    narrowed[k] = (prefix, below, n)
                below += n
        open_at = {k: v for k, v in narrowed.items() if best[k][0] > tolerance * total / shards}
    return [best[k][1] if k in best else "~" for k in range(1, shards)]


def shard(docs: DataFrame, shards: int = 40, tolerance: float = 0.01, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` plus ``shard`` (0 ..) and ``slot`` (gapless from 0 in its shard).

    The size of a row is the UTF-8 bytes of its text (null: none) plus 16.
    Null and empty texts count as one group of equal texts; a null id is an id
    like any other; repeated rows stay together. An empty table gives an empty
    result. Columns of ``docs`` named shard or slot are replaced.
    """
    keyed = docs.drop("shard", "slot").withColumns({"__key": sort_key(text_of(text), F.col(doc_id)), "__size": row_size(text_of(text))})
    keys = written(keyed.select(F.col("__key").alias("key"), F.col("__size").alias("size")), "shard-keys")
    chunks = max(CHUNKS, (keys.agg(F.sum("size")).first()[0] or 0) // (shards * CHUNK_BYTES))
    return _dealt(keyed, keys, find_splitters(keys, shards, tolerance), chunks).drop("__key", "__size")


def _place(key: Column, splitters: list[str], chunks: int) -> dict[str, Column]:
    """``prefix~`` sorts after every key with that prefix and before the next prefix."""
    number = sum((F.when(key >= F.lit(s), 1).otherwise(0) for s in splitters), F.lit(0))
    # digits after the text's hash: copies of one text spread over the chunks
    return {"shard": number.cast("int"), "__chunk": F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")}


def _dealt(keyed: DataFrame, keys: DataFrame, splitters: list[str], chunks: int) -> DataFrame:
    place = _place(F.col("__key"), splitters, chunks)
    counts = keys.withColumns(_place(F.col("key"), splitters, chunks)).groupBy("shard", "__chunk").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    # one row per chunk
    offsets = written(counts.select("shard", "__chunk", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("__before")), "shard-offsets")
    inside = Window.partitionBy("shard", "__chunk").orderBy("__key")
    return (
        keyed.withColumns(place)
        .withColumn("__in", F.row_number().over(inside))
        .join(offsets, ["shard", "__chunk"])
        .withColumn("slot", (F.col("__before") + F.col("__in") - 1).cast("long"))
        .select(*[c for c in keyed.columns], "shard", "slot")
    )
