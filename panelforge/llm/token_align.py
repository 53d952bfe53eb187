"""Alignment of two tokenizers over a corpus: each distinct text is tokenised and aligned once.

1. Exact-text deduplication: the texts are shuffled by their full text, which
   leaves every distinct text once with the number of documents that hold it.
2. Each distinct text is encoded by a byte-level BPE (A, of a space and the
   text) and by a piece model with byte fallback (B, of the text; it adds the
   space). Token byte lengths give the offsets at which A and B tokens end.
   Offsets common to both cut the tokens into groups; every stretch between two
   neighbouring ends of either side is the overlap of exactly one A with one B
   token, so the stretches are the links.
3. Texts are worked on in chunks of bounded bytes. A chunk has a dictionary of
   its distinct (A id, B id) pairs, each weighted by the documents that hold it
   linked; a text carries indices into the dictionary and how often it uses
   them. The dictionaries, not the links, are summed to the corpus-wide counts
   and joined with them, and a chunk's texts meet its counts in one group.
4. The measures are joined to the documents by the digest of the text.

A text held by a third of all documents is one row after the map-side part of
step 1, and one row of the small side in step 4, where Spark splits the skewed
side. A pair that is in every text is one row per chunk.

Null and empty texts, and texts whose joined token bytes differ from a space
and the text (U+2581 in a text, for instance), have no tokens: zeros, and ''
as the digest. Rows with a null id or repeated rows are documents like others.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import written

BPE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text that share a pair dictionary; a longer text is a chunk of its own.
CHUNK_BYTES = 16 << 20
#: Bytes of text encoded at once.
BATCH_BYTES = 1 << 17

MEASURES = ("align_n_a", "align_n_b", "align_n_groups", "align_n_links", "align_n_best", "align_count_sum")
_TEXT = "chunk long, text_key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, picks array<int>, times array<int>"
_DICT = "pairs array<long>, weights array<long>"
_FOUND = "text_key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_alphabet() -> dict[str, int]:
    """The characters that a byte-level vocabulary writes for the 256 bytes.

    Printable Latin-1 bytes stand for themselves, the others for the code
    points from 256 on, in order.
    """
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


#: How a byte-level vocabulary of this kind splits a text before merging (fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A text with a longer run of white space is left to the slower encoder: the pattern looks ahead over the run.
LONG_BLANK = re.compile(r"\s{5000}")


def merge_ranks(bpe: str) -> dict[bytes, int] | None:
    """Token bytes to ids, if the file is plain: no normalizer, the usual split, merges in the order of their ids.

    Merging by lowest rank then gives the same tokens as the listed merges: a
    pair can only be adjacent at its turn if it is the listed one, since every
    token alone is reached by its own merges.
    """
    said = json.loads(bpe)
    model, split, special = said["model"], said["pre_tokenizer"] or {}, {t["content"] for t in said["added_tokens"]}
    plain = (
        model["type"] == "BPE" and not said["normalizer"] and split.get("type") == "ByteLevel" and split.get("use_regex", True)
        and not split.get("add_prefix_space") and not model.get("ignore_merges") and not model.get("dropout")
    )
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"].get(x + y) for x, y in merges]
    if not plain or None in made or any(x >= y for x, y in zip(made, made[1:])):
        return None
    letters = byte_alphabet()
    return {bytes(letters[c] for c in token): at for token, at in model["vocab"].items() if token not in special}


class Tokenizers:
    """Both tokenizers, built from the contents of their files, and the bytes of their tokens."""

    def __init__(self, bpe: str, piece: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(bpe)
        self.a.encode_special_tokens = True
        ranks = merge_ranks(bpe)
        self.ranked = ranks and tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece)
        vocabulary, letters = self.a.get_vocab(), byte_alphabet()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, at in vocabulary.items():
            self.a_bytes[at] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = []
        for at in range(self.b.get_piece_size()):
            token = self.b.id_to_piece(at)
            self.b_bytes.append(bytes([int(token[3:5], 16)]) if self.b.is_byte(at) else token.replace("▁", " ").encode())
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        # decimal ids with the sign that follows them: inside a group, at the end of its side
        self.signed = [f"{at}{sign}" for at in range(len(self.a_bytes)) for sign in ",|"]
        self.b_signed_from = len(self.signed)
        self.signed += [f"{at}{sign}" for at in range(len(self.b_bytes)) for sign in ",;"]

    def encode_a(self, text: str) -> list[int]:
        if self.ranked is None or (len(text) > 5000 and LONG_BLANK.search(text)):
            return self.a.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none for a text that either side does not give back byte for byte."""
        a = [self.encode_a(" " + t) for t in texts]
        b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(texts):
            want = b" " + text.encode()
            if not text or b"".join(map(self.a_bytes.__getitem__, a[k])) != want or b"".join(map(self.b_bytes.__getitem__, b[k])) != want:
                a[k] = b[k] = []
        return a, b


def _bounds(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def align(models: Tokenizers, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(n_a, n_b, n_groups, n_links per text), group strings, and the links: index of the text, id pair."""
    a_lists, b_lists = models.encode(texts)
    n_a, n_b = np.array([len(x) for x in a_lists], np.int64), np.array([len(x) for x in b_lists], np.int64)
    a = np.fromiter(chain.from_iterable(a_lists), np.int64, int(n_a.sum()))
    b = np.fromiter(chain.from_iterable(b_lists), np.int64, int(n_b.sum()))
    a_end, b_end = np.cumsum(models.a_length[a]), np.cumsum(models.b_length[b])
    size = int(a_end[-1]) if len(a_end) else 0
    in_a, in_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    in_a[a_end], in_b[b_end] = True, True
    both = in_a & in_b
    # links: one per stretch between neighbouring ends; the tokens over it are those with as many ends before
    ends = np.flatnonzero(in_a | in_b)
    over_a, over_b = np.cumsum(in_a)[ends] - in_a[ends], np.cumsum(in_b)[ends] - in_b[ends]
    pair = (a[over_a] << np.int64(32)) | b[over_b]
    text = np.repeat(np.arange(len(texts)), n_a)[over_a] if len(ends) else np.empty(0, np.int64)
    # group strings: the tokens in the order of the string, each with the sign that follows it
    group = np.cumsum(both)
    group_a, group_b = group[a_end] - both[a_end], group[b_end] - both[b_end]
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + np.searchsorted(group_b, group_a, "left")] = 2 * a + both[a_end]
    order[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = models.b_signed_from + 2 * b + both[b_end]
    at, cells = _bounds(n_a + n_b), order.tolist()
    strings = ["".join(map(models.signed.__getitem__, cells[at[k] : at[k + 1]]))[:-1] for k in range(len(texts))]
    a_text = np.repeat(np.arange(len(texts)), n_a)
    n_groups = np.bincount(a_text[both[a_end]], minlength=len(texts)) if len(texts) else n_a
    n_links = np.bincount(text, minlength=len(texts)) if len(texts) else n_a
    return np.stack([n_a, n_b, n_groups, n_links]).astype(np.int64), strings, text, pair


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(_bounds(counts).astype(np.int32)), pa.array(values.astype(kind.to_pandas_dtype()), kind))


class _Chunk:
    """Aligned texts that share a pair dictionary."""

    def __init__(self) -> None:
        self.size, self.keys, self.copies, self.measures, self.digests, self.used, self.pairs, self.times = 0, [], [], [], [], [], [], []

    def add(self, models: Tokenizers, texts: list[str], copies: list[int]) -> None:
        measures, strings, text, pair = align(models, texts)
        found, place = np.unique(pair, return_inverse=True)
        cells, times = np.unique(text * max(1, len(found)) + place, return_counts=True)
        self.pairs.append(found[cells % max(1, len(found))])
        self.times.append(times)
        self.used.append(np.bincount(cells // max(1, len(found)), minlength=len(texts)))
        self.measures.append(measures)
        self.digests += [hashlib.sha256(s.encode()).hexdigest() if n else "" for s, n in zip(strings, measures[0])]
        self.keys += [hashlib.sha256(t.encode()).digest() for t in texts]
        self.copies += copies
        self.size += sum(len(t) for t in texts)

    def rows(self, number: int) -> pa.RecordBatch:
        """One row per text, and a row with the dictionary."""
        pairs, used, measures = np.concatenate(self.pairs), np.concatenate(self.used), np.concatenate(self.measures, axis=1)
        found, place = np.unique(pairs, return_inverse=True)
        weights = np.zeros(len(found), np.int64)
        np.add.at(weights, place, np.repeat(np.array(self.copies, np.int64), used))
        n = len(self.keys)
        none = np.zeros(0, np.int64)
        text_rows = [
            pa.array(np.full(n, number)), pa.array(self.keys, pa.binary()), *[pa.array(m) for m in measures], pa.array(self.digests),
            _lists(place, used, pa.int32()), _lists(np.concatenate(self.times), used, pa.int32()),
            _lists(none, np.zeros(n, np.int64), pa.int64()), _lists(none, np.zeros(n, np.int64), pa.int64()),
        ]
        dictionary = [
            pa.array([number]), pa.nulls(1, pa.binary()), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()),
            _lists(none, np.zeros(1, np.int64), pa.int32()), _lists(none, np.zeros(1, np.int64), pa.int32()),
            _lists(found, np.array([len(found)]), pa.int64()), _lists(weights, np.array([len(found)]), pa.int64()),
        ]
        names = [c.split()[0] for c in f"{_TEXT}, {_DICT}".split(", ")]
        return pa.Table.from_batches([pa.record_batch(text_rows, names), pa.record_batch(dictionary, names)]).combine_chunks().to_batches()[0]


def _aligner(bpe: str, piece: bytes, chunk_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, part, number = None, TaskContext.get().partitionId(), 0
        group = _Chunk()
        for batch in batches:
            models = models or Tokenizers(bpe, piece)
            lengths = np.array(pc.binary_length(batch.column(0)), np.int64)
            ends, lo = np.cumsum(lengths), 0
            while lo < batch.num_rows:
                before = ends[lo] - lengths[lo]
                hi = max(lo + 1, int(np.searchsorted(ends, before + BATCH_BYTES, "right")))
                if group.size and group.size + int(ends[hi - 1] - before) > chunk_bytes:
                    yield group.rows((part << 32) + number)
                    group, number = _Chunk(), number + 1
                group.add(models, batch.column(0)[lo:hi].to_pylist(), batch.column(1)[lo:hi].to_pylist())
                lo = hi
        if group.size:
            yield group.rows((part << 32) + number)

    return run


def _measure(key: tuple, texts: pa.Table, counted: pa.Table) -> pa.Table:
    """Sums over the links of each text of a chunk."""
    place = np.array(counted["place"], np.int64)
    count, best = np.zeros((2, len(place)), np.int64)
    count[place], best[place] = np.array(counted["n_documents"], np.int64), np.array(counted["best"], np.int64)
    texts = texts.combine_chunks()
    flat = lambda name: np.array(pc.list_flatten(texts[name]), np.int64)
    picks, times = flat("picks"), flat("times")
    at = _bounds(np.array(pc.list_value_length(texts["picks"]), np.int64))
    total = lambda values: pa.array(np.diff(_bounds(values)[at]))
    same = ("text_key", "n_a", "n_b", "n_groups", "n_links")
    found = {name: texts[name] for name in same} | {"n_best": total(best[picks] * times), "count_sum": total(count[picks] * times)}
    return pa.table(found | {"groups_sha256": texts["groups_sha256"]})


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, the documents that hold it linked, and whether no pair of its A id is held by more."""
    counts = aligned.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("n_documents"))
    counts = written(counts, "align-counts")
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n_documents").alias("most"))
    with_a = counts.withColumn("a", F.shiftright("pair", 32))
    return with_a.join(most, "a").select("pair", "n_documents", (F.col("n_documents") == F.col("most")).cast("int").alias("best"))


def align_tokens(docs: DataFrame, bpe_file: str = BPE_FILE, piece_file: str = PIECE_FILE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` plus ``MEASURES`` and ``align_groups_sha256``; columns of these names in ``docs`` give way.

    ``docs`` needs the column ``text``. The two files are read by the driver
    (about 2 MB together) and sent along with the tasks.
    """
    with open(bpe_file, encoding="utf-8") as f:
        bpe = f.read()
    with open(piece_file, "rb") as f:
        piece = f.read()
    out = [*MEASURES, "align_groups_sha256"]
    docs = docs.drop(*out)
    text = F.col("text").cast("string")
    distinct = docs.select(text.alias("text")).where("text != ''").groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    aligned = written(distinct.mapInArrow(_aligner(bpe, piece, chunk_bytes), f"{_TEXT}, {_DICT}"), "align-texts")
    places = aligned.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    counted = places.join(pair_counts(aligned), "pair").select(F.col("chunk").alias("of_chunk"), "place", "n_documents", "best")
    texts = aligned.where("text_key IS NOT NULL").select(*[c.split()[0] for c in _TEXT.split(", ")])
    measured = texts.groupBy("chunk").cogroup(counted.groupBy("of_chunk")).applyInArrow(_measure, _FOUND)
    renamed = [F.col("text_key").alias("__align_key"), *[F.col(m.removeprefix("align_")).alias(m) for m in MEASURES], F.col("groups_sha256").alias("align_groups_sha256")]
    measured = written(measured.select(*renamed), "align-measures")
    keyed = docs.withColumn("__align_key", F.when(text != "", F.unhex(F.sha2(text.cast("binary"), 256))))
    joined = keyed.join(measured, "__align_key", "left")
    zeros = [F.coalesce(F.col(m), F.lit(0).cast("long")).alias(m) for m in MEASURES]
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], *zeros, F.coalesce("align_groups_sha256", F.lit("")).alias("align_groups_sha256"))
