"""The prefix trie of conversations, with subtree totals by time-forward processing.

A node is a distinct sequence of first d turns; ``(conv_id, depth)`` names it,
conv_id being the smallest conversation that starts with it. Turns travel as
digests; a node's key is the exclusive or of its turns' digests, each hashed
with its place, so that keys of all prefixes come from one running pass that no
conversation forces into one task.

Subtree totals (leaves, saved words) are summed bottom-up. In a *shard* the
nodes are sorted externally in reverse level order; each takes the messages
addressed to it from a priority queue that spills sorted runs, adds its own
value and sends the total to its parent through the queue. A shard holds
fragments: a node that more than ``span`` conversations start with is a
fragment of its own; below, a fragment is the part of a subtree between two
depths divisible by ``span``. The totals of fragment roots are summed by the
node they hang on, and the tree of the fragments so entered is solved the same
way with span ** 2, span ** 3, ..., until one fragment holds what is left - a
``span``-th of the nodes per round at most, in practice far less. A second pass
inside the shards then adds what entered from other fragments.

Defined results: turns are ordered by turn (null first), ties by the digest of
role and text; repeated rows are turns of their own. Rows with a null conv_id
belong to no conversation and are left out. An empty table has no node.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.common import n_words, text_of, written
from panelforge.operators.ordered import row_numbers

#: Conversations of a light node and levels of a block, in the first round.
SPAN = 128
#: Messages that a shard's queue keeps in memory.
QUEUE_ROWS = 200_000
#: Conversation ids in one row of the lists that are hashed.
IDS_PER_ROW = 4096


# ---------------------------------------------------------------- rebuilt conversations


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its group."""
    return F.crc32(conv_id.cast("string").cast("binary")) % 4


def group_head(conv_id: Column, group: int = 20) -> Column:
    return conv_id - conv_id % group


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, n_turns) of every rebuilt conversation, and its turns: conv_id, depth, digest, words, is_end."""
    role, text = text_of("role"), text_of("text")
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    slim = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long"), F.col("turn").alias("turn"), digest.alias("digest"), n_words(text).alias("words"))
    turns = row_numbers(slim, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest").asc()], "place").drop("turn")
    turns = written(turns, "trie-turns")
    sizes = written(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    heads = sizes.select(F.col("conv_id").alias("head"), F.col("n").alias("n_head"))
    convs = sizes.withColumns({"h": shared_turns(F.col("conv_id")), "head": group_head(F.col("conv_id"))}).join(heads, "head", "left")
    taken = F.least("h", F.coalesce("n_head", F.lit(0)))
    convs = convs.withColumn("taken", taken).withColumn("n_turns", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = written(convs.select("conv_id", "head", "h", "taken", "n_turns"), "trie-conversations")
    first = turns.where("place <= 3").withColumnRenamed("conv_id", "head")
    from_head = convs.join(first, "head").where("place <= taken").select("conv_id", F.col("place").alias("depth"), "digest", "words", "n_turns")
    own = turns.join(convs, "conv_id").where("place > h")
    own = own.select("conv_id", (F.col("taken") + F.col("place") - F.col("h")).alias("depth"), "digest", "words", "n_turns")
    both = from_head.withColumn("depth", F.col("depth").cast("long")).unionByName(own.withColumn("depth", F.col("depth").cast("long")))
    return convs.select("conv_id", "n_turns"), both.withColumn("is_end", F.col("depth") == F.col("n_turns")).drop("n_turns")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """``turns`` with the 128-bit key of the prefix that ends at each, by exclusive or in two levels over range partitions."""
    halves = [F.conv(F.substring("digest", at, 16), 16, -10).cast("long") for at in (1, 17)]
    seats = {f"x{k}": F.xxhash64(F.lit(k), "depth", half) for k, half in enumerate(halves)}
    dealt = turns.withColumns(seats).drop("digest").repartitionByRange("conv_id", "depth")
    laid = written(dealt.withColumn("pid", F.spark_partition_id()), "trie-laid")
    parts = laid.groupBy("pid", "conv_id").agg(*[F.bit_xor(f"x{k}").alias(f"p{k}") for k in (0, 1)])
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("pid", "conv_id", *[F.coalesce(F.bit_xor(f"p{k}").over(before), F.lit(0)).alias(f"b{k}") for k in (0, 1)])
    inside = Window.partitionBy("pid", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys = [F.col(f"b{k}").bitwiseXOR(F.bit_xor(f"x{k}").over(inside)).alias(f"k{k}") for k in (0, 1)]
    return laid.join(offsets, ["pid", "conv_id"]).select("conv_id", "depth", *keys, "words", "is_end")


# ---------------------------------------------------------------- time-forward processing


class Messages:
    """A priority queue of (minus depth, conv_id, leaves, saved); beyond ``limit`` rows it spills sorted runs."""

    RECORD = "<qqqq"

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit, self.heap, self.runs, self.spills = limit, [], [], 0

    def push(self, depth: int, conv_id: int, leaves: int, saved: int) -> None:
        if len(self.heap) >= self.limit:
            self._spill()
        heapq.heappush(self.heap, (-depth, conv_id, leaves, saved))

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()  # has no name; gone with the task
        for message in sorted(self.heap):
            file.write(struct.pack(self.RECORD, *message))
        file.seek(0)
        run = iter(lambda: file.read(struct.calcsize(self.RECORD)), b"")
        self.heap = []
        # (first message, rest) of each run, smallest first
        heapq.heappush(self.runs, (struct.unpack(self.RECORD, next(run)), self.spills, run, file))
        self.spills += 1

    def take(self, depth: int, conv_id: int) -> tuple[int, int]:
        """Sums of the messages to this node, which must be the next in the order."""
        leaves = saved = 0
        while self.heap and self.heap[0][0] == -depth and self.heap[0][1] == conv_id:
            message = heapq.heappop(self.heap)
            leaves, saved = leaves + message[2], saved + message[3]
        while self.runs and self.runs[0][0][0] == -depth and self.runs[0][0][1] == conv_id:
            message, at, run, file = self.runs[0]
            leaves, saved = leaves + message[2], saved + message[3]
            rest = next(run, None)
            if rest is None:
                heapq.heappop(self.runs)
                file.close()
            else:
                heapq.heapreplace(self.runs, (struct.unpack(self.RECORD, rest), at, run, file))
        return leaves, saved


_NODE = ("conv_id", "depth", "up_conv", "up_depth", "f_conv", "f_depth", "leaves", "saved")
_DONE = "conv_id long, depth long, up_conv long, up_depth long, leaves long, saved long"


def _forward(roots_only: bool, limit: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of the nodes of a shard, which come in reverse level order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = Messages(limit)
        for batch in batches:
            out = []
            for conv_id, depth, up_conv, up_depth, f_conv, f_depth, leaves, saved in zip(*[c.to_pylist() for c in batch.columns]):
                more_leaves, more_saved = queue.take(depth, conv_id)
                leaves, saved = leaves + more_leaves, saved + more_saved
                top = conv_id == f_conv and depth == f_depth
                if not top:
                    queue.push(up_depth, up_conv, leaves, saved)
                if top or not roots_only:
                    out.append((conv_id, depth, up_conv, up_depth, leaves, saved))
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], [c.split()[0] for c in _DONE.split(", ")])

    return run


def _passed(nodes: DataFrame, roots_only: bool, limit: int, name: str) -> DataFrame:
    sorted_nodes = nodes.select(*_NODE).repartition("f_conv", "f_depth").sortWithinPartitions(F.desc("depth"), F.asc("conv_id"))
    return written(sorted_nodes.mapInArrow(_forward(roots_only, limit), _DONE), name)


def _with_fragments(nodes: DataFrame, paths: DataFrame, width: int) -> DataFrame:
    """``nodes`` with the root of their fragment. ``paths`` has node and members of every conversation at every depth."""
    light = paths.where(F.col("n_convs") <= width).groupBy(F.col("member").alias("conv_id"))
    light = light.agg(F.min("depth").alias("l_depth"), F.min_by("conv_id", "depth").alias("l_conv"))
    blocks = paths.where(F.col("depth") % width == 0).select(F.col("member").alias("conv_id"), F.col("depth").alias("b_depth"), F.col("conv_id").alias("b_conv"))
    found = nodes.join(light, "conv_id", "left").withColumn("b_depth", F.col("depth") - F.col("depth") % width).join(blocks, ["conv_id", "b_depth"], "left")
    heavy, deep = F.col("n_convs") > width, F.col("b_depth") > F.col("l_depth")
    pick = lambda own, block, top: F.when(heavy, F.col(own)).when(deep, F.col(block)).otherwise(F.col(top))
    return found.withColumns({"f_conv": pick("conv_id", "b_conv", "l_conv"), "f_depth": pick("depth", "b_depth", "l_depth")}).select(*_NODE, "n_convs")


def subtree_totals(nodes: DataFrame, paths: DataFrame, most: int, span: int = SPAN, limit: int = QUEUE_ROWS, round_: int = 1) -> DataFrame:
    """conv_id, depth, leaves, saved: sums over each node's subtree.

    ``nodes``: conv_id, depth, up_conv, up_depth (null at the root), n_convs,
    leaves, saved (own values). ``most``: an upper bound of the conversations
    and of the depths.
    """
    width = span**round_
    if width >= most:
        whole = nodes.select("conv_id", "depth", "up_conv", "up_depth", "leaves", "saved").withColumns({"f_conv": F.lit(-1).cast("long"), "f_depth": F.lit(0).cast("long")})
        top = F.col("up_conv").isNull()
        whole = whole.withColumns({"f_conv": F.when(top, F.col("conv_id")).otherwise(F.col("f_conv")), "f_depth": F.when(top, F.col("depth")).otherwise(F.lit(-1).cast("long"))})
        laid = whole.select(*_NODE).repartition(1).sortWithinPartitions(F.desc("depth"), F.asc("conv_id"))
        return written(laid.mapInArrow(_forward(False, limit), _DONE), f"trie-top-{round_}").select("conv_id", "depth", "leaves", "saved")
    placed = written(_with_fragments(nodes, paths, width), f"trie-shards-{round_}")
    roots = _passed(placed, True, limit, f"trie-roots-{round_}")
    ids, sums = ["conv_id", "depth"], [F.sum(c).alias(c) for c in ("leaves", "saved")]

    def sent(messages: DataFrame) -> DataFrame:
        hung = messages.where("up_conv IS NOT NULL").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth"))
        return hung.agg(*[F.sum(c).alias(f"in_{c}") for c in ("leaves", "saved")])

    # the tree of the fragments that something enters
    entered = sent(roots).join(placed.select(*ids, "f_conv", "f_depth"), ids).groupBy(F.col("f_conv").alias("conv_id"), F.col("f_depth").alias("depth"))
    entered = written(entered.agg(F.sum("in_leaves").alias("leaves"), F.sum("in_saved").alias("saved")), f"trie-entered-{round_}")
    tops = entered.join(placed.select(*ids, "up_conv", "up_depth", "n_convs"), ids)
    over = placed.select(F.col("conv_id").alias("up_conv"), F.col("depth").alias("up_depth"), F.col("f_conv").alias("o_conv"), F.col("f_depth").alias("o_depth"))
    tops = tops.join(over, ["up_conv", "up_depth"], "left").drop("up_conv", "up_depth").withColumnsRenamed({"o_conv": "up_conv", "o_depth": "up_depth"})
    outer = subtree_totals(written(tops, f"trie-tops-{round_}"), paths, most, span, limit, round_ + 1)
    # what entered from outside, handed on to the nodes it hangs on
    with_outer = roots.select(*ids, "up_conv", "up_depth", "leaves", "saved").unionByName(
        roots.select(*ids, "up_conv", "up_depth").join(outer, ids)
    )
    total = with_outer.groupBy(*ids, "up_conv", "up_depth").agg(*sums)
    full = placed.join(sent(total), ids, "left")
    full = full.withColumns({c: F.col(c) + F.coalesce(f"in_{c}", F.lit(0)) for c in ("leaves", "saved")})
    return _passed(full, False, limit, f"trie-totals-{round_}").select("conv_id", "depth", "leaves", "saved")


# ---------------------------------------------------------------- digests of long id lists


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a node in order, up to ``IDS_PER_ROW`` ids each, from (conv_id, depth, member) in order."""
    names = ["conv_id", "depth", "first", "ids"]
    node, members = None, []

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([members[0]], pa.int64()), pa.array([",".join(map(str, members))])], names)

    for batch in batches:
        for conv_id, depth, member in zip(*[c.to_pylist() for c in batch.columns]):
            if members and (node != (conv_id, depth) or len(members) >= IDS_PER_ROW):
                yield row()
                members = []
            node = (conv_id, depth)
            members.append(member)
    if members:
        yield row()


def _hash_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node; the list is streamed through the hash, never put together."""
    names, node, state = ["conv_id", "depth", "ends_sha256"], None, None

    def row() -> pa.RecordBatch:
        return pa.record_batch([pa.array([node[0]], pa.int64()), pa.array([node[1]], pa.int64()), pa.array([state.hexdigest()])], names)

    for batch in batches:
        for conv_id, depth, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
            if node != (conv_id, depth):
                if node:
                    yield row()
                node, state = (conv_id, depth), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
    if node:
        yield row()


def end_digests(ends: DataFrame) -> DataFrame:
    """``ends``: conv_id, depth, member. SHA-256 of the members of each node, ascending, joined by commas."""
    packed = ends.select("conv_id", "depth", "member").repartitionByRange("conv_id", "depth", "member").sortWithinPartitions("conv_id", "depth", "member")
    packed = packed.mapInArrow(_pack, "conv_id long, depth long, first long, ids string")
    dealt = packed.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "first")
    return dealt.mapInArrow(_hash_lists, "conv_id long, depth long, ends_sha256 string")


# ---------------------------------------------------------------- the trie


def prefix_trie(conversations: DataFrame, span: int = SPAN, limit: int = QUEUE_ROWS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``conversations`` needs conv_id, turn, role and text; other columns are not looked at.
    """
    if span < 2:
        raise ValueError("span must be at least 2")
    convs, turns = rebuilt(conversations)
    keyed = written(prefix_keys(turns), "trie-keys")
    nodes = keyed.groupBy("k0", "k1").agg(
        F.min("conv_id").alias("node"), F.max("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words")
    )
    nodes = written(nodes, "trie-nodes")
    size = convs.agg(F.count(F.lit(1)), F.min("conv_id"), F.max("n_turns")).first()
    n, least, deepest = size[0], size[1], size[2] or 0
    paths = keyed.join(nodes.select("k0", "k1", "node", "n_convs"), ["k0", "k1"])
    paths = paths.select(F.col("conv_id").alias("member"), "depth", F.col("node").alias("conv_id"), "n_convs", "is_end")
    root = convs.select(F.col("conv_id").alias("member"), F.lit(0).cast("long").alias("depth"), F.lit(least).cast("long").alias("conv_id"), F.lit(n).alias("n_convs"), (F.col("n_turns") == 0).alias("is_end"))
    paths = written(paths.unionByName(root), "trie-paths")
    below = paths.select(F.col("member").alias("conv_id"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("up_conv"))
    named = nodes.select(F.col("node").alias("conv_id"), "depth", "n_convs", "words")
    named = named.join(below, ["conv_id", "depth"]).withColumn("up_depth", F.col("depth") - 1)
    top = convs.limit(1).select(
        F.lit(least).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(n).alias("n_convs"), F.lit(0).cast("long").alias("words"),
        F.lit(None).cast("long").alias("up_conv"), F.lit(None).cast("long").alias("up_depth"),
    )
    named = written(named.unionByName(top), "trie-named")
    children = named.where("up_conv IS NOT NULL").groupBy(F.col("up_conv").alias("conv_id"), F.col("up_depth").alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    named = named.join(children, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    named = written(named, "trie-children")
    valued = named.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")})
    totals = subtree_totals(valued.drop("words", "n_children"), paths, max(n, deepest + 1), span, limit)
    digests = written(end_digests(paths.where("is_end")), "trie-ends")
    found = named.join(totals, ["conv_id", "depth"]).join(digests, ["conv_id", "depth"], "left")
    return found.select(
        "conv_id", "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
