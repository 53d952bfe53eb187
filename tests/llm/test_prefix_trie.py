"""The prefix trie against a brute-force dictionary of prefixes."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import prefix_trie as P
from panelforge.llm.common import WORD

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [r[3:] for r in sorted(v)] for c, v in own.items()}
    new = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = c - (abs(c) % 20) * (1 if c > 0 else -1)
        new[c] = own.get(head, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in new.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        words = len(re.findall(WORD, node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in children[node])
    out = []
    for node, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(new[c]) == len(node))))
        up = min(members[node[:-1]]) if node else None
        out.append((min(ms), len(node), up, len(ms), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def found(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(*cols).collect())


def made(seed):
    """A hot first turn, equal conversations, a very long one and its near copy, nulls, ties, repeated rows."""
    rng = random.Random(seed)
    texts = ["yes", "no", "well  then", "a b c", "", None]
    rows = []
    for c in rng.sample(range(-30, 400), 160):
        turns = ["hot start" if rng.random() < 0.5 else f"start {c}"] + rng.choices(texts, k=rng.randint(0, 5))
        rows += [(c, k, rng.choice(["user", "assistant", None]) if k else "user", t) for k, t in enumerate(turns)]
    for c in range(1000, 1060):  # the same conversation
        rows += [(c, k, "user", f"same {k}") for k in range(6)]
    for c in (2003, 2005):
        rows += [(c, k, "user", f"deep {min(k, 150 + c)}") for k in range(400)]
    rows += [(5000, None, None, "z"), (5000, 1, "user", "a"), (5000, 1, "user", "b"), (5000, 1, "user", "b"), (None, 0, "user", "nobody"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize(("span", "limit"), [(128, 1000), (2, 3), (5, 10)])
def test_nodes_equal_brute_force(spark, span, limit):
    rows = made(span)
    if span == 2:
        rows = [r for r in rows if r[0] is None or r[0] < 2000]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(P.prefix_trie(df, span, limit)) == brute(rows)


def test_small_and_odd_tables(spark):
    assert P.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert P.prefix_trie(spark.createDataFrame([(None, 1, "user", "a")], SCHEMA)).collect() == []
    turnless = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4][0]
    rows = [(turnless, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(P.prefix_trie(df)) == brute(rows) and len(brute(rows)) == 1
    names = ["node", "depth", "digest", "words", "place", "member", "n_convs", "k0", "pid", "up_conv"]
    rows = made(9)
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("own").alias(n) for n in names])
    assert found(P.prefix_trie(clash)) == brute(rows)


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert found(P.prefix_trie(df, 8, 20)) == brute([tuple(r) for r in df.collect()])


def test_queue_spills_in_order():
    rng, queue = random.Random(3), P.Messages(7)
    sent = defaultdict(int)
    for depth in range(40, -1, -1):
        for c in sorted({c for d, c in sent if d == depth}):
            assert queue.take(depth, c) == (sent[depth, c], sent[depth, c] * 2)
        for _ in range(25 if depth else 0):
            up, c = rng.randint(max(0, depth - 3), depth - 1), rng.randint(0, 30)
            queue.push(up, c, 1, 2)
            sent[up, c] += 1
    assert queue.heap == [] and queue.runs == []
