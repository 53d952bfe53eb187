import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelforge.llm import sharding as S
from tests.llm import cases


def size(text):
    return len((text or "").encode()) + 16


def check(rows, shards, n):
    assert len(rows) == n
    slots, sizes = defaultdict(list), defaultdict(int)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        sizes[r.shard] += size(r.text)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_sizes_are_near_equal(spark):
    rows = S.shard(cases.documents(spark), 8).collect()
    sizes = check(rows, 8, 200)
    largest, target = max(size(r.text) for r in rows), sum(sizes.values()) / 8
    assert all(abs(s - target) <= largest + 0.02 * target for s in sizes.values())
    again = {(r.doc_id, r.shard, r.slot) for r in S.shard(cases.documents(spark).repartition(7), 8).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_a_large_group_of_copies_is_split_and_small_ones_are_not(spark):
    data = [(i, "the same text " * 5, None, None, None) for i in range(2000)] + [(5000 + i, f"{i // 2} text {i // 2}", None, None, None) for i in range(4000)]
    rows = S.shard(cases.table(spark, data), 10).collect()
    sizes = check(rows, 10, 6000)
    target = sum(sizes.values()) / 10
    assert all(abs(s - target) < 0.03 * target for s in sizes.values())
    where = defaultdict(set)
    for r in rows:
        where[r.text].add(r.shard)
    assert len(where["the same text " * 5]) > 3
    assert sum(len(s) > 1 for s in where.values()) == 1


def test_copies_no_larger_than_the_largest_row_stay_together(spark):
    data = [(i, f"group {i // 6} " * 40, None, None, None) for i in range(600)] + [(9000, "one long text " * 300, None, None, None)]
    rows = S.shard(cases.table(spark, data), 40).collect()
    sizes = check(rows, 40, 601)
    largest, target = max(size(r.text) for r in rows), sum(sizes.values()) / 40
    assert all(abs(s - target) <= largest + 0.02 * target for s in sizes.values())
    where = defaultdict(set)
    for r in rows:
        where[r.text].add(r.shard)
    assert all(len(s) == 1 for s in where.values())


def test_shards_are_slices_of_the_sorted_keys(spark):
    df = cases.documents(spark)
    rows = S.shard(df.withColumn("key", S.sort_key(S.text_of("text"), F.col("doc_id"))), 8).collect()
    keys = spark.createDataFrame([(r.key, size(r.text)) for r in rows], "key string, size long")
    splitters = S.find_splitters(keys, 8, 0.01)
    assert all(r.shard == sum(r.key >= s for s in splitters) for r in rows)
    total, below = sum(size(r.text) for r in rows), 0
    by_text = defaultdict(int)
    for r in rows:
        by_text[r.key[:16]] += size(r.text)
    ends, order = [], sorted(by_text)
    for k in order:
        below += by_text[k]
        ends.append(below)
    for k, s in enumerate(splitters, 1):  # no boundary between texts is nearer than the tolerance or the one taken
        at = sum(by_text[x] for x in order if x < s)
        assert abs(at - total * k // 8) <= max(0.01 * total / 8, min(abs(e - total * k // 8) for e in ends))


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("shards", [1, 3, 40])
def test_cases(spark, clash, shards):
    df = cases.table(spark, clash=clash)
    got = S.shard(df, shards)
    assert got.columns == [*[c for c in df.columns if c not in ("shard", "slot")], "shard", "slot"]
    check(got.collect(), shards, len(cases.rows()))


def test_empty_table(spark):
    assert S.shard(cases.table(spark, []), 4).collect() == []


def test_only_dataframe_functions_run(spark):
    assert not re.search("Python|Pandas|Arrow", S.shard(cases.documents(spark), 4)._jdf.queryExecution().toString())
