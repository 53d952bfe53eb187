import ast
import random
import zlib
from itertools import combinations
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelforge.llm import decontaminate, mixing, near_dedup, toxicity
from panelforge.llm.queries import ORACLE, QUERIES
from tests.llm import cases
from tests.llm.test_near_dedup import shingles

ROOT = Path(__file__).resolve().parents[2]


def test_stages_take_effect(spark):
    docs = cases.documents(spark)
    steps, at = [docs], docs
    for _, stage in corpus_pipeline.STAGES:
        at = spark.createDataFrame(stage(spark, at, cases.SF).collect(), stage(spark, at, cases.SF).schema)
        steps.append(at)
    assert all(s.columns == docs.columns or sorted(s.columns) == sorted(docs.columns) for s in steps[:-1])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in steps]
    scored = toxicity.predict(docs, spark.read.parquet(f"{cases.SF}/labels.parquet")).collect()
    assert ids[1] == {r.doc_id for r in scored if r.toxic_predicted == 0}
    assert ids[2] == {r.doc_id for r in near_dedup.near_duplicates(steps[1], corpus_pipeline.NEAR_PERCENT).collect() if r.kept} and len(ids[2]) < len(ids[1])
    bad = {r.doc_id for r in decontaminate.contaminated(steps[2], spark.read.parquet(f"{cases.SF}/benchmark.parquet")).collect()}
    assert ids[3] == ids[2] - bad
    assert ids[4] <= ids[3] and len(ids[4]) > 0.9 * len(ids[3])
    assert steps[5].count() == steps[4].count()
    assert {"shard", "slot"} <= set(steps[5].columns)


def test_stages_accept_empty_documents(spark):
    at = cases.documents(spark).where("false")
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, cases.SF)
        assert at.count() == 0


def test_stages_keep_columns_that_bear_the_names_of_added_ones(spark):
    added = ("toxic_score", "toxic_predicted", *mixing.ADDED)
    plain = cases.documents(spark)
    docs = plain.select("*", *[F.lit(f"own {c}").alias(c) for c in added])
    for work in (lambda d: toxicity.drop_toxic(d, spark.read.parquet(f"{cases.SF}/labels.parquet")), mixing.mixture):
        got = work(docs)
        assert got.columns == docs.columns
        assert all(r[c] == f"own {c}" for r in got.select(*added).distinct().collect() for c in added)
        wanted = work(plain)
        assert got.select(*plain.columns).exceptAll(wanted).isEmpty() and got.count() == wanted.count()


def test_sharding_query_equals_its_contract(spark):
    rows = QUERIES["op7_sharding"](spark, cases.SF).collect()
    texts = dict(cases.pairs_of(cases.documents(spark)))
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    slots = {}
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(body) + 16, zlib.crc32(body), "bytes", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) <= set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = {k: sum(r["size"] for r in rows if r.shard == k) for k in range(40)}
    target, largest = sum(sizes.values()) / 40, max(r["size"] for r in rows)
    assert all(abs(n - target) <= largest + 0.02 * target for n in sizes.values())


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{cases.SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    df = QUERIES[name](spark, cases.SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "panelforge").rglob("*.py"):
        if "llm" in path.parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or ""] if isinstance(node, ast.ImportFrom) else []
            assert not any(".llm" in n or n == "corpus_pipeline" for n in names), path


def test_near_dedup_stage_equals_brute_force_at_080(spark):
    rng = random.Random(11)
    base = cases.words(rng, 124)  # 120 shingles
    docs = [(1, " ".join(base), "en", "a", 0)]
    for k, changes in enumerate((1, 2, 2, 2, 3, 4), 2):  # each change makes 5 of the shingles others: 0.92, 0.85, 0.78, 0.71
        w = list(base)
        for at in range(10, 10 + 20 * changes, 20):
            w[at] = f"changed{k}{at}"
        docs.append((k, " ".join(w), "en", "a", 0))
    for k, n in enumerate((100, 101, 102, 103, 104, 110, 96), 10):  # a part and other words: 0.80 and about it
        own = cases.words(rng, 124)
        docs += [(10 * k, " ".join(own), "en", "a", 0), (10 * k + 1, " ".join(own[:n]), "en", "a", 0)]
    df = cases.table(spark, docs)
    texts = [*cases.pairs_of(df), *cases.pairs_of(cases.documents(spark).select((F.col("doc_id") + 1000).alias("doc_id"), "text"))]
    sets = {d: shingles(t) for d, t in texts}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    between = 0
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 5 * len(x & y) >= 4 * len(x | y):
            between += 20 * len(x & y) < 17 * len(x | y)
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert between >= 5
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, rows, cases.SF).collect()} == {d for d in sets if find(d) == d}


@pytest.mark.parametrize("percent", [80, 85, 90])
def test_bands_miss_one_in_a_million(percent):
    rows = near_dedup.band_rows(percent)
    assert (1 - (percent / 100) ** rows) ** (near_dedup.BUCKETS // rows) <= 1e-6
    assert percent != 85 or (near_dedup.BUCKETS // rows, rows) == (36, 7)
