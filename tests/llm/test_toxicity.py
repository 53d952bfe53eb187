import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelforge.llm import toxicity as T
from tests.llm import cases

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = T.predict(docs.select("doc_id", "text"), labels).join(labels, "doc_id").where(T.held_out(F.col("doc_id")))
    n = {(r.toxic, r.toxic_predicted): r.n for r in scored.groupBy("toxic", "toxic_predicted").agg(F.count("*").alias("n")).collect()}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.8  # recall
    assert n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.9  # precision


def test_pairs_of_features_count(spark):
    # toxic only when both terms meet: no additive weights can tell
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for _ in range(1200):
        a, b = rng.integers(0, 2, 2)
        docs.append(np.flatnonzero([a, b, *rng.integers(0, 2, 6)]))
        labels.append(float(a != b))
    machine = T.FactorizationMachine(8, 4).fit(docs, np.array(labels), steps=3000, rate=0.3)
    rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    predicted = machine.score(rows, np.concatenate(docs), len(docs)) >= 0.5
    assert (predicted == np.array(labels)).mean() > 0.95


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    df = cases.documents(spark)
    labels = spark.read.parquet(f"{cases.SF}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(T.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r.doc_id: r.toxic_score for r in T.predict(df, x).collect()} for x in (labels, turned))
    assert one == two


@pytest.mark.parametrize("clash", [False, True])
def test_cases(spark, clash):
    rng = random.Random(7)
    df = cases.table(spark, clash=clash)
    labels = spark.createDataFrame([(d, 1, rng.randint(0, 1)) for d in range(1, 29)] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    got = T.predict(df, labels)
    assert got.columns == [*df.columns, "toxic_score", "toxic_predicted"]
    rows = got.collect()
    assert len(rows) == len(cases.rows())
    assert all(0 <= r.toxic_score <= 1 and r.toxic_predicted == (r.toxic_score >= 0.5) for r in rows)
    empty = {r.toxic_score for r in rows if not (r.text or "").strip()}
    assert len(empty) == 1


def test_empty_tables_and_one_class(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    none = labels.where("false")
    assert T.predict(cases.table(spark, []), labels).collect() == []
    assert {r.toxic_predicted for r in T.predict(cases.table(spark), labels).collect()} == {0}
    assert T.predict(cases.table(spark), none).count() == len(cases.rows())


def test_beginnings_are_terms_of_their_own():
    def terms(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return set(T.document_terms(raw, np.array([0, len(raw)]))[0].tolist())

    assert not terms("hateful") >= terms("hate")  # the whole word
    assert len(terms("hateful") & terms("hatefully")) == 3  # the beginnings of 4, 5 and 6 letters
    assert terms("Hate, HATE") == terms("hate")


def test_a_null_id_is_not_held_out(spark):
    rows = spark.createDataFrame([(None,), (7,)], "doc_id long").select("doc_id", T.held_out(F.col("doc_id")).alias("h")).collect()
    assert {r.doc_id: r.h for r in rows} == {None: False, 7: zlib.crc32(b"7") % 5 == 0}
