from pyspark.sql import functions as F

from panelforge.functions.columns import parse_date, round_to_class, threshold_flag, year_of_fiscal
from panelforge.operators import labels as L
from panelforge.operators import ranks as R


def test_row_rank_nulls_first_and_tie_break(spark):
    df = spark.createDataFrame([("a", 2000, 3.0), ("b", 2000, 3.0), ("c", 2000, None), ("d", 2000, 1.0)],
                               "CODE string, YEAR int, V double")
    got = {r.CODE: r.V_RANKING for r in R.row_rank(df, ["V"]).collect()}
    assert got == {"c": 1, "d": 2, "a": 3, "b": 4}


def test_dense_rank_ties_share_and_nulls_stay_null(spark):
    df = spark.createDataFrame([("a", 2000, 3.0), ("b", 2000, 3.0), ("c", 2000, None), ("d", 2000, 1.0)],
                               "CODE string, YEAR int, V double")
    got = {r.CODE: r.V_RANK for r in R.dense_rank_by(df, "V").collect()}
    assert got == {"a": 1, "b": 1, "c": None, "d": 2}


def test_dense_rank_of_k_distinct_values_ends_at_k(spark):
    df = spark.createDataFrame([(str(i), 2000, float(i % 7)) for i in range(50)], "CODE string, YEAR int, V double")
    assert R.dense_rank_by(df, "V").agg(F.max("V_RANK")).first()[0] == 7


def test_top_n_plans_window_group_limit(spark):
    df = spark.createDataFrame([(str(i), 2000 + i % 3, float(i)) for i in range(30)], "CODE string, YEAR int, V double")
    top = R.top_n(df, [F.col("V").desc(), F.col("CODE")], 2)
    assert top.count() == 6
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_lead_bridges_gaps_unless_strict(spark):
    df = spark.createDataFrame([("A", 1995, 0.1), ("A", 1997, 0.3)], "CODE string, YEAR int, RETURNS double")
    a = {r.YEAR: r.TARGET for r in L.lead_value(df).collect()}
    b = {r.YEAR: r.TARGET for r in L.lead_value(df, strict=True).collect()}
    assert a == {1995: 0.3, 1997: None}
    assert b == {1995: None, 1997: None}


def test_labels_null_compares_false(spark):
    p = spark.createDataFrame([("A", 2000, 0.5), ("A", 2001, -0.1)], "CODE string, YEAR int, RETURNS double")
    idx = spark.createDataFrame([(2000, 0.2), (2001, 0.3)], "YEAR int, INDEX_RETURNS double")
    got = {r.YEAR: r for r in L.next_period_labels(p, idx).collect()}
    assert got[2000].RETURNS_CAT == "POSITIVE" and got[2000].RETURNS_vs_INDEX == "WINS"
    assert got[2000].RETURNS_NEXT_CAT == "NEGATIVE" and got[2000].RETURNS_vs_INDEX_NEXT == "LOSES"
    assert got[2001].RETURNS_NEXT is None and got[2001].RETURNS_NEXT_CAT == "NEGATIVE"
    assert got[2001].RETURNS_vs_INDEX_NEXT == "LOSES"


def test_compound_label(spark):
    df = spark.createDataFrame([(0.2, 0.1), (-0.05, -0.1), (0.1, 0.2), (None, 0.1)], "RETURNS_NEXT double, INDEX_RETURNS_NEXT double")
    got = [r.RETURNS_vs_INDEX_NEXT for r in L.compound_wins(df).collect()]
    assert got == ["WINS", "LOSES", "LOSES", "LOSES"]


def test_encode_label_alphabetical(spark):
    df = spark.createDataFrame([("WINS",), ("LOSES",), ("WINS",)], "L string")
    got = {r.L: r.L_CODE for r in L.encode_label(df, "L").collect()}
    assert got == {"LOSES": 0, "WINS": 1}


def test_map_categories_passthrough(spark):
    df = spark.createDataFrame([("Banks",), ("Unlisted",)], "INDUSTRY01 string")
    m = spark.createDataFrame([("Banks", "Financial Services")], "FROM string, TO string")
    got = sorted(r.SECTOR for r in L.map_categories(df, m, "INDUSTRY01", "SECTOR").collect())
    assert got == ["Financial Services", "Unlisted"]


def test_scalar_helpers(spark):
    r = spark.range(1).select(
        year_of_fiscal(F.lit("2017-12")).alias("y"),
        year_of_fiscal(F.lit("bad")).alias("bad"),
        parse_date(F.lit("03-31-2001")).alias("us"),
        parse_date(F.lit("2001-03-31")).alias("iso"),
        round_to_class(F.lit(0.5)).alias("half"),
        round_to_class(F.lit(1.5)).alias("three_halves"),
        threshold_flag(F.lit(0.8)).alias("edge"),
    ).first()
    assert r.y == 2017 and r.bad is None
    assert str(r.us) == "2001-03-31" and str(r.iso) == "2001-03-31"
    assert r.half == 0 and r.three_halves == 2
    assert r.edge is False


def test_long_short_names_round_trip():
    from panelforge.sources.readers import long_name, short_name

    assert short_name("COMMON_SIZE_RATIOS__ROC_JOEL_GREENBLATT") == "CSR__ROC_JOEL_GREENBLATT"
    assert short_name("VALUATION_AND_QUALITY__MARKET_CAP") == "VQ_MARKET_CAP"
    assert short_name("CODE") == "CODE"
    for c in ("CSR__ROE", "VQ_MARKET_CAP", "IS_EPS_BASIC", "BS__TOTAL_ASSETS", "FISCAL_YEAR"):
        assert short_name(long_name(c)) == c


def test_unique_rank_of_sum(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3), ("C", 1)], "CODE string, V int")
    got = {r.CODE: r.RANK_UNIQUE for r in R.unique_rank_of_sum(df, ["CODE"], "V").collect()}
    assert got == {"C": 1, "A": 2, "B": 3}  # A and B tie on 3: broken by CODE
    assert R.unique_rank_of_sum(df, ["CODE"], "V", n=2).count() == 2


def test_dense_ranks_equal_brute_force_with_a_hot_value(spark):
    rows = [(y, i, 7.0 if i % 3 else float(i % 11) - 5, None if i % 5 == 0 else float(i % 4)) for y in (2000, None) for i in range(900)]
    rows += [(2001, 1, 0.0, -0.0), (2001, 2, -0.0, 0.0), (2001, 3, None, None)]
    df = spark.createDataFrame(rows, "YEAR int, ID int, V double, U double").repartition(7)
    got = R.dense_ranks(df, {"A": ("V", False), "B": ("U", True), "V": ("V", True)}).collect()
    assert len(got) == len(rows)

    def rank(year, v, at, up):
        if v is None:
            return None
        distinct = sorted({r[at] + 0.0 for r in rows if r[0] == year and r[at] is not None}, reverse=not up)
        return distinct.index(v + 0.0) + 1

    want = sorted(((y, i, rank(y, v, 2, False), rank(y, u, 3, True), rank(y, v, 2, True)) for y, i, v, u in rows), key=str)
    assert sorted(((r.YEAR, r.ID, r.A, r.B, r.V) for r in got), key=str) == want


def test_a_value_over_many_partitions_is_counted_once(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(4000).selectExpr("1 YEAR", "cast(id as int) ID", "case when id < 3500 then 5.0D else double(id) end V")
        r = R.dense_rank_by(df, "V", ascending=True).agg(F.min("V_RANK"), F.max("V_RANK"), F.count(F.when(F.col("V_RANK") == 1, 1))).first()
        assert tuple(r) == (1, 501, 3500)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_dense_ranks_join_the_rows_once(spark):
    df = spark.range(50).selectExpr("1 YEAR", "id ID", *[f"double(id % {k + 2}) C{k}" for k in range(9)])
    out = R.dense_ranks(df, {f"R{k}": (f"C{k}", True) for k in range(9)})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # the partitions' offsets, and the ranks of a row
