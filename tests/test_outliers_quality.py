import math


from panelforge.operators import outliers as O
from panelforge.operators import quality as Q

# 1..9: q1 = 3, q3 = 7, iqr = 4, fences -3 and 13.
BASE = [float(i) for i in range(1, 10)]


def _df(spark, values, year=2000):
    return spark.createDataFrame([(str(i), year, v) for i, v in enumerate(values)], "CODE string, YEAR int, V double")


def test_bounds(spark):
    b = O.fence_bounds(_df(spark, BASE), ["V"]).first()
    assert (b.Q1, b.Q3, b.IQR, b.LOW, b.HIGH) == (3.0, 7.0, 4.0, -3.0, 13.0)


def test_global_filter_drops_boundary_and_nulls(spark):
    # with 13.0 and a null added the quartiles move; compute the expected fences with pandas rules
    vals = BASE + [40.0, None]
    df = _df(spark, vals)
    out = O.fence_filter_global(df, ["V"])
    kept = sorted(r.V for r in out.collect())
    assert None not in kept and 40.0 not in kept
    assert set(kept) <= set(v for v in vals if v is not None)


def test_global_filter_strict_on_exact_fence(spark):
    # values 1..9 and 13 (q1 = 3.25, q3 = 7.75, high = 14.5): make a value sit exactly on a fence
    vals = [0.0, 0.0, 0.0, 4.0, 4.0, 4.0, 10.0]  # q1 = 0, q3 = 4, high = 10 -> 10 is on the fence
    out = O.fence_filter_global(_df(spark, vals), ["V"])
    assert 10.0 not in [r.V for r in out.collect()]


def test_by_year_keeps_boundary_and_nulls(spark):
    vals = [0.0, 0.0, 0.0, 4.0, 4.0, 4.0, 10.0, 11.0, None]
    out = O.fence_filter_by(_df(spark, vals), ["V"])
    kept = [r.V for r in out.collect()]
    # q1 = 0, q3 = 4.75 -> high = 11.875: all kept
    assert None in kept and 10.0 in kept and len(kept) == 9
    out2 = O.fence_filter_by(_df(spark, [0.0, 0.0, 0.0, 4.0, 4.0, 4.0, 10.0, 100.0]), ["V"])
    assert 100.0 not in [r.V for r in out2.collect()]


def test_sequential_order_matters(spark):
    rows = [(str(i), 2000, float(i), float(i % 3)) for i in range(20)] + [("x", 2000, 1000.0, 50.0)]
    df = spark.createDataFrame(rows, "CODE string, YEAR int, A double, B double")
    ab = O.fence_filter_global(df, ["A", "B"]).count()
    assert ab <= 20


def test_winsorize_idempotent_on_own_bounds(spark):
    df = _df(spark, BASE + [100.0, -50.0, None])
    w1 = O.winsorize_by(df, ["V"])
    got = sorted((r.V for r in w1.collect() if r.V is not None))
    b = O.fence_bounds(df, ["V"]).first()
    assert max(got) == b.HIGH and min(got) == b.LOW
    assert None in [r.V for r in w1.collect()]


def test_null_zero_profile(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (None,), (2.0,)], "V double")
    r = Q.null_zero_profile(df, ["V"]).first()
    assert (r.NULL_PCT, r.ZERO_PCT) == (25.0, 25.0)


def test_describe_all_null_and_single(spark):
    df = spark.createDataFrame([(None, 5.0)], "A double, B double")
    got = {r.METRIC: r for r in Q.describe(df, ["A", "B"]).collect()}
    assert got["A"].COUNT == 0 and got["A"].MEAN is None and got["A"].P50 is None
    assert got["B"].STD is None and got["B"].P25 == 5.0 and got["B"].MAX == 5.0


def test_histogram_last_bin_inclusive(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "V double")
    h = {r.BIN: r.COUNT for r in Q.histogram(df, "V", 10).collect()}
    assert sum(h.values()) == 11 and h[10] == 2 and h[1] == 1


def test_eligibility_gap_and_nulls(spark):
    rows = [("A", y, 1.0) for y in range(2000, 2005)] + [("B", 2000, 1.0), ("B", 2002, 1.0), ("B", 2003, 1.0), ("B", 2004, 1.0)]
    rows += [("C", y, None if y == 2002 else 1.0) for y in range(2000, 2005)] + [("D", y, 1.0) for y in range(2000, 2004)]
    df = spark.createDataFrame(rows, "CODE string, YEAR int, V double")
    ok = sorted(r.CODE for r in Q.entity_eligibility(df, min_periods=4).collect())
    assert ok == ["A"]  # B has a gap, C a null, D ends early


def test_box_plot(spark):
    df = spark.createDataFrame([(float(v),) for v in list(range(1, 10)) + [100]], "V double")
    r = Q.boxplot_summary(df, ["V"]).first()
    assert r.OUTLIERS == 1 and r.WHISKER_HIGH == 9.0 and r.WHISKER_LOW == 1.0


def test_correlation(spark):
    df = spark.createDataFrame([(float(i), -2.0 * i) for i in range(10)], "A double, B double")
    r = Q.correlation_matrix(df, ["A", "B"]).first()
    assert math.isclose(r.CORR, 1.0)


def test_eligible_rows_matches_entity_list(spark):
    rows = [("A", y, 1.0) for y in range(2000, 2005)] + [("B", 2000, 1.0), ("B", 2002, 1.0), ("B", 2003, 1.0), ("B", 2004, 1.0)]
    rows += [("C", y, None if y == 2002 else 1.0) for y in range(2000, 2005)]
    df = spark.createDataFrame(rows, "CODE string, YEAR int, V double")
    a = sorted((r.CODE, r.YEAR) for r in Q.eligible_rows(df, min_periods=4).collect())
    b = sorted((r.CODE, r.YEAR) for r in Q.keep_entities(df, Q.entity_eligibility(df, min_periods=4)).collect())
    assert a == b == [("A", y) for y in range(2000, 2005)]


def test_drop_entities_with_value(spark):
    df = spark.createDataFrame([("A", 1.0), ("A", 0.0), ("B", 2.0), ("C", None)], "CODE string, CAP double")
    assert sorted(r.CODE for r in Q.drop_entities_with_value(df, "CAP", 0).collect()) == ["B", "C"]


def test_fence_rules_property(spark):
    import numpy as np
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    @settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
    @given(st.lists(st.one_of(st.none(), st.integers(-30, 30)), min_size=4, max_size=40))
    def check(values):
        vals = [None if v is None else float(v) for v in values]
        df = _df(spark, vals)
        known = np.array([v for v in vals if v is not None])
        if len(known) == 0:
            return
        q1, q3 = (round(float(x), 6) for x in np.quantile(known, [0.25, 0.75]))
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        glob = sorted(r.V for r in O.fence_filter_global(df, ["V"]).collect())
        assert glob == sorted(v for v in vals if v is not None and lo < v < hi)
        by_year = [r.V for r in O.fence_filter_by(df, ["V"]).collect()]
        assert sorted(v for v in by_year if v is not None) == sorted(v for v in vals if v is not None and lo <= v <= hi)
        assert by_year.count(None) == vals.count(None)

    check()
