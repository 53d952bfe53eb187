"""Queries: walk-forward models, metrics and score tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelforge.operators import evaluate as EV
from panelforge.operators import labels as L
from panelforge.operators import models as M
from panelforge.operators import outliers as OUT
from panelforge.operators import quality as Q
from panelforge.operators import ranks as R
from panelforge.operators import selection as S
from panelforge.operators.labels import encode_label
from panelforge.plans import oracle as O
from panelforge.plans import pipelines as P
from panelforge.plans.catalog import Tables, register, rounded
from panelforge.operators.sets import union_by_name
from panelforge.session import write_once

# The window of the walk-forward; the target years are those of the panel that have a full window.
N_BACK = 3
#: Ranges of training years of the source jobs: open for the rankings, closed for the classifiers.
RANK_YEARS = (1990, 2016)
CLASS_YEARS = (1990, 2018)
ROC, EV_ = "CSR__ROC_JOEL_GREENBLATT", "VR__EV_TO_EBIT"


def _labelled(spark, base):
    t = Tables(spark, base).once("price")
    return P.labelled_panel(t.financials, t.price, t.index_values)


def greenblatt_training(panel):
    """Training universe: 1990 < YEAR < 2016, complete rows, dense ranks per year
    (ROC and next return descending, EV/EBIT ascending)."""
    g = panel.select("YEAR", "CODE", ROC, EV_, "RETURNS_NEXT").where(Q.between_open("YEAR", *RANK_YEARS)).na.drop()
    return R.dense_ranks(g, {"X1": (ROC, False), "X2": (EV_, True), "Y": ("RETURNS_NEXT", False)})


def greenblatt_scoring(panel):
    """Rows to score: feature ranks over the whole panel of each year (nulls stay null)."""
    return R.dense_ranks(panel, {"X1": (ROC, False), "X2": (EV_, True)}).where(F.col("X1").isNotNull() & F.col("X2").isNotNull())


O.cte(
    "gb_train",
    f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY {ROC} DESC) AS INTEGER) AS X1,
          CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY {EV_} ASC) AS INTEGER) AS X2,
          CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY RETURNS_NEXT DESC) AS INTEGER) AS Y
FROM (SELECT YEAR, CODE, {ROC}, {EV_}, RETURNS_NEXT FROM panel
      WHERE YEAR > 1990 AND YEAR < 2016 AND {ROC} IS NOT NULL AND {EV_} IS NOT NULL AND RETURNS_NEXT IS NOT NULL) g
""",
    ("panel",),
)
O.cte(
    "gb_coef",
    f"""
SELECT TARGET_YEAR, N, my - B1 * m1 - B2 * m2 AS B0, B1, B2 FROM (
  SELECT TARGET_YEAR, N, m1, m2, my,
         (v2 * c1y - c12 * c2y) / NULLIF(v1 * v2 - c12 * c12, 0) AS B1,
         (v1 * c2y - c12 * c1y) / NULLIF(v1 * v2 - c12 * c12, 0) AS B2
  FROM (SELECT TARGET_YEAR, count(*) AS N, avg(X1) AS m1, avg(X2) AS m2, avg(Y) AS my, var_samp(X1) AS v1,
               var_samp(X2) AS v2, covar_samp(X1, X2) AS c12, covar_samp(X1, Y) AS c1y, covar_samp(X2, Y) AS c2y
        FROM (SELECT *, unnest(generate_series(YEAR + 1, YEAR + {N_BACK})) AS TARGET_YEAR FROM gb_train) t
        WHERE TARGET_YEAR BETWEEN (SELECT min(YEAR) + {N_BACK} FROM panel) AND (SELECT max(YEAR) FROM panel)
        GROUP BY TARGET_YEAR) m) c
""",
    ("gb_train", "panel"),
)
O.cte(
    "gb_scored",
    f"""
SELECT s.*, round(c.B0 + c.B1 * s.X1 + c.B2 * s.X2, 6) AS PREDICTION FROM (
  SELECT *, CASE WHEN {ROC} IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY {ROC} DESC NULLS LAST) AS INTEGER) END AS X1,
            CASE WHEN {EV_} IS NOT NULL THEN CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY {EV_} ASC NULLS LAST) AS INTEGER) END AS X2
  FROM panel) s JOIN gb_coef c ON s.YEAR = c.TARGET_YEAR
WHERE s.X1 IS NOT NULL AND s.X2 IS NOT NULL
""",
    ("panel", "gb_coef"),
)

_SCORE_SQL = """
SELECT YEAR, CODE, VQ_MARKET_CAP AS CAP, IS_EPS_BASIC AS EPS, IS__REVENUE AS REVENUE, VR_PE_RATIO AS PER,
       VQ__PIOTROSKI_F_SCORE AS PIOTROSKI, PRICE_START, PRICE_END, RETURNS, round(RISK, 6) AS RISK, PREDICTION,
       CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY PREDICTION ASC NULLS LAST) AS INTEGER) AS RANKING
FROM gb_scored
"""


def _walk_forward_lr(spark, base, solver, year=None):
    """Scores of every target year, or of ``year`` alone: then only its window is ranked and only its rows are scored."""
    # the panel feeds training ranks, scoring ranks and the score table: build it once
    panel = write_once(_labelled(spark, base), "panel")
    years, training = M.target_years(panel, N_BACK), panel
    if year is not None:
        years = [y for y in years if y == year]
        training, panel = panel.where(F.col("YEAR").between(year - N_BACK, year - 1)), panel.where(F.col("YEAR") == year)
    windows = M.window_moments(greenblatt_training(training), ["X1", "X2"], "Y", years, N_BACK)
    coef = M.solve_two(windows) if solver == "closed" else M.solve_linear(windows, 2)
    scored = M.apply_linear(greenblatt_scoring(panel), coef, ["X1", "X2"])
    scored = rounded(scored, ["PREDICTION"])
    return rounded(EV.score_table(panel, scored, "PREDICTION", ascending=True), ["RISK"])


@register("walk_forward_lr", _SCORE_SQL, ["gb_scored"])
def walk_forward_lr(spark, base):
    """Two-factor linear model, window of 3 years, closed form for all target years at once."""
    return _walk_forward_lr(spark, base, "closed")


@register("walk_forward_lr_normal_equations", _SCORE_SQL, ["gb_scored"])
def walk_forward_lr_normal_equations(spark, base):
    """The same model solved from normal-equation moments (any number of features)."""
    return _walk_forward_lr(spark, base, "normal")


@register(
    "regression_metrics",
    """
SELECT count(*) AS N, round(avg((Y - PREDICTION) ^ 2), 6) AS MSE, round(sqrt(avg((Y - PREDICTION) ^ 2)), 6) AS RMSE,
       round(1 - sum((Y - PREDICTION) ^ 2) / NULLIF(var_pop(Y) * count(*), 0), 6) AS R2
FROM (SELECT s.PREDICTION, t.Y FROM gb_scored s JOIN gb_train t USING (YEAR, CODE)) j
""",
    ["gb_scored", "gb_train"],
)
def regression_metrics(spark, base):
    panel = write_once(_labelled(spark, base), "panel")
    tr = write_once(greenblatt_training(panel), "training")
    windows = M.window_moments(tr, ["X1", "X2"], "Y", M.target_years(panel, N_BACK), N_BACK)
    scored = rounded(M.apply_linear(greenblatt_scoring(panel), M.solve_two(windows), ["X1", "X2"]), ["PREDICTION"])
    j = scored.select("YEAR", "CODE", "PREDICTION").join(tr.select("YEAR", "CODE", "Y"), ["YEAR", "CODE"])
    return rounded(EV.regression_metrics(j, "Y", "PREDICTION"), ["MSE", "RMSE", "R2"])


def _tree_walk_forward(spark, base, kind):
    panel = write_once(_labelled(spark, base), "panel")
    est = M.regression_estimator(kind, **({"maxDepth": 5} if kind == "forest" else {"maxIter": 50}))
    s = M.walk_forward_fit_predict(greenblatt_training(panel), ["X1", "X2"], "Y", M.target_years(panel, N_BACK), N_BACK, est,
                                   greenblatt_scoring(panel))
    return rounded(EV.score_table(panel, s, "PREDICTION"), ["RISK"])


@register("walk_forward_rf")
def walk_forward_rf(spark, base):
    """Random forest (200 trees, sqrt features) per target year; MLlib, rows-only check."""
    return _tree_walk_forward(spark, base, "forest")


@register("walk_forward_gbt")
def walk_forward_gbt(spark, base):
    """Gradient-boosted trees (depth 5, step 0.15, 70 % features) per target year; rows-only check."""
    return _tree_walk_forward(spark, base, "gbt")


@register(
    "walk_forward_windows",
    f"""
SELECT t.TARGET_YEAR, count(*) AS ROWS_TRAINED, min(t.YEAR) AS FIRST_YEAR, max(t.YEAR) AS LAST_YEAR, any_value(s.n) AS ROWS_SCORED
FROM (SELECT *, unnest(generate_series(YEAR + 1, YEAR + {N_BACK})) AS TARGET_YEAR FROM gb_train) t
JOIN (SELECT YEAR AS TARGET_YEAR, count(*) AS n FROM gb_scored GROUP BY 1) s USING (TARGET_YEAR)
GROUP BY t.TARGET_YEAR
""",
    ["gb_train", "gb_scored"],
)
def walk_forward_windows(spark, base):
    """Per target year: the rows and years it is trained on and the rows it scores."""
    panel = write_once(_labelled(spark, base), "panel")
    train = M.training_windows(greenblatt_training(panel), M.target_years(panel, N_BACK), N_BACK)
    scored = greenblatt_scoring(panel).groupBy(F.col("YEAR").alias("TARGET_YEAR")).agg(F.count("*").alias("ROWS_SCORED"))
    windows = train.groupBy("TARGET_YEAR").agg(F.count("*").alias("ROWS_TRAINED"), F.min("YEAR").alias("FIRST_YEAR"), F.max("YEAR").alias("LAST_YEAR"))
    return windows.join(scored, "TARGET_YEAR")


@register(
    "regression_metrics_next_return",
    """
SELECT YEAR, count(CASE WHEN RETURNS_NEXT IS NOT NULL AND RETURNS IS NOT NULL THEN 1 END) AS N,
       round(avg((RETURNS_NEXT - RETURNS) ^ 2), 6) AS MSE, round(sqrt(avg((RETURNS_NEXT - RETURNS) ^ 2)), 6) AS RMSE,
       round(1 - sum((RETURNS_NEXT - RETURNS) ^ 2) / NULLIF(sum(CASE WHEN RETURNS IS NOT NULL THEN RETURNS_NEXT ^ 2 END)
             - count(CASE WHEN RETURNS IS NOT NULL THEN RETURNS_NEXT END) * avg(CASE WHEN RETURNS IS NOT NULL THEN RETURNS_NEXT END) ^ 2, 0), 6) AS R2
FROM panel GROUP BY YEAR
""",
    ["panel"],
)
def regression_metrics_next_return(spark, base):
    """This year's return as the forecast of the next one: the label is null in each company's last year."""
    return rounded(EV.regression_metrics(_labelled(spark, base), "RETURNS_NEXT", "RETURNS", ["YEAR"]), ["MSE", "RMSE", "R2"])


# Features of the classifiers: all ratios, the price columns and the encoded labels known in the year itself.
CODED = {"RETURNS_CAT_CODE": ("RETURNS_CAT", L.POSITIVE), "RETURNS_vs_INDEX_CODE": ("RETURNS_vs_INDEX", L.WINS)}
CLASS_FEATURES = [*P.RATIO_COLUMNS, "PRICE_START", "PRICE_END", "RISK", "RETURNS", *CODED]


def _class_panel(spark, base, compound=False):
    """Winsorized panel with LABEL (null where the next year is unknown) and the encoded features; not imputed."""
    p = _labelled(spark, base)
    if compound:
        p = L.compound_wins(p)  # WINS only if the next return is positive and beats the index
    p = encode_label(OUT.winsorize_by(p, P.RATIO_COLUMNS), "RETURNS_vs_INDEX_NEXT", "LABEL")
    p = p.withColumn("LABEL", F.when(F.col("RETURNS_NEXT").isNotNull(), F.col("LABEL").cast("double")))
    return write_once(p.withColumns({n: (F.col(c) == v).cast("double") for n, (c, v) in CODED.items()}), "class-panel")


@register("gbt_classifier_scores")
def gbt_classifier_scores(spark, base):
    """Beats-the-index classifier, walk-forward; probability and its rank per year (rows-only)."""
    return _gbt_classifier(spark, base, compound=False)


@register("gbt_classifier_scores_compound")
def gbt_classifier_scores_compound(spark, base):
    """The same with the stricter label (positive and above the index); rows-only."""
    return _gbt_classifier(spark, base, compound=True)


def _tuned(est, features, label, folds, loss, most):
    """The estimator with the number of rounds that k-fold cross validation on the window's rows chooses, stopping 10 rounds after the best."""
    return lambda train: est.copy().setMaxIter(S.boosting_curve(train, features, label, est, folds, loss, 10, most)[0])


def _gbt_classifier(spark, base, compound):
    p = _class_panel(spark, base, compound)
    train = M.hash_folds(p.where(Q.between_closed("YEAR", *CLASS_YEARS)), ["YEAR", "CODE"], 5)
    est = M.classifier_estimator("gbt", len(CLASS_FEATURES), keys=["YEAR", "CODE"])
    s = M.walk_forward_fit_predict(train, CLASS_FEATURES, "LABEL", M.target_years(p, N_BACK), N_BACK, est, p, probability=True, fill=True,
                                   tune=_tuned(est, CLASS_FEATURES, "LABEL", 5, "wrong_sign", 300), carry=["FOLD", "CODE"])
    out = EV.score_table(p, s, "PROBABILITY", ascending=False, rank_name="PROBABILITY_ORDER")
    return out.join(s.select("YEAR", "CODE", F.col("PREDICTION").alias("PREDICTED")), ["YEAR", "CODE"])


def _holdout(spark, base, kind, weighted=False, scaled=False, **params):
    """Scores of the held-out quarter of the labelled rows by a classifier fitted on the others."""
    p = _class_panel(spark, base).where(F.col("LABEL").isNotNull() & Q.between_closed("YEAR", *CLASS_YEARS))
    train, test = M.hash_split(p, ["YEAR", "CODE"], 0.75)
    medians = M.fit_medians(train, CLASS_FEATURES)
    train, test = M.impute(train, medians), M.impute(test, medians)
    if scaled:
        moments = M.fit_scale(train, CLASS_FEATURES)
        train, test = M.scale(train, moments), M.scale(test, moments)
    if weighted:
        train = M.class_weights(train, "LABEL")
        params["weightCol"] = "WEIGHT"
    est = M.classifier_estimator(kind, len(CLASS_FEATURES), **params).setFeaturesCol("features").setLabelCol("LABEL")
    s = est.fit(M.assemble(train, CLASS_FEATURES)).transform(M.assemble(test, CLASS_FEATURES)).withColumnRenamed("prediction", "PREDICTED")
    if "probability" in s.columns:
        from pyspark.ml.functions import vector_to_array

        s = s.withColumn("PROBABILITY", vector_to_array("probability").getItem(1))
    return s.select("YEAR", "CODE", "LABEL", "PREDICTED", *[c for c in ("PROBABILITY",) if c in s.columns])


@register("mlp_scores")
def mlp_scores(spark, base):
    """Dense network with sigmoid hidden layers of 12 and 8 and a softmax output on standardised features, hold-out scores; rows-only."""
    return _holdout(spark, base, "mlp", scaled=True)


@register("random_forest_classifier")
def random_forest_classifier(spark, base):
    """Random forest classifier (200 trees, sqrt features, depth 5), hold-out scores; rows-only."""
    return _holdout(spark, base, "forest")


@register(
    "class_weights",
    """
SELECT p.YEAR, p.CODE, p.RETURNS_vs_INDEX_NEXT,
       (SELECT count(*) FROM panel) / ((SELECT count(DISTINCT RETURNS_vs_INDEX_NEXT) FROM panel) * c.nc) AS WEIGHT
FROM panel p JOIN (SELECT RETURNS_vs_INDEX_NEXT, count(*) AS nc FROM panel GROUP BY 1) c USING (RETURNS_vs_INDEX_NEXT)
""",
    ["panel"],
)
def class_weights(spark, base):
    p = _labelled(spark, base).select("YEAR", "CODE", "RETURNS_vs_INDEX_NEXT")
    return M.class_weights(p, "RETURNS_vs_INDEX_NEXT")


@register(
    "chronological_split",
    """
SELECT CODE, YEAR, RETURNS, row_number() OVER (PARTITION BY CODE ORDER BY YEAR) <= floor(count(*) OVER (PARTITION BY CODE) * 0.8) AS TRAIN
FROM panel
""",
    ["panel"],
)
def chronological_split(spark, base):
    return M.chronological_split(_labelled(spark, base).select("CODE", "YEAR", "RETURNS"), "CODE", "YEAR", 0.8)


@register(
    "hash_split",
    """
SELECT YEAR, CODE, RETURNS,
       CASE WHEN CAST('0x' || substr(md5('10|' || CAST(YEAR AS VARCHAR) || '|' || CODE), 1, 8) AS BIGINT) % 10000 < 7500 THEN 'train' ELSE 'test' END AS SPLIT
FROM panel
""",
    ["panel"],
)
def hash_split(spark, base):
    """Repeatable 75/25 split on the MD5 of (YEAR, CODE), the parts united by name."""
    tr, te = M.hash_split(write_once(_labelled(spark, base).select("YEAR", "CODE", "RETURNS"), "split"), ["YEAR", "CODE"], 0.75)
    return union_by_name([tr.withColumn("SPLIT", F.lit("train")), te.withColumn("SPLIT", F.lit("test"))])


@register(
    "year_holdout",
    "SELECT YEAR, CODE, RETURNS, CASE WHEN YEAR < 2000 THEN 'train' ELSE 'test' END AS SPLIT FROM panel WHERE YEAR <= 2000",
    ["panel"],
)
def year_holdout(spark, base):
    """Earlier years against the held-out year 2000."""
    tr, te = M.year_holdout(write_once(_labelled(spark, base).select("YEAR", "CODE", "RETURNS"), "split"), 2000)
    return union_by_name([tr.withColumn("SPLIT", F.lit("train")), te.withColumn("SPLIT", F.lit("test"))])


@register("closed_year_range", "SELECT YEAR, CODE, RETURNS_NEXT FROM panel WHERE YEAR BETWEEN 1996 AND 1999 AND RETURNS_NEXT IS NOT NULL", ["panel"])
def closed_year_range(spark, base):
    """Closed range of years, rows with a known label only."""
    return _labelled(spark, base).where(Q.between_closed("YEAR", 1996, 1999) & F.col("RETURNS_NEXT").isNotNull()).select("YEAR", "CODE", "RETURNS_NEXT")


O.cte(
    "doc_scores",
    """
SELECT l.doc_id, l.quality AS LABEL, d.n_chars / (SELECT max(n_chars) FROM documents) AS SCORE
FROM labels l JOIN documents d USING (doc_id)
""",
)


def _doc_scores(spark, base):
    t = Tables(spark, base)
    docs = t.raw("documents")
    mx = docs.select(F.max("n_chars")).scalar()
    return t.raw("labels").join(docs.select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("LABEL"), (F.col("n_chars") / mx).alias("SCORE")
    )


@register(
    "confusion_metrics",
    """
SELECT TN, FP, FN, TP, (TP + TN) / NULLIF(TP + TN + FP + FN, 0) AS ACC, TP / NULLIF(TP + FN, 0) AS SEN,
       TN / NULLIF(TN + FP, 0) AS ESP, TP / NULLIF(TP + FP, 0) AS PPV,
       2 * (TP / NULLIF(TP + FP, 0)) * (TP / NULLIF(TP + FN, 0)) / NULLIF(TP / NULLIF(TP + FP, 0) + TP / NULLIF(TP + FN, 0), 0) AS FSC
FROM (SELECT count(CASE WHEN LABEL = 0 AND P = 0 THEN 1 END) AS TN, count(CASE WHEN LABEL = 0 AND P = 1 THEN 1 END) AS FP,
             count(CASE WHEN LABEL = 1 AND P = 0 THEN 1 END) AS FN, count(CASE WHEN LABEL = 1 AND P = 1 THEN 1 END) AS TP
      FROM (SELECT LABEL, CAST(round_even(SCORE, 0) AS INTEGER) AS P FROM doc_scores) s) c
""",
    ["doc_scores"],
)
def confusion_metrics(spark, base):
    s = EV.classify(_doc_scores(spark, base), "SCORE", "P")
    return EV.confusion_metrics(s, "LABEL", "P")


@register(
    "confusion_metrics_threshold",
    """
SELECT TN, FP, FN, TP, (TP + TN) / NULLIF(TP + TN + FP + FN, 0) AS ACC, TP / NULLIF(TP + FN, 0) AS SEN,
       TN / NULLIF(TN + FP, 0) AS ESP, TP / NULLIF(TP + FP, 0) AS PPV,
       2 * (TP / NULLIF(TP + FP, 0)) * (TP / NULLIF(TP + FN, 0)) / NULLIF(TP / NULLIF(TP + FP, 0) + TP / NULLIF(TP + FN, 0), 0) AS FSC
FROM (SELECT count(CASE WHEN LABEL = 0 AND P = 0 THEN 1 END) AS TN, count(CASE WHEN LABEL = 0 AND P = 1 THEN 1 END) AS FP,
             count(CASE WHEN LABEL = 1 AND P = 0 THEN 1 END) AS FN, count(CASE WHEN LABEL = 1 AND P = 1 THEN 1 END) AS TP
      FROM (SELECT LABEL, CASE WHEN SCORE > 0.1 THEN 1 ELSE 0 END AS P FROM doc_scores) s) c
""",
    ["doc_scores"],
)
def confusion_metrics_threshold(spark, base):
    s = _doc_scores(spark, base).withColumn("P", (F.col("SCORE") > 0.1).cast("int"))
    return EV.confusion_metrics(s, "LABEL", "P")


@register(
    "accuracy",
    "SELECT avg(CASE WHEN LABEL = CAST(round_even(SCORE, 0) AS INTEGER) THEN 1.0 ELSE 0.0 END) AS ACCURACY, count(*) AS N FROM doc_scores",
    ["doc_scores"],
)
def accuracy(spark, base):
    return EV.accuracy(EV.classify(_doc_scores(spark, base), "SCORE", "P"), "LABEL", "P")


O.cte(
    "doc_roc",
    """
SELECT THRESHOLD, TP, FP, FP / NULLIF((SELECT count(*) FROM doc_scores WHERE LABEL = 0), 0) AS FPR,
       TP / NULLIF((SELECT count(*) FROM doc_scores WHERE LABEL = 1), 0) AS TPR, pos, neg
FROM (SELECT THRESHOLD, pos, neg, CAST(sum(pos) OVER w AS BIGINT) AS TP, CAST(sum(neg) OVER w AS BIGINT) AS FP FROM (
        SELECT SCORE AS THRESHOLD, count(CASE WHEN LABEL = 1 THEN 1 END) AS pos, count(CASE WHEN LABEL = 0 THEN 1 END) AS neg
        FROM doc_scores WHERE SCORE IS NOT NULL AND LABEL IS NOT NULL GROUP BY SCORE) g
      WINDOW w AS (ORDER BY THRESHOLD DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) r
""",
    ("doc_scores",),
)


@register("roc_curve", "SELECT THRESHOLD, TP, FP, FPR, TPR FROM doc_roc", ["doc_roc"])
def roc_curve(spark, base):
    return EV.roc_curve(_doc_scores(spark, base), "LABEL", "SCORE")


@register(
    "roc_auc",
    """
SELECT round(sum(neg * (TP - pos + 0.5 * pos)) / NULLIF(sum(pos) * sum(neg), 0), 9) AS AUC,
       CAST(sum(pos) AS BIGINT) AS POSITIVES, CAST(sum(neg) AS BIGINT) AS NEGATIVES
FROM doc_roc
""",
    ["doc_roc"],
)
def roc_auc(spark, base):
    return rounded(EV.roc_auc(_doc_scores(spark, base), "LABEL", "SCORE"), ["AUC"], 9)


@register(
    "high_probability_picks",
    """
SELECT doc_id, LABEL, 1 - SCORE AS PROB_0, SCORE AS PROB_1, SCORE > 0.8 AS HIGH_PRECISION
FROM doc_scores WHERE SCORE > 0.8
""",
    ["doc_scores"],
)
def high_probability_picks(spark, base):
    return EV.high_probability_picks(_doc_scores(spark, base), "SCORE", 0.8, keep=["doc_id", "LABEL"])


@register("walk_forward_gbt_fenced")
def walk_forward_gbt_fenced(spark, base):
    """Outlier-aware walk-forward: label rank on the cleaned universe, per-year fences on
    ROC then EV/EBIT, dense ranks on the survivors, boosted trees per target year with
    early stopping on a hash third of the window (rounds chosen by validation loss),
    scored on ranks over the whole panel; rows-only check."""
    panel = write_once(_labelled(spark, base), "panel")
    g = panel.select("YEAR", "CODE", ROC, EV_, "RETURNS_NEXT").where(Q.between_open("YEAR", *RANK_YEARS)).na.drop()
    g = R.dense_rank_by(g, "RETURNS_NEXT", ascending=False, out="Y")
    g = R.dense_ranks(OUT.fence_filter_by(g, [ROC, EV_]), {"X1": (ROC, False), "X2": (EV_, True)})
    est = _boosted()
    s = M.walk_forward_fit_predict(M.hash_folds(g, ["YEAR", "CODE"], 3), ["X1", "X2"], "Y", M.target_years(panel, N_BACK), N_BACK,
                                   est, greenblatt_scoring(panel), standardise="own", tune=_tuned(est, ["X1", "X2"], "Y", 3, "squared", 500), carry=["FOLD"])
    return rounded(EV.score_table(panel, s, "PREDICTION"), ["RISK"])


def _boosted():
    """Boosted trees of depth 5 and step 0.15 on 70 % of the features; the number of rounds is chosen per window."""
    return M.regression_estimator("gbt")


# All columns of the ranking job: the ratios and the return known in the year itself.
RANK_COLUMNS = [*P.RATIO_COLUMNS, "RETURNS"]
ALL_N_BACK = 5


def _all_ranks_training(panel):
    """Complete rows, fences of every column in turn by year, dense rank of every column and of the label."""
    g = panel.select("YEAR", "CODE", *RANK_COLUMNS, "RETURNS_NEXT").where(Q.between_open("YEAR", *RANK_YEARS)).na.drop()
    g = OUT.fence_filter_by(g, RANK_COLUMNS)
    return R.dense_ranks(g, {f"{c}_RANK": (c, False) for c in [*RANK_COLUMNS, "RETURNS_NEXT"]})


def _all_ranks_sql():
    """One common table expression per fenced column, as the rows left by one are the input of the next."""
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*RANK_COLUMNS, "RETURNS_NEXT"])
    steps = [f"a0 AS (SELECT YEAR, CODE, {', '.join(RANK_COLUMNS)}, RETURNS_NEXT FROM panel WHERE YEAR > {RANK_YEARS[0]} AND YEAR < {RANK_YEARS[1]} AND {complete})"]
    for i, c in enumerate(RANK_COLUMNS, 1):
        q1, q3 = (f"round(quantile_cont({c}, {p}) OVER (PARTITION BY YEAR), 6)" for p in (0.25, 0.75))
        steps.append(f"a{i} AS (SELECT * EXCLUDE (q1, q3) FROM (SELECT *, {q1} AS q1, {q3} AS q3 FROM a{i - 1}) "
                     f"WHERE {c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))")
    ranks = ", ".join(f"CAST(dense_rank() OVER (PARTITION BY YEAR ORDER BY {c} DESC) AS INTEGER) AS {c}_RANK" for c in [*RANK_COLUMNS, "RETURNS_NEXT"])
    return f"WITH {', '.join(steps)} SELECT YEAR, CODE, {ranks} FROM a{len(RANK_COLUMNS)}"


O.cte("all_ranks", _all_ranks_sql(), ("panel",))


@register("all_ranks_training", "SELECT * FROM all_ranks", ["all_ranks"])
def all_ranks_training(spark, base):
    """Training table of the all-columns ranking job: fenced and ranked."""
    g = _all_ranks_training(write_once(_labelled(spark, base), "panel"))
    return g.select("YEAR", "CODE", *[f"{c}_RANK" for c in [*RANK_COLUMNS, "RETURNS_NEXT"]])


@register("walk_forward_gbt_all_ranks")
def walk_forward_gbt_all_ranks(spark, base):
    """All-columns ranking walk-forward: window 5, ranks of all columns scaled within the window, boosted trees, score table; rows-only."""
    panel = write_once(_labelled(spark, base), "panel")
    features = [f"{c}_RANK" for c in RANK_COLUMNS]
    train, est = M.hash_folds(_all_ranks_training(panel), ["YEAR", "CODE"], 3), _boosted()
    rows = R.dense_ranks(panel, {f"{c}_RANK": (c, False) for c in RANK_COLUMNS})
    s = M.walk_forward_fit_predict(train, features, "RETURNS_NEXT_RANK", M.target_years(panel, ALL_N_BACK), ALL_N_BACK, est, rows, standardise="own",
                                   tune=_tuned(est, features, "RETURNS_NEXT_RANK", 3, "squared", 500), carry=["FOLD"])
    return rounded(EV.score_table(panel, s, "PREDICTION"), ["RISK"])
