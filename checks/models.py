"""Training, scoring, applications and the composite jobs."""

from __future__ import annotations

import functools

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_

from checks import scores
from checks.features import _CLEAN, _DER, _DERIVED, _DRIFT, _HPI, _ORIG, _S, _hist_sql, _psi_sql, macro_frames, split_abt
from checks.loans import INTERVALS, RATE, _labelled, abt, dataset, rounded
from checks.registry import query
from checks.scores import BAD, T, preds
from checks.views import SPLIT_YEARS, oracle, table
from vintagemill import session
from vintagemill.operators import drift, features, scoring, training
from vintagemill.plans import jobs
from vintagemill.schemas import ABT_COLUMNS, AUDIT_RULES, CATEGORY_COLUMNS, LABEL, MODEL_NUMERIC, MONOTONE_DIRECTIONS
from vintagemill.sources import documents, tables


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return dataset(spark, folder, "features", lambda s, f: features.build_features(abt(s, f), SPLIT_YEARS))


def split(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return feature_table(spark, folder).filter(F.col("split") == name)


def feature_path(spark: SparkSession, folder: str) -> str:
    path = session.fresh_path(spark, "features-by-split")
    tables.write_dataset(feature_table(spark, folder), path, ["split"])
    return path


def saved(df: DataFrame, name: str) -> str:
    path = session.fresh_path(df.sparkSession, name)
    tables.write_dataset(df, path)
    return path


# --- training (large fitted models have no SQL form: rows only)


def _metrics(model: training.CreditModel, test: DataFrame) -> DataFrame:
    from vintagemill.operators import ranking
    return ranking.evaluate(training.predictions(model, test))


@query("m1_logistic_baseline")
def _(spark, folder):
    return _metrics(training.fit_logistic(split(spark, folder, "train")), split(spark, folder, "test"))


def _logistic_sql(steps: int = 8) -> dict[str, str]:
    """Newton's method for intercept and two standardised features, one CTE per step.

    Rows are weighted so that both classes weigh the same; the two slopes carry an
    L2 penalty of one half of their square.
    """
    ctes = {
        "clean": _CLEAN,
        "stat": """SELECT AVG(fico) AS m1, stddev_samp(fico) AS s1, AVG(ltv) AS m2, stddev_samp(ltv) AS s2, COUNT(*) AS n,
          SUM(CASE WHEN default_within_24m THEN 1 ELSE 0 END) AS pos FROM clean WHERE split = 'train'""",
        "pts": """SELECT (fico - m1) / s1 AS x1, (ltv - m2) / s2 AS x2, CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END AS y,
          n / (2.0E0 * CASE WHEN default_within_24m THEN pos ELSE n - pos END) AS w FROM clean, stat WHERE split = 'train'""",
        "l0": "SELECT 0.0E0 AS b0, 0.0E0 AS b1, 0.0E0 AS b2",
    }
    for i in range(steps):
        ctes[f"h{i}"] = f"""SELECT b0, b1, b2, SUM(w * (y - p)) AS g0, SUM(w * (y - p) * x1) - b1 AS g1, SUM(w * (y - p) * x2) - b2 AS g2,
          SUM(v) AS a, SUM(v * x1) AS b, SUM(v * x2) AS c, SUM(v * x1 * x1) + 1 AS d, SUM(v * x1 * x2) AS e, SUM(v * x2 * x2) + 1 AS f
          FROM (SELECT *, w * p * (1 - p) AS v FROM (
            SELECT *, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM pts, l{i})) GROUP BY b0, b1, b2"""
        det = "(a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d))"
        ctes[f"l{i + 1}"] = f"""SELECT
          b0 + ((d * f - e * e) * g0 + (c * e - b * f) * g1 + (b * e - c * d) * g2) / {det} AS b0,
          b1 + ((c * e - b * f) * g0 + (a * f - c * c) * g1 + (b * c - a * e) * g2) / {det} AS b1,
          b2 + ((b * e - c * d) * g0 + (b * c - a * e) * g1 + (a * d - b * b) * g2) / {det} AS b2 FROM h{i}"""
    return ctes


@query("m1_logistic_coefficients", oracle("""
SELECT 'fico' AS feature, ROUND(b1 / s1, 6) AS coefficient, ROUND(m1, 6) AS mean FROM l8, stat
UNION ALL SELECT 'ltv', ROUND(b2 / s2, 6), ROUND(m2, 6) FROM l8, stat""", "abt", **_logistic_sql()))
def _(spark, folder):
    model = training.fit_logistic(split(spark, folder, "train"), ["fico", "ltv"])
    rows = [(f, c, m) for f, (c, m) in training.linear_terms(model).items()]
    return rounded(spark.createDataFrame(rows, "feature string, coefficient double, mean double"), "coefficient", "mean")


@query("m8_prediction_table", oracle("""
SELECT loan_id, vintage_q, CASE WHEN default_within_24m THEN 1 ELSE 0 END AS y_true,
       ROUND(1 / (1 + exp(-(b0 + b1 * (fico - m1) / s1 + b2 * (ltv - m2) / s2))), 4) AS y_pred
FROM clean, stat, l8 WHERE split = 'test'""", "abt", **_logistic_sql()))
def _(spark, folder):
    model = training.fit_logistic(split(spark, folder, "train"), ["fico", "ltv"])
    return rounded(training.predictions(model, split(spark, folder, "test")), "y_pred", digits=4)


@query("m2_boosted_trees_mixed")
def _(spark, folder):
    model = training.fit_mixed_trees(split(spark, folder, "train"), split(spark, folder, "valid"))
    return _metrics(model, split(spark, folder, "test"))


@query("m3_boosted_trees")
def _(spark, folder):
    model = training.fit_boosted_trees(split(spark, folder, "train"), split(spark, folder, "valid"))
    return _metrics(model, split(spark, folder, "test"))


@query("m3_one_split", oracle("""
SELECT loan_id, vintage_q, CASE WHEN default_within_24m THEN 1 ELSE 0 END AS y_true,
       ROUND(1 / (1 + exp(-2 * CASE WHEN CASE f WHEN 'fico' THEN fico ELSE ltv END <= threshold THEN ls / ln ELSE rs / rn END)), 6) AS y_pred
FROM clean, best WHERE split = 'test'""", "abt", **_logistic_sql(), **{
    "counts": """SELECT f, v, COUNT(*) AS n, SUM(CASE WHEN y THEN 1.0E0 ELSE -1.0E0 END) AS s FROM (
        SELECT 'fico' AS f, CAST(fico AS DOUBLE) AS v, default_within_24m AS y FROM clean WHERE split = 'train'
        UNION ALL SELECT 'ltv', CAST(ltv AS DOUBLE), default_within_24m FROM clean WHERE split = 'train') GROUP BY 1, 2""",
    "sides": """SELECT f, (v + LEAD(v) OVER w) / 2 AS threshold, SUM(n) OVER w AS ln, SUM(s) OVER w AS ls,
        SUM(n) OVER (PARTITION BY f) - SUM(n) OVER w AS rn, SUM(s) OVER (PARTITION BY f) - SUM(s) OVER w AS rs
        FROM counts WINDOW w AS (PARTITION BY f ORDER BY v)""",
    "best": "SELECT * FROM sides WHERE ln >= 100 AND rn >= 100 ORDER BY ls * ls / ln + rs * rs / rn DESC LIMIT 1"}))
def _(spark, folder):
    """The split with the largest fall in variance and the value of each side: one round of one split on all values."""
    train, test = split(spark, folder, "train"), split(spark, folder, "test")
    model = training.fit_boosted_trees(
        train, None, ["fico", "ltv"], maxIter=1, maxDepth=1, subsamplingRate=1.0, featureSubsetStrategy="all", maxBins=1024)
    return rounded(training.predictions(model, test), "y_pred")


@query("m4_random_search")
def _(spark, folder):
    return training.random_search(split(spark, folder, "train"), split(spark, folder, "valid"), numeric=MODEL_NUMERIC)[1]


@query("m5_sign_bounded_logistic")
def _(spark, folder):
    train = split(spark, folder, "train")
    model = training.fit_logistic(train, directions=MONOTONE_DIRECTIONS)
    rows = [(f, MONOTONE_DIRECTIONS.get(f, 0), c) for f, (c, _) in training.linear_terms(model).items()]
    return spark.createDataFrame(rows, "feature string, direction int, coefficient double")


def _optimality(train: DataFrame, directions: dict[str, int]) -> DataFrame:
    """Per feature: has the coefficient its sign, and is the penalised likelihood stationary there?

    The slope of the balanced log-likelihood less half the squared coefficients must be
    zero where a coefficient is free; where it rests on its bound of zero, the slope may
    only point beyond the bound.
    """
    model = training.fit_logistic(train, directions=directions)
    ready = model.prepare(train.withColumn("_y", F.col(LABEL).cast("double")), ["_y"])
    rows = model.pipeline.transform(ready).select(
        "_y", vector_to_array("features").alias("z"), F.element_at(vector_to_array("probability"), 2).alias("p"))
    n, pos = rows.agg(F.count("*"), F.sum("_y")).first()
    push = F.when(F.col("_y") == 1, n / (2 * pos)).otherwise(n / (2 * (n - pos))) * (F.col("_y") - F.col("p"))
    sums = rows.agg(*[F.sum(push * F.get("z", F.lit(j))) for j in range(len(model.numeric))]).first()
    found = []
    for feature, total, b in zip(model.numeric, sums, map(float, model.pipeline.stages[2].coefficients)):
        slope, d = (total - b) / n, directions.get(feature, 0)
        found.append((feature, d * b >= 0, abs(slope) <= 1e-3 or (d != 0 and b == 0 and d * slope <= 0)))
    return train.sparkSession.createDataFrame(found, "feature string, sign_kept boolean, stationary boolean")


_ALL_TRUE = f"SELECT UNNEST({MODEL_NUMERIC!r}) AS feature, true AS sign_kept, true AS stationary"


@query("m1_logistic_optimality", _ALL_TRUE)
def _(spark, folder):
    return _optimality(split(spark, folder, "train"), {})


@query("m5_sign_bounded_optimality", _ALL_TRUE)
def _(spark, folder):
    return _optimality(split(spark, folder, "train"), MONOTONE_DIRECTIONS)


@query("m6_feature_importance")
def _(spark, folder):
    model = training.fit_boosted_trees(split(spark, folder, "train"), split(spark, folder, "valid"))
    return training.feature_importance(model)


# --- scoring with a given ensemble (two small trees, so that SQL can follow them)

def ensemble() -> scoring.TreeEnsemble:
    node = scoring.Node
    first = {
        0: node(0, "fico", 600.0, 1, 2), 1: node(1, "dti", 43.0, -1, -2), 2: node(2, "ltv", 80.0, -3, -4),
        -1: node(-1, value=-1.5), -2: node(-2, value=-0.5), -3: node(-3, value=-3.0), -4: node(-4, value=-2.0)}
    second = {
        0: node(0, "orig_rate", 5.25, -1, 1, default_left=False, missing="default"), 1: node(1, "dti", 20.5, -2, -3),
        -1: node(-1, value=-0.25), -2: node(-2, value=0.1), -3: node(-3, value=0.4)}
    return scoring.TreeEnsemble(["fico", "ltv", "dti", "orig_rate"], [first, second], [0, 0])


def _trees(fico: str, dti: str, ltv: str, rate: str) -> str:
    raw = f"""(CASE WHEN {fico} <= 600 THEN CASE WHEN {dti} <= 43 THEN -1.5E0 ELSE -0.5E0 END
       ELSE CASE WHEN {ltv} <= 80 THEN -3.0E0 ELSE -2.0E0 END END
     + CASE WHEN {rate} <= 5.25 THEN -0.25E0 WHEN {dti} <= 20.5 THEN 0.1E0 ELSE 0.4E0 END)"""
    return f"1 / (1 + exp(-{raw}))"


def _ensemble_query(method: str):
    def run(spark, folder):
        model = ensemble()
        if method == "stored":
            nodes = tables.read_dataset(spark, saved(model.node_table(spark), "nodes"))
            model = scoring.ensemble_from_nodes(nodes, model.features)
        how = "vectorised" if method == "vectorised" else "expression"
        return rounded(abt(spark, folder).select("loan_id", model.probability(how).alias("pd")), "pd")
    return run


for _name, _method in (("m10_tree_ensemble", "expression"), ("m10_tree_ensemble_vectorised", "vectorised"),
                       ("m10_tree_ensemble_stored", "stored")):
    query(_name, oracle(f"SELECT loan_id, ROUND({_trees('fico', 'COALESCE(dti, 0)', 'ltv', 'orig_rate')}, 6) AS pd FROM abt", "abt"))(
        _ensemble_query(_method))

_MED = "(SELECT quantile_cont(dti, 0.5) FROM s WHERE split = 'train')"


# a stored model of 40 trees with 600 nodes, made by rule, so that SQL can follow it
_FILE_FEATURES = {"fico": (420.5, 23.0), "ltv": (40.5, 4.0), "dti": (6.5, 3.0), "orig_rate": (2.6, 0.25)}
_FILE_TREES = 40


def _split_of(tree: int, node: int) -> tuple[int, str, float]:
    at = (tree + node) % len(_FILE_FEATURES)
    name, (low, step) = list(_FILE_FEATURES.items())[at]
    return at, name, low + (tree * 13 + node * 7) % 18 * step


def _leaf_of(tree: int, leaf: int) -> float:
    return ((tree * 5 + leaf * 3) % 11 - 6) / 64


def _leaf_rows(tree: int, leaf: int) -> int:
    return 1 + (tree * 3 + leaf * 5) % 7


def _tree_text() -> str:
    """Seven inner nodes a tree, numbered from the root by level, and eight leaves."""
    blocks = []
    for t in range(_FILE_TREES):
        splits = [_split_of(t, n) for n in range(7)]
        child = [[2 * n + side if n < 3 else -(2 * (n - 3) + side) for n in range(7)] for side in (1, 2)]
        lines = {"num_leaves": [8], "num_cat": [0], "split_feature": [i for i, _, _ in splits], "threshold": [v for _, _, v in splits],
                 "decision_type": [2] * 7, "left_child": child[0], "right_child": child[1], "leaf_value": [_leaf_of(t, k) for k in range(8)], "leaf_count": [_leaf_rows(t, k) for k in range(8)]}
        blocks.append(f"Tree={t}\n" + "\n".join(f"{k}={' '.join(map(str, v))}" for k, v in lines.items()))
    head = "tree\nobjective=binary sigmoid:1\nfeature_names=" + " ".join(_FILE_FEATURES)
    return "\n\n".join([head, *blocks, "end of trees"])


def _tree_sql() -> str:
    def walk(t: int, n: int) -> str:
        if n > 6:
            return f"{_leaf_of(t, n - 7)!r}E0"
        _, name, value = _split_of(t, n)
        return f"CASE WHEN {name} <= {value!r}E0 THEN {walk(t, 2 * n + 1)} ELSE {walk(t, 2 * n + 2)} END"

    return " + ".join(walk(t, 0) for t in range(_FILE_TREES))


@query("c7_score_with_tree_file", oracle(f"""
SELECT loan_id, ROUND(1 / (1 + exp(-({_tree_sql()}))), 6) AS pd_raw
FROM (SELECT loan_id, fico, ltv, orig_rate, COALESCE(dti, {_MED}) AS dti FROM s WHERE split = 'recent')""", "abt", s=_S))
def _(spark, folder):
    model, table_, out = _tree_file(spark), session.fresh_path(spark, "splits"), session.fresh_path(spark, "scored")
    tables.write_dataset(split_abt(spark, folder), table_, ["split"])
    return rounded(jobs.score_with_tree_file(spark, model, table_, out).select("loan_id", "pd_raw"), "pd_raw")


def _push_sql(feature: str) -> str:
    """What a feature adds along the path: the change of the leaves' mean below each node that asks for it."""
    def below(t: int, n: int) -> list[int]:
        return [n - 7] if n > 6 else below(t, 2 * n + 1) + below(t, 2 * n + 2)

    def mean(t: int, n: int) -> float:
        rows = [_leaf_rows(t, k) for k in below(t, n)]
        return sum(r * _leaf_of(t, k) for r, k in zip(rows, below(t, n))) / sum(rows)

    def walk(t: int, n: int) -> str:
        if n > 6:
            return "0E0"
        _, name, value = _split_of(t, n)
        sides = [f"{mean(t, c) - mean(t, n) if name == feature else 0.0!r}::DOUBLE + {walk(t, c)}" for c in (2 * n + 1, 2 * n + 2)]
        return f"CASE WHEN {name} <= {value!r}E0 THEN {sides[0]} ELSE {sides[1]} END"

    return " + ".join(f"({walk(t, 0)})" for t in range(_FILE_TREES))


def _tree_file(spark: SparkSession) -> str:
    path = session.fresh_path(spark, "tree-file")
    spark.createDataFrame([(_tree_text(),)], "value string").coalesce(1).write.text(path)
    return path


# contributions that are equal but for rounding may swap ranks, so ranks are left to the tests
@query("m15_tree_reason_codes", oracle("""
SELECT loan_id, feature, value, ROUND(push, 6) AS contribution FROM (""" + " UNION ALL ".join(
    f"SELECT loan_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {_push_sql(f)} AS push FROM filled" for f in _FILE_FEATURES) + ")",
    "abt", filled="SELECT loan_id, fico, ltv, COALESCE(dti, 0) AS dti, orig_rate FROM abt"))
def _(spark, folder):
    """Every feature's contribution: the model has fewer than eight."""
    model = scoring.read_tree_file(spark, _tree_file(spark))
    filled = abt(spark, folder).fillna(0, ["dti"])
    return rounded(scoring.tree_reason_codes(filled, model).drop("rank"), "contribution")


@query("m9_score_cohort", oracle(f"""
SELECT loan_id, orig_date, msa, ROUND({_trees('fico', f'COALESCE(dti, {_MED})', 'ltv', 'orig_rate')}, 6) AS pd_raw
FROM s WHERE split = 'recent'""", "abt", s=_S))
def _(spark, folder):
    df = split_abt(spark, folder)
    model = ensemble()
    medians = features.median_values(df.filter("split = 'train'"), model.features)
    return rounded(scoring.score_cohort(df.filter("split = 'recent'"), model, medians), "pd_raw")


# means that no value meets, so that no contribution is a signed zero
_TERMS = {"fico": (-0.01, 570.5), "ltv": (0.03, 77.5), "dti": (0.02, 36.5), "orig_rate": (0.25, 5.1), "cltv": (0.015, 84.5),
          "orig_upb": (-0.0000013, 150000.25), "loan_term": (0.001, 270.5), "num_units": (0.05, 3.5), "msa": (0.00001, 12000.5)}


@query("m15_reason_codes", oracle("""
SELECT loan_id, CAST(row_number() OVER (PARTITION BY loan_id ORDER BY -abs(contribution), feature) AS INT) AS rank, feature, value,
       ROUND(contribution, 6) AS contribution FROM (""" + " UNION ALL ".join(
    f"SELECT loan_id, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, COALESCE({c:.7f}E0 * ({f} - {m}E0), 0) AS contribution FROM abt"
    for f, (c, m) in _TERMS.items()) + ") QUALIFY rank <= 8", "abt"))
def _(spark, folder):
    return rounded(scoring.reason_codes(abt(spark, folder), _TERMS), "contribution")


_APPS = """
SELECT o_orderkey AS application_id, CAST(580 + o_orderkey % 271 AS DOUBLE) AS fico, CAST(30 + o_orderkey % 68 AS DOUBLE) AS ltv,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(10 + o_orderkey % 51 AS DOUBLE) END AS dti,
  CASE o_orderkey % 3 WHEN 0 THEN 'Purchase' WHEN 1 THEN 'Cash-out refinance' ELSE 'No cash-out refinance' END AS purpose FROM orders"""
_APP_FEATURES = ["fico", "ltv", "dti", "orig_rate", "fico_gap", "int_fico_gap_x_ltv", "ltv_80", "loan_term", "purpose_P"]
_APP_MEDIANS = {"orig_rate": 4.5, "dti": 36.0, "ltv_80": 0.5, "loan_term": 360.0}


def _applications(spark, folder):
    return spark.sql(_APPS.replace("FROM orders", "FROM {orders}"), orders=table(spark, folder, "orders"))


def _app_sql(ltv_80: str) -> str:
    return f"""SELECT application_id, fico, ltv, COALESCE(dti, 36.0E0) AS dti, 4.5E0 AS orig_rate, 850 - fico AS fico_gap,
      (850 - fico) * ltv AS int_fico_gap_x_ltv, {ltv_80} AS ltv_80, 360.0E0 AS loan_term,
      CASE WHEN purpose = 'Purchase' THEN 1.0E0 ELSE 0.0E0 END AS "purpose_P" FROM apps"""


for _name, _compat, _sql in (("m16_application_rows", False, "GREATEST(ltv - 80, 0.0E0)"), ("m16_application_rows_compat", True, "0.5E0")):
    query(_name, oracle(_app_sql(_sql), apps=_APPS))(
        lambda spark, folder, compat=_compat: scoring.application_rows(
            _applications(spark, folder), _APP_FEATURES, _APP_MEDIANS, compat=compat))


@query("m16_application_decisions", oracle(f"""
SELECT application_id, ROUND(p, 6) AS pd_raw, ROUND(1 / (1 + exp(1.25E0 - 1.03E0 * ln(p / (1 - p)))), 6) AS pd,
       1 / (1 + exp(1.25E0 - 1.03E0 * ln(p / (1 - p)))) <= 0.05 AS approved
FROM (SELECT application_id, {_trees('fico', 'COALESCE(dti, 36)', 'ltv', '4.5E0')} AS p FROM apps)""", apps=_APPS))
def _(spark, folder):
    model = ensemble()
    rows = scoring.application_rows(_applications(spark, folder), model.features, _APP_MEDIANS)
    return rounded(scoring.decide(rows, model, 0.05, -1.25, 1.03), "pd_raw", "pd")


# --- composite jobs

_HEADER = {"rows": "COUNT(*)", "unique_keys": "COUNT(DISTINCT loan_id)", "duplicates": "COUNT(*) - COUNT(DISTINCT loan_id)",
           "label_nulls": "COUNT(CASE WHEN default_within_24m IS NULL THEN 1 END)"}


@query("c3_audit_job", oracle(" UNION ALL ".join([
    *[f"SELECT 'outlier_flags' AS output, '{c}' AS key, COUNT(CASE WHEN {c} < {lo} OR {c} > {hi} OR {c} IS NULL THEN 1 END) AS n FROM abt"
      for c, (lo, hi) in AUDIT_RULES.items()],
    *[f"SELECT 'missing', '{c}', COUNT(*) - COUNT({c}) FROM abt" for c in ABT_COLUMNS],
    *[f"SELECT 'audit_header', '{name}', {sql} FROM abt" for name, sql in _HEADER.items()],
    *[f"""SELECT 'top_values', '{c} ' || rank || ' ' || COALESCE(CAST(v AS VARCHAR), ''), n FROM (
        SELECT {c} AS v, COUNT(*) AS n, row_number() OVER (ORDER BY COUNT(*) DESC, {c} ASC NULLS LAST) AS rank FROM abt GROUP BY 1) WHERE rank <= 10"""
      for c in CATEGORY_COLUMNS]]), "abt"))
def _(spark, folder):
    """All four outputs of the job in one long table."""
    out = session.fresh_path(spark, "audit")
    jobs.audit_loans(spark, saved(abt(spark, folder), "abt"), out)
    read = {n: spark.read.option("header", True).csv(f"{out}/{n}") for n in ("outlier_flags", "missing", "top_values")}
    header = spark.read.json(f"{out}/audit_header").select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("key"), F.col(n).cast("bigint").alias("n")) for n in _HEADER])))
    value = F.concat_ws(" ", "col", "rank", F.coalesce("val", F.lit("")))
    parts = {
        "outlier_flags": read["outlier_flags"].select(F.col("feature").alias("key"), F.col("count_flagged").alias("n")),
        "missing": read["missing"].select(F.col("col").alias("key"), F.col("nulls").alias("n")),
        "top_values": read["top_values"].select(value.alias("key"), "n"), "audit_header": header}
    longs = [rows.select(F.lit(name).alias("output"), "key", F.col("n").cast("bigint").alias("n")) for name, rows in parts.items()]
    return longs[0].unionByName(longs[1]).unionByName(longs[2]).unionByName(longs[3])


@query("c4_macro_job", oracle(f"""
SELECT a.loan_id, {_ORIG} AS orig_month, u.unemp_rate, h.hpi_index, ROUND(h.chg, 6) AS hpi_12m_chg, r.pmms_30y,
       ROUND(a.orig_rate - r.pmms_30y, 6) AS rate_spread
FROM abt a LEFT JOIN macro_unemp u ON a.state = u.state AND {_ORIG} = strftime(u.month, '%Y-%m')
LEFT JOIN hpi h ON a.state = h.state AND {_ORIG} = h.m LEFT JOIN macro_rate r ON {_ORIG} = strftime(r.month, '%Y-%m')""",
    "abt", "macro_unemp", "macro_hpi", "macro_rate", hpi=_HPI))
def _(spark, folder):
    paths = [session.fresh_path(spark, "series") for _ in range(3)]
    for frame, path in zip(macro_frames(spark, folder), paths):
        # full dates, and the columns in another order than the schema's
        tables.write_report(frame.withColumn("date", F.concat("date", F.lit("-01"))).select(*reversed(frame.columns)), path)
    out = session.fresh_path(spark, "abt-plus")
    jobs.add_macro(spark, saved(abt(spark, folder), "abt"), out, *paths)
    names = ["loan_id", "orig_month", "unemp_rate", "hpi_index", "hpi_12m_chg", "pmms_30y", "rate_spread"]
    return rounded(tables.read_dataset(spark, out, names), "hpi_12m_chg", "rate_spread")


@query("c5_splits_job", oracle("""
SELECT split, COUNT(*) AS n, COUNT(CASE WHEN default_within_24m THEN 1 END) AS positives,
       ROUND(AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END), 6) AS positive_rate FROM s GROUP BY 1""", "abt", s=_S))
def _(spark, folder):
    out = session.fresh_path(spark, "splits")
    sizes = jobs.build_splits(spark, saved(abt(spark, folder), "abt"), out, f"{out}-medians", SPLIT_YEARS)
    return rounded(sizes, "positive_rate")


@query("c6_train_job")
def _(spark, folder):
    return jobs.train_trees(spark, feature_path(spark, folder), session.fresh_path(spark, "run"), MODEL_NUMERIC)


_POS, _NEG = "COUNT(CASE WHEN default_within_24m THEN 1 END)", "COUNT(CASE WHEN NOT default_within_24m THEN 1 END)"


@query("c6_baseline_job", oracle(f"""
SELECT m.model, split, CAST(pos + CASE WHEN split = 'valid' THEN LEAST(neg, GREATEST(1, 10 * pos)) ELSE neg END AS BIGINT) AS n, pos AS positives
FROM (SELECT split, {_POS} AS pos, {_NEG} AS neg FROM s WHERE split IN ('valid', 'test') GROUP BY 1),
     (SELECT UNNEST(['logistic', 'trees']) AS model) m""", "abt", s=_S))
def _(spark, folder):
    """Ten negatives per positive on train and valid."""
    out = session.fresh_path(spark, "baseline")
    metrics = jobs.train_baseline(spark, feature_path(spark, folder), out, MODEL_NUMERIC)
    return metrics.select("model", "split", F.col("n").cast("bigint").alias("n"), F.col("positives").cast("bigint").alias("positives"))


@query("c6_tuned_job", oracle(f"""
SELECT 'tuned' AS model, split, CAST({_POS} + {_NEG} AS BIGINT) AS n, {_POS} AS positives, 30 AS draws, 1 AS best, true AS best_is_largest
FROM s WHERE split IN ('valid', 'test') GROUP BY 2""", "abt", s=_S))
def _(spark, folder):
    """Rows and positives the tuned model was judged on, beside the number of draws and what was called best."""
    out = session.fresh_path(spark, "tuned")
    metrics = jobs.train_tuned(spark, feature_path(spark, folder), out, MODEL_NUMERIC)
    log = spark.read.option("header", True).schema("draw int, settings string, ks double, best boolean").csv(f"{out}/draws")
    drawn = log.agg(F.count_distinct("settings").cast("int").alias("draws"), F.count_if("best").cast("int").alias("best"),
                    (F.max(F.when(F.col("best"), F.col("ks"))) == F.max("ks")).alias("best_is_largest"))
    return metrics.select("model", "split", *[F.col(c).cast("bigint").alias(c) for c in ("n", "positives")]).crossJoin(drawn)


@query("c7_score_and_calibrate_job")
def _(spark, folder):
    run = session.fresh_path(spark, "run")
    path = feature_path(spark, folder)
    jobs.train_trees(spark, path, run, MODEL_NUMERIC)
    recent = f"{run}/recent_predictions"
    jobs.score_recent(spark, run, path, recent)
    return jobs.calibrate(spark, run, f"{run}/calibrated", recent)


@query("c8_policy_job", oracle("""
SELECT threshold, metric, value FROM (UNPIVOT (
    SELECT k.threshold, k.recall, k.precision, k.f1, k.ks FROM k, (SELECT threshold AS t FROM k ORDER BY f1 DESC, threshold LIMIT 1)
    WHERE k.threshold BETWEEN t - 0.11 AND t + 0.11)
  ON recall, precision, f1, ks INTO NAME metric VALUE value)""", "preds", **{
    **scores._CURVE_CTES,
    "grid": "SELECT threshold, 1 AS pos FROM (SELECT UNNEST([" + ", ".join(
        f"{t!r}E0" for t in scores.policy.parse_grid("0.05:0.95:0.05")) + "]) AS threshold)"}))
def _(spark, folder):
    out = session.fresh_path(spark, "policy")
    jobs.choose_policy(spark, saved(preds(spark, folder), "preds"), out, "y_pred", grid="0.05:0.95:0.05", span=0.22)
    return spark.read.option("header", True).schema("threshold double, metric string, value double").csv(f"{out}/curve_long")


_POINT = ["recall", "precision", "f1", "ks", "approve_rate"]
_GRID = "0.05:0.95:0.05"


@query("c8_policy_job_outputs", oracle("""
SELECT output, ROUND(threshold, 6) AS threshold, metric, value FROM (SELECT output, threshold, metric, value FROM (UNPIVOT (
    SELECT 'policy_curve' AS output, threshold, recall, precision, f1, ks, approve_rate FROM k
    UNION ALL SELECT 'curve_wide', k.threshold, recall, precision, k.f1, ks, approve_rate FROM k, top WHERE k.threshold BETWEEN t - 0.11 AND t + 0.11
    UNION ALL SELECT 'snapshot', k.threshold, recall, precision, k.f1, ks, approve_rate FROM k, top WHERE k.threshold = t)
  ON recall, precision, f1, ks, approve_rate INTO NAME metric VALUE value)
UNION ALL SELECT 'curve_approve', k.threshold, 'approve_rate', approve_rate FROM k, top WHERE k.threshold BETWEEN t - 0.11 AND t + 0.11
UNION ALL SELECT 'policy_choice', t, 'f1', NULL FROM top)""", "preds", **{
    **scores._CURVE_CTES,
    "grid": "SELECT threshold, 1 AS pos FROM (SELECT UNNEST([" + ", ".join(f"{t!r}E0" for t in scores.policy.parse_grid(_GRID)) + "]) AS threshold)",
    "top": "SELECT threshold AS t FROM k ORDER BY f1 DESC, threshold LIMIT 1"}))
def _(spark, folder):
    """Every output of the job but the one of c8_policy_job, in one long table."""
    out = session.fresh_path(spark, "policy")
    scored = saved(preds(spark, folder), "preds")
    record = jobs.choose_policy(spark, scored, out, "y_pred", grid=_GRID, span=0.22)
    parts = record.select(F.lit("policy_choice").alias("output"), "threshold", "metric", F.lit(None).cast("double").alias("value"))
    for name in ("policy_curve", "curve_wide", "snapshot", "curve_approve"):
        points = spark.read.option("header", True).csv(f"{out}/{name}")
        points = points.select(*[F.col(c).cast("double").alias(c) for c in ["threshold", *_POINT] if c in points.columns])
        long = points.unpivot("threshold", points.columns[1:], "metric", "value").filter("value IS NOT NULL")
        parts = parts.unionByName(long.select(F.lit(name).alias("output"), "threshold", "metric", "value"))
    return rounded(parts, "threshold", "value")


@query("s14_policy_revised_by_job", oracle("""
SELECT 1 AS version, t AS threshold, 'approval_target' AS metric, 'y_pred' AS prob, rate AS approve_rate_recent, bad AS expected_bad_rate_on_approved
FROM (SELECT ROUND(t, 6) AS t, ROUND(AVG(CASE WHEN y_pred <= t THEN 1.0E0 ELSE 0.0E0 END), 6) AS rate,
             ROUND(AVG(CASE WHEN y_pred <= t THEN y_pred END), 6) AS bad FROM preds, cut GROUP BY cut.t)
UNION ALL
SELECT 2, ROUND(t, 6), 'approval_target', 'y_pred', ROUND(AVG(CASE WHEN y_pred <= t THEN 1.0E0 ELSE 0.0E0 END), 6),
       ROUND(AVG(CASE WHEN y_pred <= t THEN y_pred END), 6) FROM preds, cut WHERE y_true = 0 GROUP BY cut.t""",
    "preds", cut="SELECT quantile_cont(y_pred, 0.22) AS t FROM preds"))
def _(spark, folder):
    """Both versions: a threshold for an approve rate, then its rates on other predictions."""
    history = session.fresh_path(spark, "history")
    whole = preds(spark, folder)
    jobs.revise_policy(spark, history, saved(whole, "preds"), 0.22, "y_pred")
    jobs.revise_policy(spark, history, saved(whole.filter("y_true = 0"), "preds"), score="y_pred")
    versions = [documents.read_policy(spark, history, v).withColumn("version", F.lit(v)) for v in documents.policy_versions(spark, history)]
    return rounded(versions[0].unionByName(versions[1]), "threshold", "approve_rate_recent", "expected_bad_rate_on_approved")


@query("c9_backtest_job", oracle(f"""
SELECT vintage_q, COUNT(*) AS n, ROUND(AVG(CASE WHEN y_pred <= t THEN 1.0E0 ELSE 0.0E0 END), 6) AS approve_rate,
       ROUND(AVG(CASE WHEN y_pred <= t THEN CAST(y_true AS DOUBLE) END), 6) AS approved_bad_rate, {BAD} AS overall_bad_rate
FROM preds, (SELECT quantile_cont(y_pred, 0.22) AS t FROM preds) GROUP BY 1""", "preds"))
def _(spark, folder):
    scored = saved(preds(spark, folder), "preds")
    out = session.fresh_path(spark, "backtest")
    jobs.set_policy_by_approval(spark, scored, f"{out}-policy", 0.22, "y_pred")
    table_ = jobs.run_backtest(spark, saved(abt(spark, folder), "abt"), scored, f"{out}-policy", out, "y_pred")
    return rounded(table_, "approve_rate", "approved_bad_rate", "overall_bad_rate")


@query("c10_slice_job", oracle(f"""
SELECT slice, value, CAST(SUM(pos + neg) AS BIGINT) AS n, ROUND(CAST(SUM(pos) AS DOUBLE) / SUM(pos + neg), 6) AS bad_rate,
       {scores.AUC}, {scores.AP} AS pr_auc, {scores.KS1} FROM c GROUP BY 1, 2""",
    "preds", long=scores._LONG, **scores.ranked("slice, value", "long")))
def _(spark, folder):
    out = session.fresh_path(spark, "slices")
    slim = preds(spark, folder).select("loan_id", "y_true", "y_pred")
    jobs.slice_reports(spark, saved(slim, "preds"), saved(abt(spark, folder), "abt"), out, T)
    return rounded(tables.read_dataset(spark, f"{out}/slice_metrics"), "bad_rate", "auc", "pr_auc", "ks")


def _sliced(spark: SparkSession, folder: str) -> str:
    out = session.fresh_path(spark, "slices")
    slim = preds(spark, folder).select("loan_id", "y_true", "y_pred")
    jobs.slice_reports(spark, saved(slim, "preds"), saved(abt(spark, folder), "abt"), out, T)
    return out


_RATES = ("approve_rate", "approved_bad_rate", "overall_bad_rate")


@query("c10_slice_job_policy", oracle(f"""
SELECT 'policy_metrics' AS output, p.* FROM ({scores._policy_sql(False, 'slice, value')} FROM long GROUP BY 1, 2) p
UNION ALL SELECT 'policy_state_top20', 'state', q.* FROM ({scores._policy_sql(False, 'state')} FROM preds WHERE state IN (
  SELECT state FROM preds WHERE state IS NOT NULL GROUP BY state ORDER BY COUNT(*) DESC, state LIMIT 20) GROUP BY 1) q""",
    "preds", long=" UNION ALL ".join(f"SELECT '{s}' AS slice, CAST({s} AS VARCHAR) AS value, y_true, y_pred FROM preds" for s in jobs.SLICES)))
def _(spark, folder):
    """Policy metrics of every slice value, and of the 20 largest states."""
    out = _sliced(spark, folder)
    every = tables.read_dataset(spark, f"{out}/policy_metrics").withColumn("output", F.lit("policy_metrics"))
    schema = "state string, n bigint, approve_rate double, approved bigint, approved_bad_rate double, overall_bad_rate double"
    top = tables.read_report(spark, f"{out}/policy_state_top20")
    top = top.select(F.lit("policy_state_top20").alias("output"), F.lit("state").alias("slice"), F.col("state").alias("value"),
                     *[F.col(c).cast(kind).alias(c) for c, kind in (f.split() for f in schema.split(", ")[1:])])
    return rounded(every.unionByName(top), *_RATES)


@query("c10_slice_job_share", oracle(f"""
SELECT channel, purpose, state, msa, vintage_q, {scores._SHARE} FROM preds GROUP BY 1, 2, 3, 4, 5""", "preds"))
def _(spark, folder):
    return rounded(tables.read_dataset(spark, f"{_sliced(spark, folder)}/approved_share"), "approve_rate")


@query("c10_slice_job_manifest", oracle(f"""
SELECT 'loan_id' AS id_col, '{",".join(jobs.SLICES)}' AS used_slices, COUNT(*) AS n_rows_joined FROM preds""", "preds"))
def _(spark, folder):
    made = spark.read.json(f"{_sliced(spark, folder)}/manifest")
    return made.select("id_col", F.array_join("used_slices", ",").alias("used_slices"), F.col("n_rows_joined").cast("bigint").alias("n_rows_joined"))


@query("c11_exploration_job", oracle(" UNION ALL ".join(_psi_sql(f) for f in _DRIFT), "abt", s=_S))
def _(spark, folder):
    out = session.fresh_path(spark, "eda")
    jobs.explore(spark, saved(abt(spark, folder), "abt"), out, SPLIT_YEARS)
    return rounded(spark.read.option("header", True).schema("feature string, psi double").csv(f"{out}/psi"), "psi")


def _volume_sql(output: str, keys: list[str], tail: str = "") -> str:
    key = " || ' ' || ".join(f"COALESCE(CAST({k} AS VARCHAR), '')" for k in keys)
    return f"(SELECT '{output}' AS output, {key} AS key, COUNT(*) AS n, {RATE} FROM abt GROUP BY {', '.join(keys)} {tail})"


def _bin_sql(feature: str) -> str:
    return f"SELECT 'bins_{feature}' AS output, COALESCE(bin, '') AS key, n, bad_rate FROM ({_labelled(feature, False)})"


# outputs of the exploration job: name -> (key columns, statement)
_VOLUMES = {
    "vintage": (["vintage_q"], _volume_sql("vintage", ["vintage_q"])),
    "states": (["state"], _volume_sql("states", ["state"], "ORDER BY n DESC, state LIMIT 25")),
    "channel_purpose": (["channel", "purpose"], _volume_sql("channel_purpose", ["channel", "purpose"])),
    **{f"bins_{f}": (["bin"], _bin_sql(f)) for f in ("fico", "ltv", "dti")},
    "intervals_fico": (["interval"], f"SELECT 'intervals_fico' AS output, interval AS key, n, bad_rate FROM ({INTERVALS})"),
}


def _report_rows(spark: SparkSession, folder: str, name: str, keys: list[str], n: str = "n", value: str = "bad_rate") -> DataFrame:
    report = spark.read.option("header", True).csv(f"{folder}/{name}")
    key = F.concat_ws(" ", *[F.coalesce(F.col(k), F.lit("")) for k in keys])
    return report.select(
        F.lit(name).alias("output"), key.alias("key"), F.expr(n).cast("bigint").alias("n"), F.expr(value).cast("double").alias("bad_rate"))


def _volumes(spark: SparkSession, folder: str) -> DataFrame:
    parts = [_report_rows(spark, folder, name, keys) for name, (keys, _) in _VOLUMES.items()]
    return functools.reduce(DataFrame.unionByName, parts)


@query("c11_exploration_job_outputs", oracle(" UNION ALL ".join([
    *[sql for _, sql in _VOLUMES.values()],
    *[f"SELECT 'histograms', feature || ' ' || bin, n, low FROM ({_hist_sql(f)})" for f in drift.DRIFT_FEATURES],
    *[f"SELECT 'outlier_flags', '{c}', COUNT(CASE WHEN {c} < {lo} OR {c} > {hi} OR {c} IS NULL THEN 1 END), NULL FROM abt"
      for c, (lo, hi) in AUDIT_RULES.items()],
    "SELECT 'missing_top', feature, NULL, missing_pct FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ROUND((COUNT(*) - COUNT({c})) * 100.0E0 / COUNT(*), 2) AS missing_pct FROM abt"
        for c in ABT_COLUMNS) + ") WHERE missing_pct > 0"]), "abt", s=_S))
def _(spark, folder):
    """Ten more outputs of the job in one long table; the last column is a rate, a histogram's edge or a share."""
    out = session.fresh_path(spark, "eda")
    jobs.explore(spark, saved(abt(spark, folder), "abt"), out, SPLIT_YEARS)
    rows = _volumes(spark, out).unionByName(_report_rows(spark, out, "histograms", ["feature", "bin"], value="low"))
    rows = rows.unionByName(_report_rows(spark, out, "outlier_flags", ["feature"], "count_flagged", "CAST(NULL AS DOUBLE)"))
    return rounded(rows.unionByName(_report_rows(spark, out, "missing_top", ["feature"], "CAST(NULL AS BIGINT)", "missing_pct")), "bad_rate")


_MEDIAN_INPUTS = ["orig_upb", "orig_rate", "fico", "ltv", "cltv", "dti", "msa", "loan_term", "num_units",
                  *_DER, "rate_spread_vintage"]


@query("c5_splits_job_medians", oracle(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, ROUND(quantile_cont(CAST({f} AS DOUBLE), 0.5), 4) AS median FROM d WHERE split = 'train'"
    for f in _MEDIAN_INPUTS), "abt", clean=_CLEAN, d=_DERIVED, s=_S))
def _(spark, folder):
    """The stored medians of every feature but the encoded categories, which c5_features_and_splits has."""
    out = session.fresh_path(spark, "splits")
    jobs.build_splits(spark, saved(abt(spark, folder), "abt"), out, f"{out}-medians", SPLIT_YEARS)
    schema = T_.StructType([T_.StructField("medians", T_.MapType(T_.StringType(), T_.DoubleType()))])
    stored = documents.read_document(spark, f"{out}-medians", schema).select(F.explode("medians").alias("feature", "median"))
    return rounded(stored.filter(~F.col("feature").endswith("_te")), "median", digits=4)


_EXPORT = oracle(f"""SELECT loan_id, vintage_q, state, channel, purpose, y_true, ROUND(y_pred, 6) AS pd,
  CASE WHEN y_pred <= {T} THEN 1 ELSE 0 END AS decision_at_t FROM preds""", "preds")


@query("c12_export_job", _EXPORT)
def _(spark, folder):
    return _exported(spark, folder)


@query("s15_export_set", oracle(f"SELECT vintage_q, COUNT(*) AS n, {RATE} FROM abt GROUP BY 1", "abt"))
def _(spark, folder):
    from vintagemill.operators import summaries
    report = session.fresh_path(spark, "vintage")
    tables.write_report(rounded(summaries.by_vintage(abt(spark, folder)), "bad_rate"), report)
    out = _export(spark, folder, {"vintage": report})
    return spark.read.option("header", True).schema("vintage_q date, n bigint, bad_rate double").csv(f"{out}/vintage")


def _export(spark, folder, reports):
    out = session.fresh_path(spark, "export")
    documents.write_document(documents.policy_record(spark, {"threshold": T, "metric": "f1", "prob": "y_pred"}), f"{out}-policy")
    jobs.export_decisions(spark, {"test": saved(preds(spark, folder), "preds")}, reports, f"{out}-policy", out, "y_pred")
    return out


def _exported(spark, folder):
    schema = "loan_id bigint, vintage_q date, state string, channel string, purpose string, y_true int, pd double, decision_at_t int"
    return rounded(spark.read.option("header", True).schema(schema).csv(f"{_export(spark, folder, {})}/test"), "pd")


@query("s15_full_export_set", oracle(" UNION ALL ".join([
    *[sql for _, sql in _VOLUMES.values()],
    *[f"""SELECT '{name}', CAST(loan_id AS VARCHAR), CASE WHEN y_pred <= {T} THEN 1 ELSE 0 END, ROUND(y_pred, 6) FROM preds WHERE {rows}"""
      for name, rows in (("test", "y_true = 0"), ("recent", "true"))],
    f"SELECT 'summary', 'f1 y_pred', NULL, {T}"]), "abt", "preds"))
def _(spark, folder):
    """Two decision tables, seven reports and the summary, as exported, in one long table."""
    eda, out = session.fresh_path(spark, "eda"), session.fresh_path(spark, "export")
    jobs.explore(spark, saved(abt(spark, folder), "abt"), eda, SPLIT_YEARS)
    documents.write_document(documents.policy_record(spark, {"threshold": T, "metric": "f1", "prob": "y_pred"}), f"{out}-policy")
    whole = preds(spark, folder)
    jobs.export_decisions(
        spark, {"test": saved(whole.filter("y_true = 0"), "preds"), "recent": saved(whole, "preds")},
        {name: f"{eda}/{name}" for name in _VOLUMES}, f"{out}-policy", out, "y_pred")
    rows = _volumes(spark, out)
    for name in ("test", "recent"):
        rows = rows.unionByName(_report_rows(spark, out, name, ["loan_id"], "decision_at_t", "pd"))
    summary = spark.read.json(f"{out}/summary").select(
        F.lit("summary").alias("output"), F.concat_ws(" ", "metric", "prob").alias("key"), F.lit(None).cast("bigint").alias("n"),
        F.col("threshold").cast("double").alias("bad_rate"))
    return rounded(rows.unionByName(summary), "bad_rate")
