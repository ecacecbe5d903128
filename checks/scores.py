"""Ranking metrics, policy curves, thresholds, slices and backtests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.loans import abt, rounded
from checks.registry import query
from checks.views import oracle
from vintagemill import session
from vintagemill.functions import bins, numeric
from vintagemill.operators import ordered, policy, ranking
from vintagemill.sources import tables

SLICES = ["vintage_q", "state", "channel", "purpose"]
T = 0.25  # threshold of the policy checks; some scores lie exactly on it


def preds(spark: SparkSession, folder: str) -> DataFrame:
    bad = F.col("default_within_24m").cast("int")
    score = (((850 - F.col("fico")) * F.col("ltv")).cast("bigint") % 997 + bad * 400 + 1) / F.lit(1500.0)
    return abt(spark, folder).select(
        "loan_id", "state", "channel", "purpose", "vintage_q", "msa", bad.alias("y_true"), score.alias("y_pred"))


def of_year(df: DataFrame, *years: int) -> DataFrame:
    return df.filter(F.year("vintage_q").isin(*years))


def ranked(by: str = "", source: str = "preds") -> dict[str, str]:
    """CTEs g, c: counts per distinct score and their running totals."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    up = f"OVER ({part} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    down = f"OVER ({part} ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return {
        "g": f"SELECT {keys}y_pred AS p, SUM(y_true) AS pos, COUNT(*) - SUM(y_true) AS neg FROM {source} GROUP BY {keys}y_pred",
        "c": f"""SELECT {keys}p, pos, neg, SUM(pos) {up} AS cpos, SUM(neg) {up} AS cneg, SUM(pos) {down} AS dpos,
                 SUM(neg) {down} AS dneg, SUM(pos) OVER ({part}) AS tp, SUM(neg) OVER ({part}) AS tn FROM g""",
    }


AUC = "ROUND(SUM(pos * (CAST(cneg AS DOUBLE) - neg + neg / 2.0E0)) / NULLIF(MAX(tp) * CAST(MAX(tn) AS DOUBLE), 0), 6) AS auc"
AP = "ROUND(SUM(CASE WHEN tp > 0 AND tn > 0 THEN CAST(pos AS DOUBLE) / tp * (CAST(dpos AS DOUBLE) / (dpos + dneg)) END), 6)"
KS2 = "ROUND(MAX(ABS(CAST(cpos AS DOUBLE) / NULLIF(tp, 0) - CAST(cneg AS DOUBLE) / NULLIF(tn, 0))), 6) AS ks"
KS1 = "ROUND(MAX(CASE WHEN tp > 0 AND tn > 0 THEN GREATEST(CAST(cneg AS DOUBLE) / tn - CAST(cpos AS DOUBLE) / tp, 0.0E0) END), 6) AS ks"
BAD = "ROUND(AVG(CAST(y_true AS DOUBLE)), 6)"


def _metric(name: str):
    def run(spark, folder):
        return rounded(ranking.evaluate(preds(spark, folder), metrics=[name]), name)
    return run


for _name, _sql in (("auc", AUC), ("pr_auc", f"{AP} AS pr_auc"), ("ks", KS2)):
    _key = {"auc": "a24_roc_auc", "pr_auc": "a25_average_precision", "ks": "a26_ks"}[_name]
    query(_key, oracle(f"SELECT {_sql} FROM c", "preds", **ranked()))(_metric(_name))


@query("a26_ks_one_sided_by_vintage", oracle(f"SELECT vintage_q, {KS1} FROM c GROUP BY 1", "preds", **ranked("vintage_q")))
def _(spark, folder):
    return rounded(ranking.evaluate(preds(spark, folder), by=["vintage_q"], two_sided_ks=False, metrics=["ks"]), "ks")


@query("a22_brier_rmse", oracle("""
SELECT COUNT(*) AS n, ROUND(AVG((y_true - y_pred) * (y_true - y_pred)), 6) AS brier,
       ROUND(SQRT(AVG((y_true - y_pred) * (y_true - y_pred))), 6) AS rmse FROM preds""", "preds"))
def _(spark, folder):
    return rounded(ranking.probability_errors(preds(spark, folder), "y_pred", "y_true").drop("logloss"), "brier", "rmse")


LOGLOSS = ("ROUND(AVG(-(y_true * ln(LEAST(GREATEST(y_pred, 1e-6), 1 - 1e-6)) "
           "+ (1 - y_true) * ln(1 - LEAST(GREATEST(y_pred, 1e-6), 1 - 1e-6)))), 6)")


@query("a23_log_loss", oracle(f"""
SELECT vintage_q, CASE WHEN MIN(y_true) <> MAX(y_true) THEN {LOGLOSS} END AS logloss FROM preds GROUP BY 1""", "preds"))
def _(spark, folder):
    df = ranking.probability_errors(preds(spark, folder), "y_pred", "y_true", ["vintage_q"])
    return rounded(df.select("vintage_q", "logloss"), "logloss")


_LONG = " UNION ALL ".join(
    f"SELECT '{s}' AS slice, CAST({s} AS VARCHAR) AS value, y_true, y_pred FROM preds WHERE {s} IS NOT NULL" for s in SLICES)


@query("a27_slice_metrics", oracle(f"""
SELECT slice, value, CAST(SUM(pos + neg) AS BIGINT) AS n, ROUND(CAST(SUM(pos) AS DOUBLE) / SUM(pos + neg), 6) AS bad_rate,
       {AUC}, {AP} AS pr_auc, {KS1} FROM c GROUP BY 1, 2""", "preds", long=_LONG, **ranked("slice, value", "long")))
def _(spark, folder):
    df = ranking.evaluate_slices(preds(spark, folder), SLICES)
    return rounded(df, "bad_rate", "auc", "pr_auc", "ks")


_MODELS = """SELECT 'valid' AS split, 'y_pred' AS model, y_true, y_pred FROM preds WHERE year(vintage_q) = 1997
UNION ALL SELECT 'test', 'y_pred', y_true, y_pred FROM preds WHERE year(vintage_q) = 1998
UNION ALL SELECT 'valid', 'y_half', y_true, round(y_pred * 20) / 20 FROM preds WHERE year(vintage_q) = 1997
UNION ALL SELECT 'test', 'y_half', y_true, round(y_pred * 20) / 20 FROM preds WHERE year(vintage_q) = 1998"""


@query("m7_evaluation_block", oracle(f"""
SELECT r.*, e.brier, e.logloss FROM (
  SELECT split, model, CAST(SUM(pos + neg) AS BIGINT) AS n, CAST(SUM(pos) AS BIGINT) AS positives,
         ROUND(CAST(SUM(pos) AS DOUBLE) / SUM(pos + neg), 6) AS bad_rate, {AUC}, {AP} AS pr_auc, {KS2} FROM c GROUP BY 1, 2) r
JOIN (SELECT split, model, ROUND(AVG((y_true - y_pred) * (y_true - y_pred)), 6) AS brier, {LOGLOSS} AS logloss
      FROM long GROUP BY 1, 2) e ON r.split = e.split AND r.model = e.model""",
    "preds", long=_MODELS, **ranked("split, model", "long")))
def _(spark, folder):
    df = preds(spark, folder).withColumn("y_half", F.round(F.col("y_pred") * 20) / 20)
    year = F.year("vintage_q")
    df = df.withColumn("split", F.when(year == 1997, "valid").when(year == 1998, "test")).dropna(subset=["split"])
    block = ranking.evaluate_models(df, ["y_pred", "y_half"], by=["split"]).drop("rmse")
    return rounded(block, "bad_rate", "auc", "pr_auc", "ks", "brier", "logloss")


@query("a30_roc_points", oracle("""
SELECT p AS score, ROUND(CAST(dpos AS DOUBLE) / tp, 6) AS tpr, ROUND(CAST(dneg AS DOUBLE) / tn, 6) AS fpr FROM c""",
    "preds", **ranked()))
def _(spark, folder):
    return rounded(ranking.roc_points(preds(spark, folder)), "tpr", "fpr")


@query("a30_precision_recall_points", oracle("""
SELECT p AS score, ROUND(CAST(dpos AS DOUBLE) / (dpos + dneg), 6) AS precision, ROUND(CAST(dpos AS DOUBLE) / tp, 6) AS recall
FROM c""", "preds", **ranked()))
def _(spark, folder):
    return rounded(ranking.precision_recall_points(preds(spark, folder)), "precision", "recall")


@query("w3_cumulative_shares", oracle("""
SELECT p AS score, ROUND(CAST(cpos AS DOUBLE) / tp, 6) AS cum_pos, ROUND(CAST(cneg AS DOUBLE) / tn, 6) AS cum_neg FROM c""",
    "preds", **ranked()))
def _(spark, folder):
    return rounded(ranking.cumulative_shares(preds(spark, folder)), "cum_pos", "cum_neg")


# --- quantiles and thresholds

@query("a14_score_quantiles", oracle(" UNION ALL ".join(
    f"SELECT {float(q)!r}E0 AS q, ROUND(quantile_cont(y_pred, {q}), 6) AS value FROM preds"
    for q in policy.COHORT_QUANTILES), "preds"))
def _(spark, folder):
    return rounded(policy.score_quantiles(preds(spark, folder), "y_pred"), "value")


@query("a15_threshold_shares", oracle(" UNION ALL ".join(
    f"SELECT {t}E0 AS threshold, ROUND(AVG(CASE WHEN y_pred <= {t}E0 THEN 1.0E0 ELSE 0.0E0 END), 6) AS share FROM preds"
    for t in policy.COHORT_THRESHOLDS), "preds"))
def _(spark, folder):
    return rounded(policy.threshold_shares(preds(spark, folder), "y_pred"), "share")


# The grid as the doubles the engine uses, so that both sides compare the same numbers.
GRID = [x for x in policy.parse_grid("0.05:0.95:0.05")] + [0.2, 0.25, 0.3 + 1e-9]
_GRID_SQL = "SELECT UNNEST([" + ", ".join(f"{t!r}E0" if "e" not in repr(t) else repr(t) for t in GRID) + "]) AS threshold"
_CURVE = """
SELECT t.threshold, SUM(CASE WHEN y_pred <= threshold THEN 1 ELSE 0 END) AS appr,
       SUM(CASE WHEN y_pred <= threshold THEN y_true ELSE 0 END) AS appr_bad,
       AVG(CASE WHEN y_pred <= threshold THEN y_pred END) AS mean_pd, COUNT(*) AS n,
       SUM(CASE WHEN y_true = 1 AND y_pred >= threshold THEN 1 ELSE 0 END) AS tp,
       SUM(CASE WHEN y_true = 0 AND y_pred >= threshold THEN 1 ELSE 0 END) AS fp,
       SUM(CASE WHEN y_true = 0 AND y_pred < threshold THEN 1 ELSE 0 END) AS tn,
       SUM(CASE WHEN y_true = 1 AND y_pred < threshold THEN 1 ELSE 0 END) AS fn
FROM grid t CROSS JOIN preds GROUP BY t.threshold, t.pos
"""
_CURVE_COLUMNS = """
ROUND(threshold, 6) AS threshold, ROUND(COALESCE(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0), 6) AS precision,
ROUND(COALESCE(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0), 6) AS recall,
ROUND(COALESCE(2 * tp / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0), 6) AS f1,
ROUND(COALESCE(GREATEST(LEAST(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0) - fp / NULLIF(CAST(fp + tn AS DOUBLE), 0), 1), 0), 0), 6) AS ks,
ROUND(appr / CAST(n AS DOUBLE), 6) AS approve_rate, ROUND(appr_bad / NULLIF(CAST(appr AS DOUBLE), 0), 6) AS approved_bad_rate,
ROUND(mean_pd, 6) AS approved_mean_pd, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn
"""
_ROUNDED_GRID = f"SELECT threshold, row_number() OVER () AS pos FROM ({_GRID_SQL})"
_CURVE_CTES = {"grid": _ROUNDED_GRID, "curve": _CURVE, "k": f"SELECT {_CURVE_COLUMNS} FROM curve"}
_RATES = ["threshold", "precision", "recall", "f1", "ks", "approve_rate", "approved_bad_rate", "approved_mean_pd"]


def curve(spark, folder):
    return policy.policy_curve(preds(spark, folder), "y_pred", "y_true", GRID)


@query("a16_policy_curve", oracle("SELECT * FROM k", "preds", **_CURVE_CTES))
def _(spark, folder):
    return rounded(curve(spark, folder), *_RATES)


@query("a16_policy_curve_default_grid_global_ks", oracle(f"""
SELECT k.*, (SELECT {KS2} FROM c) AS ks_global FROM k""", "preds",
    grid=f"SELECT threshold, row_number() OVER () AS pos FROM (SELECT UNNEST([{', '.join(f'{t!r}E0' for t in policy.parse_grid())}]) AS threshold)",
    curve=_CURVE, k=_CURVE_CTES["k"], **ranked()))
def _(spark, folder):
    df = policy.policy_curve(preds(spark, folder), "y_pred", "y_true", with_global_ks=True)
    return rounded(df, *_RATES, "ks_global")


@query("p30_ks_from_counts", oracle("SELECT threshold, ks FROM k", "preds", **_CURVE_CTES))
def _(spark, folder):
    stored = curve(spark, folder).drop("ks")
    return rounded(policy.with_curve_ks(stored).select("threshold", "ks"), "threshold", "ks")


@query("a35_best_threshold", oracle("""
SELECT 'f1' AS metric, threshold, f1 AS best FROM (SELECT * FROM k ORDER BY f1 DESC, threshold LIMIT 1)
UNION ALL SELECT 'ks', threshold, ks FROM (SELECT * FROM k ORDER BY ks DESC, threshold LIMIT 1)""", "preds", **_CURVE_CTES))
def _(spark, folder):
    df = rounded(curve(spark, folder), *_RATES)
    best = [policy.best_threshold(df, m).select(F.lit(m).alias("metric"), "threshold", F.col(m).alias("best"))
            for m in ("f1", "ks")]
    return best[0].unionByName(best[1])


@query("m14_threshold_by_metric", oracle("""
SELECT threshold, 'f1' AS metric, 'y_pred' AS prob FROM (SELECT * FROM k ORDER BY f1 DESC, threshold LIMIT 1)""",
    "preds", **_CURVE_CTES))
def _(spark, folder):
    best = policy.best_threshold(rounded(curve(spark, folder), *_RATES), "f1")
    return best.select("threshold", F.lit("f1").alias("metric"), F.lit("y_pred").alias("prob"))


@query("w5_nearest_row", oracle("""
SELECT threshold, approve_rate, precision, recall, f1, ks, tp, fp, tn, fn FROM k
ORDER BY abs(threshold - 0.33), threshold LIMIT 1""", "preds", **_CURVE_CTES))
def _(spark, folder):
    row = policy.nearest_row(rounded(curve(spark, folder), *_RATES), 0.33)
    return row.select("threshold", "approve_rate", "precision", "recall", "f1", "ks", "tp", "fp", "tn", "fn")


@query("p29_near_threshold", oracle("""
SELECT threshold, recall, precision, f1, ks, approve_rate FROM k WHERE threshold BETWEEN 0.24 AND 0.36""",
    "preds", **_CURVE_CTES))
def _(spark, folder):
    near = policy.near_threshold(curve(spark, folder), 0.30, span=0.12)
    return near.select("threshold", "recall", "precision", "f1", "ks", "approve_rate")


@query("u4_curve_long", oracle("""
SELECT threshold, metric, value FROM (UNPIVOT (SELECT threshold, recall, precision, f1, ks FROM k)
  ON recall, precision, f1, ks INTO NAME metric VALUE value)""", "preds", **_CURVE_CTES))
def _(spark, folder):
    return policy.curve_long(rounded(curve(spark, folder), *_RATES))


@query("a17_quantile_policy_curve", oracle("""
SELECT q.position, ROUND(q.threshold, 6) AS threshold,
       ROUND(SUM(CASE WHEN y_pred < threshold THEN 1 ELSE 0 END) / CAST(COUNT(*) AS DOUBLE), 6) AS approval_rate,
       ROUND(AVG(CASE WHEN y_pred < threshold THEN CAST(y_true AS DOUBLE) END), 6) AS bad_rate_in_approved,
       ROUND(SUM(CASE WHEN y_pred >= threshold THEN y_true ELSE 0 END) / CAST(SUM(y_true) AS DOUBLE), 6) AS captured_defaults_share
FROM q CROSS JOIN preds GROUP BY q.position, q.threshold""", "preds",
    qs="SELECT CAST(i AS INT) AS position, CASE WHEN i = 100 THEN 1.0E0 ELSE i * 0.01E0 END AS q FROM range(101) r(i)",
    arr="SELECT list(y_pred ORDER BY y_pred) AS a, COUNT(*) - 1 AS m FROM preds",
    q="""SELECT position, a[CAST(floor(m * q) AS INT) + 1]
           + (a[CAST(ceil(m * q) AS INT) + 1] - a[CAST(floor(m * q) AS INT) + 1]) * (m * q - floor(m * q)) AS threshold FROM qs, arr"""))
def _(spark, folder):
    df = policy.quantile_policy_curve(preds(spark, folder), "y_pred", "y_true")
    return rounded(df, "threshold", "approval_rate", "bad_rate_in_approved", "captured_defaults_share")


@query("m13_threshold_for_approval", oracle("""
SELECT ROUND(t, 6) AS threshold, 0.22E0 AS target_approve_rate, 'y_pred' AS prob,
       ROUND((SELECT AVG(CASE WHEN y_pred <= t THEN 1.0E0 ELSE 0.0E0 END) FROM preds), 6) AS actual_approve_rate
FROM (SELECT quantile_cont(y_pred, 0.22) AS t FROM preds)""", "preds"))
def _(spark, folder):
    df = policy.threshold_for_approval(preds(spark, folder), "y_pred", 0.22)
    return rounded(df, "threshold", "actual_approve_rate")


@query("p20_approve_predicate", oracle(f"""
SELECT loan_id, y_pred <= {T} AS approved, y_pred < {T} AS approved_strict FROM preds""", "preds"))
def _(spark, folder):
    return preds(spark, folder).select(
        "loan_id", numeric.approves("y_pred", T).alias("approved"), numeric.approves("y_pred", T, True).alias("approved_strict"))


@query("a21_expected_bad_rate", oracle(f"""
SELECT ROUND(AVG(CASE WHEN y_pred <= {T} THEN 1.0E0 ELSE 0.0E0 END), 6) AS approve_rate,
       ROUND(AVG(CASE WHEN y_pred <= {T} THEN y_pred END), 6) AS expected_bad_rate_on_approved FROM preds""", "preds"))
def _(spark, folder):
    df = policy.approved_outcome(preds(spark, folder), "y_pred", T)
    return rounded(df, "approve_rate", "expected_bad_rate_on_approved")


def _policy_sql(strict: bool, keys: str) -> str:
    ok = f"y_pred {'<' if strict else '<='} {T}"
    return f"""SELECT {keys}, COUNT(*) AS n, ROUND(AVG(CASE WHEN {ok} THEN 1.0E0 ELSE 0.0E0 END), 6) AS approve_rate,
      COUNT(CASE WHEN {ok} THEN 1 END) AS approved, ROUND(AVG(CASE WHEN {ok} THEN CAST(y_true AS DOUBLE) END), 6) AS approved_bad_rate,
      {BAD} AS overall_bad_rate"""


@query("a18_policy_by_slice", oracle(
    f"{_policy_sql(True, 'slice, value')} FROM long GROUP BY 1, 2", "preds",
    long=" UNION ALL ".join(f"SELECT '{s}' AS slice, CAST({s} AS VARCHAR) AS value, y_true, y_pred FROM preds"
                            for s in ("vintage_q", "channel", "purpose", "msa"))))
def _(spark, folder):
    df = policy.policy_by_slice(
        preds(spark, folder), ["vintage_q", "channel", "purpose", "msa"], "y_pred", "y_true", T, strict=True)
    return rounded(df, "approve_rate", "approved_bad_rate", "overall_bad_rate")


@query("p32_policy_in_largest_states", oracle(f"""
{_policy_sql(False, 'state')} FROM preds WHERE state IN (
  SELECT state FROM preds WHERE state IS NOT NULL GROUP BY state ORDER BY COUNT(*) DESC, state LIMIT 20) GROUP BY 1""", "preds"))
def _(spark, folder):
    top = policy.in_largest_groups(preds(spark, folder), "state", 20)
    df = top.groupBy("state").agg(*policy.policy_aggregates("y_pred", "y_true", T))
    return rounded(df, "approve_rate", "approved_bad_rate", "overall_bad_rate")


@query("j11_semi_join_top_states", oracle("""
SELECT loan_id, state FROM preds WHERE state IN (SELECT state FROM preds GROUP BY state ORDER BY COUNT(*) DESC, state LIMIT 5)""",
    "preds"))
def _(spark, folder):
    return policy.in_largest_groups(preds(spark, folder), "state", 5).select("loan_id", "state")


@query("a19_backtest_by_vintage", oracle(f"""
SELECT vintage_q, COUNT(*) AS n, ROUND(AVG(CASE WHEN y_pred <= {T} THEN 1.0E0 ELSE 0.0E0 END), 6) AS approve_rate,
       ROUND(AVG(CASE WHEN y_pred <= {T} THEN CAST(y_true AS DOUBLE) END), 6) AS approved_bad_rate, {BAD} AS overall_bad_rate
FROM preds GROUP BY 1""", "preds"))
def _(spark, folder):
    df = policy.backtest(preds(spark, folder), "y_pred", T, "y_true")
    return rounded(df, "approve_rate", "approved_bad_rate", "overall_bad_rate")


@query("a19_backtest_without_labels", oracle(f"""
SELECT COUNT(*) AS n, ROUND(AVG(CASE WHEN y_pred <= {T} THEN 1.0E0 ELSE 0.0E0 END), 6) AS approve_rate FROM preds""", "preds"))
def _(spark, folder):
    return rounded(policy.backtest(preds(spark, folder), "y_pred", T, vintage=None), "approve_rate")


_SHARE = f"ROUND(AVG(CASE WHEN y_pred <= {T} THEN 1.0E0 ELSE 0.0E0 END), 6) AS approve_rate, COUNT(*) AS n"


@query("a20_approved_share", oracle(f"""
SELECT channel, purpose, state, msa, vintage_q, {_SHARE} FROM preds GROUP BY 1, 2, 3, 4, 5""", "preds"))
def _(spark, folder):
    df = policy.approved_share(preds(spark, folder), ["channel", "purpose", "state", "msa", "vintage_q"], "y_pred", T)
    return rounded(df, "approve_rate")


@query("a20_approved_share_one_at_a_time", oracle(f"""
SELECT channel, purpose, GROUPING(channel, purpose) AS grouping, {_SHARE} FROM preds
GROUP BY GROUPING SETS ((channel), (purpose))""", "preds"))
def _(spark, folder):
    df = policy.approved_share(preds(spark, folder), ["channel", "purpose"], "y_pred", T, one_at_a_time=True)
    return rounded(df, "approve_rate")


@query("p21_decision_export", oracle(f"""
SELECT loan_id, vintage_q, state, channel, purpose, y_true, y_pred AS pd, CASE WHEN y_pred <= {T} THEN 1 ELSE 0 END AS decision_at_t
FROM preds""", "preds"))
def _(spark, folder):
    keep = ["loan_id", "vintage_q", "state", "channel", "purpose", "y_true"]
    return policy.decisions(preds(spark, folder), "y_pred", T, keep)


@query("s12_report_sink", oracle("SELECT CAST(threshold AS VARCHAR) AS threshold, CAST(tp AS VARCHAR) AS tp FROM k", "preds",
                                 **_CURVE_CTES))
def _(spark, folder):
    path = session.fresh_path(spark, "report")
    tables.write_report(rounded(curve(spark, folder), *_RATES).select("threshold", "tp"), path)
    return tables.read_report(spark, path)
