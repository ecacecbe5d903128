"""Audit, drift, features, macro joins, slice joins, KPI history, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.loans import abt, dataset, rounded
from checks.registry import query
from checks.scores import SLICES, T, preds
from checks.views import SPLIT_SQL, SPLIT_YEARS, oracle, table, view
from vintagemill import session
from vintagemill.functions import bins, codes, dates, numeric
from vintagemill.operators import (
    audit,
    calibration,
    columns,
    drift,
    features,
    joins,
    macro,
    monitoring,
    ordered,
    policy,
    ranking,
    sampling,
    summaries,
)
from vintagemill.schemas import ABT_COLUMNS, AUDIT_RULES, CATEGORY_COLUMNS, CLIP_RANGES, HPI_SCHEMA, LABEL, PLATT_SCHEMA
from vintagemill.sources import documents, tables

BAD_INT = "CASE WHEN default_within_24m THEN 1 ELSE 0 END"

# --- audit

@query("a8_audit_header", oracle("""
SELECT COUNT(*) AS rows, COUNT(DISTINCT loan_id) AS unique_keys, COUNT(*) - COUNT(DISTINCT loan_id) AS duplicates,
       MIN(first_payment_date) AS min_fp, MAX(first_payment_date) AS max_fp, MIN(vintage_q) AS min_vint, MAX(vintage_q) AS max_vint,
       MIN(last_perf_month) AS min_last, MAX(last_perf_month) AS max_last,
       ROUND(AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END), 6) AS bad_rate,
       COUNT(CASE WHEN default_within_24m IS NULL THEN 1 END) AS label_nulls FROM abt""", "abt"))
def _(spark, folder):
    return rounded(audit.audit_header(abt(spark, folder)), "bad_rate")


@query("a9_missing_values", oracle(" UNION ALL ".join(
    f"SELECT '{c}' AS col, COUNT(*) - COUNT({c}) AS nulls, ROUND((COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE), 6) AS miss_rate FROM abt"
    for c in ABT_COLUMNS), "abt"))
def _(spark, folder):
    return rounded(audit.missing_values(abt(spark, folder)), "miss_rate")


@query("a9_most_missing", oracle("SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND((COUNT(*) - COUNT({c})) * 100.0E0 / COUNT(*), 2) AS missing_pct FROM abt"
    for c in ABT_COLUMNS) + ") WHERE missing_pct > 0", "abt"))
def _(spark, folder):
    return audit.most_missing(abt(spark, folder))


@query("p27_outlier_flags", oracle(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, COUNT(CASE WHEN {c} < {lo} OR {c} > {hi} OR {c} IS NULL THEN 1 END) AS count_flagged FROM abt"
    for c, (lo, hi) in AUDIT_RULES.items()), "abt"))
def _(spark, folder):
    return audit.outlier_flags(abt(spark, folder))


@query("a10_top_values", oracle("SELECT col, val, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, val ASC NULLS LAST) AS rank FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS val, COUNT(*) AS n FROM abt GROUP BY 2" for c in CATEGORY_COLUMNS)
    + ")) WHERE rank <= 10", "abt"))
def _(spark, folder):
    return audit.top_values(abt(spark, folder))


_NUMERIC = ["fico", "orig_upb", "orig_rate", "ltv", "cltv", "dti", "msa", "loan_term", "num_units"]


@query("a33_numeric_summary", oracle(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(AVG({c}), 4) AS mean, ROUND(CAST(quantile_cont({c}, 0.5) AS DOUBLE), 4) AS median, "
    f"CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max, ROUND(stddev_samp({c}), 4) AS std FROM abt"
    for c in _NUMERIC), "abt"))
def _(spark, folder):
    return rounded(audit.numeric_summary(abt(spark, folder), _NUMERIC), "mean", "median", "std", digits=4)


@query("p16_column_roles", oracle("""
SELECT 'label' AS role, 'y_true' AS "column", 1 AS rank WHERE (SELECT COUNT(*) FROM preds WHERE y_true NOT IN (0, 1)) = 0
UNION ALL SELECT 'probability', 'y_pred', 1 WHERE (SELECT AVG(CASE WHEN y_pred BETWEEN 0 AND 1 THEN 1.0 ELSE 0.0 END) FROM preds) > 0.98
  AND (SELECT COUNT(DISTINCT y_pred) FROM preds) > 10""", "preds"))
def _(spark, folder):
    return audit.detect_roles(preds(spark, folder))


# --- drift and bins

_DRIFT = ["fico", "ltv", "cltv", "dti", "orig_rate", "orig_upb"]


def _psi_sql(f: str) -> str:
    edge = lambda i: f"q[{i + 1}]"
    cases = " ".join(f"WHEN v >= {edge(i)} THEN {i}" for i in range(9, -1, -1))
    shares = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"
    return f"""SELECT '{f}' AS feature, ROUND(SUM((b - c) * ln(b / c)), 6) AS psi FROM (
      SELECT bin, GREATEST(SUM(is_base) / CAST(SUM(SUM(is_base)) OVER () AS DOUBLE), 1e-6) AS b,
             GREATEST(SUM(1 - is_base) / CAST(SUM(SUM(1 - is_base)) OVER () AS DOUBLE), 1e-6) AS c
      FROM (SELECT is_base, CASE WHEN v > {edge(10)} THEN NULL {cases} END AS bin FROM (
              SELECT CAST({f} AS DOUBLE) AS v, CASE WHEN split = 'train' THEN 1 ELSE 0 END AS is_base FROM s WHERE split IN ('train', 'test')),
            (SELECT quantile_cont(CAST({f} AS DOUBLE), {shares}) AS q FROM s WHERE split = 'train'))
      WHERE bin IS NOT NULL GROUP BY bin)"""


_S = f"SELECT *, {SPLIT_SQL} AS split FROM abt"


def split_abt(spark, folder):
    return features.with_split(abt(spark, folder), SPLIT_YEARS)


@query("a28_stability_index", oracle(" UNION ALL ".join(_psi_sql(f) for f in _DRIFT), "abt", s=_S))
def _(spark, folder):
    df = split_abt(spark, folder)
    psi = drift.stability_index(df.filter("split = 'train'"), df.filter("split = 'test'"), _DRIFT)
    return rounded(psi, "psi")


def _hist_sql(f: str) -> str:
    return f"""SELECT '{f}' AS feature, bin, ROUND(lo + bin * (hi - lo) / 60, 6) AS low, ROUND(lo + (bin + 1) * (hi - lo) / 60, 6) AS high,
      COUNT(*) AS n FROM (
      SELECT lo, hi, g - CASE WHEN v < lo + g * ((hi - lo) / 60) THEN 1 ELSE 0 END
           + CASE WHEN v >= lo + (g + 1) * ((hi - lo) / 60) AND g < 59 THEN 1 ELSE 0 END AS bin
      FROM (SELECT v, lo, hi, CAST(LEAST(floor((v - lo) / (hi - lo) * 60), 59) AS INT) AS g FROM
        (SELECT CAST({f} AS DOUBLE) AS v FROM s WHERE split = 'train' AND {f} IS NOT NULL),
        (SELECT MIN(CAST({f} AS DOUBLE)) AS lo, MAX(CAST({f} AS DOUBLE)) AS hi FROM s WHERE split = 'train'))) GROUP BY lo, hi, bin"""


@query("a31_histograms", oracle(" UNION ALL ".join(_hist_sql(f) for f in drift.DRIFT_FEATURES), "abt", s=_S))
def _(spark, folder):
    return rounded(drift.histograms(split_abt(spark, folder).filter("split = 'train'")), "low", "high")


_QCUT = """q AS (SELECT quantile_cont(y_pred, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e FROM preds)"""
_QBIN = "CASE " + " ".join(f"WHEN y_pred <= e[{i + 2}] THEN {i}" for i in range(10)) + " END"


@query("p24_quantile_bins", oracle(f"SELECT {_QBIN} AS bin, COUNT(*) AS n FROM preds, q GROUP BY 1", "preds",
                                   q=_QCUT[6:-1]))
def _(spark, folder):
    return drift.with_quantile_bin(preds(spark, folder), "y_pred").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


_RELIABILITY = "COUNT(*) AS n, ROUND(AVG(y_pred), 6) AS predicted, ROUND(AVG(CAST(y_true AS DOUBLE)), 6) AS observed"


@query("a29_calibration_table", oracle(f"SELECT {_QBIN} AS bin, {_RELIABILITY} FROM preds, q GROUP BY 1", "preds",
                                       q=_QCUT[6:-1]))
def _(spark, folder):
    return rounded(drift.calibration_table(preds(spark, folder), "y_pred", "y_true"), "predicted", "observed")


@query("a29_uniform_calibration_table", oracle(
    "SELECT CASE " + " ".join(f"WHEN y_pred <= {i * 0.05!r}E0 THEN {i - 1}" for i in range(1, 20)) + f" ELSE 19 END AS bin, {_RELIABILITY} "
    "FROM preds GROUP BY 1", "preds"))
def _(spark, folder):
    return rounded(drift.uniform_calibration_table(preds(spark, folder), "y_pred", "y_true"), "predicted", "observed")


@query("m5_monotonicity_check", oracle("""
SELECT 'fico' AS feature, bin, n, ROUND(m, 6) AS mean_score, COALESCE((m - LAG(m) OVER (ORDER BY bin)) * -1 < 0, FALSE) AS violates FROM (
  SELECT CASE """ + " ".join(f"WHEN fico <= e[{i + 2}] THEN {i}" for i in range(10)) + """ END AS bin, COUNT(*) AS n, AVG(y_pred) AS m
  FROM (SELECT a.fico, p.y_pred FROM abt a JOIN preds p USING (loan_id)),
       (SELECT quantile_cont(CAST(fico AS DOUBLE), [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS e FROM abt) GROUP BY 1)""", "abt", "preds"))
def _(spark, folder):
    scored = joins.align_by_key(preds(spark, folder), abt(spark, folder).select("loan_id", "fico"))
    return rounded(drift.monotonicity_check(scored, "fico", "y_pred", -1), "mean_score")


# --- features

CLIPPED = {
    **{c: f"LEAST(GREATEST({c}, {lo}), {hi})" for c, (lo, hi) in CLIP_RANGES.items()},
    "dti": "CASE WHEN dti IS NULL THEN NULL ELSE LEAST(GREATEST(dti, 0), 65) END",
}
_CLEAN = ("SELECT loan_id, vintage_q, state, channel, purpose, default_within_24m, orig_upb, orig_rate, msa, loan_term, num_units, "
          + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in CLIPPED.items()) + f", {SPLIT_SQL} AS split FROM abt")
_DERIVED = """SELECT *, 850.0E0 - fico AS fico_gap, GREATEST(ltv - 80, 0) AS ltv_80, GREATEST(ltv - 90, 0) AS ltv_90,
  CASE WHEN dti IS NOT NULL THEN GREATEST(dti - 43, 0) END AS dti_43, (850.0E0 - fico) * ltv AS int_fico_gap_x_ltv,
  dti * ltv AS int_dti_x_ltv,
  orig_rate - (SELECT m FROM (SELECT vintage_q AS v, quantile_cont(orig_rate, 0.5) AS m FROM clean GROUP BY 1) WHERE v = vintage_q) AS rate_spread_vintage
FROM clean"""


@query("p10_split_by_year", oracle(f"SELECT loan_id, {SPLIT_SQL} AS split FROM abt", "abt"))
def _(spark, folder):
    return split_abt(spark, folder).select("loan_id", "split")


@query("a32_split_sizes", oracle(f"""
SELECT split, COUNT(*) AS n, COUNT(CASE WHEN default_within_24m THEN 1 END) AS positives,
       ROUND(AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END), 6) AS positive_rate FROM s GROUP BY 1""", "abt", s=_S))
def _(spark, folder):
    return rounded(summaries.split_sizes(split_abt(spark, folder)), "positive_rate")


@query("p11_numeric_coercion", oracle("""
SELECT c19 AS loan_id, TRY_CAST(c11 AS DOUBLE) AS ltv, TRY_CAST(c9 AS DOUBLE) AS dti FROM acq_raw""", "acq_raw"))
def _(spark, folder):
    return view(spark, folder, "acq_raw").select(
        F.col("c19").alias("loan_id"), numeric.parse_double("c11").alias("ltv"), numeric.to_double("c9").alias("dti"))


@query("p12_clip", oracle("SELECT loan_id, fico, ltv, cltv, dti FROM clean", "abt", clean=_CLEAN))
def _(spark, folder):
    df = features.clip_features(features.coerce_numbers(abt(spark, folder)))
    return df.select("loan_id", "fico", "ltv", "cltv", "dti")


_DER = ["fico_gap", "ltv_80", "ltv_90", "dti_43", "int_fico_gap_x_ltv", "int_dti_x_ltv"]


@query("p13_derived_features", oracle(f"SELECT loan_id, {', '.join(_DER)} FROM d", "abt", clean=_CLEAN, d=_DERIVED))
def _(spark, folder):
    df = features.derive(features.clip_features(features.coerce_numbers(abt(spark, folder))))
    return df.select("loan_id", *_DER)


@query("a12_group_median", oracle("""
SELECT vintage_q, ROUND(quantile_cont(orig_rate, 0.5), 6) AS median FROM abt GROUP BY 1""", "abt"))
def _(spark, folder):
    return rounded(features.group_medians(abt(spark, folder), "orig_rate", "vintage_q"), "median")


@query("w2_spread_to_group_median", oracle("""
SELECT loan_id, ROUND(orig_rate - m, 6) AS rate_spread_vintage FROM abt JOIN (
  SELECT vintage_q, quantile_cont(orig_rate, 0.5) AS m FROM abt GROUP BY 1) USING (vintage_q)""", "abt"))
def _(spark, folder):
    df = features.spread_to_group(abt(spark, folder))
    return rounded(df.select("loan_id", "rate_spread_vintage"), "rate_spread_vintage")


@query("a11_feature_medians", oracle(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median FROM s WHERE split = 'train'"
    for c in _NUMERIC), "abt", s=_S))
def _(spark, folder):
    train = split_abt(spark, folder).filter("split = 'train'")
    return rounded(features.feature_medians(train, _NUMERIC), "median")


_TE = " UNION ALL ".join(f"""
SELECT '{c}' AS feature, {c} AS category, (AVG({BAD_INT}) * COUNT(*) + 100.0E0 * g) / (COUNT(*) + 100.0E0) AS encoded
FROM s, (SELECT AVG({BAD_INT}) AS g FROM s WHERE split = 'train') WHERE split = 'train' GROUP BY {c}, g""" for c in features.ENCODED)


@query("a13_target_means", oracle("SELECT feature, category, ROUND(encoded, 6) AS encoded FROM te", "abt", s=_S, te=_TE))
def _(spark, folder):
    train = split_abt(spark, folder).filter("split = 'train'")
    return rounded(features.fit_target_means(train).table, "encoded")


@query("j10_encoded_categories", oracle("""
SELECT s.loan_id, ROUND(COALESCE(a.encoded, g), 6) AS state_te, ROUND(COALESCE(b.encoded, g), 6) AS channel_te,
       ROUND(COALESCE(c.encoded, g), 6) AS purpose_te
FROM s LEFT JOIN te a ON a.feature = 'state' AND a.category = s.state LEFT JOIN te b ON b.feature = 'channel' AND b.category = s.channel
LEFT JOIN te c ON c.feature = 'purpose' AND c.category = s.purpose,
(SELECT AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END) AS g FROM s WHERE split = 'train')""", "abt", s=_S, te=_TE))
def _(spark, folder):
    df = split_abt(spark, folder)
    encoded = features.fit_target_means(df.filter("split = 'train'")).transform(df)
    return rounded(encoded.select("loan_id", "state_te", "channel_te", "purpose_te"), "state_te", "channel_te", "purpose_te")


@query("c5_features_and_splits", oracle(f"""
SELECT loan_id, split, vintage_q, state, channel, purpose, default_within_24m, fico, ROUND(orig_upb, 2) AS orig_upb, ROUND(orig_rate, 6) AS orig_rate,
       ltv, cltv, dti, msa, loan_term, num_units, {', '.join(_DER)}, ROUND(rate_spread_vintage, 6) AS rate_spread_vintage,
       ROUND(COALESCE(a.encoded, g), 6) AS state_te, ROUND(COALESCE(b.encoded, g), 6) AS channel_te, ROUND(COALESCE(c.encoded, g), 6) AS purpose_te
FROM d LEFT JOIN te a ON a.feature = 'state' AND a.category = d.state LEFT JOIN te b ON b.feature = 'channel' AND b.category = d.channel
LEFT JOIN te c ON c.feature = 'purpose' AND c.category = d.purpose,
(SELECT AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END) AS g FROM s WHERE split = 'train')""",
    "abt", clean=_CLEAN, d=_DERIVED, s=_S, te=_TE))
def _(spark, folder):
    df = features.build_features(abt(spark, folder), SPLIT_YEARS)
    df = rounded(df, "orig_rate", "rate_spread_vintage", "state_te", "channel_te", "purpose_te")
    return rounded(df, "orig_upb", digits=2)


@query("p17_feature_selection", oracle("""
SELECT UNNEST(['fico', 'orig_upb', 'orig_rate', 'ltv', 'cltv', 'dti', 'msa', 'loan_term', 'num_units']) AS feature,
       (SELECT COUNT(*) FROM abt) AS n""", "abt"))
def _(spark, folder):
    df = abt(spark, folder)
    names = columns.numeric_features(df)
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in names]))
                     ).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))


@query("p18_schema_conformance", oracle("""
SELECT loan_id, CAST(ltv AS DOUBLE) AS ltv, CAST(NULL AS DOUBLE) AS not_there, CAST(fico AS DOUBLE) AS fico FROM abt""", "abt"))
def _(spark, folder):
    return columns.conform(abt(spark, folder), ["ltv", "not_there", "fico"], keep=["loan_id"])


@query("p19_impute", oracle("""
SELECT loan_id, CAST(fico AS DOUBLE) AS fico, COALESCE(dti, (SELECT quantile_cont(dti, 0.5) FROM s WHERE split = 'train')) AS dti,
       0.0E0 AS not_there FROM abt""", "abt", s=_S))
def _(spark, folder):
    df = split_abt(spark, folder)
    medians = features.median_values(df.filter("split = 'train'"), ["fico", "dti"])
    names = ["fico", "dti", "not_there"]
    return columns.impute(columns.conform(df, names, keep=["loan_id"]), names, medians)


@query("p34_class_weight", oracle("""
SELECT ROUND(COUNT(CASE WHEN NOT default_within_24m THEN 1 END) / CAST(COUNT(CASE WHEN default_within_24m THEN 1 END) AS DOUBLE), 6) AS negatives_per_positive,
  ROUND((1 - r) / r, 6) AS odds_weight, ROUND(COUNT(*) / (2.0E0 * COUNT(CASE WHEN default_within_24m THEN 1 END)), 6) AS balanced_positive,
  ROUND(COUNT(*) / (2.0E0 * COUNT(CASE WHEN NOT default_within_24m THEN 1 END)), 6) AS balanced_negative
FROM abt, (SELECT AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END) AS r FROM abt) GROUP BY r""", "abt"))
def _(spark, folder):
    from vintagemill.operators import training
    weights = training.class_weights(abt(spark, folder))
    return rounded(weights, *weights.columns)


# --- macro

_ORIG = "strftime(a.first_payment_date - INTERVAL 1 MONTH, '%Y-%m')"
_HPI = ("SELECT state, strftime(month, '%Y-%m') AS m, hpi_index, "
        "hpi_index / LAG(hpi_index, 12) OVER (PARTITION BY state ORDER BY month) - 1 AS chg FROM macro_hpi")


def macro_frames(spark, folder):
    """Unemployment, house prices and mortgage rates, written once like the files they stand for."""

    def series(name, *values):
        return dataset(spark, folder, name, lambda s, f: view(s, f, name).withColumn("date", dates.month_key("month"))).select(
            "date", *values)

    return (series("macro_unemp", "state", "unemp_rate"), series("macro_hpi", "state", "hpi_index"),
            series("macro_rate", "pmms_30y"))


@query("p8_origination_month", oracle(f"SELECT loan_id, {_ORIG} AS orig_month FROM abt a", "abt"))
def _(spark, folder):
    return macro.origination_month(abt(spark, folder)).select("loan_id", "orig_month")


@query("w1_house_price_change", oracle("SELECT state, m AS month, ROUND(chg, 6) AS hpi_12m_chg FROM hpi", "macro_hpi", hpi=_HPI))
def _(spark, folder):
    changed = macro.yearly_change(view(spark, folder, "macro_hpi"), date="month")
    return rounded(changed.select("state", dates.month_key("month").alias("month"), "hpi_12m_chg"), "hpi_12m_chg")


@query("w1_house_price_change_by_calendar", oracle("""
SELECT a.state, strftime(a.month, '%Y-%m') AS month, ROUND(a.unemp_rate / b.unemp_rate - 1, 6) AS chg FROM macro_unemp a
LEFT JOIN macro_unemp b ON a.state = b.state AND a.month = b.month + INTERVAL 12 MONTH""", "macro_unemp"))
def _(spark, folder):
    un = view(spark, folder, "macro_unemp")
    changed = macro.yearly_change(un, value="unemp_rate", date="month", calendar=True, out="chg")
    return rounded(changed.select("state", dates.month_key("month").alias("month"), "chg"), "chg")


@query("j2_unemployment", oracle(f"""
SELECT a.loan_id, u.unemp_rate FROM abt a LEFT JOIN macro_unemp u ON a.state = u.state AND {_ORIG} = strftime(u.month, '%Y-%m')""",
    "abt", "macro_unemp"))
def _(spark, folder):
    return macro.with_macro(abt(spark, folder), unemployment=macro_frames(spark, folder)[0]).select("loan_id", "unemp_rate")


@query("j3_house_prices", oracle(f"""
SELECT a.loan_id, h.hpi_index, ROUND(h.chg, 6) AS hpi_12m_chg FROM abt a LEFT JOIN hpi h ON a.state = h.state AND {_ORIG} = h.m""",
    "abt", "macro_hpi", hpi=_HPI))
def _(spark, folder):
    df = macro.with_macro(abt(spark, folder), hpi=macro_frames(spark, folder)[1])
    return rounded(df.select("loan_id", "hpi_index", "hpi_12m_chg"), "hpi_12m_chg")


@query("j4_mortgage_rate", oracle(f"""
SELECT a.loan_id, r.pmms_30y FROM abt a LEFT JOIN macro_rate r ON {_ORIG} = strftime(r.month, '%Y-%m')""", "abt", "macro_rate"))
def _(spark, folder):
    return macro.with_macro(abt(spark, folder), mortgage_rate=macro_frames(spark, folder)[2]).select("loan_id", "pmms_30y")


@query("p14_rate_spread", oracle(f"""
SELECT a.loan_id, ROUND(a.orig_rate - r.pmms_30y, 6) AS rate_spread FROM abt a LEFT JOIN macro_rate r
ON {_ORIG} = strftime(r.month, '%Y-%m')""", "abt", "macro_rate"))
def _(spark, folder):
    df = macro.with_macro(abt(spark, folder), mortgage_rate=macro_frames(spark, folder)[2])
    return rounded(df.select("loan_id", "rate_spread"), "rate_spread")


@query("c4_macro_features", oracle(f"""
SELECT a.loan_id, {_ORIG} AS orig_month, u.unemp_rate, h.hpi_index, ROUND(h.chg, 6) AS hpi_12m_chg, r.pmms_30y,
       ROUND(a.orig_rate - r.pmms_30y, 6) AS rate_spread
FROM abt a LEFT JOIN macro_unemp u ON a.state = u.state AND {_ORIG} = strftime(u.month, '%Y-%m')
LEFT JOIN hpi h ON a.state = h.state AND {_ORIG} = h.m LEFT JOIN macro_rate r ON {_ORIG} = strftime(r.month, '%Y-%m')""",
    "abt", "macro_unemp", "macro_hpi", "macro_rate", hpi=_HPI))
def _(spark, folder):
    df = macro.with_macro(abt(spark, folder), *macro_frames(spark, folder))
    names = ["loan_id", "orig_month", "unemp_rate", "hpi_index", "hpi_12m_chg", "pmms_30y", "rate_spread"]
    return rounded(df.select(*names), "hpi_12m_chg", "rate_spread")


@query("s9_report_scan", oracle("SELECT strftime(month, '%Y-%m') AS date, state, hpi_index FROM macro_hpi", "macro_hpi"))
def _(spark, folder):
    path = session.fresh_path(spark, "hpi")
    hpi = macro_frames(spark, folder)[1]
    shuffled = hpi.toDF(" Date", "State ", "HPI index").select("HPI index", "State ", " Date")
    tables.write_report(shuffled, path, single_file=False)
    assert tables.read_optional_report(spark, session.fresh_path(spark, "absent")) is None
    return tables.read_optional_report(spark, path, HPI_SCHEMA)


@query("a34_months_and_states", oracle("""
SELECT DISTINCT 'month' AS domain, strftime(first_payment_date, '%Y-%m') AS value FROM abt
UNION ALL SELECT DISTINCT 'state', state FROM abt""", "abt"))
def _(spark, folder):
    df = abt(spark, folder)
    months = macro.months_present(df).select(F.lit("month").alias("domain"), F.col("month").alias("value"))
    return months.unionByName(macro.states_present(df).select(F.lit("state").alias("domain"), F.col("state").alias("value")))


@query("j9_macro_gaps", oracle("""
SELECT s.state, m.date FROM (SELECT DISTINCT state FROM abt) s CROSS JOIN
  (SELECT DISTINCT strftime(first_payment_date, '%Y-%m') AS date FROM abt) m
LEFT JOIN (SELECT state, strftime(month, '%Y-%m') AS date, unemp_rate FROM macro_unemp) u ON u.state = s.state AND u.date = m.date
WHERE u.unemp_rate IS NULL""", "abt", "macro_unemp"))
def _(spark, folder):
    return macro.macro_gaps(abt(spark, folder), macro_frames(spark, folder)[0], "unemp_rate")


# --- joins on the loan key

def bare_preds(spark, folder):
    return preds(spark, folder).select(F.col("loan_id").alias("id"), "y_true", "y_pred")


@query("j5_slice_metadata", oracle("""
SELECT p.loan_id AS id, p.y_true, p.y_pred, a.vintage_q, a.state, a.channel, a.purpose FROM preds p LEFT JOIN abt a ON p.loan_id = a.loan_id""",
    "preds", "abt"))
def _(spark, folder):
    return joins.attach_slices(bare_preds(spark, folder), abt(spark, folder), SLICES, "id", "loan_id")


@query("j6_test_features", oracle(f"""
SELECT p.loan_id, p.y_pred, s.msa, s.product FROM preds p LEFT JOIN s ON p.loan_id = s.loan_id AND s.split = 'test'""",
    "preds", "abt", s=_S))
def _(spark, folder):
    test = split_abt(spark, folder).filter("split = 'test'")
    return joins.attach_slices(preds(spark, folder).select("loan_id", "y_pred"), test, ["msa", "product"])


@query("j7_slices_one_to_one", oracle("""
SELECT loan_id, y_pred, channel, purpose, state, msa, vintage_q FROM preds""", "preds"))
def _(spark, folder):
    slim = preds(spark, folder).select("loan_id", "y_pred")
    return joins.attach_slices_one_to_one(slim, abt(spark, folder), ["channel", "purpose", "state", "msa", "vintage_q"])


@query("j8_align_by_key", oracle("""
SELECT a.loan_id, a.vintage_q, a.msa, p.y_pred FROM abt a JOIN preds p ON a.loan_id = p.loan_id""", "abt", "preds"))
def _(spark, folder):
    left = abt(spark, folder).select("loan_id", "vintage_q", "msa")
    return joins.align_by_key(left, preds(spark, folder).select("loan_id", "msa", "y_pred"))


@query("j12_required_key", oracle("SELECT loan_id, y_pred FROM preds", "preds"))
def _(spark, folder):
    df = preds(spark, folder)
    joins.require_columns(df, ["loan_id"], "predictions")
    joins.require_unique(df, ["loan_id"], "predictions")
    return df.select("loan_id", "y_pred")


@query("p31_complete_rows", oracle("""
SELECT loan_id, dti, msa FROM abt WHERE dti IS NOT NULL AND msa IS NOT NULL""", "abt"))
def _(spark, folder):
    return ordered.keep_known(abt(spark, folder).select("loan_id", "dti", "msa"), ["dti", "msa"])


# --- stability and KPI history

@query("p33_stability_table", oracle("""
SELECT state, n, ROUND(bad_rate, 6) AS bad_rate, ROUND(mean_pd, 6) AS mean_pd,
       ROUND((mean_pd - MIN(mean_pd) OVER ()) / (MAX(mean_pd) OVER () - MIN(mean_pd) OVER ()), 6) AS mean_pd_norm,
       ROUND(1 - (bad_rate - MIN(bad_rate) OVER ()) / (MAX(bad_rate) OVER () - MIN(bad_rate) OVER ()), 6) AS bad_rate_norm
FROM (SELECT state, COUNT(*) AS n, AVG(CAST(y_true AS DOUBLE)) AS bad_rate, AVG(y_pred) AS mean_pd FROM preds GROUP BY 1)""", "preds"))
def _(spark, folder):
    report = preds(spark, folder).groupBy("state").agg(
        F.count(F.lit(1)).alias("n"), F.avg("y_true").alias("bad_rate"), F.avg("y_pred").alias("mean_pd"))
    scaled = monitoring.stability_table(report, rising=["mean_pd"], falling=["bad_rate"])
    return rounded(scaled, "bad_rate", "mean_pd", "mean_pd_norm", "bad_rate_norm")


_DAILY = """SELECT CAST(ts AS DATE) AS date, event_type, SUM(value) AS v, COUNT(*) AS n FROM events GROUP BY 1, 2"""


@query("w4_rolling_mean", oracle("""
SELECT event_type AS metric, date, ROUND(v, 4) AS value,
       ROUND(AVG(v) OVER (PARTITION BY event_type ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS smoothed FROM daily""",
    daily=_DAILY))
def _(spark, folder):
    daily = table(spark, folder, "events").groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("metric")).agg(
        F.sum("value").alias("value"))
    return rounded(monitoring.rolling_mean(daily), "value", "smoothed", digits=4)


@query("u5_kpi_history", oracle("""
SELECT vintage_q AS date, 'bad_rate' AS metric, ROUND(AVG(CAST(y_true AS DOUBLE)), 6) AS value FROM preds GROUP BY 1
UNION ALL SELECT vintage_q, 'approve_rate', ROUND(AVG(CASE WHEN y_pred <= 0.25 THEN 1.0E0 ELSE 0.0E0 END), 6) FROM preds GROUP BY 1""", "preds"))
def _(spark, folder):
    report = policy.backtest(preds(spark, folder), "y_pred", T, "y_true").withColumnRenamed("overall_bad_rate", "bad_rate")
    named = report.withColumn("vintage_q", F.concat(F.year("vintage_q"), F.lit("Q"), F.quarter("vintage_q")))
    path = session.fresh_path(spark, "kpi")
    tables.write_dataset(rounded(monitoring.kpi_history(named, "vintage_q"), "value"), path, ["metric"])
    return tables.read_dataset(spark, path)


@query("p9_vintage_parse", oracle("""
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 = 1 THEN CAST(date_trunc('quarter', o_orderdate) AS DATE)
  WHEN o_orderkey % 5 = 0 THEN CAST(o_orderdate AS DATE) ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END AS vintage,
  CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE CAST(year(o_orderdate) AS INT) END AS y FROM orders"""))
def _(spark, folder):
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    text = (F.when(k % 5 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 5 == 1, F.concat(F.year(d), F.lit("-Q"), F.quarter(d)))
            .when(k % 5 == 2, F.date_format(d, "yyyy-MM")).when(k % 5 == 3, F.date_format(d, "yyyy/M")).otherwise("unknown"))
    return table(spark, folder, "orders").select(
        k.alias("k"), dates.parse_vintage(text).alias("vintage"), dates.vintage_year(text).alias("y"))


# --- sampling

@query("u6_fixed_size_sample", oracle("""
SELECT l_orderkey, l_linenumber FROM lineitem
ORDER BY md5(concat(concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)), ':13')), l_orderkey LIMIT 20000"""))
def _(spark, folder):
    rows = table(spark, folder, "lineitem").withColumn(
        "line", F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return sampling.sample_rows(rows, 20_000, key="line").select("l_orderkey", "l_linenumber")


@query("u7_negative_downsampling", oracle(f"""
SELECT loan_id, split, default_within_24m FROM (
  SELECT *, row_number() OVER (PARTITION BY split, default_within_24m ORDER BY md5(concat(CAST(loan_id AS STRING), ':42')), loan_id) AS r,
         floor(0.5 * GREATEST(1, SUM({BAD_INT}) OVER (PARTITION BY split))) AS take FROM s WHERE split IN ('train', 'valid'))
WHERE default_within_24m OR r <= take""", "abt", s=_S))
def _(spark, folder):
    df = split_abt(spark, folder).filter("split in ('train', 'valid')").select("loan_id", "split", LABEL)
    return sampling.downsample_negatives(df, LABEL, 0.5, by=["split"])


# --- codes

_NAMES = {0: "Purchase", 1: "No cash-out refinance", 2: "Cash-out refinance", 3: "Something else"}


@query("p28_code_mapping", oracle("""
SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'N' WHEN 2 THEN 'C' END AS purpose,
  CASE WHEN o_orderkey % 4 = 0 THEN 1.0E0 ELSE 0.0E0 END AS "purpose_P", CASE WHEN o_orderkey % 4 = 2 THEN 1.0E0 ELSE 0.0E0 END AS "purpose_C"
FROM orders"""))
def _(spark, folder):
    k = F.col("o_orderkey")
    name = F.when(k % 4 == 0, _NAMES[0]).when(k % 4 == 1, _NAMES[1]).when(k % 4 == 2, _NAMES[2]).otherwise(_NAMES[3])
    named = table(spark, folder, "orders").select(k.alias("k"), codes.code_of(name, codes.PURPOSE_CODES).alias("purpose"))
    return named.select("k", "purpose", *codes.one_hot("purpose", "purpose", ["P", "C"]))


# --- calibration

def _newton_sql(steps: int = 9) -> dict[str, str]:
    """Newton's method for the two coefficients, one CTE per step."""
    ctes = {
        "pts": "SELECT ln(p / (1 - p)) AS x, y FROM (SELECT LEAST(GREATEST(y_pred, 1e-6), 1 - 1e-6) AS p, y_true AS y FROM preds WHERE year(vintage_q) = 1997)",
        "n0": "SELECT 0.0E0 AS a, 1.0E0 AS b",
    }
    for i in range(steps):
        ctes[f"s{i}"] = f"""SELECT a, b, SUM(y - p) AS g0, SUM((y - p) * x) AS g1, SUM(p * (1 - p)) AS h00, SUM(p * (1 - p) * x) AS h01,
          SUM(p * (1 - p) * x * x) AS h11 FROM (SELECT x, y, a, b, 1 / (1 + exp(-LEAST(GREATEST(a + b * x, -30), 30))) AS p FROM pts, n{i}) GROUP BY a, b"""
        ctes[f"n{i + 1}"] = f"""SELECT a + (h11 * g0 - h01 * g1) / (h00 * h11 - h01 * h01) AS a,
          b + (h00 * g1 - h01 * g0) / (h00 * h11 - h01 * h01) AS b FROM s{i}"""
    return ctes


def scaler(spark, folder) -> calibration.PlattScaler:
    valid = preds(spark, folder).filter(F.year("vintage_q") == 1997)
    return calibration.fit_platt(valid, "y_pred", "y_true")


@query("m11_platt_fit", oracle("SELECT ROUND(a, 5) AS a, ROUND(b, 5) AS b FROM n9", "preds", **_newton_sql()))
def _(spark, folder):
    fitted = scaler(spark, folder)
    return rounded(spark.range(1).select(F.lit(fitted.a).alias("a"), F.lit(fitted.b).alias("b")), "a", "b", digits=5)


_CAL = "1 / (1 + exp(-LEAST(GREATEST({a} + {b} * ln(q / (1 - q)), -30), 30)))"


@query("p25_platt_apply", oracle(f"""
SELECT loan_id, ROUND({_CAL.format(a='-1.25', b='1.03')}, 6) AS pd_cal, ROUND(1 / (1 + exp(1.25 - 1.03 * q)), 6) AS pd_linear, y_pred AS pd_same
FROM (SELECT *, LEAST(GREATEST(y_pred, 1e-6), 1 - 1e-6) AS q FROM preds)""", "preds"))
def _(spark, folder):
    df = preds(spark, folder).select(
        "loan_id", numeric.platt("y_pred", -1.25, 1.03).alias("pd_cal"),
        numeric.platt("y_pred", -1.25, 1.03, mode="linear").alias("pd_linear"),
        numeric.platt("y_pred", None, None).alias("pd_same"))
    return rounded(df, "pd_cal", "pd_linear")


@query("m12_calibration_effect", oracle(f"""
SELECT stage, CAST(SUM(pos + neg) AS BIGINT) AS n, {{AUC}}, (SELECT ROUND(AVG((y_true - y_pred) * (y_true - y_pred)), 4) FROM long l WHERE l.stage = c.stage) AS brier
FROM c GROUP BY stage""".replace("{AUC}", __import__("checks.scores", fromlist=["AUC"]).AUC), "preds", **_newton_sql(),
    long=f"""SELECT 'before' AS stage, y_true, LEAST(GREATEST(y_pred, 1e-6), 1 - 1e-6) AS y_pred FROM preds
      UNION ALL SELECT 'after', y_true, ROUND({_CAL.format(a='a', b='b')}, 12)
      FROM (SELECT *, LEAST(GREATEST(y_pred, 1e-6), 1 - 1e-6) AS q FROM preds), n9""",
    **__import__("checks.scores", fromlist=["ranked"]).ranked("stage", "long")))
def _(spark, folder):
    effect = calibration.calibration_effect(preds(spark, folder), "y_pred", "y_true", scaler(spark, folder))
    return rounded(rounded(effect, "auc"), "brier", digits=4)


# --- documents

@query("s13_document_round_trip", oracle("SELECT ROUND(a, 5) AS a, ROUND(b, 5) AS b FROM n9", "preds", **_newton_sql()))
def _(spark, folder):
    path = session.fresh_path(spark, "scaler")
    fitted = scaler(spark, folder)
    documents.write_document(spark.range(1).select(F.lit(fitted.a).alias("a"), F.lit(fitted.b).alias("b")), path)
    return rounded(documents.read_document(spark, path, PLATT_SCHEMA), "a", "b", digits=5)


@query("s14_policy_record_update", oracle(f"""
SELECT ROUND(quantile_cont(y_pred, 0.22), 6) AS threshold, 'quantile' AS metric, 'y_pred' AS prob,
       ROUND(AVG(CASE WHEN y_pred <= t THEN 1.0E0 ELSE 0.0E0 END), 6) AS approve_rate_recent,
       ROUND(AVG(CASE WHEN y_pred <= t THEN y_pred END), 6) AS expected_bad_rate_on_approved
FROM preds, (SELECT quantile_cont(y_pred, 0.22) AS t FROM preds) GROUP BY t""", "preds"))
def _(spark, folder):
    df = preds(spark, folder)
    chosen = policy.threshold_for_approval(df, "y_pred", 0.22).first()
    record = documents.policy_record(spark, {"threshold": chosen["threshold"], "metric": "quantile", "prob": "y_pred"})
    path = session.fresh_path(spark, "policy")
    documents.write_document(record, path)
    from vintagemill.schemas import POLICY_SCHEMA
    stored = documents.read_document(spark, path, POLICY_SCHEMA)
    seen = policy.approved_outcome(df, "y_pred", chosen["threshold"]).first()
    updated = documents.update_policy(stored, {
        "approve_rate_recent": seen["approve_rate"], "expected_bad_rate_on_approved": seen["expected_bad_rate_on_approved"]})
    return rounded(updated, "threshold", "approve_rate_recent", "expected_bad_rate_on_approved")
