"""Jobs a user calls: each reads datasets, runs operators and writes datasets.

Outputs never overwrite: a job given a path that exists fails, so a re-run names a
new folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintagemill.functions import numeric
from vintagemill.operators import (
    audit,
    calibration,
    columns,
    drift,
    features,
    joins,
    loans,
    macro,
    monitoring,
    policy,
    ranking,
    sampling,
    scoring,
    summaries,
    training,
)
from vintagemill.schemas import (
    ABT_COLUMNS,
    ACQ_WIDTH,
    HPI_SCHEMA,
    LABEL,
    MORTGAGE_RATE_SCHEMA,
    PERF_WIDTH,
    PLATT_SCHEMA,
    POLICY_SCHEMA,
    UNEMPLOYMENT_SCHEMA,
)
from vintagemill.sources import documents, raw, tables

SAMPLE_ROWS = 5_000
SLICES = ("vintage_q", "state", "channel", "purpose")
SHARE_SLICES = ("channel", "purpose", "state", "msa", "vintage_q")
EXPORT_COLUMNS = ("loan_id", "vintage_q", "state", "channel", "purpose", "y_true")


def build_loans(
    spark: SparkSession,
    acq_folder: str,
    perf_folder: str,
    out: str,
    years: Sequence[str] | None = None,
    sep: str = "|",
    sample_out: str | None = None,
) -> DataFrame:
    """Raw files to labelled loans, written by vintage; returns volume and bad rate."""
    acq = raw.project_acquisition(raw.scan_folder(spark, acq_folder, ACQ_WIDTH, sep, years))
    perf = raw.project_performance(raw.scan_folder(spark, perf_folder, PERF_WIDTH, sep, years))
    tables.write_dataset(loans.label_loans(acq, perf).select(*ABT_COLUMNS), out, ["vintage_q"])
    written = tables.read_dataset(spark, out).select(*ABT_COLUMNS)
    if sample_out:
        tables.write_dataset(sampling.sample_rows(written, SAMPLE_ROWS), sample_out)
    return summaries.volume_and_bad_rate(written)


def combine_loans(spark: SparkSession, paths: Sequence[str], out: str) -> DataFrame:
    """Append yearly datasets into one; returns the vintage table."""
    tables.write_dataset(tables.read_union(spark, paths), out, ["vintage_q"])
    return summaries.by_vintage(tables.read_dataset(spark, out))


def audit_loans(spark: SparkSession, abt_path: str, out: str) -> None:
    """Header document, missing values, outlier flags and top category values."""
    abt = tables.read_dataset(spark, abt_path)
    documents.write_document(audit.audit_header(abt), f"{out}/audit_header")
    tables.write_report(audit.missing_values(abt), f"{out}/missing")
    tables.write_report(audit.outlier_flags(abt), f"{out}/outlier_flags")
    tables.write_report(audit.top_values(abt).orderBy("col", "rank"), f"{out}/top_values")


def add_macro(
    spark: SparkSession, abt_path: str, out: str, unemployment: str | None = None, hpi: str | None = None,
    mortgage_rate: str | None = None,
) -> None:
    """Loans with macro columns; a series whose file is missing is left out."""

    def optional(path, schema):
        return tables.read_optional_report(spark, path, schema) if path else None

    plus = macro.with_macro(
        tables.read_dataset(spark, abt_path), optional(unemployment, UNEMPLOYMENT_SCHEMA),
        optional(hpi, HPI_SCHEMA), optional(mortgage_rate, MORTGAGE_RATE_SCHEMA))
    tables.write_dataset(plus, out)


def build_splits(
    spark: SparkSession, abt_path: str, out: str, medians_out: str,
    years: Mapping[str, tuple[int | None, int | None]] = features.SPLIT_YEARS,
) -> DataFrame:
    """Feature table by split, and the training medians; returns split sizes."""
    table = features.build_features(tables.read_dataset(spark, abt_path), years)
    tables.write_dataset(table, out, ["split"])
    written = tables.read_dataset(spark, out)
    train = written.filter(F.col("split") == "train")
    medians = features.feature_medians(train, features.columns.numeric_features(train))
    documents.write_document(documents.map_document(medians, "feature", "median", "medians"), medians_out)
    return summaries.split_sizes(written)


def split_of(spark: SparkSession, features_path: str, name: str) -> DataFrame:
    """One split: a partition of the feature table."""
    return tables.read_dataset(spark, features_path, where=F.col("split") == name)


def train_trees(
    spark: SparkSession, features_path: str, out: str, numeric_columns: Sequence[str] | None = None, **params
) -> DataFrame:
    """Fit on train/valid, save model, metrics, importance and predictions under one
    run folder; returns the metrics."""
    train, valid, test = (split_of(spark, features_path, s) for s in ("train", "valid", "test"))
    model = training.fit_boosted_trees(train, valid, numeric_columns, **params)
    _save_run(spark, model, {"valid": valid, "test": test}, out)
    metrics = ranking.evaluate(tables.read_dataset(spark, f"{out}/test_predictions"), "y_pred", "y_true")
    documents.write_document(metrics, f"{out}/metrics")
    tables.write_report(training.feature_importance(model), f"{out}/feature_importance")
    return spark.read.schema(metrics.schema).json(f"{out}/metrics")


def _save_run(spark: SparkSession, model: training.CreditModel, splits: Mapping[str, DataFrame], out: str) -> None:
    """A model and its predictions of each split."""
    model.save(spark, f"{out}/model")
    for name, rows in splits.items():
        carried = [c for c in SLICES if c != "vintage_q" and c in rows.columns]
        tables.write_dataset(training.predictions(model, rows, keys=["loan_id", "vintage_q", *carried]), f"{out}/{name}_predictions")


def _run_metrics(spark: SparkSession, runs: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """(model, split, metrics...) of stored predictions."""
    parts = None
    for model, path in runs.items():
        for name in names:
            row = ranking.evaluate(tables.read_dataset(spark, f"{path}/{name}_predictions"), "y_pred", "y_true")
            row = row.select(F.lit(model).alias("model"), F.lit(name).alias("split"), *row.columns)
            parts = row if parts is None else parts.unionByName(row)
    return parts


def train_baseline(
    spark: SparkSession, features_path: str, out: str, numeric_columns: Sequence[str] | None = None,
    negatives_per_positive: float = 10.0, seed: int = 42, **params,
) -> DataFrame:
    """Logistic and boosted baselines side by side; returns their metrics on valid and test.

    Negatives of train and valid are downsampled, those of test never are.  Models,
    predictions, metrics and importance are written under ``out``.
    """
    train, valid, test = (split_of(spark, features_path, s) for s in ("train", "valid", "test"))
    fewer = []
    for name, rows in (("train", train), ("valid", valid)):
        tables.write_dataset(sampling.downsample_negatives(rows, LABEL, negatives_per_positive, seed=seed), f"{out}/{name}_sample")
        fewer.append(tables.read_dataset(spark, f"{out}/{name}_sample"))
    runs = {"logistic": f"{out}/logistic", "trees": f"{out}/trees"}
    logistic = training.fit_logistic(fewer[0], *([numeric_columns] if numeric_columns else []))
    trees = training.fit_boosted_trees(*fewer, numeric_columns, **params)
    for name, model in (("logistic", logistic), ("trees", trees)):
        _save_run(spark, model, {"valid": fewer[1], "test": test}, runs[name])
    tables.write_report(training.feature_importance(trees), f"{out}/feature_importance")
    metrics = _run_metrics(spark, runs, ["valid", "test"])
    tables.write_report(metrics, f"{out}/metrics")
    return tables.read_report(spark, f"{out}/metrics", metrics.schema)


def train_tuned(
    spark: SparkSession, features_path: str, out: str, numeric_columns: Sequence[str] | None = None, draws: int = 30,
    seed: int = 42, drop: Sequence[str] = ("msa",), **fixed,
) -> DataFrame:
    """Random search; the best model, its metrics, importance and predictions, and all draws are written.

    ``drop`` names numeric columns the tuned model does without.  Returns its metrics on valid and test.
    """
    train, valid, test = (split_of(spark, features_path, s) for s in ("train", "valid", "test"))
    names = [c for c in numeric_columns or columns.numeric_features(train) if c not in drop]
    model, log = training.random_search(train, valid, draws, seed, numeric=names, **fixed)
    _save_run(spark, model, {"valid": valid, "test": test}, out)
    tables.write_report(log, f"{out}/draws")
    tables.write_report(training.feature_importance(model), f"{out}/feature_importance")
    metrics = _run_metrics(spark, {"tuned": out}, ["valid", "test"])
    tables.write_report(metrics, f"{out}/metrics")
    return tables.read_report(spark, f"{out}/metrics", metrics.schema)


def score_with_tree_file(
    spark: SparkSession, model_file: str, features_path: str, out: str, split: str = "recent", train_split: str = "train"
) -> DataFrame:
    """Raw probabilities of a split from a stored boosted-tree text file; gaps take the training medians."""
    model = scoring.read_tree_file(spark, model_file)
    medians = features.median_values(split_of(spark, features_path, train_split), model.features)
    scored = scoring.score_cohort(split_of(spark, features_path, split), model, medians, ("loan_id", "msa", *SLICES))
    tables.write_dataset(scored, out)
    return tables.read_dataset(spark, out)


def score_recent(spark: SparkSession, run: str, features_path: str, out: str) -> None:
    """Raw probabilities of the recent split from a saved model."""
    model = training.CreditModel.load(spark, f"{run}/model")
    recent = split_of(spark, features_path, "recent")
    keys = ["loan_id", "msa", *SLICES]
    tables.write_dataset(model.score(recent, keys, out="pd_raw"), out)


def calibrate(spark: SparkSession, run: str, out: str, recent: str | None = None) -> DataFrame:
    """Fit the scaler on validation predictions; write it, and calibrated tables.

    Returns quality before and after on the test predictions.
    """
    valid = tables.read_dataset(spark, f"{run}/valid_predictions")
    scaler = calibration.fit_platt(valid, "y_pred", "y_true")
    record = spark.range(1).select(F.lit(scaler.a).alias("a"), F.lit(scaler.b).alias("b"))
    documents.write_document(record, f"{out}/platt_scaler")
    test = tables.read_dataset(spark, f"{run}/test_predictions")
    for name, rows, score in (("valid", valid, "y_pred"), ("test", test, "y_pred")):
        tables.write_dataset(scaler.transform(rows, score), f"{out}/{name}_calibrated")
    if recent:
        rows = scaler.transform(tables.read_dataset(spark, recent), "pd_raw")
        tables.write_dataset(rows, f"{out}/recent_calibrated")
    return calibration.calibration_effect(test, "y_pred", "y_true", scaler)


def apply_scaler(spark: SparkSession, scaler_path: str, preds_path: str, out: str, score: str = "pd_raw") -> None:
    """Calibrate a prediction table with a stored scaler."""
    row = documents.read_document(spark, scaler_path, PLATT_SCHEMA).first()
    scaled = tables.read_dataset(spark, preds_path).withColumn("pd_cal", numeric.platt(score, row["a"], row["b"]))
    tables.write_dataset(scaled, out)


def choose_policy(
    spark: SparkSession, preds_path: str, out: str, score: str = "pd_cal", label: str = "y_true", metric: str = "f1",
    grid: str | None = None, span: float = 0.06,
) -> DataFrame:
    """Curve, tidy extracts around the choice and the policy record (with its score column)."""
    preds = tables.read_dataset(spark, preds_path)
    curve = policy.policy_curve(preds, score, label, policy.parse_grid(grid))
    tables.write_report(curve, f"{out}/policy_curve")
    stored = tables.read_report(spark, f"{out}/policy_curve", curve.schema)
    t = policy.best_threshold(stored, metric).first()["threshold"]
    record = documents.policy_record(spark, {"threshold": t, "metric": metric, "prob": score})
    documents.write_document(record, f"{out}/policy_choice")
    near = policy.near_threshold(stored, t, span)
    tables.write_report(near, f"{out}/curve_wide")
    tables.write_report(policy.curve_long(near), f"{out}/curve_long")
    tables.write_report(near.select("threshold", "approve_rate"), f"{out}/curve_approve")
    tables.write_report(policy.nearest_row(stored, t), f"{out}/snapshot")
    return record


def policy_threshold(spark: SparkSession, policy_path: str, score: str) -> float:
    """Threshold of a stored policy; it must have been chosen on the same score column."""
    record = documents.read_document(spark, policy_path, POLICY_SCHEMA).first()
    if record is None or record["threshold"] is None:
        raise ValueError(f"no threshold in {policy_path}")
    if record["prob"] != score:
        raise ValueError(f"policy was chosen on {record['prob']!r}, not on {score!r}")
    return record["threshold"]


def set_policy_by_approval(spark: SparkSession, preds_path: str, out: str, target: float, score: str = "pd_cal") -> DataFrame:
    """Policy record for a target approve rate, with the rates it leads to."""
    preds = tables.read_dataset(spark, preds_path)
    chosen = policy.threshold_for_approval(preds, score, target).first()
    outcome = policy.approved_outcome(preds, score, chosen["threshold"]).first()
    record = documents.policy_record(spark, {
        "threshold": chosen["threshold"], "metric": "approval_target", "prob": score,
        "approve_rate_recent": outcome["approve_rate"],
        "expected_bad_rate_on_approved": outcome["expected_bad_rate_on_approved"],
    })
    documents.write_document(record, out)
    return record


def revise_policy(
    spark: SparkSession, history: str, preds_path: str, target: float | None = None, score: str = "pd_cal"
) -> DataFrame:
    """Next version of the stored policy: the threshold for an approve rate, if given, and the rates it has on these predictions.

    The version is worked out from the last one; when another writer was faster, nothing is stored and this fails.
    """
    base = max(documents.policy_versions(spark, history), default=0)
    stored = documents.read_policy(spark, history, base).first() if base else None
    if stored is None and target is None:
        raise ValueError(f"no policy in {history}, and no approve rate to choose one by")
    if stored is not None and stored["prob"] != score:
        raise ValueError(f"policy was chosen on {stored['prob']!r}, not on {score!r}")
    preds = tables.read_dataset(spark, preds_path)
    changes: dict[str, object] = {"threshold": stored["threshold"] if stored else None}
    if target is not None:
        changes["threshold"] = policy.threshold_for_approval(preds, score, target).first()["threshold"]
        changes |= {"metric": "approval_target", "prob": score}
    outcome = policy.approved_outcome(preds, score, changes["threshold"]).first()
    if outcome["approve_rate"] is None:
        raise ValueError(f"no predictions in {preds_path}")
    changes |= {"approve_rate_recent": outcome["approve_rate"],
                "expected_bad_rate_on_approved": outcome["expected_bad_rate_on_approved"]}
    return documents.read_policy(spark, history, documents.append_policy(spark, history, changes, base))


def run_backtest(
    spark: SparkSession, abt_path: str, preds_path: str, policy_path: str, out: str, score: str = "pd_cal"
) -> DataFrame:
    """Stored policy on a later cohort: approval and observed bad rate by vintage.

    A cohort without a vintage is one row; without labels the bad rates are NULL.
    """
    t = policy_threshold(spark, policy_path, score)
    preds = tables.read_dataset(spark, preds_path).select("loan_id", score)
    cohort = tables.read_dataset(spark, abt_path)
    absent = {c: F.lit(None).cast(kind) for c, kind in (("vintage_q", "date"), (LABEL, "int")) if c not in cohort.columns}
    cohort = cohort.withColumns(absent).select("loan_id", "vintage_q", LABEL)
    table = policy.backtest(joins.align_by_key(preds, cohort), score, t, LABEL).orderBy("vintage_q")
    tables.write_report(table, out)
    return tables.read_report(spark, out, table.schema)


def slice_reports(
    spark: SparkSession, preds_path: str, abt_path: str, out: str, t: float, score: str = "y_pred", label: str = "y_true"
) -> None:
    """Quality and policy metrics by slice, those of the largest states, approved share, stability, KPI history, and a manifest."""
    preds = tables.read_dataset(spark, preds_path)
    loans_ = tables.read_dataset(spark, abt_path)
    df = joins.attach_slices(preds, loans_, [*SLICES, "msa"])
    quality = ranking.evaluate_slices(df, SLICES, score, label)
    tables.write_dataset(quality, f"{out}/slice_metrics", ["slice"])
    stored = tables.read_dataset(spark, f"{out}/slice_metrics")
    tables.write_dataset(policy.policy_by_slice(df, SLICES, score, label, t), f"{out}/policy_metrics", ["slice"])
    largest = policy.in_largest_groups(df, "state", 20).groupBy("state").agg(*policy.policy_aggregates(score, label, t))
    tables.write_report(largest.orderBy("approve_rate", "state"), f"{out}/policy_state_top20")
    share = policy.approved_share(df, SHARE_SLICES, score, t)
    tables.write_dataset(share, f"{out}/approved_share")
    states = stored.filter(F.col("slice") == "state").orderBy(F.desc("n"), "value").limit(20)
    tables.write_report(states, f"{out}/state_top20")
    tables.write_report(
        monitoring.stability_table(stored.filter(F.col("slice") != "vintage_q"), by=["slice"]), f"{out}/stability")
    history = monitoring.kpi_history(stored.filter(F.col("slice") == "vintage_q"), "value")
    tables.write_dataset(monitoring.rolling_mean(history), f"{out}/kpi_history", ["metric"])
    # each row has one value of a slice, so any slice counts all rows
    joined = stored.filter(F.col("slice") == SLICES[0]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows_joined"))
    documents.write_document(joined.select(
        F.lit(preds_path).alias("preds"), F.lit(abt_path).alias("abt"), F.lit("loan_id").alias("id_col"),
        F.array(*map(F.lit, SLICES)).alias("used_slices"), "n_rows_joined"), f"{out}/manifest")


def explore(
    spark: SparkSession, abt_path: str, out: str,
    years: Mapping[str, tuple[int | None, int | None]] = features.SPLIT_YEARS,
) -> None:
    """Volume and bad-rate tables, bins, histograms, drift and gaps."""
    abt = tables.read_dataset(spark, abt_path)
    tables.write_report(summaries.by_vintage(abt), f"{out}/vintage")
    tables.write_report(summaries.largest_groups(abt, "state", 25), f"{out}/states")
    tables.write_report(summaries.by_pair(abt, "channel", "purpose"), f"{out}/channel_purpose")
    for feature in ("fico", "ltv", "dti"):
        tables.write_report(summaries.by_labelled_bin(abt, feature), f"{out}/bins_{feature}")
        tables.write_report(summaries.by_interval(abt, feature), f"{out}/intervals_{feature}")
    placed = features.with_split(abt, years)
    train, test = placed.filter(F.col("split") == "train"), placed.filter(F.col("split") == "test")
    tables.write_report(drift.histograms(train), f"{out}/histograms")
    tables.write_report(drift.stability_index(train, test), f"{out}/psi")
    tables.write_report(audit.most_missing(abt), f"{out}/missing_top")
    tables.write_report(audit.outlier_flags(abt), f"{out}/outlier_flags")


def export_decisions(
    spark: SparkSession, preds: Mapping[str, str], reports: Mapping[str, str], policy_path: str, out: str, score: str = "pd_cal"
) -> None:
    """Per-row decisions of each prediction table, copies of report tables, summary.

    Decision tables have one row per loan and are written by as many tasks as they
    have partitions.
    """
    t = policy_threshold(spark, policy_path, score)
    for name, path in preds.items():
        rows = policy.decisions(tables.read_dataset(spark, path), score, t, EXPORT_COLUMNS)
        tables.write_report(rows, f"{out}/{name}", single_file=False)
    for name, path in reports.items():
        tables.write_report(spark.read.option("header", True).csv(path), f"{out}/{name}")
    documents.write_document(documents.read_document(spark, policy_path, POLICY_SCHEMA), f"{out}/summary")
