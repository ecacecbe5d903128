"""Ordered operators, metrics, policy, drift and calibration against brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintagemill.functions import numeric
from vintagemill.operators import calibration, drift, monitoring, ordered, policy, ranking


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(7)
    n = 4_000
    y = (rng.random(n) < 0.2).astype(int)
    p = np.round(np.clip(rng.normal(0.3 + 0.15 * y, 0.15), 0, 1), 2)  # many ties
    p[: n // 3] = 0.3  # one score holds a third of the rows
    return pd.DataFrame({"loan_id": range(n), "y_true": y, "y_pred": p, "slice": np.where(np.arange(n) % 5 == 0, "a", "b")})


@pytest.fixture(scope="module")
def scored(spark, sample):
    return spark.createDataFrame(sample).repartition(6).persist()


def brute_metrics(y, p):
    pos, neg = p[y == 1], p[y == 0]
    values = np.unique(p)
    cp = np.array([(pos <= v).mean() for v in values])
    cn = np.array([(neg <= v).mean() for v in values])
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    precision = np.array([y[p >= v].mean() for v in values])
    share = np.array([(pos == v).mean() for v in values])
    return auc, (share * precision).sum(), np.abs(cp - cn).max(), max(0.0, (cn - cp).max())


def test_metrics_match_brute_force(scored, sample):
    y, p = sample.y_true.to_numpy(), sample.y_pred.to_numpy()
    auc, ap, ks, one_sided = brute_metrics(y, p)
    row = ranking.evaluate(scored).first()
    assert (row["auc"], row["pr_auc"], row["ks"]) == pytest.approx((auc, ap, ks))
    assert row["brier"] == pytest.approx(((y - p) ** 2).mean()) and row["rmse"] == pytest.approx(math.sqrt(((y - p) ** 2).mean()))
    q = np.clip(p, 1e-6, 1 - 1e-6)
    assert row["logloss"] == pytest.approx(-(y * np.log(q) + (1 - y) * np.log(1 - q)).mean())
    assert ranking.evaluate(scored, two_sided_ks=False, metrics=["ks"]).first()["ks"] == pytest.approx(one_sided)


def test_auc_survives_a_monotone_transform(scored):
    plain = ranking.evaluate(scored, metrics=["auc", "ks"]).first()
    bent = ranking.evaluate(scored.withColumn("y_pred", F.exp(F.col("y_pred") * 3)), metrics=["auc", "ks"]).first()
    assert tuple(plain) == pytest.approx(tuple(bent))


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, -1.7976931348623157e308,
         float("inf"), float("-inf"), 1.0, 0.9999999999999999, 1.0000000000000002, 8.0, 7.999999999999999, 1e22, 0.1, 1e-300]


def test_order_image_is_the_bits_of_the_number(spark):
    rng = np.random.default_rng(12)
    values = np.concatenate([EDGES, [math.ldexp(f, e) for e in range(-1074, 1024) for f in (1.0, 0.9999999999999999)],
                             rng.integers(0, 0x7FEF << 48, 3000).view(np.float64) * rng.choice([-1, 1], 3000), rng.random(500)])
    values = values[np.isfinite(values) | np.isinf(values)]
    rows = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "v": values}))
    got = numeric.with_order_image(rows, "v", {"image": 64}).orderBy("i").toPandas()["image"].to_numpy()
    bits = np.abs(values).view(np.int64)
    assert (got == np.where(values < 0, -bits, bits)).all()
    assert numeric.with_order_image(spark.sql("SELECT CAST(NULL AS DOUBLE) AS v"), "v", {"image": 64}).first()["image"] is None


def test_narrow_group_is_spread_over_tasks(spark):
    """Groups of equal size, one on a thousandth of the range of the other."""
    n = 20_000
    rows = spark.range(2 * n).select(
        F.when(F.col("id") < n, "wide").otherwise("narrow").alias("g"), (F.rand(3) * F.when(F.col("id") < n, 1.0).otherwise(0.001) + 0.3).alias("s"),
        (F.rand(4) < 0.2).cast("int").alias("y"))
    table = ranking.ranking_table(rows, "s", "y", ["g"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would be joined to one task
    try:
        tasks = table.groupBy("g", F.spark_partition_id().alias("task")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for g in ("wide", "narrow"):
        held = [r["count"] for r in tasks if r["g"] == g]
        assert len(held) >= 3 and max(held) < 0.6 * n
    found = {r["g"]: r["auc"] for r in ranking.evaluate(rows, "s", "y", ["g"]).collect()}
    pdf = rows.toPandas()
    for g, part in pdf.groupby("g"):
        ranks = part.s.rank().to_numpy()
        pos = (part.y == 1).to_numpy()
        expected = (ranks[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())
        assert found[g] == pytest.approx(expected)


def test_quantiles_evaluate_their_input_twice(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.createDataFrame([(float(i % 97), float(i), i % 2) for i in range(500)], "u double, v double, y int")
    counted = df.mapInPandas(count, df.schema)
    for run, times in (
        (lambda: ordered.exact_quantiles(counted, ["u", "v"], [0.1, 0.5, 0.9]), 2),
        (lambda: policy.quantile_policy_curve(counted, "u", "y", 11), 1),
        (lambda: drift.calibration_table(counted, "u", "y"), 1),
        (lambda: drift.stability_index(counted, df, ["u", "v"]), 1),
    ):
        before = seen.value
        assert run().collect() and seen.value - before == times * 500


def test_ranking_reads_its_rows_once_in_compiled_code(spark, tmp_path):
    """The JVM interprets methods of more than 8,000 bytes; places in the order are worked out for each score, not each row."""
    path = str(tmp_path / "scored")
    spark.range(500).select((F.col("id") % 7 / 7).alias("y_pred"), (F.col("id") % 3 == 0).cast("int").alias("y_true"), (F.col("id") % 2).alias("g")).write.parquet(path)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for by in ([], ["g"]):
            run = ranking.evaluate(spark.read.parquet(path), by=by)._jdf.queryExecution()
            stages = run.debug().codegenToSeq()
            assert 0 < max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
            assert run.executedPlan().toString().count("Scan parquet") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_counted_rows_rank_like_the_rows(spark):
    nan = float("nan")
    rows = [(1, 0.5, 2), (0, 0.5, 3), (0, -0.0, 2), (1, 0.0, 1), (0, 0.9, 1), (1, 0.9, 4), (None, 0.2, 2), (1, None, 3), (0, nan, 2), (1, 0.1, 0), (0, 0.3, None)]
    counted = spark.createDataFrame(rows, "y_true int, y_pred double, n long")
    whole = spark.createDataFrame([r[:2] for r in rows for _ in range(r[2] or 0)], "y_true int, y_pred double")
    got, expected = (ranking.evaluate(df, count=c).first() for df, c in ((counted, "n"), (whole, None)))
    assert got == expected and (got["n"], got["positives"]) == (13, 7)
    assert ranking.score_counts(counted, "y_pred", "y_true", count="n").filter("score = 0").collect() == [(0, 0.0, 1, 2)]


def test_one_class_and_null_slices(spark):
    rows = [("good", 0, 0.1), ("good", 0, 0.2), ("both", 1, 0.9), ("both", 0, 0.1), (None, 1, 0.5)]
    df = spark.createDataFrame(rows, "s string, y_true int, y_pred double")
    got = {r["value"]: r for r in ranking.evaluate_slices(df, ["s"]).collect()}
    assert set(got) == {"good", "both"}
    assert (got["good"]["auc"], got["good"]["ks"], got["good"]["pr_auc"]) == (None, None, None)
    assert (got["both"]["auc"], got["both"]["ks"], got["both"]["n"]) == (1.0, 1.0, 2)


def test_slices_add_up_to_the_whole(scored, sample):
    parts = ranking.evaluate_slices(scored, ["slice"]).collect()
    assert sum(r["n"] for r in parts) == len(sample)
    assert sum(r["n"] * r["bad_rate"] for r in parts) == pytest.approx(sample.y_true.sum())


def test_running_totals_equal_the_plain_window(scored):
    counts = ranking.score_counts(scored, "y_pred", "y_true", ["slice"])
    fast = ordered.running_totals(counts, "score", ["pos"], ["slice"]).select("slice", "score", "run_pos")
    window = W.partitionBy("slice").orderBy("score").rowsBetween(W.unboundedPreceding, 0)
    plain = counts.select("slice", "score", F.sum("pos").over(window).alias("run_pos"))
    assert fast.exceptAll(plain).count() == 0 and plain.exceptAll(fast).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6), st.sampled_from([0.0, 1.0, 7.5])), min_size=1, max_size=60),
       st.lists(st.floats(0, 1), min_size=1, max_size=6, unique=True))
def test_quantiles_match_numpy(spark, data, probabilities):
    known = [v for v in data if v is not None]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    got = ordered.quantile_values(df, "v", probabilities)
    if not known:
        assert got == []
        return
    assert got == pytest.approx([float(np.quantile(known, q)) for q in probabilities], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("in_order", [2_000_000, 10])
def test_grouped_quantiles_of_several_columns(spark, monkeypatch, in_order):
    monkeypatch.setattr(ordered, "IN_ORDER", in_order)
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 900), "u": rng.random(900), "v": rng.integers(0, 5, 900).astype(float)})
    got = ordered.exact_quantiles(spark.createDataFrame(pdf), ["u", "v"], [0.1, 0.5], ["g"]).collect()
    assert len(got) == 16
    for r in got:
        assert r["value"] == pytest.approx(np.quantile(pdf.loc[pdf.g == r["g"], r["feature"]], r["q"]))


def test_quantiles_of_more_groups_than_a_broadcast_holds(spark, monkeypatch):
    from vintagemill import session

    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"g": rng.integers(0, 300, 3000), "v": rng.integers(0, 50, 3000).astype(float)})
    df = spark.createDataFrame(pdf)
    few = ordered.medians(df, ["v"], ["g"])
    monkeypatch.setattr(session, "BROADCAST_BYTES", 1)
    many = ordered.medians(df, ["v"], ["g"])
    expected = pdf.groupby("g").v.median().to_dict()
    for table in (few, many):
        assert {r["g"]: r["median"] for r in table.collect()} == pytest.approx(expected)


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5.0, None), (5.0, None)], "c double, e double")
    assert [(r["feature"], r["median"]) for r in ordered.medians(df, ["c", "e"]).collect()] == [("c", 5.0)]
    assert drift.with_quantile_bin(df, "c").first()["bin"] is None


def test_code_of_a_quantile_scan_is_short_enough_to_be_compiled(spark):
    """The JVM interprets methods of more than 8,000 bytes."""
    names = [f"c{i}" for i in range(19)]
    df = spark.range(50).select((F.col("id") % 3).alias("g"), *[(F.col("id") * i).cast("double").alias(c) for i, c in enumerate(names)])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for table in (ordered.medians(df, names), ordered.medians(df, names, ["g"])):
            stages = table._jdf.queryExecution().debug().codegenToSeq()
            assert 0 < max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_grid_formula():
    assert policy.parse_grid() == np.arange(0.01, 0.251, 0.005).tolist()
    assert policy.parse_grid("0.1:0.5:0.1") == np.arange(0.1, 0.5 + 1e-12, 0.1).tolist()
    assert policy.parse_grid("0.2,0.1") == [0.2, 0.1]


def brute_curve(y, p, t):
    ok, flag = p <= t, p >= t
    tp, fp = int((flag & (y == 1)).sum()), int((flag & (y == 0)).sum())
    tn, fn = int((~flag & (y == 0)).sum()), int((~flag & (y == 1)).sum())
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
    return dict(tp=tp, fp=fp, tn=tn, fn=fn, precision=precision, recall=recall, f1=f1, approve_rate=ok.mean(),
                approved_mean_pd=p[ok].mean() if ok.any() else None, approved_bad_rate=y[ok].mean() if ok.any() else None)


def test_policy_curve_matches_one_pass_per_threshold(scored, sample):
    y, p = sample.y_true.to_numpy(), sample.y_pred.to_numpy()
    grid = [-0.5, 0.0, 0.1, 0.3, 0.30000001, 0.45, 1.0, 2.0]  # exact ties, nobody approved, everybody approved
    rows = policy.policy_curve(scored, "y_pred", "y_true", grid).collect()
    assert [r["threshold"] for r in rows] == grid
    for r in rows:
        for name, value in brute_curve(y, p, r["threshold"]).items():
            assert r[name] == (None if value is None else pytest.approx(value)), (r["threshold"], name)
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == len(y)


def test_policy_curve_counts_rows_without_a_score(spark):
    df = spark.createDataFrame([(1, None), (0, 0.2), (0, float("nan")), (1, 0.8)], "y_true int, p double")
    r = policy.policy_curve(df, "p", "y_true", [0.5]).first()
    assert (r["tp"], r["fp"], r["tn"], r["fn"], r["approve_rate"]) == (1, 0, 2, 1, 0.25)


def test_curve_is_monotone(scored):
    rows = policy.policy_curve(scored, "y_pred", "y_true").collect()
    assert len(rows) == 49
    assert all(a["recall"] >= b["recall"] and a["approve_rate"] <= b["approve_rate"] for a, b in zip(rows, rows[1:]))


def test_quantile_curve_keeps_repeated_thresholds(scored, sample):
    y, p = sample.y_true.to_numpy(), sample.y_pred.to_numpy()
    rows = policy.quantile_policy_curve(scored, "y_pred", "y_true").collect()
    thresholds = np.quantile(p, np.linspace(0, 1, 101))
    assert [r["threshold"] for r in rows] == pytest.approx(thresholds.tolist())
    for r in rows:
        ok = p < r["threshold"]
        assert r["approval_rate"] == pytest.approx(ok.mean())
        assert r["captured_defaults_share"] == pytest.approx(y[~ok].sum() / y.sum())
    assert rows[0]["bad_rate_in_approved"] is None


def test_first_best_threshold_wins(spark):
    curve = spark.createDataFrame([(0.3, 0.7), (0.1, 0.7), (0.2, 0.5)], "threshold double, f1 double")
    assert policy.best_threshold(curve, "f1").first()["threshold"] == 0.1
    assert policy.nearest_row(curve, 0.15).first()["threshold"] == 0.1


def test_target_approval(scored, sample):
    row = policy.threshold_for_approval(scored, "y_pred", 0.22).first()
    t = sample.y_pred.quantile(0.22)
    assert row["threshold"] == pytest.approx(t)
    assert row["actual_approve_rate"] == pytest.approx((sample.y_pred <= t).mean())


def test_policy_by_slice_keeps_null_and_empty_sets(spark):
    rows = [("R", 1, 0.9), ("R", 0, 0.8), (None, 1, 0.1), (None, 0, 0.2)]
    df = spark.createDataFrame(rows, "channel string, y int, p double")
    got = {r["value"]: r for r in policy.policy_by_slice(df, ["channel"], "p", "y", 0.5).collect()}
    assert got["R"]["approved"] == 0 and got["R"]["approved_bad_rate"] is None
    assert got[None]["approved_bad_rate"] == 0.5
    zero = policy.policy_by_slice(df, ["channel"], "p", "y", 0.5, empty=0.0).filter("value = 'R'").first()
    assert zero["approved_bad_rate"] == 0.0
    assert policy.approved_share(df, [], "p", 0.5).first()["slice"] == "GLOBAL"


def test_stability_index_matches_histograms(spark):
    rng = np.random.default_rng(5)
    base = pd.DataFrame({"x": np.round(rng.normal(0, 1, 3000), 1), "c": np.where(rng.random(3000) < 0.4, 1.0, rng.random(3000))})
    comp = pd.DataFrame({"x": rng.normal(0.5, 2, 2000), "c": rng.random(2000)})
    got = {r["feature"]: r["psi"] for r in drift.stability_index(
        spark.createDataFrame(base), spark.createDataFrame(comp), ["x", "c"]).collect()}
    for f in ("x", "c"):
        edges = np.quantile(base[f], np.linspace(0, 1, 11))
        b, c = (np.histogram(v, bins=edges)[0] for v in (base[f], comp[f]))
        b, c = np.clip(b / b.sum(), 1e-6, None), np.clip(c / c.sum(), 1e-6, None)
        assert got[f] == pytest.approx(((b - c) * np.log(b / c)).sum())
    same = drift.stability_index(spark.createDataFrame(base), spark.createDataFrame(base), ["x"]).first()
    assert same["psi"] == pytest.approx(0.0)


def test_histograms_match_numpy(spark):
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"x": np.round(rng.normal(0, 3, 2000), 1), "k": 4.0})
    rows = drift.histograms(spark.createDataFrame(pdf), ["x", "k"]).collect()
    for f in ("x", "k"):
        expected = np.histogram(pdf[f], bins=60)[0]
        got = np.zeros(60, dtype=int)
        for r in rows:
            if r["feature"] == f:
                got[r["bin"]] = r["n"]
        assert got.tolist() == expected.tolist(), f


def test_deciles_match_qcut(scored, sample):
    cut = pd.qcut(sample.y_pred, 10, duplicates="drop").cat.codes
    got = {r["bin"]: r["n"] for r in drift.calibration_table(scored, "y_pred", "y_true").collect()}
    assert got == cut.value_counts().to_dict()


def newton(y, p, steps=60):
    x = np.log(p / (1 - p))
    X, th = np.c_[np.ones(len(x)), x], np.array([0.0, 1.0])
    for _ in range(steps):
        z = X @ th
        q = 1 / (1 + np.exp(-z))
        th = th + np.linalg.solve((X.T * (q * (1 - q))) @ X, X.T @ (y - q))
    return th


def test_platt_fit_and_ranking(scored, sample):
    p = np.clip(sample.y_pred.to_numpy(), 1e-6, 1 - 1e-6)
    a, b = newton(sample.y_true.to_numpy(), p)
    scaler = calibration.fit_platt(scored, "y_pred", "y_true")
    assert (scaler.a, scaler.b) == pytest.approx((a, b), abs=1e-4)
    effect = {r["stage"]: r for r in calibration.calibration_effect(scored, "y_pred", "y_true", scaler).collect()}
    assert effect["before"]["auc"] == pytest.approx(effect["after"]["auc"])
    assert effect["after"]["brier"] < effect["before"]["brier"]


def test_platt_settles_on_an_uninformative_score(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"p": rng.random(2000) * 0.98 + 0.01, "y": (rng.random(2000) < 0.02).astype(int)})
    scaler = calibration.fit_platt(spark.createDataFrame(pdf), "p", "y")
    assert abs(scaler.b) < 1.0 and 1 / (1 + math.exp(-scaler.a)) == pytest.approx(pdf.y.mean(), abs=0.02)


def test_separable_labels_do_not_pass_silently(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)], "p double, y int")
    with pytest.raises(calibration.NotConverged):
        calibration.fit_platt(df, "p", "y", max_iter=5)


def test_kpi_history_and_smoothing(spark):
    report = spark.createDataFrame(
        [("2021Q1", 0.7, None), ("2021Q2", 0.8, 0.3), ("?", 0.1, 0.1), ("2021Q3", 0.6, 0.5)], "vintage string, auc double, ks double")
    history = monitoring.rolling_mean(monitoring.kpi_history(report, "vintage"))
    got = {(r["metric"], str(r["date"])): r["smoothed"] for r in history.collect()}
    assert len(got) == 5
    assert got["auc", "2021-07-01"] == pytest.approx(0.7) and got["ks", "2021-04-01"] == pytest.approx(0.3)
    with pytest.raises(ValueError):
        monitoring.kpi_history(report.select("vintage"), "vintage")


def test_stability_of_equal_values(spark):
    df = spark.createDataFrame([(0.4, 0.7, 0.1), (0.4, 0.9, 0.3)], "ks double, auc double, bad_rate double")
    got = sorted(map(tuple, monitoring.stability_table(df).select("ks_norm", "auc_norm", "bad_rate_norm").collect()))
    assert got == [(0.0, 0.0, 1.0), (0.0, 1.0, 0.0)]


def test_logit_is_bounded(spark):
    got = spark.createDataFrame([(0.0,), (1.0,)], "p double").select(numeric.logit("p")).collect()
    assert [round(r[0], 3) for r in got] == [-13.816, 13.816]
