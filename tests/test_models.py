"""Features, encoders, models, tree ensembles, documents, policy files."""

import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vintagemill.operators import columns, features, policy, scoring, training
from vintagemill.plans import jobs
from vintagemill.schemas import POLICY_SCHEMA
from vintagemill.sources import documents, tables

YEARS = {"train": (None, 2018), "valid": (2019, 2019), "test": (2020, None)}


@pytest.fixture(scope="module")
def abt(spark):
    rng = np.random.default_rng(4)
    n = 1500
    fico = rng.integers(550, 850, n)
    ltv = rng.integers(40, 120, n).astype(float)
    risk = 1 / (1 + np.exp(-(-2 + (700 - fico) / 40 + (ltv - 80) / 25)))
    pdf = pd.DataFrame({
        "loan_id": [f"L{i}" for i in range(n)], "fico": fico, "ltv": ltv, "dti": rng.integers(5, 60, n).astype(float),
        "orig_rate": rng.integers(8, 30, n) / 4, "orig_upb": rng.random(n) * 1e5, "state": rng.choice(["CA", "TX", "OH"], n, p=[0.6, 0.3, 0.1]),
        "channel": rng.choice(["R", "B"], n), "purpose": "P", "default_within_24m": rng.random(n) < risk,
        "vintage_q": pd.to_datetime(rng.choice(["2017-01-01", "2018-04-01", "2019-01-01", "2020-01-01"], n)).date,
    })
    return spark.createDataFrame(pdf).withColumn("fico", F.col("fico").cast("int")).persist()


@pytest.fixture(scope="module")
def table(abt):
    return features.build_features(abt, YEARS).persist()


def test_split_bounds(spark):
    df = spark.createDataFrame([("2019Q4",), ("2020-01-01",), ("2022-12-31",), ("2023Q1",), (None,), ("x",)], "v string")
    assert [r["split"] for r in features.with_split(df, vintage="v").collect()] == ["train", "valid", "test", "recent", None, None]


def test_clipping_and_derived_features(spark):
    df = spark.createDataFrame([(9999, 999.0, 90.0), (None, None, None)], "fico int, dti double, ltv double")
    got = features.derive(features.clip_features(df)).collect()
    assert (got[0]["fico"], got[0]["dti"], got[0]["dti_43"], got[0]["ltv_80"]) == (850.0, 65.0, 22.0, 10.0)
    assert (got[0]["fico_gap"], got[0]["int_dti_x_ltv"]) == (0.0, 65.0 * 90)
    assert all(v is None for v in got[1])
    nulled = features.clip_features(df, null_out_of_range=True).first()
    assert nulled["fico"] is None and nulled["dti"] is None and nulled["ltv"] == 90.0


def test_spread_can_be_fitted_on_train_only(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 9.0)], "vintage_q string, orig_rate double")
    whole = sorted(r["rate_spread_vintage"] for r in features.spread_to_group(df).collect())
    assert whole == [-1.0, 0.0, 1.0]
    part = features.spread_to_group(df, fit_on=df.filter("vintage_q = 'a'"))
    assert part.filter("vintage_q = 'b'").first()["rate_spread_vintage"] is None


def test_target_means(spark):
    train = spark.createDataFrame([("CA", 1), ("CA", 0), ("TX", 0), (None, 1)], "state string, y int")
    model = features.fit_target_means(train, ["state"], "y", smoothing=2.0)
    test = spark.createDataFrame([("CA",), ("TX",), ("NY",), (None,)], "state string")
    got = {r["state"]: r["state_te"] for r in model.transform(test).collect()}
    g = 0.5
    assert got == pytest.approx({"CA": (1 + 2 * g) / 4, "TX": (0 + 2 * g) / 3, "NY": g, None: g})


def test_feature_table_keeps_keys_and_no_dates(table):
    assert table.columns[:7] == ["loan_id", "split", "vintage_q", "state", "channel", "purpose", "default_within_24m"]
    assert {"state_te", "rate_spread_vintage", "int_fico_gap_x_ltv"} <= set(columns.numeric_features(table))
    assert "default_within_24m" not in columns.numeric_features(table)
    assert "vintage_q" not in columns.all_features(table, drop=())


def test_conform_and_impute(spark):
    df = spark.createDataFrame([("1.5", "k1"), ("bad", "k2")], "a string, loan_id string")
    ready = columns.impute(columns.conform(df, ["a", "b"], ["loan_id"]), ["a", "b"], {"a": 7.0})
    assert sorted(map(tuple, ready.collect())) == [("k1", 1.5, 0.0), ("k2", 7.0, 0.0)]


def balanced_logistic(X, y, steps=200):
    X = (X - X.mean(0)) / X.std(0, ddof=1)
    n, w = len(y), np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    Z, th = np.c_[np.ones(n), X], np.zeros(X.shape[1] + 1)
    ridge = np.diag([0.0] + [1.0] * X.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-Z @ th))
        th = th + np.linalg.solve((Z.T * (w * p * (1 - p))) @ Z + ridge, Z.T @ (w * (y - p)) - ridge @ th)
    return 1 / (1 + np.exp(-Z @ th))


def test_logistic_matches_newton(spark, table):
    names = ["fico", "ltv", "dti"]
    train = table.filter("split = 'train'")
    model = training.fit_logistic(train, names)
    pdf = train.select("loan_id", "default_within_24m", *names).toPandas()
    expected = balanced_logistic(pdf[names].to_numpy(float), pdf.default_within_24m.to_numpy(int))
    got = training.predictions(model, train).toPandas().set_index("loan_id").loc[pdf.loan_id, "y_pred"].to_numpy()
    assert np.abs(got - expected).max() < 1e-3
    terms = training.linear_terms(model)
    assert terms["fico"][0] < 0 < terms["ltv"][0]
    assert terms["fico"][1] == pytest.approx(pdf.fico.mean())


def test_sign_bounds_hold(table):
    against = {"fico": 1, "ltv": -1}
    model = training.fit_logistic(table.filter("split = 'train'"), ["fico", "ltv", "dti"], directions=against)
    terms = training.linear_terms(model)
    assert terms["fico"][0] == pytest.approx(0, abs=1e-9) and terms["ltv"][0] == pytest.approx(0, abs=1e-9)


def test_trees_learn_save_and_load(spark, table, tmp_path):
    train, valid, test = (table.filter(F.col("split") == s) for s in ("train", "valid", "test"))
    model = training.fit_mixed_trees(train, valid, maxIter=8, maxDepth=3)
    from vintagemill.operators import ranking
    scored = training.predictions(model, test)
    assert ranking.evaluate(scored, metrics=["auc"]).first()["auc"] > 0.65
    assert scored.count() == test.count() and "loan_id" in scored.columns
    model.save(spark, str(tmp_path / "run"))
    again = training.CreditModel.load(spark, str(tmp_path / "run"))
    assert again.medians == model.medians
    assert training.predictions(again, test).exceptAll(scored).count() == 0
    table_ = training.feature_importance(model).toPandas()
    assert set(table_.feature) == {*model.numeric, *model.categorical} and table_.gain.sum() == pytest.approx(1.0)
    assert table_.split.sum() > 0
    unseen = test.withColumn("state", F.lit("ZZ")).withColumn("fico", F.lit(None).cast("int"))
    assert training.predictions(model, unseen).filter("y_pred is null").count() == 0


def test_search_settings_are_distinct_and_repeatable():
    drawn = training.sample_settings(training.SEARCH_SPACE, 30, 42)
    assert len({str(d) for d in drawn}) == 30 and drawn == training.sample_settings(training.SEARCH_SPACE, 30, 42)


TREE_FILE = """tree
version=v4
max_feature_idx=2
objective=binary sigmoid:1
feature_names=a b c

Tree=0
num_leaves=3
num_cat=0
split_feature=0 2
threshold=0.5 10
decision_type=2 8
left_child=-1 -2
right_child=1 -3
leaf_value=0.5 -1 2
shrinkage=1

Tree=1
num_leaves=1
num_cat=0
leaf_value=0.25

end of trees

parameters
end of parameters
"""


def test_tree_file_and_both_evaluators(spark, tmp_path):
    path = tmp_path / "model.txt"
    path.write_text(TREE_FILE)
    model = scoring.read_tree_file(spark, str(path))
    assert model.features == ["a", "b", "c"] and model.size == 6
    rows = [(0.5, 1.0, 3.0), (0.6, 1.0, 10.0), (0.6, 1.0, 11.0), (None, 1.0, 99.0), (0.6, 1.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    raw = [0.75, -0.75, 2.25, 0.75, 2.25]  # a missing: counts as 0; c missing: default branch is the right one
    expected = [1 / (1 + np.exp(-r)) for r in raw]
    for method in ("expression", "vectorised"):
        assert [r[0] for r in df.select(model.probability(method)).collect()] == pytest.approx(expected), method
    stored = scoring.ensemble_from_nodes(model.node_table(spark), model.features)
    assert [r[0] for r in df.select(stored.probability()).collect()] == pytest.approx(expected)
    path.write_text(TREE_FILE.replace("num_cat=0", "num_cat=1"))
    with pytest.raises(ValueError, match="categorical"):
        scoring.read_tree_file(spark, str(path))


def test_reason_codes_rank_by_size(spark):
    df = spark.createDataFrame([("l", 600.0, 90.0, None)], "loan_id string, fico double, ltv double, dti double")
    got = scoring.reason_codes(df, {"fico": (-0.01, 700.0), "ltv": (0.2, 80.0), "dti": (1.0, 3.0)}, k=2).collect()
    assert [(r["rank"], r["feature"], r["contribution"]) for r in got] == [(1, "ltv", pytest.approx(2.0)), (2, "fico", pytest.approx(1.0))]


def test_documents(spark, tmp_path):
    pairs = spark.createDataFrame([("fico", 751.0), ("ltv", 80.0)], "feature string, median double")
    documents.write_document(documents.map_document(pairs, "feature", "median", "medians"), str(tmp_path / "m"))
    text = next((tmp_path / "m").glob("*.json")).read_text()
    assert json.loads(text) == {"medians": {"fico": 751.0, "ltv": 80.0}}
    (tmp_path / "policy.json").write_text(json.dumps({"threshold": 0.014021, "metric": "ks_constrained", "prob": "pd_cal"}, indent=2))
    stored = documents.read_document(spark, str(tmp_path / "policy.json"), POLICY_SCHEMA)
    changed = documents.update_policy(stored, {"approve_rate_recent": 0.2, "prob": None}).first()
    assert (changed["threshold"], changed["approve_rate_recent"], changed["prob"]) == (0.014021, 0.2, "pd_cal")
    with pytest.raises(ValueError):
        documents.update_policy(stored, {"nonsense": 1})
    history = spark.createDataFrame([(0.1, "f1", "p", None, None, 1), (0.2, "f1", "p", None, None, 2)],
                                    "threshold double, metric string, prob string, approve_rate_recent double, "
                                    "expected_bad_rate_on_approved double, updated_at int")
    assert documents.latest_policy(history).first()["threshold"] == 0.2


def test_policy_versions_are_created_never_overwritten(spark, tmp_path):
    folder = str(tmp_path / "history")
    assert documents.policy_versions(spark, folder) == []
    with pytest.raises(FileNotFoundError):
        documents.read_policy(spark, folder)
    assert documents.append_policy(spark, folder, {"threshold": 0.1, "prob": "pd_cal"}) == 1
    assert documents.append_policy(spark, folder, {"threshold": 0.2}, base=1) == 2
    with pytest.raises(FileExistsError):  # a second writer that read version 1
        documents.append_policy(spark, folder, {"threshold": 0.3}, base=1)
    last, first = documents.read_policy(spark, folder).first(), documents.read_policy(spark, folder, 1).first()
    assert (last["threshold"], last["prob"], first["threshold"]) == (0.2, "pd_cal", 0.1)


def test_two_writers_of_one_policy_version(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "history")
    documents.append_policy(spark, folder, {"threshold": 0.1, "prob": "pd_cal"})
    documents.append_policy(spark, folder, {"threshold": 0.2})
    monkeypatch.setattr(documents, "policy_versions", lambda *_: [1])  # what the second writer saw before the first was done
    with pytest.raises(FileExistsError, match="by another"):
        documents.append_policy(spark, folder, {"threshold": 0.3})
    monkeypatch.undo()
    assert documents.read_policy(spark, folder).first()["threshold"] == 0.2
    (tmp_path / "history" / "policy-000003.json").write_text("")
    with pytest.raises(ValueError, match="no content"):
        documents.read_policy(spark, folder)


def test_revised_policy_needs_predictions_and_its_score(spark, tmp_path):
    rows = spark.createDataFrame([(i / 10, i % 2) for i in range(10)], "pd_cal double, y_true int")
    rows.write.parquet(str(tmp_path / "p"))
    rows.filter("pd_cal > 2").write.parquet(str(tmp_path / "none"))
    history = str(tmp_path / "history")
    with pytest.raises(ValueError, match="no policy"):
        jobs.revise_policy(spark, history, str(tmp_path / "p"))
    first = jobs.revise_policy(spark, history, str(tmp_path / "p"), target=0.5).first()
    again = jobs.revise_policy(spark, history, str(tmp_path / "p")).first()
    assert again == first and documents.policy_versions(spark, history) == [1, 2]
    with pytest.raises(ValueError, match="no predictions"):
        jobs.revise_policy(spark, history, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="chosen on"):
        jobs.revise_policy(spark, history, str(tmp_path / "p"), score="y_true")
    assert documents.policy_versions(spark, history) == [1, 2]


def test_tree_contributions_add_up_to_the_score(spark):
    node = scoring.Node
    trees = []
    for missing, left in (("zero", True), ("default", True), ("default", False), ("zero_default", False)):
        trees.append({0: node(0, "a", 0.5, 1, -1, left, missing), 1: node(1, "b", -0.5, -2, -3, not left, missing),
                      -1: node(-1, value=1.0, count=3.0), -2: node(-2, value=-2.0, count=1.0), -3: node(-3, value=0.25, count=4.0)})
    trees.append({-1: node(-1, value=0.125, count=8.0)})  # a tree of one leaf
    model = scoring.TreeEnsemble(["a", "b"], trees, [0, 0, 0, 0, -1])
    values = [None, float("nan"), 0.0, -1.0, 0.5, 2.0]
    df = spark.createDataFrame([(6 * i + j, a, b) for i, a in enumerate(values) for j, b in enumerate(values)], "id int, a double, b double")
    # mean of a tree: (3 * 1 - 2 + 4 * 0.25) / 8; below its root: (-2 + 4 * 0.25) / 5
    assert model.base() == pytest.approx(4 * 0.25 + 0.125)
    rows = df.select("id", "a", "b", model.contributions().alias("c"), model.raw_expression().alias("raw")).collect()
    assert all(sum(r["c"]) == pytest.approx(r["raw"] - model.base()) for r in rows)
    high = next(r for r in rows if (r["a"], r["b"]) == (2.0, -1.0))
    assert high["c"] == pytest.approx([4 * (1.0 - 0.25), 0.0])
    low = next(r for r in rows if (r["a"], r["b"]) == (-1.0, -1.0))
    assert low["c"] == pytest.approx([4 * (-0.2 - 0.25), 4 * (-2.0 + 0.2)])
    codes = scoring.tree_reason_codes(df, model, "id", k=1).where(f"id = {low['id']}").collect()
    assert [(r["rank"], r["feature"], r["value"]) for r in codes] == [(1, "b", -1.0)]
    stored = scoring.ensemble_from_nodes(model.node_table(spark), model.features)
    assert stored.base() == model.base()
    with pytest.raises(ValueError, match="training rows"):
        scoring.TreeEnsemble(["a"], [{0: node(0, value=1.0)}], [0]).base()


def test_search_draws_side_by_side(table):
    train, valid = table.filter("split = 'train'"), table.filter("split = 'valid'")
    space = {"maxDepth": [1, 2], "minInstancesPerNode": [5, 2000], "weight_scale": [0.5, 1.0]}
    runs = [training.random_search(train, valid, 4, space=space, numeric=["fico", "ltv"], at_once=n, maxIter=2) for n in (1, 3)]
    logs = [log.orderBy("draw").collect() for _, log in runs]
    assert logs[0] == logs[1] and [r["draw"] for r in logs[0]] == [1, 2, 3, 4]
    best = [r for r in logs[0] if r["best"]]
    assert len(best) == 1 and best[0]["ks"] == max(r["ks"] for r in logs[0])
    scored = training.predictions(runs[1][0], valid, keys=["loan_id"])
    assert training.KolmogorovSmirnov().evaluate(scored) == pytest.approx(best[0]["ks"])


def test_draws_are_judged_on_counted_scores(spark, table, monkeypatch):
    """What is written for a draw grows with its different scores, not with the rows; nothing stays in memory."""
    train, valid = table.filter("split = 'train'"), table.filter("split = 'valid'")
    written, write = [], training.session.materialise

    def spy(df, name="table"):
        done = write(df, name)
        if name == "draw":
            written.append(done)
        return done

    monkeypatch.setattr(training.session, "materialise", spy)
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    space = {"maxDepth": [1, 2], "minInstancesPerNode": [5]}
    training.random_search(train, valid, 2, space=space, numeric=["fico", "ltv"], at_once=1, maxIter=1)
    assert len(written) == 2
    for draw in written:
        assert draw.count() <= 2 * 4 and draw.agg(F.sum("n")).first()[0] == valid.count()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= kept


def test_policy_is_bound_to_its_score_column(spark, tmp_path):
    path = str(tmp_path / "choice")
    documents.write_document(documents.policy_record(spark, {"threshold": 0.1, "metric": "f1", "prob": "pd_cal"}), path)
    assert jobs.policy_threshold(spark, path, "pd_cal") == 0.1
    with pytest.raises(ValueError, match="pd_cal"):
        jobs.policy_threshold(spark, path, "y_pred")
    with pytest.raises(ValueError):
        documents.policy_record(spark, {"treshold": 0.1})


def test_train_calibrate_choose_backtest_export(spark, abt, tmp_path):
    at = lambda name: str(tmp_path / name)
    tables.write_dataset(abt, at("abt"))
    years = {"train": (None, 2017), "valid": (2018, 2018), "test": (2019, 2019), "recent": (2020, None)}
    jobs.build_splits(spark, at("abt"), at("features"), at("medians"), years)
    jobs.train_trees(spark, at("features"), at("run"), ["fico", "ltv", "dti"], maxIter=5, maxDepth=3)
    jobs.score_recent(spark, at("run"), at("features"), at("recent"))
    effect = {r["stage"]: r["auc"] for r in jobs.calibrate(spark, at("run"), at("cal"), at("recent")).collect()}
    assert effect["before"] == pytest.approx(effect["after"])
    jobs.apply_scaler(spark, at("cal/platt_scaler"), at("recent"), at("recent2"))
    assert tables.read_dataset(spark, at("recent2")).count() == tables.read_dataset(spark, at("cal/recent_calibrated")).count()
    record = jobs.choose_policy(spark, at("cal/test_calibrated"), at("policy"), grid="0.05:0.9:0.05").first()
    assert record["prob"] == "pd_cal" and 0.05 <= record["threshold"] <= 0.9
    back = jobs.run_backtest(spark, at("abt"), at("cal/recent_calibrated"), at("policy/policy_choice"), at("backtest"))
    row = back.first()
    assert back.count() == 1 and row["n"] == abt.filter("vintage_q >= '2020-01-01'").count()
    jobs.export_decisions(
        spark, {"test": at("cal/test_calibrated"), "recent": at("cal/recent_calibrated")},
        {"policy_curve": at("policy/policy_curve")}, at("policy/policy_choice"), at("export"))
    recent = spark.read.option("header", True).csv(at("export/recent"))
    assert recent.columns == ["loan_id", "vintage_q", "state", "channel", "purpose", "pd", "decision_at_t"]
    share = policy.threshold_shares(tables.read_dataset(spark, at("cal/recent_calibrated")), "pd_cal", [record["threshold"]]).first()
    assert recent.filter("decision_at_t = 1").count() == round(share["share"] * row["n"])


def test_report_names_are_cleaned(spark, tmp_path):
    (tmp_path / "r.csv").write_text(" Vintage , Bad rate\n2021Q1,0.1\n")
    assert tables.read_report(spark, str(tmp_path / "r.csv")).columns == ["vintage", "bad_rate"]
    assert tables.read_optional_report(spark, str(tmp_path / "absent.csv")) is None
    with pytest.raises(ValueError):
        tables.read_union(spark, [])
