"""Raw files, labels, sampling, joins, audit."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vintagemill import session
from vintagemill.operators import audit, joins, loans, macro, sampling, summaries
from vintagemill.plans import jobs
from vintagemill.schemas import ABT_COLUMNS, ABT_SCHEMA, HPI_SCHEMA, PERF_WIDTH
from vintagemill.sources import documents, raw, tables

D = dt.date


def small_world(spark):
    acq = spark.createDataFrame(
        [(k, D(2017, 2, 1)) for k in ("edge_bad", "late_bad", "short", "exact", "no_reports", "codes")],
        "loan_id string, first_payment_date date")
    reports = [
        ("edge_bad", D(2019, 2, 1), "3"), ("edge_bad", D(2019, 3, 1), "0"),   # first 90+ at the window end: bad
        ("late_bad", D(2019, 3, 1), "04"), ("late_bad", D(2019, 2, 1), "2"),  # one month later: good
        ("short", D(2019, 1, 1), "5"),                                        # stops reporting early: dropped
        ("exact", D(2019, 2, 1), "0"),                                        # last report at the window end: kept
        ("codes", D(2019, 4, 1), "RA"), ("codes", D(2018, 1, 1), None),       # letters and gaps are not delinquent
    ]
    perf = spark.createDataFrame(reports, "loan_id string, report_month date, dq_status string")
    return acq, perf


def test_label_edges(spark):
    got = {r["loan_id"]: r["default_within_24m"] for r in loans.label_loans(*small_world(spark)).collect()}
    assert got == {"edge_bad": True, "late_bad": False, "exact": False, "codes": False}


def test_label_options(spark):
    acq, perf = small_world(spark)
    early = {r["loan_id"] for r in loans.label_loans(acq, perf, keep_early_bads=True).collect()}
    assert early == {"edge_bad", "late_bad", "exact", "codes", "short"}
    coded = loans.label_loans(acq, perf.filter("dq_status is not null"), bad_codes=["RA"])
    row = coded.filter("loan_id = 'codes'").first()
    assert row["first_90dpd"] == D(2019, 4, 1) and not row["default_within_24m"]


def test_one_pass_history_equals_two_aggregations(spark):
    _, perf = small_world(spark)
    numbered = loans.with_delinquency(perf)
    two = loans.last_report(numbered).join(loans.first_serious_delinquency(numbered), "loan_id", "left")
    assert sorted(map(tuple, loans.loan_history(perf).collect())) == sorted(map(tuple, two.collect()))


def raw_line(loan_id, first, fico="700", ltv="80"):
    fields = ["x"] * 25
    for i, v in {0: fico, 1: first, 2: "Y", 4: "", 6: "1", 8: "80", 9: "35", 10: "200000", 11: ltv, 12: "3.5",
                 13: "R", 16: "CA", 19: loan_id, 20: "P", 21: "360"}.items():
        fields[i] = v
    return "|".join(fields)


@pytest.fixture()
def raw_folder(tmp_path):
    for year in ("2017", "2018"):
        (tmp_path / "acq" / year).mkdir(parents=True)
        (tmp_path / "perf" / year).mkdir(parents=True)
        (tmp_path / "acq" / year / "a.txt").write_text(
            raw_line(f"L{year}", f"{year}02") + "\n" + raw_line(f"M{year}", f"{year}-03-01", fico="n/a") + "\n")
        rows = [f"L{year}|{int(year) + 2}02|0|3", f"M{year}|{int(year) + 2}-03-01|0|RA"]
        (tmp_path / "perf" / year / "p.csv").write_text("\n".join(rows) + "\n")
    (tmp_path / "acq" / "notes.md").write_text("not data\n")
    return tmp_path


def test_raw_files_and_years(spark, raw_folder):
    names = [f.rsplit("/", 2)[-2] for f in raw.list_raw_files(spark, str(raw_folder / "acq"))]
    assert names == ["2017", "2018"]
    only = raw.list_raw_files(spark, str(raw_folder / "acq"), ["/2018/"])
    assert len(only) == 1
    with pytest.raises(FileNotFoundError):
        raw.list_raw_files(spark, str(raw_folder / "acq"), ["/1901/"])


def test_build_loans_end_to_end(spark, raw_folder):
    out = str(raw_folder / "abt")
    summary = jobs.build_loans(
        spark, str(raw_folder / "acq"), str(raw_folder / "perf"), out, sample_out=str(raw_folder / "sample")).first()
    assert (summary["n"], summary["bad_rate"]) == (4, 0.5)
    abt = tables.read_dataset(spark, out).select(*ABT_COLUMNS)
    assert [(f.name, f.dataType) for f in abt.schema] == [(f.name, f.dataType) for f in ABT_SCHEMA]
    row = abt.filter("loan_id = 'M2018'").first()
    assert row["fico"] is None and row["msa"] is None and row["vintage_q"] == D(2018, 1, 1)
    assert tables.read_dataset(spark, str(raw_folder / "sample")).count() == 4


def test_short_lines_are_padded(spark, tmp_path):
    (tmp_path / "p.txt").write_text("A|201901\nB|201901|0|1|extra\n")
    got = {r["_c0"]: r["_c3"] for r in raw.read_headerless(spark, str(tmp_path), PERF_WIDTH).collect()}
    assert got == {"A": None, "B": "1"}


def test_raw_files_are_written_and_profiled_without_sorting_rows(spark, tmp_path):
    spark.sql(f"CREATE TABLE by_year (v STRING, y STRING) USING csv PARTITIONED BY (y) LOCATION '{tmp_path}/by_year'")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    try:
        with tables.open_files(spark, 4):
            plan = spark.sql("EXPLAIN INSERT INTO by_year SELECT CAST(id AS STRING), CAST(id % 3 AS STRING) FROM range(9)").first()[0]
    finally:
        spark.sql("DROP TABLE by_year")
    assert "Sort" not in plan and spark.conf.get(key) == before
    rows = [(str(i), f"y{i % 7}") for i in range(500)]
    with tables.open_files(spark, 2):  # more years than files: the rows are the same
        spark.createDataFrame(rows, "v string, y string").coalesce(1).write.partitionBy("y").csv(f"{tmp_path}/raw")
    assert sorted(map(tuple, spark.read.schema("v string, y string").csv(f"{tmp_path}/raw").collect())) == sorted(rows)
    profile = raw.layout_profile(spark, f"{tmp_path}/raw")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in profile and "SortAggregate" not in profile


def test_layout_profile_spots_delimiter_and_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fico,date,x\n700,201901,1\n710,201902\n")
    (tmp_path / "b.txt").write_text("700|201901|a,b|1\n710|201902|c|2\n")
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "b.txt").write_text("loan,month\n")
    (tmp_path / "d.txt").write_text("id|state\nA-one|CA\nB7|TX\n")
    found = raw.layout_profile(spark, str(tmp_path)).collect()
    got = {r["file"].split(str(tmp_path) + "/")[1]: r for r in found}
    assert len(found) == 4 and not got["c/b.txt"]["header_likely"] and got["d.txt"]["header_likely"]
    assert (got["a.csv"]["delimiter"], got["a.csv"]["header_likely"]) == ("comma", True)
    assert (got["a.csv"]["min_fields"], got["a.csv"]["max_fields"]) == (2, 3)
    assert (got["b.txt"]["delimiter"], got["b.txt"]["header_likely"], got["b.txt"]["max_fields"]) == ("pipe", False, 4)


def test_empty_input_has_no_rate(spark):
    empty = spark.createDataFrame([], "default_within_24m boolean")
    row = summaries.volume_and_bad_rate(empty).first()
    assert row["n"] == 0 and row["bad_rate"] is None


def test_sample_sizes_are_exact(spark):
    df = spark.range(30_000).withColumnRenamed("id", "loan_id")
    big = sampling.sample_rows(df, 12_345)
    assert big.count() == 12_345 and big.distinct().count() == 12_345
    assert {r[0] for r in sampling.sample_rows(df, 50).collect()} <= {r[0] for r in big.collect()}
    assert sampling.sample_rows(df, 40_000).count() == 30_000
    share = sampling.approximate_rate(df, 0.25).count() / 30_000
    assert 0.23 < share < 0.27


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(25_000).withColumnRenamed("id", "loan_id")
    one = sampling.sample_rows(df.repartition(3), 11_000)
    two = sampling.sample_rows(df.repartition(7), 11_000)
    assert one.exceptAll(two).count() == 0


def test_downsampling_counts(spark):
    df = spark.range(10_000).select(F.col("id").alias("loan_id"), (F.col("id") % 100 == 0).alias("bad"),
                                    F.when(F.col("id") < 5_000, "a").otherwise("b").alias("split"))
    got = {(r["split"], r["bad"]): r["count"] for r in
           sampling.downsample_negatives(df, "bad", 10, by=["split"]).groupBy("split", "bad").count().collect()}
    assert got == {(s, b): n for s in "ab" for b, n in ((True, 50), (False, 500))}
    assert sampling.downsample_negatives(df, "bad", 0).count() == 10_000
    assert sampling.downsample_negatives(df, "bad", 1_000).count() == 10_000
    none_bad = df.filter(~F.col("bad"))
    assert sampling.downsample_negatives(none_bad, "bad", 10).count() == 10


def test_lookup_join_needs_unique_keys(spark):
    fact = spark.createDataFrame([("CA", 1), (None, 2), ("TX", 3)], "state string, x int")
    good = spark.createDataFrame([("CA", 5.0), (None, 9.0)], "state string, v double")
    got = {r["x"]: r["v"] for r in joins.lookup_join(fact, good, ["state"]).collect()}
    assert got == {1: 5.0, 2: None, 3: None}
    with pytest.raises(ValueError, match="not unique"):
        joins.lookup_join(fact, good.union(good), ["state"])


def test_lookup_beyond_the_broadcast_bound_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", 1)
    fact = spark.createDataFrame([("CA", 1), ("TX", 3)], "state string, x int")
    lookup = session.materialise(spark.createDataFrame([("CA", 5.0), ("TX", 6.0)], "state string, v double"))
    joined = joins.lookup_join(fact, lookup, ["state"])
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert joined.count() == 2


def test_one_to_one_slices(spark):
    preds = spark.createDataFrame([("a", 0.1), ("a", 0.2)], "loan_id string, p double")
    meta = spark.createDataFrame([("a", "R")], "loan_id string, channel string")
    with pytest.raises(ValueError, match="predictions"):
        joins.attach_slices_one_to_one(preds, meta, ["channel"])
    assert joins.attach_slices(preds, meta, ["channel"]).count() == 2
    with pytest.raises(ValueError, match="missing columns"):
        joins.align_by_key(preds.drop("loan_id"), meta)
    with pytest.raises(ValueError, match="not unique"):
        joins.attach_slices(preds, meta.union(meta), ["channel"])
    with pytest.raises(ValueError, match="no partner"):
        joins.align_by_key(preds.union(spark.createDataFrame([("z", 0.3), (None, 0.4)], preds.schema)), meta)


def test_reports_are_read_by_name(spark, tmp_path):
    (tmp_path / "r.csv").write_text("State, Date,hpi index,more\nCA,2019-01-01,x,1\nTX,2019-02-01,7.5,2\n")
    got = tables.read_report(spark, str(tmp_path / "r.csv"), HPI_SCHEMA).collect()
    assert [(r["date"], r["state"], r["hpi_index"]) for r in got] == [("2019-01-01", "CA", None), ("2019-02-01", "TX", 7.5)]
    (tmp_path / "s.csv").write_text("date,state\n2019-01-01,CA\n")
    with pytest.raises(ValueError, match="hpi_index"):
        tables.read_report(spark, str(tmp_path / "s.csv"), HPI_SCHEMA)


def test_documents_are_one_row(spark, tmp_path):
    two = spark.createDataFrame([(1,), (2,)], "a int")
    for df in (two, two.limit(0)):
        with pytest.raises(ValueError, match="one row"):
            documents.write_document(df, str(tmp_path / "doc"))


def test_samples_with_null_groups_and_whole_budgets(spark):
    rows = [(i, None if i % 3 == 0 else "a", int(i % 10 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "loan_id long, g string, y int")
    kept = sampling.downsample_negatives(df, "y", 2.0, by=["g"]).collect()
    assert sum(r["y"] for r in kept) == 30 and len(kept) == 90 and sum(r["g"] is None for r in kept) == 30
    order = [r["loan_id"] for r in df.orderBy(sampling.sample_order("loan_id", 13), "loan_id").collect()]
    for k in (0, 1, 7, 299, 300, 500):
        assert sorted(r["loan_id"] for r in sampling.sample_rows(df, k).collect()) == sorted(order[:k])


def test_house_price_change_over_gaps(spark):
    months = [m for m in range(14) if m != 1]
    rows = [("CA", D(2019 + m // 12, m % 12 + 1, 1), 100.0 + m) for m in months]
    hpi = spark.createDataFrame(rows, "state string, date date, hpi_index double")
    by_row = {r["date"]: r["hpi_12m_chg"] for r in macro.yearly_change(hpi).collect()}
    by_month = {r["date"]: r["hpi_12m_chg"] for r in macro.yearly_change(hpi, calendar=True).collect()}
    assert by_row[D(2020, 2, 1)] == pytest.approx(113 / 100 - 1)
    assert by_month[D(2020, 2, 1)] is None and by_month[D(2020, 1, 1)] == pytest.approx(112 / 100 - 1)


def test_padding_carries_the_last_value(spark):
    rows = [("CA", D(2019 + m // 12, m % 12 + 1, 1), None if m == 1 else 100.0 + m) for m in range(14)]
    hpi = spark.createDataFrame(rows, "state string, date date, hpi_index double")
    got = {r["date"]: r["hpi_12m_chg"] for r in macro.yearly_change(hpi, pad=True).collect()}
    assert got[D(2020, 2, 1)] == pytest.approx(113 / 100 - 1)


def test_duplicate_macro_keys_are_rejected(spark):
    abt = spark.createDataFrame([("l", "CA", D(2019, 3, 1), None)], "loan_id string, state string, first_payment_date date, orig_date date")
    un = spark.createDataFrame([("2019-02", "CA", 4.0)] * 2, "date string, state string, unemp_rate double")
    with pytest.raises(ValueError, match="unemployment"):
        macro.with_macro(abt, unemployment=un)
    assert macro.with_macro(abt, unemployment=un.limit(1)).first()["unemp_rate"] == 4.0


def test_origination_month_is_chosen_per_dataset(spark):
    schema = "loan_id string, first_payment_date date, orig_date date"
    rows = [("a", D(2019, 3, 1), D(2018, 12, 5)), ("b", D(2019, 3, 1), None)]
    got = {r["loan_id"]: r["orig_month"] for r in macro.origination_month(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"a": "2018-12", "b": None}
    assert macro.origination_month(spark.createDataFrame(rows[1:], schema)).first()["orig_month"] == "2019-02"


def test_month_fallbacks(spark):
    quarters = spark.createDataFrame([("2019Q2",)], "vintage_q string")
    assert [r[0] for r in macro.months_present(quarters).collect()] == ["2019-04"]
    fixed = [r[0] for r in macro.months_present(spark.range(1)).collect()]
    assert (fixed[0], fixed[-1], len(fixed)) == ("2017-01", "2025-03", 99)


def test_missing_values_and_top_values(spark):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 2)], "channel string, x int")
    got = {r["col"]: (r["nulls"], round(r["miss_rate"], 4)) for r in audit.missing_values(df).collect()}
    assert got == {"channel": (1, 0.3333), "x": (1, 0.3333)}
    top = [(r["val"], r["n"]) for r in audit.top_values(df, ["channel"]).orderBy("rank").collect()]
    assert top == [("a", 2), (None, 1)]


def test_column_roles(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("big"), (F.col("id") % 2).cast("int").alias("flag"),
        (F.col("id") / 100).alias("share"), (F.col("id") % 20 / 100).alias("prob_x"), F.lit(0.5).alias("flat"))
    got = [(r["role"], r["column"]) for r in audit.detect_roles(df, exact=True).orderBy("role", "rank").collect()]
    assert got == [("label", "flag"), ("probability", "prob_x"), ("probability", "share")]


def test_shared_folder(spark):
    from types import SimpleNamespace as Fake

    def fake(master, folder):
        return Fake(conf=Fake(get=lambda key, default: folder), sparkContext=Fake(master=master, applicationId=f"test-{master}"))

    assert session.shared_folder(fake("spark://host", "hdfs:///shared/")) == "hdfs:///shared"
    local = session.shared_folder(fake("local[2]", None))
    assert local == session.shared_folder(fake("local[2]", None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("spark://host", None))


@pytest.mark.parametrize("in_order", [2_000_000, 0])
def test_samples_of_repeated_keys_are_exact(spark, monkeypatch, in_order):
    from vintagemill.operators import ordered

    monkeypatch.setattr(ordered, "IN_ORDER", in_order)
    rows = [(i % 10, i if i % 4 else 0, i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "loan_id long, v long, bad int").repartition(5)
    for k in (0, 1, 5, 37, 99, 100, 150):
        assert sampling.sample_rows(df, k).count() == min(k, 100)
    fewer = sampling.downsample_negatives(df.filter("bad = 0 OR v < 13"), "bad", 3.0)
    bads = sum(1 for r in rows if r[2] and r[1] < 13)
    assert fewer.groupBy("bad").count().orderBy("bad").collect() == [(0, min(50, 3 * bads)), (1, bads)]
    equal = spark.createDataFrame([(1, "x")] * 30 + [(2, None)] * 30, "loan_id long, s string")
    assert sampling.sample_rows(equal, 7).count() == 7 and sampling.sample_rows(equal, 44).count() == 44
