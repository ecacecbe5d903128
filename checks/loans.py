"""Raw files, loan history, labels and volume tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import query
from checks.views import oracle, view
from vintagemill import session
from vintagemill.operators import loans, macro, sampling, summaries
from vintagemill.schemas import ABT_COLUMNS, ACQ_WIDTH, PERF_WIDTH
from vintagemill.sources import raw, tables


def built_abt(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled loans, by the library, from the typed inputs."""
    return loans.label_loans(view(spark, folder, "acq"), view(spark, folder, "perf"))


_datasets: dict[tuple[str, str, str], str] = {}

# Years a task writes side by side; rows are put in order only if it meets more.
YEAR_FILES = 32


def dataset(spark: SparkSession, folder: str, name: str, build) -> DataFrame:
    """A derived dataset, written once per application and read by later queries.

    Stages exchange datasets on disk, so a query over labelled loans does not label
    them again.  A path that has gone is built anew.
    """
    slot = (spark.sparkContext.applicationId, folder, name)
    if slot in _datasets:
        try:
            return spark.read.parquet(_datasets[slot])
        except AnalysisException:
            pass
    _datasets[slot] = session.fresh_path(spark, name)
    tables.write_dataset(build(spark, folder), _datasets[slot])
    return spark.read.parquet(_datasets[slot])


def abt(spark: SparkSession, folder: str) -> DataFrame:
    return dataset(spark, folder, "abt", built_abt)


def raw_frame(spark: SparkSession, folder: str, name: str) -> DataFrame:
    df = view(spark, folder, name)
    return df.toDF(*[f"_{c}" for c in df.columns])


def raw_root(spark: SparkSession, folder: str) -> str:
    """Pipe-delimited raw files derived from the tables, one folder per year."""
    slot = (spark.sparkContext.applicationId, folder, "raw")
    if slot in _datasets:
        try:
            raw.list_raw_files(spark, f"{_datasets[slot]}/perf")
            return _datasets[slot]
        except (AnalysisException, FileNotFoundError):
            pass
    root = _datasets[slot] = session.fresh_path(spark, "raw")
    for name in ("acq", "perf"):
        df = raw_frame(spark, folder, f"{name}_raw").withColumn("y", F.substring("_c1", 1, 4))
        with tables.open_files(spark, YEAR_FILES):
            df.write.partitionBy("y").option("sep", "|").csv(f"{root}/{name}")
    return root


@query("s1_raw_files", oracle("""
SELECT concat('y=', substr(c1, 1, 4)) AS folder, COUNT(*) AS n_lines FROM perf_raw GROUP BY 1""", "perf_raw"))
def _(spark, folder):
    files = raw.file_table(spark, f"{raw_root(spark, folder)}/perf")
    return files.groupBy(F.element_at(F.split("file", "/"), 1).alias("folder")).agg(F.sum("n_lines").alias("n_lines"))


@query("s2_raw_files_of_years", oracle("""
SELECT c19, c1, c0 FROM acq_raw WHERE substr(c1, 1, 4) IN ('1996', '1997')""", "acq_raw"))
def _(spark, folder):
    files = raw.list_raw_files(spark, f"{raw_root(spark, folder)}/acq", ["y=1996", "y=1997"])
    return raw.read_headerless(spark, files, ACQ_WIDTH).select(
        F.col("_c19").alias("c19"), F.col("_c1").alias("c1"), F.col("_c0").alias("c0"))


@query("s3_headerless_scan", oracle("SELECT * FROM perf_raw", "perf_raw"))
def _(spark, folder):
    df = raw.read_headerless(spark, f"{raw_root(spark, folder)}/perf", PERF_WIDTH)
    return df.toDF(*[c[1:] for c in df.columns])


@query("s4_raw_layout_profile", oracle("""
SELECT source, COUNT(*) AS n_lines, 'pipe' AS delimiter, MIN(f) AS min_fields, MAX(f) AS max_fields, false AS header_likely
FROM (SELECT 'acq' AS source, 25 AS f FROM acq_raw UNION ALL SELECT 'perf', 4 FROM perf_raw) GROUP BY 1""",
       "acq_raw", "perf_raw"))
def _(spark, folder):
    parts = []
    for name in ("acq", "perf"):
        profile = raw.layout_profile(spark, f"{raw_root(spark, folder)}/{name}")
        parts.append(profile.withColumn("source", F.lit(name)))
    return parts[0].unionByName(parts[1]).groupBy("source", "delimiter", "header_likely").agg(
        F.sum("n_lines").alias("n_lines"), F.min("min_fields").alias("min_fields"), F.max("max_fields").alias("max_fields"))


ACQ_FROM_RAW = """
SELECT c19 AS loan_id, TRY_CAST(c0 AS INT) AS fico,
       CAST(date_trunc('month', COALESCE(try_strptime(c1, '%Y-%m-%d'), try_strptime(c1, '%Y%m'))) AS DATE) AS first_payment_date,
       CAST(NULL AS DATE) AS orig_date, TRY_CAST(c10 AS DOUBLE) AS orig_upb, TRY_CAST(c12 AS DOUBLE) AS orig_rate,
       TRY_CAST(c11 AS DOUBLE) AS ltv, TRY_CAST(c8 AS DOUBLE) AS cltv, TRY_CAST(c9 AS DOUBLE) AS dti,
       c13 AS channel, c20 AS purpose, c7 AS occupancy, c15 AS product, c17 AS property_type, c16 AS state,
       TRY_CAST(c4 AS INT) AS msa, TRY_CAST(c21 AS INT) AS loan_term, TRY_CAST(c6 AS INT) AS num_units,
       c23 AS seller_name, c24 AS servicer_name, c2 AS first_time_buyer
FROM acq_raw
"""
PERF_FROM_RAW = """
SELECT c0 AS loan_id,
       CAST(date_trunc('month', COALESCE(try_strptime(c1, '%Y-%m-%d'), try_strptime(c1, '%Y%m'))) AS DATE) AS report_month,
       c3 AS dq_status
FROM perf_raw
"""
# one history row per loan: its last report, and the first one at three or more months overdue
ABT_FROM_RAW = """
SELECT loan.*, seen.last_perf_month, seen.first_90dpd, COALESCE(seen.first_90dpd <= loan.window_end, false) AS default_within_24m
FROM (SELECT loan_id, MAX(report_month) AS last_perf_month,
             MIN(report_month) FILTER (WHERE TRY_CAST(dq_status AS INT) >= 3) AS first_90dpd
      FROM perf2 GROUP BY loan_id) AS seen
JOIN (SELECT *, CAST(date_trunc('quarter', first_payment_date) AS DATE) AS vintage_q,
             CAST(first_payment_date + INTERVAL 24 MONTH AS DATE) AS window_end FROM acq2) AS loan
  ON loan.loan_id = seen.loan_id AND seen.last_perf_month >= loan.window_end
"""


@query("p1_acquisition_projection", oracle(ACQ_FROM_RAW, "acq_raw"))
def _(spark, folder):
    return raw.project_acquisition(raw_frame(spark, folder, "acq_raw"))


@query("p2_performance_projection", oracle(PERF_FROM_RAW, "perf_raw"))
def _(spark, folder):
    return raw.project_performance(raw_frame(spark, folder, "perf_raw"))


@query("p3_month_parse", oracle("""
SELECT first_payment_date, COUNT(*) AS n FROM acq2 GROUP BY 1""", "acq_raw", acq2=ACQ_FROM_RAW))
def _(spark, folder):
    acq = raw.project_acquisition(raw_frame(spark, folder, "acq_raw"))
    return acq.groupBy("first_payment_date").agg(F.count(F.lit(1)).alias("n"))


@query("p4_delinquency_number", oracle("""
SELECT dq_status, COALESCE(TRY_CAST(dq_status AS INT), -1) AS dq_num, COUNT(*) AS n FROM perf GROUP BY 1, 2""", "perf"))
def _(spark, folder):
    perf = loans.with_delinquency(view(spark, folder, "perf"))
    return perf.groupBy("dq_status", "dq_num").agg(F.count(F.lit(1)).alias("n"))


@query("p5_outcome_label", oracle("""
SELECT loan_id, first_90dpd, window_end, default_within_24m FROM abt""", "abt"))
def _(spark, folder):
    return built_abt(spark, folder).select("loan_id", "first_90dpd", "window_end", "default_within_24m")


@query("p6_full_window_keeping_early_bads", oracle("""
SELECT vintage_q, COUNT(*) AS n, CAST(SUM(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS bads FROM (
  SELECT CAST(date_trunc('quarter', a.first_payment_date) AS DATE) AS vintage_q,
         COALESCE(h.f <= a.first_payment_date + INTERVAL 24 MONTH, FALSE) AS bad, h.l >= a.first_payment_date + INTERVAL 24 MONTH AS seen
  FROM acq a JOIN (SELECT loan_id, MAX(report_month) AS l,
                          MIN(CASE WHEN TRY_CAST(dq_status AS INT) >= 3 THEN report_month END) AS f FROM perf GROUP BY 1) h
    ON a.loan_id = h.loan_id) WHERE seen OR bad GROUP BY 1""", "acq", "perf"))
def _(spark, folder):
    kept = loans.label_loans(view(spark, folder, "acq"), view(spark, folder, "perf"), keep_early_bads=True)
    return kept.groupBy("vintage_q").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("default_within_24m").alias("bads"))


@query("p7_date_arithmetic", oracle("""
SELECT loan_id, CAST(date_trunc('quarter', first_payment_date) AS DATE) AS vintage_q,
       CAST(first_payment_date + INTERVAL 24 MONTH AS DATE) AS window_end FROM acq""", "acq"))
def _(spark, folder):
    return loans.with_window(view(spark, folder, "acq")).select("loan_id", "vintage_q", "window_end")


@query("a1_first_serious_delinquency", oracle("""
SELECT loan_id, MIN(report_month) AS first_90dpd FROM perf WHERE COALESCE(TRY_CAST(dq_status AS INT), -1) >= 3
GROUP BY loan_id""", "perf"))
def _(spark, folder):
    return loans.first_serious_delinquency(loans.with_delinquency(view(spark, folder, "perf")))


@query("a2_last_report_month", oracle("""
SELECT loan_id, MAX(report_month) AS last_perf_month FROM perf GROUP BY loan_id""", "perf"))
def _(spark, folder):
    return loans.last_report(view(spark, folder, "perf"))


@query("j1_labelled_loans", oracle("SELECT * FROM abt", "abt"))
def _(spark, folder):
    return built_abt(spark, folder).select(*ABT_COLUMNS)


@query("c1_build_loans_from_raw_files", oracle(
    "SELECT vintage_q, COUNT(*) AS n, CAST(SUM(CAST(default_within_24m AS INT)) AS BIGINT) AS bads, "
    "CAST(SUM(fico) AS BIGINT) AS fico_sum, COUNT(ltv) AS n_ltv, COUNT(dti) AS n_dti, MIN(last_perf_month) AS min_last, "
    "MAX(first_90dpd) AS max_late FROM abt2 GROUP BY 1",
    "acq_raw", "perf_raw", acq2=ACQ_FROM_RAW, perf2=PERF_FROM_RAW, abt2=ABT_FROM_RAW))
def _(spark, folder):
    from vintagemill.plans import jobs
    root = raw_root(spark, folder)
    out = session.fresh_path(spark, "abt")
    jobs.build_loans(spark, f"{root}/acq", f"{root}/perf", out)
    return tables.read_dataset(spark, out).groupBy("vintage_q").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("default_within_24m").alias("bads"),
        F.sum("fico").alias("fico_sum"), F.count("ltv").alias("n_ltv"), F.count("dti").alias("n_dti"),
        F.min("last_perf_month").alias("min_last"), F.max("first_90dpd").alias("max_late"))


@query("c2_combine_datasets", oracle("""
SELECT vintage_q, COUNT(*) AS n, ROUND(AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END), 6) AS bad_rate
FROM abt GROUP BY 1""", "abt"))
def _(spark, folder):
    from vintagemill.plans import jobs
    whole = abt(spark, folder)
    paths = []
    for early in (True, False):
        part = whole.filter((F.year("vintage_q") < 1997) == F.lit(early))
        paths.append(session.fresh_path(spark, "part"))
        tables.write_dataset(part, paths[-1])
    out = session.fresh_path(spark, "combined")
    return jobs.combine_loans(spark, paths, out).withColumn("bad_rate", F.round("bad_rate", 6))


@query("s5_parquet_scan", oracle("SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"))
def _(spark, folder):
    return tables.read_dataset(spark, f"{folder}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("s6_projected_filtered_scan", oracle("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE l_shipdate BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND l_returnflag IS NOT NULL"""))
def _(spark, folder):
    dated = F.col("l_shipdate").between(F.lit("1997-01-01").cast("timestamp"), F.lit("1997-12-31").cast("timestamp"))
    return tables.read_dataset(
        spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_linenumber", "l_quantity"],
        dated & F.col("l_returnflag").isNotNull())


@query("s7_union_scan", oracle("""
SELECT COUNT(*) AS n, COUNT(o_orderkey) AS n_orders, COUNT(c_custkey) AS n_customers FROM (
  SELECT o_orderkey, NULL AS c_custkey FROM orders UNION ALL SELECT NULL, c_custkey FROM customer)"""))
def _(spark, folder):
    both = tables.read_union(spark, [f"{folder}/orders.parquet", f"{folder}/customer.parquet"])
    return both.agg(F.count(F.lit(1)).alias("n"), F.count("o_orderkey").alias("n_orders"),
                    F.count("c_custkey").alias("n_customers"))


@query("u1_union_all", oracle("""
SELECT loan_id, default_within_24m FROM abt WHERE default_within_24m
UNION ALL SELECT loan_id, default_within_24m FROM abt WHERE NOT default_within_24m""", "abt"))
def _(spark, folder):
    df = abt(spark, folder).select("loan_id", "default_within_24m")
    paths = [session.fresh_path(spark, "part") for _ in range(2)]
    for path, rows in zip(paths, (df.filter("default_within_24m"), df.filter(~F.col("default_within_24m")))):
        tables.write_dataset(rows, path)
    return tables.read_union(spark, paths)


@query("s10_partitioned_parquet_sink", oracle("SELECT * FROM abt", "abt"))
def _(spark, folder):
    path = session.fresh_path(spark, "by-vintage")
    tables.write_dataset(built_abt(spark, folder), path, partition_by=["vintage_q"])
    return tables.read_dataset(spark, path).select(*ABT_COLUMNS)


@query("s11_sample_sink", oracle("""
SELECT loan_id, vintage_q FROM abt ORDER BY md5(concat(CAST(loan_id AS STRING), ':13')), loan_id LIMIT 5000""", "abt"))
def _(spark, folder):
    path = session.fresh_path(spark, "sample")
    tables.write_dataset(sampling.sample_rows(abt(spark, folder), 5000), path)
    return tables.read_dataset(spark, path, ["loan_id", "vintage_q"])


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


RATE = "ROUND(AVG(CASE WHEN default_within_24m THEN 1.0E0 ELSE 0.0E0 END), 6) AS bad_rate"


@query("a3_volume_and_bad_rate", oracle(f"SELECT COUNT(*) AS n, {RATE} FROM abt", "abt"))
def _(spark, folder):
    return rounded(summaries.volume_and_bad_rate(abt(spark, folder)), "bad_rate")


@query("a4_bad_rate_by_vintage", oracle(f"SELECT vintage_q, COUNT(*) AS n, {RATE} FROM abt GROUP BY 1", "abt"))
def _(spark, folder):
    return rounded(summaries.by_vintage(built_abt(spark, folder)), "bad_rate")


@query("a5_largest_states", oracle(f"""
SELECT state, COUNT(*) AS n, {RATE} FROM abt GROUP BY 1 ORDER BY n DESC, state LIMIT 25""", "abt"))
def _(spark, folder):
    return rounded(summaries.largest_groups(abt(spark, folder), "state", 25), "bad_rate")


@query("a6_channel_purpose", oracle(f"SELECT channel, purpose, COUNT(*) AS n, {RATE} FROM abt GROUP BY 1, 2", "abt"))
def _(spark, folder):
    return rounded(summaries.by_pair(abt(spark, folder), "channel", "purpose"), "bad_rate")


def _labelled(feature: str, compat: bool) -> str:
    from vintagemill.functions.bins import LABELLED_BINS
    edges, labels = LABELLED_BINS[feature]
    used = edges[:-1] if compat else edges
    cases = " ".join(f"WHEN {feature} <= {e} THEN '{lab}'" for e, lab in zip(used, labels))
    null = "" if compat else f"WHEN {feature} IS NULL THEN NULL "
    return (f"SELECT '{feature}' AS feature, CASE {null}{cases} ELSE '{labels[-1]}' END AS bin, COUNT(*) AS n, {RATE} "
            f"FROM abt GROUP BY 1, 2")


def _all_labelled(compat: bool):
    def run(spark, folder):
        df = abt(spark, folder)
        parts = [summaries.by_labelled_bin(df, f, compat).withColumn("feature", F.lit(f)) for f in ("fico", "ltv", "dti")]
        return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), "bad_rate")
    return run


for _name, _compat in (("a7_labelled_bins", False), ("p22_labelled_bins_compat", True)):
    _sql = " UNION ALL ".join(_labelled(f, _compat) for f in ("fico", "ltv", "dti"))
    query(_name, oracle(_sql, "abt"))(_all_labelled(_compat))


INTERVALS = f"""
SELECT position, interval, COUNT(*) AS n, {RATE} FROM (
  SELECT default_within_24m, CASE WHEN fico < 500 THEN NULL WHEN fico <= 580 THEN 0 WHEN fico <= 620 THEN 1 WHEN fico <= 660 THEN 2
    WHEN fico <= 700 THEN 3 WHEN fico <= 740 THEN 4 WHEN fico <= 780 THEN 5 WHEN fico <= 850 THEN 6 END AS position,
  CASE WHEN fico < 500 THEN NULL WHEN fico <= 580 THEN '(499.999, 580.0]' WHEN fico <= 620 THEN '(580.0, 620.0]'
    WHEN fico <= 660 THEN '(620.0, 660.0]' WHEN fico <= 700 THEN '(660.0, 700.0]' WHEN fico <= 740 THEN '(700.0, 740.0]'
    WHEN fico <= 780 THEN '(740.0, 780.0]' WHEN fico <= 850 THEN '(780.0, 850.0]' END AS interval FROM abt)
WHERE position IS NOT NULL GROUP BY 1, 2"""


@query("p23_interval_bins", oracle(INTERVALS, "abt"))
def _(spark, folder):
    return rounded(summaries.by_interval(abt(spark, folder), "fico"), "bad_rate")


@query("o1_ordered_table", oracle(f"""
SELECT state, COUNT(*) AS n, {RATE} FROM abt GROUP BY 1 ORDER BY bad_rate DESC, state""", "abt"))
def _(spark, folder):
    df = rounded(summaries.volume_and_bad_rate(abt(spark, folder), ["state"]), "bad_rate")
    return df.orderBy(F.desc("bad_rate"), "state")


@query("o2_top_rows", oracle("SELECT loan_id, orig_upb FROM abt ORDER BY orig_upb DESC, loan_id LIMIT 25", "abt"))
def _(spark, folder):
    return abt(spark, folder).select("loan_id", "orig_upb").orderBy(F.desc("orig_upb"), "loan_id").limit(25)


@query("o4_head_preview", oracle(f"""
SELECT vintage_q, COUNT(*) AS n, {RATE} FROM abt GROUP BY 1 ORDER BY 1 LIMIT 12""", "abt"))
def _(spark, folder):
    return rounded(summaries.by_vintage(abt(spark, folder)).limit(12), "bad_rate")


@query("u2_distinct_domain", oracle("SELECT DISTINCT state FROM abt WHERE state IS NOT NULL", "abt"))
def _(spark, folder):
    return macro.states_present(abt(spark, folder))


@query("w6_top_states_per_vintage", oracle("""
SELECT vintage_q, state, n, rank FROM (SELECT vintage_q, state, n, row_number() OVER (PARTITION BY vintage_q ORDER BY n DESC, state) AS rank
  FROM (SELECT vintage_q, state, COUNT(*) AS n FROM abt GROUP BY 1, 2)) WHERE rank <= 3""", "abt"))
def _(spark, folder):
    counts = abt(spark, folder).groupBy("vintage_q", "state").agg(F.count(F.lit(1)).alias("n"))
    return summaries.top_per_group(counts, ["vintage_q"], [F.desc("n"), F.asc("state")], 3).select(
        "vintage_q", "state", "n", F.col("rank").cast("bigint").alias("rank"))
