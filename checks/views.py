"""Credit-shaped views over the provided tables.

``orders`` are the loans, ``lineitem`` the monthly reports, ``customer`` and
``nation`` give the state.  Each view is one SQL text that Spark and DuckDB read
alike; the oracles inline it as a CTE, while the queries take only the raw-shaped
inputs from here and compute everything after that with the library.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Raw text columns, addressed by file position; two month formats and some junk.
RAW_LOANS = """
SELECT o.o_orderkey AS k, o.o_totalprice AS upb, o.o_orderdate AS d, o.o_orderpriority AS channel,
       o.o_orderstatus AS purpose, n.n_name AS state, c.c_nationkey AS nk, c.c_mktsegment AS seg,
       300 + (o.o_orderkey * 37 + o.o_custkey * 11) % 551 AS fico
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

ACQ_RAW = """
SELECT CAST(fico AS STRING) AS c0,
       CASE WHEN k % 500 = 11 THEN 'junk'
            WHEN k % 2 = 0 THEN CAST(year(d) * 100 + month(d) AS STRING)
            ELSE CAST(CAST(d AS DATE) AS STRING) END AS c1,
       CASE k % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE '9' END AS c2,
       'x' AS c3,
       CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(nk * 1000 AS STRING) END AS c4,
       'x' AS c5,
       CAST(1 + k % 5 AS STRING) AS c6,
       CASE k % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'S' ELSE 'P' END AS c7,
       CAST(35 + (k * 17) % 100 AS STRING) AS c8,
       CASE WHEN k % 50 = 7 THEN NULL WHEN k % 61 = 3 THEN '999' ELSE CAST((k * 7) % 72 AS STRING) END AS c9,
       CAST(CAST(floor(upb) AS BIGINT) AS STRING) AS c10,
       CASE WHEN k % 400 = 9 THEN 'n/a' ELSE CAST(30 + (k * 13) % 95 AS STRING) END AS c11,
       CAST(2.0E0 + CAST((k * 31) % 24 AS DOUBLE) / 4.0E0 AS STRING) AS c12,
       channel AS c13, 'x' AS c14, 'FRM' AS c15, state AS c16, seg AS c17, 'x' AS c18,
       CAST(k AS STRING) AS c19, purpose AS c20, CAST(40 + (k * 19) % 460 AS STRING) AS c21, 'x' AS c22,
       concat('SELLER ', CAST(nk % 7 AS STRING)) AS c23, concat('SERVICER ', CAST(k % 5 AS STRING)) AS c24
FROM raw_loans
"""

PERF_RAW = """
SELECT CAST(l_orderkey AS STRING) AS c0,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING)
            ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS c1,
       'x' AS c2,
       CASE WHEN l_returnflag = 'R' THEN concat('0', CAST(l_linenumber AS STRING))
            WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'RA' ELSE '00' END AS c3
FROM lineitem
"""

# Typed inputs, for queries that start after the raw files.
ACQ = """
SELECT k AS loan_id, CAST(fico AS INT) AS fico, CAST(date_trunc('month', d) AS DATE) AS first_payment_date,
       CAST(NULL AS DATE) AS orig_date, upb AS orig_upb,
       2.0E0 + CAST((k * 31) % 600 AS DOUBLE) / 100.0E0 AS orig_rate,
       CAST(30 + (k * 13) % 95 AS DOUBLE) AS ltv, CAST(35 + (k * 17) % 100 AS DOUBLE) AS cltv,
       CASE WHEN k % 50 = 7 THEN NULL WHEN k % 61 = 3 THEN 999.0E0 ELSE CAST((k * 7) % 72 AS DOUBLE) END AS dti,
       channel, purpose, CASE k % 4 WHEN 0 THEN 'I' WHEN 1 THEN 'S' ELSE 'P' END AS occupancy,
       'FRM' AS product, seg AS property_type, state,
       CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(nk * 1000 AS INT) END AS msa,
       CAST(40 + (k * 19) % 460 AS INT) AS loan_term, CAST(1 + k % 5 AS INT) AS num_units,
       concat('SELLER ', CAST(nk % 7 AS STRING)) AS seller_name,
       concat('SERVICER ', CAST(k % 5 AS STRING)) AS servicer_name,
       CASE k % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END AS first_time_buyer
FROM raw_loans
"""

PERF = """
SELECT l_orderkey AS loan_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS report_month,
       CASE WHEN l_returnflag = 'R' THEN concat('0', CAST(l_linenumber AS STRING))
            WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN 'RA' ELSE '00' END AS dq_status
FROM lineitem
"""

MACRO_HPI = """
SELECT n.n_name AS state, m.month, 100.0E0 + (n.n_nationkey * 7 + m.k) % 40 AS hpi_index
FROM nation n CROSS JOIN (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
     (year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS k FROM orders) m
"""

MACRO_UNEMP = """
SELECT state, month, 3.0E0 + (hpi_index - 100.0E0) / 8.0E0 AS unemp_rate FROM macro_hpi
WHERE month(month) <> 6
"""

MACRO_RATE = """
SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       4.0E0 + (year(o_orderdate) * 12 + month(o_orderdate)) % 9 / 4.0E0 AS pmms_30y FROM orders
"""

# Below here: oracle-only views (the queries compute these with the library).
ABT = """
SELECT a.*, CAST(date_trunc('quarter', a.first_payment_date) AS DATE) AS vintage_q,
       CAST(a.first_payment_date + INTERVAL 24 MONTH AS DATE) AS window_end,
       h.last_perf_month, h.first_90dpd,
       (h.first_90dpd IS NOT NULL AND h.first_90dpd <= CAST(a.first_payment_date + INTERVAL 24 MONTH AS DATE))
         AS default_within_24m
FROM acq a JOIN (
  SELECT loan_id, MAX(report_month) AS last_perf_month,
         MIN(CASE WHEN COALESCE(TRY_CAST(dq_status AS INT), -1) >= 3 THEN report_month END) AS first_90dpd
  FROM perf GROUP BY loan_id) h ON a.loan_id = h.loan_id
WHERE h.last_perf_month >= CAST(a.first_payment_date + INTERVAL 24 MONTH AS DATE)
"""

PREDS = """
SELECT loan_id, state, channel, purpose, vintage_q, msa, CASE WHEN default_within_24m THEN 1 ELSE 0 END AS y_true,
       (CAST((850 - fico) * ltv AS BIGINT) % 997 + CASE WHEN default_within_24m THEN 400 ELSE 0 END + 1) / 1500.0E0
         AS y_pred
FROM abt
"""

VIEWS = {
    "raw_loans": (RAW_LOANS, ()),
    "acq_raw": (ACQ_RAW, ("raw_loans",)),
    "perf_raw": (PERF_RAW, ()),
    "acq": (ACQ, ("raw_loans",)),
    "perf": (PERF, ()),
    "macro_hpi": (MACRO_HPI, ()),
    "macro_unemp": (MACRO_UNEMP, ("macro_hpi",)),
    "macro_rate": (MACRO_RATE, ()),
    "abt": (ABT, ("acq", "perf")),
    "preds": (PREDS, ("abt",)),
}

# Split bounds that fit the vintages of the provided tables (1995Q1..1999Q4).
SPLIT_YEARS = {"train": (None, 1996), "valid": (1997, 1997), "test": (1998, 1998), "recent": (1999, None)}
SPLIT_SQL = (
    "CASE WHEN year(vintage_q) <= 1996 THEN 'train' WHEN year(vintage_q) = 1997 THEN 'valid' "
    "WHEN year(vintage_q) = 1998 THEN 'test' WHEN year(vintage_q) >= 1999 THEN 'recent' END"
)


def _ordered(names: tuple[str, ...], done: list[str]) -> list[str]:
    for name in names:
        if name not in done:
            _ordered(VIEWS[name][1], done)
            done.append(name)
    return done


def oracle(body: str, *views: str, **extra: str) -> str:
    """``WITH`` the named views, then extra CTEs, then the body."""
    ctes = [f"{n} AS ({VIEWS[n][0].strip()})" for n in _ordered(views, [])]
    ctes += [f"{n} AS ({q.strip()})" for n, q in extra.items()]
    return f"WITH {', '.join(ctes)}\n{body.strip()}" if ctes else body.strip()


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the input views above, evaluated by Spark."""
    sources = {t: table(spark, folder, t) for t in ("orders", "customer", "nation", "lineitem")}
    bound = {t: t for t in sources}
    for needed in _ordered((name,), []):
        text = VIEWS[needed][0]
        sources[needed] = spark.sql(_braced(text, bound), **{t: sources[t] for t in bound if _uses(text, t)})
        bound[needed] = needed
    return sources[name]


def _uses(text: str, name: str) -> bool:
    return f"FROM {name}" in text or f"JOIN {name}" in text


def _braced(text: str, bound: dict[str, str]) -> str:
    for name in sorted(bound, key=len, reverse=True):
        for word in ("FROM", "JOIN"):
            for end in (" ", "\n", ")"):
                text = text.replace(f"{word} {name}{end}", f"{word} {{{name}}}{end}")
    return text
