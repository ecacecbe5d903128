"""Column functions on hand-made rows."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vintagemill.functions import bins, codes, dates, numeric


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def values(spark, data, column, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_month_formats(spark):
    got = values(spark, ["201702", "2017-02-15", "junk", None, "201713"], dates.parse_month("v"), "string")
    assert got == [dt.date(2017, 2, 1), dt.date(2017, 2, 1), None, None, None]


def test_vintage_formats(spark):
    data = ["2021-05-07", "2021Q3", "2021-q4", "2021-07", "2021/7", "later", None]
    got = values(spark, data, dates.parse_vintage("v"), "string")
    days = [(5, 7), (7, 1), (10, 1), (7, 1), (7, 1)]
    assert got == [dt.date(2021, m, d) for m, d in days] + [None, None]
    assert values(spark, data, dates.vintage_year("v"), "string") == [2021] * 5 + [None, None]


def test_delinquency_codes(spark):
    data = ["0", "03", "RA", None, "12"]
    assert values(spark, data, numeric.delinquency_number("v"), "string") == [0, 3, -1, -1, 12]
    assert values(spark, data, numeric.delinquency_number("v", ["RA"]), "string") == [0, 3, 3, -1, 12]


def test_clip_keeps_null_and_bounds_sentinels(spark):
    assert values(spark, [999.0, -1.0, 40.0, None], numeric.clip("v", 0.0, 65.0)) == [65.0, 0.0, 40.0, None]
    assert values(spark, [85.0, 70.0, None], numeric.excess_over("v", 80)) == [5.0, 0.0, None]


def test_to_double_turns_nan_and_text_into_null(spark):
    assert values(spark, [float("nan"), 1.5, None], numeric.to_double("v")) == [None, 1.5, None]
    assert values(spark, ["2.5", "n/a", "NaN"], numeric.to_double("v"), "string") == [2.5, None, None]


def test_platt_modes(spark):
    row = one(
        spark, numeric.platt(F.lit(0.2), -1.0, 1.5), numeric.platt(F.lit(0.2), -1.0, 1.5, "linear"),
        numeric.platt(F.lit(0.2), None, None), numeric.platt(F.lit(0.0), 0.0, 1.0))
    expected = 1 / (1 + math.exp(1.0 - 1.5 * math.log(0.25)))
    assert row[0] == pytest.approx(expected) and row[1] == pytest.approx(1 / (1 + math.exp(1.0 - 0.3)))
    assert row[2] == 0.2 and row[3] == pytest.approx(1e-6)
    with pytest.raises(ValueError):
        numeric.platt(F.lit(0.2), 0.0, 1.0, "cubic")


def test_approval_at_the_threshold_and_for_null(spark):
    assert values(spark, [0.1, 0.2, 0.3, None], numeric.approves("v", 0.2)) == [True, True, False, False]
    assert values(spark, [0.1, 0.2, 0.3, None], numeric.approves("v", 0.2, strict=True)) == [True, False, False, False]


def test_ks_from_counts_is_zero_without_a_class(spark):
    row = one(spark, numeric.ks_from_counts(*[F.lit(x) for x in (3, 1, 9, 1)]),
              numeric.ks_from_counts(*[F.lit(x) for x in (0, 4, 4, 0)]),
              numeric.ks_from_counts(*[F.lit(x) for x in (0, 4, 0, 4)]))
    assert row[0] == pytest.approx(0.75 - 0.1) and row[1] == 0.0 and row[2] == 0.0


def test_labelled_bins(spark):
    edges, labels = bins.LABELLED_BINS["fico"]
    data = [620.0, 621.0, 750.0, 790.0, None]
    assert values(spark, data, bins.labelled_bins("v", edges, labels)) == ["<=620", "621-660", "741-780", ">780", None]
    compat = values(spark, data, bins.labelled_bins("v", edges, labels, compat=True))
    assert compat == ["<=620", "621-660", ">780", ">780", ">780"]


def test_interval_bins_match_pandas_cut(spark):
    for feature, edges in bins.INTERVAL_EDGES.items():
        data = [float(e) for e in edges] + [edges[0] - 1.0, edges[-1] + 1.0, edges[1] + 0.5, None]
        cut = pd.cut(pd.Series(data, dtype=float), bins=edges, include_lowest=True)
        expected = [None if pd.isna(x) else str(x) for x in cut]
        assert values(spark, data, bins.interval_label("v", edges)) == expected, feature
        positions = values(spark, data, bins.right_closed_bin("v", edges))
        assert positions == [None if c < 0 else c for c in cut.cat.codes.tolist()]


def test_left_closed_bins_match_histogram_with_repeated_edges(spark):
    edges = [0.0, 1.0, 1.0, 2.0, 3.0, 3.0]
    data = [0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, -0.1, 3.1]
    got = [b for b in values(spark, data, bins.left_closed_bin("v", edges)) if b is not None]
    assert np.bincount(got, minlength=5).tolist() == np.histogram(data, bins=edges)[0].tolist()


def test_uniform_bins(spark):
    inner = np.linspace(0, 1, 21)[1:-1]
    data = [0.0, 0.05, 0.051, 0.15, 0.3, 0.999, 1.0]
    assert values(spark, data, bins.uniform_bin("v", 20)) == np.searchsorted(inner, data).tolist()


def test_codes(spark):
    got = values(spark, ["Texas", "Atlantis", None], codes.code_of("v", codes.STATE_CODES), "string")
    assert got == ["TX", None, None]
    assert values(spark, ["P", None], codes.one_hot("v", "purpose", ["P"])[0], "string") == [1.0, 0.0]


def test_numbers_and_dates_in_all_written_forms(spark):
    got = values(spark, ["720.0", "720.6", "7e2", " 45 ", "-3", "junk", "", None, "99999999999", "+", "1e999"], dates.parse_int("v"), "string")
    assert got == [720, 721, 700, 45, -3, None, None, None, None, None, None]
    got = values(spark, ["2019-3-1", " 201903", "2019-03-01 ", "2019-02-30", "20193", "2019-03-01 00:00:00"], dates.parse_month("v"), "string")
    march = dt.date(2019, 3, 1)
    assert got == [march, march, march, None, None, march]
    assert values(spark, ["2021-07-01 00:00:00"], dates.parse_vintage("v"), "string") == [dt.date(2021, 7, 1)]
