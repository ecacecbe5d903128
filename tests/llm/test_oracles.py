"""The SQL oracles on rows made for them, and the whole pipeline against its parts."""

import duckdb
import pandas as pd

import corpus_pipeline
from checks.run import differences
from tests.llm.test_text_groups import LINK_FORMS, PAGES, some_texts
from vintagemill.llm.queries import ORACLES, QUERIES


def compare(spark, tmp_path, name, table, df):
    df.write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    assert differences(QUERIES[name](spark, str(tmp_path)), ORACLES[name], con) == []


def test_url_filter_oracle(spark, tmp_path):
    compare(spark, tmp_path, "op1_url_filter", "pages", spark.createDataFrame(PAGES + [r[:3] for r in LINK_FORMS], "page_id int, url string, html string"))


def test_near_duplicate_oracle(spark, tmp_path):
    compare(spark, tmp_path, "op6_bottomk_near_dedup", "documents", spark.createDataFrame(some_texts(), "doc_id long, text string"))


def test_near_vector_oracle(spark, tmp_path):
    rows = [(i, [float(i % 7 == j) + 0.001 * i for j in range(8)]) for i in range(40)] + [(50, None), (51, [0.0] * 8)]
    compare(spark, tmp_path, "op9_cap_filters", "embeddings", spark.createDataFrame(rows, "vec_id long, embedding array<float>"))


def test_pipeline(spark, tmp_path):
    words = [f"{a}{b}" for a in ("ba", "lo", "mi", "ru") for b in ("ne", "sta", "vor", "qui", "len")]
    rows, labels = [], []
    for i in range(160):
        body = [words[(i * 7 + j * (1 + i % 11) + j * j) % len(words)] + str(i % 3 * j % 5) for j in range(60)]
        good = i % 8 != 0
        rows.append((i, " ".join(body) if good else " ".join(w.upper() + "!!" for w in body), "en", f"src{i % 3}", None))
        labels.append((i, int(good), 0))
    rows.append((500, rows[1][1], "en", "src9", None))  # a copy
    rows.append((501, rows[3][1] + " write to me@firm.org now", "en", "src9", None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df = df.selectExpr("doc_id", "text", "lang", "source", "CAST(length(text) AS BIGINT) AS n_chars")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = df, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert docs.columns == df.columns
            docs.write.parquet(f"{tmp_path}/{name}")
            docs = spark.read.parquet(f"{tmp_path}/{name}")
            kept[name] = {r.doc_id: r for r in docs.collect()}
    assert {i for i in range(160) if i % 8} | {500, 501} == set(kept["quality"])
    assert 500 not in kept["near_duplicates"] and 1 in kept["near_duplicates"]
    assert set(kept["personal_data"]) == set(kept["near_duplicates"])
    assert all("@" not in r.text and r.n_chars == len(r.text) for r in kept["personal_data"].values())
    placed = docs.toPandas()
    assert set(placed.doc_id) == set(kept["personal_data"]) and (placed.groupby("sequence_id").length.sum() <= 2048).all()
    whole = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    columns = ["doc_id", "piece", "ids_crc32"]
    assert pd.DataFrame.equals(*[d[columns].sort_values(columns).reset_index(drop=True) for d in (placed, whole)])
