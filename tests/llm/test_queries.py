"""The registered corpus queries on the smallest tables, and the pipeline stage by stage."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemill.llm import exact, packing, queries, secrets, simhash

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(cur.fetchall(), key=str)


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)] + ["pipeline"]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA).cache()
        assert out.columns == columns and out.select("doc_id").distinct().count() == out.count() <= before
        if name == "quality":
            labels = spark.read.parquet(f"{DATA}/labels.parquet")
            good = docs.join(labels.filter("quality = 1"), "doc_id").count()
            assert out.join(labels.filter("quality = 1"), "doc_id").count() >= 0.97 * good
        elif name == "exact_dedup":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in exact.exact_groups(docs).filter("kept").collect()}
        elif name == "near_dedup":
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in simhash.near_groups(docs).filter("doc_id = component_id").collect()}
        else:
            assert out.count() == before and secrets.report(out).filter("n_assign + n_access + n_hex > 0").count() == 0
        docs, before = out, out.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert pieces.select("doc_id").distinct().count() == before
    assert pieces.agg(F.sum("length")).head()[0] == packing.tokenised(docs).agg(F.sum("n")).head()[0]


def test_pipeline_end_to_end_on_odd_rows(spark, tmp_path):
    """Null and empty texts, null ids, repeated rows, columns with clashing names and an empty table through ``run``."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept int, score double"
    rng = random.Random(2)
    prose = lambda: " ".join(rng.choices([f"{a}{b}" for a in ("river", "town", "field", "stone", "lamp") for b in ("s", "ing", "ed", "er", "like", "side", "")], k=70))
    good = [(k, prose(), "en", f"s{k % 3}", 0, 1, 0.5) for k in range(30)]
    bad = [(100 + k, "$$$ buy !!! click " * (k + 3), "en", "spam", 0, 1, 0.5) for k in range(30)]
    odd = [(200, None, None, None, None, None, None), (201, "", "en", "", 0, 1, 0.1), (None, prose(), "en", "s1", 0, 1, 0.1), (5, good[5][1], "en", "s2", 0, 1, 0.5), (202, good[6][1].replace(" ", "  "), "en", "s0", 0, 1, 0.5)]
    for name, rows in (("full", good + bad + odd), ("empty", [])):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / name / "documents.parquet"))
        labels = [(k, 1, 0) for k in range(30)] + [(100 + k, 0, 0) for k in range(30)]
        spark.createDataFrame(labels if rows else [], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / name / "labels.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path / "full")).collect()
    whole = {}
    for r in sorted(pieces, key=lambda r: (str(r.doc_id), r.start)):
        whole.setdefault(r.doc_id, []).append(r)
    kept = set(whole)
    assert set(range(30)) <= kept and not kept & set(range(105, 130)) and None in kept and 202 not in kept
    assert all(sum(r.length for r in rows) % rows[0].doc_tokens == 0 for rows in whole.values())  # rows that repeat an id are each packed whole
    assert len({(r.sequence_id, r.offset) for r in pieces}) == len(pieces)
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
