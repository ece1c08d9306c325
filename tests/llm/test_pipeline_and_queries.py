"""The pipeline stage by stage, and the registration of the queries."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from check_oracle import TABLES, rows_of
from letwise.llm import queries

SF = "/root/testdata/sf0.001"
NATIVE = ["op1_url_filters", "op5_line_dedup", "op8_pii", "op10_mixing"]


def test_all_thirteen_operators_and_the_pipeline_are_registered():
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert E.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination",
        "mixing sources to target weights"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    cols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def stage(k):
    return corpus_pipeline.STAGES[k][1]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x") for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, extra string")


def words(tag, n):
    return " ".join(f"{tag}{k}" for k in range(n))


def test_stages_keep_columns_and_clean_documents(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    rows = [(i, f"site menu\n{words(f'd{i}x', 60)}", "hot") for i in range(10, 30)]
    rows += [(1, words("base", 80), "a"), (2, words("base", 79) + " other", "b"), (3, words("base", 80), "a")]
    rows += [(4, items[0]["text"], "c"), (5, f"{words('long', 900)} {items[1]['text']} end", "c"), (6, None, "c"), (7, "", "c")]
    docs = documents(spark, rows)
    kept = stage(1)(spark, docs, SF)
    assert kept.columns == docs.columns
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect()}
    assert len(got) == len(rows) and got[10] == (words("d10x", 60), len(words("d10x", 60))) and got[6] == (None, 0)
    near = stage(2)(spark, docs, SF)
    assert near.columns == docs.columns
    assert {r["doc_id"] for r in near.collect()} == {r[0] for r in rows} - {2, 3}
    clean = stage(3)(spark, docs, SF)
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert clean.columns == docs.columns and 4 not in got
    assert got[5].startswith(words("long", 900)) and len(got[5].split()) < 905 and got[6] is None
    assert {r[0] for r in rows} - {4} == set(got)
    mixed = stage(4)(spark, docs, SF).collect()
    assert {r["doc_id"] for r in mixed} == {r[0] for r in rows} and all(r["mix_rate"] > 0 for r in mixed)


def test_a_group_of_copies_keeps_one_whole_document(spark):
    def page(tag, changed=None):
        return "\n".join(words(f"{tag}{j}x", 12) + (" changed" if j == changed else "") for j in range(10))

    rows = [(i, f"site menu\n{page(f'own{i}')}", "hot") for i in range(200)]
    rows += [(1000 + i, page("exact"), "hot") for i in range(100)]
    rows += [(2000 + i, page("near", i % 11), "hot") for i in range(60)]
    rows += [(3000 + i, page("few"), "small") for i in range(3)] + [(3100, page("other"), "small")]
    docs = documents(spark, rows)
    for k in (1, 2):
        docs = stage(k)(spark, docs, SF)
    got = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(got) == {*range(200), 1000, 2000, 3000, 3100}
    assert all(got[i] == page(f"own{i}") for i in range(200))
    assert got[1000] == page("exact") and got[2000] == page("near", 0)
    assert got[3000] == page("few") and got[3100] == page("other")


def test_mixing_stage_keeps_documents_of_rate_0(spark, monkeypatch):
    rated = F.when(F.col("doc_id") % 2 == 0, 0.0).otherwise(1.0)
    monkeypatch.setattr(corpus_pipeline.mixing, "mix_documents", lambda docs, labels: docs.withColumn("mix_rate", rated))
    out = stage(4)(spark, documents(spark, [(i, "meadow", "s") for i in range(6)]), SF).collect()
    assert {r["doc_id"]: r["mix_rate"] for r in out} == {i: float(i % 2) for i in range(6)}


def test_stages_take_empty_tables(spark):
    none = documents(spark, [])
    for _, run in corpus_pipeline.STAGES:
        none = run(spark, none, SF)
        assert none.count() == 0


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, run in corpus_pipeline.STAGES:
        docs = run(spark, docs, SF)
    want = sorted(map(tuple, docs.select("doc_id", "text", "n_tokens", "mix_rate").collect()), key=repr)
    out = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, out.select("doc_id", "text", "n_tokens", "mix_rate").collect()), key=repr) == want
    assert 0 < out.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
