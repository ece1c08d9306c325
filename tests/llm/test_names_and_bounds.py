"""Column names that clash with an operator's own, bounded mixing weights, a session made first."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from letwise.llm import decontaminate, lines, mixing, near, pii, urls

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DOCS = [(i, f"line one {i}\nshared footer\nwords of page {i % 3}", "s") for i in range(12)] + [(99, None, None)]


def docs(spark, *clashing):
    f = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    return f.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in clashing])


def same(got, clashing):
    rows = got.collect()
    assert rows and all(r[c] == f"{c} {r['doc_id']}" for r in rows for c in clashing)
    return sorted(tuple(v for k, v in r.asDict().items() if k not in clashing) for r in rows if r["doc_id"] is not None and r["text"] is not None)


def cases(spark):
    items = spark.createDataFrame([(1, "words of page 2"), (2, "no such words at all")], "item_id int, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(12)], "doc_id long, quality int, toxic int")
    return [
        (lambda d: decontaminate.remove_contamination(d, items), ["__hits", "__clean", "c0"]),
        (lambda d: lines.drop_boilerplate(d, ratio=0.5), ["__host", "__lines", "__key", "__kept", "c1"]),
        (lambda d: lines.drop_boilerplate(d, ratio=0.5, copies_once=True), ["__host", "__lines", "crowded", "c2"]),
        (lambda d: near.drop_near_copies(d, 80), ["__gone", "cid", "c0"]),
        (lambda d: mixing.mix_documents(d, labels), ["__e", "__words", "__buckets", "__id", "c1"]),
        (lambda d: pii.find_pii(d), ["pos", "found", "tail"])]


@pytest.mark.parametrize("k", range(6))
def test_clashing_names_change_nothing(spark, k):
    run, clashing = cases(spark)[k]
    assert same(run(docs(spark, *clashing)), clashing) == same(run(docs(spark)), [])


def test_clashing_names_of_url_verdicts(spark):
    rules = urls.rule_table(spark, [("com", "/", "allow"), ("b.com", "/en/", "block")])
    pages = spark.createDataFrame([(1, "http://a.b.com/en/x"), (2, "https://b.com/"), (3, None), (4, "http://x.org/?")], "page_id long, url string")
    clashing = ["__u", "__rule", "__verdict", "__key", "c0", "u", "place"]
    more = pages.select("*", *[F.lit(c).alias(c) for c in clashing])
    got = urls.url_verdicts(more, rules)
    assert all(r[c] == c for r in got.collect() for c in clashing)
    assert sorted(map(tuple, got.drop(*clashing).collect())) == sorted(map(tuple, urls.url_verdicts(pages, rules).collect()))


# --------------------------------------------------------------------------- bounded weights
TABLE = [[0.97, 0.01, 0.02], [0.90, 0.02, 0.08], [0.70, 0.10, 0.20], [0.20, 0.10, 0.70], [0.1, 0.9, 0.0], [0.3, 0.3, 0.4]]
TOKENS = [40, 1500, 900, 300, 200, 0]


@pytest.mark.parametrize("ridge", [0.001, 0.01, 0.3])
def test_bounded_rates_solve_the_least_squares(ridge):
    """No feasible point near the solution, nor any of many others, has a smaller loss; computed anew with numpy."""
    least, most = 0.05, 4.0
    rates = np.array(mixing.fit_rates(TOKENS, TABLE, [0.93, 0.05, 0.02], ridge=ridge, least=least, most=most))
    q, w = np.array(TABLE), np.array(TOKENS) / sum(TOKENS)
    shares = w @ q
    aim = np.array(mixing.reachable([0.93, 0.05, 0.02], shares.tolist()))

    def loss(r):
        off = (r * w) @ q - aim
        return float((off * off / shares).sum() + ridge * (w * (r - 1) ** 2).sum())

    assert rates.min() >= least and rates.max() <= most
    rng = np.random.default_rng(1)
    here = loss(rates)
    for size in (1e-4, 1e-2, 0.3, 2.0):
        for _ in range(300):
            assert loss(np.clip(rates + size * rng.normal(size=len(rates)), least, most)) >= here - 1e-9


def test_production_weights_keep_the_corpus(spark):
    """sf0.1 as a whole: a large effective sample, bounded rates, no labelled clean document out of the mix."""
    sf = "/root/testdata/sf0.1"
    d, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = mixing.mix_documents(d, labels, columns=["doc_id"]).toPandas()
    rate, n = rows["mix_rate"].to_numpy(), rows["n_tokens"].to_numpy()
    assert rate.sum() ** 2 / (rate ** 2).sum() >= 0.3 * len(rate)
    assert rate.min() >= mixing.LEAST_RATE and rate.max() <= mixing.MOST_WEIGHT
    share = {k: (n * rows[f"p_{k}"]).sum() / n.sum() for k in mixing.TARGETS}
    mixed = {k: (rate * n * rows[f"p_{k}"]).sum() / (rate * n).sum() for k in mixing.TARGETS}
    assert len(set(rows["p_toxic"])) >= 50          # posteriors follow the evidence
    gap = lambda x: sum(abs(x[k] - t) for k, t in mixing.TARGETS.items())
    assert gap(mixed) < 0.35 * gap(share)
    clean = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    assert (rows[rows["doc_id"].isin(clean)]["mix_rate"] < 0.05).mean() < 0.01


def test_posteriors_solve_the_regression():
    """The slope of the penalised loss, computed anew row by row, is nought at the weights."""
    rng = np.random.default_rng(5)
    rows = mixing._features(rng.integers(0, (mixing.levels(3) + 1) ** 3, 200), 3)
    counts = rng.integers(0, 9, (200, 3)).astype(float)
    w = mixing._regression(rows, counts)
    slope = mixing.PULL * w * np.array([0.001] + [1.0] * (rows.shape[1] - 1))[:, None]
    for x, c in zip(rows, counts):
        e = np.exp(x @ w)
        slope += np.outer(x, c.sum() * e / e.sum() - c)
    assert np.abs(slope).max() < 1e-2
    assert not mixing._regression(rows, counts * 0).any()
    one = mixing._regression(rows, counts * [1, 0, 0])          # domains without a labelled row
    assert (mixing._softmax(rows @ one)[:, 0] > 0.99).all()


@pytest.mark.parametrize("domains", range(1, 13))
def test_evidence_is_bounded(domains):
    assert (mixing.levels(domains) + 1) ** domains <= mixing.CLASSES and mixing.levels(domains) >= 1


# --------------------------------------------------------------------------- other
def test_workers_import_the_package_in_a_session_made_first():
    code = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.range(1).rdd.map(lambda r: r).collect()
import sys
sys.path.insert(0, %r)
import __spark_entry__ as e
print("rows", e.queries()["op2_decontamination"](spark, "/root/testdata/sf0.001").count())
""" % HERE
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=240)
    assert "rows 200" in done.stdout, done.stderr[-2000:]
