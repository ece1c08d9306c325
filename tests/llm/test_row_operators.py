"""URL rules, decontamination, line dedup, personal data, quality, mixing: small fixtures and brute force."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from letwise.llm import decontaminate, lines, mixing, pii, quality, urls

DOCS = "doc_id long, text string, source string, n_words long, spans string, host string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x", "y") for i, t, s in rows], DOCS)


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


# ------------------------------------------------------------------ URLs
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr", "block"), ("a+b.org", "", "block"), ("", "/x", "block"), ("odd", "x", "block")]
URLS = ["https://example.com/en/1", "http://WWW.Example.com/en/1?x", "http://shop.example.com/en/", "http://example.com",
        "https://x.net/es/1", "https://x.net/es", "https://net/frame", "ftp://a+b.org", "ftp://a+b.organ/", "http://q.a+b.org?x#y",
        "no url", "", None, "http://", "x://y://z/w", "http://notcom/", "http://example.com/en/1", "http://com/a b\nc?d",
        "https://É.com/É"]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for h, p, v in RULES:
        if h and (not p or p[0] == "/") and (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or (-len(h + p), h + p) < (-len(best[0]), best[0]):
                best = (h + p, v)
    return host, path, best and best[0], best[1] if best else "allow"


def test_url_rules(spark):
    rows = [(k, u, "keep", "old") for k, u in enumerate(URLS + URLS[:2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, extra string, host string")
    out = urls.url_verdicts(pages, urls.rule_table(spark, RULES))
    assert no_python(out)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert got == {k: judged(u) for k, u, *_ in rows}
    assert out.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]


def test_pages_of_a_hot_url_are_dealt_over_keys(spark):
    """A third of the pages has one URL and a third has none; none of these meet under one key."""
    hot = "http://www.example.com/en/a"
    rows = [(k, [hot, None, f"http://h{k}.net/es/{k}"][k % 3], {"k": k}) for k in range(6000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, more map<string,int>")
    out = urls.url_verdicts(pages, urls.rule_table(spark, RULES))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect()}
    assert len(got) == 6000 and got == {k: judged(u) for k, u, _ in rows}
    plain, _ = urls.plainly_named(pages)
    dealt = plain.where("c0 % 3 < 2").groupBy(urls._dealt(plain).alias("salt")).count().collect()
    assert len(dealt) == urls.SALTS and max(r["count"] for r in dealt) < 150


def test_url_rules_on_nothing(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.url_verdicts(pages, urls.rule_table(spark, RULES)).count() == 0
    none = urls.url_verdicts(spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string"),
                             urls.rule_table(spark, []))
    assert none.first()["verdict"] == "allow"


# ------------------------------------------------------------------ decontamination
def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(text, items, window):
    w, hit, found = tokens(text), set(), set()
    for name, t in items:
        v = tokens(t)
        k = min(window, len(v))
        for a in range(len(v) - k + 1 if k else 0):
            for p in range(len(w) - k + 1):
                if w[p:p + k] == v[a:a + k]:
                    hit.update(range(p, p + k))
                    found.add("null" if name is None else str(name))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("item_chars", [60, 500_000])
def test_decontamination_matches_brute_force(spark, item_chars):
    rnd = random.Random(4)
    vocab = ["a", "B", "ça", "7", "the", "x"]
    def text(n):
        return rnd.choice([" ", ", ", "-"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.randint(1, 9))) for i in range(12)] + [(3, "the the"), (None, "a B x 7"), (50, None), (51, ""), (52, "!!")]
    docs = [(i, text(rnd.randint(0, 60)), "s") for i in range(60)] + [(90, None, "s"), (91, "", "s"), (92, "the " * 3000, "s"), (None, "a b x 7", "s")]
    got = decontaminate.match_items(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"),
                                    window=4, item_chars=item_chars)
    assert {(r["doc_id"], r["__hits"]["n_words"], r["__hits"]["n_hit"], tuple(r["__hits"]["items"])) for r in got.collect()} \
        == {(i, n, h, tuple(f)) for i, t, _ in docs for n, h, f in [brute_hits(t, items, 4)]}


def test_one_automaton_at_a_time(spark):
    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(6))) for i in range(20)], "item_id long, text string")
    docs = frame(spark, [(i, f"a w{i}x0 w{i}x1 w{i}x2 w{i}x3 b", "s") for i in range(20)])
    out = decontaminate.match_items(docs, items, window=4, item_chars=100)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert {(r["doc_id"], r["__hits"]["n_hit"], *r["__hits"]["items"]) for r in out.collect()} == {(i, 4, str(i)) for i in range(20)}


def test_contamination_is_cut_or_dropped(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    long_ = " ".join(f"w{i}" for i in range(400))
    docs = frame(spark, [(1, f"{long_} ONE, two three four five six seven eight nine ten eleven twelve thirteen. fourteen! tail", "s"),
                         (2, item, "s"), (3, long_, "s"), (4, None, "s"), (5, "", "s")])
    out = decontaminate.remove_contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: f"{long_} ! tail", 3: long_, 4: None, 5: ""}
    assert out.columns == docs.columns
    none = decontaminate.remove_contamination(docs, spark.createDataFrame([], "item_id long, text string"))
    assert none.count() == 5


# ------------------------------------------------------------------ lines
def test_boilerplate_lines_go(spark):
    rows = [(i, f"menu\nbody {i}\n menu \t\n\nmenu", "hot") for i in range(30)]
    rows += [(100 + i, "menu\nown", "cold") for i in range(2)] + [(200, None, "hot"), (201, "", "hot"), (202, "menu", None)]
    rows += [(300 + i, "null host line\nx", None) for i in range(4)]
    out = lines.drop_boilerplate(frame(spark, rows), ratio=0.5)
    assert no_python(out)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()}
    assert got[3] == ("body 3\n", 5, 3)
    assert got[100] == ("menu\nown", 2, 0)          # two pages are too few
    assert got[200] == (None, 0, 0) and got[201] == ("", 1, 0) and got[202] == ("menu", 1, 0)
    assert got[301] == ("", 2, 2)
    assert lines.drop_boilerplate(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ personal data
TEXTS = ["", None, "mail a@b.co, x.y+z@sub.mail-1.org; a@b", "a@b.c_d@e.f", "1.2.3.4 and 256.1.1.1 and 1.2.3.4.5.6.7.8",
         "00001.002.3.0255", "card 4111 1111 1111 1111 ok 4111111111111112", "4111-1111-1111-1111", "4" * 60,
         "call +49 (30) 123-4567. or +1 2", "+12 34 56 78 90 12 34 56 7", "é ñ 😀 mail me@x.io", "IBAN DE89370400440532013000 x",
         "iban GB82 WEST 1234 5698 7654 32", "DE89370400440532013001", "ssn 123-45-6789", "ref 123-45-6789",
         "a" * 20000 + "@b.c", "1 " * 20000, "1." * 9000, "a@b" + ".c" * 9000, "+" + "1(" * 9000, "%@%.%", "x@y.z\n@w.v"]


def brute_pii(text):
    text = text or ""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(reversed(d))) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


def test_personal_data(spark):
    docs = frame(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])
    out = pii.find_pii(docs)
    assert no_python(out)
    base = tuple(k.name for k in pii.KINDS if k.base)
    got = {r[0]: (r[1], r[2]) for r in out.select("doc_id", pii.span_list(F.col("spans"), base),
                                                 pii.span_list(F.col("spans"))).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i][0] == brute_pii(t), t and t[:60]
    assert "iban:5:27" in got[12][1] and "iban:5:32" in got[13][1] and "iban" not in got[14][1]
    assert "ssn:4:15" in got[15][1] and "ssn" not in got[16][1]
    assert pii.find_pii(frame(spark, [])).count() == 0


def test_secrets_need_length_alphabet_entropy_and_context(spark):
    hexes = "c80fd45a66f8564ae70609f7b2a26100e64e830e"
    texts = [f'token = "{hexes}"', f"commit {hexes}", f"x {hexes} y", f"{hexes} is the api key", f"PASSWORD: {hexes.upper()};",
             "token how-to-get-an-api-key-in-2024-guide", "token " + "a1" * 20, "token " + "a" * 30000, f"secret {hexes}@b.co",
             "token aK3x9QpL0zRt7VwY2mNc", "token aK3x9QpL0zRt7VwY2mN", "shared thing. token " + hexes]
    out = pii.find_pii(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).select("doc_id", F.filter(
        "spans", lambda x: x["kind"] == "secret").alias("s")).collect()
    got = {r["doc_id"]: [(x["start"], x["end"], x["score"]) for x in r["s"]] for r in out}
    assert got == {0: [(9, 49, 0.7)], 1: [], 2: [], 3: [(0, 40, 0.7)], 4: [(10, 50, 0.7)], 5: [], 6: [], 7: [], 8: [],
                   9: [(6, 26, 0.7)], 10: [], 11: [(20, 60, 0.7)]}


def test_context_raises_and_lowers_scores(spark):
    texts = ["server 1.2.3.4", "1.2.3.4 is the host", "release 1.2.3.4", "1.2.3.4", "host release 1.2.3.4", "order 123-45-6789 tax"]
    got = {r["doc_id"]: [x["score"] for x in r["spans"]] for r in
           pii.find_pii(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert got == {0: [0.9], 1: [0.9], 2: [0.3], 3: [0.6], 4: [0.6], 5: []}


@pytest.mark.parametrize("n", [1, 31, 32, 33, 1024, 5000])
def test_places_of_many_matches(spark, n):
    rnd = random.Random(n)
    text = "".join(rnd.choice(["a@b.co ", "é😀 x@y.z, ", "1.2.3.4 ", "999.1.1.1 ", "+49 123 4567 89;"]) for _ in range(n))
    spans = pii.find_pii(frame(spark, [(1, text, "s")])).select(
        pii.span_list(F.col("spans"), ("email", "ip", "card", "phone")).alias("s")).first()["s"]
    assert spans == brute_pii(text)


# ------------------------------------------------------------------ quality
def quality_rows():
    rnd = random.Random(9)
    good, bad = ["river", "morning", "window", "letters", "quiet"], ["click%%", "win$$$", "buy###", "free!!!"]
    return [(i, " ".join(rnd.choice(good if i % 3 else bad) for _ in range(30)), 1 if i % 3 else 0) for i in range(600)]


def test_quality_held_out_accuracy(spark):
    rows = quality_rows()
    docs = frame(spark, [(i, t, "s") for i, t, _ in rows] + [(9000, None, "s"), (9001, "", "s"), (None, "river", "s")])
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 0), (5, None, 0), (77777, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels)
    got = out.withColumn("held", quality.held_out(F.col("doc_id"))).collect()
    truth = {i: q for i, _, q in rows}
    held = [r for r in got if r["held"] and r["doc_id"] in truth]
    assert len(held) > 60 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert all(0 <= r["score"] <= 1 for r in got) and len(got) == len(rows) + 3
    assert len({r["score"] for r in got if not r["text"]}) == 1


def test_quality_sample_is_bounded_and_skips_held_out(spark):
    rows = quality_rows()
    docs = frame(spark, [(i, t, "s") for i, t, _ in rows])
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    assert len(quality.labelled_sample(docs, labels, rows=50)) == 50
    held = {t for i, t, _ in rows if __import__("zlib").crc32(str(i).encode()) % 5 == 0}
    sample = quality.labelled_sample(docs, labels)
    assert not held & {t for t, _ in sample} and len(sample) == 600 - len(held)


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.classify(frame(spark, [(1, "x", "s")]), none).first()
    assert out["score"] == 0.5 and out["predicted"] == 1
    assert quality.classify(frame(spark, []), none).count() == 0
    only = quality.train([("a", 1), ("b", 1)])
    assert only[1] > 0 and not only[0].any()


# ------------------------------------------------------------------ mixing
def test_mixing_meets_targets(spark):
    rnd = random.Random(1)
    kinds = {"clean": "meadow river", "junk": "click win", "toxic": "scum filth"}
    rows = []
    for i in range(900):
        kind = rnd.choices(list(kinds), [6, 2, 1])[0]
        rows.append((i, " ".join(rnd.choice((kinds[kind] + " the of and").split()) for _ in range(rnd.randint(5, 40))), kind))
    docs = frame(spark, [(i, t, "s") for i, t, _ in rows] + [(5000, None, "s"), (5001, "", "s")])
    labels = spark.createDataFrame([(i, int(k != "junk"), int(k == "toxic")) for i, _, k in rows if i % 2],
                                   "doc_id long, quality int, toxic int")
    targets = {"clean": 0.8, "junk": 0.15, "toxic": 0.05}
    out = mixing.mix_documents(docs, labels, targets)
    assert no_python(out)
    got = out.collect()
    total = sum(r["n_tokens"] for r in got)
    for name, target in targets.items():
        assert abs(sum(r["mix_rate"] * r["n_tokens"] * r[f"p_{name}"] for r in got) / total - target) < 0.002
    assert all(r["mix_rate"] >= 0 and math.isclose(sum(r[f"p_{k}"] for k in targets), 1) for r in got)
    truth = {i: k for i, _, k in rows}
    right = sum(max(targets, key=lambda k: r[f"p_{k}"]) == truth[r["doc_id"]] for r in got if r["doc_id"] in truth)
    assert right > 0.95 * len(rows)
    # the same steps in plain Python
    rates = {}
    groups = {}
    for r in got:
        key = tuple(r[f"p_{k}"] for k in targets)
        groups[key] = groups.get(key, 0) + r["n_tokens"]
        rates[key] = r["mix_rate"]
    mine, share, steps = dict.fromkeys(groups, 1.0), None, 0
    while True:
        now = [sum(mine[g] * n * g[k] for g, n in groups.items()) / total for k in range(3)]
        share = share or now
        gap = [(a - b) / s for a, b, s in zip(now, targets.values(), share)]
        if steps == mixing.ROUNDS or max(abs(x) * s for x, s in zip(gap, share)) < mixing.TOLERANCE:
            break
        mine = {g: max(0.0, x - sum(a * b for a, b in zip(g, gap))) for g, x in mine.items()}
        steps += 1
    assert all(math.isclose(mine[g], rates[g], abs_tol=1e-9) for g in groups)


def test_scarce_domains_do_not_drive_the_others_out(spark):
    assert mixing.reachable([0.9, 0.1], [0.99, 0.01]) == pytest.approx([0.98, 0.02])
    assert mixing.reachable([0.9, 0.1], [0.8, 0.2]) == [0.9, 0.1]
    assert mixing.reachable([0.9, 0.1, 0.0], [0.2, 0.4, 0.4]) == pytest.approx([0.4, 0.6, 0.0])
    rows = [(i, "meadow river of the " * 5, "s") for i in range(400)] + [(1000 + i, "click win of the " * 5, "s") for i in range(2)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)] + [(1000, 0, 0), (1001, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    out = mixing.mix_documents(frame(spark, rows), labels, {"clean": 0.5, "junk": 0.5}).collect()
    assert min(r["mix_rate"] for r in out) > 0.9 and max(r["mix_rate"] for r in out) < 2.01


def test_evidence_does_not_fall_with_length(spark):
    rnd = random.Random(3)
    plain = [f"w{k}" for k in range(300)]

    def text(n, toxic):
        return " ".join(rnd.choice(["scum", "filth"]) if toxic and rnd.random() < 0.03 else rnd.choice(plain) for _ in range(n))

    sizes = [1000, 1200, 2000, 20000]
    rows = [(i, text(400, i % 5 == 0), i % 5 == 0) for i in range(500)]
    rows += [(1000 + 2 * k + t, text(n, t), bool(t)) for k, n in enumerate(sizes) for t in (0, 1)]
    labels = spark.createDataFrame([(i, 1, int(t)) for i, _, t in rows if i < 500], "doc_id long, quality int, toxic int")
    out = mixing.mix_documents(frame(spark, [(i, t, "s") for i, t, _ in rows]), labels).collect()
    got = {r["doc_id"]: r["p_toxic"] for r in out}
    assert all(got[i] > 0.9 if t else got[i] < 0.1 for i, _, t in rows if i >= 1000)


def test_scarce_domains_keep_their_posterior(spark):
    rows = [(i, "meadow river of the " * 5, "s") for i in range(400)] + [(1000 + i, "meadow river of the " * 5, "s") for i in range(8)]
    labels = spark.createDataFrame([(i, int(i < 1000), 0) for i, _, _ in rows], "doc_id long, quality int, toxic int")
    out = mixing.mix_documents(frame(spark, rows), labels, {"clean": 0.95, "junk": 0.05}).collect()
    assert all(r["p_junk"] == pytest.approx(8 / 408, rel=0.02) for r in out)


@pytest.mark.parametrize("tokens, met", [([160, 190, 30, 20], False), ([160, 190, 5, 45], False), ([60, 30, 5, 5], True)])
def test_rates_are_fitted_to_the_end(tokens, met):
    table = [[0.86, 0.08, 0.06], [0.80, 0.09, 0.11], [0.45, 0.50, 0.05], [0.40, 0.10, 0.50]]
    if met:
        table = [[0.97, 0.02, 0.01], [0.93, 0.06, 0.01], [0.45, 0.50, 0.05], [0.40, 0.10, 0.50]]
    rates = mixing.fit_rates(tokens, table, [0.93, 0.05, 0.02])
    weight = [n / sum(tokens) for n in tokens]
    shares = [sum(w * t[k] for w, t in zip(weight, table)) for k in range(3)]
    aim = mixing.reachable([0.93, 0.05, 0.02], shares)
    off = [sum(r * w * t[k] for r, w, t in zip(rates, weight, table)) - aim[k] for k in range(3)]
    slope = [sum(t[k] * off[k] / shares[k] for k in range(3)) for t in table]
    still = all(abs(g) < 1e-6 if r > 0 else g > -1e-6 for r, g in zip(rates, slope))
    assert max(map(abs, off)) < mixing.TOLERANCE if met else still and max(map(abs, off)) > mixing.TOLERANCE
    assert min(rates) >= 0


def test_mixing_without_labels_or_documents(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = mixing.mix_documents(frame(spark, [(1, "a b c", "s")]), labels).first()
    assert got["n_tokens"] == 3 and got["mix_rate"] >= 0
    assert mixing.mix_documents(frame(spark, []), labels).count() == 0
