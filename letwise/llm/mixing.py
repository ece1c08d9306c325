"""Mixing to target weights with soft membership.

A classifier fitted on the labelled table gives every document posteriors over domains; projected-gradient
least squares then finds nonnegative document rates whose expected tokens in each domain match the
targets. Built-in functions only.

* Classifier, fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``): hashed words are counted per domain; the
  telling words of a domain are those that ``DOCUMENTS`` documents hold and that it has clearly more often than all
  documents together, by ``Z`` standard errors and ``LEAST`` in the logarithm of the (smoothed) ratio. A document's
  evidence is its share of telling words for each domain, every occurrence counted, so that it does not fall with the
  document's length, on a logarithmic scale of ``levels`` steps from ``LOW`` to ``HIGH``. Posteriors are those of
  a multinomial logistic regression on the evidence (for each domain whether there is any, and how much), so
  they follow each domain's share. The sample bounds the telling words; documents are scored in the row.
* Rates: documents of equal evidence have equal posteriors, so one pre-aggregated pass leaves the tokens of each
  evidence, ``CLASSES`` numbers at most whatever the number of documents. The gradient
  rounds need nothing else and run on the driver until the targets are met or no rate moves any more.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letwise.llm.textkit import named_back, plainly_named
from letwise.session import scratch_path

SAMPLE_ROWS = 4000
BUCKET_BITS = 20
Z = 5.0
LEAST = 0.7
CLASSES = 4096
LOW, HIGH = 0.002, 0.2
PULL = 0.1
DOCUMENTS = 20
SMOOTH = 10.0
ROUNDS = 60
MORE_ROUNDS = 200_000
STILL = 1e-9
MOST_RATE = 2.0
TOLERANCE = 1e-4
TARGETS = {"clean": 0.93, "junk": 0.05, "toxic": 0.02}
# with the targets above: pull of the rates towards 1, and the least and the greatest rate
RIDGE, LEAST_RATE, MOST_WEIGHT = 0.01, 0.05, 4.0


def label_domain() -> Column:
    """Domain of a row of ``labels``: toxic, else junk (quality 0), else clean; null if quality is not 0 or 1."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk")
            .when(F.col("quality") == 1, "clean"))


def words_of(text: Column) -> Column:
    """Lower-cased words, cut at white space, dots and commas; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s.,]+"), "")


def buckets_of(text: Column, words: Column) -> Column:
    """Hash buckets of the words, and of how much of the text is symbols."""
    symbols = F.length(text) - F.length(F.translate(text, "#$%&*|<>{}[]=~^@", ""))
    share = F.floor(F.coalesce(symbols / F.length(text), F.lit(0.0)) * 40).cast("string")
    return F.concat(F.transform(words, _bucket), F.array(_bucket(F.concat(F.lit("\u0000share"), share))))


def _bucket(word: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(word), 64 - BUCKET_BITS)


def _prepared(docs: DataFrame, text_col: str) -> DataFrame:
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    size = F.when(F.length(whole) == 0, F.lit(None)).otherwise(whole)
    return (docs.withColumn("__words", words_of(whole))
            .withColumn("n_tokens", F.size("__words").cast("long"))
            .withColumn("__buckets", buckets_of(F.coalesce(size, F.lit(" ")), F.col("__words"))).drop("__words"))


def fit_domains(docs: DataFrame, labels: DataFrame, domains: list[str], domain: Column, id_col: str = "doc_id",
                text_col: str = "text", rows: int = SAMPLE_ROWS, label_id: str | None = None) -> tuple[list[list[int]], list[list[float]]]:
    """The telling buckets of each domain, and for each evidence the posteriors. Labelled
    rows are taken in the order of a hash of the id; rows without a domain or a document are left out. Without
    rows, posteriors are even."""
    some = (labels.select(F.col(label_id or id_col).alias("__id"), domain.alias("__domain"))
            .where(F.col("__id").isNotNull() & F.col("__domain").isin(*domains))
            .orderBy(F.xxhash64("__id"), "__id", "__domain").limit(rows))
    texts = (docs.select(F.col(id_col).alias("__d"), F.col(text_col))
             .join(F.broadcast(some), F.col("__d") == F.col("__id")))
    prepared = _written(_prepared(texts, text_col).select("__d", "__domain", "__buckets"), "labelled")
    names = {f"n{k}": name for k, name in enumerate(domains)}

    def per_domain(column: Column) -> list[Column]:
        return [F.sum(F.when(F.col("__domain") == name, column).otherwise(0)).alias(n) for n, name in names.items()]

    seen = prepared.select("__d", "__domain", F.explode("__buckets").alias("b")).groupBy("b", "__d", "__domain").count()
    # shares are of a domain's words, not of its documents: longer documents hold more of every word
    sizes = [x or 0 for x in seen.agg(*per_domain(F.col("count"))).first()]
    total = sum(sizes)
    common = (seen.groupBy("b").agg(F.count(F.lit(1)).alias("documents"), *per_domain(F.col("count")))
              .where(F.col("documents") >= DOCUMENTS))
    telling: list[list[int]] = [[] for _ in domains]
    for r in common.orderBy("b").collect():
        counts = [r[n] for n in names]
        share = sum(counts) / total
        for n, size, found in zip(counts, sizes, telling):
            due = size * share
            z = (n - due) / math.sqrt(max(due * (1 - share), 1.0))
            if z >= Z and math.log((n + SMOOTH) / (due + SMOOTH)) >= LEAST:
                found.append(r["b"])
    held: dict[int, list[int]] = {}
    for r in prepared.groupBy(evidence(F.col("__buckets"), telling).alias("e")).agg(*per_domain(F.lit(1))).collect():
        held[r["e"]] = [r[n] for n in names]
    k = len(domains)
    seen_rows = _features(np.array(sorted(held), int), k)
    weights = _regression(seen_rows, np.array([held[e] for e in sorted(held)], float).reshape(len(held), k))
    return telling, _softmax(_features(np.arange((levels(k) + 1) ** k), k) @ weights).tolist()


def levels(domains: int) -> int:
    """Steps of a domain's evidence above none: as many as leave at most ``CLASSES`` combinations, one at least."""
    n = 1
    while (n + 2) ** domains <= CLASSES:
        n += 1
    return n


def _features(numbers: np.ndarray, domains: int) -> np.ndarray:
    """Rows of the regression for evidence numbers: 1, then for each domain whether it has evidence, its step and that squared."""
    steps, columns = levels(domains), [np.ones(len(numbers))]
    for k in range(domains):
        step = numbers // (steps + 1) ** k % (steps + 1)
        columns += [(step > 0).astype(float), step / steps, (step / steps) ** 2]
    return np.stack(columns, axis=1)


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _regression(rows: np.ndarray, counts: np.ndarray, turns: int = 100) -> np.ndarray:
    """Weights (features x domains) of a multinomial logistic regression by damped Newton steps. ``counts``: labelled
    documents of each row by domain. ``PULL`` draws the weights towards 0, the intercepts by a thousandth of it."""
    width, domains = rows.shape[1], counts.shape[1]
    pull = np.full((width, 1), PULL)
    pull[0] = PULL / 1000
    weights = np.zeros((width, domains))
    if not counts.sum():
        return weights

    def loss(w: np.ndarray) -> float:
        return float(-(counts * np.log(np.maximum(_softmax(rows @ w), 1e-300))).sum() + 0.5 * (pull * w * w).sum())

    size, now = counts.sum(axis=1, keepdims=True), loss(weights)
    for _ in range(turns):
        p = _softmax(rows @ weights)
        slope = rows.T @ (size * p - counts) + pull * weights
        bend = np.zeros((domains, width, domains, width))
        for i in range(domains):
            for j in range(domains):
                bend[i, :, j, :] = rows.T @ (rows * (size[:, 0] * p[:, i] * ((i == j) - p[:, j]))[:, None])
        flat = bend.reshape(domains * width, -1) + np.diag(np.tile(pull[:, 0], domains))
        step = np.linalg.solve(flat, slope.T.reshape(-1)).reshape(domains, width).T
        pace = 1.0
        while pace > 1e-6 and loss(weights - pace * step) > now:
            pace /= 2
        weights, last = weights - pace * step, now
        now = loss(weights)
        if last - now < 1e-9 * max(1.0, abs(last)):
            break
    return weights


def evidence(buckets: Column, telling: list[list[int]]) -> Column:
    """Number of a document's evidence: for each domain the step of the share of its buckets, with repeats, that
    tell of it."""
    steps = levels(len(telling))
    span = math.log(HIGH / LOW)

    def number(told: Column) -> Column:
        out = F.lit(0)
        for k, known in enumerate(telling):
            found = F.size(F.filter(told, lambda x: x.isin(known))) if known else F.lit(0)
            depth = F.round(F.ln(found / F.size(buckets) / LOW) / span * (steps - 1)).cast("int") + 1
            step = F.when(found > 0, F.greatest(F.lit(1), F.least(F.lit(steps), depth))).otherwise(0)
            out = out + step * (steps + 1) ** k
        return out

    every = sorted({b for known in telling for b in known})
    if not every:
        return F.lit(0)
    told = F.filter(buckets, lambda x: x.isin(every))
    return F.get(F.transform(F.array(told), number), F.lit(0))


def scored_documents(docs: DataFrame, telling: list[list[int]], text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens`` (words) and ``__e``, the number of its evidence. Null and empty texts have none."""
    scored = _prepared(docs, text_col)
    return scored.withColumn("__e", evidence(F.col("__buckets"), telling)).drop("__buckets")


def _of_evidence(values: list[float]) -> Column:
    """The value of the row's evidence."""
    return F.get(F.split(F.lit(",".join(repr(float(x)) for x in values)), ",").cast("array<double>"), F.col("__e"))


def reachable(targets: list[float], shares: list[float], most: float = MOST_RATE) -> list[float]:
    """Target shares of which none asks for over ``most`` times the domain's share; what that leaves open goes to
    the other domains in proportion to their targets."""
    out, capped = list(targets), set()
    while True:
        over = {k for k, t in enumerate(out) if k not in capped and t > most * shares[k]}
        if not over:
            return out
        capped |= over
        free = sum(targets[k] for k in range(len(out)) if k not in capped)
        left = 1 - sum(most * shares[k] for k in capped)
        out = [most * shares[k] if k in capped else (targets[k] * left / free if free else 0.0) for k in range(len(out))]


def fit_rates(tokens: list[float], table: list[list[float]], targets: list[float], rounds: int = ROUNDS,
              ridge: float = 0.0, least: float = 0.0, most: float = math.inf) -> list[float]:
    """Rate of each evidence: projected gradient from 1 on min over rates ``least`` <= r <= ``most`` of sum over domains
    (expected tokens - target)^2 / domain tokens, plus ``ridge`` times the token-weighted sum of (r - 1)^2.
    ``tokens``: of each evidence, which has the posteriors in ``table``.

    Where posteriors are soft, targets can often be met only by a few of the purest documents. The ridge and the
    bounds give up a little of the targets so that nearly all documents stay in the mix; without a ridge the targets
    come first.

    The step of a document is taken per token, so that the rate does not depend on a document's length.
    Targets are first made ``reachable``, so that a scarce domain is not bought by dropping all else; domains
    without expected tokens are left out. No tokens at all: no steps.

    After ``rounds`` plain rounds the rounds are accelerated (with restarts) until the targets are met within
    ``TOLERANCE`` or no rate moves by over ``STILL`` any more; what is then left of the targets is logged.
    """
    q, n = np.array(table, float), np.array(tokens, float)
    rates = np.ones(len(n))
    if not n.sum():
        return rates.tolist()
    weight = n / n.sum()
    shares = weight @ q
    aim = np.array(reachable(targets, shares.tolist()))
    per = np.divide(1.0, shares, out=np.zeros(len(aim)), where=shares > 0)

    def off(r: np.ndarray) -> np.ndarray:
        return np.where(shares > 0, (r * weight) @ q - aim, 0.0)

    def moved(r: np.ndarray) -> np.ndarray:
        return np.clip(r - (q @ (off(r) * per) + ridge * (r - 1)) / (1 + ridge), least, most)

    last, pace = rates, 1.0
    for turn in range(rounds + MORE_ROUNDS):
        left, after = off(rates), moved(rates)
        if not ridge and np.abs(left).max() < TOLERANCE:
            return rates.tolist()
        if np.abs(after - rates)[n > 0].max() < STILL:
            break
        if turn < rounds:
            last, rates = rates, after
            continue
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        ahead = rates + (pace - 1) / faster * (rates - last)
        after = moved(ahead)
        pace = 1.0 if (weight * (ahead - after) * (after - rates)).sum() > 0 else faster
        last, rates = rates, after
    else:
        logging.getLogger(__name__).warning("mixing rates still move after %d rounds", rounds + MORE_ROUNDS)
    logging.getLogger(__name__).warning("mixing targets %s are missed by %s", aim.round(4).tolist(), off(rates).round(4).tolist())
    return rates.tolist()


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
                  domain: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                  columns: list[str] | None = None) -> DataFrame:
    """``docs`` (or some of its ``columns``) with n_tokens, ``p_<domain>`` for each domain, and ``mix_rate`` >= 0: the weight at which a document
    enters the mix, so that rate-weighted expected tokens of each domain have the target shares of all tokens.
    The default targets come with a ridge towards 1 and bounds of the rates (``RIDGE``, ``LEAST_RATE``,
    ``MOST_WEIGHT``), and are approached as far as these allow; targets that are given are met as nearly as rates of 0
    and more can.
    Documents are scored once, into a table in the shared folder; the rates are found and applied on that.

    Null and empty texts have the prior posteriors and 0 tokens; repeated rows count each; an empty table stays
    empty; without usable labels the posteriors are even. Columns already called so are replaced.
    """
    bounds = {"ridge": RIDGE, "least": LEAST_RATE, "most": MOST_WEIGHT} if targets is None else {}
    targets = TARGETS if targets is None else targets
    domains = list(targets)
    whole = sum(targets.values())
    new = {"n_tokens", "mix_rate", *(f"p_{k}" for k in domains)}
    plain, names = plainly_named(docs.select(*[f"`{c}`" for c in docs.columns if c.lower() not in new]))
    id_name, text_name = names[id_col], names[text_col]
    telling, table = fit_domains(plain, labels, domains, label_domain() if domain is None else domain, id_name, text_name, label_id=id_col)
    kept = {c: name for c, name in names.items() if columns is None or c in columns}
    scored = _written(scored_documents(plain, telling, text_name).select(*kept.values(), "n_tokens", "__e"), "scored")
    tokens = {r["__e"]: r["n"] for r in scored.groupBy("__e").agg(F.sum("n_tokens").alias("n")).collect()}
    seen = sorted(tokens)
    rates = [1.0] * len(table)
    for e, rate in zip(seen, fit_rates([tokens[e] or 0 for e in seen], [table[e] for e in seen],
                                       [t / whole for t in targets.values()], **bounds) if seen else []):
        rates[e] = rate
    return scored.select(*named_back(kept), "n_tokens",
                         *[_of_evidence([row[k] for row in table]).alias(f"p_{name}") for k, name in enumerate(domains)],
                         _of_evidence(rates).alias("mix_rate"))
