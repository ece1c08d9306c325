"""URL filters: host and path rules, found through their rarest literal token.

Every rule is a host and a path prefix (``example.com/en/``). Its literal text is cut into tokens
(host labels and whole path segments); the rule is filed under the token that the fewest distinct
URLs hold. The tokens of a URL fetch the rules filed under them, and only those rules run their
regular expression. Plain joins and aggregates, no Python. Rules are sought for the distinct URLs, counted
with partial aggregation, so a hot host or URL costs a row per task there. Pages get their URL's rule by a
join on the URL: pages of a URL that more than one page in ``HOT_SHARE`` has are dealt over ``SALTS`` keys, and so are
pages without a URL; fewer than ``HOT_SHARE`` URLs can be as hot, so their list is broadcast whatever the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from letwise.llm.textkit import named_back, plainly_named
from letwise.session import literal_frame

HOT_SHARE = 1000
SALTS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules ``(host, path, verdict)`` given as literals, for short lists kept in code."""
    return literal_frame(spark, rules, "host string, path string, verdict string")


def _index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Each rule with the token it is filed under: that in the fewest URLs, then the longest, then the first.
    A rule without a whole token is filed under the empty token, which every URL has."""
    tokens = rules.select(
        "rule", "verdict", "regex", "size",
        F.explode(F.array_distinct(F.concat(
            F.split("host", r"\."),
            F.filter(F.split(F.regexp_extract("path", r"(?s)^(.*/)", 1), "/"), lambda x: x != ""),
            F.array(F.lit(""))))).alias("token"))
    seen = (urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("urls")))
    rank = F.struct((F.col("token") == "").alias("a"), F.coalesce("urls", F.lit(0)).alias("b"),
                    (-F.length("token")).alias("c"), F.col("token").alias("d"))
    return (tokens.join(seen, "token", "left").groupBy("rule", "verdict", "regex", "size")
            .agg(F.min(rank).getField("d").alias("token")))


def _dealt(pages: DataFrame) -> Column:
    """A number from 0 to ``SALTS`` - 1 by the content of a row, the same when a task is run again."""
    plain = [f.name for f in pages.schema.fields
             if not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    return F.pmod(F.xxhash64(*(plain or [F.lit(0)])), F.lit(SALTS)).cast("int")


def url_verdicts(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict of each URL (columns of these names are replaced).

    A rule fits its host and all subdomains if the path starts with the rule's path. Among fitting rules
    the longest text wins, then the smallest text, then the smallest verdict. Null URLs and URLs without
    ``://`` have an empty host and path, no rule and the default verdict. Rules with a null host, path or
    verdict, an empty host or a path that does not start with a slash are ignored. Repeated pages get a row each.
    """
    pages, names = plainly_named(pages)
    url = F.col(names[url_col]).cast("string")
    clean = (rules.where("host != '' and (path = '' or path like '/%') and verdict is not null")
             .select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict")
             .withColumn("rule", F.concat("host", "path"))
             .withColumn("size", F.length("rule"))
             .withColumn("regex", F.concat(
                 F.lit(r"(?s)^(?:[^/]*\.)?"), F.regexp_replace("rule", r"([^A-Za-z0-9/])", r"\\$1"),
                 F.when(F.col("path") == "", F.lit("(?:/|$)")).otherwise(F.lit(""))))
             .distinct())
    pages = pages.withColumn("__key", F.when(url.contains("://"), url))
    counted = (pages.where(F.col("__key").isNotNull()).groupBy(F.col("__key").alias("u"))
               .agg(F.count(F.lit(1)).alias("n")))
    urls = (counted.select("u", F.concat(url_host(F.col("u")), url_path(F.col("u"))).alias("place"))
            .withColumn("tokens", F.array_distinct(F.concat(
                F.split(F.regexp_extract("place", r"(?s)^([^/]*)", 1), r"\."),
                F.filter(F.split(F.regexp_extract("place", r"(?s)^[^/]*(/.*)$", 1), "/"), lambda x: x != ""),
                F.array(F.lit(""))))))
    found = (urls.select("u", "place", F.explode("tokens").alias("token"))
             .join(_index(clean, urls), "token")
             .where("regexp_like(place, regex)")
             .groupBy("u")
             .agg(F.min(F.struct((-F.col("size")).alias("a"), "rule", "verdict")).alias("best"))
             .select(F.col("u").alias("__u"), F.col("best.rule").alias("__rule"), F.col("best.verdict").alias("__verdict")))

    least = pages.count() / HOT_SHARE
    hot = counted.where(F.col("n") > least).select(F.xxhash64("u").alias("__hot")).distinct()
    salts = F.when(F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    found = (found.join(F.broadcast(hot), F.xxhash64("__u") == F.col("__hot"), "left")
             .select("__u", F.explode(salts).alias("__salt"), "__rule", "__verdict"))
    alone = F.col("__hot").isNull() & F.col("__key").isNotNull()
    spread = F.when(alone, F.lit(0)).otherwise(_dealt(pages.drop("__key")))
    keep = {c: new for c, new in names.items() if c.lower() not in ("host", "path", "rule", "verdict")}
    return (pages.join(F.broadcast(hot), F.xxhash64("__key") == F.col("__hot"), "left")
            .withColumn("__dealt", spread)
            .join(found, (F.col("__key") == F.col("__u")) & (F.col("__dealt") == F.col("__salt")), "left")
            .select(*named_back(keep), url_host(F.col("__key")).alias("host"), url_path(F.col("__key")).alias("path"),
                    F.col("__rule").alias("rule"), F.coalesce("__verdict", F.lit(default)).alias("verdict")))
