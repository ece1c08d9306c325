"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

One narrow pass of built-in functions: no shuffle, no Python. Positions come from cutting the text at the
same matches (``split``) and adding up the lengths of pieces and matches, in blocks of about the square root
of their number, so that a text of many matches copies no long array at each of them. The expressions are possessive
where nothing could be given back, so that very long runs need neither deep recursion nor repeated scans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
THRESHOLD = 0.5


@dataclass(frozen=True)
class Kind:
    """A kind of span: its expression, its score before context, and the words that raise the score nearby.

    ``base`` kinds keep every confirmed span; spans of the others need the threshold. Words of ``against``
    nearby lower the score.
    """

    name: str
    regex: str
    hint: str | None
    prior: float
    words: str
    base: bool
    against: str = ""


_LOCAL = "A-Za-z0-9._%+-"
KINDS = (
    Kind("email", rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         "mail|contact|write|kontakt|correo|courriel", True, "package|npm"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.6, "ip|host|server|address|adresse", True,
         "version|release|section|chapter"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", None, 0.8, "card|visa|master|credit|karte|tarjeta|carte", True,
         "isbn|tracking|invoice|serial"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, "phone|tel|call|mobile|telefon", True, "isbn|invoice|score"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", None, 0.8,
         "iban|bank|account|konto|cuenta|compte", False, "isbn|serial"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssn|social|security|tax", False,
         "order|invoice|part"),
    Kind("secret", r"(?<![A-Za-z0-9_@.-])[A-Za-z0-9_-]{20,}+(?![@.][A-Za-z0-9])", None, 0.4,
         "token|secret|passw|pwd|credential|auth|bearer|api|private|key", False,
         r"sha\b|sha-?[0-9]|md5|commit|checksum|digest|hash|uuid|revision|etag"),
)
SECRET_CHARS = 512
SECRET_BITS = 3.0
_ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    def add(total, i):
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (spaces ignored) leaves 1 modulo 97 with its first four characters moved
    to the end and letters counted from 10."""
    plain = F.regexp_replace(account, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest, i):
        v = F.instr(F.lit(_ALNUM), F.substring(turned, i, F.lit(1))) - 1
        return F.when(v > 9, rest * 100 + v).otherwise(rest * 10 + v) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def entropy(text: Column) -> Column:
    """Shannon entropy of a string's characters, in bits a character."""
    n = F.length(text).cast("double")

    def bits(total, c):
        share = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
        return total - share * F.log2(share)

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), bits)


def random_looking(text: Column) -> Column:
    """Whether a token of 20 to ``SECRET_CHARS`` characters reads like a generated one: letters and digits, at least
    one change between digits, small and capital letters in five characters (words joined by hyphens have few),
    and ``SECRET_BITS`` bits a character."""
    changes = F.regexp_count(text, F.lit("[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])|[a-z](?=[A-Z])|[A-Z](?=[a-z])"))
    return F.when(F.length(text) > SECRET_CHARS, False).when(~text.rlike("[0-9]") | ~text.rlike("[A-Za-z]"), False).when(
        changes * 5 < F.length(text), False).otherwise(entropy(text) >= SECRET_BITS)


def confirmed(kind: str, match: Column) -> Column:
    """The check that a proposed match must pass."""
    if kind == "ip":
        def small(part):
            plain = F.regexp_replace(part, "^0+", "")
            return F.when(F.length(plain) <= 3, F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255).otherwise(False)

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        n = digits(match)
        return F.when(F.length(match) > 40, F.lit(False)).when(
            F.length(n).between(16, 19), luhn(n)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    if kind == "iban":
        return mod97(match)
    if kind == "secret":
        return random_looking(match)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often lambda functions in it use the value."""
    return F.transform(F.array(value), body)[0]


def _score(kind: Kind, before: Column, after: Column) -> Column:
    """Prior, raised or lowered by context words in the ``CONTEXT_CHARS`` characters before and after."""
    left = F.lower(F.right(before, F.lit(CONTEXT_CHARS)))
    right = F.lower(F.left(after, F.lit(CONTEXT_CHARS)))

    def near(words, amount):
        found = left.rlike(rf"\b(?:{words})") | right.rlike(rf"\b(?:{words})")
        return F.when(found, amount).otherwise(0.0)

    score = F.lit(kind.prior) + near(kind.words, 0.3) - (near(kind.against, 0.3) if kind.against else 0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2)


def spans_of(kind: Kind, text: Column) -> Column:
    """Array of (kind, start, end, score) of the confirmed spans of a kind, in order; code points, end exclusive.

    Context is the text up to the neighbouring matches of the same kind, ``CONTEXT_CHARS`` characters at most.
    """
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")

    def judged(pieces):
        """Per match: the characters before it, its own, whether it stays, its score."""
        matches = F.regexp_extract_all(text, F.lit(kind.regex), F.lit(0))
        rows = F.arrays_zip(pieces.alias("before"), matches.alias("match"),
                            F.slice(pieces, F.lit(2), F.size(pieces)).alias("after"))

        def one(x):
            score = _score(kind, x["before"], x["after"])
            good = x["match"].isNotNull() & confirmed(kind.name, x["match"])
            return F.struct(F.length(x["before"]).alias("gap"), F.coalesce(F.length(x["match"]), F.lit(0)).alias("size"),
                            (good if kind.base else good & (score >= THRESHOLD)).alias("good"), score.alias("score"))

        return F.transform(rows, one)

    def placed(rows, block):
        """Matches by their places: block starts first, then the matches of each block from its start."""
        part = lambda b: F.slice(rows, b * block + 1, block)
        moved = lambda pos, x: pos + x["gap"] + x["size"]
        starts = F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / block).cast("int")),
            F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("starts")),
            lambda acc, b: F.struct(F.aggregate(part(b), acc["pos"], moved).alias("pos"),
                                    F.array_append(acc["starts"], acc["pos"]).alias("starts")),
            lambda acc: acc["starts"])

        def add(acc, x):
            at = acc["pos"] + x["gap"]
            end = at + x["size"]
            span = F.struct(F.lit(kind.name).alias("kind"), at.alias("start"), end.alias("end"), x["score"].alias("score"))
            return F.struct(end.alias("pos"),
                            F.when(x["good"], F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

        return F.flatten(F.transform(starts, lambda pos, b: F.aggregate(
            part(b), F.struct(pos.alias("pos"), none.alias("found")), add, lambda acc: acc["found"])))

    found = _let(_let(F.split(text, kind.regex), judged), lambda rows: _let(
        F.greatest(F.lit(32), F.ceil(F.sqrt(F.size(rows))).cast("int")), lambda block: placed(rows, block)))
    seen = text.contains(kind.hint) if kind.hint else text.rlike(kind.regex)
    return F.when(seen, found).otherwise(none)


def find_pii(docs: DataFrame, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with ``spans``: array of (kind, start, end, score), by kind as in ``kinds``, then start.

    Spans of a kind are the leftmost matches that do not overlap; a match that fails its check is dropped
    and not tried again at another place. A null or empty text has no spans. Rows stay one to one; a column
    already called spans is replaced.
    """
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumn("spans", F.concat(*[spans_of(k, whole) for k in kinds]))


def span_list(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans, comma-joined in their order; of some kinds only if given."""
    some = F.filter(spans, lambda x: x["kind"].isin(*kinds)) if kinds else spans
    return F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def score_list(spans: Column) -> Column:
    """Scores of the spans, comma-joined in their order."""
    return F.array_join(F.transform(spans, lambda x: x["score"].cast("string")), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
