"""Personal data and secrets, by patterns and by weak supervision, in DataFrame functions alone.

The base kinds are found by their patterns. Beside them, long tokens are candidates for the kind "secret"; labelers vote on
each: the token's shape (regex), the word before it in a gazetteer, its context (assigned or quoted), and its digits.
Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability; the posteriors then train
a naive Bayes span classifier over the token's own features, which decides. Only counts per pattern, a few hundred rows
by construction, reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, written so that Java runs them in linear time and without recursion; they match the same spans.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
KINDS = ("email", "ip", "card", "phone", "secret")
GAZETTEER = ("token", "password", "passwd", "pwd", "secret", "apikey", "api_key", "key", "auth", "bearer", "credential", "credentials")
LABELERS = ("shape", "gazetteer", "context", "digits")
#: A span is added if the classifier gives it at least this probability.
ACCEPT = 0.9
SPAN = "struct<start:int,end:int,value:string>"


def _let(value: Column, f) -> Column:
    """f of value, which is worked out once."""
    return F.transform(F.array(value), f)[0]


def _running(lengths: Column, size: int = 128) -> Column:
    """Running sums of an array, in two levels so that a text with very many matches stays cheap."""

    def blocks(arr):
        n = F.size(arr)
        return F.transform(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int")), lambda c: F.slice(arr, c * size + 1, F.lit(size)))

    def total(arr):
        return F.aggregate(arr, F.lit(0), lambda a, x: a + x)

    def within(parts):
        return _let(
            F.transform(parts, total),
            lambda sums: F.flatten(F.transform(parts, lambda p, c: _let(total(F.slice(sums, F.lit(1), c)), lambda base: F.transform(p, lambda _, i: base + total(F.slice(p, F.lit(1), i + 1)))))),
        )

    return _let(blocks(lengths), within)


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches, in code points; no text, no matches."""
    none = F.expr(f"cast(array() as array<{SPAN}>)")

    def place(found):
        def ends(pieces):
            lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(found)), found, lambda p, m: F.length(p) + F.length(m))
            return _let(_running(lengths), lambda end: F.zip_with(found, end, lambda m, e: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("value"))))

        return _let(F.split(text, pattern, -1), ends)

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda found: F.when(F.size(found) > 0, place(found)).otherwise(none))


def _luhn(value: Column) -> Column:
    def check(digits):
        n = F.length(digits)

        def add(total, i):
            d = F.substring(digits, n - i, F.lit(1)).cast("int")
            twice = F.when(i % 2 == 1, d * 2).otherwise(d)
            return total + F.when(twice > 9, twice - 9).otherwise(twice)

        return F.when(n.between(13, 19), F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0).otherwise(F.lit(False))

    return _let(F.regexp_replace(value, r"[\x20-]", ""), check)


_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_HOLDS = {
    "email": None,
    "ip": lambda s: s["value"].rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$".replace("0*+", "0*")),
    "card": lambda s: _luhn(s["value"]),
    "phone": lambda s: F.length(F.regexp_replace(s["value"], "[^0-9]", "")).between(9, 15),
}


def base_spans(text: Column, kind: str) -> Column:
    found = matches(text, PATTERNS[kind])
    return F.filter(found, _HOLDS[kind]) if _HOLDS[kind] else found


def _candidates(text: Column) -> Column:
    """Long tokens with what labelers and classifier look at: four votes (-1, 0, 1) and three features."""

    def look(s):
        value = s["value"]
        n = F.length(value)
        before = F.lower(F.substring(text, F.greatest(s["start"] - 23, F.lit(1)), s["start"] - F.greatest(s["start"] - 24, F.lit(0))))
        after = F.substring(text, s["end"] + 1, F.lit(1))
        digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
        shape = F.when(value.rlike("^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$"), 1).when(value.rlike("^[A-Za-z]+$") | value.rlike(r"^(.)\1*$"), -1).otherwise(0)
        gazetteer = F.when(before.rlike(r"(?:^|[^a-z])(?:" + "|".join(GAZETTEER) + r")[^a-z0-9]{1,8}$"), 1).when(before.rlike(r"[a-z]\s$"), -1).otherwise(0)
        context = F.when(before.rlike(r"[=:]\s*[\"']?$") | (before.rlike("[\"']$") & after.rlike("[\"']")), 1).when(before.rlike(r"[/.]$"), -1).otherwise(0)
        share = F.when((digits * 10 >= n) & (digits < n), 1).when((digits == 0) | (digits == n), -1).otherwise(0)
        charset = F.when(value.rlike("^[0-9a-fA-F]+$"), "hex").when(value.rlike("^[A-Za-z]+$"), "letters").when(value.rlike("^[0-9]+$"), "digits").when(value.rlike("[/+_-]"), "signs").otherwise("mixed")
        quoted = F.when(before.rlike("[\"']$") & after.rlike("[\"']"), "quoted").when(before.rlike(r"[=:]\s*$"), "assigned").otherwise("plain")
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.array(shape, gazetteer, context, share).alias("votes"),
            F.array(charset, F.least(F.floor(n / 8), F.lit(8)).cast("string"), F.concat(quoted, F.when(gazetteer == 1, F.lit("+named")).otherwise(F.lit("")))).alias("features"),
        )

    return F.transform(matches(text, CANDIDATE), look)


def reliabilities(counts: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[float, list[float], dict[tuple[int, ...], float]]:
    """Prior, each labeler's reliability, and each vote pattern's posterior, from counts of patterns; no data leave the start."""
    prior, right = 0.5, [0.8] * len(LABELERS)
    posterior: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes, _n in counts:
            odds = math.log(prior / (1 - prior)) + sum(v * math.log(r / (1 - r)) for v, r in zip(votes, right))
            posterior[votes] = 1 / (1 + math.exp(-odds))
        total = sum(n for _, n in counts)
        if not total:
            break
        prior = min(0.95, max(0.05, sum(posterior[v] * n for v, n in counts) / total))
        for k in range(len(LABELERS)):
            agree = sum((posterior[v] if v[k] > 0 else 1 - posterior[v]) * n for v, n in counts if v[k])
            voted = sum(n for v, n in counts if v[k])
            right[k] = min(0.95, max(0.55, (agree + 8) / (voted + 10)))
    return prior, right, posterior


class Classifier:
    """Log odds of each feature value, to be summed in a Column."""

    def __init__(self, rows: list[tuple[tuple[int, ...], tuple[str, ...], int]]):
        votes: dict[tuple[int, ...], int] = {}
        for v, _, n in rows:
            votes[v] = votes.get(v, 0) + n
        self.prior, self.right, posterior = reliabilities(sorted(votes.items()))
        yes, no, self.weights = {}, {}, {}
        for v, features, n in rows:
            for key in enumerate(features):
                yes[key] = yes.get(key, 1.0) + posterior[v] * n
                no[key] = no.get(key, 1.0) + (1 - posterior[v]) * n
        for place in range(3):
            keys = [k for k in yes if k[0] == place]
            a, b = sum(yes[k] for k in keys), sum(no[k] for k in keys)
            self.weights |= {k: math.log(yes[k] / a) - math.log(no[k] / b) for k in keys}

    def accepts(self, span: Column) -> Column:
        least = math.log(ACCEPT / (1 - ACCEPT)) - math.log(self.prior / (1 - self.prior))
        total = F.lit(0.0)
        for place in range(3):
            held = [(k[1], w) for k, w in sorted(self.weights.items()) if k[0] == place]
            column = F.lit(0.0)
            for value, weight in held:
                column = F.when(span["features"][place] == value, F.lit(weight)).otherwise(column)
            total = total + column
        return total >= least


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    """From the counts of vote and feature patterns over all documents."""
    spans = docs.select(F.explode(_candidates(F.coalesce(F.col(text_col), F.lit("")))).alias("s"))
    rows = spans.groupBy("s.votes", "s.features").count().collect()  # at most 3^4 x 5 x 9 x 6 rows whatever the input
    return Classifier(sorted((tuple(r.votes), tuple(r.features), r["count"]) for r in rows))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classifier: Classifier | None = None) -> DataFrame:
    """One row per row of docs: id_col, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_secret.

    Spans are kind:start:end in code points, end exclusive, by kind (email, ip, card, phone, secret), then start, joined by
    commas. An added span never overlaps a base span. A null text counts as empty and has no spans. Repeated rows give
    repeated results; an empty table gives none; other columns are ignored.
    """
    own = classifier or train(docs, text_col)
    text = F.col("_text")
    out = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    plain = {k: F.transform(base_spans(text, k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for k in PATTERNS}
    out = out.select(id_col, *[c.alias(f"_{k}") for k, c in plain.items()], F.filter(_candidates(text), own.accepts).alias("_more"))
    taken = F.concat(*[F.col(f"_{k}") for k in PATTERNS])
    free = F.filter("_more", lambda s: ~F.exists(taken, lambda t: (t["start"] < s["end"]) & (s["start"] < t["end"])))
    out = out.withColumn("_secret", F.transform(free, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    def named(kind):
        return F.transform(f"_{kind}", lambda s: F.concat(F.lit(f"{kind}:"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))

    def said(kinds):
        return F.concat_ws(",", F.concat(*map(named, kinds)))

    return out.select(id_col, *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in PATTERNS], F.sha2(said(PATTERNS), 256).alias("base_sha256"), said(KINDS).alias("spans"), F.size("_secret").cast("long").alias("n_secret"))
