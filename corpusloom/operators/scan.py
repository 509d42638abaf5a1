"""Which boilerplate an article holds: named rules over the whole article or its last lines, with an excerpt of each hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import splitlines, strip
from corpusloom.operators import rules

#: Lines at an article's end, and characters before and after a hit in its excerpt.
TAIL_LINES, BEFORE, AFTER = 15, 30, 50


def scope(output: Column) -> Column:
    """What is scanned: the first tagged article, or all where none is tagged."""
    pattern = r"(?s)<article>(.*?)</article>"
    return F.when(output.rlike(pattern), F.regexp_extract(output, pattern, 1)).otherwise(output)


def tail(article: Column) -> Column:
    def last(lines):
        return F.array_join(F.slice(lines, F.greatest(F.lit(1), F.size(lines) - (TAIL_LINES - 1)), F.lit(TAIL_LINES)), "\n")

    return F.transform(F.array(splitlines(strip(article))), last)[0]


def excerpt(text: Column, pattern: str) -> Column:
    """Up to BEFORE characters before the first hit, the hit, and up to AFTER behind it, in one line."""
    found = F.regexp_extract(text, f"(?d)(?U)(?s)^.*?((?-s:{pattern}))", 0)  # all up to the hit's end
    hit = F.regexp_extract(text, "(?d)(?U)" + pattern, 0)
    begin = F.length(found) - F.length(hit)
    at = F.greatest(F.lit(0), begin - BEFORE)
    return F.replace(F.substring(text, at + 1, F.length(found) - at + AFTER), F.lit("\n"), F.lit(" | "))


def scan(records: DataFrame, output: str = "output", key: str = "name") -> DataFrame:
    """key, rule, excerpt: a row for each rule that a record's article breaks. Null outputs break none."""
    d = records.select(F.col(key).alias("key"), scope(F.col(output)).alias("article"))
    d = d.select("key", "article", tail(F.col("article")).alias("tail"))
    hits = []
    for name, (pattern, last) in rules.SCAN.items():
        text = F.col("tail" if last else "article")
        hits.append(F.when(rules.found(text, pattern), F.struct(F.lit(name).alias("rule"), excerpt(text, pattern).alias("excerpt"))))
    return d.select("key", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("hit")).select(F.col("key").alias(key), "hit.rule", "hit.excerpt")


def summary(hits: DataFrame, key: str = "name") -> DataFrame:
    """rule, docs, example (of the least key)."""
    return hits.groupBy("rule").agg(F.count("*").alias("docs"), F.min_by("excerpt", key).alias("example"))
