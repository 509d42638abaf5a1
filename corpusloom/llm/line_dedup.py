"""Lines that are boilerplate of their site, judged relative to the site's own number of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._common import cut, packed, shuffle_partitions, unpacked

#: A line is boilerplate if over ONE_IN's part of its host's pages hold it. REPEAT is what makes a line a repeated one at all.
ONE_IN, REPEAT = 50, 3
#: Boilerplate lines, of all hosts, that are broadcast; beyond, pages and lines are joined by host and salt.
BROADCAST_LINES = 500_000
#: Holds something besides white space.
_INK = r"[^\x20\x09-\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _digest(line: Column) -> Column:
    return F.md5(line.cast("binary"))


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", one_in: int = ONE_IN, repeat: int = REPEAT) -> DataFrame:
    """host, line_md5, pages, host_pages of each boilerplate line.

    A line counts once a page; lines of white space never count. Sums are taken per task before the shuffle, and only
    digests are shuffled. Per host there are at most one_in times as many of them as a page has lines on average.
    """
    digests = F.array_distinct(F.transform(F.filter(_lines(F.col(text_col)), lambda x: x.rlike(_INK)), _digest))
    held = docs.select(F.col(host_col).alias("host"), F.explode(digests).alias("line_md5")).groupBy("host", "line_md5").agg(F.count("*").alias("pages")).where(F.col("pages") >= repeat)
    totals = docs.groupBy(F.col(host_col).alias("host")).agg(F.count("*").alias("host_pages"))
    joined = held.alias("h").join(totals.alias("t"), F.col("h.host").eqNullSafe(F.col("t.host")))
    return joined.where("pages * %d > host_pages" % one_in).select("h.host", "line_md5", "pages", "host_pages")


def drop_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", one_in: int = ONE_IN, repeat: int = REPEAT, n_lines: str = "_n_lines", n_removed: str = "_n_removed", broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """docs with two more columns, n_lines and n_removed, and text_col without the boilerplate lines of its host.

    Rows without a host are one host of their own. A null text stays null and has no lines; a text of boilerplate alone
    becomes empty. Repeated rows are pages each. An empty table gives no rows; other columns pass through, whatever their
    names, but for those called as n_lines and n_removed say, which are replaced.
    """
    found = boilerplate(docs, host_col, text_col, one_in, repeat).select("host", "line_md5", "host_pages")
    bad, _ = cut(found.repartition(max(1, shuffle_partitions(docs.sparkSession) // 16)), "boilerplate")  # far fewer rows than the partitions that found them
    per_host = bad.groupBy("host").agg(F.collect_list("line_md5").alias("bad"), F.first("host_pages").alias("host_pages"))
    own = packed(docs, text_col, text=F.col(text_col).cast("string"), own_host=F.col(host_col))
    if bad.count() <= broadcast_lines:
        joined = own.join(F.broadcast(per_host), F.col("own_host").eqNullSafe(F.col("host")), "left")
    else:  # the pages of a host that is more than a partition are dealt out by a salt, and its lines go to each salt
        share = max(1, docs.count() // shuffle_partitions(docs.sparkSession))
        per_host = per_host.withColumn("copies", F.ceil(F.col("host_pages") / share))
        large = per_host.where("copies > 1").select(F.col("host").alias("large"), F.col("copies").alias("salts"))  # no more than there are partitions
        salted = own.join(F.broadcast(large), F.col("own_host").eqNullSafe(F.col("large")), "left").withColumn("salt", F.coalesce(F.pmod(F.monotonically_increasing_id(), "salts"), F.lit(0)))
        copies = per_host.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
        joined = salted.join(copies.hint("shuffle_hash"), F.col("own_host").eqNullSafe(F.col("host")) & (F.col("salt") == F.col("copy")), "left")
    split = joined.select("row", "text", "bad", _lines(F.col("text")).alias("lines"))
    marked = split.withColumn("digests", F.when(F.col("bad").isNotNull() & F.col("text").isNotNull(), F.transform("lines", _digest)))
    # the intersection is by hash; what it leaves to search through are the few lines that this page holds
    found = marked.withColumn("here", F.array_intersect("digests", "bad")).drop("bad")
    kept = F.filter("lines", lambda x, i: ~F.array_contains(F.col("here"), F.get("digests", i)))
    out = found.withColumn("kept", F.when(F.size("here") > 0, kept))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long")
    text = F.when(F.col("kept").isNotNull(), F.concat_ws("\n", "kept")).otherwise(F.col("text"))
    return unpacked(out, docs.columns, **{text_col: text, n_lines: n, n_removed: F.coalesce(n - F.size("kept"), F.lit(0)).cast("long")})


SQL = f"""
WITH d AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
held AS (
  SELECT source, line, count(*) AS pages
  FROM (SELECT source, unnest(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '{_INK}')))) AS line FROM d)
  GROUP BY source, line),
totals AS (SELECT source, count(*) AS host_pages FROM d GROUP BY source),
bad AS (
  SELECT held.source, list(line) AS bad FROM held JOIN totals ON held.source IS NOT DISTINCT FROM totals.source
  WHERE pages >= {REPEAT} AND pages * {ONE_IN} > host_pages GROUP BY held.source),
kept AS (
  SELECT doc_id, lines, CASE WHEN bad IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(bad, x)) END AS kept
  FROM d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source)
SELECT doc_id, len(lines) AS n_lines, len(lines) - len(kept) AS n_removed, sha256(array_to_string(kept, chr(10))) AS kept_sha256 FROM kept
"""
