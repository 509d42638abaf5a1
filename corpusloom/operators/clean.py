"""Cleaning of raw and of final articles: whole documents as Columns, lines as arrays, no explode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import HAN, between, count_of, let, rstrip, splitlines, strip, tag
from corpusloom.functions.words import holds, tagged
from corpusloom.operators import rules


def cut_comments(c: Column) -> Column:
    """Up to the earliest comment marker."""

    def cut(x):
        first = F.least(*[F.nullif(F.instr(x, m), F.lit(0)) for m in rules.COMMENT_MARKERS])
        return let(first, lambda at: F.when(at.isNotNull(), F.substring(x, F.lit(1), at - 1)).otherwise(x))

    return let(c, cut)


def drop_lines_raw(c: Column) -> Column:
    return F.filter(splitlines(c), lambda x: ~let(strip(x), lambda y: F.coalesce(rules.drops_raw(y), F.lit(False))))


def fix_heading(line: Column) -> Column:
    """A title of up to thirty characters between underscores becomes `## title`; any other line stays."""
    pattern = "(?d)(?U)" + rules.HEADING

    def fixed(x: Column) -> Column:
        title = strip(F.regexp_replace(strip(F.regexp_extract(x, pattern, 2)), "^_+|_+$", ""))
        return F.when(x.rlike(pattern) & (title != ""), F.concat(F.lit("## "), title)).otherwise(line)

    return F.when(F.contains(line, F.lit("_")), let(strip(line), lambda x: F.when(F.startswith(x, F.lit("_")), fixed(x)).otherwise(line))).otherwise(line)


def squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, "\n{3,}", "\n\n"))


def clean_raw(c: Column) -> Column:
    lines = F.transform(drop_lines_raw(cut_comments(c)), lambda x: rstrip(fix_heading(x)))
    return squeeze(F.array_join(lines, "\n"))


def drop_noise(lines: Column) -> Column:
    return F.filter(lines, lambda x: ~rules.is_noise(x))


def cut_tail_block(lines: Column) -> Column:
    """Everything from the first marker in the last third or the last 25 lines, whichever is less, goes."""

    def cut(arr):
        n = F.size(arr)
        zone = F.greatest(F.floor(n * 2 / 3).cast("int"), n - 25)
        marked = F.filter(F.transform(arr, lambda x, i: F.when((i >= zone) & x.rlike("(?d)(?U)" + rules.TAIL_CUT), i)), lambda i: i.isNotNull())
        return F.when(F.size(marked) > 0, F.slice(arr, F.lit(1), F.array_min(marked))).otherwise(arr)

    return let(lines, cut)


def strip_tail(lines: Column) -> Column:
    """Junk lines at the end go, one after the other."""

    def cut(arr):
        last = F.array_max(F.transform(arr, lambda x, i: F.when(~rules.is_tail_junk(x), i + 1).otherwise(0)))
        return F.slice(arr, F.lit(1), F.coalesce(last, F.lit(0)))

    return let(lines, cut)


def strip_head(lines: Column) -> Column:
    def cut(arr):
        first = F.array_min(F.filter(F.transform(arr, lambda x, i: F.when(strip(x) != "", i)), lambda i: i.isNotNull()))
        return F.when(first.isNull(), F.slice(arr, F.lit(1), F.lit(0))).otherwise(F.slice(arr, first + 1, F.size(arr)))

    return let(lines, cut)


def clean_final(c: Column) -> Column:
    """An article without noise lines, tail block and junk at its end; the zone of the tail is counted on the stripped article."""
    return squeeze(F.array_join(strip_head(strip_tail(cut_tail_block(drop_noise(splitlines(strip(c)))))), "\n"))


def final_record(output: Column, least: int = 800, charset: str = HAN) -> Column:
    """struct<status, output>: untagged (kept as it is, not counted), untouched, cleaned or dropped."""
    pattern = r"(?s)<article>\n?(.*?)\n?</article>"

    def judged(out, body, new):
        before = F.substring_index(out, "<article>", 1)
        rest = F.substring(out, F.length(before) + len("<article>") + 1, F.length(out))
        after = F.substring(rest, F.instr(rest, "</article>") + len("</article>"), F.length(rest))
        whole = F.concat(before, F.lit("<article>\n"), new, F.lit("\n</article>"), after)
        status = F.when(~out.rlike(pattern), "untagged").when(count_of(new, charset) < least, "dropped").when(new == strip(body), "untouched").otherwise("cleaned")
        return let(status, lambda s: F.struct(s.alias("status"), F.when(s == "cleaned", whole).otherwise(out).alias("output")))

    return let(output, lambda out: let(F.regexp_extract(out, pattern, 1), lambda body: let(clean_final(body), lambda new: judged(out, body, new))))


TAGS = ("<thinking>", "</thinking>", "<article>", "</article>")


def gate_reason(instruction: Column, input_: Column, output: Column, least: int = 800, charset: str = HAN) -> Column:
    """The first reason to reject a record; null if it passes. Tags in a wrong order have a reason of their own."""
    return let(F.coalesce(output, F.lit("")), lambda out: _reason(instruction, input_, out, least, charset))


def _reason(instruction: Column, input_: Column, out: Column, least: int, charset: str) -> Column:
    empty = (F.coalesce(instruction, F.lit("")) == "") | (F.coalesce(input_, F.lit("")) == "")
    reason = F.when(empty, "no instruction or input")
    for t in TAGS:
        reason = reason.when(~F.contains(out, F.lit(t)), f"no {t}")
    untold = ~F.contains(F.substring_index(out, "</thinking>", 1), F.lit("核心矛盾"))
    article = let(tag(out, "article"), lambda x: F.when(x.isNull(), "tags out of order").when(count_of(x, charset) < least, "too short"))
    return reason.when(untold, "no 核心矛盾").otherwise(article)


def warnings_forward(thinking: Column, article: Column, charset: str = HAN) -> Column:
    length = let(count_of(article, charset), lambda n: F.when(n < 1200, F.lit("short")).when(n > 3200, F.lit("long")))
    found = [F.when(F.contains(thinking, F.lit(p)), F.lit(f"meta: {p}")) for p in rules.META_PHRASES]
    found += [F.when(~F.contains(thinking, F.lit("核心矛盾")), F.lit("no 核心矛盾")), F.when(~F.startswith(article, F.lit("#")), F.lit("no heading")), length]
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def warnings_reverse(input_: Column, thinking: Column, least: int | None = None, charset: str = HAN) -> Column:
    """All that is amiss; with least, thinking of fewer characters too."""
    found = [F.when(~F.contains(input_, F.lit(f)), F.lit(f"no {f}")) for f in rules.INPUT_FIELDS]
    found += [F.when(~F.contains(thinking, F.lit("核心矛盾")), F.lit("no 核心矛盾"))]
    found += [F.when(F.contains(thinking, F.lit(k)), F.lit(f"review tone {k}")) for k in rules.REVIEW_TONE]
    found += [F.when(count_of(thinking, charset) < least, F.lit("short thinking"))] if least else []
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def without_prefix(docs, name: str = "name", prefix: str = rules.TITLE_PREFIX):
    """docs but for those whose name begins with the prefix; a null name stays."""
    return docs.where(~F.coalesce(F.startswith(F.col(name), F.lit(prefix)), F.lit(False)))


def ab_score(raw: Column, charset: str = HAN) -> Column:
    """The ten-point rubric in hundredths: format, five points, tone, length."""
    words = (*rules.FIVE_POINTS, *rules.REVIEW_TONE, *rules.PLAN_WORDS, *rules.PLAN_AROUND)
    tags = tagged(raw, input=rules.INPUT_FIELDS, thinking=words)
    asked, seen, thought = tags.input, tags.thinking, between(raw, "thinking")
    n = seen.han if charset == HAN else count_of(thought, charset)
    both = asked.isNotNull() & seen.isNotNull()
    planned = holds(seen.found, words, *rules.PLAN_WORDS) | (holds(seen.found, words, rules.PLAN_AROUND[0]) & holds(seen.found, words, rules.PLAN_AROUND[1]) & thought.rlike(rules.PLAN_TONE))
    length = F.when(n.between(300, 500), 100).when(n.between(250, 600), 50).otherwise(0)
    told = sum((holds(seen.found, words, w).cast("int") for w in rules.FIVE_POINTS), F.lit(0)) * 60 + F.when(planned, 150).otherwise(0)
    told = told + F.when(~holds(seen.found, words, *rules.REVIEW_TONE), 150).otherwise(0) + length
    told = F.coalesce(told, F.when(raw.isNotNull(), 150))  # without a thought there is no wrong tone
    fields = F.round(F.bit_count(F.coalesce(asked.found, F.when(raw.isNotNull(), F.lit(0)).cast("long"))) * 200 / 3).cast("int")
    return (F.when(both, 100).otherwise(0) + fields + told).cast("long")
