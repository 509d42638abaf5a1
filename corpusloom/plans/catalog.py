"""The queries of the engine's own operators, and the DuckDB SQL that each must equal.

The corpus is documents, spelt in Han characters one for one and given lines that the cleaning rules look for; scores come
from the deterministic scorer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions.rouge import rouge_l_udf
from corpusloom.operators import chat, clean, dedup, metrics, rules, scan, scoring
from corpusloom.session import shared_dir, ship_package, spread
from corpusloom.sources.io import table, union_sources

LATIN, HAN_FOR = "abcdefghijklmnopqrstuvwxyz", "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余"
LONG_TITLE = "_" + "长" * 40 + "_"
HEADS = (
    "作者：某某", "_ _ 标题 _ _", "正文 a@b.com 联系", "**想涨知识**", "去阅读", "普通的一行", "封面来源：网络", "以下文章来源于别处",
    "_小标题_", "__双线__", "_ 独行 _ _", LONG_TITLE, "", "编辑：某某\n", "![图](http://x.cn/1.png)",
)
TAILS = ("点个在看", "[1] 文献 http://x.cn/1", "参考文献", "微信扫一扫 关注", "修改于", "结尾", "***")
QUERIES: dict = {}
SQL: dict = {}

ARTICLES = f"""
articles AS (
  SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '早报' ELSE '' END || source || '_' || doc_id || '.md' AS name, lang, translate(lower(text), '{LATIN}', '{HAN_FOR}') AS han,
    ({"[" + ", ".join("'" + h.replace(chr(10), "' || chr(10) || '") + "'" for h in HEADS) + "]"})[(doc_id % {len(HEADS)} + 1)::INT] || chr(10) || translate(lower(text), '{LATIN}', '{HAN_FOR}') || chr(10) || chr(10) || chr(10) || chr(10) ||
    ({"[" + ", ".join(map(repr, TAILS)) + "]"})[(doc_id % 7 + 1)::INT] || chr(10) || '尾行' || (doc_id % 3)::VARCHAR AS body
  FROM documents)"""
COUNT = "len(regexp_replace({}, '[^\\x{{4e00}}-\\x{{9fff}}]', '', 'g'))"
SCORES = f"""{ARTICLES},
scored AS (
  SELECT name AS file, ({COUNT.format("han")})::INT AS chars, ('0x' || substr(md5(name), 1, 1))::INT % 5 + 1 AS depth, ('0x' || substr(md5(name), 2, 1))::INT % 5 + 1 AS evidence,
    ({list(scoring.GENRES)})[('0x' || substr(md5(name), 3, 1))::INT % 5 + 1] AS genre, ({list(scoring.TOPICS)})[('0x' || substr(md5(name), 4, 1))::INT % 6 + 1] AS topic
  FROM articles)"""


def re2(pattern: str) -> str:
    """A rule's pattern for DuckDB, whose \\w is ASCII alone."""
    return pattern.replace(r"[\w.-]", r"[\p{L}\p{N}\p{M}_.-]").replace(r"\w", r"[\p{L}\p{N}\p{M}_]")


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    han = F.translate(F.lower("text"), LATIN, HAN_FOR)
    head = F.element_at(F.array(*map(F.lit, HEADS)), (F.col("doc_id") % len(HEADS) + 1).cast("int"))
    tail = F.element_at(F.array(*map(F.lit, TAILS)), (F.col("doc_id") % 7 + 1).cast("int"))
    body = F.concat(head, F.lit("\n"), han, F.lit("\n\n\n\n"), tail, F.lit("\n尾行"), (F.col("doc_id") % 3).cast("string"))
    return d.select("doc_id", F.concat(F.when(F.col("doc_id") % 11 == 0, rules.TITLE_PREFIX).otherwise(""), "source", F.lit("_"), "doc_id", F.lit(".md")).alias("name"), "lang", han.alias("han"), body.alias("body"))


def scores(spark, sf_dir):
    return scoring.stub_scores(articles(spark, sf_dir).select("name", t.count_of(F.col("han")).alias("n")))


@query(f"WITH {ARTICLES} SELECT doc_id, ({COUNT.format('han')})::BIGINT AS n_han FROM articles")
def charset_count(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", t.count_of(F.col("han")).cast("long").alias("n_han"))


@query(f"WITH {ARTICLES} SELECT doc_id, lower(regexp_replace(replace(name, '.md', ''), '[^\\p{{L}}\\p{{N}}_]', '', 'g')) AS title FROM articles")
def normalize_title(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", t.normalize_title(F.col("name")).alias("title"))


@query("SELECT doc_id, substr(regexp_replace(substr(text, 1, 60), '[^\\p{L}\\p{N}\\p{M}_]+', '_', 'g'), 1, 30) AS topic FROM documents")
def safe_topic(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.safe_topic(F.col("text")).alias("topic"))


@query(f"WITH {ARTICLES} SELECT doc_id, floor(({COUNT.format('han')}) * 1.6::DOUBLE)::BIGINT AS tokens FROM articles")
def est_tokens(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", t.est_tokens(F.col("han")).alias("tokens"))


@query("SELECT doc_id, substr(text, 1, 40) AS head, md5(substr(text, 1, 3000)) AS m3, md5(substr(text, 1, 6000)) AS m6 FROM documents")
def truncate_heads(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, 40).alias("head"), F.md5(F.substring("text", 1, 3000).cast("binary")).alias("m3"), F.md5(F.substring("text", 1, 6000).cast("binary")).alias("m6"))


@query("SELECT page_id, md5(trim(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), ' ' || chr(9) || chr(10) || chr(13))) AS article FROM pages")
def extract_tag_article(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(t.tag(F.col("html"), "article").cast("binary")).alias("article"))


REPLIES = f"""{ARTICLES}, replies AS (
  SELECT doc_id, CASE doc_id % 6
    WHEN 0 THEN '```json' || chr(10) || '{{"depth": ' || (doc_id % 5 + 1) || ', "evidence": "' || (length(han) % 5 + 1) || '", "genre": "访谈", "topic": "' || lang || '"}}' || chr(10) || '```'
    WHEN 1 THEN '{{"depth": ' || (doc_id % 4) || '.7, "evidence": ' || (length(han) % 3) || ', "genre": "访谈", "topic": "' || lang || '"}} {{"depth": 9}}'
    WHEN 2 THEN '{{"depth": 3, "genre": "' || lang || '"}}'
    WHEN 3 THEN '{{"depth": "3.7", "evidence": 2, "genre": "访谈", "topic": "' || lang || '"}}'
    WHEN 4 THEN '{{"depth": 3, "evidence": 2, "genre": {{"of": "访谈"}}, "topic": "' || lang || '"}}'
    ELSE substr(han, 1, 20) END AS reply FROM articles),
bodies AS (SELECT doc_id, regexp_extract(reply, '(?s)\\{{.*?\\}}', 0) AS b FROM replies),
parsed AS (SELECT doc_id, CASE WHEN json_valid(b) THEN b::JSON END AS j FROM bodies),
fields AS (
  SELECT doc_id, j->>'topic' AS topic, j->>'genre' AS genre,
    CASE WHEN json_type(j, 'depth') = 'VARCHAR' THEN TRY_CAST(CASE WHEN regexp_matches(j->>'depth', '^[0-9]+$') THEN j->>'depth' END AS INT) ELSE trunc(TRY_CAST(j->>'depth' AS DOUBLE))::INT END AS depth,
    CASE WHEN json_type(j, 'evidence') = 'VARCHAR' THEN TRY_CAST(CASE WHEN regexp_matches(j->>'evidence', '^[0-9]+$') THEN j->>'evidence' END AS INT) ELSE trunc(TRY_CAST(j->>'evidence' AS DOUBLE))::INT END AS evidence FROM parsed),
usable AS (SELECT *, depth IS NOT NULL AND evidence IS NOT NULL AND genre IS NOT NULL AND topic IS NOT NULL AS ok FROM fields)"""


def _replies():
    i, n = F.col("doc_id"), F.length("han")
    forms = (
        ('```json\n{"depth": %d, "evidence": "%d", "genre": "访谈", "topic": "%s"}\n```', i % 5 + 1, n % 5 + 1, "lang"), ('{"depth": %d.7, "evidence": %d, "genre": "访谈", "topic": "%s"} {"depth": 9}', i % 4, n % 3, "lang"),
        ('{"depth": 3, "genre": "%s"}', "lang"), ('{"depth": "3.7", "evidence": 2, "genre": "访谈", "topic": "%s"}', "lang"), ('{"depth": 3, "evidence": 2, "genre": {"of": "访谈"}, "topic": "%s"}', "lang"),
    )
    out = F.when(F.lit(False), "")
    for k, (form, *values) in enumerate(forms):
        out = out.when(i % 6 == k, F.format_string(form, *values))
    return out.otherwise(F.substring("han", 1, 20))


@query(f"WITH {REPLIES} SELECT doc_id, CASE WHEN ok THEN depth END AS depth, CASE WHEN ok THEN evidence END AS evidence, CASE WHEN ok THEN topic END AS topic FROM usable")
def extract_json_score(spark, sf_dir):
    d = articles(spark, sf_dir)
    return d.select("doc_id", t.reply_scores(_replies()).alias("s")).select("doc_id", "s.depth", "s.evidence", "s.topic")


@query(f"WITH {ARTICLES} SELECT doc_id, md5(substr(regexp_replace(han, '[^\\x{{4e00}}-\\x{{9fff}}]', '', 'g'), 1, 500)) AS fp FROM articles")
def fingerprint_md5(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", t.fingerprint(F.col("han")).alias("fp"))


@query(f"""WITH {ARTICLES} SELECT doc_id, CASE WHEN length(han) > 8000 THEN 'kimi'
WHEN (list_sum([('0x' || substr(md5(name), k, 1))::INT * CASE WHEN k = 32 THEN 1 ELSE 6 END FOR k IN range(1, 33)]) % 10) < 7 THEN 'qwen' ELSE 'kimi' END AS teacher FROM articles""")
def route_teacher(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", t.route_teacher(F.col("name"), F.length("han")).alias("teacher"))


CUT = f"""{ARTICLES}, cut AS (SELECT *, list_min(list_filter([{", ".join(f"instr(body, '{m}')" for m in rules.COMMENT_MARKERS)}], lambda x: x > 0)) AS first FROM articles),
trimmed AS (SELECT *, CASE WHEN first IS NULL THEN body ELSE substr(body, 1, first - 1) END AS b FROM cut)"""
RE2 = [p.replace("'", "''") for p in rules.RAW_LINE_DROP]
RAW_LINES = f"""{CUT}, lines AS (
  SELECT *, list_filter(string_split(regexp_replace(b, '\\n$', ''), chr(10)), lambda x: NOT ({" OR ".join(f"regexp_matches(trim(x, ' '), '{p}')" for p in RE2)} OR trim(x, ' ') IN ('End', '阅读', '去阅读', '['))) AS kept FROM trimmed)"""
TITLE = f"trim(trim(trim(regexp_extract(trim(x, ' '), '{rules.HEADING}', 2), ' '), '_'), ' ')"
FIXED = f"""{RAW_LINES}, fixed AS (
  SELECT *, list_transform(kept, lambda x: CASE WHEN starts_with(trim(x, ' '), '_') AND {TITLE} <> '' THEN '## ' || {TITLE} ELSE rtrim(x, ' ') END) AS done FROM lines)"""
RAW_CLEAN = f"""{FIXED}, raw_clean AS (SELECT *, trim(regexp_replace(array_to_string(done, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS cleaned FROM fixed)"""


@query(f"WITH {CUT} SELECT doc_id, md5(b) AS cut FROM trimmed")
def cut_comment_markers(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.md5(clean.cut_comments(F.col("body")).cast("binary")).alias("cut"))


@query(f"WITH {RAW_LINES} SELECT doc_id, len(kept)::BIGINT AS n, md5(array_to_string(kept, chr(10))) AS kept FROM lines")
def drop_lines_raw(spark, sf_dir):
    kept = clean.drop_lines_raw(clean.cut_comments(F.col("body")))
    return articles(spark, sf_dir).select("doc_id", kept.alias("k")).select("doc_id", F.size("k").cast("long").alias("n"), F.md5(F.array_join("k", "\n").cast("binary")).alias("kept"))


@query(f"WITH {FIXED} SELECT doc_id, len(list_filter(done, lambda x: starts_with(x, '## ')))::BIGINT AS headings, list_filter(done, lambda x: starts_with(x, '## '))[1] AS first FROM fixed")
def fix_headings(spark, sf_dir):
    lines = F.transform(clean.drop_lines_raw(clean.cut_comments(F.col("body"))), clean.fix_heading)
    found = articles(spark, sf_dir).select("doc_id", F.filter(lines, lambda x: F.startswith(x, F.lit("## "))).alias("h"))
    return found.select("doc_id", F.size("h").cast("long").alias("headings"), F.get("h", F.lit(0)).alias("first"))


@query(f"WITH {ARTICLES} SELECT doc_id, md5(trim(regexp_replace(body, '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))) AS squeezed FROM articles")
def squeeze_blank(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.md5(clean.squeeze(F.col("body")).cast("binary")).alias("squeezed"))


@query(f"WITH {RAW_CLEAN} SELECT doc_id, md5(cleaned) AS cleaned, ({COUNT.format('cleaned')})::BIGINT AS n FROM raw_clean WHERE n >= 1200")
def clean_raw_full(spark, sf_dir):
    both = t.let(clean.clean_raw(F.col("body")), lambda c: F.struct(F.md5(c.cast("binary")).alias("cleaned"), t.count_of(c).cast("long").alias("n")))
    kept = F.filter(F.array(both), lambda r: r.n >= 1200)  # as a filter the cleaning would be planned twice
    return articles(spark, sf_dir).select("doc_id", F.inline(kept))


@query(f"""WITH {RAW_CLEAN}, c AS (SELECT lang, coalesce(starts_with(name, '早报'), false) AS skipped, coalesce({COUNT.format('cleaned')}, 0)::BIGINT AS n FROM raw_clean),
k AS (SELECT *, NOT skipped AND n >= 1200 AS kept FROM c)
SELECT lang, count(*) AS total, count(*) FILTER (skipped) AS zaobao, count(*) FILTER (NOT skipped AND NOT kept) AS too_short, count(*) FILTER (kept) AS ok,
  min(n) FILTER (kept) AS least, list_sort(list(n) FILTER (kept))[(count(*) FILTER (kept) // 2 + 1)::INT] AS median, max(n) FILTER (kept) AS most FROM k GROUP BY lang""")
def clean_raw_stats(spark, sf_dir):
    n = F.coalesce(t.count_of(clean.clean_raw(F.col("body"))).cast("long"), F.lit(0))
    d = articles(spark, sf_dir).select("lang", "body", F.coalesce(F.startswith("name", F.lit("早报")), F.lit(False)).alias("skipped"))
    counted = d.groupBy("lang", "skipped", F.when(~F.col("skipped"), n).alias("n")).agg(F.count("*").alias("c"))  # the one place that cleans
    kept = F.col("n") >= 1200
    w = Window.partitionBy("lang")
    here = F.sum(F.when(kept, F.col("c")).otherwise(0))
    placed = counted.select("*", here.over(w).alias("_ok"), here.over(w.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"))
    held = lambda which: F.sum(F.when(which, F.col("c")).otherwise(0))
    return placed.groupBy("lang").agg(
        F.sum("c").alias("total"), held(F.col("skipped")).alias("zaobao"), held(F.col("n") < 1200).alias("too_short"), held(kept).alias("ok"),
        F.min(F.when(kept, F.col("n"))).alias("least"), F.min(F.when(kept & (F.col("_upto") > F.floor(F.col("_ok") / 2)), F.col("n"))).alias("median"), F.max(F.when(kept, F.col("n"))).alias("most"),
    )


NOISE = " OR ".join(f"(len(x) <= {cap} AND regexp_matches(x, '{re2(p)}'))" for p, cap in rules.LINE_NOISE)
JUNK = " OR ".join([f"regexp_matches(x, '{p}')" for p in rules.TAIL_JUNK] + [NOISE])
NOISELESS = f"{ARTICLES}, noiseless AS (SELECT *, list_filter(string_split(trim(body, ' ' || chr(10)), chr(10)), lambda x: NOT ({NOISE})) AS l1 FROM articles)"
CUT_TAIL = f"""{NOISELESS}, tailcut AS (
  SELECT *, list_filter(range(1, len(l1) + 1), lambda i: i - 1 >= greatest(len(l1) * 2 // 3, len(l1) - 25) AND regexp_matches(l1[i], '{rules.TAIL_CUT}')) AS marks FROM noiseless),
l2 AS (SELECT *, CASE WHEN len(marks) > 0 THEN l1[:marks[1] - 1] ELSE l1 END AS l2 FROM tailcut)"""
STRIPPED = f"""{CUT_TAIL}, l3 AS (SELECT *, l2[:coalesce(list_max(list_filter(range(1, len(l2) + 1), lambda i: NOT (list_contains(list_filter([l2[i]], lambda x: {JUNK}), l2[i])))), 0)] AS l3 FROM l2)"""
FINAL = f"""{STRIPPED}, final AS (SELECT *, trim(regexp_replace(array_to_string(l3, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS f FROM l3)"""


@query(f"WITH {NOISELESS} SELECT doc_id, len(l1)::BIGINT AS n, md5(array_to_string(l1, chr(10))) AS kept FROM noiseless")
def line_noise_filter(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", clean.drop_noise(t.splitlines(t.strip(F.col("body")))).alias("k")).select("doc_id", F.size("k").cast("long").alias("n"), F.md5(F.array_join("k", "\n").cast("binary")).alias("kept"))


@query(f"WITH {CUT_TAIL} SELECT doc_id, len(l2)::BIGINT AS n FROM l2")
def tail_block_cut(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.size(clean.cut_tail_block(clean.drop_noise(t.splitlines(t.strip(F.col("body")))))).cast("long").alias("n"))


@query(f"WITH {STRIPPED} SELECT doc_id, len(l3)::BIGINT AS n FROM l3")
def tail_strip(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.size(clean.strip_tail(clean.cut_tail_block(clean.drop_noise(t.splitlines(t.strip(F.col("body"))))))).cast("long").alias("n"))


@query(f"WITH {FINAL} SELECT doc_id, md5(f) AS cleaned FROM final")
def clean_final_full(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.md5(clean.clean_final(F.col("body")).cast("binary")).alias("cleaned"))


RECORDS = f"""{FINAL}, records AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN body ELSE '前言<article>' || chr(10) || body || chr(10) || '</article>后记 <article>二</article>' END AS output FROM final),
cleaned AS (
  SELECT *, CASE WHEN NOT contains(output, '<article>') THEN 'untagged' WHEN {COUNT.format('f')} < 800 THEN 'dropped' WHEN f = trim(body, ' ' || chr(10)) THEN 'untouched' ELSE 'cleaned' END AS status FROM records)"""


def _final(spark, sf_dir):
    tagged = F.concat(F.lit("前言<article>\n"), "body", F.lit("\n</article>后记 <article>二</article>"))
    return articles(spark, sf_dir).select("doc_id", clean.final_record(F.when(F.col("doc_id") % 5 == 0, F.col("body")).otherwise(tagged)).alias("r"))


@query(f"WITH {RECORDS} SELECT status, count(*) AS n FROM cleaned GROUP BY ALL")
def clean_final_stats(spark, sf_dir):
    return _final(spark, sf_dir).groupBy(F.col("r.status").alias("status")).agg(F.count("*").alias("n"))


@query(f"""WITH {RECORDS} SELECT doc_id, status, md5(CASE WHEN status = 'cleaned' THEN '前言<article>' || chr(10) || f || chr(10) || '</article>后记 <article>二</article>' ELSE output END) AS output FROM cleaned WHERE status <> 'dropped'""")
def clean_final_records(spark, sf_dir):
    kept = _final(spark, sf_dir).select("doc_id", F.inline(F.filter(F.array("r"), lambda r: r.status != "dropped")))
    return kept.select("doc_id", "status", F.md5(F.col("output").cast("binary")).alias("output"))


def records(spark, sf_dir):
    i = F.col("doc_id")
    output = (
        F.when(i % 6 == 0, F.concat(F.lit("<article>"), "han", F.lit("</article>"))).when(i % 6 == 1, t.build_output(F.lit("没有"), F.col("han")))
        .when(i % 6 == 2, F.concat(F.lit("核心矛盾</article><article><thinking></thinking>"), "han")).otherwise(t.build_output(F.lit("核心矛盾 我会"), F.col("body")))
    )
    return articles(spark, sf_dir).select("doc_id", F.when(i % 9 != 0, F.lit("写文章")).alias("instruction"), t.build_input(F.col("lang"), F.lit("众"), F.lit("求")).alias("input"), output.alias("output"), "han")


REASONS = f"""{ARTICLES}, records AS (
  SELECT doc_id, CASE WHEN doc_id % 9 <> 0 THEN '写文章' END AS instruction, '主题：' || lang || chr(10) || '受众：众' || chr(10) || '要求：求' AS input,
    CASE doc_id % 6 WHEN 0 THEN '<article>' || han || '</article>'
      WHEN 1 THEN '<thinking>' || chr(10) || '没有' || chr(10) || '</thinking>' || chr(10) || chr(10) || '<article>' || chr(10) || han || chr(10) || '</article>'
      WHEN 2 THEN '核心矛盾</article><article><thinking></thinking>' || han
      ELSE '<thinking>' || chr(10) || '核心矛盾 我会' || chr(10) || '</thinking>' || chr(10) || chr(10) || '<article>' || chr(10) || body || chr(10) || '</article>' END AS output FROM articles),
bodies AS (SELECT *, string_split(output, '</thinking>')[1] AS thought, regexp_matches(output, '(?s)<article>(.*?)</article>') AS tagged, regexp_extract(output, '(?s)<article>(.*?)</article>', 1) AS article FROM records),
reasons AS (
  SELECT doc_id, CASE WHEN coalesce(instruction, '') = '' OR coalesce(input, '') = '' THEN 'no instruction or input'
    {" ".join(f"WHEN NOT contains(output, '{tag}') THEN 'no {tag}'" for tag in clean.TAGS)}
    WHEN NOT contains(thought, '核心矛盾') THEN 'no 核心矛盾' WHEN NOT tagged THEN 'tags out of order' WHEN {COUNT.format('article')} < 800 THEN 'too short' END AS reason FROM bodies)"""


@query(f"WITH {REASONS} SELECT reason, count(*) AS n FROM reasons WHERE reason IS NOT NULL GROUP BY ALL")
def quality_gate_reasons(spark, sf_dir):
    r = records(spark, sf_dir).select(clean.gate_reason(F.col("instruction"), F.col("input"), F.col("output")).alias("reason"))
    return r.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


@query(f"WITH {REASONS} SELECT doc_id FROM reasons WHERE reason IS NULL")
def gate_passed(spark, sf_dir):
    return records(spark, sf_dir).where(clean.gate_reason(F.col("instruction"), F.col("input"), F.col("output")).isNull()).select("doc_id")


@query(f"""WITH {ARTICLES}, c AS (SELECT doc_id, {COUNT.format('han')} AS n FROM articles)
SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 2 = 0 THEN 'no 核心矛盾' END, 'no heading', CASE WHEN n < 1200 THEN 'short' WHEN n > 3200 THEN 'long' END], lambda x: x IS NOT NULL), '|') AS warnings FROM c""")
def validate_forward(spark, sf_dir):
    thinking = F.when(F.col("doc_id") % 2 == 0, "无").otherwise("核心矛盾")
    return articles(spark, sf_dir).select("doc_id", F.array_join(clean.warnings_forward(thinking, F.col("han")), "|").alias("warnings"))


REVERSE = f"""{ARTICLES}, asked AS (
  SELECT doc_id, '主题：' || lang || '受众：' || CASE WHEN doc_id % 3 = 0 THEN '' ELSE '要求：' END AS input, CASE WHEN doc_id % 2 = 0 THEN '本文' ELSE '核心矛盾' END || han AS thinking FROM articles)"""
AMISS = (
    [f"CASE WHEN NOT contains(input, '{f}') THEN 'no {f}' END" for f in rules.INPUT_FIELDS] + ["CASE WHEN NOT contains(thinking, '核心矛盾') THEN 'no 核心矛盾' END"]
    + [f"CASE WHEN contains(thinking, '{k}') THEN 'review tone {k}' END" for k in rules.REVIEW_TONE]
)


def _reverse(spark, sf_dir, least=None):
    i = F.col("doc_id")
    asked = F.concat(F.lit("主题："), "lang", F.lit("受众："), F.when(i % 3 == 0, "").otherwise("要求："))
    thinking = F.concat(F.when(i % 2 == 0, "本文").otherwise("核心矛盾"), "han")
    return articles(spark, sf_dir).select("doc_id", F.array_join(clean.warnings_reverse(asked, thinking, least), "|").alias("warnings"))


@query(f"WITH {REVERSE} SELECT doc_id, array_to_string(list_filter([{', '.join(AMISS)}], lambda x: x IS NOT NULL), '|') AS warnings FROM asked")
def validate_reverse(spark, sf_dir):
    return _reverse(spark, sf_dir)


@query(f"WITH {REVERSE} SELECT doc_id, array_to_string(list_filter([{', '.join(AMISS)}, CASE WHEN {COUNT.format('thinking')} < 200 THEN 'short thinking' END], lambda x: x IS NOT NULL), '|') AS warnings FROM asked")
def validate_reverse_single(spark, sf_dir):
    return _reverse(spark, sf_dir, 200)


def _scan_sql():
    scoped = f"""{RECORDS}, scoped AS (SELECT doc_id, CASE WHEN regexp_matches(output, '(?s)<article>(.*?)</article>') THEN regexp_extract(output, '(?s)<article>(.*?)</article>', 1) ELSE output END AS article FROM records),
tails AS (SELECT *, array_to_string(string_split(trim(article, ' ' || chr(10)), chr(10))[-15:], chr(10)) AS tail FROM scoped)"""
    hits = []
    for k, (p, last) in rules.SCAN.items():
        text = "tail" if last else "article"
        whole = f"regexp_extract({text}, '(?s)^.*?((?-s:{re2(p)}))', 0)"
        begin = f"length({whole}) - length(regexp_extract({text}, '{re2(p)}', 0))"
        cut = f"replace(substr({text}, greatest(0, {begin} - 30) + 1, length({whole}) - greatest(0, {begin} - 30) + 50), chr(10), ' | ')"
        hits.append(f"SELECT doc_id, '{k}' AS rule, {cut} AS excerpt FROM tails WHERE regexp_matches({text}, '{re2(p)}')")
    return f"{scoped}, hits AS ({' UNION ALL '.join(hits)})"


SCAN_SQL = _scan_sql()


def _scan(spark, sf_dir):
    tagged = F.concat(F.lit("前言<article>\n"), "body", F.lit("\n</article>后记 <article>二</article>"))
    output = F.when(F.col("doc_id") % 5 == 0, F.col("body")).otherwise(tagged)
    return scan.scan(articles(spark, sf_dir).select("doc_id", output.alias("output")), key="doc_id")


@query(f"WITH {SCAN_SQL} SELECT doc_id, rule, excerpt FROM hits")
def scan_boilerplate(spark, sf_dir):
    return _scan(spark, sf_dir)


@query(f"WITH {SCAN_SQL} SELECT rule, count(*) AS docs, min_by(excerpt, doc_id) AS example FROM hits GROUP BY ALL")
def scan_boilerplate_hits(spark, sf_dir):
    return scan.summary(_scan(spark, sf_dir), "doc_id")


@query(f"WITH {SCAN_SQL} SELECT (SELECT count(DISTINCT doc_id) FROM hits) AS polluted, (SELECT count(*) FROM articles) AS total")
def scan_polluted_share(spark, sf_dir):
    found = _scan(spark, sf_dir).agg(F.count_distinct("doc_id").alias("polluted"))
    return found.crossJoin(table(spark, sf_dir, "documents").agg(F.count("*").alias("total")))  # a row each


GEN = f"""{ARTICLES}, gen AS (SELECT unnest(['base', 'v1', 'v2']) AS tag, doc_id AS idx, han AS reference, unnest(['作者：某某' || chr(10) || han, body, han]) AS generated, 'https' || lang || chr(10) || lang AS input FROM articles)"""
HITS = " + ".join(f"regexp_matches(generated, '{p}')::INT" for p in rules.EVAL)


def generations(spark, sf_dir):
    ship_package(spark)
    each = F.array(*[F.struct(F.lit(n).alias("tag"), c.alias("generated")) for n, c in (("base", F.concat(F.lit("作者：某某\n"), "han")), ("v1", F.col("body")), ("v2", F.col("han")))])
    return articles(spark, sf_dir).select(F.col("doc_id").alias("idx"), F.concat(F.lit("https"), "lang", F.lit("\n"), "lang").alias("input"), F.col("han").alias("reference"), F.explode(each).alias("g")).select("g.tag", "idx", "input", "reference", "g.generated")


@query(f"WITH {GEN} SELECT tag, sum({HITS})::BIGINT AS hits, count(*) AS n FROM gen GROUP BY tag")
def boilerplate_hits_by_tag(spark, sf_dir):
    return generations(spark, sf_dir).groupBy("tag").agg(F.sum(rules.eval_hits(F.col("generated"))).alias("hits"), F.count("*").alias("n"))


TAGS = ("base", "v1", "v2", "v3")  # no generation has the last


@query(f"WITH {GEN} SELECT " + ", ".join(f"avg({HITS}) FILTER (tag = '{x}') AS {x}_hits, avg({COUNT.format('generated')}) FILTER (tag = '{x}') AS {x}_len" for x in TAGS) + " FROM gen")
def eval_matrix(spark, sf_dir):
    p = generations(spark, sf_dir).select("tag", "generated", rules.eval_words(F.col("generated")).alias("p"))
    g = p.select("tag", rules.eval_hits(F.col("generated"), F.col("p.found")).alias("h"), F.col("p.han").alias("l"))
    return g.groupBy().pivot("tag", list(TAGS)).agg(F.avg("h").alias("hits"), F.avg("l").alias("len"))


@query()
def eval_matrix_rouge(spark, sf_dir):
    """All cells: mean ROUGE-L, hits and length of each tag; a tag without generations has nulls."""
    p = generations(spark, sf_dir).select("tag", "generated", rouge_l_udf("generated", "reference").alias("r"), rules.eval_words(F.col("generated")).alias("p"))
    g = p.select("tag", "r", rules.eval_hits(F.col("generated"), F.col("p.found")).alias("h"), F.col("p.han").alias("l"))
    return g.groupBy().pivot("tag", list(TAGS)).agg(F.round(F.avg("r"), 6).alias("rouge_l"), F.avg("h").alias("hits"), F.avg("l").alias("len"))


@query(f"""WITH {GEN}, part AS (SELECT * FROM gen WHERE tag <> 'v2' OR idx % 3 = 0),
numbered AS (SELECT tag, idx, row_number() OVER (PARTITION BY tag ORDER BY idx) - 1 AS place FROM part)
SELECT b.place, b.idx AS base, v.idx AS v1, w.idx AS v2 FROM numbered b JOIN numbered v USING (place) JOIN numbered w USING (place) WHERE b.tag = 'base' AND v.tag = 'v1' AND w.tag = 'v2'""")
def tags_by_position(spark, sf_dir):
    """The i-th generation of every tag side by side, as far as the shortest tag goes."""
    g = generations(spark, sf_dir).select("tag", "idx").where("tag <> 'v2' or idx % 3 = 0")
    return metrics.by_position(g, "tag", ["base", "v1", "v2"], "idx")


MARK = "('0x' || substr(md5(question), {}, 1))::INT"
JUDGE = f"""{GEN}, asked AS (SELECT tag, idx, '文章主题：' || substr(string_split(input, chr(10))[1], 1, 60) || chr(10) || chr(10) || '文章正文：' || chr(10) || substr(generated, 1, 6000) AS question FROM gen),
marks AS (
  SELECT tag, idx, {MARK.format(1)} % 5 + 1.0::DOUBLE AS depth, {MARK.format(2)} % 5 + 1.0::DOUBLE AS evidence, {MARK.format(3)} % 5 + 1.5::DOUBLE AS style,
    CASE WHEN {MARK.format(5)} = 1 THEN 0.0::DOUBLE ELSE {MARK.format(4)} % 5 + 1.0::DOUBLE END AS clean, {MARK.format(5)} = 0 AS failed FROM asked)"""


@query(f"WITH {JUDGE} SELECT tag, idx, CASE WHEN NOT failed THEN depth END AS depth, CASE WHEN NOT failed THEN evidence END AS evidence, CASE WHEN NOT failed THEN style END AS style, CASE WHEN NOT failed THEN clean END AS clean FROM marks")
def llm_judge(spark, sf_dir):
    return chat.judge(generations(spark, sf_dir))


@query(f"""WITH {JUDGE}, each AS (SELECT tag, unnest(['depth', 'evidence', 'style', 'clean', 'all', 'all', 'all', 'all']) AS dim, unnest([depth, evidence, style, clean, depth, evidence, style, clean]) AS mark FROM marks WHERE NOT failed)
SELECT tag, dim, round(avg(mark), 6) AS mean, count(*) AS n FROM each GROUP BY ALL""")
def judge_means_by_tag(spark, sf_dir):
    return chat.judged(chat.judge(generations(spark, sf_dir)))


DIGIT = "('0x' || substr(md5('请评估以下文章：' || chr(10) || chr(10) || substr(body, 1, 3000)), {}, 1))::INT"


@query(f"""WITH {ARTICLES}, s AS (SELECT *, {DIGIT.format(5)} > 0 AS ok FROM articles)
SELECT name AS file, ({COUNT.format('body')})::INT AS chars, CASE WHEN ok THEN {DIGIT.format(1)} % 5 + 1 END AS depth, CASE WHEN ok THEN {DIGIT.format(2)} % 5 + 1 END AS evidence,
  CASE WHEN ok THEN ({list(scoring.GENRES)})[{DIGIT.format(3)} % 5 + 1] END AS genre, CASE WHEN ok THEN ({list(scoring.TOPICS)})[{DIGIT.format(4)} % 6 + 1] END AS topic,
  CASE WHEN NOT ok THEN 'unusable reply' END AS error FROM s""")
def llm_score(spark, sf_dir):
    return chat.score(articles(spark, sf_dir).select("name", F.col("body").alias("text")))


def _written(question: str) -> str:
    return f"""d AS (SELECT *, {", ".join(f"('0x' || substr(md5({question}), {k}, 1))::INT AS d{k}" for k in (1, 2, 3, 4))} FROM q)"""


@query(f"""WITH {ARTICLES}, q AS (SELECT name, trim(body, ' ' || chr(10)) AS article FROM articles), {_written("'请反推以下文章的写作任务和构思：' || chr(10) || chr(10) || article")}
SELECT name, CASE WHEN d1 > 0 THEN md5('<thinking>' || chr(10) || '核心矛盾 ' || d2 || chr(10) || '</thinking>' || chr(10) || chr(10) || '<article>' || chr(10) || article || chr(10) || '</article>') END AS output,
  CASE WHEN d1 > 0 THEN '主题：' || d3 || chr(10) || '受众：众' || chr(10) || '要求：求' END AS input, CASE WHEN d1 > 0 THEN 'done' ELSE 'failed' END AS status, CASE WHEN d1 > 0 THEN 0 END AS warnings,
  CASE WHEN length(article) > 8000 THEN 'kimi' WHEN (list_sum([('0x' || substr(md5(name), k, 1))::INT * CASE WHEN k = 32 THEN 1 ELSE 6 END FOR k IN range(1, 33)]) % 10) < 7 THEN 'qwen' ELSE 'kimi' END AS teacher FROM d""")
def llm_reverse(spark, sf_dir):
    r = chat.reverse(articles(spark, sf_dir).select("name", F.col("body").alias("text")))
    return r.select("name", F.md5(F.col("output").cast("binary")).alias("output"), "input", "status", F.when(F.col("warnings").isNotNull(), F.size("warnings")).alias("warnings"), "teacher")


@query(f"""WITH q AS (SELECT DISTINCT source || ' ' || lang AS topic FROM documents), {_written("'主题：' || topic || chr(10) || '受众：众' || chr(10) || '要求：求'")}
SELECT topic, CASE WHEN d1 > 0 THEN '<thinking>' || chr(10) || '核心矛盾 ' || d2 || chr(10) || '</thinking>' || chr(10) || chr(10) || '<article>' || chr(10) || '# 题 ' || d4 || chr(10) || '文' || chr(10) || '</article>' END AS output,
  CASE WHEN d1 > 0 THEN 'short' END AS warnings, CASE WHEN d1 > 0 THEN 'done' ELSE 'failed' END AS status FROM d""")
def llm_forward(spark, sf_dir):
    topics = table(spark, sf_dir, "documents").select(F.concat_ws(" ", "source", "lang").alias("topic")).distinct()
    return chat.forward(topics, audience="众", requirements="求").select("topic", "output", F.array_join("warnings", "|").alias("warnings"), "status")


CHAT = f"""{ARTICLES}, chats AS (
  SELECT doc_id, '<|im_start|>system' || chr(10) || '写文章' || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || lang || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || han || '<|im_end|>' || chr(10) AS chat FROM articles)"""


@query(f"WITH {CHAT} SELECT doc_id, md5(chat) AS chat, floor(({COUNT.format('chat')}) * 1.6::DOUBLE)::BIGINT AS tokens FROM chats")
def chat_length(spark, sf_dir):
    c = chat.chat_text(F.lit("写文章"), F.col("lang"), F.col("han"))
    return articles(spark, sf_dir).select("doc_id", c.alias("c")).select("doc_id", F.md5(F.col("c").cast("binary")).alias("chat"), chat.token_length(F.col("c")).alias("tokens"))


@query(f"WITH {ARTICLES} SELECT name FROM articles WHERE NOT starts_with(name, '早报')")
def title_prefix(spark, sf_dir):
    return clean.without_prefix(articles(spark, sf_dir)).select("name")


@query(f"WITH {ARTICLES} SELECT name FROM articles WHERE doc_id % 4 <> 0 ORDER BY name LIMIT 25")
def limit_n(spark, sf_dir):
    d = articles(spark, sf_dir)
    todo = scoring.todo(d.select("name"), d.where("doc_id % 4 = 0").select(F.col("name").alias("file")))
    return scoring.limit_n(todo, 25)


@query(f"WITH {RECORDS} SELECT doc_id, md5(trim(CASE WHEN contains(output, '<article>') THEN regexp_extract(output, '(?s)<article>(.*?)</article>', 1) ELSE output END, ' ' || chr(10))) AS article FROM records")
def extract_article(spark, sf_dir):
    tagged = F.concat(F.lit("前言<article>\n"), "body", F.lit("\n</article>后记 <article>二</article>"))
    output = F.when(F.col("doc_id") % 5 == 0, F.col("body")).otherwise(tagged)
    return articles(spark, sf_dir).select("doc_id", F.md5(t.article_or_all(output).cast("binary")).alias("article"))


@query("""SELECT source, lang FROM (SELECT DISTINCT source, lang FROM documents) EXCEPT SELECT DISTINCT source, lang FROM documents WHERE doc_id % 7 <> 0""")
def set_difference(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return dedup.difference(d.select("source", "lang"), d.where("doc_id % 7 <> 0").select("source", "lang"))


@query()
def rouge_l_by_item(spark, sf_dir):
    return generations(spark, sf_dir).select("tag", "idx", F.round(rouge_l_udf("generated", "reference"), 6).alias("rouge_l"))


@query()
def rouge_l_by_tag(spark, sf_dir):
    scored = generations(spark, sf_dir).select("tag", rouge_l_udf("generated", "reference").alias("r"))
    return scored.groupBy("tag").agg(F.round(F.avg("r"), 6).alias("rouge_l"), F.count("*").alias("n"))


KEYED = f"""{ARTICLES}, keyed AS (SELECT doc_id, name, han, ({COUNT.format('han')})::BIGINT AS n, substr(name, 1, 5) || (doc_id // 3)::VARCHAR AS title FROM articles)"""


def _keyed(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", "name", "han", t.count_of(F.col("han")).cast("long").alias("n"), F.concat(F.substring("name", 1, 5), F.floor(F.col("doc_id") / 3).cast("string")).alias("title"))


@query(f"WITH {KEYED} SELECT doc_id, row_number() OVER (PARTITION BY title ORDER BY n DESC, name) = 1 AS kept FROM keyed")
def dedup_title(spark, sf_dir):
    return dedup.keep_first(_keyed(spark, sf_dir), ["title"], [-F.col("n"), F.col("name")], "doc_id").select("doc_id", "kept")


@query(f"WITH {KEYED}, f AS (SELECT doc_id, doc_id % 3 AS priority, md5(substr(regexp_replace(han, '[^\\x{{4e00}}-\\x{{9fff}}]', '', 'g'), 1, 500)) AS fp FROM keyed) SELECT doc_id FROM f QUALIFY row_number() OVER (PARTITION BY fp ORDER BY priority, doc_id) = 1")
def dedup_fingerprint(spark, sf_dir):
    f = _keyed(spark, sf_dir).select("doc_id", (F.col("doc_id") % 3).alias("priority"), t.fingerprint(F.col("han")).alias("fp"))
    return dedup.keep_first(f, ["fp"], [F.col("priority")], "doc_id").where("kept").select("doc_id")


@query(f"""WITH {KEYED}, byte AS (SELECT doc_id, md5(han) AS h FROM keyed),
a AS (SELECT doc_id FROM keyed QUALIFY row_number() OVER (PARTITION BY title ORDER BY n DESC, name, doc_id) > 1), b AS (SELECT doc_id FROM byte QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id) > 1)
SELECT doc_id FROM a UNION SELECT doc_id FROM b""")
def set_union_dups(spark, sf_dir):
    """Duplicates by title or by content, each once."""
    d = _keyed(spark, sf_dir)
    by_title = dedup.keep_first(d, ["title"], [-F.col("n"), F.col("name")], "doc_id").where("not kept").select("doc_id")
    content = d.select("doc_id", F.md5(F.col("han").cast("binary")).alias("h"))
    return dedup.union_dups(by_title, dedup.keep_first(content, ["h"], [], "doc_id").where("not kept").select("doc_id"))


def _signed(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return dedup.signed(d, F.col("doc_id"), t.count_of(F.col("text"), t.LETTER), F.col("text"), t.LETTER)


@query("""WITH l AS (SELECT doc_id, regexp_replace(text, '[^\\p{L}]', '', 'g') AS x FROM documents),
g AS (SELECT doc_id, CASE WHEN len(x) < 5 THEN [x] ELSE list_distinct(list_transform(range(1, len(x) - 3), lambda i: substr(x, i, 5))) END AS grams FROM l)
SELECT doc_id, md5(array_to_string(list_sort(list_distinct(list_transform(grams, lambda s: substr(md5(s), 1, 16))))[:128], ',')) AS signature FROM g""")
def minhash_signature(spark, sf_dir):
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.md5(F.array_join(dedup.signature(F.col("text"), t.LETTER), ",").cast("binary")).alias("signature"))


@query()
def near_dup_edges(spark, sf_dir):
    return dedup.edges(dedup.classes(_signed(spark, sf_dir)))


@query()
def near_dup_greedy(spark, sf_dir):
    """Each document with its class's first document and whether it is kept."""
    d = _signed(spark, sf_dir)
    reps = dedup.classes(d)
    kept = dedup.greedy(reps, dedup.edges(reps))
    return d.select(F.col("name").alias("doc_id"), "digest").join(reps.select("digest", F.col("name").alias("first")), "digest").join(kept.withColumnRenamed("name", "first"), "first").select("doc_id", "first", ((F.col("doc_id") == F.col("first")) & F.col("kept")).alias("kept"))


CORE = "depth >= 4 AND genre IN ('深度评论', '访谈')"
SUPPLEMENT = "(SELECT *, row_number() OVER (ORDER BY evidence DESC, abs(chars - 3500), file) AS r FROM scored WHERE depth = 3 AND evidence >= 4 AND genre = '深度评论')"


@query(f"WITH {SCORES} SELECT file, depth, genre FROM scored WHERE {CORE}")
def select_core(spark, sf_dir):
    return scoring.select_core(scores(spark, sf_dir)).select("file", "depth", "genre")


@query(f"WITH {SCORES} SELECT file, evidence, chars FROM {SUPPLEMENT} WHERE r <= greatest(0, 190 - (SELECT count(*) FROM scored WHERE {CORE}))")
def select_supplement_topk(spark, sf_dir):
    return scoring.supplement(scores(spark, sf_dir), 190).select("file", "evidence", "chars")


@query(f"WITH {SCORES} SELECT genre, topic, count(*) AS n, sum(chars)::BIGINT AS chars FROM scored WHERE {CORE} GROUP BY ALL")
def selection_report(spark, sf_dir):
    return scoring.select_core(scores(spark, sf_dir)).groupBy("genre", "topic").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"))


@query(f"WITH {ARTICLES} SELECT name FROM articles WHERE doc_id % 4 <> 0")
def resume_todo_scores(spark, sf_dir):
    d = articles(spark, sf_dir)
    return scoring.todo(d.select("name"), d.where("doc_id % 4 = 0").select(F.col("name").alias("file")))


@query("""WITH l AS (SELECT user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, event_type FROM l WHERE event_type <> 'purchase'""")
def resume_todo_manifest(spark, sf_dir):
    e = scoring.latest(table(spark, sf_dir, "events"), "user_id", [F.col("ts"), F.col("event_id")])
    done = e.where("event_type = 'purchase'").select("user_id")
    return e.join(done, "user_id", "left_anti").select("user_id", "event_type")


@query(f"WITH {SCORES} SELECT file FROM scored JOIN articles ON name = file WHERE {CORE} AND doc_id % 10 <> 0")
def selected_existing(spark, sf_dir):
    there = articles(spark, sf_dir).where("doc_id % 10 <> 0").select(F.col("name").alias("file"))
    return scoring.select_core(scores(spark, sf_dir)).select("file").join(there, "file", "left_semi")


@query(f"WITH {SCORES} SELECT count(*) AS missing FROM scored JOIN articles ON name = file WHERE {CORE} AND doc_id % 10 = 0")
def selected_missing(spark, sf_dir):
    there = articles(spark, sf_dir).where("doc_id % 10 <> 0").select(F.col("name").alias("file"))
    return scoring.select_core(scores(spark, sf_dir)).join(there, "file", "left_anti").agg(F.count("*").alias("missing"))


ALPACA = """SELECT conv_id, max(text) FILTER (role = 'system') AS instruction, min_by(text, turn) FILTER (role = 'user') AS input, min_by(text, turn) FILTER (role = 'assistant') AS output FROM conversations GROUP BY conv_id"""


def _alpaca(spark, sf_dir):
    def first(role, f):
        return f(F.when(F.col("role") == role, F.col("text")))

    c = table(spark, sf_dir, "conversations")
    return c.groupBy("conv_id").agg(
        first("system", F.max).alias("instruction"),
        F.min_by("text", F.when(F.col("role") == "user", F.col("turn"))).alias("input"),
        F.min_by("text", F.when(F.col("role") == "assistant", F.col("turn"))).alias("output"),
    )


@query(f"WITH a AS ({ALPACA}) SELECT source, priority, count(*) AS n, count(instruction) AS with_instruction FROM (SELECT 'a' AS source, 0 AS priority, * FROM a WHERE conv_id % 2 = 0 UNION ALL SELECT 'b', 2, * FROM a WHERE conv_id % 2 = 1) GROUP BY ALL")
def union_sources_count(spark, sf_dir):
    a = _alpaca(spark, sf_dir)
    return union_sources([(a.where("conv_id % 2 = 0"), "a", 0), (a.where("conv_id % 2 = 1"), "b", 2)]).groupBy("source", "priority").agg(F.count("*").alias("n"), F.count("instruction").alias("with_instruction"))


SPLIT = "SELECT conv_id, CASE WHEN row_number() OVER (ORDER BY md5('42:' || conv_id::VARCHAR)) <= greatest(1, floor(count(*) OVER () * 0.05::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM (SELECT DISTINCT conv_id FROM conversations)"


@query(SPLIT)
def split_train_val(spark, sf_dir):
    return scoring.split(table(spark, sf_dir, "conversations").select("conv_id").distinct(), "conv_id").select("conv_id", "split")


@query(f"WITH a AS ({ALPACA}), s AS ({SPLIT}) SELECT conv_id, split, 'conversations' AS source, coalesce(NULL, '?') AS teacher, substr(input, 1, 40) AS input_head FROM a JOIN s USING (conv_id)")
def provenance(spark, sf_dir):
    a = scoring.split(_alpaca(spark, sf_dir), "conv_id")
    return a.select("conv_id", "split", F.lit("conversations").alias("source"), F.coalesce(F.lit(None).cast("string"), F.lit("?")).alias("teacher"), F.substring("input", 1, 40).alias("input_head"))


@query(f"WITH {SCORES} SELECT depth, count(*) AS n FROM scored GROUP BY depth")
def score_distribution(spark, sf_dir):
    return scores(spark, sf_dir).groupBy("depth").agg(F.count("*").alias("n"))


@query(f"WITH {SCORES} SELECT genre, topic, count(*) AS n FROM scored GROUP BY ALL")
def genre_topic_counts(spark, sf_dir):
    return scores(spark, sf_dir).groupBy("genre", "topic").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, round(avg((quality = 1 AND toxic = 0)::INT), 6) AS good FROM labels")
def good_ratio(spark, sf_dir):
    good = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0)
    return table(spark, sf_dir, "labels").agg(F.count("*").alias("n"), F.round(F.avg(good), 6).alias("good"))


@query("WITH q AS (SELECT list_sort(list(n_chars)) AS l, count(*) AS n FROM documents) SELECT n, " + ", ".join(f"l[least(n - 1, floor(n * {q}::DOUBLE))::INT + 1] AS p{int(q * 100)}" for q in (0.5, 0.75, 0.9, 0.95)) + " FROM q")
def length_quantiles(spark, sf_dir):
    return metrics.by_index(table(spark, sf_dir, "documents").select("n_chars"), [], "n_chars", {f"p{int(q * 100)}": metrics.quantile_index(q) for q in (0.5, 0.75, 0.9, 0.95)})


@query("SELECT cutoff, round(avg((n_chars <= cutoff)::INT) * 100, 6) AS coverage FROM documents, (SELECT unnest([2048, 4096, 6144, 8192, 12288]) AS cutoff) GROUP BY cutoff")
def cutoff_coverage(spark, sf_dir):
    cutoffs = (2048, 4096, 6144, 8192, 12288)
    one = table(spark, sf_dir, "documents").agg(*[F.round(F.avg(F.when(F.col("n_chars") <= c, 1).otherwise(0)) * 100, 6).alias(str(c)) for c in cutoffs])
    return one.unpivot([], [str(c) for c in cutoffs], "cutoff", "coverage").select(F.col("cutoff").cast("int").alias("cutoff"), "coverage")


@query("SELECT lang, count(*) AS n, list_sort(list(n_chars))[(count(*) // 2 + 1)::INT] AS median FROM documents GROUP BY lang")
def upper_median_by_lang(spark, sf_dir):
    return metrics.by_index(table(spark, sf_dir, "documents").select("lang", "n_chars"), ["lang"], "n_chars", {"median": metrics.upper_median()})


def _ab(spark, sf_dir):
    providers = F.explode(F.array(*map(F.lit, ("gemini", "qwen", "kimi", "deepseek"))))
    d = articles(spark, sf_dir).select("doc_id", "han", providers.alias("provider"))
    thought = F.concat(F.when(F.col("provider") == "kimi", "本文").otherwise("核心矛盾 语气定位 打算"), F.lit(" "), "han")
    raw = F.concat(F.lit("<input>主题：题\n受众：众"), F.when(F.col("provider") != "qwen", "\n要求：求").otherwise(""), F.lit("</input><thinking>"), thought, F.lit("</thinking>"))
    ship_package(spark)
    return d.select("provider", "doc_id", raw.alias("raw")).select("provider", "doc_id", clean.ab_score(F.col("raw")).alias("score"))


AB = f"""{ARTICLES}, ab AS (
  SELECT provider, doc_id, ({COUNT.format("(CASE WHEN provider = 'kimi' THEN '本文' ELSE '核心矛盾 语气定位 打算' END || ' ' || han)")}) AS n
  FROM articles, (SELECT unnest(['gemini', 'qwen', 'kimi', 'deepseek']) AS provider)),
points AS (SELECT provider, doc_id, (100 + CASE WHEN provider = 'qwen' THEN 133 ELSE 200 END + CASE WHEN provider = 'kimi' THEN 0 ELSE 120 + 300 END
  + CASE WHEN n BETWEEN 300 AND 500 THEN 100 WHEN n BETWEEN 250 AND 600 THEN 50 ELSE 0 END)::BIGINT AS score FROM ab)"""


@query(f"WITH {AB} SELECT * FROM points")
def ab_rubric(spark, sf_dir):
    return _ab(spark, sf_dir)


@query(f"WITH {AB} SELECT provider, round(avg(CASE WHEN doc_id % 7 = 0 THEN 0 ELSE score END), 6) AS mean, round(avg(doc_id % 50 / 10.0::DOUBLE), 6) AS elapsed, count(*) AS n FROM points GROUP BY provider")
def ab_rank(spark, sf_dir):
    """Failures, each seventh here, count as no points but with their time."""
    scored = _ab(spark, sf_dir).withColumn("score", F.when(F.col("doc_id") % 7 != 0, F.col("score"))).withColumn("elapsed", F.col("doc_id") % 50 / F.lit(10.0))
    return metrics.ab_rank(scored)


@query(f"WITH {SCORES} SELECT dim, round(avg(v), 6) AS mean FROM (SELECT 'depth' AS dim, depth AS v FROM scored UNION ALL SELECT 'evidence', evidence FROM scored UNION ALL SELECT 'all', unnest([depth, evidence]) FROM scored) GROUP BY dim")
def judge_means(spark, sf_dir):
    each = scores(spark, sf_dir).select(F.explode(F.array(F.struct(F.lit("depth").alias("dim"), F.col("depth").alias("v")), F.struct(F.lit("evidence").alias("dim"), F.col("evidence").alias("v")), F.struct(F.lit("all").alias("dim"), F.col("depth").alias("v")), F.struct(F.lit("all").alias("dim"), F.col("evidence").alias("v")))).alias("x"))
    return each.groupBy("x.dim").agg(F.round(F.avg("x.v"), 6).alias("mean"))


@query(f"WITH {SCORES} SELECT * FROM scored")
def stub_llm_score(spark, sf_dir):
    return scores(spark, sf_dir)


@query(f"WITH {SCORES} SELECT file, depth, evidence FROM scored")
def incremental_scores(spark, sf_dir):
    from corpusloom.streaming import incremental

    root = f"{shared_dir(spark)}/corpusloom-stream-{uuid.uuid4().hex}"
    articles(spark, sf_dir).select("name", t.count_of(F.col("han")).alias("n")).write.parquet(f"{root}/in")
    return incremental.run(spark, f"{root}/in", "name string, n int", scoring.stub_scores, f"{root}/out", f"{root}/state").select("file", "depth", "evidence")
