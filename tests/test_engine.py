"""The engine's own queries against DuckDB, and units of their rules."""

import duckdb
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as t
from corpusloom.functions.rouge import lcs
from corpusloom.operators import chat, clean, dedup, metrics, scan, scoring
from corpusloom.plans import catalog

SF = "/root/testdata/sf0.001"
@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in ("documents", "pages", "labels", "conversations", "events", "benchmark"):
        con.execute(f"CREATE VIEW {n} AS FROM '{SF}/{n}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_strip_and_lines(spark):
    assert one(spark, t.strip(F.lit("　 a b \x1c"))) == "a b"
    for s in ("", "a", "a\n", "a\n\nb", "a\r\nb\x0bc", "\n"):
        assert one(spark, t.splitlines(F.lit(s))) == s.splitlines()


def test_raw_rules(spark):
    assert one(spark, clean.clean_raw(F.lit("![x](y)\n_ _ 题 _ _\n正文\n👉加入\nEnd\n精选留言\n别的"))) == "## 题\n正文"


def test_noise_keeps_long_lines(spark):
    long = "正" * 40 + "点个"
    assert one(spark, clean.drop_noise(F.array(F.lit("  "), F.lit(""), F.lit(" " * 31), F.lit("点个赞"), F.lit(long)))) == ["", " " * 31, long]


def test_tail_marker_only_in_zone(spark):
    lines = ["行%d" % i for i in range(90)]
    early, late = list(lines), list(lines)
    early[10] = late[70] = "参考文献"
    assert len(one(spark, clean.cut_tail_block(F.array(*map(F.lit, early))))) == 90
    assert len(one(spark, clean.cut_tail_block(F.array(*map(F.lit, late))))) == 70


def test_gate_names_wrong_order(spark):
    assert one(spark, clean.gate_reason(F.lit("i"), F.lit("j"), F.lit("核心矛盾</article><article><thinking></thinking>"))) == "tags out of order"


def test_upper_median(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4)], "v int")
    assert metrics.by_index(df, [], "v", {"m": metrics.upper_median()}).first()["m"] == 3


def test_greedy_chain(spark):
    reps = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "name string, n int")
    edges = spark.createDataFrame([("b", "a"), ("c", "b")], "later string, earlier string")
    assert {r.name: r.kept for r in dedup.greedy(reps, edges).collect()} == {"a": True, "b": False, "c": True}


def test_split_takes_at_least_one(spark):
    for n in (1, 19, 20):
        assert scoring.split(spark.range(n), "id").where("split = 'val'").count() == 1


def test_raw_report_cleans_and_counts_kept_rows(spark, tmp_path):
    import __spark_entry__ as entry

    def text(n, cut=0):
        return "a" * n + ("\n精选留言\n" + "b" * cut if cut else "")

    rows = [(5 + 15 * 11 * k, x, "en", s) for k, (x, s) in enumerate([(text(1300), "s"), (text(1500), "s"), (text(1400, 900), "s"), (text(100, 5000), "s"), (text(3000), "早报"), (None, "s"), (text(1200), None)])]
    spark.createDataFrame(rows + [(9000, "short", "zh", "s")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.lang: r for r in catalog.clean_raw_stats(spark, str(tmp_path)).collect()}
    en, zh = found["en"], found["zh"]
    assert (en.total, en.zaobao, en.too_short, en.ok) == (7, 1, 2, 4)
    assert 1200 <= en.least < 1220 and 1400 <= en.median < 1420 and 1500 <= en.most < 1520
    assert (zh.total, zh.zaobao, zh.too_short, zh.ok, zh.least, zh.median, zh.most) == (1, 0, 1, 0, None, None, None)
    for where in (SF, str(tmp_path)):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS FROM '{where}/documents.parquet{'' if where == SF else '/*.parquet'}'")
        want = con.execute(catalog.SQL["clean_raw_stats"])
        columns = [c[0] for c in want.description]
        got = [tuple(r[c] for c in columns) for r in catalog.clean_raw_stats(spark, where).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want.fetchall()))
    assert set(entry.entry(spark).columns) == set(columns)


def test_rouge_scores_whole_texts(spark, tmp_path):
    def slow(a, b):
        a, b = ("".join((x or "").split()) for x in (a, b))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return 2 * row[-1] / (len(a) + len(b)) if row[-1] else 0.0

    texts = ["ab c" * 30, "the quick brown fox " * 45 + "ends here", "x" * 600 + " END y", "", None]
    rows = [(k, x, "en", "s", len(x or "")) for k, x in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    made = {(r.tag, r.idx): slow(r.generated, r.reference) for r in catalog.generations(spark, str(tmp_path)).collect()}
    assert {(r.tag, r.idx): r.rouge_l for r in catalog.rouge_l_by_item(spark, str(tmp_path)).collect()} == {k: round(v, 6) for k, v in made.items()}
    means = {r.tag: (r.rouge_l, r.n) for r in catalog.rouge_l_by_tag(spark, str(tmp_path)).collect()}
    for tag in ("base", "v1", "v2"):
        own = [v for k, v in made.items() if k[0] == tag]
        assert means[tag] == (pytest.approx(sum(own) / len(own), abs=1e-6), len(texts))


def test_safe_topic_reads_past_sixty_characters(spark, tmp_path):
    spark.createDataFrame([(1, "a" + "-" * 80 + "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert catalog.safe_topic(spark, str(tmp_path)).first().topic == "a_b"


def test_lcs():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    for a, b in (("abcde", "badce"), ("", "a"), ("aaaa", "aa"), ("xaybzc", "abc")):
        assert lcs(a, b) == slow(a, b)


def test_lcs_of_a_text_in_another_searches_once(monkeypatch):
    from corpusloom.functions import rouge

    monkeypatch.setattr(rouge, "_within", lambda *a: pytest.fail("went through the text character by character"))
    text = "天地玄黄" * 5000
    assert lcs("作者" + text + "点个", text) == lcs(text, "玄" + text + "x") == len(text)
    assert rouge.rouge_l("a\u3000b\x1cc \n", "abc") == 1.0


@pytest.mark.parametrize(
    "line, want",
    [
        ("_ _ 题 _ _", "## 题"), ("_题_", "## 题"), ("__题__", "## 题"), ("_ 题 _ _", "## 题"), ("_" + "长" * 40 + "_", "_" + "长" * 40 + "_"), ("_" + "长" * 30 + "_", "## " + "长" * 30),
        ("a _b_", "a _b_"), ("_a_ b", "_a_ b"), ("  _题_  ", "## 题"), ("", ""),
    ],
)
def test_headings(spark, line, want):
    assert one(spark, clean.fix_heading(F.lit(line))) == want


def test_final_record_strips_first_and_keeps_what_follows(spark):
    lines = ["行" * 400, "参考文献", "行" * 400]  # a marker on line 1 of 3 lies before the zone, which begins at 2
    out = f"<thinking>t</thinking><article>\n\n{lines[0]}\n{lines[1]}\n{lines[2]}\n</article> after <article>x</article>"
    got = one(spark, clean.final_record(F.lit(out)))
    assert got.status == "untouched" and got.output == out
    got = one(spark, clean.final_record(F.lit(out.replace(lines[0], lines[0] + "\n点个赞"))))
    assert got.status == "cleaned" and got.output == "<thinking>t</thinking><article>\n" + "\n".join(lines) + "\n</article> after <article>x</article>"
    assert one(spark, clean.final_record(F.lit("none"))).status == "untagged"


def test_scan_takes_the_article_and_an_excerpt(spark):
    text = "封面来源<article>" + "前" * 40 + "封面来源" + "后" * 60 + "\n尾行</article>扫码"
    rows = spark.createDataFrame([("a", text), ("b", None), ("c", "x@y.zz")], "name string, output string")
    got = {(r.name, r.rule): r.excerpt for r in scan.scan(rows).collect()}
    assert got == {("a", "cover_source"): "前" * 30 + "封面来源" + "后" * 50, ("c", "email"): "x@y.zz"}


def test_split_breaks_ties_and_counts(spark):
    many = spark.range(100).selectExpr("7 as k", "id")
    assert scoring.split(many, "k").where("split = 'val'").count() == 5
    mixed = spark.range(3000).selectExpr("if(id < 2900, 1, id) as k", "id")
    got = scoring.split(mixed, "k")
    assert got.count() == 3000 and got.where("split = 'val'").count() == 150
    assert scoring.split(spark.range(0), "id").count() == 0


def test_by_index_equals_sorting(spark):
    import random

    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.randrange(300)) for _ in range(2000)] + [("c", 5), ("c", None), (None, 9)]
    df = spark.createDataFrame(rows, "g string, v int")
    want = {g: sorted(v for x, v in rows if x == g and v is not None) for g in ("a", "b", "c", None)}
    got = {r.g: r for r in metrics.by_index(df, ["g"], "v", {"m": metrics.upper_median(), "q": metrics.quantile_index(0.9)}).collect()}
    for g, v in want.items():
        assert (got[g].n, got[g].m, got[g].q) == (len(v), v[len(v) // 2], v[min(len(v) - 1, int(len(v) * 0.9))])
    none = df.limit(0)
    assert metrics.by_index(none, ["g"], "v", {"m": metrics.upper_median()}).count() == 0
    assert metrics.by_index(none, [], "v", {"m": metrics.upper_median()}).collect() == [(None, None)]  # a total is one row


def test_keep_first_of_one_hot_group(spark):
    df = spark.range(500).selectExpr("id", "if(id % 3 = 0, '', cast(id as string)) as t", "id % 5 as p")
    kept = {r.id for r in dedup.keep_first(df, ["t"], [F.col("p")], "id").where("kept").collect()}
    assert kept == {0} | {x for x in range(500) if x % 3}


def test_edges_equal_all_pairs(spark):
    import random

    rng = random.Random(3)
    base = ["".join(rng.choice("abcdefgh") for _ in range(200)) for _ in range(5)]
    texts = [b[: rng.randrange(120, 200)] + "".join(rng.choice("xyz") for _ in range(rng.randrange(20))) for b in base for _ in range(8)] + ["", "abc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    signed = dedup.signed(docs, F.col("k"), F.length("t"), F.col("t"), t.LETTER)
    reps = dedup.classes(signed)
    sigs = {r.name: (r.n, set(r.sig)) for r in reps.collect()}

    def near(a, b):
        low = sorted(a | b)[:128]
        return len([x for x in low if x in a and x in b]) / len(low)

    want = set()
    for x, (n, a) in sigs.items():
        for y, (m, b) in sigs.items():
            if (m > n or (m == n and y < x)) and near(a, b) > 0.7:
                want.add((x, y))
    assert {(r.later, r.earlier) for r in dedup.edges(reps).collect()} == want and len(want) > 20


def test_edges_of_several_blocks_write_no_candidates(spark, tmp_path, monkeypatch):
    """Sketches of a small vocabulary share single hashes with all others; only pairs are written, whatever block they lie in."""
    import random
    from pathlib import Path

    rng = random.Random(4)
    words = [rng.randrange(-(2**63), 2**63) for _ in range(600)]

    def near(a, b):
        low = sorted(a | b)[:128]
        return len([x for x in low if x in a and x in b]) / len(low)

    sigs = []
    for _ in range(60):
        own = rng.sample(words, rng.choice([1, 2, 6, 12, 17, 18, 60, 127, 200, 300]))
        for _ in range(4):
            sigs.append(sorted({x for x in own if rng.random() > 0.08} | set(rng.sample(words, len(own) // 12)) or {own[0]})[:128])
    rows = [(k, k % 7, s) for k, s in enumerate(sigs)] + [(9000, 1, None)]
    reps = spark.createDataFrame(rows, "name long, n long, sig array<long>").repartition(3)
    want = {(x, y): near(set(a), set(b)) for x, n, a in rows[:-1] for y, m, b in rows[:-1] if m > n or (m == n and y < x)}
    want = {k: v for k, v in want.items() if v > 0.7}
    monkeypatch.setattr(dedup, "BLOCK", 50)
    monkeypatch.setattr(dedup, "AT_ONCE", 16)
    monkeypatch.setattr(dedup, "shared_dir", lambda spark: f"file://{tmp_path}")
    got = {(r.later, r.earlier): r.similarity for r in dedup.edges(reps).collect()}
    assert got == want and len(want) > 100
    written = spark.read.parquet(*[f"{p}" for p in Path(tmp_path).glob("corpusloom-pairs-*")])
    assert written.count() == len(want)


def test_pairs_are_never_shuffled(spark):
    """Key and rank stand beside each pair when it is found: what edges() returns is read and projected, whatever the number of pairs."""
    reps = spark.createDataFrame([(f"k{k}", k % 3, list(range(k, k + 128))) for k in range(40)], "name string, n int, sig array<long>")
    found = dedup.edges(reps)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    want = {(f"k{x}", f"k{y}") for x in range(40) for y in range(40) if (y % 3 > x % 3 or (y % 3 == x % 3 and f"k{y}" < f"k{x}")) and (128 - abs(x - y)) / 128 > 0.7}
    assert {(r.later, r.earlier) for r in found.collect()} == want and len(want) > 500


def test_greedy_looks_at_decided_pairs_no_more(spark, monkeypatch):
    """A cluster that is decided at once leaves no pair to the rounds that a chain needs; the choice is that of a plain loop."""
    pairs = [(f"c{i:02}", f"c{j:02}") for i in range(40) for j in range(i)] + [(f"d{i + 1}", f"d{i}") for i in range(6)]
    held, own = [], dedup.cut

    def cut(df, label="cut"):
        out = own(df, label)
        if label == "edges":
            held.append(out[0].count())
        return out

    monkeypatch.setattr(dedup, "cut", cut)
    names = sorted({x for p in pairs for x in p} | {"alone"})
    want = {}
    for x in names:
        want[x] = not any(want[y] for z, y in pairs if z == x)
    reps = spark.createDataFrame([(x,) for x in names], "name string")
    assert {r.name: r.kept for r in dedup.greedy(reps, spark.createDataFrame(pairs, "later string, earlier string")).collect()} == want
    assert held == [786, 4, 2, 0]
    none = spark.createDataFrame([], "later string, earlier string")
    assert all(r.kept for r in dedup.greedy(reps, none).collect())


def test_ab_score_equals_its_patterns(spark):
    """Tags that are missing or in a wrong order, tones and lengths: the score by plain patterns, of each text and none."""
    import re

    from corpusloom.operators import rules

    def slow(raw):
        found = [re.search(f"(?s)<{x}>(.*?)</{x}>", raw) for x in ("input", "thinking")]
        asked, thought = (m[1] if m else "" for m in found)
        n = len(re.findall("[\u4e00-\u9fff]", thought))
        return (100 if all(found) else 0) + round(sum(w in asked for w in rules.INPUT_FIELDS) * 200 / 3) + sum(w in thought for w in rules.FIVE_POINTS) * 60 + (150 if re.search(rules.PLAN_TONE, thought) else 0) + (
            150 if not any(w in thought for w in rules.REVIEW_TONE) else 0) + (100 if 300 <= n <= 500 else 50 if 250 <= n <= 600 else 0)

    made = ["", "<input>", "</input><input>主题：", "<input>主题：</input>", "<input>a<input>要求：</input>b</input><thinking>先做再看</thinking>", "<thinking>先\n再</thinking>", "<thinking>本文</thinking><input></input>"]
    made += [f"<input>主题：受众：</input><thinking>核心矛盾{w}{'字' * k}x</thinking>" for k in (0, 246, 300, 496, 600, 700) for w in ("我会", "先" + "a" * 13 + "再", "作者认为准备")] + ["本文<thinking>x</thinking>打算"]
    rows = spark.createDataFrame([(x,) for x in made] + [(None,)], "raw string")
    got = {r.raw: r.score for r in rows.select("raw", clean.ab_score(F.col("raw")).alias("score")).collect()}
    assert got == {x: slow(x) for x in made} | {None: None}
    assert "RLike(raw" not in (plan := rows.select(clean.ab_score(F.col("raw")))._jdf.queryExecution().toString()) and "ArrowEvalPython" in plan


def test_tags_are_found_beside_the_words(spark):
    """tagged() sees what between() gives and the words in it; the rubric's texts go to Python as they are, without a search before."""
    from corpusloom.functions import words

    made = ["", "<a>", "</a><a>天地x</a>y</a>", "<a></a><b>地\n🙂\U00020000天</b>", "<a>天<b>地</a>天</b>", "<a><a>x</a></a>", "<b>龥\u4dff\u9fff\ua000</b>", "<b>天</b", "🙂<a>\ue000\uffff地</a>"]
    rows = spark.createDataFrame([(x,) for x in made] + [(None,)], "x string")
    seen = words.tagged(F.col("x"), a=("天",), b=("地", "天"))
    got = rows.select("x", seen.a.alias("a"), seen.b.alias("b"), t.between(F.col("x"), "a").alias("in_a"), t.between(F.col("x"), "b").alias("in_b")).collect()
    for r in got:
        for held, inner, own in ((r.a, r.in_a, ("天",)), (r.b, r.in_b, ("地", "天"))):
            assert (held and tuple(held)) == (None if inner is None else (sum(1 << i for i, w in enumerate(own) if w in inner), sum("\u4e00" <= c <= "\u9fff" for c in inner)))
    assert sum(r.a is not None for r in got) == 5 and len(got) == 10
    plan = rows.select(clean.ab_score(F.col("x")))._jdf.queryExecution().optimizedPlan().toString()
    assert "each(x#" in plan and plan.count("substring_index(x#") + plan.count("substring_index(substring(x#") <= 1


def test_eval_hits_equal_their_patterns(spark):
    from corpusloom.functions import words
    from corpusloom.operators import rules

    made = ["", "作者：某某\n文", "说作者", "  ** 编辑 | x", "本文来自", "本文来x未经授权", "封面图点个", "[1] 见 https://x", "文 1 http://", "小爱心\n12 a http://b", "责编\u3000：", "🙂授权发布\n\u2003校对\uff5c"]
    rows = spark.createDataFrame([(x,) for x in made] + [(None,)], "x string")
    slow = sum((F.col("x").rlike("(?d)(?U)" + p).cast("int") for p in rules.EVAL), F.lit(0))
    got = rows.select("x", rules.eval_hits(F.col("x")).alias("a"), slow.alias("b"), rules.eval_words(F.col("x")).han.alias("n"), t.count_of(F.col("x")).alias("m"), rules.eval_words(F.col("x")).found.alias("w")).collect()
    assert all(r.a == r.b and r.n == r.m for r in got) and max(r.b or 0 for r in got) == 2
    every = sum(rules.EVAL_WORDS.values(), ())
    assert {r.x: r.w for r in got} == {x: words.look(x, every)[0] for x in made} | {None: None}


def test_chat_retries_and_error_rows(spark):
    tried, slept = [], []

    def client(request):
        tried.append(request)
        raise RuntimeError("429 too many") if len(tried) < 3 else RuntimeError("bad request")

    assert chat.attempt(client, chat.Request("", "q"), 5, 2.0, slept.append) == (None, "bad request", 3) and slept == [2.0, 4.0]
    assert chat.attempt(lambda r: " ", chat.Request("", "q"), 3, 1.0, slept.append)[1].endswith("empty reply")
    assert chat.attempt(lambda r: " x ", chat.Request("", "q"), 3, 1.0) == ("x", None, 1)

    def flaky(request):
        if "bad" in request.user:
            raise ValueError("no")
        return request.system + request.user + str(request.temperature)

    rows = spark.createDataFrame([("a", 1), ("bad", 2), (None, 3)], "q string, answer int")
    got = {r.q: r.answer for r in chat.ask(rows, flaky, "s", F.col("q"), "kimi", model="kimi-k2-x", threads=2).collect()}
    assert got["a"].reply == "sa1.0" and got["bad"].error == "no" and got["bad"].tries == 1 and got[None].reply == "s1.0"
    assert chat.ask(rows.limit(0), flaky, "s", F.col("q")).count() == 0


def test_ask_sends_questions_alone_and_each_once(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    at = f"{tmp_path}/asked"

    def client(request):
        with open(at, "a") as f:
            f.write(request.user + "\n")
        return request.user[::-1]

    rows = spark.range(700).selectExpr("id", "repeat('long', 1000) as text", "named_struct('a', id) as other", "1 as Answer")
    asked = chat.ask(rows, client, "s", F.col("id").cast("string"), threads=2)
    plan = asked._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan and "MapInPandas" not in plan and asked.columns == ["id", "text", "other", "answer"]
    twice = asked.select("id", F.length("text").alias("n"), "other.a", "answer.reply", "answer.tries", F.col("answer.reply").alias("again")).collect()
    assert sorted(open(at).read().split()) == sorted(str(k) for k in range(700))
    assert {(r.id, r.n, r.a, r.reply, r.tries, r.again) for r in twice} == {(k, 4000, k, str(k)[::-1], 1, str(k)[::-1]) for k in range(700)}
    monkeypatch.setattr(chat, "AT_ONCE", 3)
    assert list(map(len, chat._parts([pa.array(list("abcdefgh"))]))) == [3, 3, 2]


def test_providers():
    env = {"KIMI_API_KEY": "k", "QWEN_MODEL": "other", "DASHSCOPE_API_KEY": chat.PLACEHOLDER, "KIMI_BASE_URL": "http://x"}
    assert chat.available(env) == ["kimi"]
    assert chat.PROVIDERS["qwen"].model(env) == "other" and chat.PROVIDERS["kimi"].model(env) == "kimi-latest"
    assert chat.PROVIDERS["kimi"].url(env) == "http://x" and chat.PROVIDERS["deepseek"].url(env) == "https://api.deepseek.com"


def test_judge_pools_partial_marks(spark):
    marks = spark.createDataFrame([("a", 1, 4.0, 2.0, 3.0, 0.0), ("a", 2, None, None, None, None), ("b", 1, 1.0, 1.0, 1.0, 1.0)], "tag string, idx int, depth double, evidence double, style double, clean double")
    got = {(r.tag, r.dim): (r["mean"], r.n) for r in chat.judged(marks).collect()}
    assert got["a", "all"] == (2.25, 4) and got["a", "depth"] == (4.0, 1) and got["b", "all"] == (1.0, 4)


def test_token_length_by_a_tokenizer(spark):
    text = chat.chat_text(F.lit("a"), F.lit("b"), F.lit("c"))
    assert one(spark, text) == "<|im_start|>system\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"
    assert one(spark, chat.token_length(F.lit("a b c"), lambda x: len(x.split()))) == 3


def test_sources(spark, tmp_path):
    from corpusloom.sources import io

    (tmp_path / "md").mkdir()
    (tmp_path / "md/a.md").write_bytes("甲\r\n乙\ufffd".encode() + b"\xff\xfe end\r")
    (tmp_path / "md/b.txt").write_text("no")
    assert [tuple(r) for r in io.markdown(spark, f"{tmp_path}/md").collect()] == [("a.md", "甲\n乙\ufffd end\n")]
    (tmp_path / "x.jsonl").write_text('{"instruction": "i", "input": "j", "output": "o"}\n\n{"instruction": "k"}\n')
    assert sorted(r.instruction for r in io.json_lines(spark, f"{tmp_path}/x.jsonl").collect()) == ["i", "k"]
    (tmp_path / "bad.jsonl").write_text('{"instruction": "i"}\n{broken\n')
    with pytest.raises(Exception):
        io.json_lines(spark, f"{tmp_path}/bad.jsonl").collect()
    assert io.json_lines(spark, f"{tmp_path}/bad.jsonl", strict=False).where("instruction is not null").count() == 1
    (tmp_path / "g.json").write_text('[{"idx": 0, "input": "a"},\n {"idx": 1, "input": "b"}]')
    assert [r.idx for r in io.json_array(spark, f"{tmp_path}/g.json").orderBy("idx").collect()] == [0, 1]
    (tmp_path / "topics.txt").write_text("# no\n\n  第一 \n第二\n")
    assert io.first_topic(spark, f"{tmp_path}/topics.txt").first().topic == "第一" and io.topics(spark, f"{tmp_path}/topics.txt").count() == 2
    (tmp_path / "p.txt").write_text("\n 提示 \n")
    assert one(spark, io.prompt(spark, f"{tmp_path}/p.txt")) == "提示"
    (tmp_path / "gemini_1.jsonl").write_text('{"instruction": "g"}\n')
    (tmp_path / "gemini_2.jsonl").write_text('{"instruction": "h"}\n')
    found = io.json_sources(spark, [(f"{tmp_path}/x.jsonl", "x", 0), (f"{tmp_path}/none.jsonl", "none", 1), (f"{tmp_path}/gemini_*.jsonl", "gemini_forward", 2)])
    assert sorted((r.source, r.priority, r.instruction) for r in found.collect()) == [("gemini_forward", 2, "g"), ("gemini_forward", 2, "h"), ("x", 0, "i"), ("x", 0, "k")]
    assert io.json_sources(spark, [(f"{tmp_path}/none.jsonl", "none", 1)]).count() == 0


def test_sinks(spark, tmp_path):
    import json

    from corpusloom.sources import io

    df = spark.createDataFrame([("a.md", "文", 1), ("b.md", "字", 2)], "name string, text string, n int")
    io.write_documents(df, f"{tmp_path}/docs")
    assert spark.read.parquet(f"{tmp_path}/docs").columns == ["name", "text"]
    io.write_jsonl(df, f"{tmp_path}/out")
    io.append_jsonl(df, f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out").count() == 4 and "文" in "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert [io.write_version(df.where(f"n <= {k}"), f"{tmp_path}/v") for k in (1, 2)] == [1, 2]
    assert io.read_version(spark, f"{tmp_path}/v").count() == 2 and io.read_version(spark, f"{tmp_path}/v", 1).count() == 1
    assert json.loads(io.dataset_info({"train": "train.jsonl"}))["train"]["columns"] == {"prompt": "instruction", "query": "input", "response": "output"}
    assert io.report({"T": df.select("name", "n").orderBy("n")}) == "## T\n\n| name | n |\n|---|---|\n| a.md | 1 |\n| b.md | 2 |\n"
    made = chat.forward(spark.createDataFrame([("题 目/一",)], "topic string"), lambda r: "<thinking>x</thinking><article># y</article>")
    io.write_generations(made, f"{tmp_path}/gen", "20240101_000000")
    raw, records = spark.read.parquet(f"{tmp_path}/gen/raw").first(), spark.read.json(f"{tmp_path}/gen/records").first()
    assert raw.key == records.key == "题_目_一_20240101_000000" and records.output.startswith("<thinking>\nx")


def test_stream_goes_on_and_repeats_nothing(spark, tmp_path):
    from corpusloom.streaming import incremental

    def go():
        return sorted(r.file for r in incremental.run(spark, f"{tmp_path}/in", "name string, n int", scoring.stub_scores, f"{tmp_path}/out", f"{tmp_path}/state").collect())

    spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "name string, n int").write.parquet(f"{tmp_path}/in/1")
    spark.createDataFrame([("a", 1), ("b", 2)], "name string, n int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert go() == ["a", "b"]
    spark.createDataFrame([("b", 2), ("c", 3)], "name string, n int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    assert go() == ["a", "b", "c"] == go()
    import shutil

    shutil.rmtree(tmp_path / "state")  # a retried first batch writes its folder anew
    shutil.rmtree(tmp_path / "out/batch=1")
    assert go() == ["a", "b", "c"]
