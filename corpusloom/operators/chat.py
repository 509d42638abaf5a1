"""Questions to language models: providers, retries, error rows, and the tasks that ask them.

A client is any function (Request) -> str that can be pickled. ask() sends each row's question through it in Arrow batches,
with threads of its own in each task; what fails after all retries is a row with an error and never fails the job. The
clients of this module answer from the question's MD5, need no network, and give the same answer each time.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import text as t
from corpusloom.session import ship_package

# Which errors are worth another try, how the tasks ask, and the providers' settings.
SCORE_ASKS, REVERSE_ASKS = "请评估以下文章：\n\n", "请反推以下文章的写作任务和构思：\n\n"
RETRYABLE = ("503", "UNAVAILABLE", "429", "rate", "timeout", "Timeout")
PLACEHOLDER = "your-api-key-here"
ANSWER = T.StructType([T.StructField("reply", T.StringType()), T.StructField("error", T.StringType()), T.StructField("tries", T.IntegerType()), T.StructField("elapsed", T.DoubleType())])
#: Questions of a batch that a worker holds as text at once.
AT_ONCE = 256


@dataclass(frozen=True)
class Provider:
    """How a provider is reached; the settings that an environment gives win."""

    name: str
    key_env: str
    model_env: str
    default_model: str
    base_url: str = ""
    base_url_env: str = ""

    def key(self, env: Mapping[str, str]) -> str | None:
        found = env.get(self.key_env, "")
        return None if found in ("", PLACEHOLDER) else found

    def model(self, env: Mapping[str, str]) -> str:
        return env.get(self.model_env) or self.default_model

    def url(self, env: Mapping[str, str]) -> str:
        return (env.get(self.base_url_env) if self.base_url_env else "") or self.base_url


PROVIDERS = {
    p.name: p
    for p in (
        Provider("deepseek", "DEEPSEEK_API_KEY", "DEEPSEEK_MODEL", "deepseek-chat", "https://api.deepseek.com", "DEEPSEEK_BASE_URL"),
        Provider("kimi", "KIMI_API_KEY", "KIMI_MODEL", "kimi-latest", "https://api.moonshot.cn/v1", "KIMI_BASE_URL"),
        Provider("qwen", "DASHSCOPE_API_KEY", "QWEN_MODEL", "qwen-max", "https://dashscope.aliyuncs.com/compatible-mode/v1", "QWEN_BASE_URL"),
        Provider("gemini", "GEMINI_API_KEY", "GEMINI_MODEL", "gemini-2.5-pro"),
    )
}


def available(env: Mapping[str, str], providers: Mapping[str, Provider] = PROVIDERS) -> list[str]:
    """Names of the providers that have a key."""
    return [n for n, p in providers.items() if p.key(env)]


@dataclass(frozen=True)
class Request:
    system: str
    user: str
    provider: str = "deepseek"
    model: str = ""
    temperature: float = 0.4
    max_tokens: int = 4096


def temperature_for(provider: str, model: str, wanted: float) -> float:
    """One provider's k2 models take no other temperature than one."""
    return 1.0 if provider == "kimi" and model.startswith("kimi-k2") else wanted


def attempt(client: Callable[[Request], str], request: Request, retries: int, backoff_s: float, sleep: Callable[[float], None] = time.sleep) -> tuple[str | None, str | None, int]:
    """(reply, error, tries): errors worth it are tried again after backoff_s, twice that, and so on; an empty reply is an error."""
    for n in range(1, max(1, retries) + 1):
        try:
            reply = (client(request) or "").strip()
            if not reply:
                raise RuntimeError(f"{request.provider}: empty reply")
            return reply, None, n
        except Exception as e:  # an error row takes its place
            if n == max(1, retries) or not any(k in str(e) for k in RETRYABLE):
                return None, str(e)[:200], n
            sleep(backoff_s * n)
    raise AssertionError


def ask(
    rows: DataFrame, client: Callable[[Request], str], system: Column | str, user: Column, provider: Column | str = "deepseek", model: str = "", temperature: float = 0.4,
    max_tokens: int = 4096, retries: int = 3, backoff_s: float = 5.0, threads: int = 4, tasks: int | None = None,
) -> DataFrame:
    """rows with one more column, answer: struct<reply, error, tries, elapsed>. A null question is asked as an empty one.

    threads ask at once in each task, tasks (if given) is how many tasks do. Columns of rows stay in the JVM and only the
    questions go to Python, where AT_ONCE of them are text at a time; an answer column of rows is replaced.
    """
    ship_package(rows.sparkSession)
    system, provider = (F.lit(x) if isinstance(x, str) else x for x in (system, provider))
    kept = [F.col(f"`{c}`") for c in rows.columns if c.lower() != "answer"]
    own = rows.repartition(tasks) if tasks else rows

    def one(question):
        began = time.monotonic()
        told, asked, name = question
        chosen = model or (PROVIDERS[name].default_model if name in PROVIDERS else "")
        request = Request(told, asked, name, chosen, temperature_for(name, chosen, temperature), max_tokens)
        return (*attempt(client, request, retries, backoff_s), time.monotonic() - began)

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        with ThreadPoolExecutor(threads) as pool:
            for questions in batches:
                yield pa.concat_arrays([_answers(pool.map(one, part)) for part in _parts(questions)] or [_answers([])])

    answer = F.arrow_udf(run, ANSWER).asNondeterministic()  # a question is asked once, whatever uses its answer
    return own.select(*kept, answer(*[F.coalesce(x.cast("string"), F.lit("")) for x in (system, user, provider)]).alias("answer"))


def _parts(columns):
    """Rows of Arrow columns as tuples, in lists of AT_ONCE rows."""
    for start in range(0, len(columns[0]), AT_ONCE):
        yield list(zip(*[c.slice(start, AT_ONCE).to_pylist() for c in columns]))


def _answers(found) -> pa.Array:
    columns = list(zip(*found)) or [()] * 4
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int32(), pa.float64()))], ["reply", "error", "tries", "elapsed"])


def _digits(request: Request) -> list[int]:
    return [int(c, 16) for c in hashlib.md5(request.user.encode()).hexdigest()]


def stub_scorer(request: Request) -> str:
    """A score from the question's MD5; one question in sixteen gets no JSON."""
    d = _digits(request)
    if d[4] == 0:
        return "no score"
    genre, topic = ("深度评论", "新闻报道", "访谈", "软文广告", "拼盘杂烩")[d[2] % 5], ("科技", "商业", "社会", "消费", "财经", "其他")[d[3] % 6]
    return f'```json\n{{"depth": {d[0] % 5 + 1}, "evidence": "{d[1] % 5 + 1}", "genre": "{genre}", "topic": "{topic}"}}\n```'


def stub_judge(request: Request) -> str:
    """Four marks from the question's MD5; one question in sixteen lacks the last of them, another is no JSON."""
    d = _digits(request)
    if d[4] == 0:
        return "no marks"
    last = "" if d[4] == 1 else f', "clean": {d[3] % 5 + 1}'
    return f'{{"depth": {d[0] % 5 + 1}, "evidence": {d[1] % 5 + 1}, "style": {d[2] % 5 + 1}.5{last}}}'


def stub_writer(request: Request) -> str:
    """A task, an outline and an article from the question's MD5; one question in sixteen has no outline."""
    d = _digits(request)
    thinking = "" if d[0] == 0 else f"<thinking>核心矛盾 {d[1]}</thinking>"
    return f"<input>主题：{d[2]}\n受众：众\n要求：求</input>{thinking}<article># 题 {d[3]}\n文</article>"


def score(docs: DataFrame, client: Callable[[Request], str] = stub_scorer, system: str = "", n_chars: int = 3000, charset: str = t.HAN, **settings) -> DataFrame:
    """file, chars, depth, evidence, genre, topic, error of docs (name, text): the model reads the first n_chars characters.

    A reply without the four keys, or with numbers that aren't any, is an error row.
    """
    user = F.concat(F.lit(SCORE_ASKS), F.substring("text", 1, n_chars))
    asked = ask(docs, client, system, user, **({"temperature": 0.1, "max_tokens": 1024, "threads": 6} | settings))
    d = asked.select(F.col("name").alias("file"), t.count_of(F.col("text"), charset).cast("int").alias("chars"), "answer", t.reply_scores(F.col("answer.reply")).alias("s"))
    error = F.when(F.col("answer.error").isNotNull(), F.col("answer.error")).when(F.col("s").isNull(), "unusable reply")
    return d.select("file", "chars", "s.depth", "s.evidence", "s.genre", "s.topic", error.alias("error"))


def reverse(docs: DataFrame, client: Callable[[Request], str] = stub_writer, system: str = "", instruction: str = "写文章", **settings) -> DataFrame:
    """name, instruction, input, output, teacher, warnings, status of docs (name, text), each asked of the teacher of its name.

    A reply without task or outline is a row of status failed, which a resumed run asks again.
    """
    article = t.strip(F.col("text"))
    own = docs.select("name", article.alias("article"), t.route_teacher(F.col("name"), F.length(article)).alias("teacher"))
    asked = ask(own, client, system, F.concat(F.lit(REVERSE_ASKS), F.col("article")), F.col("teacher"), **settings)
    d = asked.select("name", "article", "teacher", t.tag(F.col("answer.reply"), "input").alias("input"), t.tag(F.col("answer.reply"), "thinking").alias("thinking"))
    from corpusloom.operators import clean

    ok = F.col("input").isNotNull() & F.col("thinking").isNotNull()
    return d.select(
        "name", F.when(ok, F.lit(instruction)).alias("instruction"), F.when(ok, F.col("input")).alias("input"), F.when(ok, t.build_output(F.col("thinking"), F.col("article"))).alias("output"),
        "teacher", F.when(ok, clean.warnings_reverse(F.col("input"), F.col("thinking"))).alias("warnings"), F.when(ok, "done").otherwise("failed").alias("status"),
    )


def forward(topics: DataFrame, client: Callable[[Request], str] = stub_writer, system: str = "", audience: str = "", requirements: str = "", instruction: str = "写文章", **settings) -> DataFrame:
    """topic, instruction, input, output, warnings, status, reply of topics (topic): the model writes outline and article."""
    user = t.build_input(F.col("topic"), F.lit(audience), F.lit(requirements))
    asked = ask(topics, client, system, user, **({"provider": "gemini", "temperature": 0.6, "max_tokens": 16384} | settings))
    d = asked.select("topic", user.alias("input"), "answer.reply", t.tag(F.col("answer.reply"), "thinking").alias("thinking"), t.tag(F.col("answer.reply"), "article").alias("article"))
    from corpusloom.operators import clean

    ok = F.col("thinking").isNotNull() & F.col("article").isNotNull()
    return d.select(
        "topic", F.lit(instruction).alias("instruction"), "input", F.when(ok, t.build_output(F.col("thinking"), F.col("article"))).alias("output"),
        F.when(ok, clean.warnings_forward(F.col("thinking"), F.col("article"))).alias("warnings"), F.when(ok, "done").otherwise("failed").alias("status"), "reply",
    )


DIMENSIONS = ("depth", "evidence", "style", "clean")


def judge(generations: DataFrame, client: Callable[[Request], str] = stub_judge, system: str = "", n_chars: int = 6000, **settings) -> DataFrame:
    """tag, idx and a mark for each of DIMENSIONS of generations (tag, idx, input, generated); 0 for a missing mark, null all where the reply is no JSON."""
    topic = F.substring(F.split("input", "\n")[0], 1, 60)
    user = F.concat(F.lit("文章主题："), topic, F.lit("\n\n文章正文：\n"), F.substring("generated", 1, n_chars))
    own = generations.select("tag", "idx", user.alias("question"))  # the texts themselves stay behind
    asked = ask(own, client, system, F.col("question"), **({"provider": "gemini", "temperature": 0.1, "max_tokens": 2048} | settings))
    body = F.regexp_extract("answer.reply", r"(?s)\{.*?\}", 0)
    d = asked.select("tag", "idx", F.when(body != "", body).alias("body"))
    marks = [F.when(F.col("body").isNotNull(), F.coalesce(F.get_json_object("body", f"$.{k}").try_cast("double"), F.lit(0.0))).alias(k) for k in DIMENSIONS]
    return d.select("tag", "idx", *marks)


def judged(marks: DataFrame) -> DataFrame:
    """tag, dim, mean, n; dim `all` pools every mark. Replies without marks count nowhere."""
    each = F.array(*[F.struct(F.lit(k).alias("dim"), F.col(k).alias("mark")) for k in DIMENSIONS], *[F.struct(F.lit("all").alias("dim"), F.col(k).alias("mark")) for k in DIMENSIONS])
    d = marks.select("tag", F.explode(each).alias("m")).where("m.mark is not null")
    return d.groupBy("tag", F.col("m.dim").alias("dim")).agg(F.round(F.avg("m.mark"), 6).alias("mean"), F.count("*").alias("n"))


def chat_text(instruction: Column, input_: Column, output: Column) -> Column:
    """A record as one conversation in the ChatML form."""
    parts = []
    for role, c in (("system", instruction), ("user", input_), ("assistant", output)):
        parts += [F.lit(f"<|im_start|>{role}\n"), F.coalesce(c, F.lit("")), F.lit("<|im_end|>\n")]
    return F.concat(*parts)


def token_length(text: Column, tokenizer: Callable[[str], int] | None = None) -> Column:
    """Tokens by a tokenizer, given as a function that counts; without one the estimate by characters."""
    if tokenizer is None:
        return t.est_tokens(text)

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: tokenizer(x or ""))

    return count(text)
