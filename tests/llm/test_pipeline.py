"""run() against the same five stages in plain Python, and on tables that could break it."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import bpe, decontaminate, quality
from tests.llm.test_brute_force import roots_of, slow_fingerprint, slow_lines, slow_matches, vote

SF = "/root/testdata/sf0.001"


def could_hold(item, own):
    w = decontaminate.words(item)
    return (Counter(w) - own).total() <= int((1 - decontaminate.SIMILARITY) * len(w) + 1e-9)


def test_pipeline_equals_plain_python(spark):
    import public_tokenizers as P
    import tiktoken

    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(table, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(r.doc_id, r.text, r.source) for r in table.collect()]
    scores = {i: vote(model, x.encode()) for i, x, _ in rows}
    assert min(abs(s - quality.THRESHOLD) for s in scores.values()) > 2e-3  # no document is so near that rounding decides
    rows = [r for r in rows if scores[r[0]] >= quality.THRESHOLD]
    rows = [(i, x) for i, x, _, _ in slow_lines(rows)]
    root = roots_of([(i, slow_fingerprint(x)) for i, x in rows])
    rows = [(i, x) for i, x in rows if root[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for i, x in rows:
        own = Counter(decontaminate.words(x))
        if not slow_matches([t for t in items if could_hold(t[1], own)], x):
            kept.append((i, x))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(open(bpe.default_vocabulary(), "rb").read()), special_tokens={})
    want = set()
    for i, x in kept:
        ids = enc.encode_ordinary(x)
        want.add((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(x.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want) < len(root)


def test_stages_keep_columns_and_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, "plain words here. They go on and on.", "en", None, 5), (70_000, None, None, None, None), (70_001, "", "en", "s", 0), (70_001, "", "en", "s", 0)], docs.schema)
    both = docs.unionByName(odd).select("*", F.lit("x").alias("score"), F.lit(1).alias("n_lines"), F.lit(2).alias("n_removed"), F.lit(3).alias("host"), F.lit(4).alias("row"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    both.write.parquet(f"{tmp_path}/documents.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path))
        assert out.columns == now.columns and out.select("score", "n_lines", "n_removed", "host", "row").distinct().collect() == [("x", 1, 2, 3, 4)]
        now = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
