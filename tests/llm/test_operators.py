"""Edge cases of each operator, and brute force where SQL can't express one."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from corpusloom.llm import bpe, decontaminate, exact_dedup, html_text, line_dedup, pii, quality, sharding, simhash, suffix_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long, norm string"


def docs(spark, rows):
    return spark.createDataFrame([(i, x, None, s, None, "clash") for i, x, s in rows], DOCS)


ODD = [(1, "a b c d e", "s"), (2, "a  b\tc d e", "s"), (2, "a  b\tc d e", "s"), (3, None, None), (4, "", "s"), (None, "a b c d e", "s"), (5, "x" * 3000, "t"), (6, " \n ", None)]


def test_exact(spark):
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(docs(spark, ODD)).collect()}
    assert {(1, 1, 4, True), (2, 1, 4, False), (None, 1, 4, False), (3, 3, 2, True), (4, 3, 2, False), (5, 5, 1, True), (6, 6, 1, True)} == got
    assert exact_dedup.exact_duplicates(docs(spark, [])).count() == 0


def test_simhash_edges(spark):
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs(spark, ODD)).collect()}
    assert {(1, 1), (2, 1), (None, 1), (3, 3), (4, 3), (6, 3)} <= got
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


def test_simhash_links_equal_all_pairs(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = sorted({b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 6))) for b in base for _ in range(12)})
    signed = {simhash._signed(f): f for f in fps}
    edges = simhash.links(spark.createDataFrame([(k,) for k in signed], "fp long")).collect()

    def roots(pairs):
        up = {f: f for f in fps}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
        return {f: find(f) for f in fps}

    brute = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4]
    assert roots([(signed[e.u], signed[e.v]) for e in edges]) == roots(brute)


def test_simhash_split_blocks_keep_links(monkeypatch):
    rng = random.Random(6)
    for at_once in (50, 3000, 10**9):
        monkeypatch.setattr(simhash, "AT_ONCE", at_once)
        for _ in range(8):
            fps = [rng.getrandbits(63)]
            while len(fps) < 40:
                fps.append(rng.choice(fps[-3:]) ^ sum(1 << x for x in rng.sample(range(64), 4)) if rng.random() < 0.9 else rng.getrandbits(64))
            fps = sorted(set(fps))
            data = pa.table({"fp": np.array(fps, np.uint64).view(np.int64), "block": np.zeros(len(fps), np.int64)})
            edges = simhash._link_block(0, list(range(63, -1, -1)), 2)(None, data).to_pydict()

            def groups(pairs):
                of = {f: {f} for f in fps}
                for a, b in pairs:
                    if of[a] is not of[b]:
                        of[a] |= of[b]
                        for x in of[b]:
                            of[x] = of[a]
                return {frozenset(g) for g in of.values()}

            found = [(u % 2**64, v % 2**64) for u, v in zip(edges["u"], edges["v"])]
            assert groups(found) == groups([(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 4])


def test_lines(spark):
    rows = [(i, f"shared\nown {i}\n\nshared", "s") for i in range(12)] + [(99, None, None), (100, "shared", "t")]
    got = {r.doc_id: r for r in line_dedup.drop_lines(docs(spark, rows)).collect()}
    assert got[3].text == "own 3\n" and got[3]._n_removed == 2
    assert got[99].text is None and got[99]._n_lines == 0 and got[100].text == "shared" and got[100].norm == "clash"
    assert line_dedup.drop_lines(docs(spark, [])).count() == 0


def test_suffixes_equal_brute_force(spark):
    rng = random.Random(2)
    passage = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(40, 160))) for _ in range(6)]
    rows = [(i, "".join(rng.choice(passage + ["".join(rng.choice("abcdefgh ") for _ in range(70))]) for _ in range(rng.randint(0, 4))), "s") for i in range(60)]
    rows += [(70, None, "s"), (71, "z" * 400, "s"), (72, "z" * 90, "s"), (72, "z" * 90, "s"), (None, "z" * 60, "s")]
    first = {}
    for i, x, _ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (x or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    want = []
    for i, x, _ in rows:
        b = (x or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            f = first[b[p : p + 50]]
            if f is not None and (i is None or f < i):
                gone[p : p + 50] = b"\1" * 50
        want.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    got = [tuple(r)[:5] for r in suffix_dedup.remove_repeats(docs(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert suffix_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_blind_trie_orders():
    trie, strings = suffix_dedup.BlindTrie(), [b"abc", b"abd", b"abc", b"xbc", b"aac"]
    for k, s in enumerate(strings):
        trie.add(s, k)
    assert list(trie.classes()) == [[4], [0, 2], [1], [3]]


def test_bpe(spark):
    import public_tokenizers as P
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(open(bpe.default_vocabulary(), "rb").read()), special_tokens={})
    texts = ["Hello world's", "a" * 900, "é日本 \n\n x", None, "", "<|endoftext|>"]
    rows = bpe.decode(bpe.encode(docs(spark, [(k, x, "s") for k, x in enumerate(texts)])).drop("decoded")).collect()
    for r in rows:
        x = texts[r.doc_id] or ""
        ids = enc.encode_ordinary(x)
        assert r.ids == ids and bytes(r.decoded) == x.encode() and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(x.encode()).hexdigest()


def test_decontamination(spark):
    rng = random.Random(4)
    words = ["w%d" % k for k in range(400)]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(8, 50)))) for k in range(30)] + [(90, None), (91, "too short")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows, found = [], 0
    for k in range(30):
        w = items[k][1].split()
        w[len(w) // 2] = "edited"
        rows.append((k, " ".join(["pre"] * k + w + ["post"] * 5), "s"))
    rows += [(200 + k, " ".join(rng.choice(words) for _ in range(200)), "s") for k in range(30)] + [(300, None, "s"), (301, items[0][1].upper() + "!!!", "s")]
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    found = sum((k, k) in got for k in range(30))
    assert found >= 27 and got[301, 0].edits == 0 and not [k for k in got if 200 <= k[0] <= 300]
    kept = {r.doc_id for r in decontaminate.clean(docs(spark, rows), bench).collect()}
    assert kept == {r[0] for r in rows} - {k for k, _ in got}
    assert decontaminate.contaminated(docs(spark, rows), bench.limit(0)).count() == 0


def test_decontamination_of_unspaced_and_short_items(spark):
    chinese = "下列关于光合作用的说法，哪一项是正确的？请从四个选项里选出答案并说明理由"
    items = [(1, chinese), (2, "東京タワーの高さは何メートルですか"), (3, "Zebra quagga"), (4, "量子"), (5, "！？"), (6, "ราคาข้าวหอมมะลิ")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, "前文。" + chinese + "。后文", "s"), (2, "「東京タワーの高さは何メートルですか」と聞く", "s"), (3, "a ZEBRA, quagga b", "s"), (4, "论量子力学", "s"), (5, "quagga zebra 子量！？", "s")]
    rows += [(7, "xราคาข้าวหอมมะลิy", "s"), (8, None, "s"), (9, "今天天气很好，我们去公园散步吧", "s")]
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.contaminated(docs(spark, rows), bench).collect()}
    assert got == {(1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 0), (7, 6, 0)}
    assert {r.doc_id for r in decontaminate.clean(docs(spark, rows), bench).collect()} == {5, 8, 9}
    assert decontaminate.words("A，ｂ・東々 été don't 가나") == ["A".lower().encode(), "ｂ".encode(), "東".encode(), "々".encode(), "été".encode(), b"don", b"t", "가나".encode()]


def test_decontamination_of_edited_unspaced_items(spark):
    rng = random.Random(8)
    draw = lambda n: "".join(chr(0x4E00 + rng.randrange(500)) for _ in range(n))
    items = [(k, draw(rng.randint(20, 60))) for k in range(40)]
    rows = []
    for k, x in items:
        at = rng.randrange(1, len(x) - 1)
        rows.append((k, draw(k) + "。" + x[:at] + "错" + x[at + 1 :] + "，" + draw(9), "s"))
    rows += [(200 + k, draw(300), "s") for k in range(40)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert sum((k, k) in got for k in range(40)) >= 36 and not [d for d, _ in got if d >= 200]


def test_edit_distance():
    assert decontaminate.edit_distance(list("abcd"), list("xxabzdyy")) == 1


def test_quality(spark):
    good, bad = ["plain words number %d here. They go on." % k for k in range(60)], ["BUY!! %d NOW!!" % k for k in range(60)]
    rows = [(k, x, "s") for k, x in enumerate(good + bad)] + [(500, None, "s")]
    labels = spark.createDataFrame([(k, int(k < 60), 0) for k in range(120)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    d = docs(spark, rows)
    got = {r.doc_id: r._score for r in quality.score(d, quality.fit(d, labels)).collect()}
    assert min(got[k] for k in range(60)) > 0.7 > 0.3 > max(got[k] for k in range(60, 120)) and 0 <= got[500] <= 1
    assert {r._score for r in quality.score(d, quality.fit(d, labels.limit(0))).collect()} == {0.5}


def test_html():
    page = '<html><head><title>t</title></head><body><nav><a>Menu</a></nav><div class="cookie-notice">We use</div><article><h1>Head &amp; line</h1><p>One <b>two</b>,\n three.<p>Four, five.<br>six<script>x("</p>")</script></article><div class="comments"><p>No, never.</p></div><footer>f</footer>'
    assert html_text.main_text(page) == "Head & line\nOne two, three.\nFour, five. six"
    assert html_text.main_text("<div class=menu>a</div><div><p>Long text, that goes on and on.</p><p>And more, of it.</p></div>") == "Long text, that goes on and on.\nAnd more, of it."
    assert html_text.main_text('<body class="has-sidebar"><main id="search-main"><p>One, two.</p><aside>x</aside></main></body>') == "One, two."
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""


def test_pii(spark):
    text = 'é a@b.co.uk and a@b.c%d@e.f, 10.0.0.1 300.1.1.1 card 4111 1111 1111 1111 +1 (555) 555-1234 token = "0123456789abcdef0123456789abcdef01234567"'
    rows = [(k, text, "s") for k in range(3)] + [(9, None, "s"), (10, "", "s"), (11, "1" * 20000 + "a" * 20000 + "@x" + ".y" * 9000, "s")]
    got = {r.doc_id: r for r in pii.find(docs(spark, rows)).collect()}
    spans = [(s.split(":")[0], text[int(s.split(":")[1]) : int(s.split(":")[2])]) for s in got[0].spans.split(",")]
    assert spans == [("email", "a@b.co.uk"), ("email", "a@b.c"), ("email", "%d@e.f"), ("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 555-1234"), ("secret", "0123456789abcdef0123456789abcdef01234567")]
    assert got[9].spans == "" and got[9].base_sha256 == hashlib.sha256(b"").hexdigest() and got[11].n_email == 1
    assert pii.find(docs(spark, [])).count() == 0


def test_shards(spark):
    store, version = sharding.shard(docs(spark, ODD))
    assert sorted(map(str, (r.doc_id for r in store.read().collect()))) == sorted(str(r[0]) for r in ODD)
    assert version == store.version()
    with pytest.raises(sharding.Conflict):
        store.commit([], version - 1)
    small = [{"shard": k, "bytes": 10, "file": "f"} for k in range(5)]
    assert [len(r) for r in sharding.plan(small, 25)] == [2, 2]
