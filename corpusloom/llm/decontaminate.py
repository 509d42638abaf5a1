"""Benchmark passages in documents, edited ones too: CGK embedding, bit-sampling LSH, exact verification.

The CGK walk reads a window word by word; at each step it gives out the current word and, by a random bit of step and
word, stays or moves on. Words that agree keep two walks together and a few edits part them only for a while, so edit
distance becomes Hamming distance. A repetition samples SAMPLES steps of its own walk as a key; equal keys are candidates.

Items are put into classes by their words, [a, 1.5 a). A class looks at the windows of W = a - S + 1 words at every S-th
word of a document, S = a // 2 (but for long items W = STEP + 1, S = STEP): whatever holds an item whole then holds a window
of it at one of its first S offsets, and the items are indexed at every offset. Windows of an item's full size would have to start at every word, which costs
several times as many steps a word. The number of repetitions is the least that finds the target share of items with as
many of their words edited at random as a match may have, measured on the items themselves; if no number does, that is an
error. Each candidate is verified by the exact edit distance, in words, between the item and the best passage around it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from corpusloom.llm._common import shipped

#: Similarity of a match; the share of items, edited as much as a match may be, that repetitions must find; steps in a key.
SIMILARITY, RECALL, SAMPLES = 0.8, 0.92, 3
#: Repetitions beyond which the target counts as out of reach, which is an error; edited items that measure the recall.
REPETITIONS, PROBES = 64, 2000
#: The step of long items' windows: edits would part the walks of longer ones.
STEP = 26
#: Items of fewer words are looked for exactly, word by word. Words of the items that one broadcast holds.
MIN_WORDS, BLOCK_WORDS = 5, 200_000
#: Words of documents that are looked at together.
AT_ONCE = 400_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: First bytes of what follows: characters of scripts without spaces (Han, kana, Thai, Lao, Burmese, Khmer), and full-width punctuation.
_WIDE = re.compile(rb"[\xe0\xe1\xe3-\xe9\xef\xf0]")
_UNSPACED = re.compile(
    rb"[\xe4-\xe9][\x80-\xbf]{2}|\xe3(?:\x80[\x85\x87]|[\x81\x82\x90-\xbf][\x80-\xbf]|\x83[\x80-\xba\xbc-\xbf])|\xef(?:[\xa4-\xab][\x80-\xbf]|\xbd[\xa6-\xbf]|\xbe[\x80-\x9f])"
    rb"|\xf0[\xa0-\xb3][\x80-\xbf]{2}|\xe0[\xb8-\xbb][\x80-\xbf]|\xe1(?:[\x80\x81\x9e\x9f][\x80-\xbf]|\x82[\x80-\x9f])"
)
_APART = re.compile(rb"\xe3\x80[\x80-\x84\x86\x88-\xbf]|\xe3\x83\xbb|\xef\xbc[\x80-\x8f\x9a-\xa0\xbb-\xbf]|\xef\xbd[\x80\x9b-\xa5]")


def words(text: str | None) -> list[bytes]:
    """Runs of letters and digits, A-Z lowered, and single characters of scripts without spaces.

    Full-width punctuation separates as ASCII's does; every other byte outside ASCII counts as a letter.
    """
    data = (text or "").encode().lower()
    if _WIDE.search(data):
        data = _UNSPACED.sub(rb" \g<0> ", _APART.sub(b" ", data))
    return _WORD.findall(data)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxh64_intdigest(word, 1) | 1
        return h


def edit_distance(item: list[bytes], text: list[bytes]) -> int:
    """The least edits that turn item into any passage of text."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        last, row[0] = row[0], i
        left = i
        for j, t in enumerate(text, 1):
            left = min(last + (w != t), row[j] + 1, left + 1)
            last, row[j] = row[j], left
    return min(row)


class Index:
    """The items of one block, ready to be broadcast."""

    def __init__(self, items: list[tuple[object, str | None]], similarity: float = SIMILARITY, recall: float = RECALL):
        self.ids, self.words, self.similarity = [], [], similarity
        for item, text in items:
            if w := words(text):
                self.ids.append(item)
                self.words.append(w)
        self.short: dict[bytes, list[int]] = defaultdict(list)
        for k, w in enumerate(self.words):
            if len(w) < MIN_WORDS:
                self.short[w[0]].append(k)
        self.classes: list[tuple[int, int, list[int]]] = []
        a, longest = MIN_WORDS, max(map(len, self.words), default=0)
        while a <= longest:
            b = max(a + 1, a * 3 // 2)
            if held := [k for k, w in enumerate(self.words) if a <= len(w) < b]:
                step = max(1, min(a // 2, STEP))
                self.classes.append((min(a - a // 2, STEP) + 1, step, held))
            a = b
        self.repetitions, self.keys = 1, {}
        rng = np.random.default_rng(3)
        held = [k for k, w in enumerate(self.words) if len(w) >= MIN_WORDS]
        chosen = np.resize(rng.permutation(held), PROBES).astype(int).tolist() if held else []  # few items are edited more than once
        probe = [(k, [b"\x00"] * int(rng.integers(0, 37)) + self._edited(self.words[k], rng, 1 - similarity)) for k in chosen]
        missed = probe
        for self.repetitions in range(1, REPETITIONS + 1):
            self._build(self.repetitions - 1)
            found = self.candidates([w for _, w in missed], range(self.repetitions - 1, self.repetitions))
            missed = [(k, w) for (k, w), c in zip(missed, found) if not any(self.words[k] == self.words[x] for x, _ in c)]
            if len(missed) <= (1 - recall) * len(probe):
                break
        else:
            raise ValueError(f"{REPETITIONS} repetitions find {1 - len(missed) / len(probe):.3f} of edited items, not {recall}")
        self.recall = 1 - len(missed) / max(1, len(probe))

    @staticmethod
    def _edited(item: list[bytes], rng, rate: float) -> list[bytes]:
        out = list(item)
        for _ in range(int(rate * len(item) + 1e-9)):
            at, kind = int(rng.integers(0, len(out))), int(rng.integers(0, 3))
            out[at : at + (kind != 1)] = [b"\xff\xfe%d" % rng.integers(0, 1 << 30)] * (kind != 2)
        return out

    def _walk(self, c: int, r: int):
        """Odd multipliers of the steps, and the steps that are sampled."""
        rng = np.random.default_rng((c, r))
        steps = 2 * self.classes[c][0]  # about as many as the walk needs to the window's end
        edges = np.linspace(0, steps, min(SAMPLES, steps) + 1).astype(int)
        sampled = np.array([rng.integers(a, b) for a, b in zip(edges[:-1], edges[1:])])  # one in each part: not the same word again
        return (rng.integers(0, 1 << 63, steps, dtype=np.uint64) << np.uint64(1)) | np.uint64(1), sampled

    def embed(self, c: int, r: int, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The key of the window at each start. After the last word, hashes have as many zeros as a walk has steps."""
        odd, sampled = self._walk(c, r)
        ends, at, key = starts + self.classes[c][0], starts.copy(), np.zeros(len(starts), np.uint64)
        take, last = set(sampled.tolist()), int(sampled[-1])
        for j in range(last + 1):
            h = hashes[at]
            if j in take:  # a walk that has left its window reads zero, wherever it is
                key = (key ^ np.where(at < ends, h, np.uint64(0))) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            if j < last:
                h *= odd[j]
                h >>= np.uint64(63)
                at += h.view(np.int64)
        return key

    def _padding(self) -> list[int]:
        return [0] * (2 * max((size for size, _, _ in self.classes), default=0) + 1)

    def _build(self, r: int) -> None:
        seen = _Hashes()
        for c, (size, _, held) in enumerate(self.classes):
            hashes, starts, of = [], [], []
            for k in held:
                starts += range(len(hashes), len(hashes) + len(self.words[k]) - size + 1)
                of += [(k, o) for o in range(len(self.words[k]) - size + 1)]
                hashes += map(seen.__getitem__, self.words[k])
            keys = self.embed(c, r, np.array(hashes + self._padding(), np.uint64), np.array(starts, np.int64))
            order = np.argsort(keys, kind="stable")
            held_low = np.zeros(1 << max(12, (16 * len(keys)).bit_length()), bool)  # which low bits the keys have
            held_low[keys & np.uint64(len(held_low) - 1)] = True
            self.keys[c, r] = keys[order], np.array(of, np.int64)[order], held_low

    def candidates(self, texts: list[list[bytes]], repetitions=None) -> list[set[tuple[int, int]]]:
        """For each text, (item's place, word where the item would begin), by all repetitions or some."""
        out: list[set[tuple[int, int]]] = [set() for _ in texts]
        first = np.cumsum([0, *map(len, texts)])
        if not first[-1]:
            return out
        seen = self.__dict__.setdefault("_seen", _Hashes())
        hashes = np.concatenate((np.fromiter(map(seen.__getitem__, chain.from_iterable(texts)), np.uint64, int(first[-1])), np.array(self._padding(), np.uint64)))
        for c, (size, step, _) in enumerate(self.classes):
            starts = np.concatenate([np.arange(a, b - size + 1, step) for a, b in zip(first[:-1], first[1:])])
            if not starts.size:
                continue
            for r in repetitions or range(self.repetitions):
                keys, of, held_low = self.keys[c, r]
                made = self.embed(c, r, hashes, starts)
                maybe = np.flatnonzero(held_low[made & np.uint64(len(held_low) - 1)])  # most windows end here
                made, begun = made[maybe], starts[maybe]
                left, right = np.searchsorted(keys, made), np.searchsorted(keys, made, "right")
                where = np.searchsorted(first, begun, "right") - 1
                for at in np.flatnonzero(left < right):
                    text = int(where[at])
                    for item, offset in of[left[at] : right[at]]:
                        out[text].add((int(item), int(begun[at] - first[text] - offset)))
        return out

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_seen"}

    def matches(self, texts: list[list[bytes]]) -> list[dict[int, int]]:
        """For each text, the least edits of each item that it holds closely enough."""
        out = []
        for text, found in zip(texts, self.candidates(texts)):
            best: dict[int, int] = {}
            if self.short and (begun := self.short.keys() & set(text)):
                for at, w in enumerate(text):
                    if w in begun:
                        best.update((k, 0) for k in self.short[w] if text[at : at + len(self.words[k])] == self.words[k])
            places = defaultdict(list)
            for item, at in sorted(found):
                places[item].append(at)
            for item, ats in places.items():
                own = self.words[item]
                most = int((1 - self.similarity) * len(own) + 1e-9)
                if any(text[max(0, at) : max(0, at) + len(own)] == own for at in ats):
                    best[item] = 0
                    continue
                done = None
                for at in ats:
                    if done is None or at - done > most // 2:  # a passage nearby has been looked at in full
                        done = at
                        near = text[max(0, at - 2 * most) : max(0, at + len(own) + 2 * most)]
                        if (Counter(own) - Counter(near)).total() > most:  # each word that is missing is an edit
                            continue
                        edits = edit_distance(own, near)
                        if edits <= most:
                            best[item] = min(edits, best.get(item, edits))
            out.append(best)
        return out


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", **settings) -> list[Index]:
    """The items in blocks of about BLOCK_WORDS words, one Index each; a block, or an item that is longer, is what is brought
    to the driver at once.

    Null texts and items without any word are passed over. Items repeated with their text are held once, with their number.
    """
    rows = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).where("text is not null").groupBy("item", "text").agg(F.count("*").alias("times"))
    n_words = F.size(F.split("text", r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+")) + 2 * F.length(F.regexp_replace("text", r"[\x00-\u0DFF]", ""))  # or fewer
    total = rows.agg(F.coalesce(F.sum(n_words), F.lit(0))).first()[0]
    n = max(1, -(-total // BLOCK_WORDS))
    out = []
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == k)
        held = part.orderBy("item", "text").collect()
        index = Index([(r.item, r.text) for r in held], **settings)
        if index.words:
            index.times = [r.times for r in held if words(r.text)]
            out.append(index)
    return out


def _batches(batch: pa.RecordBatch, at: int):
    """Slices of a batch with their words, of a bounded number of words except where one text is longer."""
    start, held, n = 0, [], 0
    for k, t in enumerate(batch.column(at)):
        w = words(t.as_py())
        held.append(w)
        n += len(w)
        if n >= AT_ONCE or k + 1 == batch.num_rows:
            yield batch.slice(start, len(held)), held
            start, held, n = k + 1, [], 0


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", **settings) -> DataFrame:
    """id_col, item_id, edits, n_words (of the item), similarity: one row per document and item that it holds.

    A match is a passage within (1 - similarity) x words of the item in edits; of an item of under MIN_WORDS words, its
    exact words. Null and empty texts hold nothing. Repeated rows and repeated items give repeated results; an empty table on
    either side gives no rows; other columns are ignored. An item found at several places is one row, with its least edits.
    """
    spark = shipped(docs).sparkSession
    kind, item_kind = docs.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("item_id", item_kind), T.StructField("edits", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("similarity", T.DoubleType())])
    own = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    out = None
    for index in indexes(benchmark, item_col, **settings):
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            ix = shared.value
            for b in batches:
                for part, held in _batches(b, 1):
                    rows = [(part.column(0)[k].as_py(), ix.ids[i], e, len(ix.words[i]), 1 - e / len(ix.words[i])) for k, m in enumerate(ix.matches(held)) for i, e in sorted(m.items()) for _ in range(ix.times[i])]
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], types)

        from pyspark.sql.pandas.types import to_arrow_schema

        types = to_arrow_schema(schema)
        found = own.mapInArrow(run, schema)
        out = found if out is None else out.union(found)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """docs without the rows that hold an item; what contaminated() says of nulls and empty tables holds here too."""
    at = shipped(docs).columns.index(text_col)
    for index in indexes(benchmark, **settings):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for b in batches:
                for part, held in _batches(b, at):
                    yield part.filter(pa.array([not m for m in shared.value.matches(held)]))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
