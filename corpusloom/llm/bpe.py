"""Byte-level BPE by DuckDB's recursive queries, one database in each Python worker.

The text is cut by the public pattern. Each distinct word becomes token-position rows, one for each byte, which join the
merge table with the token after them; gathered in order they are the word's list of (what the token would become with the
next, position, token), each packed into one number. The recursive query contracts each word's least number, its leftmost
pair of least rank, and joins the two positions beside it to the merge table, until no word has a pair. Ordered aggregation
over the token rows then gives a word's ids and decodes them.

A worker remembers words, in two generations of bounded size. Words of over LONG bytes, for which a round for each
contraction would take too many rounds, are merged by the same rule with a heap.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from corpusloom.llm._common import shipped

#: Words of more bytes go to the heap; words in a generation; characters that are cut at once; bytes that a query's rounds may hold.
LONG, GENERATION, AT_ONCE, ROUNDS = 4000, 150_000, 2_000_000, 64_000_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_vocabulary(spark: SparkSession, path: str | None) -> bytes:
    """The file of ranks, read by the driver from its own disk or by Spark from a store; workers get it by broadcast."""
    path = path or default_vocabulary()
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first().content)
    with open(path, "rb") as file:
        return file.read()


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}


#: One ordered aggregate gives ids and bytes at once: bytes are hexadecimal in the letters a to p, so that digits are ids.
HEX, LETTERS, DIGITS = b"0123456789abcdef", b"abcdefghijklmnop", b"0123456789 "
TO_LETTERS, TO_HEX = bytes.maketrans(HEX, LETTERS), bytes.maketrans(LETTERS, HEX)


class Queries:
    """The SQL for numbers of rank, position and token, each of so many bits."""

    def __init__(self, bits: int, positions: int):
        self.none = none = (1 << bits) - 1  # no merge, or no token
        low, done = (1 << (bits + positions)) - 1, none << (bits + positions)
        self.start = f"""
CREATE OR REPLACE TEMP TABLE start AS
SELECT word, list((coalesce(merged, {none}) << {bits + positions}) + (pos << {bits}) + id ORDER BY pos) AS tokens
FROM rows LEFT JOIN merge_pairs ON pair = (id << {bits}) + after GROUP BY word"""
        self.code = f"""
WITH RECURSIVE t(word, tokens, best) AS (
  SELECT word, tokens, list_min(tokens) FROM start
  UNION ALL
  SELECT word, tokens, list_min(tokens) FROM (
    SELECT word, tokens[:greatest(p - 2, 0)]
      || CASE WHEN p > 1 THEN [(coalesce(a.merged, {none}) << {bits + positions}) + (tokens[p - 1] & {low})] ELSE [] END
      || [(coalesce(b.merged, {none}) << {bits + positions}) + (best & {low - none}) + made] || tokens[p + 2:] AS tokens
    FROM (SELECT word, tokens, best, best >> {bits + positions} AS made, list_position(tokens, best) AS p FROM t WHERE best < {done})
    LEFT JOIN merge_pairs a ON a.pair = ((tokens[p - 1] & {none}) << {bits}) + made
    LEFT JOIN merge_pairs b ON b.pair = (made << {bits}) + (tokens[p + 2] & {none}))
), token AS (SELECT word, unnest(tokens) & {low} AS place FROM t WHERE best >= {done})
SELECT word, count(*), string_agg(id_and_bytes, ' ' ORDER BY place) FROM token JOIN vocabulary ON id = place & {none} GROUP BY word"""


class Coder:
    """What one worker knows of one vocabulary."""

    def __init__(self, vocabulary: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = parse_ranks(vocabulary)
        self.cut = regex.compile(pattern)
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        bits = (max(self.bytes_of) + 1).bit_length()
        self.sql = Queries(bits, LONG.bit_length())
        self.young: dict[str, tuple[int, str, bytes]] = {}
        self.old: dict[str, tuple[int, str, bytes]] = {}
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "250MB", "preserve_insertion_order": False})
        made = [((self.ranks[t[:k]] << bits) + self.ranks[t[k:]], r) for t, r in self.ranks.items() for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        merges = pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("pair", "merged"), zip(*made))})  # noqa: F841 (read by the next statements)
        vocabulary = pa.table({"id": pa.array(self.bytes_of, pa.int64()), "hex": [b.hex() for b in self.bytes_of.values()], "id_and_bytes": [f"{k}{b.hex().encode().translate(TO_LETTERS).decode()}" for k, b in self.bytes_of.items()]})  # noqa: F841
        self.db.execute("CREATE TABLE merge_pairs AS FROM merges")
        self.db.execute("CREATE TABLE vocabulary AS FROM vocabulary")

    def _heap(self, data: bytes) -> list[int]:
        """The same contraction for a long word: least rank first, leftmost among equals."""
        parts: list[bytes | None] = [data[i : i + 1] for i in range(len(data))]
        after, before = [*range(1, len(data)), -1], [*range(-1, len(data) - 1)]
        queue = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) >= 0 and (rank := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(queue, (rank, i, parts[i], parts[j]))

        for i in range(len(data) - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            if parts[i] == a and (j := after[i]) >= 0 and parts[j] == b:
                parts[i], parts[j], after[i] = a + b, None, after[j]
                if after[j] >= 0:
                    before[after[j]] = i
                offer(i)
                offer(before[i])
        return [self.ranks[p] for p in parts if p is not None]

    def learn(self, words: list[str]) -> None:
        """Work out these words."""
        names, data, rounds = [], [], 0
        for w in words:
            own = w.encode()
            if len(own) > LONG:
                found = self._heap(own)
                self.young[w] = (len(found), " ".join(map(str, found)), b"".join(map(self.bytes_of.__getitem__, found)))
                continue
            rounds += 4 * len(own) ** 2  # bytes that its lists of all rounds may have
            if names and rounds > ROUNDS:
                self._query(names, data)
                names, data, rounds = [], [], 4 * len(own) ** 2
            names.append(w), data.append(own)
        if names:
            self._query(names, data)

    def _query(self, names: list[str], data: list[bytes]) -> None:
        raw, size = np.frombuffer(b"".join(data), np.uint8), np.fromiter(map(len, data), np.int64, len(data))
        ends, ids = np.cumsum(size), self.byte[raw]
        after = np.append(ids[1:], 0)
        after[ends - 1] = self.sql.none
        rows = pa.table({"word": np.repeat(np.arange(len(data)), size), "pos": np.arange(len(raw)) - np.repeat(ends - size, size), "id": ids, "after": after})  # noqa: F841
        self.db.execute(self.sql.start)
        for k, n, both in self.db.execute(self.sql.code).fetchall():
            both = both.encode()
            self.young[names[k]] = (n, both.translate(None, LETTERS).decode(), bytes.fromhex(both.translate(TO_HEX, DIGITS).decode()))

    def _known(self, pieces: list[list[str]]) -> dict[str, tuple[int, str, bytes]]:
        """All words of these pieces; words that were not used since the last change of generations are forgotten at the next."""
        if len(self.young) > GENERATION:
            self.young, self.old = {}, self.young
        unknown = []
        for w in set().union(*pieces).difference(self.young):
            if (found := self.old.get(w)) is not None:
                self.young[w] = found
            else:
                unknown.append(w)
        self.learn(unknown)
        return self.young

    def _long(self, text: str):
        pieces = (m[0] for m in self.cut.finditer(text))
        while some := list(itertools.islice(pieces, AT_ONCE // 8)):
            yield list(map(self._known([some]).__getitem__, some))

    def code(self, texts: list[str]):
        """For each text, in chunks, its pieces' (number of ids, ids as text, decoded bytes)."""
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= AT_ONCE):
                size += len(texts[upto])
                upto += 1
            if size > AT_ONCE:  # one very long text: never all its pieces at once
                yield self._long(texts[at])
            else:
                pieces = [self.cut.findall(t) for t in texts[at:upto]]
                known = self._known(pieces)
                for p in pieces:
                    yield [list(map(known.__getitem__, p))] if p else []
            at = upto


@functools.lru_cache(2)
def coder(vocabulary: bytes, pattern: str) -> Coder:
    return Coder(vocabulary, pattern)


def _shared(df: DataFrame, vocabulary: str | None):
    """What a task calls for its worker's coder."""
    import public_tokenizers

    spark = shipped(df).sparkSession
    held, pattern = spark.sparkContext.broadcast(read_vocabulary(spark, vocabulary)), public_tokenizers.PATTERN
    return lambda: coder(held.value, pattern)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, with_ids: bool = True) -> DataFrame:
    """One row per row of docs: id_col, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded.

    A null text counts as empty and has no tokens; the digests are then those of the empty string. Repeated rows give
    repeated results; an empty table gives none; other columns are ignored. decoded holds the bytes that the ids stand for.
    """
    own_coder = _shared(docs, vocabulary)
    extra = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())] if with_ids else []

    def run(batches):
        own = own_coder()
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                n, ids, decoded, full, whole = [], [], [], [], []
                for chunks in own.code([t.as_py() or "" for t in part.column(1)]):
                    total, one, two, kept_ids, kept_bytes = 0, hashlib.sha256(), hashlib.sha256(), [], []
                    for chunk in chunks:
                        counts, texts, data = zip(*chunk)
                        one.update((" " * (total > 0) + " ".join(texts)).encode())
                        two.update(b"".join(data))
                        total += sum(counts)
                        if with_ids:
                            kept_ids.extend(int(x) for text in texts for x in text.split())
                            kept_bytes.extend(data)
                    n.append(total), ids.append(one.hexdigest()), decoded.append(two.hexdigest())
                    full.append(kept_ids), whole.append(b"".join(kept_bytes))
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    columns += [pa.array(full, pa.list_(pa.int32())), pa.array(whole, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(f.name for f in extra)])

    fields = [T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), *extra]
    return docs.select(id_col, docs[text_col].cast("string").alias("text")).mapInArrow(run, T.StructType(fields))


def decode(rows: DataFrame, ids_col: str = "ids", vocabulary: str | None = None, into: str = "decoded") -> DataFrame:
    """rows with one more column, into: the bytes of its ids by ordered aggregation; a column of that name is replaced.

    Null ids give null, no ids give no bytes.
    """
    rows = rows.select(*[c for c in rows.columns if c == ids_col or c.lower() != into.lower()])
    own_coder = _shared(rows, vocabulary)
    at = rows.columns.index(ids_col)

    def run(batches):
        own = own_coder()
        for b in batches:
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                flat = [(r, p, x) for r, ids in enumerate(part.column(at).to_pylist()) for p, x in enumerate(ids or [])]
                coded = pa.table({n: pa.array([x[i] for x in flat], pa.int32()) for i, n in enumerate(("row", "pos", "id"))})  # noqa: F841
                found = dict(own.db.execute("SELECT row, string_agg(hex, '' ORDER BY pos) FROM coded JOIN vocabulary USING (id) GROUP BY row").fetchall())
                out = [None if ids is None else bytes.fromhex(found.get(r, "")) for r, ids in enumerate(part.column(at).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.binary())], [*part.schema.names, into])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(into, T.BinaryType())]))
