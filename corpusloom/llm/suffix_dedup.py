"""Repeated 50-byte strings across documents, by deep-shallow suffix sorting of the places that can repeat.

Equal 50-byte windows hold the same least 24-byte gram at the same place (the minimiser), so only windows around a gram
that two documents share can repeat. That makes three passes over chunks of about a megabyte of text:

1. Each chunk sends the hashes of its grams, once each, to buckets; a bucket answers each chunk which of them are shared.
2. Each chunk sends the bytes around shared grams (the context; equal contexts once, with their least id) to the buckets.
   A bucket sorts all suffixes of its contexts that start a window: multikey quicksort, with characters of eight bytes, to
   the shallow depth of 40 bytes, leaving out what only one document holds; then blind tries order the groups whose members
   still differ. Neighbours with 50 bytes in common form a class, and a window is a repeat if its class has a smaller id.
   The bucket answers each chunk with a bit per window.
3. Each chunk marks the bytes that repeated windows cover.

The contexts of a gram that many chunks share would meet in one bucket. Every window has thirteen bytes more on one side of
its gram, so such a gram's windows are dealt out by the gram and those bytes, to the left or to the right of it.

Sharing is found by hash and only widens the search; the decision always compares bytes. A string that thousands of
documents share costs a context per chunk, not one per document or pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._common import cut, shipped, shuffle_partitions

LENGTH, GRAM = 50, 24
SPAN = LENGTH - GRAM  # bytes of a window besides its gram
CONTEXT = GRAM + 2 * SPAN
WIDTH = CONTEXT + 2  # and the first and last window that a context has
CHUNK, SEGMENT = 1_000_000, 1 << 19
#: Bytes of text for each bucket, and the size of a group in which a suffix's depth is shallow.
BUCKET_BYTES, SHALLOW = 5_000_000, 40
#: A gram in more chunks is dealt out by the SIDE bytes beside it.
HOT, SIDE = 64, SPAN // 2
NO_ID = np.iinfo(np.int64).max

_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _sliding(x: np.ndarray, width: int, f) -> np.ndarray:
    """f over each width neighbours; width - 1 shorter."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = f(x[:-step], x[step:])
        have += step
    return x


def anchors(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the minimisers of all windows within documents, starts[i] to ends[i] of text."""
    at_all, hash_all = [], []
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    inside = np.zeros(len(text) + 1, np.int8)  # 1 where a gram fits into its document
    fits = ends - starts >= GRAM
    np.add.at(inside, starts[fits], 1)
    np.add.at(inside, ends[fits] - GRAM + 1, -1)
    valid = np.cumsum(inside[:-1], dtype=np.int8) > 0
    for a in range(0, len(text), SEGMENT):
        low, high = max(0, a - SPAN), min(len(text), a + SEGMENT + LENGTH)
        part = np.zeros(high - low + GRAM + 8, np.uint8)
        part[: high - low] = text[low:high]
        n = high - low
        word = np.empty(n + GRAM, np.uint64)
        for o in range(8):
            view = part[o : o + (len(part) - o) // 8 * 8].view("<u8")
            word[o::8] = view[: len(word[o::8])]
        h = word[:n] * _MULTIPLIERS[0]
        h ^= (h >> np.uint64(32)) ^ (word[8 : n + 8] * _MULTIPLIERS[1])
        h *= _MULTIPLIERS[2]
        h ^= (h >> np.uint64(29)) ^ (word[16 : n + 16] * _MULTIPLIERS[0])
        h *= _MULTIPLIERS[1]
        h ^= h >> np.uint64(32)
        h &= ~np.uint64(1)
        h[~valid[low:high]] = none
        padded = np.concatenate((np.full(SPAN, none), h, np.full(SPAN, none)))
        opened = _sliding(_sliding(padded, SPAN + 1, np.minimum), SPAN + 1, np.maximum)  # as long as h
        found = np.flatnonzero((h == opened) & (h != none))
        found = found[(found + low >= a) & (found + low < a + SEGMENT)]
        at_all.append(found + low)
        hash_all.append(h[found])
    return (np.concatenate(at_all), np.concatenate(hash_all)) if at_all else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


class Chunk:
    """The documents of one chunk, one after the other."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, text: bytes):
        self.ids, self.text = ids, np.frombuffer(text, np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.at, self.hashes = anchors(self.text, self.starts, self.ends)
        self.doc = np.searchsorted(self.ends, self.at, "right")

    def grams(self) -> np.ndarray:
        """Each hash once; its lowest bit tells that two ids of this chunk share it."""
        order = np.argsort(self.hashes, kind="stable")
        h, ids = self.hashes[order], self.ids[self.doc[order]]
        if not len(h):
            return h
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
        return h[first] | several.astype(np.uint64)

    def contexts(self, shared: np.ndarray, buckets: int):
        """Distinct contexts of the shared grams, by bucket: (n, WIDTH) bytes, bucket of each, least id; and for each occurrence
        its place, first and last window, its context and its id. The lowest bit of a shared hash tells that it is hot."""
        shared = np.sort(shared)
        plain = shared & ~np.uint64(1)
        held, hot = np.zeros(len(self.hashes), bool), np.zeros(0, bool)
        if len(shared) and len(held):
            place = np.minimum(np.searchsorted(plain, self.hashes), len(plain) - 1)
            held = plain[place] == self.hashes
            held &= self.ends[self.doc] - self.starts[self.doc] >= LENGTH
            hot = (shared[place] & np.uint64(1)).astype(bool)[held]
        at, doc, h = self.at[held], self.doc[held], self.hashes[held]
        first = np.maximum(0, SPAN - (self.ends[doc] - at - GRAM)).astype(np.int64)  # bytes left of the gram, at least and at most
        last = np.minimum(SPAN, at - self.starts[doc]).astype(np.int64)
        # the windows of a hot gram that have SIDE bytes to its left, and the others, which have more than that to its right
        left, right = hot & (last >= SIDE), hot & (first < SIDE)
        side = np.concatenate((np.zeros((~hot).sum(), np.int8), np.full(left.sum(), 1, np.int8), np.full(right.sum(), 2, np.int8)))
        at, doc, h, first, last = (np.concatenate((x[~hot], x[left], x[right])) for x in (at, doc, h, first, last))
        first = np.where(side == 1, np.maximum(first, SIDE), first)
        last = np.where(side == 2, np.minimum(last, SIDE - 1), last)
        rows = np.zeros((len(at), WIDTH), np.uint8)
        padded = np.concatenate((np.zeros(SPAN, np.uint8), self.text, np.zeros(SPAN + GRAM, np.uint8)))
        rows[:, :CONTEXT] = np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[at]
        edge = np.flatnonzero((first > 0) | (last < SPAN))  # no window has the bytes beyond
        column = np.arange(CONTEXT)
        rows[edge, :CONTEXT] *= (column >= (SPAN - last[edge])[:, None]) & (column < CONTEXT - first[edge][:, None])
        rows[:, CONTEXT], rows[:, CONTEXT + 1] = first, last
        for k, low in ((1, SPAN - SIDE), (2, SPAN + GRAM)):
            chosen = side == k
            beside = np.zeros((chosen.sum(), 16), np.uint8)
            beside[:, :SIDE] = rows[chosen, low : low + SIDE]
            word = beside.view("<u8")
            mixed = (h[chosen] ^ word[:, 0] * _MULTIPLIERS[0] ^ word[:, 1] * _MULTIPLIERS[1]) * _MULTIPLIERS[2]
            h[chosen] = mixed ^ (mixed >> np.uint64(29))
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        digest = _row_digest(rows)
        order = np.lexsort((digest[1], digest[0], bucket))
        b, d0, d1 = bucket[order], digest[0][order], digest[1][order]
        new = np.concatenate(([True], (b[1:] != b[:-1]) | (d0[1:] != d0[:-1]) | (d1[1:] != d1[:-1]))) if len(order) else np.zeros(0, bool)
        # digests bring equal contexts together; bytes decide
        if len(order):
            new[1:] |= (rows[order[1:]] != rows[order[:-1]]).any(1)
        of = np.empty(len(order), np.int64)
        of[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        ids = self.ids[doc]
        least = np.minimum.reduceat(ids[order], starts) if len(starts) else ids[:0]
        return rows[order[starts]], b[starts], least, (at, first, last, of, ids)

    def marked(self, where, repeats: np.ndarray, least: np.ndarray) -> np.ndarray:
        """How many repeated windows cover each byte, over 0 or not. repeats: a bit per window of each context."""
        at, first, last, of, ids = where
        bits = repeats[of].copy()
        bits[ids > least[of]] = (1 << (SPAN + 1)) - 1  # a smaller id of this chunk has the whole context
        edge = np.zeros(len(self.text) + 1, np.int64)
        for s in range(SPAN + 1):
            hit = at[((bits >> s) & 1).astype(bool) & (first <= s) & (s <= last)] - s
            hit = np.unique(hit)
            edge[hit] += 1
            edge[hit + LENGTH] -= 1
        return np.cumsum(edge[:-1]) > 0


def _row_digest(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wide = np.zeros((len(rows), -(-WIDTH // 8) * 8), np.uint8)
    wide[:, :WIDTH] = rows
    words = wide.view("<u8")
    out = []
    for m in _MULTIPLIERS[:2]:
        h = np.zeros(len(rows), np.uint64)
        for k in range(words.shape[1]):
            h = (h ^ words[:, k]) * m
            h ^= h >> np.uint64(31)
        out.append(h)
    return out[0], out[1]


class BlindTrie:
    """Orders strings of LENGTH bytes: inner nodes keep only the place where their branches differ; one full comparison of a
    new string with a leaf that is found blindly gives the place where it belongs."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _leaf(node):
        while node[0] is not None:
            node = next(iter(node[1].values()))
        return node

    def add(self, string: bytes, member: int) -> None:
        if self.root is None:
            self.root = (None, string, [member])
            return
        node = self.root
        while node[0] is not None:
            node = node[1].get(string[node[0]]) or self._leaf(node)
        known = node[1]
        if known == string:
            node[2].append(member)
            return
        at = next(i for i, (x, y) in enumerate(zip(string, known)) if x != y)
        above, node = None, self.root
        while node[0] is not None and node[0] < at:
            above, node = node, node[1][string[node[0]]]
        leaf = (None, string, [member])
        if node[0] == at:
            node[1][string[at]] = leaf
            return
        branch = (at, {known[at]: node, string[at]: leaf})
        if above is None:
            self.root = branch
        else:
            above[1][string[above[0]]] = branch

    def classes(self):
        """Members of equal strings together, in the strings' order."""
        stack = [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                yield node[2]
            else:
                stack += [node[1][k] for k in sorted(node[1], reverse=True)]


def repeated(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each context a bit per window: some smaller id has the window too."""
    out = np.zeros(len(rows), np.int64)
    if not len(rows):
        return out
    # equal contexts of several chunks: one stands for all, the others repeat it whole unless their id is as small
    d0, d1 = _row_digest(rows)
    order = np.lexsort((ids, d1, d0))
    same = np.concatenate(([False], (rows[order[1:]] == rows[order[:-1]]).all(1)))
    group = np.cumsum(~same) - 1
    lead = order[~same]
    every = (1 << (SPAN + 1)) - 1
    leader = np.empty(len(rows), np.int64)
    leader[order] = lead[group]
    out[ids > ids[leader]] = every

    padded = np.zeros((len(rows), CONTEXT + 8), np.uint8)
    padded[:, :CONTEXT] = rows[:, :CONTEXT]
    flat = padded.ravel()
    stride = CONTEXT + 8
    owner, window = [], []
    for s in range(SPAN + 1):
        has = lead[(rows[lead, CONTEXT] <= s) & (s <= rows[lead, CONTEXT + 1])]
        owner.append(has)
        window.append(np.full(len(has), s, np.int8))
    owner, window = np.concatenate(owner), np.concatenate(window)

    def word(depth: int, o: np.ndarray, w: np.ndarray) -> np.ndarray:
        at = o * stride + SPAN - w + depth
        value = np.zeros(len(at), np.uint64)
        for k in range(8):
            value = (value << np.uint64(8)) | flat[at + k]
        return value

    group = np.zeros(len(owner), np.int64)
    for depth in range(0, SHALLOW, 8):  # multikey quicksort, eight bytes a character
        key = word(depth, owner, window)
        order = np.lexsort((key, group)) if depth else np.argsort(key, kind="quicksort")
        owner, window, group, key = owner[order], window[order], group[order], key[order]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (key[1:] != key[:-1]))) if len(key) else np.zeros(0, bool)
        owner, window, group = _several(owner, window, new, ids)
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1]))) if len(group) else np.zeros(0, np.int64)
    # groups whose members agree to the end are classes already
    differs = np.zeros(len(owner), bool)
    for depth in (SHALLOW, LENGTH - 8):
        key = word(depth, owner, window)
        differs |= key != np.repeat(key[starts], np.diff(np.append(starts, len(key))))
    mixed = np.add.reduceat(differs, starts) > 0 if len(starts) else np.zeros(0, bool)
    ends = np.append(starts[1:], len(owner))
    own, raw = ids[owner], flat.tobytes()
    if len(starts):
        least = np.repeat(np.where(mixed, np.iinfo(np.int64).min, np.minimum.reduceat(own, starts)), ends - starts)
        hit = (own > least) & ~np.repeat(mixed, ends - starts)
        np.bitwise_or.at(out, owner[hit], np.int64(1) << window[hit].astype(np.int64))
    for a, b in zip(starts[mixed].tolist(), ends[mixed].tolist()):
        trie, begins, whose = BlindTrie(), (owner[a:b] * stride + SPAN - window[a:b]).tolist(), own[a:b].tolist()
        for k, begin in enumerate(begins):
            trie.add(raw[begin : begin + LENGTH], k)
        for members in trie.classes():
            if len(members) > 1:
                small = min(whose[k] for k in members)
                for k in members:
                    if whose[k] > small:
                        out[owner[a + k]] |= 1 << int(window[a + k])
    # those that a leader of the same id stands for share its windows
    return out | np.where(ids == ids[leader], out[leader], 0)


def _several(owner, window, new, ids):
    """Leave out groups that only one id holds; number the others."""
    if not len(owner):
        return owner, window, np.zeros(0, np.int64)
    starts = np.flatnonzero(new)
    own = ids[owner]
    keep = np.minimum.reduceat(own, starts) != np.maximum.reduceat(own, starts)
    sizes = np.diff(np.append(starts, len(owner)))
    mask = np.repeat(keep, sizes)
    return owner[mask], window[mask], np.repeat(np.arange(len(starts)), sizes)[mask]


def _chunks(batches):
    import itertools

    import zstandard
    from pyspark import TaskContext

    part, number = TaskContext.get().partitionId(), itertools.count()

    pack = zstandard.ZstdCompressor(level=1)

    def made(ids, texts):
        sizes = np.array([len(t) for t in texts], np.int64)
        raw = b"".join(texts)
        known = np.array([NO_ID if i is None else i for i in ids], np.int64)
        nulls = bytes(i is None for i in ids)
        return {"chunk": f"{part}-{next(number)}", "ids": known.tobytes(), "nulls": nulls, "sizes": sizes.tobytes(), "data": pack.compress(raw), "n_bytes": len(raw)}

    schema = pa.schema([("chunk", pa.string()), ("ids", pa.binary()), ("nulls", pa.binary()), ("sizes", pa.binary()), ("data", pa.binary()), ("n_bytes", pa.int64())])
    ids, texts, n = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0), b.column(1)):
            ids.append(i.as_py())
            texts.append((t.as_py() or "").encode())
            n += len(texts[-1])
            if n >= CHUNK or len(ids) >= 20_000:
                yield pa.RecordBatch.from_pylist([made(ids, texts)], schema)
                ids, texts, n = [], [], 0
    if ids:
        yield pa.RecordBatch.from_pylist([made(ids, texts)], schema)


CHUNKS = "chunk string, ids binary, nulls binary, sizes binary, data binary, n_bytes bigint"


def _opened(b: pa.RecordBatch, k: int) -> Chunk:
    import zstandard

    row = {n: b.column(n)[k].as_py() for n in ("ids", "sizes", "data", "n_bytes")}
    return Chunk(np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64), zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=max(1, row["n_bytes"])))


def _send_grams(buckets: int):
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                h = _opened(b, k).grams()
                bucket = ((h & ~np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                found, at = np.unique(bucket[order], return_index=True)
                parts = np.split(h[order], at[1:]) if len(found) else []
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array([b.column("chunk")[k].as_py()] * len(found), pa.string()), pa.array([_packed(p) for p in parts], pa.binary())], ["bucket", "chunk", "grams"])

    return run


def _packed(h: np.ndarray) -> bytes:
    """Sorted hashes as byte planes of their differences; the planes of high bytes are nearly constant."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _answer_grams(key, data):
    lists = [_unpacked(x) for x in data.column("grams").to_pylist()]
    every = np.concatenate(lists)
    plain, times = np.unique(every & ~np.uint64(1), return_counts=True)
    shared = np.union1d(plain[times > 1], every[(every & np.uint64(1)) == 1] & ~np.uint64(1))
    hot = shared | np.isin(shared, plain[times > HOT], assume_unique=True).astype(np.uint64)  # told by the lowest bit
    out = []
    for c, h in zip(data.column("chunk").to_pylist(), lists):
        h = h & ~np.uint64(1)
        at = np.minimum(np.searchsorted(shared, h), len(shared) - 1)
        if len(shared) and len(found := hot[at[shared[at] == h]]):
            out.append((c, _packed(found)))
    return pa.table({"chunk": pa.array([x[0] for x in out], pa.string()), "shared": pa.array([x[1] for x in out], pa.binary())})


def _shared(b, k) -> np.ndarray:
    lists = b.column("shared")[k].as_py()
    return np.concatenate([_unpacked(x) for x in lists]) if lists else np.zeros(0, np.uint64)


def _send_contexts(buckets: int):
    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            for k in range(b.num_rows):
                rows, bucket, least, _ = _opened(b, k).contexts(_shared(b, k), buckets)
                found, at = np.unique(bucket, return_index=True)
                cuts = np.append(at, len(bucket))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found),
                        pa.array([b.column("chunk")[k].as_py()] * len(found), pa.string()),
                        pa.array([pack.compress(rows[x:y].tobytes()) for x, y in zip(cuts[:-1], cuts[1:])], pa.binary()),
                        pa.array([least[x:y].tobytes() for x, y in zip(cuts[:-1], cuts[1:])], pa.binary()),
                    ],
                    ["bucket", "chunk", "contexts", "least"],
                )

    return run


def _answer_contexts(key, data):
    import zstandard

    open_ = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(open_.decompress(x), np.uint8).reshape(-1, WIDTH) for x in data.column("contexts").to_pylist()]
    ids = [np.frombuffer(x, np.int64) for x in data.column("least").to_pylist()]
    bits = repeated(np.concatenate(rows), np.concatenate(ids)).astype(np.uint32)
    parts = np.split(bits, np.cumsum([len(x) for x in ids])[:-1])
    return pa.table({"chunk": data.column("chunk"), "bucket": data.column("bucket"), "bits": pa.array([p.tobytes() for p in parts], pa.binary())})


def _digests(buckets: int, with_kept: bool):
    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                chunk = _opened(b, k)
                rows, bucket, least, where = chunk.contexts(_shared(b, k), buckets)
                answers = sorted((x["bucket"], x["bits"]) for x in b.column("answers")[k].as_py() or [])
                repeats = np.concatenate([np.frombuffer(x[1], np.uint32) for x in answers]).astype(np.int64) if answers else np.zeros(0, np.int64)
                gone = chunk.marked(where, repeats, least)
                total = np.concatenate(([0], np.cumsum(gone)))
                begins = np.concatenate(([False], gone[1:] & ~gone[:-1])) if len(gone) else gone
                inner = chunk.starts[chunk.starts < len(gone)]
                if len(gone):
                    begins[inner] = gone[inner]
                spans = np.concatenate(([0], np.cumsum(begins)))
                s, e = chunk.starts, chunk.ends
                kept = [chunk.text[x:y].tobytes() if not total[y] - total[x] else chunk.text[x:y][~gone[x:y]].tobytes() for x, y in zip(s, e)]
                nulls = np.frombuffer(b.column("nulls")[k].as_py(), np.uint8).astype(bool)
                columns = [pa.array(chunk.ids, mask=nulls), pa.array(e - s), pa.array(total[e] - total[s]), pa.array(spans[e] - spans[s]), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.binary())] if with_kept else []), ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = True) -> DataFrame:
    """One row per row of docs: id_col, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes that stay).

    A byte goes if a 50-byte string that covers it also starts in a document of a smaller id. Rows that repeat an id are
    one rank and remove nothing from each other. A null text counts as empty; a null id counts as larger than any other but
    2**63 - 1, which ranks with it. Ids are whole numbers of up to 64 bits; other types are an error. An empty table gives
    no rows; other columns are ignored.
    """
    spark = shipped(docs).sparkSession
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{id_col} must be a whole number")
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    chunks, _ = cut(own.mapInArrow(_chunks, CHUNKS), "chunks")
    total = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = max(shuffle_partitions(spark), -(-total // BUCKET_BYTES))
    grams = chunks.mapInArrow(_send_grams(buckets), "bucket bigint, chunk string, grams binary")
    answered = grams.groupBy("bucket").applyInArrow(_answer_grams, "chunk string, shared binary")
    shared, _ = cut(answered.groupBy("chunk").agg(F.collect_list("shared").alias("shared")), "shared")
    both = chunks.join(shared, "chunk")
    contexts = both.select("chunk", "ids", "sizes", "data", "n_bytes", "shared").mapInArrow(_send_contexts(buckets), "bucket bigint, chunk string, contexts binary, least binary")
    sorted_ = contexts.groupBy("bucket").applyInArrow(_answer_contexts, "chunk string, bucket bigint, bits binary")
    answers, _ = cut(sorted_.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")), "answers")
    whole = chunks.join(shared.join(answers, "chunk", "left"), "chunk", "left")
    out = whole.mapInArrow(_digests(buckets, with_kept), "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * with_kept)
    return out.withColumnRenamed("id", id_col)
