"""SimHash near-duplicates, found by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most 2r bits if and only if some value lies within r bits of both. So every distinct
fingerprint stands for all its variants within r flipped bits, and fingerprints that share a variant collide. Colliding pairs
are deduplicated and verified by their differing bits. By the triangle inequality no true collision fails that, so the
verification guards the links against a fault in the dealing, and never drops one.

The 2,081 variants (r = 2) are not shuffled as rows. They are dealt by p of their bits, the block: a fingerprint is sent
once to each block within r flips of its own, and makes there just those variants that have the block's bits. With p = 9
that is 46 small rows instead of 2,081. Within a block, sorting brings equal variants together; a run of equal variants
gives a star and not all pairs, so a group of copies of any size stays linear. A block too large for memory splits on
further bits by the same rule.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm._common import cut, discard, shipped
from corpusloom.llm.components import components

SEED = 42
#: Variants that are sorted at once in a task, and that a block should have on average.
AT_ONCE, A_BLOCK = 2_000_000, 1_000_000


def fingerprint(data: bytes, words: int = 4) -> int:
    """The unsigned fingerprint of one UTF-8 text: majority bits of XXH64 over its word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    parts = data.lower().split()  # of bytes: lowers A-Z alone, splits at \x20 and \x09-\x0D alone
    if not parts:
        return 0
    joined, n = b" ".join(parts), max(1, len(parts) - words + 1)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    ends = (ends[min(words, len(parts)) - 1 :] - 1).tolist()
    counts = np.zeros(2048, np.int64)
    for at in range(0, n, 1 << 16):
        h = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])), np.uint64)
        counts += np.bincount((h.view(np.uint8).reshape(-1, 8) + _BYTE_AT).ravel(), minlength=2048)
    ones = counts.reshape(8, 256) @ _BITS  # [byte of the hash, bit of that byte]
    return int.from_bytes(np.packbits((2 * ones > n).astype(np.uint8), axis=1, bitorder="little").tobytes(), "little")


_BYTE_AT = (np.arange(8) * 256).astype(np.int64)
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """id, fp (signed long) for every row; a null text counts as empty."""

    def run(batches):
        for b in batches:
            fps = [fingerprint((x.as_py() or "").encode(), words) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return shipped(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, fp bigint")


def _block_bits(p: int) -> list[int]:
    """p bit positions, spread evenly."""
    return [i * 64 // p for i in range(p)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _flips(bits: list[int], radius: int) -> list[int]:
    """All masks of up to radius of these bits."""
    out = [0]
    if radius >= 1:
        out += [1 << b for b in bits]
    if radius >= 2:
        out += [(1 << a) | (1 << b) for i, a in enumerate(bits) for b in bits[:i]]
    return out


def _runs(base: np.ndarray, left: np.ndarray, free: list[int], label: np.ndarray, who: np.ndarray, fps: np.ndarray, most: int) -> None:
    """Unite the labels of fingerprints that share a variant and differ in at most most bits. The halves of a split share
    label, and what one united stays united.

    base: each one's bits within this block; left: flips it has left; free: the bits not yet fixed by the block; who: its
    place in label and fps.
    """
    sizes = {0: 1, 1: 1 + len(free), 2: 1 + len(free) + len(free) * (len(free) - 1) // 2}
    total = sum(int((left == r).sum()) * n for r, n in sizes.items())
    if len(base) < 2:
        return
    if total > AT_ONCE and free:
        bit, rest = np.uint64(1 << free[0]), free[1:]
        high = (base & bit) != 0
        for side in (False, True):
            same, other = high == side, (high != side) & (left > 0)
            _runs(np.concatenate((base[same], base[other] ^ bit)), np.concatenate((left[same], left[other] - 1)), rest, label, np.concatenate((who[same], who[other])), fps, most)
        return
    values, owners = [], []
    for r in (0, 1, 2):
        if (at := np.flatnonzero(left == r)).size:
            masks = np.array(_flips(free, r), np.uint64)
            values.append((base[at][:, None] ^ masks[None, :]).ravel())
            owners.append(np.repeat(who[at], len(masks)))
    values, owners = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    new = np.concatenate(([True], values[1:] != values[:-1]))
    shared = ~new | np.concatenate((~new[1:], [False]))
    owners, new = owners[shared], new[shared]
    if not owners.size:
        return
    pairs = np.unique(owners * len(fps) + owners[np.flatnonzero(new)[np.cumsum(new) - 1]])  # each with the first of its run, once
    a, b = pairs // len(fps), pairs % len(fps)
    close = np.bitwise_count(fps[a] ^ fps[b]) <= most
    _unite(label, a[close], b[close])


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give a[i] and b[i] one label, with all that have either's label. The labels are roots: label[label] is label, before and after."""
    while (differ := label[a] != label[b]).any():
        a, b = a[differ], b[differ]
        x, y = label[a], label[b]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while ((up := label[label]) != label).any():
            label[:] = up


def _link_block(mask: int, free: list[int], radius: int):
    def run(key, data):
        fps = np.unique(data.column("fp").to_numpy().view(np.uint64))
        block = np.uint64(int(data.column("block")[0].as_py()) & (2**64 - 1))
        base = (fps & np.uint64(~mask & (2**64 - 1))) | block
        left = radius - np.bitwise_count((fps & np.uint64(mask)) ^ block).astype(np.int64)
        label = np.arange(len(fps))
        _runs(base, left, free, label, np.arange(len(fps)), fps, 2 * radius)
        moved = np.flatnonzero(label != np.arange(len(fps)))
        return pa.table({"u": fps[moved].view(np.int64), "v": fps[label[moved]].view(np.int64)})

    return run


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """u, v: edges that span, within each block, the fingerprints linked there. fps: distinct longs in column fp.

    An edge joins fingerprints of one linked group; its ends may differ in more than 2 * radius bits where a chain within
    the block joins them. The components are those of the full graph.
    """
    n = shipped(fps).count()
    p = min(24, max(4, math.ceil(math.log2(max(1, n * 2081 / A_BLOCK)))))
    bits = _block_bits(p)
    mask = sum(1 << b for b in bits)
    free = [b for b in range(63, -1, -1) if b not in bits]
    flips = F.array(*[F.lit(_signed(x)) for x in _flips(bits, radius)])
    dealt = fps.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseAND(F.lit(_signed(mask))).bitwiseXOR(F.col("flip")).alias("block"))
    return dealt.groupBy("block").applyInArrow(_link_block(mask, free, radius), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, distance: int = 4) -> DataFrame:
    """One row per row of docs: id_col, fingerprint (16 hex digits), component_id (the least id reachable over links of
    distance or fewer differing bits).

    Empty, blank and null texts have fingerprint zero and are linked like any other. Repeated rows give repeated results.
    A null id gets its fingerprint's component, and counts nowhere as the least. An empty table gives none. Other columns
    are ignored.
    """
    if distance not in (2, 4):
        raise ValueError("distance must be 2 or 4")
    own, _ = cut(fingerprints(docs, id_col, text_col, words), "simhash")
    groups, at = cut(own.groupBy("fp").agg(F.min("id").alias("first")), "simhash-groups")
    roots = components(links(groups.select("fp"), distance // 2)).select(F.col("node").alias("fp"), "root")
    rooted = groups.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp, _ = cut(rooted.join(least, "root").select("fp", "component_id"), "simhash-components")
    discard(docs.sparkSession, at)
    return own.join(by_fp, "fp", "left").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows that a document of a smaller id in their component stands for; rows that repeat an id stay together."""
    found = near_duplicates(docs.select(id_col, text_col), id_col, text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    return docs.join(gone, id_col, "left_anti")
