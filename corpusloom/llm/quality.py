"""Quality by nearest-neighbour voting among labelled latent-semantic vectors.

A text's terms are its trigrams of byte classes (letter, capital, digit, space, each frequent sign), its words (hashed),
and bins of how much it repeats itself. A bounded sample of labelled texts gives document frequencies and, by a truncated
singular value decomposition, the latent space; its vectors and labels are broadcast. Each document is projected, its
exact cosines with all of them are taken block by block, and its nearest neighbours vote with their similarity.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm._common import shipped

#: The bound of the labelled sample, the rank of the space, the voters, the power of a similarity as a weight.
SAMPLE, RANK, NEIGHBOURS, POWER, THRESHOLD = 3000, 48, 15, 8, 0.7
SHAPES, WORDS, STATS = 4096, 4096, 48
TERMS = SHAPES + WORDS + STATS
#: What each part of the terms weighs after it is brought to length one.
WEIGHTS = ((0, SHAPES, 1.0), (SHAPES, SHAPES + WORDS, 0.3), (SHAPES + WORDS, TERMS, 0.6))
BLOCK = 256

_CLASS = np.full(256, 15, np.int64)
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[128:] = 5
for _k, _signs in ((3, b" \t"), (4, b"\n\r"), (6, b".,"), (7, b"|"), (8, b"$"), (9, b"%"), (10, b"*"), (11, b"#"), (12, b"&"), (13, b"!"), (14, b"@")):
    _CLASS[list(_signs)] = _k


def terms(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and counts of a text's terms."""
    shapes = np.zeros(SHAPES, np.int64)
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, max(0, len(raw) - 2), 1 << 20):
        c = _CLASS[raw[at : at + (1 << 20) + 2]]
        shapes += np.bincount(c[:-2] * 256 + c[1:-1] * 16 + c[2:], minlength=SHAPES)
    at = np.flatnonzero(shapes)
    parts = data.lower().split()
    held = Counter(parts)
    words = np.bincount(np.fromiter((zlib.crc32(w) for w in held), np.int64, len(held)) % WORDS, np.fromiter(held.values(), np.float64, len(held)), WORDS) if held else np.zeros(WORDS)
    found = np.flatnonzero(words)
    n = len(parts)
    again = sum(map(bytes.__eq__, parts[1:], parts)) / n if n else 1.0
    stats = [min(11, int(12 * len(held) / n)) if n else 0, 12 + min(11, int(24 * again)), 24 + min(23, n.bit_length())]
    index = np.concatenate((at, SHAPES + found, SHAPES + WORDS + np.array(stats)))
    return index, np.concatenate((shapes[at], words[found], np.ones(3)))


def _weighted(rows: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> np.ndarray:
    x = np.zeros((len(rows), TERMS), np.float32)
    for k, (index, count) in enumerate(rows):
        x[k, index] = np.log1p(count)
    x *= idf
    for a, b, weight in WEIGHTS:
        x[:, a:b] *= weight / np.maximum(np.linalg.norm(x[:, a:b], axis=1, keepdims=True), 1e-9)
    return x


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


class Model:
    """idf, the projection, the sample's vectors and labels: at most SAMPLE x RANK and TERMS x RANK numbers."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int]):
        self.labels = np.array(labels, np.float32)
        self.prior = float(self.labels.mean()) if labels else 0.5
        df = np.zeros(TERMS)
        for index, _ in rows:
            df[index] += 1
        self.idf = np.log((1 + len(rows)) / (1 + df)).astype(np.float32) + np.float32(0.1)
        if not rows:
            self.projection, self.vectors = np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32)
            return
        x = _weighted(rows, self.idf)
        q = x @ np.random.default_rng(7).standard_normal((TERMS, min(RANK + 16, len(rows))), np.float32)
        for _ in range(3):
            q, _ = np.linalg.qr(x @ (x.T @ np.linalg.qr(q)[0]))
        self.projection = np.ascontiguousarray(np.linalg.svd(q.T @ x, full_matrices=False)[2][:RANK].T)
        self.vectors = _unit(x @ self.projection)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The share of label 1 among each text's nearest neighbours, weighted by similarity."""
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.vectors))
        for at in range(0, len(texts) if k else 0, BLOCK):
            own = _unit(_weighted([terms(t) for t in texts[at : at + BLOCK]], self.idf) @ self.projection)
            cosines = own @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            found = np.take_along_axis(cosines, near, 1)
            weight = np.maximum(found, 0).astype(np.float64) ** POWER
            votes, total = (weight * self.labels[near]).sum(1), weight.sum(1)
            last = found.min(1)
            for row in np.flatnonzero((cosines >= last[:, None]).sum(1) > k):  # all that tie for the last places share them
                own_row = cosines[row]
                above, tied = own_row > last[row], own_row == last[row]
                shares = np.maximum(own_row, 0).astype(np.float64) ** POWER * (above + tied * ((k - above.sum()) / tied.sum()))
                votes[row], total[row] = (shares * self.labels).sum(), shares.sum()
            out[at : at + BLOCK] = np.where(total > 0, votes / np.maximum(total, 1e-300), self.prior)
        return out.clip(0, 1)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of at most sample labelled rows that are not held out, those of the least hashes of their id.

    Rows without an id or label are passed over; of repeated ids the least label and the least text count. Without any labelled
    row every score is 0.5.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
    chosen = usable.groupBy("doc_id").agg(F.min("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches):
        for b in batches:
            found = [terms((t.as_py() or "").encode()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x[0] for x in found], pa.list_(pa.int64())), pa.array([x[1] for x in found], pa.list_(pa.float64()))], ["doc_id", "quality", "index", "count"])

    joined = shipped(docs).select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", F.col("quality").cast("int").alias("quality")).agg(F.min(F.col("text").cast("string")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = sorted(joined.mapInArrow(run, f"doc_id {kind}, quality int, index array<bigint>, count array<double>").toLocalIterator(), key=lambda r: r.doc_id)
    return Model([(np.array(r["index"], np.int64), np.array(r["count"])) for r in rows], [r.quality for r in rows])


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "_score", columns: list[str] | None = None) -> DataFrame:
    """docs, or just those columns of it, with one more column, into; a column of docs of that name is replaced.

    A null text counts as empty; empty texts are scored by their neighbours too. Neighbours that tie for the last places
    share them. Repeated rows get one score each; an empty table gives no rows; a long text is read whole, in pieces.
    """
    kept = [c for c in (shipped(docs).columns if columns is None else columns) if c.lower() != into.lower()]
    own = docs.select(*[F.col(f"`{c}`") for c in kept if c != text_col], F.col(text_col).cast("string"))
    at = len(own.columns) - 1
    order = [at if c == text_col else own.columns.index(c) for c in kept]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, BLOCK):
                part = b.slice(k, BLOCK)
                found = shared.value.scores([(t.as_py() or "").encode() for t in part.column(at)])
                yield pa.RecordBatch.from_arrays([*[part.column(x) for x in order], pa.array(found)], [*kept, into])

    return own.mapInArrow(run, T.StructType([*[own.schema[x] for x in order], T.StructField(into, T.DoubleType())]))
