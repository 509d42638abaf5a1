"""ROUGE-L over characters: no built-in gives the longest common subsequence, so an Arrow UDF does, bit-parallel."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, at any length; of the longer text a machine word or more at once.

    A text that lies in the other, in one piece or as a subsequence, is settled in one pass; all else takes the product of the lengths.
    """
    a, b = (a, b) if len(a) >= len(b) else (b, a)
    if b in a or _within(b, a):
        return len(b)
    codes = np.frombuffer(a.encode("utf-32-le"), np.uint32)
    places = {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in set(b)}
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places[c]
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _within(part: str, whole: str) -> bool:
    at = 0
    for c in part:
        if not (at := whole.find(c, at) + 1):
            return False
    return True


def rouge_l(a: str | None, b: str | None) -> float:
    x, y = ("".join((t or "").split()) for t in (a, b))
    n = lcs(x, y) if x and y else 0
    return 2 * n / (len(x) + len(y)) if n else 0.0


@F.arrow_udf(DoubleType())
def rouge_l_udf(a, b):
    import pyarrow as pa

    return pa.array([rouge_l(x.as_py(), y.as_py()) for x, y in zip(a, b)], pa.float64())  # one pair of a batch as text at a time
