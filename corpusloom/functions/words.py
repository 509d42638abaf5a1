"""Which of some words a text holds, and its Han characters, in one pass of an Arrow UDF.

Spark looks for a word byte by byte and for each word anew, and in Han text every third byte may begin one; Python's own
search skips, so that twenty words cost less there than two in Spark, the way there included.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def look(text: str, words: tuple[str, ...]) -> tuple[int, int]:
    """(sum of 2^i for each i-th word that the text holds, number of its characters in HAN)."""
    codes = np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)  # no half of a pair lies in HAN
    return sum(1 << i for i, w in enumerate(words) if w in text), int(np.count_nonzero(codes - np.uint16(0x4E00) <= 0x9FFF - 0x4E00))


def within(text: bytes | None, name: str) -> bytes | None:
    """What functions/text.py's between() gives."""
    opening, closing = f"<{name}>".encode(), f"</{name}>".encode()
    at = -1 if text is None else text.find(opening)
    end = -1 if at < 0 else text.find(closing, at + len(opening))
    return None if end < 0 else text[at + len(opening) : end]


def _structs(held: list[tuple[int, int] | None]):
    import pyarrow as pa

    return pa.StructArray.from_arrays(
        [pa.array([h and h[0] for h in held], pa.int64()), pa.array([h and h[1] for h in held], pa.int32())], ["found", "han"], mask=pa.array([h is None for h in held], pa.bool_())
    )


def looked_up(text: Column, words: tuple[str, ...]) -> Column:
    """struct<found: long, han: int> of a text, at most 63 words; null of a null text."""

    @F.arrow_udf("found long, han int")
    def each(texts):
        return _structs([None if b is None else look(b.decode("utf-8", "replace"), words) for b in (x.as_py() for x in texts.cast("binary"))])

    return each(text)


def tagged(text: Column, **words: tuple[str, ...]) -> Column:
    """For each tag a struct as looked_up() gives it, of what stands between the first <tag> and the next </tag>; null without.

    The text goes to Python once and whole, where the tags are found, too; one text at a time is copied.
    """

    @F.arrow_udf(", ".join(f"{name} struct<found: long, han: int>" for name in words))
    def each(texts):
        import pyarrow as pa

        held = [[] for _ in words]
        for b in (x.as_py() for x in texts.cast("binary")):
            for out, (name, own) in zip(held, words.items()):
                inner = within(b, name)
                out.append(None if inner is None else look(inner.decode("utf-8", "replace"), own))
        return pa.StructArray.from_arrays([_structs(h) for h in held], list(words))

    return each(text)


def holds(found: Column, words: tuple[str, ...], *wanted: str) -> Column:
    """Whether any of the wanted is among the words found."""
    return found.bitwiseAND(F.lit(sum(1 << words.index(w) for w in wanted)).cast("long")) != 0
