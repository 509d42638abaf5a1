"""Column functions over text. Every count takes the class of characters that it counts: HAN, or LETTER for other scripts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HAN, LETTER = r"\x{4e00}-\x{9fff}", r"\p{L}"
#: White space as Unicode and the information separators have it.
SPACE = r"[\s\x1c-\x1f]"
SEPARATORS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def let(value: Column, f) -> Column:
    """f of a value that is worked out once, however often f uses it."""
    return F.transform(F.array(value), f)[0]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"(?U){SPACE}+\z", "")


def splitlines(c: Column) -> Column:
    """Lines without their separators; no empty line after the last separator, no line of an empty text."""
    return let(F.split(c, SEPARATORS, -1), lambda parts: F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts))


def only(c: Column, charset: str = HAN) -> Column:
    return F.regexp_replace(c, f"[^{charset}]", "")


def count_of(c: Column, charset: str = HAN) -> Column:
    return F.length(only(c, charset))


def normalize_title(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.replace(name, F.lit(".md"), F.lit("")), r"(?U)[^\w]", ""))


def safe_topic(topic: Column, n: int = 30) -> Column:
    return F.substring(F.regexp_replace(topic, r"(?U)[^\w]+", "_"), 1, n)


def tag(c: Column, name: str) -> Column:
    """The first <name>…</name>, stripped; null without one."""
    pattern = f"(?s)<{name}>(.*?)</{name}>"
    return let(c, lambda x: F.when(x.rlike(pattern), strip(F.regexp_extract(x, pattern, 1))))


def between(c: Column, name: str) -> Column:
    """The first <name>…</name> as it is, null without one: searches for the tags alone, which cost far less than a pattern."""
    opening, closing = f"<{name}>", f"</{name}>"
    rest = F.substring(c, F.instr(c, opening) + F.lit(len(opening)), F.lit(2**31 - 1))
    return F.when(F.contains(c, F.lit(opening)) & F.contains(rest, F.lit(closing)), F.substring_index(rest, closing, 1))


def article_or_all(c: Column) -> Column:
    return let(c, lambda x: F.coalesce(tag(x, "article"), strip(x)))


def reply_scores(reply: Column, required=("depth", "evidence", "genre", "topic")) -> Column:
    """struct of a judge's reply: up to the first closing brace; null where that is no JSON, a key is missing or a number isn't one."""
    body = F.regexp_extract(reply, r"(?s)\{.*?\}", 0)
    body = F.when(F.try_parse_json(body).isNotNull(), body)
    raw = {k: F.get_json_object(body, f"$.{k}") for k in required}
    # a quoted number must be whole, a bare one is cut off
    whole = {k: F.when(body.rlike(rf'"{k}"\s*:\s*"'), F.when(raw[k].rlike(r"^\s*[+-]?\d+\s*$"), raw[k].try_cast("int"))).otherwise(raw[k].try_cast("double").cast("int")) for k in ("depth", "evidence") if k in raw}
    ok = F.lit(True)
    for k in required:
        ok = ok & (whole[k] if k in whole else raw[k]).isNotNull()
    return F.when(ok, F.struct(*[(whole[k] if k in whole else raw[k]).alias(k) for k in required]))


def fingerprint(output: Column, n: int = 500, charset: str = HAN) -> Column:
    return F.md5(F.substring(only(article_or_all(output), charset), 1, n).cast("binary"))


def md5_mod10(c: Column) -> Column:
    """The MD5 number modulo 10: 16 to any power is 6 modulo 10, so four chunks of eight digits do."""
    h = F.md5(c.cast("binary"))
    part = [F.conv(F.substring(h, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]
    return ((part[0] + part[1] + part[2]) * 6 + part[3]) % 10


def route_teacher(name: Column, n_chars: Column, long_over: int = 8000, share: int = 7) -> Column:
    return F.when(n_chars > long_over, "kimi").when(md5_mod10(name) < share, "qwen").otherwise("kimi")


def est_tokens(*texts: Column, charset: str = HAN, rate: float = 1.6) -> Column:
    total = F.lit(0)
    for t in texts:
        total = total + count_of(F.coalesce(t, F.lit("")), charset)
    return F.floor(total * F.lit(rate)).cast("long")


def build_output(thinking: Column, article: Column) -> Column:
    return F.concat(F.lit("<thinking>\n"), thinking, F.lit("\n</thinking>\n\n<article>\n"), article, F.lit("\n</article>"))


def build_input(topic: Column, audience: Column, requirements: Column) -> Column:
    return F.concat(F.lit("主题："), topic, F.lit("\n受众："), audience, F.lit("\n要求："), requirements)
