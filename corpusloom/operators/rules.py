"""Named rule sets as data, and what compiles them to Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.words import holds, looked_up

# The rules' patterns and word lists define the results.
RAW_LINE_DROP = (
    r"^!\[.*?\]\(.*?\)\s*$",
    r"^\[.*?\]\(javascript.*?\)\s*$",
    r"^_\s*\d{4}年\d{1,2}月\d{1,2}日.*_",
    r"^在小说阅读器读本章\s*$",
    r"^去阅读\s*$",
    r"^以下文章来源于.*$",
    r"^预览时标签不可点\s*$",
    r"^原创\s+.*\]\(javascript.*$",
    r"^.*👉.*",
    r"^本文来自微信公众号.*?$",
    r"^\*\*.{1,20}\*\*\s*\.",
    r"^\*\*.*想涨知识.*\*\*\s*$",
    r"^\*\*.*关注虎嗅.*\*\*\s*$",
    r"^[\*_\s]+$",
    r"^\]\(https?://.*\)\s*$",
    r"^\[?!\[.*\]\(.*$",
    r"^\*\*\s*文\s*\*\*.*[｜|].*$",
    r"^.*来源[｜|].*封面来源.*$",
)
RAW_EXACT = ("End", "阅读", "去阅读", "[")
#: A garbled heading: its second group is the title.
HEADING = r"^_+\s*(_*\s*)?(.{1,30}?)\s*_+\s*(_+\s*)?$"
TITLE_PREFIX = "早报"
COMMENT_MARKERS = ("分享  留言  收藏", "精选留言", "微信扫一扫", "继续滑动看下一个", "本内容由作者授权发布", "如对本稿件有异议或投诉")
LINE_NOISE = (
    (r"^\s*[*_\s]*(作者|编辑|排版|校对|设计|策划|视觉|运营|监制|出品)\s*[:：|｜]", 60),
    (r"封面来源|题图来源|头图来源|封面图来源|图片来源|封面图|配图来源", 60),
    (r"本文来[自源]|未经授权|不得转载|转载请|授权发布|白名单|投稿邮箱", 90),
    (r"[\w.-]+@[\w.-]+\.\w{2,}", 90),
    (r"扫码|添加微信|微信号\s*[:：]|长按识别|关注公众号|后台回复", 60),
    (r"点个|求点赞|求在看|戳这里|阅读原文", 40),
    (r"^[\s*_\-—|｜·点赞在看分享收藏转发，、]+$", 30),
    (r"^\s*[*_\s]*文\s*[*_\s]*[｜|]", 60),
    (r"来源\s*[｜|].{0,30}$", 50),
)
TAIL_CUT = (
    r"^\s*[*_\s]*(参考文献|参考资料|参考链接|资料来源|图片.{0,6}来源|数据来源|策划制作|科学审核|内容审核|本文.{0,4}审核|责编|主编|监制|出品|"
    r"欢迎转发|家有女儿|我们为您推荐|推荐阅读|往期回顾|延伸阅读|点击.{0,6}阅读|References|参考$)"
)
TAIL_JUNK = (r"^\s*$", r"^\[?\d+\]?[.、]?\s*.{0,120}https?://", r"^https?://", r"^\[\d+\]", r"^[\s*_\-—|｜.·]+$", r"^修改于\s*$")
#: name -> (pattern, only the last 15 lines)
SCAN = {
    "cover_source": (r"封面来源|题图来源|头图来源|图片来源|封面图", False),
    "byline": (r"(?m)^\s*\*{0,2}\s*(作者|编辑|排版|校对|设计)\s*[:：|｜]", False),
    "repost": (r"未经授权|不得转载|授权发布|转载请|白名单", True),
    "from_x": (r"本文来[自源]", True),
    "prompts": (r"点个|在看|小爱心|求关注|分享给|点赞|star标", True),
    "email": (r"[\w.-]+@[\w.-]+\.\w+", True),
    "references": (r"(?m)^\[\d+\]\s*.{0,80}https?://", True),
    "wechat": (r"微信号|公众号ID|添加微信|扫码", True),
}
EVAL = (
    r"封面来源|题图来源|图片来源|封面图",
    r"(?m)^\s*[*_\s]*(作者|编辑|排版|校对|责编|监制|策划)\s*[:：|｜]",
    r"未经授权|不得转载|本文来[自源]|授权发布",
    r"点个|在看|小爱心|求关注|扫码|微信号",
    r"(?m)^\[?\d+\]?\s*.{0,80}https?://",
)
FIVE_POINTS = ("核心矛盾", "读者痛点", "文章结构", "语气定位", "关键素材")
#: PLAN_TONE's words that are a match by themselves, and the two that its last part needs.
PLAN_WORDS, PLAN_AROUND = ("打算", "准备", "我会"), ("先", "再")
PLAN_TONE, REVIEW_TONE = r"打算|准备|我会|先.{0,12}再", ("本文", "这篇文章", "文章讲述", "作者认为")
META_PHRASES = ("Analyze the Request", "Thesis Generation", "Drafting Process", "Final Polish")
INPUT_FIELDS = ("主题：", "受众：", "要求：")


def _any(columns) -> Column:
    return reduce(lambda a, b: a | b, columns, F.lit(False))


def _guarded(line: Column, pattern: str) -> Column:
    """Whether the pattern is found. A literal that every match holds is looked for first, which costs far less than the pattern."""
    literals = NEEDS.get(pattern)
    found = line.rlike(r"(?d)(?U)" + pattern)
    return _any(F.contains(line, F.lit(x)) for x in literals) & found if literals else found


#: For the patterns that scan long lines: literals, one of which each match holds.
NEEDS = {
    RAW_LINE_DROP[8]: ("👉",),
    RAW_LINE_DROP[17]: ("封面来源",),
    LINE_NOISE[3][0]: ("@",),
    SCAN["byline"][0]: ("作者", "编辑", "排版", "校对", "设计"),
    SCAN["email"][0]: ("@",),
    SCAN["references"][0]: ("http",),
    EVAL[1]: ("作者", "编辑", "排版", "校对", "责编", "监制", "策划"),
    EVAL[4]: ("http",),
}
#: Patterns of literals alone, which need no pattern at all.
_PLAIN = {p: tuple(p.split("|")) for p in (SCAN["cover_source"][0], SCAN["repost"][0], SCAN["prompts"][0], SCAN["wechat"][0], EVAL[0], EVAL[3])}


def found(text: Column, pattern: str) -> Column:
    """Whether one of SCAN's or EVAL's patterns is in the text."""
    return _any(F.contains(text, F.lit(x)) for x in _PLAIN[pattern]) if pattern in _PLAIN else _guarded(text, pattern)


def drops_raw(line: Column) -> Column:
    """Whether a stripped line goes. All but two of the patterns begin with one of a few signs, which are looked at first."""
    begun = [p for p in RAW_LINE_DROP if p not in NEEDS]
    sign = line.rlike(r"(?d)(?U)^[!\[_在去以预原本*\]\s]")
    return (sign & _any(line.rlike(r"(?d)(?U)" + p) for p in begun)) | _any(_guarded(line, p) for p in RAW_LINE_DROP if p in NEEDS) | line.isin(*RAW_EXACT)


def is_noise(line: Column) -> Column:
    """Whether a line is noise; no line of over the largest cap is, and most lines end there."""
    return (F.length(line) <= max(cap for _, cap in LINE_NOISE)) & _any((F.length(line) <= cap) & _guarded(line, p) for p, cap in LINE_NOISE)


def is_tail_junk(line: Column) -> Column:
    return _any([line.rlike("(?d)(?U)" + p) for p in TAIL_JUNK] + [is_noise(line)])


#: For each of EVAL's patterns the words, one of which each match holds; those of the PLAIN ones are the pattern.
EVAL_WORDS = {EVAL[0]: _PLAIN[EVAL[0]], EVAL[1]: NEEDS[EVAL[1]], EVAL[2]: ("未经授权", "不得转载", "本文来自", "本文来源", "授权发布"), EVAL[3]: _PLAIN[EVAL[3]], EVAL[4]: NEEDS[EVAL[4]]}
EVAL_PLAIN = (EVAL[0], EVAL[2], EVAL[3])


def eval_words(text: Column) -> Column:
    """struct<found, han> of a text, for eval_hits."""
    return looked_up(text, sum(EVAL_WORDS.values(), ()))


def eval_hits(text: Column, found: Column | None = None) -> Column:
    """How many of EVAL's patterns are in the text; found is that of eval_words, where the caller has it."""
    found = eval_words(text).found if found is None else found
    every = sum(EVAL_WORDS.values(), ())

    def hit(p):
        some = holds(found, every, *EVAL_WORDS[p])
        return (some if p in EVAL_PLAIN else some & text.rlike(r"(?d)(?U)" + p)).cast("int")

    return reduce(lambda a, b: a + b, map(hit, EVAL))
