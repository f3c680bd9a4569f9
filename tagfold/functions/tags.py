"""Column expressions for log cleaning and tag extraction.

Every extractor returns an ``array`` column whose elements are distinct within
the row: a log row contributes each (module, tag) at most once, whatever the
weight. Exploding happens in the operators.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# User-agent markers of crawlers; a log row whose lower-cased
# user agent contains any of them (lower-cased) is dropped.
BOT_MARKERS = [
    "spider",
    "+Galaxy+Nexus+Build/ICL53F)+",
    "bingbot",
    "trendkite-akashic-crawler",
    "SHV-E250S Build/JZO54K",
    "python-requests",
    "Googlebot-Image",
    "Scrapy",
    "Baiduspider",
    "YisouSpider",
    "Kazehakase",
    "(+https://scrapy.org)",
    "Windows; U; MSIE",
    "Bytespider",
    "ToutiaoSpider",
    "360Spider",
    "baiduboxapp",
    "bot",
    "SinaWeiboBot",
    "Googlebot",
    "DotBot",
    "Facebot",
    "applebot",
    "cliqzbot",
    "SurveyBot",
    "MagiBot",
    "oBot",
    "KomodiaBot",
    "aiHitBot",
    "LinkpadBot",
    "MJ12bot",
    "TurnitinBot",
    "YoudaoBot",
    "http://mappydata.net/bot",
    "coccocbot-web",
    "Twitterbot",
    "YandexMobileBot",
    "SEMrushBot",
]

# Author names that are bylines, not authors.
AUTHOR_STOP_NAMES = ["整理", "本报记者", "通讯员"]

# Action -> tag weight; any other action weighs 1.
ACTION_WEIGHTS = {"buy": 2.0}

# Actions that count as reading an article.
ARTICLE_ACTIONS = ["browse", "buy", "read", "collect", "concern", "comment"]


def least_markers(markers=BOT_MARKERS) -> list[str]:
    """The lower-cased markers, without those that hold another one: a text with
    such a marker has the other one too."""
    low = dict.fromkeys(m.lower() for m in markers)
    return [m for m in low if not any(o in m for o in low if o != m)]


def is_human(ua: Column, markers=BOT_MARKERS) -> Column:
    """True when the user agent holds none of the crawler markers (F1).
    A null agent counts as the empty string."""
    text = F.lower(F.coalesce(ua, F.lit("")))
    out = F.lit(True)
    for m in least_markers(markers):
        out = out & ~F.contains(text, F.lit(m))
    return out


def clean_user(un: Column) -> Column:
    """User name without blanks and double quotes (applied once, at the log edge)."""
    return F.regexp_replace(F.coalesce(un, F.lit("")), '[ "]', "")


def action_weight(ac: Column) -> Column:
    """tag weight of an action."""
    w = F.lit(1.0)
    for action, weight in ACTION_WEIGHTS.items():
        w = F.when(ac == action, F.lit(weight)).otherwise(w)
    return w


def _non_empty(arr: Column) -> Column:
    return F.filter(arr, lambda x: x != "")


def java_split(s: Column, pattern: str) -> Column:
    """Regex split with JVM ``String.split`` semantics: trailing empty pieces
    are removed (Spark's ``split`` keeps them), except that input without
    any match comes back whole (so '' gives ['']).

    The split array is bound once as a lambda variable (wrapped in a
    one-element array), so the regex runs once per row, and the trim is
    linear in the number of pieces (reverse, find the last non-empty piece,
    slice)."""
    empty = F.array().cast("array<string>")

    def trim(p):
        last = F.array_position(F.transform(F.reverse(p), lambda x: x != ""), True)  # 0 when all empty
        return (F.when(F.size(p) == 1, p).when(last == 0, empty)
                .otherwise(F.slice(p, 1, F.size(p) - last + 1)))

    return F.get(F.transform(F.array(F.split(s, pattern)), trim), 0)


def subject_codes(rcc: Column) -> Column:
    """``rcc`` split on comma/blank/semicolon, first four characters of each
    code; codes shorter than four characters are skipped."""
    codes = F.filter(F.split(F.coalesce(rcc, F.lit("")), "[, ;]"), lambda c: F.length(c) >= 4)
    return F.array_distinct(F.transform(codes, lambda c: F.substring(c, 1, 4)))


def subsubject_codes(rcc: Column) -> Column:
    """The full codes, non-empty, distinct."""
    return F.array_distinct(_non_empty(F.split(F.coalesce(rcc, F.lit("")), "[, ;]")))


def interest_modules(rcc: Column) -> Column:
    """T1 modules: ``rcc`` split on ';', first four characters, short codes skipped."""
    codes = F.filter(F.split(F.coalesce(rcc, F.lit("")), ";"), lambda c: F.length(c) >= 4)
    return F.array_distinct(F.transform(codes, lambda c: F.substring(c, 1, 4)))


def interest_keywords(rkd: Column) -> Column:
    """T1 keywords: drop '<', blank and '>', split on '$$$' (two pieces -> the
    second, one piece -> it, otherwise none), split on comma/blank/';'/'$',
    non-empty, lower-cased, distinct."""
    cleaned = F.regexp_replace(F.coalesce(rkd, F.lit("")), "[< >]", "")
    # the choice is made inside a lambda so the pieces are computed once
    chosen = F.aggregate(F.array(java_split(cleaned, r"\$\$\$")), F.lit(None).cast("string"),
                         lambda acc, p: F.when(F.size(p) == 2, F.get(p, 1)).when(F.size(p) == 1, F.get(p, 0)))
    words = _non_empty(F.split(F.coalesce(chosen, F.lit("")), r"[, ;$]"))
    return F.array_distinct(F.transform(words, F.lower))


def author_names(au: Column, stop_names=AUTHOR_STOP_NAMES) -> Column:
    """T4: remove CR/LF/blank, split on comma (ASCII or full-width) and ';',
    drop byline stop names and empties, distinct."""
    cleaned = F.regexp_replace(F.coalesce(au, F.lit("")), "[\r \n]", "")
    names = F.split(cleaned, "[,，;]")
    stops = F.array(*[F.lit(s) for s in stop_names]) if stop_names else F.array().cast("array<string>")
    kept = F.filter(names, lambda x: (x != "") & ~F.array_contains(stops, x))
    return F.array_distinct(kept)
