"""DuckDB oracle SQL, one statement per registered query.

pre-registered test-table views, independently of the Spark code. Shared
sub-queries (the log stand-in of FIXTURES.md and the tag extractors) are
spliced in as CTE text. DuckDB notes: ``epoch_us(ts) // 1000`` floors like
Spark's ``unix_millis``; lambdas are written ``lambda x: ...``; ``/`` is
floating-point division.
"""

from __future__ import annotations

from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..functions.tags import ARTICLE_ACTIONS, BOT_MARKERS
from ..schemas import GUEST_COLUMNS, LOG_FIELDS, PORTRAIT_COLUMNS
from ..operators.filters import OTHER_TYPE, TYPE_CLASSES
from . import fixtures as fx


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "[" + ", ".join(_q(x) for x in items) + "]"


def _jsplit(x: str, sep: str) -> str:
    """JVM ``split`` of ``x`` on a literal separator: trailing empty pieces
    dropped, input without a separator returned whole."""
    p = f"string_split({x}, '{sep}')"
    trailing = f"coalesce(list_position(list_transform(list_reverse({p}), lambda e: e <> ''), true) - 1, len({p}))"
    return f"(CASE WHEN len({p}) = 1 THEN {p} ELSE list_slice({p}, 1, len({p}) - {trailing}) END)"


AS_OF = fx.AS_OF_MS
OLD_BEFORE = fx.OLD_BEFORE_MS
STOPS = _list(fx.FIXTURE_STOP_NAMES)
MARKERS = _list([m.lower() for m in BOT_MARKERS])
ACTIONS = "(" + ", ".join(_q(a) for a in ARTICLE_ACTIONS) + ")"

LOG = f"""
log AS (
  SELECT e.event_id, e.ts,
    epoch_us(e.ts) // 1000 AS vt_ms,
    CASE WHEN e.user_id % 10 = 0 THEN '' ELSE 'u' || CAST(e.user_id AS VARCHAR) END AS un,
    'g' || CAST(e.user_id AS VARCHAR) AS gki,
    CASE e.event_type WHEN 'view' THEN 'browse' WHEN 'purchase' THEN 'buy' WHEN 'click' THEN 'read'
         WHEN 'signup' THEN 'collect' ELSE 'search' END AS ac,
    CASE e.event_id % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'tushu' ELSE 'journal' END AS ro,
    'R' || CAST(p.p_partkey AS VARCHAR) AS ri,
    p.p_name || '$$$' || replace(p.p_name, ' ', ';') || ',' || p.p_type AS rkd,
    p.p_type AS sw,
    substr(p.p_type, 1, 3) || CAST(p.p_size % 3 AS VARCHAR) || '_' || CAST(p.p_size % 2 AS VARCHAR)
      || ';' || substr(p.p_type, 1, 3) || CAST(p.p_partkey % 3 AS VARCHAR) AS rcc,
    p.p_brand || ';staff' AS au,
    CASE WHEN e.event_id % 10 = 0 THEN 'Mozilla/5.0 (compatible; Googlebot/2.1)'
         ELSE 'Mozilla/5.0 (X11; Linux)' END AS ua
  FROM events e JOIN part p ON TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) = p.p_partkey
),
hlog AS (
  SELECT * FROM log
  WHERE len(list_filter({MARKERS}, lambda m: contains(lower(coalesce(ua, '')), m))) = 0
),
art AS (
  SELECT event_id, regexp_replace(un, '[ "]', '', 'g') AS usr,
         CAST(CASE WHEN ac = 'buy' THEN 2.0 ELSE 1.0 END AS DOUBLE) AS w, vt_ms, rcc, rkd, au
  FROM hlog
  WHERE un <> '' AND ro = 'article' AND coalesce(rcc, '') <> '' AND ac IN {ACTIONS}
),
srch AS (
  SELECT event_id, regexp_replace(un, '[ "]', '', 'g') AS usr,
         CAST(CASE WHEN ac = 'buy' THEN 2.0 ELSE 1.0 END AS DOUBLE) AS w, vt_ms, sw
  FROM hlog
  WHERE un <> '' AND ac = 'search' AND coalesce(sw, '') <> ''
)"""

# Keyword interests: modules = first four characters of ';'-separated codes
# (shorter ones skipped); keywords = rkd without '<', blank, '>', cut on
# '$$$' with JVM split semantics (trailing empty pieces removed), 2 pieces ->
# second, 1 -> it, split on comma/blank/';'/'$', non-empty, lower-cased.
KW = """
kw_parts AS (
  SELECT usr, w, vt_ms,
    list_distinct(list_transform(list_filter(string_split(rcc, ';'), lambda c: length(c) >= 4),
                                 lambda c: substr(c, 1, 4))) AS mods,
    string_split(regexp_replace(coalesce(rkd, ''), '[< >]', '', 'g'), '$$$') AS p
  FROM art
),
kw_cut AS (
  SELECT usr, w, vt_ms, mods, p,
    len(p) - coalesce(list_position(list_transform(list_reverse(p), lambda x: x <> ''), true) - 1,
                      len(p)) AS n
  FROM kw_parts
),
kw_base AS (
  SELECT usr, w, vt_ms, mods,
    list_distinct(list_transform(
      list_filter(regexp_split_to_array(coalesce(CASE WHEN n = 2 THEN p[2] WHEN n = 1 THEN p[1] END, ''),
                                        '[, ;$]'), lambda x: x <> ''),
      lambda x: lower(x))) AS kws
  FROM kw_cut
),
kw_mod AS (SELECT usr, w, vt_ms, unnest(mods) AS module, kws FROM kw_base),
kw_rows AS (SELECT usr, w, vt_ms, module, unnest(kws) AS tag FROM kw_mod)"""

SUBJ = """
subj_rows AS (
  SELECT usr, w, vt_ms, '' AS module, unnest(list_distinct(list_transform(
      list_filter(regexp_split_to_array(rcc, '[, ;]'), lambda c: length(c) >= 4),
      lambda c: substr(c, 1, 4)))) AS tag
  FROM art
)"""

SUBSUBJ = """
subsubj_rows AS (
  SELECT usr, w, vt_ms, '' AS module,
         unnest(list_distinct(list_filter(regexp_split_to_array(rcc, '[, ;]'), lambda c: c <> ''))) AS tag
  FROM art
)"""

AUTH = f"""
auth_rows AS (
  SELECT usr, w, vt_ms, '' AS module,
         unnest(list_distinct(list_filter(
           regexp_split_to_array(regexp_replace(coalesce(au, ''), '[\\r \\n]', '', 'g'), '[,，;]'),
           lambda x: x <> '' AND NOT list_contains({STOPS}, x)))) AS tag
  FROM art
)"""

SEARCH = """
search_rows AS (SELECT usr, w, vt_ms, '' AS module, sw AS tag FROM srch)"""

ROWS = {"kw": KW, "subj": SUBJ, "subsubj": SUBSUBJ, "auth": AUTH, "search": SEARCH}

# Fixed names of the seven portrait dimensions.
DIM_OF = {"subj": "ConcenedSubject", "subsubj": "SubConcenedSubject",
          "kw_total": "SingleArticleTotalInterest", "kw_recent": "SingleArticleRecentInterest",
          "auth_total": "TotalRelatedAuthor", "auth_recent": "RecentRelatedAuthor",
          "search": "SearchKeyword"}


def _with(*parts: str) -> str:
    return "WITH " + ",".join([LOG] + [ROWS[p] for p in parts])


def _log_dim(kind: str) -> str:
    return _with(kind) + f"""
SELECT usr AS "user", module, tag, round(sum(w), 4) AS weight, max(vt_ms) AS last_ms
FROM {kind}_rows WHERE usr <> '' GROUP BY usr, module, tag"""


def _merge_dim(kind: str) -> str:
    """Old portrait (aggregated before the split) plus the new rows, merged."""
    return _with(kind) + f""",
old_p AS (
  SELECT usr, module, tag, sum(w) AS w, max(vt_ms) AS vt_ms
  FROM {kind}_rows WHERE usr <> '' AND vt_ms < {OLD_BEFORE} GROUP BY ALL
),
new_r AS (SELECT usr, module, tag, w, vt_ms FROM {kind}_rows WHERE usr <> '' AND vt_ms >= {OLD_BEFORE})
SELECT usr AS "user", module, tag, round(sum(w), 4) AS weight, max(vt_ms) AS last_ms
FROM (SELECT * FROM old_p UNION ALL SELECT * FROM new_r) GROUP BY usr, module, tag"""


def _factor(days: str, period: int, fraction: float) -> str:
    return f"CASE WHEN {days} > 0 THEN exp(ln({fraction}) / {period} * ({days} % {period})) ELSE 0.9 END"


def _days(ms: str) -> str:
    return f"CAST(trunc(({AS_OF} - {ms}) / 86400000.0) AS BIGINT)"


def _floor_round(x: str) -> str:
    return f"round(CASE WHEN {x} <= 0.001 THEN 0.001 ELSE {x} END, 4)"


ALL_DIM_ROWS = ",".join([KW, SUBJ, SUBSUBJ, AUTH, SEARCH])

# Every tag row of the log in long form (user, dim, module, tag, w, vt_ms).
ALL_TAGS = ALL_DIM_ROWS + """,
tag_rows AS (
  SELECT usr, 'SingleArticleTotalInterest' AS dim, module, tag, w, vt_ms FROM kw_rows
  UNION ALL SELECT usr, 'SingleArticleRecentInterest', module, tag, w, vt_ms FROM kw_rows
  UNION ALL SELECT usr, 'ConcenedSubject', module, tag, w, vt_ms FROM subj_rows
  UNION ALL SELECT usr, 'SubConcenedSubject', module, tag, w, vt_ms FROM subsubj_rows
  UNION ALL SELECT usr, 'TotalRelatedAuthor', module, tag, w, vt_ms FROM auth_rows
  UNION ALL SELECT usr, 'RecentRelatedAuthor', module, tag, w, vt_ms FROM auth_rows
  UNION ALL SELECT usr, 'SearchKeyword', module, tag, w, vt_ms FROM search_rows
),
old_tags AS (
  SELECT usr, dim, module, tag, round(sum(w), 4) AS weight, max(vt_ms) AS last_ms
  FROM tag_rows WHERE usr <> '' AND vt_ms < """ + str(OLD_BEFORE) + """ GROUP BY ALL
),
new_rows AS (
  SELECT usr, dim, module, tag, w AS weight, vt_ms AS last_ms
  FROM tag_rows WHERE usr <> '' AND vt_ms >= """ + str(OLD_BEFORE) + """
)"""

# Decay of the stored portrait (recent interest with pruning at MinWeight
# 0.01 / MinKeywordsCount 10, recent authors re-stamped) plus the new log.
UPDATED = ALL_TAGS + f""",
ri AS (
  SELECT *, {_floor_round('weight * ' + _factor(_days('last_ms'), 30, 0.01))} AS w2
  FROM old_tags WHERE dim = 'SingleArticleRecentInterest'
),
ri_m AS (SELECT usr, module, round(sum(weight), 4) AS mw FROM ri GROUP BY ALL),
ri_h AS (SELECT usr, count(*) FILTER (WHERE w2 >= 0.01) AS h FROM ri GROUP BY usr),
ri_low AS (
  SELECT ri.*, row_number() OVER (PARTITION BY ri.usr
           ORDER BY m.mw ASC, ri.module DESC, ri.weight ASC, ri.tag DESC) AS rn
  FROM ri JOIN ri_m m USING (usr, module) WHERE w2 < 0.01
),
ri_kept AS (
  SELECT usr, dim, module, tag, w2 AS weight, last_ms FROM ri WHERE w2 >= 0.01
  UNION ALL
  SELECT l.usr, l.dim, l.module, l.tag, l.w2, l.last_ms
  FROM ri_low l JOIN ri_h h USING (usr) WHERE l.rn <= 11 - h.h
),
decayed AS (
  SELECT usr, dim, module, tag, weight, last_ms FROM old_tags
  WHERE dim NOT IN ('SingleArticleRecentInterest', 'RecentRelatedAuthor')
  UNION ALL SELECT * FROM ri_kept
  UNION ALL
  SELECT usr, dim, module, tag, {_floor_round('weight * ' + _factor(_days('last_ms'), 30, 0.01))},
         CAST({AS_OF} AS BIGINT)
  FROM old_tags WHERE dim = 'RecentRelatedAuthor'
),
updated AS (
  SELECT usr, dim, module, tag, round(sum(weight), 4) AS weight, max(last_ms) AS last_ms
  FROM (SELECT * FROM decayed UNION ALL SELECT * FROM new_rows) GROUP BY ALL
),
users AS (
  SELECT DISTINCT regexp_replace(un, '[ "]', '', 'g') AS usr FROM hlog
  WHERE un <> '' AND regexp_replace(un, '[ "]', '', 'g') <> ''
)"""


def _json_str(x: str) -> str:
    return f"""'"' || replace(replace({x}, '\\', '\\\\'), '"', '\\"') || '"'"""


def _entry(tag: str, weight: str, last_ms: str) -> str:
    return (f"""{_json_str(tag)} || ':{{"weight":' || CAST(round({weight}, 4) AS VARCHAR) || ',"dateTime":"' """
            f"""|| coalesce(CAST({last_ms} AS VARCHAR), '') || '"}}'""")


def _packed(src: str, mw_src: str) -> str:
    """JSON text per (usr, dim) of a long-form relation ``src``; nested
    modules are ordered by the module totals of ``mw_src``."""
    return f"""
flat_js AS (
  SELECT usr, dim, '{{' || string_agg({_entry('tag', 'weight', 'last_ms')}, ',' ORDER BY weight DESC, tag)
         || '}}' AS js
  FROM {src} WHERE dim NOT IN ('SingleArticleTotalInterest', 'SingleArticleRecentInterest') GROUP BY usr, dim
),
mod_tot AS (SELECT usr, dim, module, round(sum(weight), 4) AS mw FROM {mw_src} GROUP BY ALL),
mod_js AS (
  SELECT s.usr, s.dim, s.module, any_value(t.mw) AS mw,
         {_json_str('s.module')} || ':{{' || string_agg({_entry('s.tag', 's.weight', 's.last_ms')}, ','
             ORDER BY s.weight DESC, s.tag) || '}}' AS js
  FROM {src} s JOIN mod_tot t USING (usr, dim, module)
  WHERE s.dim IN ('SingleArticleTotalInterest', 'SingleArticleRecentInterest') GROUP BY s.usr, s.dim, s.module
),
nested_js AS (
  SELECT usr, dim, '{{' || string_agg(js, ',' ORDER BY mw DESC, module) || '}}' AS js FROM mod_js GROUP BY usr, dim
),
packed AS (SELECT * FROM flat_js UNION ALL SELECT * FROM nested_js),
wide AS (
  SELECT u.usr,
    {", ".join(f"max(CASE WHEN p.dim = '{d}' THEN p.js END) AS {d}" for d in DIM_OF.values())}
  FROM users u LEFT JOIN packed p USING (usr) GROUP BY u.usr
)"""


DIM_COLS = ["ConcenedSubject", "SubConcenedSubject", "SingleArticleTotalInterest",
            "SingleArticleRecentInterest", "TotalRelatedAuthor", "RecentRelatedAuthor", "SearchKeyword"]

# Guest scores of the old log: per (cookie, code) the number of article rows
# listing the code, with the cookie's latest article time.
OLD_GUEST = """
g_all AS (
  SELECT gki, vt_ms, rcc FROM hlog WHERE un = '' AND rcc <> '' AND ro = 'article'
),
g_old_counts AS (
  SELECT gki AS usr, code, CAST(count(*) AS DOUBLE) AS score
  FROM (SELECT gki, unnest(""" + _jsplit('rcc', ';') + """) AS code
        FROM g_all WHERE vt_ms < """ + str(OLD_BEFORE) + """) GROUP BY ALL
),
g_latest AS (SELECT gki AS usr, max(vt_ms) AS latest_ms FROM g_all WHERE vt_ms < """ + str(OLD_BEFORE) + """ GROUP BY ALL),
g_decayed AS (
  SELECT c.usr, c.code, c.score * pow(0.9, CAST(greatest(1, """ + _days("l.latest_ms") + """) AS DOUBLE)) AS score
  FROM g_old_counts c JOIN g_latest l USING (usr)
)"""


def _type_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} IN ({', '.join(_q(s) for s in sp)}) THEN {_q(cls)}"
                     for sp, cls in TYPE_CLASSES)
    return f"CASE {whens} ELSE {_q(OTHER_TYPE)} END"


SPELLINGS = [s for sp, _ in TYPE_CLASSES for s in sp]

ARTICLE_EVENTS = f"""
ev AS (
  SELECT 'F' || CAST(l.l_partkey AS VARCHAR) AS fileName,
         list_value({", ".join(_q(s) for s in SPELLINGS)}, p.p_type)[((l.l_orderkey + l.l_linenumber) % 15) + 1]
           AS dataType
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

ORACLE_SQL: dict[str, str] = {
    "article_ranking": "WITH " + LOG + """
SELECT ri, count(ri) AS visits FROM hlog WHERE ro = 'article' GROUP BY ri ORDER BY visits DESC, ri LIMIT 100""",

    "book_ranking": "WITH " + LOG + """
SELECT ri, count(ri) AS visits FROM hlog WHERE ro = 'tushu' GROUP BY ri ORDER BY visits DESC, ri LIMIT 100""",

    "top_articles_by_type": "WITH " + ARTICLE_EVENTS + f""",
counts AS (
  SELECT fileName, {_type_case('dataType')} AS DataType, count(*) AS BuyCount
  FROM ev WHERE fileName IS NOT NULL AND dataType IS NOT NULL GROUP BY ALL
),
top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY DataType ORDER BY BuyCount DESC, fileName) AS rn
                 FROM counts) WHERE rn <= 100
),
t1 AS (
  SELECT 'F' || CAST(p_partkey AS VARCHAR) AS fileName, min(p_name) AS Title FROM part GROUP BY 1
)
SELECT top.fileName AS FileName, t1.Title, top.DataType, top.BuyCount,
       CAST(0 AS BIGINT) AS BrowseCount, 2018 AS Year
FROM top JOIN t1 ON top.fileName = t1.fileName""",

    "normalize_type": "WITH " + ARTICLE_EVENTS + f"""
SELECT dataType AS spelling, {_type_case('dataType')} AS type_class, count(*) AS n FROM ev GROUP BY ALL""",

    "journal_purchase_stats": f"""
WITH jp AS (
  SELECT CAST(l_partkey AS VARCHAR) AS code, l_linenumber AS times,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS datetime,
         CASE WHEN l_linenumber = 7 THEN '\\N' ELSE l_returnflag END AS album, l_linestatus AS subject
  FROM lineitem
),
r AS (
  SELECT code, album, subject, split_part(datetime, ' ', 1) AS d,
         CASE WHEN times = 2 THEN 12 ELSE times END AS times
  FROM jp WHERE album <> '\\N' AND subject <> '\\N'
)
SELECT code, album AS albumcategory, subject AS subjectcategory, '' AS subjectsubcategory,
       TRY_CAST(string_split(d, '-')[1] AS INTEGER) AS year, TRY_CAST(string_split(d, '-')[2] AS INTEGER) AS month,
       d AS datadate, CAST(0 AS BIGINT) AS browsecount, CAST(sum(times) AS BIGINT) AS buycount,
       {_q(fx.AS_OF_TEXT)} AS createon
FROM r WHERE len(string_split(d, '-')) >= 3
GROUP BY code, album, subject, year, month, d""",

    "ua_daily_counts": "WITH " + LOG + """,
lines AS (
  SELECT concat_ws(' ', strftime(ts, '%Y-%m-%d'), strftime(ts, '%H:%M:%S'), '10.0.0.1', 'GET', '/' || ri, '-', '80',
                   CASE WHEN un = '' THEN '-' ELSE un END, gki, replace(ua, ' ', '+'), '-', '200', '0', '0', '15') AS v
  FROM log
),
f AS (SELECT string_split(v, ' ') AS a FROM lines)
SELECT a[1] AS date, a[10] AS userAgent, CAST(count(*) AS INTEGER) AS count
FROM f WHERE len(a) >= 15 AND a[1] <> '' AND NOT contains(a[1], 'Fields') AND a[10] <> '-'
GROUP BY 1, 2""",

    "user_category_tags": """
WITH pc AS (
  SELECT 'c' || CAST(o.o_custkey AS VARCHAR) AS usr, CAST(trunc(l.l_quantity) AS INTEGER) AS cnt, p.p_brand AS category
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
),
s AS (SELECT usr, category, sum(cnt) AS n FROM pc WHERE cnt >= 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY usr ORDER BY n DESC, category) AS rk FROM s)
SELECT usr AS UserName, string_agg(category, ';' ORDER BY rk) AS JournalsInterests
FROM r WHERE rk <= 10 GROUP BY usr""",

    "bot_filter": "WITH " + LOG + """
SELECT event_id, un, ua FROM hlog""",

    "log_quality_counts": "WITH " + LOG + f""",
h AS (SELECT *, len(list_filter({MARKERS}, lambda m: contains(lower(coalesce(ua, '')), m))) = 0 AS human FROM log)
SELECT count(*) AS raw_rows, CAST(count(*) FILTER (WHERE human) AS BIGINT) AS human_rows,
       CAST(count(*) FILTER (WHERE human AND un <> '') AS BIGINT) AS registered_rows,
       CAST(count(*) FILTER (WHERE human AND un = '' AND rcc <> '') AS BIGINT) AS guest_rows
FROM h""",

    "distinct_users": "WITH " + LOG + """
SELECT DISTINCT regexp_replace(coalesce(un, ''), '[ "]', '', 'g') AS "user" FROM hlog
WHERE regexp_replace(coalesce(un, ''), '[ "]', '', 'g') <> ''""",

    "log_keyword_interests": _log_dim("kw"),
    "log_subjects": _log_dim("subj"),
    "log_subsubjects": _log_dim("subsubj"),
    "log_authors": _log_dim("auth"),
    "log_search_words": _log_dim("search"),

    "decay_factor": "WITH " + LOG + f""",
d AS (SELECT {_days('vt_ms')} AS days FROM log)
SELECT days, count(*) AS n, round({_factor('days', 30, 0.01)}, 10) AS f30,
       round({_factor('days', 60, 0.5)}, 10) AS f60
FROM d GROUP BY days""",

    # Prune check: threshold 0.1, 1% left after one 30-day period.
    "decay_recent_interest": _with("kw") + f""",
old AS (
  SELECT usr, module, tag, sum(w) AS weight, max(vt_ms) AS last_ms
  FROM kw_rows WHERE usr <> '' AND vt_ms < {OLD_BEFORE} GROUP BY ALL
),
d AS (SELECT *, {_floor_round('weight * ' + _factor(_days('last_ms'), 30, 0.01))} AS w2 FROM old),
m AS (SELECT usr, module, round(sum(weight), 4) AS mw FROM old GROUP BY ALL),
h AS (SELECT usr, count(*) FILTER (WHERE w2 >= 0.1) AS h FROM d GROUP BY usr),
low AS (
  SELECT d.*, row_number() OVER (PARTITION BY d.usr ORDER BY m.mw ASC, d.module DESC, d.weight ASC, d.tag DESC) AS rn
  FROM d JOIN m USING (usr, module) WHERE w2 < 0.1
),
kept AS (
  SELECT usr, module, tag, w2, last_ms FROM d WHERE w2 >= 0.1
  UNION ALL
  SELECT low.usr, low.module, low.tag, low.w2, low.last_ms FROM low JOIN h USING (usr) WHERE low.rn <= 11 - h.h
)
SELECT usr AS "user", module, tag, round(w2, 4) AS weight, last_ms FROM kept""",

    "decay_recent_author": _with("auth") + f""",
old AS (
  SELECT usr, module, tag, sum(w) AS weight, max(vt_ms) AS last_ms
  FROM auth_rows WHERE usr <> '' AND vt_ms < {OLD_BEFORE} GROUP BY ALL
)
SELECT usr AS "user", module, tag,
       round({_floor_round('weight * ' + _factor(_days('last_ms'), 30, 0.01))}, 4) AS weight,
       CAST({AS_OF} AS BIGINT) AS last_ms
FROM old""",

    "decay_guest_flat": "WITH " + LOG + "," + OLD_GUEST + """
SELECT usr AS "user", code, round(score, 6) AS score FROM g_decayed WHERE score >= 0.01""",

    "decay_guest_nested": _with("kw") + f""",
old AS (
  SELECT usr, module, tag, sum(w) AS weight, max(vt_ms) AS last_ms
  FROM kw_rows WHERE usr <> '' AND vt_ms < {OLD_BEFORE} GROUP BY ALL
),
lt AS (SELECT usr, max(last_ms) AS latest_ms FROM old GROUP BY usr),
d AS (
  SELECT o.usr, o.module, o.tag,
         round(o.weight * pow(0.9, CAST(greatest(1, {_days('lt.latest_ms')}) AS DOUBLE)), 4) AS weight, o.last_ms
  FROM old o JOIN lt USING (usr)
)
SELECT usr AS "user", module, tag, round(weight, 4) AS weight, last_ms FROM d WHERE weight >= 0.01""",

    "portrait_interest_merge": _merge_dim("kw"),
    "portrait_subject_merge": _merge_dim("subj"),
    "portrait_subsubject_merge": _merge_dim("subsubj"),
    "portrait_author_merge": _merge_dim("auth"),
    "portrait_search_merge": _merge_dim("search"),

    "new_users": "WITH " + LOG + f""",
u AS (SELECT regexp_replace(un, '[ "]', '', 'g') AS usr, vt_ms FROM hlog)
SELECT DISTINCT usr AS "user" FROM u WHERE usr <> '' AND vt_ms >= {OLD_BEFORE}
  AND usr NOT IN (SELECT usr FROM u WHERE usr <> '' AND vt_ms < {fx.KNOWN_BEFORE_MS})""",

    "new_guests": "WITH " + LOG + f""",
g AS (SELECT gki, vt_ms FROM hlog WHERE un = '' AND rcc <> '' AND coalesce(gki, '') <> '')
SELECT DISTINCT gki AS "user" FROM g WHERE vt_ms >= {OLD_BEFORE}
  AND gki NOT IN (SELECT gki FROM g WHERE vt_ms < {fx.KNOWN_BEFORE_MS})""",

    "portrait_update": "WITH " + LOG + "," + UPDATED + """
SELECT usr AS "user", dim, module, tag, round(weight, 4) AS weight, last_ms FROM updated""",

    "portrait_wide": "WITH " + LOG + "," + UPDATED + "," + _packed("updated", "updated") + f"""
SELECT usr AS UserName, '' AS LawOfworkAndRest, '' AS Area, 0 AS Age, 0 AS Gender,
  {", ".join(f"coalesce({d}, '{{}}') AS {d}" for d in DIM_COLS)},
  '{{}}' AS JournalsInterests, '{{}}' AS ReferenceBookInterests, '{{}}' AS CustomerPurchasingPowerInterests,
  {_q(fx.AS_OF_TEXT)} AS latest_log_time
FROM wide""",

    "serving_portrait": "WITH " + LOG + "," + UPDATED + """,
flat_top AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY usr, dim ORDER BY weight DESC, tag) AS rn
                 FROM updated WHERE dim NOT IN ('SingleArticleTotalInterest', 'SingleArticleRecentInterest'))
  WHERE rn <= 3
),
mods AS (
  SELECT * FROM (SELECT usr, dim, module, row_number() OVER (PARTITION BY usr, dim ORDER BY mw DESC, module) AS rn
                 FROM (SELECT usr, dim, module, round(sum(weight), 4) AS mw FROM updated
                       WHERE dim IN ('SingleArticleTotalInterest', 'SingleArticleRecentInterest') GROUP BY ALL))
  WHERE rn <= 3
),
nested_top AS (
  SELECT t.* FROM (SELECT *, row_number() OVER (PARTITION BY usr, dim, module ORDER BY weight DESC, tag) AS rn
                   FROM updated WHERE dim IN ('SingleArticleTotalInterest', 'SingleArticleRecentInterest')) t
  JOIN mods m USING (usr, dim, module) WHERE t.rn <= 3
),
cut AS (
  SELECT usr, dim, module, tag, weight, last_ms FROM flat_top
  UNION ALL SELECT usr, dim, module, tag, weight, last_ms FROM nested_top
),""" + _packed("cut", "updated") + f"""
SELECT usr AS UserName, '' AS LawOfworkAndRest, '' AS Area, 0 AS Age, 0 AS Gender,
  {", ".join(f"coalesce({d}, '{{}}') AS {d}" for d in DIM_COLS)},
  '' AS JournalsInterests, '' AS ReferenceBookInterests, '' AS CustomerPurchasingPowerInterests,
  CASE WHEN {" OR ".join(f"{d} IS NOT NULL" for d in DIM_COLS)} THEN 1 ELSE 0 END AS hasPortrait,
  {_q(fx.AS_OF_TEXT)} AS latest_log_time
FROM wide""",

    "guest_portrait": "WITH " + LOG + "," + OLD_GUEST + f""",
fresh AS (
  SELECT gki AS usr, code, CAST(count(*) AS DOUBLE) AS score
  FROM (SELECT gki, unnest({_jsplit('rcc', ';')}) AS code
        FROM g_all WHERE vt_ms >= {OLD_BEFORE}) GROUP BY ALL
),
u AS (SELECT usr, code, score FROM g_decayed WHERE score >= 0.01 UNION ALL SELECT * FROM fresh)
SELECT usr AS "user", code, round(sum(score), 6) AS score FROM u GROUP BY usr, code""",

    "legacy_keyword_portrait": "WITH " + LOG + f""",
a AS (
  SELECT regexp_replace(un, '[ "]', '', 'g') AS usr,
         {_jsplit('rcc', ';')} AS codes,
         list_distinct(list_filter(regexp_split_to_array(regexp_replace(coalesce(rkd, ''), '[< >]', '', 'g'),
                                                         '[, ;$]'), lambda x: x <> '')) AS kws
  FROM hlog
  WHERE un <> '' AND ro = 'article' AND coalesce(rcc, '') <> '' AND ac IN {ACTIONS}
),
m AS (SELECT usr, unnest(codes) AS module, kws FROM a),
t AS (SELECT usr, module, unnest(kws) AS tag FROM m)
SELECT usr AS "user", module, tag, CAST(count(*) AS DOUBLE) AS weight FROM t WHERE usr <> '' GROUP BY ALL""",

    "initial_roster": "WITH " + LOG + """,
names AS (
  SELECT c_name AS name FROM customer
  UNION ALL SELECT s_name FROM supplier
  UNION ALL SELECT un FROM log
),
d AS (SELECT DISTINCT name FROM names WHERE trim(name) <> '')
SELECT CAST(row_number() OVER (ORDER BY name) - 1 AS BIGINT) AS UserID, name AS UserName, 0 AS Age, 0 AS Gender,
       '' AS SingleArticleInterest, '' AS latest_log_time
FROM d""",
}


# TF-IDF over whole documents: tokens = runs of letters, marks and digits of the
# lower-cased text, Han characters one by one; idf = ln((N + 1) / (df + 1)); ties by term.
TOKENS = r"""regexp_split_to_array(regexp_replace(lower(coalesce(text, '')), '(\p{Han})', ' \1 ', 'g'),
                                    '[^\p{L}\p{M}\p{N}]+')"""
TFIDF = f"""
toks AS (
  SELECT doc_id, unnest(list_filter({TOKENS}, lambda t: t <> '')) AS term
  FROM documents
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
sc AS (
  SELECT tf.doc_id, tf.term, tf.tf * ln((n.n + 1.0) / (df.df + 1.0)) AS score
  FROM tf JOIN df USING (term) CROSS JOIN n
),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS rank FROM sc)"""

ORACLE_SQL["tfidf_keywords"] = "WITH " + TFIDF + """
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, round(score, 6) AS score FROM rk WHERE rank <= 25"""

ORACLE_SQL["catalog_keywords"] = "WITH " + TFIDF + f"""
SELECT rk.doc_id, d.source AS class,
       '{{' || {_json_str('d.source')} || ':{{' ||
       string_agg({_json_str('rk.term')} || ':' || printf('%.4f', round(rk.score, 4)), ',' ORDER BY rk.rank)
       || '}}}}' AS keywords
FROM rk JOIN documents d USING (doc_id) WHERE rk.rank <= 10 GROUP BY rk.doc_id, d.source"""


# The 20 log fields as text, from a log relation with the fixture's columns.
_FIELD_EXPR = {"vt": "CAST(vt_ms AS VARCHAR)", "un": "un", "gki": "gki", "ac": "ac", "ro": "ro", "ri": "ri",
               "rkd": "rkd", "sw": "sw", "ua": "ua", "rcc": "rcc", "au": "au"}
FIELDS = ", ".join(f"{_FIELD_EXPR.get(f, chr(39) * 2)} AS {f}" for f in LOG_FIELDS)

# Raw lines whose vt millisecond is below 40 are broken (no marker, or a
# truncated JSON object) and rejected by the reader.
ORACLE_SQL["parse_raw_log"] = "WITH " + LOG + f"""
SELECT {FIELDS} FROM log WHERE vt_ms % 1000 >= 40"""

ORACLE_SQL["format_user_log"] = "WITH " + LOG + f"""
SELECT {FIELDS} FROM hlog WHERE vt_ms % 1000 >= 40"""

ORACLE_SQL["read_portrait_text"] = ORACLE_SQL["portrait_wide"]

GUEST_WIDE = "WITH " + LOG + "," + OLD_GUEST + f""",
fresh AS (
  SELECT gki AS usr, code, CAST(count(*) AS DOUBLE) AS score
  FROM (SELECT gki, unnest({_jsplit('rcc', ';')}) AS code
        FROM g_all WHERE vt_ms >= {OLD_BEFORE}) GROUP BY ALL
),
u AS (SELECT usr, code, score FROM g_decayed WHERE score >= 0.01 UNION ALL SELECT * FROM fresh),
gp AS (SELECT usr, code, round(sum(score), 4) AS score FROM u GROUP BY usr, code),
gj AS (
  SELECT usr, '{{' || string_agg({_json_str('code')} || ':' || CAST(score AS VARCHAR), ','
                                 ORDER BY score DESC, code) || '}}' AS js
  FROM gp GROUP BY usr
)"""

ORACLE_SQL["read_guest_portrait"] = GUEST_WIDE + f"""
SELECT TRY_CAST(substr(usr, 2) AS BIGINT) AS UserID, usr AS UserName, '' AS LawOfworkAndRest, '' AS Area,
       0 AS Age, 0 AS Gender, js AS SingleArticleInterest,
       {", ".join(f"'{{}}' AS {c}" for c in GUEST_COLUMNS[7:13])},
       {_q(fx.AS_OF_TEXT)} AS latest_log_time
FROM gj"""

ORACLE_SQL["portrait_reproject"] = GUEST_WIDE + f"""
SELECT usr AS UserName, '' AS LawOfworkAndRest, '' AS Area, 0 AS Age, 0 AS Gender,
       {", ".join(f"'{{}}' AS {c}" for c in PORTRAIT_COLUMNS[5:15])},
       {_q(fx.AS_OF_TEXT)} AS latest_log_time
FROM gj"""

_QUALS = ["ac", "ci", "dt", "gki", "rcc", "rkd", "ri", "sw", "ua", "un", "vt"]
CELLS = f""",
full_log AS (SELECT {FIELDS} FROM hlog),
keyed AS (
  SELECT md5(concat_ws(chr(1), {", ".join(LOG_FIELDS)})) || '-' || vt AS row_key, * FROM full_log
),
cells AS (
  SELECT row_key, 'cf1' AS family, c.qualifier, c.value
  FROM (SELECT row_key, unnest([{", ".join(f"struct_pack(qualifier := '{q}', value := {q})" for q in _QUALS)}]) AS c
        FROM keyed)
)"""

ORACLE_SQL["log_to_cells"] = "WITH " + LOG + CELLS + """
SELECT row_key, family, qualifier, value FROM cells"""

ORACLE_SQL["customer_cells"] = """
SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'info' AS family, c.qualifier, c.value
FROM (SELECT c_custkey, unnest([
  struct_pack(qualifier := 'c_name', value := CAST(c_name AS VARCHAR)),
  struct_pack(qualifier := 'c_mktsegment', value := CAST(c_mktsegment AS VARCHAR)),
  struct_pack(qualifier := 'c_nationkey', value := CAST(c_nationkey AS VARCHAR))]) AS c FROM customer)"""

ORACLE_SQL["cell_range_scan"] = "WITH " + LOG + CELLS + f"""
SELECT row_key, {", ".join(f"max(CASE WHEN qualifier = '{q}' THEN value END) AS {q}" for q in _QUALS)}
FROM cells WHERE row_key >= '4' AND row_key < '8' GROUP BY row_key"""

ORACLE_SQL["key_pattern_scan"] = "WITH " + LOG + """
SELECT replace(ua, ' ', '+') AS key, CAST(count(*) AS VARCHAR) AS value FROM log GROUP BY 1
HAVING replace(ua, ' ', '+') LIKE 'Mozilla/5.0+%'"""

ORACLE_SQL["publish_location"] = "WITH " + LOG + f"""
SELECT ri, count(ri) AS visits FROM hlog WHERE ro = 'article' AND vt_ms >= {OLD_BEFORE}
GROUP BY ri ORDER BY visits DESC, ri LIMIT 100"""


ORACLE_SQL["content_match"] = _with("kw") + f""",
old_p AS (
  SELECT usr, module, tag, round(sum(w), 4) AS weight
  FROM kw_rows WHERE usr <> '' AND vt_ms < {OLD_BEFORE} GROUP BY ALL
),
pairs AS (SELECT DISTINCT usr, ri FROM art a JOIN hlog h USING (event_id) WHERE h.vt_ms >= {OLD_BEFORE}),
items AS (SELECT DISTINCT ri, rcc, rkd FROM hlog),
it_parts AS (
  SELECT ri,
    list_distinct(list_transform(list_filter(string_split(rcc, ';'), lambda c: length(c) >= 4),
                                 lambda c: substr(c, 1, 4))) AS mods,
    string_split(regexp_replace(coalesce(rkd, ''), '[< >]', '', 'g'), '$$$') AS p
  FROM items
),
it_cut AS (
  SELECT ri, mods, p,
    len(p) - coalesce(list_position(list_transform(list_reverse(p), lambda x: x <> ''), true) - 1, len(p)) AS n
  FROM it_parts
),
it_kw AS (
  SELECT ri, mods, list_distinct(list_transform(list_filter(regexp_split_to_array(
      coalesce(CASE WHEN n = 2 THEN p[2] WHEN n = 1 THEN p[1] END, ''), '[, ;$]'), lambda x: x <> ''),
      lambda x: lower(x))) AS kws
  FROM it_cut
),
it_m AS (SELECT ri, unnest(mods) AS module, kws FROM it_kw),
it AS (SELECT DISTINCT ri, module, unnest(kws) AS tag FROM it_m)
SELECT p.usr AS "user", p.ri AS item, round(sum(o.weight * 1.0), 4) AS score
FROM pairs p JOIN it ON p.ri = it.ri JOIN old_p o ON o.usr = p.usr AND o.module = it.module AND o.tag = it.tag
GROUP BY p.usr, p.ri"""

ORACLE_SQL["content_recommend"] = f"""
WITH m AS ({ORACLE_SQL["content_match"]}),
{LOG.strip().rstrip(",")},
seen AS (SELECT DISTINCT regexp_replace(un, '[ "]', '', 'g') AS usr, ri FROM hlog
         WHERE un <> '' AND vt_ms < {OLD_BEFORE} AND ro = 'article' AND coalesce(rcc, '') <> '' AND ac IN ({", ".join(_q(a) for a in ARTICLE_ACTIONS)})),
bought AS (SELECT DISTINCT regexp_replace(un, '[ "]', '', 'g') AS usr, ri FROM hlog
           WHERE un <> '' AND vt_ms >= {OLD_BEFORE} AND ac = 'buy'),
p AS (SELECT m."user" AS u, m.item AS i, m.score AS s FROM m),
r AS (
  SELECT u, i, s, CAST(row_number() OVER (PARTITION BY u ORDER BY s DESC, i) AS INTEGER) AS rank
  FROM p LEFT JOIN seen ON seen.usr = u AND seen.ri = i LEFT JOIN bought ON bought.usr = u AND bought.ri = i
  WHERE s > 0 AND seen.usr IS NULL AND bought.usr IS NULL)
SELECT u AS "user", rank, i AS item, s AS score FROM r WHERE rank <= 10"""

# every (user, item) pair that shares a keyword, scored; then the rank cut
_ITEM_TAGS = ORACLE_SQL["content_match"]
_ITEM_TAGS = _ITEM_TAGS[:_ITEM_TAGS.index("pairs AS")] + _ITEM_TAGS[_ITEM_TAGS.index("items AS"):_ITEM_TAGS.index("SELECT p.usr")]
ORACLE_SQL["content_catalogue"] = _ITEM_TAGS + f""",
p AS (SELECT o.usr AS u, it.ri AS i, round(sum(o.weight), 4) AS s
      FROM old_p o JOIN it ON o.module = it.module AND o.tag = it.tag GROUP BY ALL),
seen AS (SELECT DISTINCT regexp_replace(un, '[ "]', '', 'g') AS usr, ri FROM hlog
         WHERE un <> '' AND vt_ms < {OLD_BEFORE} AND ro = 'article' AND coalesce(rcc, '') <> '' AND ac IN ({", ".join(_q(a) for a in ARTICLE_ACTIONS)})),
bought AS (SELECT DISTINCT regexp_replace(un, '[ "]', '', 'g') AS usr, ri FROM hlog
           WHERE un <> '' AND vt_ms >= {OLD_BEFORE} AND ac = 'buy'),
r AS (
  SELECT u, i, s, CAST(row_number() OVER (PARTITION BY u ORDER BY s DESC, i) AS INTEGER) AS rank
  FROM p LEFT JOIN seen ON seen.usr = u AND seen.ri = i LEFT JOIN bought ON bought.usr = u AND bought.ri = i
  WHERE s > 0 AND seen.usr IS NULL AND bought.usr IS NULL)
SELECT u AS "user", rank, i AS item, s AS score FROM r WHERE rank <= 10"""

ORACLE_SQL["portrait_fold"] = ORACLE_SQL["portrait_update"]

ORACLE_SQL["file_keywords"] = """WITH files AS (
  SELECT coalesce(source, 'none') AS doc_id, string_agg(coalesce(text, ''), chr(10)) AS text FROM documents GROUP BY 1), """ + TFIDF.replace(
    "FROM documents", "FROM files") + """
SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, round(score, 6) AS score FROM rk WHERE rank <= 25"""

ORACLE_SQL["read_ratings"] = """
WITH r AS (SELECT event_id, CAST(user_id AS INTEGER) AS user_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id,
                  CAST(value AS FLOAT) AS rating FROM events)
SELECT user_id, item_id, round(CAST(rating AS DOUBLE), 4) AS rating
FROM r WHERE item_id IS NOT NULL AND rating IS NOT NULL AND event_id % 50 <> 0"""

ORACLE_SQL["publish_partitioned"] = "WITH " + LOG + f"""
SELECT CASE WHEN ro = 'article' THEN '01' WHEN ro = 'tushu' THEN CASE WHEN ac = 'buy' THEN 'a b:c' ELSE 'x=y' END END AS label,
       ri, count(*) AS visits
FROM hlog WHERE vt_ms >= {OLD_BEFORE} GROUP BY ALL"""


def _similar(vectors: str) -> str:
    """Every pair of items (id, v) scored, the ten best of each."""
    return f"""
WITH v AS ({vectors}),
n AS (SELECT id, v, sqrt(list_dot_product(v, v)) AS n FROM v),
s AS (SELECT a.id, b.id AS other, round(list_dot_product(a.v, b.v) / (a.n * b.n + 1), 6) AS score
      FROM n a JOIN n b ON a.id <> b.id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS INTEGER) AS rank FROM s)
SELECT id, rank, other, score FROM r WHERE rank <= 10"""


ORACLE_SQL["similar_items"] = _similar("SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL")
ORACLE_SQL["similar_parts"] = _similar("""
  SELECT l_partkey AS id, [round(count(*) / 10.0 - 3, 6), round(sum(CAST(l_quantity AS DOUBLE)) / count(*) - 25, 6),
                           round(sum(CAST(l_discount * 100 AS DOUBLE)) / count(*) - 5, 6)] AS v
  FROM lineitem GROUP BY l_partkey""")

ORACLE_SQL["read_catalogue"] = "WITH odd AS (SELECT * FROM documents WHERE doc_id % 2 = 1), " + TFIDF.replace(
    "FROM documents", "FROM odd") + """
SELECT CAST(doc_id AS VARCHAR) AS id, source AS class, lang AS keyword, round((n_chars % 100) / 100.0, 4) AS score
FROM documents WHERE doc_id % 2 = 0
UNION ALL
SELECT CAST(rk.doc_id AS VARCHAR), d.source, rk.term, round(rk.score, 4)
FROM rk JOIN documents d ON d.doc_id = rk.doc_id WHERE rank <= 10"""

ORACLE_SQL["ua_daily_export"] = ORACLE_SQL["ua_daily_counts"]


def _count_tfidf_sql(vocab_size: int = 5, stop_words=ENGLISH_STOP_WORDS) -> str:
    stops = _list(list(stop_words))
    return f"""
WITH toks AS (
  SELECT doc_id, unnest(list_filter({TOKENS}, lambda t: t <> '' AND NOT list_contains({stops}, t))) AS term
  FROM documents
),
cnt AS (SELECT term, count(*) AS c FROM toks GROUP BY term),
vocab AS (
  SELECT term, idx FROM (SELECT term, row_number() OVER (ORDER BY c DESC, term) AS idx FROM cnt)
  WHERE idx <= {vocab_size}
),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term IN (SELECT term FROM vocab) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM documents),
grid AS (SELECT d.doc_id, v.term, v.idx FROM documents d CROSS JOIN vocab v)
SELECT g.doc_id,
       list(round(coalesce(tf.tf, 0) * ln((n.n + 1.0) / (coalesce(df.df, 0) + 1.0)), 6) ORDER BY g.idx) AS features
FROM grid g LEFT JOIN tf ON tf.doc_id = g.doc_id AND tf.term = g.term
LEFT JOIN df ON df.term = g.term CROSS JOIN n
GROUP BY g.doc_id"""


ORACLE_SQL["count_tfidf"] = _count_tfidf_sql(5)

ORACLE_SQL["read_related_authors"] = (
    "SELECT UserName, TotalRelatedAuthor, RecentRelatedAuthor FROM (" + ORACLE_SQL["portrait_wide"] + ")")

ORACLE_SQL["read_preference_portrait"] = _with("kw") + f"""
SELECT usr AS id, module, tag AS keyword, round(sum(w), 4) AS score
FROM kw_rows WHERE usr <> '' AND vt_ms < {OLD_BEFORE} GROUP BY usr, module, tag"""

ORACLE_SQL["read_raw_catalogue"] = """
WITH l AS (
  SELECT concat_ws('::', CAST(doc_id AS VARCHAR), lang, concat_ws('/', lang, source),
                   regexp_replace(coalesce(text, ''), '[\r\n]', ' ', 'g'), 'a', 'b', source,
                   CAST(n_chars AS VARCHAR)) AS line
  FROM documents
),
p AS (SELECT string_split(line, '::') AS f FROM l),
c AS (
  SELECT f, len(f) - coalesce(list_position(list_transform(list_reverse(f), lambda x: x <> ''), true) - 1,
                              len(f)) AS n
  FROM p
)
SELECT f[1] AS id, replace(f[3], '&', '') AS title, replace(f[4], '&', '') AS content, f[7] AS class
FROM c WHERE n >= 7"""
