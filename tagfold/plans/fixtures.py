"""Stand-ins for the reference inputs, derived by Spark from the test tables.

Each function is a pure DataFrame derivation (no driver-side data), so its work
grows with the tables. The mapping follows FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import LOG_FIELDS
from ..session import materialized
from ..sources.tables import load
from ..operators.filters import TYPE_CLASSES

# Fixed values of the fixture: split point between the "old portrait" rows and
# "the new log", and the clock of every portrait run (2024-02-01T00:00:00Z).
OLD_BEFORE_MS = 1705363200000     # 2024-01-16T00:00:00Z
OLD_BEFORE_DAY = 20240116         # its day partition (yyyyMMdd)
AS_OF_MS = 1706745600000          # 2024-02-01T00:00:00Z
AS_OF_TEXT = "2024-02-01 00:00:00"
# The author stop list used with this fixture (its logs carry 'staff' bylines).
FIXTURE_STOP_NAMES = ["staff"]


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The formatted behaviour log as a parquet table partitioned by day
    (``log_day``), written once per application from :func:`derive_log`
    (the reference's log-formatting job likewise writes parquet that every
    later job reads)."""
    return materialized(spark, f"log:{sf_dir}", lambda: derive_log(spark, sf_dir), ["log_day"])


def derive_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour log: events joined to the part they touch.

    Columns: the 20 string fields plus ``event_id``, typed ``vt_ms`` and the
    UTC day ``log_day`` (int yyyyMMdd). ``part`` is a dimension table; the planner
    broadcasts it only while its size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge
    join beyond it.
    """
    e = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    j = e.join(p, k == p["p_partkey"])  # events without a part touch no resource
    vt_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    def s(c):
        return (F.col(c) if isinstance(c, str) else c).cast("string")
    cols = {
        "vt": vt_ms.cast("string"),
        "un": F.when(F.col("user_id") % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("u"), s("user_id"))),
        "gki": F.concat(F.lit("g"), s("user_id")),
        "ac": (F.when(F.col("event_type") == "view", "browse")
               .when(F.col("event_type") == "purchase", "buy")
               .when(F.col("event_type") == "click", "read")
               .when(F.col("event_type") == "signup", "collect")
               .otherwise("search")),
        "ro": (F.when(F.col("event_id") % 3 == 0, "article")
               .when(F.col("event_id") % 3 == 1, "tushu").otherwise("journal")),
        "ri": F.concat(F.lit("R"), s("p_partkey")),
        "rkd": F.concat(F.col("p_name"), F.lit("$$$"), F.replace(F.col("p_name"), F.lit(" "), F.lit(";")),
                        F.lit(","), F.col("p_type")),
        "sw": F.col("p_type"),
        "rcc": F.concat(F.substring("p_type", 1, 3), s(F.col("p_size") % 3), F.lit("_"),
                        s(F.col("p_size") % 2), F.lit(";"), F.substring("p_type", 1, 3),
                        s(F.col("p_partkey") % 3)),
        "au": F.concat(F.col("p_brand"), F.lit(";staff")),
        "ua": F.when(F.col("event_id") % 10 == 0, F.lit("Mozilla/5.0 (compatible; Googlebot/2.1)"))
               .otherwise(F.lit("Mozilla/5.0 (X11; Linux)")),
    }
    out = [F.col("event_id")]
    for f in LOG_FIELDS:
        out.append((cols[f] if f in cols else F.lit("")).alias(f))
    out.append(vt_ms.alias("vt_ms"))
    out.append(F.date_format(F.col("ts"), "yyyyMMdd").cast("int").alias("log_day"))
    return j.select(*out)


# Noon of the log's first day: what a portrait stored then knows. Later users
# and guests are new to it.
KNOWN_BEFORE_MS = 1_704_110_400_000


def known_log(log_df: DataFrame) -> DataFrame:
    """Rows of the log's first half day."""
    return log_df.where((F.col("log_day") <= 20240101) & (F.col("vt_ms") < F.lit(KNOWN_BEFORE_MS)))


def old_log(log_df: DataFrame) -> DataFrame:
    """Rows before the split (the day predicate prunes partitions)."""
    return log_df.where((F.col("log_day") <= F.lit(OLD_BEFORE_DAY))
                        & (F.col("vt_ms") < F.lit(OLD_BEFORE_MS)))


def new_log(log_df: DataFrame) -> DataFrame:
    return log_df.where((F.col("log_day") >= F.lit(OLD_BEFORE_DAY))
                        & (F.col("vt_ms") >= F.lit(OLD_BEFORE_MS)))


def journal_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 stand-in: (code, times, datetime, album, subject) from lineitem."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus")
    return li.select(
        F.col("l_partkey").cast("string").alias("code"),
        F.col("l_linenumber").cast("int").alias("times"),
        F.date_format(F.col("l_shipdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("datetime"),
        # the null marker of the text exports in a seventh of the lines
        F.when(F.col("l_linenumber") == 7, F.lit("\\N")).otherwise(F.col("l_returnflag")).alias("album"),
        F.col("l_linestatus").alias("subject"),
    )


def type_spellings():
    """The 14 known spellings in table order, then two unknown ones."""
    known = [s for spellings, _ in TYPE_CLASSES for s in spellings]
    return known


def article_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 stand-in: (fileName, dataType) per lineitem row. The spelling is
    picked from the 14 known spellings plus the part type (an unknown one) by
    ``(l_orderkey + l_linenumber) mod 15``."""
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    choices = F.array(*[F.lit(s) for s in type_spellings()], F.col("p_type"))
    idx = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(15)).cast("int")
    return j.select(F.concat(F.lit("F"), F.col("l_partkey").cast("string")).alias("fileName"),
                    F.get(choices, idx).alias("dataType"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 stand-in: (fileName, title) from part."""
    p = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    return p.select(F.concat(F.lit("F"), F.col("p_partkey").cast("string")).alias("fileName"),
                    F.col("p_name").alias("title"))


def category_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 stand-in: (user, count, category) from orders x lineitem x part."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    return j.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user"),
                    F.col("l_quantity").cast("int").alias("count"),
                    F.col("p_brand").alias("category"))


def web_log_lines(log_df: DataFrame) -> DataFrame:
    """S12 stand-in: W3C-style blank-separated lines (15 fields, agent in
    field 9 with blanks encoded as '+') derived from the log."""
    ts = F.timestamp_millis(F.col("vt_ms"))
    fields = [F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss"), F.lit("10.0.0.1"),
              F.lit("GET"), F.concat(F.lit("/"), F.col("ri")), F.lit("-"), F.lit("80"),
              F.when(F.col("un") == "", F.lit("-")).otherwise(F.col("un")), F.col("gki"),
              F.replace(F.col("ua"), F.lit(" "), F.lit("+")), F.lit("-"), F.lit("200"),
              F.lit("0"), F.lit("0"), F.lit("15")]
    return log_df.select(F.concat_ws(" ", *fields).alias("value"))


# Fixed values of the raw-log fixture: the text before "<digit>] " and the
# shares of deliberately broken lines (chosen by the millisecond of vt).
RAW_PREFIX = "2024-01-01 00:00:00 [INFO 1] "


def raw_log_lines(log_df: DataFrame) -> DataFrame:
    """S2 stand-in: one text line per log row, ``RAW_PREFIX + JSON``; empty
    fields are left out of the JSON (missing keys). Rows whose ``vt``
    millisecond is below 20 lose the ``digit] `` marker and rows in [20, 40)
    carry a truncated JSON object, so both rejection paths are exercised."""
    rec = F.struct(*[F.when(F.col(f) != "", F.col(f)).alias(f) for f in LOG_FIELDS])
    js = F.to_json(rec)
    ms = F.col("vt_ms") % 1000
    line = (F.when(ms < 20, F.concat(F.lit("2024-01-01 00:00:00 [INFO] "), js))
            .when(ms < 40, F.concat(F.lit(RAW_PREFIX), F.substring(js, 1, 40)))
            .otherwise(F.concat(F.lit(RAW_PREFIX), js)))
    return log_df.select(line.alias("value"))


def user_agent_store(log_df: DataFrame) -> DataFrame:
    """S21 stand-in: a (key, value) store of user agents (blanks as '+')
    with their row counts."""
    return (log_df.groupBy(F.replace(F.col("ua"), F.lit(" "), F.lit("+")).alias("key"))
            .agg(F.count(F.lit(1)).cast("string").alias("value")))
