"""Log statistics and rankings.

Group top-k uses ``row_number() <= k`` so the planner inserts a
WindowGroupLimit that trims each group to k rows before the window's
exchange; global top-k uses ``orderBy().limit()`` (TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .filters import normalize_type, recode_times


def resource_ranking(log: DataFrame, kind: str = "article", n: int = 100) -> DataFrame:
    """The n resources of one kind with the most log rows.
    Ties are broken by resource id (the reference leaves them arbitrary)."""
    counts = (log.where(F.col("ro") == kind)
              .groupBy("ri").agg(F.count("ri").alias("visits")))
    return counts.orderBy(F.desc("visits"), F.asc("ri")).limit(n)


def journal_purchase_stats(purchases: DataFrame, created_on: str) -> DataFrame:
    """A2: recoded purchase counts summed per (code, album, subject, year,
    month, date). Rows with album or subject ``\\N`` are dropped."""
    date = F.split(F.col("datetime"), " ").getItem(0)
    parts = F.split(date, "-")
    rows = (purchases
            .where((F.col("album") != "\\N") & (F.col("subject") != "\\N"))
            .where(F.size(parts) >= 3)
            .select("code", "album", "subject",
                    F.get(parts, 0).try_cast("int").alias("year"),
                    F.get(parts, 1).try_cast("int").alias("month"),
                    date.alias("datadate"),
                    recode_times(F.col("times")).alias("times")))
    agg = rows.groupBy("code", "album", "subject", "year", "month", "datadate").agg(
        F.sum("times").cast("long").alias("buycount"))
    return agg.select(
        F.col("code"), F.col("album").alias("albumcategory"),
        F.col("subject").alias("subjectcategory"), F.lit("").alias("subjectsubcategory"),
        "year", "month", "datadate", F.lit(0).cast("long").alias("browsecount"),
        "buycount", F.lit(created_on).alias("createon"))


def top_articles_by_type(events: DataFrame, titles: DataFrame, n: int = 100,
                         year: int = 2018) -> DataFrame:
    """A3 + W3 + A11 + J3: event counts per (file, type class), the n most
    counted files of each class, joined to one title per file.

    The title side is reduced to one row per file (smallest title) with a
    partial aggregate; the top-n side has at most 6 * n rows, and AQE broadcasts
    it when that is small.
    """
    counts = (events.where(F.col("fileName").isNotNull() & F.col("dataType").isNotNull())
              .select("fileName", normalize_type(F.col("dataType")).alias("DataType"))
              .groupBy("fileName", "DataType").agg(F.count(F.lit(1)).alias("BuyCount")))
    w = Window.partitionBy("DataType").orderBy(F.desc("BuyCount"), F.asc("fileName"))
    top = counts.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
    one_title = (titles.where(F.col("fileName") != "")
                 .groupBy("fileName").agg(F.min("title").alias("Title")))
    j = one_title.join(top, "fileName")
    return j.select(F.col("fileName").alias("FileName"), "Title", "DataType",
                    F.col("BuyCount").cast("long").alias("BuyCount"),
                    F.lit(0).cast("long").alias("BrowseCount"), F.lit(year).alias("Year"))


def parse_web_log(lines: DataFrame) -> DataFrame:
    """S12 + F6/F7: blank-separated lines with at least 15 fields; date is
    field 0 and the user agent field 9. Header lines (containing 'Fields'),
    empty dates and '-' agents are dropped."""
    f = F.split(F.col("value"), " ")
    rows = lines.where(F.size(f) >= 15).select(F.get(f, 0).alias("date"), F.get(f, 9).alias("userAgent"))
    return rows.where((F.col("date") != "") & ~F.col("date").contains("Fields")
                      & (F.col("userAgent") != "-"))


def ua_daily_counts(rows: DataFrame) -> DataFrame:
    """A4: rows per (date, user agent)."""
    return rows.groupBy("date", "userAgent").agg(F.count(F.lit(1)).cast("int").alias("count"))


def user_category_tags(purchases: DataFrame, k: int = 10) -> DataFrame:
    """A5 + W4 + A6: purchases summed per (user, category); each user's k
    largest categories, joined with ';' in descending order (ties by name)."""
    sums = (purchases.where(F.col("count") >= 0)
            .groupBy("user", "category").agg(F.sum("count").alias("n")))
    w = Window.partitionBy("user").orderBy(F.desc("n"), F.asc("category"))
    top = sums.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)
    packed = top.groupBy("user").agg(
        F.array_sort(F.collect_list(F.struct("rk", "category"))).alias("cats"))
    return packed.select(F.col("user").alias("UserName"),
                         F.array_join(F.transform("cats", lambda c: c["category"]), ";")
                         .alias("JournalsInterests"))
