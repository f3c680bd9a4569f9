"""Readers for the reference's text inputs.

All are DataFrame readers: ``spark.read.text``/``csv`` with explicit schemas,
regex splits and ``from_json`` -- no per-line Python. Rejected lines are
dropped from the result and can be counted with :func:`parse_log_lines`'s
``ok`` flag (the reference aborts or prints instead).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tags import java_split
from ..schemas import GUEST_COLUMNS, GUEST_SCHEMA, LOG_FIELDS, LOG_SCHEMA, PORTRAIT_COLUMNS, PORTRAIT_SCHEMA
from ..sinks.writers import index_path

# A raw log line is "<anything><digit>] <json>".
LOG_LINE_SPLIT = r"\d\] "
# Columns of the portrait layouts that hold JSON maps.
PORTRAIT_JSON_COLUMNS = PORTRAIT_COLUMNS[5:15]
GUEST_JSON_COLUMNS = GUEST_COLUMNS[6:13]

_LOG_WITH_CORRUPT = T.StructType(LOG_SCHEMA.fields + [T.StructField("_corrupt", T.StringType(), True)])


def parse_log_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Split each line on ``<digit>] `` (JVM split semantics); exactly two
    pieces, the second a JSON object; the 20 fields, a missing or null key
    giving ''. Adds ``ok`` (false for unsplittable lines and bad JSON)."""
    # staged projections: the split and the JSON parse each run once per line
    t = lines.select(java_split(F.col(value_col), LOG_LINE_SPLIT).alias("_p"))
    t = t.select(F.when(F.size("_p") == 2, F.get(F.col("_p"), 1)).alias("_js"))
    rec = F.from_json(F.col("_js"), _LOG_WITH_CORRUPT,
                      {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})
    t = t.select("_js", rec.alias("r"))
    ok = F.col("_js").isNotNull() & F.col("r").isNotNull() & F.col("r._corrupt").isNull()
    return t.select(*[F.coalesce(F.col(f"r.{f}"), F.lit("")).alias(f) for f in LOG_FIELDS], ok.alias("ok"))


def read_raw_log(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """S2 with rejected lines removed."""
    return parse_log_lines(lines, value_col).where("ok").drop("ok")


def raw_log_counts(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """One row: lines read, and lines rejected by the parser."""
    return parse_log_lines(lines, value_col).agg(
        F.count(F.lit(1)).alias("lines"), F.count(F.when(~F.col("ok"), 1)).alias("rejected"))


def _json_default(c: Column) -> Column:
    """X16: '', blank or missing JSON text becomes '{}'."""
    return F.when(F.coalesce(F.trim(c), F.lit("")).isin("", '""'), F.lit("{}")).otherwise(c)


def read_portrait_text(spark: SparkSession, path: str, sep: str = "&") -> DataFrame:
    """The 16-column portrait text. The CSV reader's quote/escape rules
    restore JSON text containing the separator or quotes; empty maps become
    '{}', missing demographics 0; rows without a user name are dropped."""
    df = spark.read.csv(path, schema=PORTRAIT_SCHEMA, sep=sep, mode="PERMISSIVE")
    cols = []
    for c in PORTRAIT_COLUMNS:
        if c in PORTRAIT_JSON_COLUMNS:
            cols.append(_json_default(F.col(c)).alias(c))
        elif c in ("Age", "Gender"):
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
        else:
            cols.append(F.coalesce(F.col(c), F.lit("")).alias(c))
    return df.select(*cols).where(F.col("UserName") != "")


def read_guest_portrait(spark: SparkSession, path: str, log_time: str, sep: str = "&") -> DataFrame:
    """The 14-column legacy/guest portrait text; JSON columns default to
    '{}', and the time column is replaced by the run time ``log_time``."""
    df = spark.read.csv(path, schema=GUEST_SCHEMA, sep=sep, mode="PERMISSIVE")
    cols = []
    for c in GUEST_COLUMNS:
        if c in GUEST_JSON_COLUMNS:
            cols.append(_json_default(F.col(c)).alias(c))
        elif c == "latest_log_time":
            cols.append(F.lit(log_time).alias(c))
        elif c in ("Age", "Gender"):
            cols.append(F.coalesce(F.col(c), F.lit(0)).alias(c))
        elif c == "UserID":
            cols.append(F.col(c))
        else:
            cols.append(F.coalesce(F.col(c), F.lit("")).alias(c))
    return df.select(*cols).where(F.col("UserName") != "")


def reproject(df: DataFrame, columns: list[str], defaults: dict[str, Column]) -> DataFrame:
    """re-read rows into another column layout; columns the source lacks
    take their default."""
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else defaults[c]).alias(c) for c in columns])


def glob_to_like(pattern: str) -> str:
    """Key glob (``*``, ``?``) as a SQL LIKE pattern (``\\`` escapes)."""
    out = []
    for ch in pattern:
        if ch == "*":
            out.append("%")
        elif ch == "?":
            out.append("_")
        elif ch in "%_\\":
            out.append("\\" + ch)
        else:
            out.append(ch)
    return "".join(out)


def key_pattern_scan(kv: DataFrame, pattern: str) -> DataFrame:
    """Rows of a (key, value) table whose key matches a glob."""
    return kv.where(F.col("key").like(glob_to_like(pattern)))


def cell_range_scan(cells: DataFrame, lo: str, hi: str, qualifiers: list[str]) -> DataFrame:
    """Cells with ``lo <= row_key < hi`` pivoted back to one row per key
    (one column per qualifier). The range predicate is pushed to the scan."""
    c = cells.where((F.col("row_key") >= F.lit(lo)) & (F.col("row_key") < F.lit(hi)))
    return c.groupBy("row_key").agg(*[
        F.max(F.when(F.col("qualifier") == q, F.col("value"))).alias(q) for q in qualifiers])


def cell_files(spark: SparkSession, path: str, lo: str, hi: str) -> list[str]:
    """Files of a cell table whose keys overlap ``lo <= row_key < hi``, from the
    key index; only their names reach the driver."""
    index = spark.read.parquet(index_path(path))
    found = index.where((F.col("greatest") >= F.lit(lo)) & (F.col("least") < F.lit(hi))).select("file").orderBy("least")
    return [f"{path.rstrip('/')}/{r.file}" for r in found.collect()]


def read_cell_range(spark: SparkSession, path: str, lo: str, hi: str, qualifiers: list[str]) -> DataFrame:
    """S20 over a stored cell table: files outside the range are not opened."""
    files = cell_files(spark, path, lo, hi)
    schema = "row_key string, family string, qualifier string, value string"
    cells = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    return cell_range_scan(cells, lo, hi, qualifiers)


def read_file_lines(spark: SparkSession, path: str) -> DataFrame:
    """S18 for files of any size: one row per line, (file_path, block_start,
    value). A file is read in splits by many tasks and is never one string;
    ``block_start`` is the offset of the split that a line is read in."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file_path"),
                                        F.col("_metadata.file_block_start").alias("block_start"), "value")


def read_related_authors(spark: SparkSession, path: str, sep: str = "&") -> DataFrame:
    """(UserName, TotalRelatedAuthor, RecentRelatedAuthor) text; JSON
    columns default to '{}' (the reference's extra stripped character is not
    reproduced)."""
    schema = "UserName string, TotalRelatedAuthor string, RecentRelatedAuthor string"
    df = spark.read.csv(path, schema=schema, sep=sep, mode="PERMISSIVE")
    return df.select(F.coalesce(F.col("UserName"), F.lit("")).alias("UserName"),
                     _json_default(F.col("TotalRelatedAuthor")).alias("TotalRelatedAuthor"),
                     _json_default(F.col("RecentRelatedAuthor")).alias("RecentRelatedAuthor")
                     ).where(F.col("UserName") != "")


def read_preference_portrait(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """``id;name;prefList;latest_log_time`` with prefList a JSON
    score map ``{class: {keyword: score}}`` parsed to a nested map (bad
    text -> empty map)."""
    schema = "id string, name string, prefList string, latest_log_time string"
    df = spark.read.csv(path, schema=schema, sep=sep, mode="PERMISSIVE")
    m = F.from_json(F.col("prefList"), "map<string,map<string,double>>")
    return df.select("id", "name", F.coalesce(m, F.create_map().cast("map<string,map<string,double>>"))
                     .alias("prefList"), "latest_log_time")


def read_raw_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """S17: '::'-separated catalogue lines (JVM split semantics); id = field
    0, title = field 2, content = field 3 (both without '&'), class = field
    6. Lines with fewer than 7 fields are rejected (the reference would
    fail on them)."""
    lines = spark.read.text(path)
    t = lines.select(java_split(F.col("value"), "::").alias("f"))
    return t.where(F.size("f") >= 7).select(
        F.get("f", 0).alias("id"), F.replace(F.get("f", 2), F.lit("&"), F.lit("")).alias("title"),
        F.replace(F.get("f", 3), F.lit("&"), F.lit("")).alias("content"), F.get("f", 6).alias("class"))


def read_catalogue(spark: SparkSession, path: str, sep: str = "&") -> DataFrame:
    """Catalogue text, id = field 0, title = field 2, time = field 5,
    class = field 6, and field 8 a JSON map ``{class: {keyword: score}}``.
    ``keywords`` is the map under the item's own class, null where that is
    absent. Lines without an id are rejected."""
    schema = ", ".join(f"f{i} string" for i in range(9))
    f = spark.read.csv(path, schema=schema, sep=sep, mode="PERMISSIVE")
    maps = F.from_json(F.col("f8"), "map<string,map<string,double>>")
    return f.where(F.coalesce(F.col("f0"), F.lit("")) != "").select(
        F.col("f0").alias("id"), F.col("f6").alias("class"), F.coalesce("f2", F.lit("")).alias("title"),
        F.col("f5").alias("time"), F.try_element_at(maps, F.col("f6")).alias("keywords"))


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, (file_name, content)."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file_name"), F.col("value").alias("content"))


def _fields(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Lines split on a literal separator with JVM split semantics."""
    import re as _re
    return spark.read.text(path).select(java_split(F.col("value"), _re.escape(sep)).alias("f"))


def read_journal_purchases(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``code, times, datetime, album, subject``; lines with
    fewer than 5 fields or a non-numeric count are rejected."""
    f = _fields(spark, path, "\t")
    t = f.where(F.size("f") >= 5).select(
        F.get("f", 0).alias("code"), F.get("f", 1).try_cast("int").alias("times"),
        F.get("f", 2).alias("datetime"), F.get("f", 3).alias("album"), F.get("f", 4).alias("subject"))
    return t.where(F.col("times").isNotNull())


def read_article_events(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``fileName, dataType``; lines with fewer than 2
    fields are dropped."""
    f = _fields(spark, path, "\t")
    return f.where(F.size("f") >= 2).select(F.get("f", 0).alias("fileName"), F.get("f", 1).alias("dataType"))


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ``fileName, title``; short lines dropped."""
    f = _fields(spark, path, "\t")
    return f.where(F.size("f") >= 2).select(F.get("f", 0).alias("fileName"), F.get("f", 1).alias("title"))


def read_category_purchases(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated, at least 7 fields: user = field 0, count = field 3,
    category = field 6 (malformed rows dropped, D-22)."""
    f = _fields(spark, path, "\t")
    t = f.where(F.size("f") >= 7).select(
        F.get("f", 0).alias("user"), F.get("f", 3).try_cast("int").alias("count"), F.get("f", 6).alias("category"))
    return t.where(F.col("count").isNotNull() & (F.col("user") != ""))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """``userId,productId,rating`` CSV -> (user_id, item_id, rating);
    rows that do not parse are rejected (the reference asserts)."""
    schema = "user_id int, item_id int, rating float"
    df = spark.read.csv(path, schema=schema, mode="DROPMALFORMED")
    return df.where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("rating").isNotNull())


def read_id_map(spark: SparkSession, path: str, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """``id,name`` CSV."""
    df = spark.read.csv(path, schema=f"{id_col} int, {name_col} string", mode="DROPMALFORMED")
    return df.where(F.col(id_col).isNotNull())


def read_name_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain text lines as ``value`` (roster files)."""
    return spark.read.text(path)
