"""Command-line jobs, one per batch program of the reference.

    spark-submit run_job.py <job> [options]      (or python -m tagfold.jobs)

Every job reads its inputs, runs the DataFrame operators and writes to a NEW
output path (parquet, or delimited text where the reference wrote text);
publishing is a separate, explicit ``--table`` switch. Clocks are arguments
(``--as-of``), never the wall clock. The session comes from spark-submit
(master, memory, ``spark.checkpoint.dir``); only unset settings get
defaults.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.tags import AUTHOR_STOP_NAMES
from .operators import filters as flt
from .operators import portrait as pt
from .operators import recommend as rc
from .operators import stats as st
from .operators import text as tx
from .schemas import LOG_FIELDS, TAG_COLUMNS
from .session import checkpoint_dir, get_spark, path_exists
from .sinks import writers as wr
from .sources import readers as rd


def _as_of_ms(text: str) -> int:
    """'yyyy-MM-dd HH:mm:ss' (UTC) -> epoch millis."""
    return int(datetime.strptime(text, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp() * 1000)


def _with_time(log: DataFrame) -> DataFrame:
    """Typed visit time and UTC day next to the 20 text fields."""
    vt_ms = F.col("vt").try_cast("long")
    return log.select(*LOG_FIELDS, vt_ms.alias("vt_ms"),
                      F.date_format(F.timestamp_millis(vt_ms), "yyyyMMdd").try_cast("int").alias("log_day"))


def _publish(spark: SparkSession, table: str | None, path: str, fmt: str = "parquet", **how) -> None:
    if table:
        wr.publish_location(spark, table, path, fmt, **how)


def _users_path(portrait: str) -> str:
    """The users of a stored portrait, those without any tag included."""
    return portrait.rstrip("/") + "_users"


def _users(spark: SparkSession, portrait: str, tags: DataFrame) -> DataFrame:
    """Users of a stored portrait; of one without a users table, those of its tags."""
    if path_exists(spark, _users_path(portrait)):
        return spark.read.parquet(_users_path(portrait)).select("user")
    return tags.select("user").distinct()


def job_format_log(spark, a):
    """S3: raw text log -> parsed, crawler-free log parquet by day."""
    lines = spark.read.text(a.input)
    log = flt.bot_filter(rd.read_raw_log(lines))
    wr.write_parquet(_with_time(log), a.output, ["log_day"])
    # lines that are not log rows are left out and counted
    counts = rd.raw_log_counts(lines)
    wr.write_parquet(counts, a.output.rstrip("/") + "_counts")


def job_portrait_update(spark, a):
    """Stored long-form portrait (optional) + one day's log -> new
    portrait (long form parquet), optionally the 16-column '&' text."""
    as_of = _as_of_ms(a.as_of)
    log = spark.read.parquet(a.log)
    stops = a.stop_names.split(",") if a.stop_names else AUTHOR_STOP_NAMES
    if a.portrait:
        old = spark.read.parquet(a.portrait).select(*TAG_COLUMNS)
        tags = pt.portrait_update(old, log, as_of, stops, a.min_weight, a.min_keywords)
        known = _users(spark, a.portrait, old)
    else:
        tags = pt.log_portrait(log, stop_names=stops)
        known = None
    wr.write_parquet(tags, a.output, ["dim"])    # decay reads only its dimensions
    users = pt.log_users(log)
    if known is not None:
        users = users.unionByName(known).distinct()
    wr.write_parquet(users, _users_path(a.output))
    _publish(spark, a.table, a.output)
    if a.wide_output:
        saved, users = spark.read.parquet(a.output), spark.read.parquet(_users_path(a.output))
        wr.write_delimited(pt.portrait_wide(users, saved, a.as_of), a.wide_output, "&")


def job_serving(spark, a):
    """P10: truncated serving portrait from a stored long-form portrait."""
    tags = spark.read.parquet(a.portrait).select(*TAG_COLUMNS)
    users = _users(spark, a.portrait, tags)
    out = pt.serving_portrait(users, tags, a.as_of, a.n)
    if a.format == "csv":
        wr.write_delimited(out, a.output, "&")
        _publish(spark, a.table, a.output, "csv", schema=", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema),
                 options={"sep": "&"})
    else:
        wr.write_parquet(out, a.output)
        _publish(spark, a.table, a.output, a.format)


def job_guest_portrait(spark, a):
    """Stored guest scores (user, code, score, latest_ms) + log. Scores
    are decayed up to ``--as-of`` and ``latest_ms`` says so, so the next run
    decays by the days since this one and not by those since the last log."""
    log = spark.read.parquet(a.log)
    old = spark.read.parquet(a.scores) if a.scores else None
    new = flt.guests(log)
    as_of = _as_of_ms(a.as_of)
    if old is None:
        scores = pt.guest_visit_counts(new)
    else:
        scores = pt.guest_portrait(old, new, as_of, a.coefficient, a.min_weight)
    wr.write_parquet(scores.withColumn("latest_ms", F.lit(as_of).cast("long")), a.output)


def job_ranking(spark, a):
    """Top-N resources of one kind (bounded: one output file)."""
    top = st.resource_ranking(spark.read.parquet(a.log), a.kind, a.n)
    top.coalesce(1).write.mode("overwrite").option("sep", ",").csv(a.output)


def job_top_articles(spark, a):
    """A3 + W3 + J3: top-N files per publication type with titles."""
    out = st.top_articles_by_type(rd.read_article_events(spark, a.events), rd.read_titles(spark, a.titles),
                                  a.n, a.year)
    wr.write_parquet(out, a.output)


def job_journal_stats(spark, a):
    """A2: journal purchase statistics."""
    wr.write_parquet(st.journal_purchase_stats(rd.read_journal_purchases(spark, a.input), a.created_on), a.output)


def job_ua_stats(spark, a):
    """A4 + K4: user-agent counts per day, one directory per date."""
    counts = st.ua_daily_counts(st.parse_web_log(spark.read.text(a.input)))
    wr.write_partitioned_by_date(counts, a.output, "date", "count")


def job_category_tags(spark, a):
    """Top-k categories per user, ';'-joined."""
    wr.write_parquet(st.user_category_tags(rd.read_category_purchases(spark, a.input), a.k), a.output)


def job_roster(spark, a):
    """Initial roster with dense ids in name order."""
    lists = [rd.read_name_lines(spark, p) for p in (a.lists.split(",") if a.lists else [])]
    wr.write_delimited(pt.initial_roster(rd.read_name_lines(spark, a.named), *lists), a.output, "&")


def job_keywords(spark, a):
    """M3: top-k TF-IDF keywords per document: documents from parquet
    (``--docs`` with id/text columns) or one document per file of a
    directory (``--text-dir``, S18; the file path is the id)."""
    if a.text_dir:
        docs = rd.read_whole_files(spark, a.text_dir).select(F.col("file_name").alias("doc_id"),
                                                             F.col("content").alias("text"))
    elif a.docs:
        docs = spark.read.parquet(a.docs).select(F.col(a.id_col).alias("doc_id"), F.col(a.text_col).alias("text"))
    else:
        raise SystemExit("keywords: give --docs or --text-dir")
    wr.write_parquet(tx.tfidf_keywords(docs, a.k), a.output)


def job_als(spark, a):
    """ALS (load or train), RMSE, top-10 per user with names."""
    # the split key is a hash of the rating itself, so a retried task puts
    # every row on the same side again
    ratings = rd.read_ratings(spark, a.ratings)
    ratings = ratings.withColumn("rid", F.xxhash64("user_id", "item_id", "rating"))
    train, test = rc.hash_split(ratings, "rid")
    model = rc.load_or_train(a.model, train)
    rc.als_rmse(model, test).coalesce(1).write.mode("overwrite").json(a.output + "/rmse")
    names = (rd.read_id_map(spark, a.items, "item_id", "item_name") if a.items
             else spark.createDataFrame([], "item_id int, item_name string"))
    # among the pairs given, else among all items
    if a.candidates:
        best = rc.als_recommend(model, rd.read_ratings(spark, a.candidates).select("user_id", "item_id"), names, a.k)
    else:
        best = rc.als_top_items(model, names, a.k)
    wr.write_parquet(best, a.output + "/recommendations")


def job_cells(spark, a):
    """K9: cell layout of a formatted log for a sorted bulk load."""
    wr.write_parquet(wr.log_to_cells(spark.read.parquet(a.log)), a.output)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tagfold.jobs")
    sub = p.add_subparsers(dest="job", required=True)

    def add(name, fn, *args):
        s = sub.add_parser(name)
        for arg, kw in args:
            s.add_argument(arg, **kw)
        s.set_defaults(fn=fn)
        return s

    req = {"required": True}
    add("format-log", job_format_log, ("--input", req), ("--output", req))
    add("portrait-update", job_portrait_update, ("--log", req), ("--output", req), ("--as-of", req),
        ("--portrait", {}), ("--wide-output", {}), ("--table", {}), ("--stop-names", {}),
        ("--min-weight", {"type": float, "default": 0.01}), ("--min-keywords", {"type": int, "default": 10}))
    add("serving", job_serving, ("--portrait", req), ("--output", req), ("--as-of", req),
        ("--n", {"type": int, "default": 3}), ("--format", {"choices": ["parquet", "csv"], "default": "parquet"}),
        ("--table", {}))
    add("guest-portrait", job_guest_portrait, ("--log", req), ("--output", req), ("--as-of", req), ("--scores", {}),
        ("--coefficient", {"type": float, "default": 0.9}), ("--min-weight", {"type": float, "default": 0.01}))
    add("ranking", job_ranking, ("--log", req), ("--output", req), ("--kind", {"default": "article"}),
        ("--n", {"type": int, "default": 100}))
    add("top-articles", job_top_articles, ("--events", req), ("--titles", req), ("--output", req),
        ("--n", {"type": int, "default": 100}), ("--year", {"type": int, "required": True}))
    add("journal-stats", job_journal_stats, ("--input", req), ("--output", req), ("--created-on", req))
    add("ua-stats", job_ua_stats, ("--input", req), ("--output", req))
    add("category-tags", job_category_tags, ("--input", req), ("--output", req), ("--k", {"type": int, "default": 10}))
    add("roster", job_roster, ("--named", req), ("--output", req), ("--lists", {}))
    add("keywords", job_keywords, ("--docs", {}), ("--text-dir", {}), ("--output", req),
        ("--k", {"type": int, "default": 25}),
        ("--id-col", {"default": "doc_id"}), ("--text-col", {"default": "text"}))
    add("als", job_als, ("--ratings", req), ("--model", req), ("--output", req), ("--items", {}), ("--candidates", {}),
        ("--k", {"type": int, "default": 10}))
    add("cells", job_cells, ("--log", req), ("--output", req))
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(argv)
    spark = spark or get_spark(app=f"tagfold-{a.job}")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    a.fn(spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
