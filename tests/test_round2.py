"""Text round trips, publication, daily job chains and join plans."""

import pytest
from pyspark.sql import functions as F

from tagfold import jobs
from tagfold.functions.stopwords import ENGLISH_STOP_WORDS
from tagfold.operators import portrait as pt
from tagfold.operators import recommend as rc
from tagfold.operators import text as tx
from tagfold.schemas import DIM_SEARCH, DIM_TOTAL_INTEREST, LOG_FIELDS, TAG_COLUMNS
from tagfold.sinks import writers as wr
from tagfold.sources import readers as rd

ODD = ["tab\there", "line\nbreak", 'quo"te', "back\\slash", "amp&er&sand", "bell\u0007", "crlf\r\nend", "{\"a\":1}", "推荐", "a:b,c"]


def test_tokens_of_any_script(spark):
    df = spark.createDataFrame([("推荐系统 论文",), ("naïve café über 2024 C ai ml",), (None,), ("...",)], "t string")
    got = [r.w for r in df.select(tx.token_array(F.col("t")).alias("w")).collect()]
    assert got == [list("推荐系统论文"), ["naïve", "café", "über", "2024", "c", "ai", "ml"], [], []]


def test_stop_words_are_mllibs(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_portrait_text_round_trip(spark, tmp_path):
    rows = [(f"u{i}", dim, mod, tag, 1.5, 1_700_000_000_000) for i, tag in enumerate(ODD)
            for dim, mod in ((DIM_SEARCH, ""), (DIM_TOTAL_INTEREST, tag))]
    rows += [("u0", DIM_SEARCH, "", tag, 2.0, 1_700_000_000_001) for tag in ODD[1:]]
    tags = spark.createDataFrame(rows, "user string, dim string, module string, tag string, weight double, last_ms long")
    users = tags.select("user").distinct()
    path = wr.write_delimited(pt.portrait_wide(users, tags, "2026-01-01 00:00:00"), str(tmp_path / "p"), "&")
    back = pt.unpack_portrait(rd.read_portrait_text(spark, path))
    key = lambda df: sorted(tuple(r) for r in df.select(*TAG_COLUMNS).collect())
    assert key(back) == key(tags)


def test_delimited_table_has_columns_and_separator(spark, tmp_path):
    out = spark.createDataFrame([("u", '{"a,b":"x&y"}', 1)], "UserName string, TotalInterest string, hasPortrait int")
    path = wr.write_delimited(out, str(tmp_path / "t"), "&")
    spark.sql("DROP TABLE IF EXISTS t_delimited")
    wr.publish_location(spark, "t_delimited", path, "csv", "UserName string, TotalInterest string, hasPortrait int", {"sep": "&"})
    assert [tuple(r) for r in spark.table("t_delimited").collect()] == [("u", '{"a,b":"x&y"}', 1)]
    spark.sql("DROP TABLE t_delimited")


def test_partitioned_publish_switches_partitions_and_keeps_files(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_parts")
    one = wr.write_parquet(spark.createDataFrame([(1, "a"), (2, "b")], "x int, dim string"), str(tmp_path / "d1"), ["dim"])
    two = wr.write_parquet(spark.createDataFrame([(3, "b"), (4, "c")], "x int, dim string"), str(tmp_path / "d2"), ["dim"])
    wr.publish_location(spark, "t_parts", one)
    assert sorted(map(tuple, spark.table("t_parts").collect())) == [(1, "a"), (2, "b")]
    wr.publish_location(spark, "t_parts", two)
    assert sorted(map(tuple, spark.table("t_parts").collect())) == [(3, "b"), (4, "c")]
    assert spark.read.parquet(one).count() == 2
    spark.sql("DROP TABLE t_parts")


def test_managed_tables_are_refused(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_managed")
    spark.createDataFrame([(1,)], "x int").write.saveAsTable("t_managed")
    with pytest.raises(ValueError):
        wr.publish_location(spark, "t_managed", str(tmp_path))
    assert spark.table("t_managed").count() == 1
    spark.sql("DROP TABLE t_managed")


def _log(spark, rows, path):
    df = spark.createDataFrame([tuple(r.get(c, "") for c in LOG_FIELDS) for r in rows], ", ".join(f"{c} string" for c in LOG_FIELDS))
    df = df.withColumn("vt_ms", F.col("vt").cast("long")).withColumn("log_day", F.lit(20200101))
    df.write.parquet(path)
    return path


def test_idle_guest_decays_once_per_day(spark, tmp_path):
    first = _log(spark, [{"gki": "g1", "ro": "article", "rcc": "A", "vt": "1577836800000"},
                         {"gki": "", "ro": "article", "rcc": "A", "vt": "1577836800000"}], str(tmp_path / "l0"))
    none = _log(spark, [], str(tmp_path / "l1"))
    jobs.main(["guest-portrait", "--log", first, "--output", str(tmp_path / "s0"), "--as-of", "2020-01-01 00:00:00"])
    for day in (1, 2, 3):
        jobs.main(["guest-portrait", "--log", none, "--scores", str(tmp_path / f"s{day - 1}"), "--output", str(tmp_path / f"s{day}"),
                   "--as-of", f"2020-01-0{day + 1} 00:00:00"])
    rows = spark.read.parquet(str(tmp_path / "s3")).collect()
    assert [(r.user, r.code) for r in rows] == [("g1", "A")] and rows[0].score == pytest.approx(0.9 ** 3)


def test_users_without_tags_stay(spark, tmp_path):
    log = _log(spark, [{"un": "empty", "ro": "x", "ac": "look", "vt": "1577836800000"},
                       {"un": "seeker", "ro": "x", "ac": "search", "sw": "spark", "vt": "1577836800000"}], str(tmp_path / "l0"))
    none = _log(spark, [], str(tmp_path / "l1"))
    at = ["--as-of", "2020-01-02 00:00:00"]
    jobs.main(["portrait-update", "--log", log, "--output", str(tmp_path / "p0"), *at])
    jobs.main(["portrait-update", "--log", none, "--portrait", str(tmp_path / "p0"), "--output", str(tmp_path / "p1"),
               "--wide-output", str(tmp_path / "w1"), *at])
    wide = {r.UserName for r in rd.read_portrait_text(spark, str(tmp_path / "w1")).collect()}
    assert wide == {"empty", "seeker"}
    jobs.main(["serving", "--portrait", str(tmp_path / "p1"), "--output", str(tmp_path / "v1"), *at])
    assert {r.UserName: r.hasPortrait for r in spark.read.parquet(str(tmp_path / "v1")).collect()} == {"empty": 0, "seeker": 1}


def test_a_broken_model_is_not_overwritten(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "note").write_text("not a model")
    with pytest.raises(Exception):
        rc.load_or_train(str(tmp_path / "m"), spark.createDataFrame([(1, 1, 1.0)], "user_id int, item_id int, rating float"))
    assert (tmp_path / "m" / "note").read_text() == "not a model"


def test_equal_counts_of_a_day_are_spread(spark, tmp_path):
    df = spark.range(20_000).select(F.lit("2020-01-01").alias("date"), F.concat(F.lit("ua"), "id").alias("userAgent"),
                                    F.lit(1).alias("count"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = wr.write_partitioned_by_date(df, str(tmp_path / "k4"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [sum(1 for _ in open(f)) for f in (tmp_path / "k4" / "date=2020-01-01").glob("part-*")]
    assert sum(sizes) == 20_000 and len(sizes) >= 3 and max(sizes) < 10_000


def test_rank_cuts_run_before_the_exchange(spark):
    tags = spark.createDataFrame([("u", DIM_SEARCH, "", "t", 1.0, 1)],
                                 "user string, dim string, module string, tag string, weight double, last_ms long")
    for df in (pt.truncate_portrait(tags, 3), pt.decay_recent_interest(tags, 10, 0.1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Partial" in plan and "WindowGroupLimit" in plan


def test_hot_term_join_can_be_split(spark):
    docs = spark.createDataFrame([(i, "the " * 3 + f"w{i}") for i in range(50)], "doc_id long, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tx.tfidf(docs)._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan[plan.index("== Physical Plan =="):]
    join = final[final.index("SortMergeJoin"):]
    assert "HashAggregate" not in join and join.count("Exchange hashpartitioning(term") == 2


def test_unseen_recommendations(spark):
    scores = spark.createDataFrame([("u", "a", 3.0), ("u", "b", 2.0), ("u", "c", 2.0), ("u", "d", 0.0), ("v", "a", 1.0)],
                                   "user string, item string, score double")
    seen = spark.createDataFrame([("u", "a")], "user string, item string")
    done = spark.createDataFrame([("u", "b")], "user string, item string")
    got = [tuple(r) for r in rc.recommend_unseen(scores, seen, done, 2).orderBy("user", "rank").collect()]
    assert got == [("u", 1, "c", 2.0), ("v", 1, "a", 1.0)]
