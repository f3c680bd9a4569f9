"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
fixtures (whole tables, no row caps) and returns a deterministic result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fixtures as fx
from ..functions import jsonmaps as J
from ..functions.decay import decay_factor, whole_days
from ..functions.tags import is_human
from ..operators import filters as flt
from ..operators import portrait as pt
from ..operators import stats as st
from ..operators import recommend as rc
from ..operators import text as tx
from ..operators import topk as tk
from ..schemas import GUEST_COLUMNS, PORTRAIT_COLUMNS
from ..session import scratch_path
from ..sinks import writers as wr
from ..sources import readers as rd
from ..schemas import (DIM_RECENT_AUTHOR, DIM_RECENT_INTEREST, DIM_SEARCH, DIM_SUBJECT,
                       DIM_SUBSUBJECT, DIM_TOTAL_AUTHOR, DIM_TOTAL_INTEREST, DIMS)
from ..session import checkpoint_dir, materialized
from ..sources.tables import load

STOP = fx.FIXTURE_STOP_NAMES
AS_OF = fx.AS_OF_MS
# Prune settings of the decay_recent_interest check: threshold 0.1 with the
# default 1% per-period fraction, so that pruning actually happens on the
# fixture (with the 0.01 default no weight >= 1 ever falls below it).
PRUNE_MIN_WEIGHT = 0.1
PRUNE_FRACTION = 0.01


def prepare_session(spark: SparkSession) -> None:
    """Session settings the queries rely on: UTC for epoch-millis conversion
    of the NTZ timestamps, and a checkpoint folder (kept when the cluster
    names one)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)


def formatted_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the log after the crawler filter (what the portrait jobs read)."""
    return flt.bot_filter(fx.log(spark, sf_dir))


def _old_new(spark, sf_dir):
    lg = formatted_log(spark, sf_dir)
    return fx.old_log(lg), fx.new_log(lg)


def _long(df: DataFrame, dim_col: bool = False) -> DataFrame:
    cols = ["user"] + (["dim"] if dim_col else []) + ["module", "tag"]
    return df.select(*cols, F.round("weight", 4).alias("weight"), "last_ms")


# ------------------------------------------------------------ statistics

def q_article_ranking(spark, sf_dir):
    return st.resource_ranking(formatted_log(spark, sf_dir), "article", 100)


def q_book_ranking(spark, sf_dir):
    return st.resource_ranking(formatted_log(spark, sf_dir), "tushu", 100)


_TEXTS: dict[tuple, str] = {}


def _as_text(spark, key: str, build, sep: str = "\t") -> str:
    """Path of the rows of ``build()`` as lines of ``sep``-joined fields,
    written once per application: the input of the text readers."""
    k = (spark.sparkContext.applicationId, key)
    if k not in _TEXTS:
        df = build()
        path = scratch_path(spark, "text")
        df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])).write.text(path)
        _TEXTS[k] = path
    return _TEXTS[k]


def _article_events(spark, sf_dir):
    """The events as tab-separated text, read back."""
    return rd.read_article_events(spark, _as_text(spark, f"events:{sf_dir}", lambda: fx.article_events(spark, sf_dir)))


def q_top_articles_by_type(spark, sf_dir):
    titles = rd.read_titles(spark, _as_text(spark, f"titles:{sf_dir}", lambda: fx.titles(spark, sf_dir)))
    return st.top_articles_by_type(_article_events(spark, sf_dir), titles, 100, 2018)


def q_normalize_type(spark, sf_dir):
    ev = _article_events(spark, sf_dir)
    return (ev.select(F.col("dataType").alias("spelling"),
                      flt.normalize_type(F.col("dataType")).alias("type_class"))
            .groupBy("spelling", "type_class").agg(F.count(F.lit(1)).alias("n")))


def q_journal_purchase_stats(spark, sf_dir):
    """Tab-separated purchases through the reader."""
    path = _as_text(spark, f"purchases:{sf_dir}", lambda: fx.journal_purchases(spark, sf_dir))
    return st.journal_purchase_stats(rd.read_journal_purchases(spark, path), fx.AS_OF_TEXT)


def q_ua_daily_counts(spark, sf_dir):
    lines = fx.web_log_lines(fx.log(spark, sf_dir))
    return st.ua_daily_counts(st.parse_web_log(lines))


def q_user_category_tags(spark, sf_dir):
    """Seven tab-separated fields through the reader."""
    e = F.lit("")
    path = _as_text(spark, f"categories:{sf_dir}", lambda: fx.category_purchases(spark, sf_dir).select(
        "user", e.alias("f1"), e.alias("f2"), "count", e.alias("f4"), e.alias("f5"), "category"))
    return st.user_category_tags(rd.read_category_purchases(spark, path), 10)


# ------------------------------------------------------------ log cleaning

def q_bot_filter(spark, sf_dir):
    return formatted_log(spark, sf_dir).select("event_id", "un", "ua")


def q_log_quality_counts(spark, sf_dir):
    lg = fx.log(spark, sf_dir)
    human = is_human(F.col("ua"))
    return lg.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(human).alias("human_rows"),
        F.count_if(human & (F.col("un") != "")).alias("registered_rows"),
        F.count_if(human & (F.col("un") == "") & (F.col("rcc") != "")).alias("guest_rows"))


def q_distinct_users(spark, sf_dir):
    return pt.log_users(formatted_log(spark, sf_dir))


# ------------------------------------------------------------ tag extraction

def _log_dim(spark, sf_dir, dim):
    p = pt.log_portrait(formatted_log(spark, sf_dir), [dim], STOP)
    return _long(p)


def q_log_keyword_interests(spark, sf_dir):
    return _log_dim(spark, sf_dir, DIM_TOTAL_INTEREST)


def q_log_subjects(spark, sf_dir):
    return _log_dim(spark, sf_dir, DIM_SUBJECT)


def q_log_subsubjects(spark, sf_dir):
    return _log_dim(spark, sf_dir, DIM_SUBSUBJECT)


def q_log_authors(spark, sf_dir):
    return _log_dim(spark, sf_dir, DIM_TOTAL_AUTHOR)


def q_log_search_words(spark, sf_dir):
    return _log_dim(spark, sf_dir, DIM_SEARCH)


# ------------------------------------------------------------ decay

def q_decay_factor(spark, sf_dir):
    lg = fx.log(spark, sf_dir)
    days = whole_days(AS_OF, F.col("vt_ms"))
    g = lg.groupBy(days.alias("days")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("days", "n",
                    F.round(decay_factor(F.col("days"), 30, 0.01), 10).alias("f30"),
                    F.round(decay_factor(F.col("days"), 60, 0.5), 10).alias("f60"))


def stored_portrait(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored portrait an update starts from (long form, all seven
    dimensions): the portrait of the log rows before the split, written once
    as a table partitioned by ``dim``, like the portrait table the daily job
    reads."""
    def build():
        old, _ = _old_new(spark, sf_dir)
        return pt.log_portrait(old, DIMS, STOP)
    # partitioned by dimension: the decay branches prune to their own files
    return materialized(spark, f"portrait:{sf_dir}", build, ["dim"])


def _old_portrait(spark, sf_dir, dims=DIMS):
    return stored_portrait(spark, sf_dir).where(F.col("dim").isin(list(dims)))


def q_decay_recent_interest(spark, sf_dir):
    old = _old_portrait(spark, sf_dir, [DIM_RECENT_INTEREST])
    d = pt.decay_recent_interest(old, AS_OF, min_weight=PRUNE_MIN_WEIGHT, fraction=PRUNE_FRACTION)
    return _long(d)


def q_decay_recent_author(spark, sf_dir):
    old = _old_portrait(spark, sf_dir, [DIM_RECENT_AUTHOR])
    return _long(pt.decay_recent_author(old, AS_OF))


def _old_guest_scores(spark, sf_dir):
    old, _ = _old_new(spark, sf_dir)
    g = flt.guests(old)
    scores = pt.guest_visit_counts(g)
    latest = (g.where(F.col("ro") == "article").groupBy(F.col("gki").alias("user"))
              .agg(F.max("vt_ms").alias("latest_ms")))
    return scores.join(latest, "user")


def q_decay_guest_flat(spark, sf_dir):
    d = pt.decay_guest_flat(_old_guest_scores(spark, sf_dir), AS_OF)
    return d.select("user", "code", F.round("score", 6).alias("score"))


def q_decay_guest_nested(spark, sf_dir):
    old = _old_portrait(spark, sf_dir, [DIM_TOTAL_INTEREST])
    latest = old.groupBy("user").agg(F.max("last_ms").alias("latest_ms"))
    d = pt.decay_guest_nested(old.join(latest, "user"), AS_OF)
    return _long(d)


# ------------------------------------------------------------ merges

def _merge_dim(spark, sf_dir, dim):
    _, new = _old_new(spark, sf_dir)
    merged = pt.merge_portraits(_old_portrait(spark, sf_dir, [dim]), pt.log_tag_rows(new, [dim], STOP))
    return _long(merged)


def q_portrait_interest_merge(spark, sf_dir):
    return _merge_dim(spark, sf_dir, DIM_TOTAL_INTEREST)


def q_portrait_subject_merge(spark, sf_dir):
    return _merge_dim(spark, sf_dir, DIM_SUBJECT)


def q_portrait_subsubject_merge(spark, sf_dir):
    return _merge_dim(spark, sf_dir, DIM_SUBSUBJECT)


def q_portrait_author_merge(spark, sf_dir):
    return _merge_dim(spark, sf_dir, DIM_TOTAL_AUTHOR)


def q_portrait_search_merge(spark, sf_dir):
    return _merge_dim(spark, sf_dir, DIM_SEARCH)


def q_new_users(spark, sf_dir):
    """Users of the new log that a portrait of the first half day lacks."""
    _, new = _old_new(spark, sf_dir)
    return pt.new_users(pt.log_users(fx.known_log(formatted_log(spark, sf_dir))), new)


def q_new_guests(spark, sf_dir):
    _, new = _old_new(spark, sf_dir)
    known = pt.log_users(flt.guests(fx.known_log(formatted_log(spark, sf_dir))), "gki")
    return pt.new_users(known, flt.guests(new), "gki")


# ------------------------------------------------------------ portraits

def _updated(spark, sf_dir):
    _, new = _old_new(spark, sf_dir)
    # known users plus the new ones (P6) is every distinct user of the log:
    # one scan and one distinct instead of a union with an anti join
    users = pt.log_users(formatted_log(spark, sf_dir))
    return users, pt.portrait_update(stored_portrait(spark, sf_dir), new, AS_OF, STOP)


def q_portrait_update(spark, sf_dir):
    _, tags = _updated(spark, sf_dir)
    return _long(tags, dim_col=True)


# Buckets of the stored portrait of the fold query: so many at least, and no
# more rows of it in each on average. A task holds windows over a bucket.
FOLD_BUCKETS = 8
FOLD_ROWS = 50_000
_BUCKETED: dict[tuple, str] = {}


def fold_buckets(rows: int) -> int:
    return max(FOLD_BUCKETS, -(-rows // FOLD_ROWS))


def bucketed_portrait(spark, sf_dir):
    """The stored portrait as a table bucketed by user, written once."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _BUCKETED:
        stored = stored_portrait(spark, sf_dir)
        name = f"tagfold_portrait_{len(_BUCKETED)}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        wr.write_bucketed(stored, name, scratch_path(spark, "bucketed"), "user", fold_buckets(stored.count()),
                          ["user", "dim", "module", "tag"])
        _BUCKETED[k] = name
    return spark.table(_BUCKETED[k])


def q_portrait_fold(spark, sf_dir):
    """P8 over a stored portrait in buckets, which is not shuffled: the next
    portrait is stored in buckets and read."""
    _, new = _old_new(spark, sf_dir)
    _published[0] += 1
    buckets = fold_buckets(stored_portrait(spark, sf_dir).count())
    return _long(pt.fold_and_store(bucketed_portrait(spark, sf_dir), new, AS_OF, f"tagfold_folded_{_published[0]}",
                                   scratch_path(spark, "folded"), buckets, stop_names=STOP), dim_col=True)


def q_portrait_wide(spark, sf_dir):
    users, tags = _updated(spark, sf_dir)
    return pt.portrait_wide(users, tags, fx.AS_OF_TEXT)


def q_serving_portrait(spark, sf_dir):
    users, tags = _updated(spark, sf_dir)
    return pt.serving_portrait(users, tags, fx.AS_OF_TEXT, 3)


def q_guest_portrait(spark, sf_dir):
    _, new = _old_new(spark, sf_dir)
    g = pt.guest_portrait(_old_guest_scores(spark, sf_dir), flt.guests(new), AS_OF)
    return g.select("user", "code", F.round("score", 6).alias("score"))


def q_legacy_keyword_portrait(spark, sf_dir):
    return pt.legacy_keyword_portrait(formatted_log(spark, sf_dir))


def q_initial_roster(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(
        F.concat_ws("\t", F.col("c_custkey").cast("string"), F.col("c_name")).alias("value"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_name").alias("value"))
    u = fx.log(spark, sf_dir).select(F.col("un").alias("value"))
    # Three lists of lines, read as text
    c, s, u = (rd.read_name_lines(spark, _as_text(spark, f"names{i}:{sf_dir}", lambda d=d: d)) for i, d in enumerate((c, s, u)))
    return pt.initial_roster(c, s, u).select("UserID", "UserName", "Age", "Gender", "SingleArticleInterest",
                                             "latest_log_time")


# ------------------------------------------------------------ text features

def _documents(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", "text", "source")


def q_tfidf_keywords(spark, sf_dir):
    return tx.tfidf_keywords(_documents(spark, sf_dir), 25)


def q_catalog_keywords(spark, sf_dir):
    return tx.catalog_keywords(_documents(spark, sf_dir), "doc_id", "source", "text", 10)


def q_read_catalogue(spark, sf_dir):
    """The documents as catalogue text; every second item's map lacks its
    own class, so its keywords come from its title."""
    d = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    cls = F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(F.lit("other"))
    maps = F.to_json(F.create_map(cls, F.create_map(F.col("lang"), (F.col("n_chars") % 100) / 100.0)))
    e = F.lit("")
    lines = d.select(F.col("doc_id").cast("string").alias("f0"), e.alias("f1"),
                     F.regexp_replace(F.coalesce("text", e), "[\r\n]", " ").alias("f2"), e.alias("f3"), e.alias("f4"),
                     F.lit(fx.AS_OF_TEXT).alias("f5"), F.col("source").alias("f6"), e.alias("f7"), maps.alias("f8"))
    path = wr.write_delimited(lines, scratch_path(spark, "catalogue"), "&")
    return tx.catalogue_scores(rd.read_catalogue(spark, path), 10)


def q_hashing_tfidf(spark, sf_dir):
    return tx.hashing_tfidf(_documents(spark, sf_dir), 20)


def q_count_tfidf(spark, sf_dir):
    return tx.count_tfidf(_documents(spark, sf_dir), 5)


def q_word2vec_vectors(spark, sf_dir):
    return tx.word2vec_vectors(_documents(spark, sf_dir))


# ------------------------------------------------------------ sources and sinks

def q_parse_raw_log(spark, sf_dir):
    return rd.read_raw_log(fx.raw_log_lines(fx.log(spark, sf_dir)))


def q_format_user_log(spark, sf_dir):
    """S3: raw lines -> parsed -> crawler filter -> parquet (fresh path) -> read."""
    parsed = flt.bot_filter(rd.read_raw_log(fx.raw_log_lines(fx.log(spark, sf_dir))))
    path = wr.write_parquet(parsed, scratch_path(spark, "formatted-log"))
    return spark.read.parquet(path)


def q_read_portrait_text(spark, sf_dir):
    """S4 round trip: the wide portrait written as '&' text and read back."""
    path = wr.write_delimited(q_portrait_wide(spark, sf_dir), scratch_path(spark, "portrait-text"), "&")
    return rd.read_portrait_text(spark, path, "&")


def _guest_wide(spark, sf_dir):
    """The guest portrait in the 14-column legacy layout (score maps as JSON)."""
    _, new = _old_new(spark, sf_dir)
    g = pt.guest_portrait(_old_guest_scores(spark, sf_dir), flt.guests(new), AS_OF)
    js = pt.guest_scores_json(g)
    cols = {"UserID": F.substring(F.col("user"), 2, 64).try_cast("long"), "UserName": F.col("user"),
            "Age": F.lit(0), "Gender": F.lit(0), "SingleArticleInterest": F.col("SingleArticleInterest"),
            "latest_log_time": F.lit(fx.AS_OF_TEXT), "LawOfworkAndRest": F.lit(""), "Area": F.lit("")}
    return js.select(*[(cols[c] if c in cols else F.lit("")).alias(c) for c in GUEST_COLUMNS])


def q_read_guest_portrait(spark, sf_dir):
    """S5 round trip: guest portrait as '&' text, read back with the run time."""
    path = wr.write_delimited(_guest_wide(spark, sf_dir), scratch_path(spark, "guest-text"), "&")
    return rd.read_guest_portrait(spark, path, fx.AS_OF_TEXT, "&")


def q_portrait_reproject(spark, sf_dir):
    """legacy guest portrait text re-read into the current 16 columns."""
    path = wr.write_delimited(_guest_wide(spark, sf_dir), scratch_path(spark, "guest-text"), "&")
    legacy = rd.read_guest_portrait(spark, path, fx.AS_OF_TEXT, "&")
    defaults = {c: F.lit("{}") for c in PORTRAIT_COLUMNS}
    return rd.reproject(legacy, PORTRAIT_COLUMNS, defaults)


def q_read_related_authors(spark, sf_dir):
    """S6 round trip: the two author maps of the wide portrait as '&' text."""
    wide = q_portrait_wide(spark, sf_dir).select("UserName", "TotalRelatedAuthor", "RecentRelatedAuthor")
    path = wr.write_delimited(wide, scratch_path(spark, "authors-text"), "&")
    return rd.read_related_authors(spark, path, "&")


def q_read_preference_portrait(spark, sf_dir):
    """S15/R5 round trip: the stored keyword interests as the recommender's
    ';' text (score map JSON), read back and flattened to (id, module,
    keyword, score)."""
    kw = _old_portrait(spark, sf_dir, [DIM_TOTAL_INTEREST])
    per_mod = kw.groupBy("user", "module").agg(F.array_sort(F.collect_list(F.struct(
        F.col("tag").alias("k"), J.score_entry(F.col("tag"), F.col("weight")).alias("e")))).alias("es"))
    mod_e = F.concat(J.json_string(F.col("module")), F.lit(":"), J.object_of(F.col("es")))
    per_user = per_mod.groupBy("user").agg(F.array_sort(F.collect_list(F.struct(
        F.col("module").alias("k"), mod_e.alias("e")))).alias("ms"))
    text = per_user.select(F.col("user").alias("id"), F.col("user").alias("name"),
                           J.object_of(F.col("ms")).alias("prefList"), F.lit(fx.AS_OF_TEXT).alias("t"))
    path = wr.write_delimited(text, scratch_path(spark, "pref-text"), ";")
    back = rd.read_preference_portrait(spark, path, ";")
    m = back.select("id", F.explode("prefList").alias("module", "kws"))
    return m.select("id", "module", F.explode("kws").alias("keyword", "score"))


def q_read_raw_catalogue(spark, sf_dir):
    """S17 round trip: every document as one '::' catalogue line (id, lang,
    lang/source title, whole text with line breaks blanked, two fillers,
    source as class, length), written as text and read back."""
    d = load(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    body = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), "[\r\n]", " ")
    line = F.concat_ws("::", F.col("doc_id").cast("string"), F.col("lang"),
                       F.concat_ws("/", F.col("lang"), F.col("source")), body, F.lit("a"), F.lit("b"),
                       F.col("source"), F.col("n_chars").cast("string"))
    path = scratch_path(spark, "catalogue-text")
    d.select(line.alias("value")).write.mode("overwrite").text(path)
    return rd.read_raw_catalogue(spark, path)


def q_log_to_cells(spark, sf_dir):
    return wr.log_to_cells(formatted_log(spark, sf_dir))


def q_customer_cells(spark, sf_dir):
    """Any rows as sorted cells."""
    return wr.rows_to_cells(load(spark, sf_dir, "customer"), F.col("c_custkey").cast("string"),
                            ["c_name", "c_mktsegment", "c_nationkey"], "info")


# Fixed values of the range-scan check: keys from '4' up to (not including) '8'.
RANGE_LO, RANGE_HI = "4", "8"


_CELLS: dict[tuple, str] = {}


def q_cell_range_scan(spark, sf_dir):
    """Range scan of the stored cell table (written once, sorted, with its
    key index); only the files of the range are read."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _CELLS:
        _CELLS[k] = wr.write_cells(wr.log_to_cells(formatted_log(spark, sf_dir)), scratch_path(spark, "cells"))
    return rd.read_cell_range(spark, _CELLS[k], RANGE_LO, RANGE_HI, wr.CELL_QUALIFIERS)


def q_file_keywords(spark, sf_dir):
    """A document per source, its texts in as many text files as were
    written, read in splits; the 25 best keywords of each."""
    d = load(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("none")).alias("source"),
                                                F.coalesce("text", F.lit("")).alias("value"))
    path = scratch_path(spark, "files")
    d.write.partitionBy("source").text(path)
    lines = rd.read_file_lines(spark, path)
    lines = lines.select(F.regexp_extract("file_path", "source=([^/]+)/", 1).alias("doc_id"), F.col("value").alias("text"))
    return tx.line_keywords(lines, spark.read.text(path).select("source").distinct().count(), 25)


def q_read_ratings(spark, sf_dir):
    """Ratings as CSV, some lines of which do not parse, read back."""
    r = _ratings(spark, sf_dir)
    bad = F.when(F.col("event_id") % 50 == 0, F.lit("x")).otherwise(F.col("user_id").cast("string"))
    path = wr.write_delimited(r.select(bad.alias("u"), "item_id", "rating"), scratch_path(spark, "ratings"), ",")
    return rd.read_ratings(spark, path).select("user_id", "item_id", F.round(F.col("rating").cast("double"), 4).alias("rating"))


# Fixed value: the key glob of the key-value scan.
KEY_GLOB = "Mozilla/5.0+*"


def q_key_pattern_scan(spark, sf_dir):
    return rd.key_pattern_scan(fx.user_agent_store(fx.log(spark, sf_dir)), KEY_GLOB)


def q_ua_daily_export(spark, sf_dir):
    """K4: daily user-agent counts written one directory per date (sorted by
    count inside), read back with the date from the directory names."""
    counts = q_ua_daily_counts(spark, sf_dir)
    path = wr.write_partitioned_by_date(counts, scratch_path(spark, "ua-daily"), "date", "count")
    back = spark.read.csv(path, schema="userAgent string, count int, date string", sep=",")
    return back.select("date", "userAgent", "count")


_published = [0]


def q_publish_location(spark, sf_dir):
    """K5: yesterday's ranking is published, then the table is switched to
    today's ranking at a new dated path; the query reads the table."""
    old, new = _old_new(spark, sf_dir)
    p1 = wr.write_parquet(st.resource_ranking(old, "article", 100), scratch_path(spark, "ranking-d1"))
    p2 = wr.write_parquet(st.resource_ranking(new, "article", 100), scratch_path(spark, "ranking-d2"))
    _published[0] += 1
    name = f"tagfold_article_ranking_{_published[0]}"
    wr.publish_location(spark, name, p1)
    wr.publish_location(spark, name, p2)
    return spark.table(name)


def q_publish_partitioned(spark, sf_dir):
    """K5/K6: visits by partition, published and then switched to the new
    log's; the partitions' names are text that has to survive (a leading zero,
    a blank and a colon, an equals sign, none at all)."""
    label = (F.when(F.col("ro") == "article", F.lit("01")).when(F.col("ro") == "tushu", F.when(
        F.col("ac") == "buy", F.lit("a b:c")).otherwise(F.lit("x=y"))))
    paths = []
    for lg in _old_new(spark, sf_dir):
        visits = lg.groupBy(label.alias("label"), "ri").agg(F.count(F.lit(1)).alias("visits"))
        paths.append(wr.write_parquet(visits, scratch_path(spark, "visits"), ["label"]))
    _published[0] += 1
    name = f"tagfold_visits_{_published[0]}"
    for path in paths:
        wr.publish_location(spark, name, path)
    return spark.table(name).select("label", "ri", "visits")


# ------------------------------------------------------------ recommendation

def _ratings(spark, sf_dir):
    """R1 input: events as (user, item = props.k, rating = value)."""
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "props", "value")
    item = F.get_json_object("props", "$.k").try_cast("int")
    return e.select("event_id", F.col("user_id").cast("int").alias("user_id"), item.alias("item_id"),
                    F.col("value").cast("float").alias("rating")).where(F.col("item_id").isNotNull())


def _als(spark, sf_dir):
    """Model trained once per application and kept under the shared folder
    (S22: a later query loads it instead of training again)."""
    train, test = rc.hash_split(_ratings(spark, sf_dir), "event_id")
    key = f"als:{sf_dir}"
    if key not in _MODELS:
        _MODELS[key] = scratch_path(spark, "als-model")
    return rc.load_or_train(_MODELS[key], train), test


_MODELS: dict[str, str] = {}


def q_als_rmse(spark, sf_dir):
    model, test = _als(spark, sf_dir)
    return rc.als_rmse(model, test)


def q_als_recommend(spark, sf_dir):
    """R2 over the held-out (user, item) pairs as candidates."""
    model, test = _als(spark, sf_dir)
    names = load(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("item_id"),
                                                F.col("p_name").alias("item_name"))
    # The id map as text
    names = rd.read_id_map(spark, wr.write_delimited(names, scratch_path(spark, "names"), ","), "item_id", "item_name")
    return rc.als_recommend(model, test, names, 10)


def q_als_top_items(spark, sf_dir):
    """The ten best of all items for every user of the model, names
    attached."""
    model, _ = _als(spark, sf_dir)
    names = load(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("item_id"), F.col("p_name").alias("item_name"))
    return rc.als_top_items(model, names, 10)


def q_similar_items(spark, sf_dir):
    """M7 over the embeddings: the ten most similar other vectors of each."""
    e = load(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    return tk.similar_items(e, 10)


def q_similar_parts(spark, sf_dir):
    """M7 over vectors of three numbers, the reference's size: a part's order
    lines, mean quantity and mean discount, each against the mean of all."""
    li = load(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_discount")
    per = li.groupBy(F.col("l_partkey").alias("id")).agg(
        F.count(F.lit(1)).cast("double").alias("c"), F.sum(F.col("l_quantity").cast("double")).alias("q"),
        F.sum((F.col("l_discount") * 100).cast("double")).alias("d"))
    vec = F.array(F.round(F.col("c") / 10 - 3, 6), F.round(F.col("q") / F.col("c") - 25, 6), F.round(F.col("d") / F.col("c") - 5, 6))
    return tk.similar_items(per.select("id", vec.alias("vec")), 10)


def q_content_match(spark, sf_dir):
    """R3 over the new log's (user, article) reads, scored against the
    stored keyword-interest portrait."""
    _, new = _old_new(spark, sf_dir)
    reads = new.where(pt.is_article_read() & (F.col("un") != ""))
    pairs = reads.select(F.regexp_replace("un", '[ "]', "").alias("user"), F.col("ri").alias("item")).distinct()
    items = formatted_log(spark, sf_dir).select(F.col("ri").alias("item"), "rcc", "rkd").distinct()
    return rc.content_match(pairs, _old_portrait(spark, sf_dir, [DIM_TOTAL_INTEREST]), items)


def q_content_recommend(spark, sf_dir):
    """R4's tail over R3's given pairs: articles a user had read before the
    split are dropped, as are those the user bought since (recommended before);
    the ten best stay."""
    old, new = _old_new(spark, sf_dir)
    pair = lambda lg: (lg.where(F.col("un") != "")
                       .select(F.regexp_replace("un", '[ "]', "").alias("user"), F.col("ri").alias("item")).distinct())
    seen = pair(old.where(pt.is_article_read()))
    bought = pair(new.where(F.col("ac") == "buy"))
    return rc.recommend_unseen(q_content_match(spark, sf_dir), seen, bought, 10)


def q_content_catalogue(spark, sf_dir):
    """R4 over the whole catalogue: the ten best articles per user by shared
    keywords, but those read before the split or bought since."""
    old, new = _old_new(spark, sf_dir)
    pair = lambda lg: (lg.where(F.col("un") != "")
                       .select(F.regexp_replace("un", '[ "]', "").alias("user"), F.col("ri").alias("item")))
    hidden = pair(old.where(pt.is_article_read())).unionByName(pair(new.where(F.col("ac") == "buy")))
    items = formatted_log(spark, sf_dir).select(F.col("ri").alias("item"), "rcc", "rkd").distinct()
    return rc.recommend_from_catalogue(_old_portrait(spark, sf_dir, [DIM_TOTAL_INTEREST]), items, hidden, 10)


QUERIES = {
    "article_ranking": q_article_ranking,
    "book_ranking": q_book_ranking,
    "top_articles_by_type": q_top_articles_by_type,
    "normalize_type": q_normalize_type,
    "journal_purchase_stats": q_journal_purchase_stats,
    "ua_daily_counts": q_ua_daily_counts,
    "user_category_tags": q_user_category_tags,
    "bot_filter": q_bot_filter,
    "log_quality_counts": q_log_quality_counts,
    "distinct_users": q_distinct_users,
    "log_keyword_interests": q_log_keyword_interests,
    "log_subjects": q_log_subjects,
    "log_subsubjects": q_log_subsubjects,
    "log_authors": q_log_authors,
    "log_search_words": q_log_search_words,
    "decay_factor": q_decay_factor,
    "decay_recent_interest": q_decay_recent_interest,
    "decay_recent_author": q_decay_recent_author,
    "decay_guest_flat": q_decay_guest_flat,
    "decay_guest_nested": q_decay_guest_nested,
    "portrait_interest_merge": q_portrait_interest_merge,
    "portrait_subject_merge": q_portrait_subject_merge,
    "portrait_subsubject_merge": q_portrait_subsubject_merge,
    "portrait_author_merge": q_portrait_author_merge,
    "portrait_search_merge": q_portrait_search_merge,
    "new_users": q_new_users,
    "new_guests": q_new_guests,
    "portrait_update": q_portrait_update,
    "portrait_fold": q_portrait_fold,
    "portrait_wide": q_portrait_wide,
    "serving_portrait": q_serving_portrait,
    "guest_portrait": q_guest_portrait,
    "legacy_keyword_portrait": q_legacy_keyword_portrait,
    "initial_roster": q_initial_roster,
    "tfidf_keywords": q_tfidf_keywords,
    "catalog_keywords": q_catalog_keywords,
    "read_catalogue": q_read_catalogue,
    "hashing_tfidf": q_hashing_tfidf,
    "count_tfidf": q_count_tfidf,
    "word2vec_vectors": q_word2vec_vectors,
    "parse_raw_log": q_parse_raw_log,
    "format_user_log": q_format_user_log,
    "read_portrait_text": q_read_portrait_text,
    "read_guest_portrait": q_read_guest_portrait,
    "portrait_reproject": q_portrait_reproject,
    "read_related_authors": q_read_related_authors,
    "read_preference_portrait": q_read_preference_portrait,
    "read_raw_catalogue": q_read_raw_catalogue,
    "log_to_cells": q_log_to_cells,
    "customer_cells": q_customer_cells,
    "cell_range_scan": q_cell_range_scan,
    "key_pattern_scan": q_key_pattern_scan,
    "file_keywords": q_file_keywords,
    "read_ratings": q_read_ratings,
    "publish_location": q_publish_location,
    "publish_partitioned": q_publish_partitioned,
    "ua_daily_export": q_ua_daily_export,
    "als_rmse": q_als_rmse,
    "als_recommend": q_als_recommend,
    "content_match": q_content_match,
    "content_recommend": q_content_recommend,
    "content_catalogue": q_content_catalogue,
    "als_top_items": q_als_top_items,
    "similar_items": q_similar_items,
    "similar_parts": q_similar_parts,
}
