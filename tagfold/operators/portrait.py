"""User-portrait operators.

Canonical model: the long form ``(user, dim, module, tag, weight, last_ms)``
(``module`` is '' for the flat dimensions). Old portrait plus new log is one
``unionByName`` and ONE ``groupBy(user, dim, module, tag)`` whose partial
aggregate combines map-side, so a user holding a third of the log still
shuffles at most one row per distinct tag per map task. Windows run only
on aggregated portraits, where a user's group is bounded by the tag
vocabulary rather than by the log volume: decay with pruning shares one
``repartition(user, dim)``, truncation and JSON packing share one
``repartition(user)`` (a packed row is one value per user anyway).

Canonical order of a portrait (the reference keeps insertion order, which a
distributed plan cannot carry): modules by total weight desc then code, tags
by weight desc then tag. Module totals are rounded to 4 decimals before
ordering so that engines summing in different orders agree.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsonmaps as J
from ..functions.decay import (BASE_COEFFICIENT, MIN_KEYWORDS_COUNT, MIN_WEIGHT, PERIOD_DAYS,
                               coefficient_power, decay_factor, floor_and_round, whole_days)
from ..functions.tags import (ARTICLE_ACTIONS, AUTHOR_STOP_NAMES, action_weight, author_names,
                              clean_user, interest_keywords, interest_modules, java_split,
                              subject_codes, subsubject_codes)
from ..sinks.writers import write_bucketed
from ..schemas import (DIM_RECENT_AUTHOR, DIM_RECENT_INTEREST, DIM_SEARCH, DIM_SUBJECT,
                       DIM_SUBSUBJECT, DIM_TOTAL_AUTHOR, DIM_TOTAL_INTEREST, DIMS, GUEST_COLUMNS,
                       NESTED_DIMS, PORTRAIT_COLUMNS, TAG_COLUMNS)

KEYS = ["user", "dim", "module", "tag"]
_TAG_T = "array<struct<dim:string,module:string,tag:string>>"


# ---------------------------------------------------------------- extraction

def is_article_read() -> Column:
    return ((F.col("ro") == "article") & (F.coalesce(F.col("rcc"), F.lit("")) != "")
            & F.col("ac").isin(ARTICLE_ACTIONS))


def _is_search() -> Column:
    return (F.col("ac") == "search") & (F.coalesce(F.col("sw"), F.lit("")) != "")


def log_tag_rows(log: DataFrame, dims=DIMS, stop_names=AUTHOR_STOP_NAMES,
                 weighted: bool = True) -> DataFrame:
    """T1-T5 in one pass: one row per (log row, dim, module, tag).

    Article reads give keyword interests (total and recent), subjects,
    sub-subjects and authors (total and recent); searches give search
    keywords. Each (dim, module, tag) occurs at most once per log row.
    The user name is cleaned of blanks and quotes here, once.
    """
    art, srch = is_article_read(), _is_search()
    empty = F.array().cast(_TAG_T)

    def nested(dim: str) -> Column:
        mods, kws = interest_modules(F.col("rcc")), interest_keywords(F.col("rkd"))
        pairs = F.flatten(F.transform(mods, lambda m: F.transform(
            kws, lambda k: F.struct(F.lit(dim).alias("dim"), m.alias("module"), k.alias("tag")))))
        return F.when(art, pairs).otherwise(empty)

    def flat(dim: str, arr: Column, cond: Column) -> Column:
        entries = F.transform(arr, lambda x: F.struct(F.lit(dim).alias("dim"), F.lit("").alias("module"),
                                                      x.alias("tag")))
        return F.when(cond, entries).otherwise(empty)

    builders = {
        DIM_TOTAL_INTEREST: lambda: nested(DIM_TOTAL_INTEREST),
        DIM_RECENT_INTEREST: lambda: nested(DIM_RECENT_INTEREST),
        DIM_SUBJECT: lambda: flat(DIM_SUBJECT, subject_codes(F.col("rcc")), art),
        DIM_SUBSUBJECT: lambda: flat(DIM_SUBSUBJECT, subsubject_codes(F.col("rcc")), art),
        DIM_TOTAL_AUTHOR: lambda: flat(DIM_TOTAL_AUTHOR, author_names(F.col("au"), stop_names), art),
        DIM_RECENT_AUTHOR: lambda: flat(DIM_RECENT_AUTHOR, author_names(F.col("au"), stop_names), art),
        DIM_SEARCH: lambda: flat(DIM_SEARCH, F.array(F.col("sw")), srch),
    }
    arrays = [builders[d]() for d in dims]
    tags = arrays[0] if len(arrays) == 1 else F.concat(*arrays)
    need_art = any(d != DIM_SEARCH for d in dims)
    need_srch = DIM_SEARCH in dims
    cond = (art if need_art else F.lit(False)) | (srch if need_srch else F.lit(False))
    w = action_weight(F.col("ac")) if weighted else F.lit(1.0)
    rows = (log.where(F.coalesce(F.col("un"), F.lit("")) != "").where(cond)
            .select(clean_user(F.col("un")).alias("user"), w.alias("weight"),
                    F.col("vt_ms").alias("last_ms"), F.explode(tags).alias("t")))
    return rows.where(F.col("user") != "").select(
        "user", "t.dim", "t.module", "t.tag", "weight", "last_ms")


def aggregate_tags(rows: DataFrame) -> DataFrame:
    """A7/A8 merge: weights added, last-seen = latest, per (user, dim, module,
    tag). Weights are 4-decimal values; the sum is rounded back to 4 places
    so that it does not depend on the order partial sums are combined in."""
    return rows.groupBy(*KEYS).agg(F.round(F.sum("weight"), 4).alias("weight"),
                                   F.max("last_ms").alias("last_ms"))


def log_portrait(log: DataFrame, dims=DIMS, stop_names=AUTHOR_STOP_NAMES,
                 weighted: bool = True) -> DataFrame:
    """The portrait contributed by a log alone (long form)."""
    return aggregate_tags(log_tag_rows(log, dims, stop_names, weighted))


def merge_portraits(*frames: DataFrame) -> DataFrame:
    """Old portrait(s) + log portrait -> new portrait, one aggregate."""
    u = frames[0].select(*TAG_COLUMNS)
    for f in frames[1:]:
        u = u.unionByName(f.select(*TAG_COLUMNS))
    return aggregate_tags(u)


# ---------------------------------------------------------------- decay

def decay_recent_interest(tags: DataFrame, as_of_ms: int, min_weight: float = MIN_WEIGHT,
                          min_keywords: int = MIN_KEYWORDS_COUNT,
                          fraction: float | None = None) -> DataFrame:
    """``w' = round4(max-floor(w * f30(days since last seen)))``; then tags
    with ``w' < min_weight`` are removed in portrait order while the user's
    remaining tag count minus one exceeds ``min_keywords``. ``last_ms`` is
    kept. ``fraction`` (default ``min_weight``, as in the reference) is the
    share left after one 30-day period.

    The sequential rule equals a rank rule: with ``h`` tags kept anyway,
    exactly the LAST ``max(0, min_keywords + 1 - h)`` low tags (in portrait
    order: modules by total weight desc then code, tags by weight desc then
    tag) survive. Module totals and ``h`` are partial aggregates; only low tags
    are ranked, and as at most ``min_keywords + 1`` of a user survive, the rank
    filter trims them before the window's exchange.
    """
    fraction = min_weight if fraction is None else fraction
    keep_n = min_keywords + 1
    w2 = floor_and_round(F.col("weight") * decay_factor(
        whole_days(as_of_ms, F.col("last_ms")), PERIOD_DAYS, fraction))
    t = tags.select(*TAG_COLUMNS).withColumn("w2", w2).withColumn("low", F.col("w2") < F.lit(min_weight))
    high, low = t.where(~F.col("low")), t.where(F.col("low"))
    totals = t.groupBy("user", "dim", "module").agg(F.round(F.sum("weight"), 4).alias("mw"))
    kept_anyway = high.groupBy("user", "dim").agg(F.count(F.lit(1)).alias("h"))
    last = Window.partitionBy("user", "dim").orderBy(F.asc("mw"), F.desc("module"), F.asc("weight"), F.desc("tag"))
    ranked = (low.join(totals, ["user", "dim", "module"]).withColumn("rn", F.row_number().over(last))
              .where(F.col("rn") <= keep_n).join(kept_anyway, ["user", "dim"], "left")
              .where(F.col("rn") <= F.lit(keep_n) - F.coalesce("h", F.lit(0))))
    out = [*KEYS, F.col("w2").alias("weight"), "last_ms"]
    return high.select(*out).unionByName(ranked.select(*out))


def decay_recent_author(tags: DataFrame, as_of_ms: int, fraction: float = MIN_WEIGHT) -> DataFrame:
    """Same factor and floor, last seen := as_of, nothing removed."""
    w2 = floor_and_round(F.col("weight") * decay_factor(
        whole_days(as_of_ms, F.col("last_ms")), PERIOD_DAYS, fraction))
    return tags.select(*KEYS, w2.alias("weight"), F.lit(int(as_of_ms)).cast("long").alias("last_ms"))


def decay_guest_flat(scores: DataFrame, as_of_ms: int, coefficient: float = BASE_COEFFICIENT,
                     min_weight: float = MIN_WEIGHT) -> DataFrame:
    """``score * c^max(1, days since the portrait's last log)``; scores
    below ``min_weight`` dropped; no rounding. Needs ``latest_ms``."""
    f = coefficient_power(whole_days(as_of_ms, F.col("latest_ms")), coefficient)
    out = scores.withColumn("score", F.col("score") * f)
    return out.where(F.col("score") >= F.lit(min_weight))


def decay_guest_nested(tags: DataFrame, as_of_ms: int, coefficient: float = BASE_COEFFICIENT,
                       min_weight: float = MIN_WEIGHT) -> DataFrame:
    """P5: ``round4(w * c^max(1, days))``, below ``min_weight`` dropped (empty
    modules vanish with their last tag). Needs ``latest_ms``."""
    f = coefficient_power(whole_days(as_of_ms, F.col("latest_ms")), coefficient)
    out = tags.withColumn("weight", F.round(F.col("weight") * f, 4))
    return out.where(F.col("weight") >= F.lit(min_weight))


def decay_portrait(tags: DataFrame, as_of_ms: int, min_weight: float = MIN_WEIGHT,
                   min_keywords: int = MIN_KEYWORDS_COUNT) -> DataFrame:
    """Decay the two "recent" dimensions of a stored portrait, keep the rest."""
    recent_i = tags.where(F.col("dim") == DIM_RECENT_INTEREST)
    recent_a = tags.where(F.col("dim") == DIM_RECENT_AUTHOR)
    others = tags.where(~F.col("dim").isin(DIM_RECENT_INTEREST, DIM_RECENT_AUTHOR)).select(*TAG_COLUMNS)
    return (others.unionByName(decay_recent_interest(recent_i, as_of_ms, min_weight, min_keywords))
            .unionByName(decay_recent_author(recent_a, as_of_ms, min_weight)))


# ---------------------------------------------------------------- users

def log_users(log: DataFrame, column: str = "un") -> DataFrame:
    """Distinct cleaned, non-empty names of a log."""
    u = clean_user(F.col(column)) if column == "un" else F.coalesce(F.col(column), F.lit(""))
    return log.select(u.alias("user")).where(F.col("user") != "").distinct()


def new_users(known: DataFrame, log: DataFrame, column: str = "un") -> DataFrame:
    """P6/P7 + J7: names in the log that the portrait does not know yet.
    ``known`` has a ``user`` column (cleaned the same way)."""
    k = known.select(clean_user(F.col("user")).alias("user")) if column == "un" else known.select("user")
    return log_users(log, column).join(k.where(F.col("user") != ""), "user", "left_anti")


# ---------------------------------------------------------------- full update

def portrait_update(old_tags: DataFrame, log: DataFrame, as_of_ms: int,
                    stop_names=AUTHOR_STOP_NAMES, min_weight: float = MIN_WEIGHT,
                    min_keywords: int = MIN_KEYWORDS_COUNT) -> DataFrame:
    """Decay the stored portrait, add the log's tags, merge (long form)."""
    decayed = decay_portrait(old_tags, as_of_ms, min_weight, min_keywords)
    return merge_portraits(decayed, log_tag_rows(log, DIMS, stop_names))


def decay_in_place(tags: DataFrame, as_of_ms: int, min_weight: float = MIN_WEIGHT,
                   min_keywords: int = MIN_KEYWORDS_COUNT) -> DataFrame:
    """P2/P3 in one pass over a portrait whose rows of a user lie together: the
    rows of ``decay_portrait``, with windows over users where that one joins
    aggregates. Windows need rows by user only, so a portrait bucketed by user
    is not shuffled."""
    recent, author = F.col("dim") == DIM_RECENT_INTEREST, F.col("dim") == DIM_RECENT_AUTHOR
    w2 = floor_and_round(F.col("weight") * decay_factor(
        whole_days(as_of_ms, F.col("last_ms")), PERIOD_DAYS, min_weight))
    low = recent & (F.col("w2") < F.lit(min_weight))
    module, dim = Window.partitionBy("user", "dim", "module"), Window.partitionBy("user", "dim")
    last = Window.partitionBy("user", "dim", "low").orderBy(F.asc("mw"), F.desc("module"), F.asc("weight"), F.desc("tag"))
    t = (tags.select(*TAG_COLUMNS).withColumn("w2", w2).withColumn("low", low)
         .withColumn("mw", F.round(F.sum("weight").over(module), 4)).withColumn("h", F.count_if(~F.col("low")).over(dim))
         .withColumn("rn", F.row_number().over(last)))
    kept = t.where(~F.col("low") | (F.col("rn") <= F.lit(min_keywords + 1) - F.col("h")))
    return kept.select(*KEYS, F.when(recent | author, F.col("w2")).otherwise(F.col("weight")).alias("weight"),
                       F.when(author, F.lit(int(as_of_ms)).cast("long")).otherwise(F.col("last_ms")).alias("last_ms"))


@contextmanager
def bucket_joins(spark):
    """Plans made inside may join on (user, ...) where both sides are dealt by
    user alone; otherwise Spark deals both anew by all the keys."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def fold_portrait(stored: DataFrame, log: DataFrame, as_of_ms: int, buckets: int, stop_names=AUTHOR_STOP_NAMES,
                  min_weight: float = MIN_WEIGHT, min_keywords: int = MIN_KEYWORDS_COUNT) -> DataFrame:
    """P8 without moving the stored portrait: ``stored`` is a table bucketed by
    user into ``buckets``. Only the day's log is aggregated and dealt into the
    same buckets; decay and merge (a full outer join of the two portraits) run
    bucket by bucket. To be planned inside ``bucket_joins``."""
    day = log_portrait(log, DIMS, stop_names).repartition(buckets, "user")
    day = day.select(*[F.col(c).alias(f"_{c}") for c in TAG_COLUMNS])
    old = decay_in_place(stored, as_of_ms, min_weight, min_keywords)
    j = old.join(day, [F.col(k) == F.col(f"_{k}") for k in KEYS], "full_outer")
    zero = F.lit(0.0)
    return j.select(*[F.coalesce(k, f"_{k}").alias(k) for k in KEYS],
                    F.round(F.coalesce("weight", zero) + F.coalesce("_weight", zero), 4).alias("weight"),
                    F.greatest("last_ms", "_last_ms").alias("last_ms"))


def fold_and_store(stored: DataFrame, log: DataFrame, as_of_ms: int, table: str, path: str, buckets: int, **rules) -> DataFrame:
    """The daily job: fold ``log`` into the bucketed portrait ``stored`` and
    write the next one, in the same buckets, as ``table`` at ``path``. A task
    reads a bucket and writes it; only the log is shuffled."""
    with bucket_joins(stored.sparkSession):
        return write_bucketed(fold_portrait(stored, log, as_of_ms, buckets, **rules), table, path, "user", buckets, KEYS, dealt=True)


# ---------------------------------------------------------------- packing

def _packed(tags: DataFrame) -> DataFrame:
    """Long form -> (user, dim, json) in canonical order, built per module and
    only put together per dimension and user:
    tags by weight desc then tag; modules of a nested dimension by total
    weight desc then code (``mw`` when the rows carry the total of their
    untruncated module, else the sum of the given rows). A flat dimension
    has the single module ''."""
    entry = J.tag_entry(F.col("tag"), F.col("weight"), F.col("last_ms"))
    total = F.max("mw") if "mw" in tags.columns else F.round(F.sum("weight"), 4)
    per_mod = tags.groupBy("user", "dim", "module").agg(
        total.alias("mw"),
        F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("k1"), F.col("tag").alias("k2"),
                                             entry.alias("e")))).alias("es"))
    inner = J.object_of(F.col("es"))
    per_mod = per_mod.select("user", "dim", "module", "mw", inner.alias("inner"))
    mod_entry = F.concat(J.json_string(F.col("module")), F.lit(":"), F.col("inner"))
    per_dim = per_mod.groupBy("user", "dim").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("mw")).alias("k1"), F.col("module").alias("k2"), mod_entry.alias("e"),
        F.col("inner").alias("inner")))).alias("ms"))
    json = (F.when(F.col("dim").isin(NESTED_DIMS), J.object_of(F.col("ms")))
            .otherwise(F.get(F.col("ms"), 0)["inner"]))
    return per_dim.select("user", "dim", json.alias("json"))


def pack_portrait(tags: DataFrame) -> DataFrame:
    """Long form -> (user, dim, json) in canonical order."""
    return _packed(tags.select(*TAG_COLUMNS))


def _wide(users: DataFrame, packed: DataFrame) -> DataFrame:
    piv = packed.groupBy("user").agg(*[
        F.max(F.when(F.col("dim") == d, F.col("json"))).alias(d) for d in DIMS])
    return users.select("user").join(piv, "user", "left")


def portrait_wide(users: DataFrame, tags: DataFrame, latest_log_time: str) -> DataFrame:
    """One row per user in the 16-column portrait layout, '{}' for an
    empty dimension (left join; users without tags are kept)."""
    w = _wide(users, pack_portrait(tags))
    cols = {"UserName": F.col("user"), "LawOfworkAndRest": F.lit(""), "Area": F.lit(""),
            "Age": F.lit(0), "Gender": F.lit(0), "JournalsInterests": F.lit("{}"),
            "ReferenceBookInterests": F.lit("{}"), "CustomerPurchasingPowerInterests": F.lit("{}"),
            "latest_log_time": F.lit(latest_log_time)}
    for d in DIMS:
        cols[d] = F.coalesce(F.col(d), F.lit("{}"))
    return w.select(*[cols[c].alias(c) for c in PORTRAIT_COLUMNS])


def truncate_portrait(tags: DataFrame, n: int = 3) -> DataFrame:
    """First n tags of each flat dimension; first n modules of each
    nested dimension and first n tags within each kept module (a flat
    dimension is the single module '', so one rule covers both). Rows carry
    ``mw``, the total of their whole module, which keeps the module order of
    the full portrait when packed. Module totals are a partial aggregate, and
    both cuts are ``row_number() <= n``, which WindowGroupLimit applies before
    its exchange; the full portrait is shuffled once, by module, to join the
    modules that stay."""
    mod_order = Window.partitionBy("user", "dim").orderBy(F.desc("mw"), F.asc("module"))
    tag_order = Window.partitionBy("user", "dim", "module").orderBy(F.desc("weight"), F.asc("tag"))
    t = tags.select(*TAG_COLUMNS)
    mods = (t.groupBy("user", "dim", "module").agg(F.round(F.sum("weight"), 4).alias("mw"))
            .withColumn("mrank", F.row_number().over(mod_order)).where(F.col("mrank") <= n).drop("mrank"))
    top = t.join(mods, ["user", "dim", "module"]).withColumn("trank", F.row_number().over(tag_order))
    return top.where(F.col("trank") <= n).select(*TAG_COLUMNS, "mw")


def serving_portrait(users: DataFrame, tags: DataFrame, latest_log_time: str, n: int = 3) -> DataFrame:
    """P10: truncated portrait for an online store: demographics blanked, a
    flag telling whether any of the seven maps is non-empty."""
    w = _wide(users, _packed(truncate_portrait(tags, n)))
    has = F.greatest(*[F.col(d).isNotNull().cast("int") for d in DIMS])
    cols = [F.col("user").alias("UserName"), F.lit("").alias("LawOfworkAndRest"), F.lit("").alias("Area"),
            F.lit(0).alias("Age"), F.lit(0).alias("Gender")]
    cols += [F.coalesce(F.col(d), F.lit("{}")).alias(d) for d in DIMS]
    cols += [F.lit("").alias("JournalsInterests"), F.lit("").alias("ReferenceBookInterests"),
             F.lit("").alias("CustomerPurchasingPowerInterests"), has.alias("hasPortrait"),
             F.lit(latest_log_time).alias("latest_log_time")]
    return w.select(*cols)


def unpack_portrait(wide: DataFrame) -> DataFrame:
    """Wide portrait (JSON text columns) -> long form."""
    parts = []
    for d in DIMS:
        if d in NESTED_DIMS:
            m = wide.select(F.col("UserName").alias("user"), F.explode(J.nested_tags(F.col(d))).alias("module", "kw"))
            e = m.select("user", "module", F.explode("kw").alias("tag", "v"))
        else:
            e = wide.select(F.col("UserName").alias("user"), F.lit("").alias("module"),
                            F.explode(J.flat_tags(F.col(d))).alias("tag", "v"))
        parts.append(e.select("user", F.lit(d).alias("dim"), "module", "tag",
                              F.col("v.weight").alias("weight"),
                              F.col("v.dateTime").try_cast("long").alias("last_ms")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("user") != "")


# ---------------------------------------------------------------- guests

def guest_visit_counts(guest_log: DataFrame) -> DataFrame:
    """Per (guest cookie, class code) the number of article rows whose
    ``rcc`` lists the code (a code listed twice in one row counts twice;
    codes are cut with JVM split semantics, so an empty code between two
    ';' counts as the reference counts it). A row without a cookie belongs to
    no guest, here as in ``new_users`` over cookies."""
    codes = java_split(F.col("rcc"), ";")
    rows = (guest_log.where((F.col("ro") == "article") & (F.col("rcc") != "") & (F.col("gki") != ""))
            .select(F.col("gki").alias("user"), F.explode(codes).alias("code")))
    return rows.groupBy("user", "code").agg(F.count(F.lit(1)).cast("double").alias("score"))


def guest_portrait(old_scores: DataFrame, new_guest_log: DataFrame, as_of_ms: int,
                   coefficient: float = BASE_COEFFICIENT, min_weight: float = MIN_WEIGHT) -> DataFrame:
    """Stored guest scores decayed (P4), plus visit counts of the new
    guest log (A9); guests left with no score drop out (F13).
    ``old_scores``: (user, code, score, latest_ms). Result: (user, code, score)."""
    decayed = decay_guest_flat(old_scores, as_of_ms, coefficient, min_weight).select("user", "code", "score")
    fresh = guest_visit_counts(new_guest_log)
    return (decayed.unionByName(fresh).groupBy("user", "code").agg(F.sum("score").alias("score")))


def guest_scores_json(scores: DataFrame) -> DataFrame:
    """(user, code, score) -> (user, SingleArticleInterest JSON), scores desc."""
    g = scores.groupBy("user").agg(F.array_sort(F.collect_list(F.struct(
        (-F.round(F.col("score"), 4)).alias("k1"), F.col("code").alias("k2"),
        J.score_entry(F.col("code"), F.col("score")).alias("e")))).alias("es"))
    return g.select("user", J.object_of(F.col("es")).alias("SingleArticleInterest"))


def legacy_keyword_portrait(log: DataFrame) -> DataFrame:
    """A10: +1 per distinct keyword of an article row under each of its
    class codes (full codes, JVM split on ';'), keywords split on comma,
    blank, ';' and '$' after dropping '<', blank and '>' (no case folding)."""
    codes = java_split(F.col("rcc"), ";")
    kws = F.array_distinct(F.filter(F.split(F.regexp_replace(F.coalesce(F.col("rkd"), F.lit("")), "[< >]", ""),
                                            "[, ;$]"), lambda c: c != ""))
    rows = (log.where(is_article_read() & (F.coalesce(F.col("un"), F.lit("")) != ""))
            .select(clean_user(F.col("un")).alias("user"), F.explode(codes).alias("module"), kws.alias("kws"))
            .select("user", "module", F.explode("kws").alias("tag")))
    return (rows.where(F.col("user") != "").groupBy("user", "module", "tag")
            .agg(F.count(F.lit(1)).cast("double").alias("weight")))


# ---------------------------------------------------------------- roster

def initial_roster(named_lines: DataFrame, *name_lists: DataFrame, partitions: int | None = None) -> DataFrame:
    """P11 (U4 + W11): names from a two-field TSV (second field) and plain
    name lists; blanks removed; distinct; ids 0.. in name order; empty
    portraits in the 14-column legacy layout.

    Ids without a single-partition window: names are range-partitioned
    (sampled bounds, so a popular prefix is spread out) and checkpointed so
    both uses below see the same ranges; each range is numbered by
    ``row_number()`` over its own partition id, and the ids are offset by
    the counts of all earlier ranges (a table with one row per range).
    """
    f = F.split(F.col("value"), "\t")
    names = named_lines.select(F.when(F.size(f) == 2, F.get(f, 1)).otherwise(F.lit("")).alias("name"))
    for nl in name_lists:
        names = names.unionByName(nl.select(F.col("value").alias("name")))
    names = names.where(F.trim(F.col("name")) != "").distinct()
    spark = names.sparkSession
    nparts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = names.repartitionByRange(nparts, "name").withColumn("pid", F.spark_partition_id())
    from ..session import checkpoint_dir
    checkpoint_dir(spark)
    ranged = ranged.checkpoint(eager=True)
    numbered = ranged.withColumn("rn", F.row_number().over(Window.partitionBy("pid").orderBy("name")) - 1)
    counts = ranged.groupBy("pid").agg(F.count(F.lit(1)).alias("c"))
    offs = counts.withColumn("off", F.coalesce(F.sum("c").over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # offs has one row per range partition: bounded by the partition count.
    ids = numbered.join(F.broadcast(offs.select("pid", "off")), "pid")
    cols = {"UserID": (F.col("off") + F.col("rn")).cast("long"), "UserName": F.col("name"),
            "Age": F.lit(0), "Gender": F.lit(0)}
    return ids.select(*[(cols[c] if c in cols else F.lit("")).alias(c) for c in GUEST_COLUMNS])
