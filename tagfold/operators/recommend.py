"""Recommendation (R1-R3): MLlib ALS and keyword-overlap content scores.

ALS training is MLlib's blocked alternating least squares (shuffles per
iteration inside MLlib); the train/test split is a hash of the rating's row
identity, so it is the same on every run and every retry. Content scores are
an inverted-index join through shared (module, tag) keys, computed for the
given (user, item) pairs -- never for the user x item product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tags import interest_keywords, interest_modules
from ..session import path_exists, scratch_path
from .topk import top_items


def hash_split(ratings: DataFrame, id_col: str, train_share: int = 8, buckets: int = 10):
    """Deterministic split: rows whose hashed id falls in the first
    ``train_share`` of ``buckets`` buckets train, the rest test."""
    b = F.pmod(F.xxhash64(F.col(id_col)), F.lit(buckets))
    return ratings.where(b < train_share), ratings.where(b >= train_share)


def als_model(train: DataFrame, max_iter: int = 5, reg: float = 0.01, seed: int = 42):
    """ALS(maxIter 5, regParam 0.01), cold-start rows dropped."""
    from pyspark.ml.recommendation import ALS
    als = ALS(maxIter=max_iter, regParam=reg, userCol="user_id", itemCol="item_id", ratingCol="rating",
              coldStartStrategy="drop", seed=seed)
    return als.fit(train)


def load_or_train(path: str, train: DataFrame, **params):
    """Load the ALS model saved at ``path`` when there is one,
    otherwise train it and save it there. A model that is there but cannot be
    loaded is an error and stays as it is."""
    from pyspark.ml.recommendation import ALSModel
    if path_exists(train.sparkSession, path):
        return ALSModel.load(path)
    model = als_model(train, **params)
    model.write().save(path)
    return model


def als_rmse(model, test: DataFrame) -> DataFrame:
    """Test-set RMSE (plus the number of scored rows) as a one-row frame."""
    p = model.transform(test)
    return p.agg(F.sqrt(F.avg(F.pow(F.col("rating") - F.col("prediction"), 2))).alias("rmse"),
                 F.count(F.lit(1)).alias("scored_rows"))


def als_recommend(model, candidates: DataFrame, item_names: DataFrame, k: int = 10) -> DataFrame:
    """The k best of the given (user_id, item_id) candidates per user
    by predicted rating (ties by item), item names attached with a left join
    ('' when unknown). Users and items that the model does not know drop out.
    Only the given pairs are scored, never users x items; WindowGroupLimit
    keeps k rows per user and map task before the exchange."""
    w = Window.partitionBy("user_id").orderBy(F.desc("prediction"), F.asc("item_id"))
    p = model.transform(candidates.select("user_id", "item_id").distinct())
    top = p.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return (top.join(item_names, "item_id", "left")
            .select("user_id", "rank", "item_id", F.col("prediction").alias("score"),
                    F.coalesce(F.col("item_name"), F.lit("")).alias("item_name")))


def als_top_items(model, item_names: DataFrame, k: int = 10) -> DataFrame:
    """The k best of all items for every user of the model by predicted
    rating (six decimals, ties by item), names attached ('' when unknown). The
    factors are searched exactly (``topk``), not crossed."""
    top = top_items(model.userFactors.select(F.col("id").alias("q"), F.col("features").alias("vec")),
                    model.itemFactors.select("id", F.col("features").alias("vec")), k)
    return (top.join(item_names, F.col("id") == F.col("item_id"), "left")
            .select(F.col("q").alias("user_id"), "rank", F.col("id").alias("item_id"), "score",
                    F.coalesce(F.col("item_name"), F.lit("")).alias("item_name")))


def item_tags(items: DataFrame) -> DataFrame:
    """Item keyword map in long form (item, module, tag, weight 1.0) with the
    keyword-interest rule applied to the item's class codes and keywords."""
    mods, kws = interest_modules(F.col("rcc")), interest_keywords(F.col("rkd"))
    pairs = F.flatten(F.transform(mods, lambda m: F.transform(
        kws, lambda k: F.struct(m.alias("module"), k.alias("tag")))))
    return (items.select("item", F.explode(pairs).alias("t"))
            .select("item", "t.module", "t.tag").distinct().withColumn("weight", F.lit(1.0)))


def content_match(pairs: DataFrame, user_tags: DataFrame, items: DataFrame) -> DataFrame:
    """For each (user, item) pair, the sum over shared (module, tag) of
    user weight x item weight; pairs sharing nothing have no row. Rows grow
    with pairs x item keywords; a hot item's keyword rows are joined by AQE
    (broadcast when small, skew-split otherwise)."""
    it = item_tags(items).withColumnRenamed("weight", "iw")
    ut = user_tags.select("user", "module", "tag", F.col("weight").alias("uw"))
    j = pairs.join(it, "item").join(ut, ["user", "module", "tag"])
    return j.groupBy("user", "item").agg(F.round(F.sum(F.col("uw") * F.col("iw")), 4).alias("score"))


def recommend_unseen(scores: DataFrame, seen: DataFrame, already: DataFrame, n: int) -> DataFrame:
    """R4 tail over given (user, item) scores: pairs without a positive score,
    seen by the user or recommended before are dropped; the n best stay, ranked
    (ties by item)."""
    keep = (scores.where(F.col("score") > 0).join(seen.select("user", "item"), ["user", "item"], "left_anti")
            .join(already.select("user", "item"), ["user", "item"], "left_anti"))
    w = Window.partitionBy("user").orderBy(F.desc("score"), F.asc("item"))
    return keep.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("user", "rank", "item", "score")


def _table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder, and a scan of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def catalogue_candidates(user_tags: DataFrame, postings: DataFrame, hidden: DataFrame, n: int) -> DataFrame:
    """(user, item, partial, rest): the items that can be among a user's ``n``
    best, with the weight they collect from the user's essential tags and the
    most that the other tags can add.

    ``postings`` (item, module, tag) is the inverted index. A tag that more
    than ``n`` items have, besides those hidden from the user, gives that many
    the tag's weight, so the n-th score is at least the greatest such weight.
    Tags are taken by impact: the lightest ones that together stay below that
    score cannot make an item on their own, and their lists are not opened for
    candidates. The n-th best partial score then raises the bound once more."""
    lists = postings.groupBy("module", "tag").agg(F.count(F.lit(1)).alias("n_items"))
    out_of = hidden.groupBy("user").agg(F.count(F.lit(1)).alias("n_hidden"))
    tags = user_tags.where(F.col("weight") > 0).select("user", "module", "tag", "weight")
    tags = tags.join(lists, ["module", "tag"]).join(out_of, "user", "left")
    by_user = Window.partitionBy("user")
    sure = F.when(F.col("n_items") >= n + F.coalesce("n_hidden", F.lit(0)), F.col("weight"))
    light = F.sum("weight").over(by_user.orderBy("weight", "module", "tag"))
    tags = tags.select("user", "module", "tag", "weight", light.alias("light"),
                       F.coalesce(F.max(sure).over(by_user), F.lit(0.0)).alias("least"))
    tags = _table(tags.withColumn("essential", F.col("light") >= F.col("least") - SLACK), "impact_tags")
    user = tags.groupBy("user").agg(F.first("least").alias("least"),
                                    F.sum(F.when(~F.col("essential"), F.col("weight")).otherwise(0.0)).alias("rest"))
    part = (tags.where("essential").join(postings, ["module", "tag"]).groupBy("user", "item").agg(F.sum("weight").alias("partial"))
            .join(hidden, ["user", "item"], "left_anti"))
    part = _table(part, "impact_partial")
    nth = (part.withColumn("rank", F.row_number().over(by_user.orderBy(F.desc("partial"), "item"))).where(F.col("rank") <= n)
           .groupBy("user").agg(F.min(F.when(F.col("rank") == n, F.col("partial"))).alias("nth")))
    bounds = user.join(nth, "user").select("user", "rest", F.greatest("least", F.coalesce("nth", F.lit(0.0))).alias("_least"))
    return (part.join(_table(bounds, "impact_bounds"), "user")
            .where(F.col("partial") + F.col("rest") >= F.col("_least") - SLACK).drop("_least")), tags


# more than rounding to four decimals can move a score
SLACK = 1e-3


def recommend_from_catalogue(user_tags: DataFrame, items: DataFrame, hidden: DataFrame, n: int) -> DataFrame:
    """The ``n`` best items of the whole catalogue for every user by the sum
    of the weights of shared (module, tag), without those ``hidden`` (user,
    item: seen or recommended before): (user, rank, item, score), ties by item.
    Exact: pairs are left out only where their bound is below the n-th score."""
    postings = _table(item_tags(items).select("item", "module", "tag"), "postings")
    hidden = hidden.select("user", "item").distinct()
    part, tags = catalogue_candidates(user_tags, postings, hidden, n)
    part = _table(part, "impact_pairs")
    light = tags.where("NOT essential").select("user", "module", "tag", "weight")
    more = (part.where("rest > 0").select("user", "item").join(postings, "item").join(light, ["user", "module", "tag"])
            .groupBy("user", "item").agg(F.sum("weight").alias("more")))
    score = F.round(F.col("partial") + F.coalesce("more", F.lit(0.0)), 4)
    scored = part.join(more, ["user", "item"], "left").select("user", "item", score.alias("score"))
    w = Window.partitionBy("user").orderBy(F.desc("score"), F.asc("item"))
    return (scored.withColumn("rank", F.row_number().over(w)).where((F.col("rank") <= n) & (F.col("score") > 0))
            .select("user", "rank", "item", "score"))
