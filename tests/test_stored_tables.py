"""The bucketed portrait, the key index of the cells and files read in splits."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tagfold.operators import portrait as pt
from tagfold.operators import text as tx
from tagfold.plans import fixtures as fx
from tagfold.plans import queries as q
from tagfold.schemas import DIM_RECENT_AUTHOR, DIM_RECENT_INTEREST, DIM_SEARCH, DIMS
from tagfold.sinks import writers as wr
from tagfold.sources import readers as rd

SF = "/root/testdata/sf0.001"
DAY = 86_400_000


def _portrait(rng, users):
    rows = {}
    for _ in range(2500):
        dim = rng.choice((DIM_RECENT_INTEREST, DIM_RECENT_INTEREST, DIM_RECENT_AUTHOR, DIM_SEARCH))
        module = rng.choice("MN") if dim == DIM_RECENT_INTEREST else ""
        key = (rng.choice(users), dim, module, f"t{rng.randrange(60)}")
        rows[key] = (*key, round(rng.choice((0.05, 0.5, 1, 30)) * rng.random(), 4), rng.randrange(0, 200) * DAY)
    return list(rows.values())


@pytest.mark.parametrize("seed", [1, 2])
def test_decay_in_place_is_the_decay(spark, seed):
    rng = random.Random(seed)
    tags = spark.createDataFrame(_portrait(rng, ["hot"] * 8 + ["u1", "u2", "u3"]),
                                 "user string, dim string, module string, tag string, weight double, last_ms long")
    rows = lambda df: sorted((r.user, r.dim, r.module, r.tag, r.weight, r.last_ms) for r in df.collect())
    for least in (0.01, 0.3):
        want = rows(pt.decay_portrait(tags, 201 * DAY, least, 5))
        assert rows(pt.decay_in_place(tags, 201 * DAY, least, 5)) == want


def test_the_fold_does_not_move_the_stored_portrait(spark):
    q.prepare_session(spark)
    new = fx.new_log(q.formatted_log(spark, SF))
    with pt.bucket_joins(spark):
        df = pt.fold_portrait(q.bucketed_portrait(spark, SF), new, q.AS_OF, q.FOLD_BUCKETS, q.STOP)
        df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, level = [], depth(lines[at])
    for line in reversed(lines[:at]):  # the scan's ancestors
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    assert any("Join" in x for x in above) and any("Window" in x for x in above)
    assert not any("Exchange" in x or "ShuffleQueryStage" in x for x in above)
    # what is shuffled is the day's log
    assert any("Exchange" in x for x in lines)


def test_folds_in_a_chain(spark, tmp_path):
    """A fold's result is stored in buckets and folded again."""
    q.prepare_session(spark)
    new = fx.new_log(q.formatted_log(spark, SF))
    stored = pt.fold_and_store(q.bucketed_portrait(spark, SF), new, q.AS_OF, "t_next_portrait", str(tmp_path / "next"),
                               q.FOLD_BUCKETS, stop_names=q.STOP)
    assert len(stored.inputFiles()) <= q.FOLD_BUCKETS  # one file per bucket
    later = q.AS_OF + 40 * DAY
    got = pt.fold_and_store(stored, new, later, "t_last_portrait", str(tmp_path / "last"), q.FOLD_BUCKETS, stop_names=q.STOP)
    want = pt.portrait_update(pt.portrait_update(q.stored_portrait(spark, SF), new, q.AS_OF, q.STOP), new, later, q.STOP)
    rows = lambda df: sorted((r.user, r.dim, r.module, r.tag, round(r.weight, 4), r.last_ms) for r in df.collect())
    assert rows(got) == rows(want) and {r.dim for r in want.select("dim").distinct().collect()} == set(DIMS)
    for t in ("t_next_portrait", "t_last_portrait"):
        spark.sql(f"DROP TABLE {t}")


def test_a_range_scan_opens_the_files_of_its_range(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("k"), F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
        cells = wr.rows_to_cells(rows, F.col("k"), ["a", "b"]).repartitionByRange(12, "row_key", "qualifier").sortWithinPartitions("row_key", "qualifier")
        path = wr.write_cells(cells, str(tmp_path / "cells"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = spark.read.parquet(path)
    n_files = len(whole.inputFiles())
    assert n_files >= 10
    for lo, hi in (("4", "5"), ("0", "g"), ("zz", "zzz"), ("5", "5")):
        df = rd.read_cell_range(spark, path, lo, hi, ["a", "b"])
        want = rd.cell_range_scan(whole, lo, hi, ["a", "b"])
        assert sorted(df.collect()) == sorted(want.collect())
    assert len(rd.read_cell_range(spark, path, "4", "5", ["a"]).inputFiles()) <= 3
    assert rd.cell_files(spark, path, "zz", "zzz") == []


def test_a_file_is_read_in_splits(spark, tmp_path):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(200)]
    texts = {f"f{i}.txt": "\n".join(" ".join(rng.choice(words) for _ in range(8)) for _ in range(n)) for i, n in enumerate((2000, 40, 1))}
    for name, t in texts.items():
        (tmp_path / name).write_text(t + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = rd.read_file_lines(spark, str(tmp_path))
        assert lines.where(F.col("file_path").endswith("f0.txt")).select("block_start").distinct().count() > 5
        docs = lines.select(F.regexp_extract("file_path", r"([^/]+)$", 1).alias("doc_id"), F.col("value").alias("text"))
        got = [tuple(r) for r in tx.line_keywords(docs, 3, 10).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    counts = {n: collections.Counter(re.findall(r"\w+", t)) for n, t in texts.items()}
    whole = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    assert sorted(got) == sorted(tuple(r) for r in tx.tfidf_keywords(whole, 10).collect())
    assert sum(counts["f0.txt"].values()) == 16_000
