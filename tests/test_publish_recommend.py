"""Atomic publication and recommendation over whole catalogues."""

import collections
import random
import threading

import pytest
from pyspark.sql import functions as F

from tagfold.operators import recommend as rc
from tagfold.sinks import writers as wr

ODD = ["01", None, "a b:c", "x=y", "1", "ü/%", "{}"]


def _snapshot(spark, path, names, x):
    return wr.write_parquet(spark.createDataFrame([(x, n) for n in names for _ in range(3)], "x int, part string"), path, ["part"])


def _rows(df):
    return collections.Counter((r.x, r.part) for r in df.select("x", "part").collect())


def test_partition_names_come_back_as_text(spark, tmp_path):
    one = _snapshot(spark, str(tmp_path / "a b" / "d1"), ODD, 1)
    two = _snapshot(spark, str(tmp_path / "a b" / "d2"), ["02", *ODD[:4]], 2)
    wr.publish_location(spark, "t_odd", one)
    assert _rows(spark.table("t_odd")) == {(1, n): 3 for n in ODD}
    wr.publish_location(spark, "t_odd", two)
    assert _rows(spark.table("t_odd")) == {(2, n): 3 for n in ["02", *ODD[:4]]}
    wr.publish_location(spark, "t_odd", one)  # and back
    assert _rows(spark.table("t_odd")) == {(1, n): 3 for n in ODD}
    assert spark.table("t_odd").where("part = '01'").count() == 3 and spark.table("t_odd").where("part IS NULL").count() == 3
    spark.sql("DROP TABLE t_odd")


def test_nested_partitions_and_declared_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "07", "p"), (2, "8", None)], "x int, day string, k string")
    one = wr.write_parquet(df, str(tmp_path / "n1"), ["day", "k"])
    wr.publish_location(spark, "t_nested", one)
    assert sorted(map(tuple, spark.table("t_nested").collect())) == [(1, "07", "p"), (2, "8", None)]
    wr.publish_location(spark, "t_typed", one, schema="x int, day int, k string")
    assert sorted(map(tuple, spark.table("t_typed").collect())) == [(1, 7, "p"), (2, 8, None)]
    with pytest.raises(ValueError):
        wr.publish_location(spark, "t_nested", _snapshot(spark, str(tmp_path / "n2"), ["a"], 1))
    assert spark.table("t_nested").count() == 2
    for t in ("t_nested", "t_typed"):
        spark.sql(f"DROP TABLE {t}")


def test_nothing_to_publish_is_an_error(spark, tmp_path):
    one = _snapshot(spark, str(tmp_path / "d"), ["a"], 1)
    wr.publish_location(spark, "t_kept", one)
    with pytest.raises(ValueError):
        wr.publish_location(spark, "t_kept", str(tmp_path / "none"))
    assert _rows(spark.table("t_kept")) == {(1, "a"): 3}
    spark.sql("DROP TABLE t_kept")


def test_tables_with_registered_partitions_are_refused(spark, tmp_path):
    one = _snapshot(spark, str(tmp_path / "d"), ["a"], 1)
    spark.sql(f"CREATE TABLE t_old (x int, part string) USING parquet PARTITIONED BY (part) LOCATION '{one}'")
    with pytest.raises(ValueError):
        wr.publish_location(spark, "t_old", one)
    spark.sql("DROP TABLE t_old")


def test_readers_see_one_snapshot(spark, tmp_path):
    paths = [_snapshot(spark, str(tmp_path / f"s{x}"), [f"p{i}" for i in range(12)], x) for x in (1, 2)]
    wr.publish_location(spark, "t_switched", paths[0])
    before = spark.table("t_switched")
    wr.publish_location(spark, "t_switched", paths[1])
    assert {x for x, _ in _rows(before)} == {1}  # resolved before the switch
    seen, done, errors = [], threading.Event(), []

    def read():
        while not done.is_set():
            try:
                seen.append(_rows(spark.table("t_switched")))
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    t = threading.Thread(target=read)
    t.start()
    for i in range(6):
        wr.publish_location(spark, "t_switched", paths[i % 2])
    done.set()
    t.join()
    assert not errors and seen
    assert all(rows in ({(1, f"p{i}"): 3 for i in range(12)}, {(2, f"p{i}"): 3 for i in range(12)}) for rows in seen)
    spark.sql("DROP TABLE t_switched")


# ---------------------------------------------------------------- catalogue

def _catalogue(rng):
    words = [f"w{i}" for i in range(40)]
    pick = lambda n: {words[min(int(rng.expovariate(0.12)), 39)] for _ in range(n)}  # noqa: E731  a few words are common
    items = {f"i{k:03d}": pick(rng.randrange(1, 6)) for k in range(300)}
    users = {f"u{k}": {w: round(rng.expovariate(0.5) + 0.01, 4) for w in pick(rng.randrange(1, 12))} for k in range(60)}
    hidden = {(u, i) for u in users for i in rng.sample(sorted(items), rng.choice((0, 3, 120)))}
    return items, users, hidden


def _frames(spark, items, users, hidden):
    # one class code, and the words as the keyword list of the item
    it = spark.createDataFrame([(i, "A123", ";".join(sorted(w)) + "$$$") for i, w in items.items()], "item string, rcc string, rkd string")
    ut = spark.createDataFrame([(u, "A123", w, x) for u, t in users.items() for w, x in t.items()],
                               "user string, module string, tag string, weight double")
    return ut, it, spark.createDataFrame(sorted(hidden) * 2, "user string, item string")


@pytest.mark.parametrize("seed", [1, 2])
def test_catalogue_recommendations(spark, seed):
    items, users, hidden = _catalogue(random.Random(seed))
    ut, it, hd = _frames(spark, items, users, hidden)
    tagged = collections.defaultdict(set)
    for r in rc.item_tags(it).collect():
        tagged[r.item].add(r.tag)
    want = {}
    for u, t in users.items():
        s = {i: round(sum(t.get(w, 0) for w in ws), 4) for i, ws in tagged.items() if (u, i) not in hidden}
        best = sorted(((i, x) for i, x in s.items() if x > 0), key=lambda p: (-p[1], p[0]))[:5]
        want |= {(u, k + 1): p for k, p in enumerate(best)}
    got = {(r.user, r.rank): (r.item, r.score) for r in rc.recommend_from_catalogue(ut, it, hd, 5).collect()}
    assert got == want


def test_fewer_pairs_than_share_a_keyword(spark):
    items, users, hidden = _catalogue(random.Random(3))
    ut, it, hd = _frames(spark, items, users, hidden)
    postings = rc.item_tags(it).select("item", "module", "tag")
    part, _ = rc.catalogue_candidates(ut, postings, hd.distinct(), 5)
    every = ut.join(postings, ["module", "tag"]).select("user", "item").distinct().count()
    assert part.count() < 0.5 * every


def test_als_top_items_over_all_items(spark):
    rng = random.Random(5)
    ratings = spark.createDataFrame([(u, i, float(rng.randrange(1, 6))) for u in range(25) for i in rng.sample(range(80), 20)],
                                    "user_id int, item_id int, rating float")
    model = rc.als_model(ratings, max_iter=3)
    names = spark.createDataFrame([(i, f"n{i}") for i in range(0, 80, 2)], "item_id int, item_name string")
    got = rc.als_top_items(model, names, 7).collect()
    users = {r.id: list(r.features) for r in model.userFactors.collect()}
    items = {r.id: list(r.features) for r in model.itemFactors.collect()}
    for u, x in users.items():
        s = {i: round(sum(a * b for a, b in zip(x, y)), 6) + 0.0 for i, y in items.items()}
        want = sorted(s.items(), key=lambda p: (-p[1], p[0]))[:7]
        mine = sorted((r for r in got if r.user_id == u), key=lambda r: r.rank)
        assert [(r.item_id, r.item_name) for r in mine] == [(i, f"n{i}" if i % 2 == 0 else "") for i, _ in want]
        assert all(abs(r.score - s) < 2e-6 for r, (_, s) in zip(mine, want))


def test_empty_catalogue(spark):
    items, users, hidden = _catalogue(random.Random(4))
    ut, it, hd = _frames(spark, items, users, hidden)
    for a, b in ((ut.limit(0), it), (ut, it.limit(0))):
        assert rc.recommend_from_catalogue(a, b, hd, 5).count() == 0
    assert rc.recommend_from_catalogue(ut, it, hd.limit(0), 5).where(F.col("rank") == 1).count() > 0
