"""Decay, pruning, merge and packing properties."""

import json
import math
import random

from pyspark.sql import functions as F

from tagfold.functions.decay import decay_factor
from tagfold.functions.jsonmaps import nested_tags
from tagfold.operators import portrait as pt
from tagfold.schemas import DIM_RECENT_INTEREST, DIM_SUBJECT, DIM_TOTAL_INTEREST, DIMS, TAGS_SCHEMA

DAY = 86_400_000
AS_OF = 1706745600000


def test_decay_factor_cycle(spark):
    df = spark.createDataFrame([(d,) for d in [-1, 0, 1, 15, 29, 30, 31]], "d long")
    got = [r.f for r in df.select(decay_factor(F.col("d"), 30, 0.01).alias("f")).collect()]
    want = [0.9, 0.9] + [0.01 ** ((d % 30) / 30) for d in [1, 15, 29, 30, 31]]
    assert all(math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got, want))
    assert got[5] == 1.0  # day 30 gives factor 1 again (kept literally)


def _sequential_prune(tags, min_weight, min_keywords):
    """Transcription of the sequential rule: walk the portrait in order and
    drop a low tag while the remaining count - 1 exceeds min_keywords."""
    remaining = len(tags)
    kept = []
    for t in tags:
        if t[1] < min_weight and remaining - 1 > min_keywords:
            remaining -= 1
            continue
        kept.append(t[0])
    return set(kept)


def test_prune_rank_rule_equals_sequential_rule(spark):
    rnd = random.Random(7)
    rows, expected = [], {}
    for u in range(60):
        n = rnd.choice([3, 11, 12, 13, 20, 40])
        tags = []
        for i in range(n):
            module = f"M{rnd.randint(0, 3)}"
            w = float(rnd.choice([1, 2, 3, 4]))
            days = rnd.choice([0, 1, 5, 10, 20, 29, 30, 31, 45])
            rows.append((f"u{u}", DIM_RECENT_INTEREST, module, f"t{i}", w, AS_OF - days * DAY - 5))
            tags.append((module, f"t{i}", w, days))
        # portrait order: modules by total desc then code, tags by weight desc then tag
        mw = {}
        for m, _, w, _ in tags:
            mw[m] = mw.get(m, 0) + w
        ordered = sorted(tags, key=lambda t: (-mw[t[0]], t[0], -t[2], t[1]))
        dec = []
        for m, t, w, days in ordered:
            f = 0.9 if days <= 0 else 0.01 ** ((days % 30) / 30)
            dec.append(((m, t), round(max(0.001, w * f) + 1e-12, 4)))
        expected[f"u{u}"] = _sequential_prune(dec, 0.1, 10)
    df = spark.createDataFrame(rows, TAGS_SCHEMA)
    out = pt.decay_recent_interest(df, AS_OF, min_weight=0.1, fraction=0.01).collect()
    got = {}
    for r in out:
        got.setdefault(r.user, set()).add((r.module, r.tag))
    for u, want in expected.items():
        assert got.get(u, set()) == want, u
    # never fewer than min_keywords + 1 tags when the user had that many
    for u, want in expected.items():
        assert len(got.get(u, set())) >= min(11, sum(1 for r in rows if r[0] == u))


def test_merge_is_commutative_and_associative(spark):
    rnd = random.Random(3)
    frames = []
    for _ in range(3):
        rows = [(f"u{rnd.randint(0, 4)}", rnd.choice(DIMS), "", f"t{rnd.randint(0, 5)}",
                 float(rnd.randint(1, 3)), rnd.randint(1, 10**6)) for _ in range(40)]
        frames.append(spark.createDataFrame(rows, TAGS_SCHEMA))
    a, b, c = frames
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(pt.merge_portraits(a, b)) == key(pt.merge_portraits(b, a))
    assert key(pt.merge_portraits(pt.merge_portraits(a, b), c)) == key(pt.merge_portraits(a, pt.merge_portraits(b, c)))


def test_pack_unpack_identity(spark):
    rows = [("u1", DIM_TOTAL_INTEREST, "ABCD", "k\"q", 2.0, 5), ("u1", DIM_TOTAL_INTEREST, "ABCD", "k2", 1.0, 6),
            ("u1", DIM_TOTAL_INTEREST, "EFGH", "k&x", 4.0, 7), ("u1", DIM_SUBJECT, "", "ABCD", 3.0, 8),
            ("u2", DIM_SUBJECT, "", "back\\slash", 1.5, 9)]
    tags = spark.createDataFrame(rows, TAGS_SCHEMA)
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "user string")
    wide = pt.portrait_wide(users, tags, "2024-02-01 00:00:00")
    w = {r.UserName: r for r in wide.collect()}
    assert w["u3"].ConcenedSubject == "{}"
    # canonical order: module with the larger total first, tags by weight desc
    assert list(json.loads(w["u1"].SingleArticleTotalInterest)) == ["EFGH", "ABCD"]
    assert list(json.loads(w["u1"].SingleArticleTotalInterest)["ABCD"]) == ['k"q', "k2"]
    back = pt.unpack_portrait(wide)
    assert sorted(tuple(r) for r in back.select(*[f.name for f in TAGS_SCHEMA.fields]).collect()) == sorted(rows)


def test_nested_tags_bad_json_and_empty_modules(spark):
    df = spark.createDataFrame([('{"A":{}, "B":{"k":{"weight":1.0,"dateTime":"1"}}}',), ("not json",), (None,)],
                               "s string")
    got = [r.m for r in df.select(nested_tags(F.col("s")).alias("m")).collect()]
    assert list(got[0].keys()) == ["B"] and got[1] == {} and got[2] == {}


def test_truncate_two_levels(spark):
    rows = [("u", DIM_TOTAL_INTEREST, m, f"{m}{i}", float(w), 1)
            for m, ws in [("A", [5, 4, 3, 2]), ("B", [1, 1]), ("C", [9]), ("D", [1])] for i, w in enumerate(ws)]
    rows += [("u", DIM_SUBJECT, "", f"s{i}", float(i), 1) for i in range(6)]
    cut = pt.truncate_portrait(spark.createDataFrame(rows, TAGS_SCHEMA), 3).collect()
    nested = sorted((r.module, r.tag) for r in cut if r.dim == DIM_TOTAL_INTEREST)
    assert nested == [("A", "A0"), ("A", "A1"), ("A", "A2"), ("B", "B0"), ("B", "B1"), ("C", "C0")]
    assert sorted(r.tag for r in cut if r.dim == DIM_SUBJECT) == ["s3", "s4", "s5"]


def test_initial_roster_ids_follow_name_order(spark):
    tsv = spark.createDataFrame([("1\tbob",), ("2\tamy",), ("bad",), ("3\t ",)], "value string")
    extra = spark.createDataFrame([("cat",), ("amy",), ("",)], "value string")
    out = pt.initial_roster(tsv, extra, partitions=3).orderBy("UserID").collect()
    assert [(r.UserID, r.UserName) for r in out] == [(0, "amy"), (1, "bob"), (2, "cat")]


def test_guest_counts_follow_jvm_split(spark):
    rows = [("g1", "article", "A;;B;A;;"), ("g1", "article", "B"), ("g1", "tushu", "A")]
    log = spark.createDataFrame(rows, "gki string, ro string, rcc string")
    got = {(r.user, r.code): r.score for r in pt.guest_visit_counts(log).collect()}
    # "A;;B;A;;" -> [A, '', B, A] (trailing empties dropped): A twice, '' once
    assert got == {("g1", "A"): 2.0, ("g1", ""): 1.0, ("g1", "B"): 2.0}


def test_new_users_clean_both_sides(spark):
    known = spark.createDataFrame([('a b',), ('"c"',)], "user string")
    log = spark.createDataFrame([("ab",), ('"a b"',), ("c",), ("d d",), ("",), ("  ",), ("d d",)], "un string")
    got = sorted(r.user for r in pt.new_users(known, log).collect())
    assert got == ["dd"]                       # 'ab' and 'c' are known once cleaned; blanks-only names vanish


def test_new_guests_by_cookie(spark):
    known = spark.createDataFrame([("g1",)], "user string")
    log = spark.createDataFrame([("g1",), ("g2",), ("g2",), ("",)], "gki string")
    assert [r.user for r in pt.new_users(known, log, "gki").collect()] == ["g2"]


def test_pack_ties_ordered_by_name(spark):
    rows = [("u", DIM_TOTAL_INTEREST, "M2", "b", 1.0, 1), ("u", DIM_TOTAL_INTEREST, "M2", "a", 1.0, 1),
            ("u", DIM_TOTAL_INTEREST, "M1", "z", 2.0, 1),
            ("u", DIM_SUBJECT, "", "y", 3.0, 1), ("u", DIM_SUBJECT, "", "x", 3.0, 1)]
    packed = {r.dim: r.json for r in pt.pack_portrait(spark.createDataFrame(rows, TAGS_SCHEMA)).collect()}
    nested = json.loads(packed[DIM_TOTAL_INTEREST])
    assert list(nested) == ["M1", "M2"]            # equal totals (2.0): module code decides
    assert list(nested["M2"]) == ["a", "b"]        # equal weights: tag decides
    assert list(json.loads(packed[DIM_SUBJECT])) == ["x", "y"]
