"""Text features and recommendation against brute force on tiny inputs."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from tagfold.operators import recommend as rc
from tagfold.operators import text as tx

DOCS = [(1, "The cat sat on the mat. The cat!", "s1"),
        (2, "A dog and a cat; dogs bark.", "s2"),
        (3, "Über naïve café: mat mat mat", "s1"),
        (4, None, "s3")]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string, source string")


def _brute_tfidf():
    toks = {d: [t for t in re.split(r"[\W_]+", (x or "").lower()) if t] for d, x, _ in DOCS}
    tf = {d: Counter(ts) for d, ts in toks.items()}
    df = Counter(t for c in tf.values() for t in c)
    n = len(DOCS)
    return {(d, t): c * math.log((n + 1) / (df[t] + 1)) for d, cs in tf.items() for t, c in cs.items()}


def test_tfidf_keywords_brute_force(spark):
    want = _brute_tfidf()
    got = {(r.doc_id, r.term): r.score for r in tx.tfidf_keywords(_docs(spark), 25).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - round(want[k], 6)) < 1e-9 for k in want)
    top1 = {r.doc_id: r.term for r in tx.tfidf_keywords(_docs(spark), 1).collect()}
    # doc 1: "the" x3 only there beats "cat" x2 (also in doc 2); doc 3: "mat" x3
    assert top1[1] == "the" and top1[3] == "mat"


def test_catalog_keywords_json(spark):
    out = {r.doc_id: (r["class"], r.keywords) for r in tx.catalog_keywords(_docs(spark), k=2).collect()}
    # the: 3 * ln(5/2) = 2.7489; cat: 2 * ln(5/3) = 1.0217
    assert out[1] == ("s1", '{"s1":{"the":2.7489,"cat":1.0217}}')
    assert 4 not in out                                # no tokens, no keywords


def test_count_tfidf_vocabulary_ties_by_term(spark):
    docs = spark.createDataFrame([(1, "zeta alpha beta"), (2, "beta zeta gamma"), (3, "delta")],
                                 "doc_id long, text string")
    out = {r.doc_id: r.features for r in tx.count_tfidf(docs, 2).collect()}
    # counts: beta 2, zeta 2, others 1 -> vocabulary [beta, zeta]; idf = ln(4/3)
    idf = round(math.log(4 / 3), 6)
    assert out[1] == [idf, idf] and out[3] == [0.0, 0.0]


def test_hash_split_is_deterministic_and_complete(spark):
    r = spark.range(1000).withColumnRenamed("id", "event_id")
    a, b = rc.hash_split(r, "event_id")
    a2, _ = rc.hash_split(r, "event_id")
    ids_a = {x.event_id for x in a.collect()}
    assert ids_a == {x.event_id for x in a2.collect()}
    assert ids_a.isdisjoint({x.event_id for x in b.collect()}) and len(ids_a) + b.count() == 1000
    assert 700 < len(ids_a) < 900


def test_content_match_brute_force(spark):
    items = spark.createDataFrame([("i1", "ABCD1;EFGH2", "t$$$red,blue"), ("i2", "ABCD9", "t$$$green")],
                                  "item string, rcc string, rkd string")
    user_tags = spark.createDataFrame([("u1", "ABCD", "red", 2.0), ("u1", "EFGH", "blue", 3.0),
                                       ("u1", "ABCD", "green", 0.5), ("u2", "ZZZZ", "red", 9.0)],
                                      "user string, module string, tag string, weight double")
    pairs = spark.createDataFrame([("u1", "i1"), ("u1", "i2"), ("u2", "i1")], "user string, item string")
    got = {(r.user, r.item): r.score for r in rc.content_match(pairs, user_tags, items).collect()}
    # i1 tags: (ABCD|EFGH) x (red|blue); i2: ABCD x green; u2 shares nothing
    assert got == {("u1", "i1"): 5.0, ("u1", "i2"): 0.5}
