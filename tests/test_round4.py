"""Steps whose shuffles, tables or tasks grew faster than their input."""

import random

import numpy as np
from pyspark.sql import functions as F

from tagfold.operators import wordvec as wv


def test_frequent_words_have_no_rows_of_pairs_and_the_same_vectors(spark):
    """N in parts is N: texts over several segments, few and many frequent words."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    texts = [rng.choices(vocabulary, weights, k=rng.choice((0, 1, 2, 5, 30, 90))) for _ in range(60)]
    words = wv._table(spark.createDataFrame(list(enumerate(texts)), "doc_id long, words array<string>"), "t_words")
    want = {r.w: np.array(r.vector) for r in wv.word_vectors(wv._table(wv.cooccurrences(words, 5), "t_pairs"), 3).collect()}
    for frequent, segment in ((6, 20), (1000, 2000)):
        parts = wv.cooccurrences(words, 5, segment, frequent)
        assert 0 < len(parts.names) <= frequent
        pairs = {x for r in parts.pairs.collect() for x in (r.a, r.b)}
        assert not pairs & set(parts.names.tolist()) and bool(pairs) == (frequent == 6)
        got = {r.w: np.array(r.vector) for r in wv.word_vectors(parts, 3).collect()}
        assert set(got) == set(want)
        a, b = (np.array([v[w] for w in sorted(want)]) for v in (want, got))
        assert np.abs(a @ a.T - b @ b.T).max() < 1e-9 * np.abs(a @ a.T).max()
    whole = {r.doc_id: r.vector for r in wv.document_vectors(words, 3).collect()}
    some = {r.doc_id: r.vector for r in wv.document_vectors(words, 3, frequent=6).collect()}
    assert whole.keys() == some.keys() == set(range(60))
    assert all(np.allclose(np.abs(whole[d]), np.abs(some[d]), atol=2e-6) for d in whole)


def test_tfidf_by_frequent_and_rare_terms(spark):
    """Repeated ids and null ones are one document each, as in one aggregate."""
    from tagfold.operators import text as tx
    rng = random.Random(6)
    rows = [(rng.choice((1, 2, 3, None)) if i % 3 == 0 else 100 + i, " ".join(rng.choices("abcdefghijkl", k=rng.choice((0, 1, 7, 30))))) for i in range(40)]
    docs = spark.createDataFrame([*rows, (7, None)], "doc_id long, text string")
    tf, df = {}, {}
    for d, t in rows:
        for w in t.split():
            tf[d, w] = tf.get((d, w), 0) + 1
    for _, w in tf:
        df[w] = df.get(w, 0) + 1
    want = sorted((str(d), w, n, df[w], round(n * float(np.log(42 / (df[w] + 1))), 9)) for (d, w), n in tf.items())
    for frequent in (0, 3, 100):
        got = tx.tfidf(docs, frequent=frequent)
        assert sorted((str(r.doc_id), r.term, r.tf, r.df, round(r.score, 9)) for r in got.collect()) == want


def test_buckets_of_the_fold_grow_with_the_portrait():
    from tagfold.plans import queries as q
    assert q.fold_buckets(0) == q.fold_buckets(8 * q.FOLD_ROWS) == q.FOLD_BUCKETS
    assert all(n / q.fold_buckets(n) <= q.FOLD_ROWS for n in (10**6, 10**7 + 1, 10**9))
