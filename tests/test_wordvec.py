"""Word vectors against the full matrix, and what they are for: words of the
same contexts are neighbours."""

import collections
import random

import numpy as np
from pyspark.sql import functions as F

from tagfold.operators import text as tx
from tagfold.operators import wordvec as wv


def _words(spark, texts):
    return wv._table(spark.createDataFrame([(i, t.split()) for i, t in enumerate(texts)], "doc_id long, words array<string>"), "t_words")


def _names(spark, texts):
    words = sorted({w for t in texts for w in t.split()})
    df = spark.createDataFrame([(w,) for w in words], "t string").select("t", F.xxhash64("t").alias("w"))
    return {r.w: r.t for r in df.collect()}


def _counts(texts, window):
    out = collections.Counter()
    for t in texts:
        w = t.split()
        for i in range(len(w)):
            for d in range(1, window + 1):
                if i + d < len(w):
                    out[w[i], w[i + d]] += window - d + 1
                    out[w[i + d], w[i]] += window - d + 1
    return out


def _corpus(seed, n=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice("abcdefgh") * rng.choice((1, 1, 2)) for _ in range(rng.choice((0, 1, 2, 3, 9, 40)))) for _ in range(n)]


def test_pairs_are_counted_once_in_segments(spark):
    texts = _corpus(1)
    names = _names(spark, texts)
    for segment, window in ((3, 2), (7, 5), (2000, 5)):
        got = collections.Counter()
        for r in wv.cooccurrences(_words(spark, texts), window, segment).collect():
            got[names[r.a], names[r.b]] += r.n
            got[names[r.b], names[r.a]] += r.n
        assert got == _counts(texts, window)


def test_vectors_are_the_leading_eigenvectors(spark):
    texts = _corpus(2)
    names, counts = _names(spark, texts), _counts(texts, 5)
    words = sorted({a for a, _ in counts})
    n = np.array([[counts[a, b] for b in words] for a in words], dtype=float)
    s = n.sum(axis=1)
    d = 1 / np.sqrt(s + s.mean())
    values, vectors = np.linalg.eigh(n * np.outer(d, d))
    order = np.argsort(-np.abs(values))[1:4]
    want = (vectors[:, order] * np.sqrt(np.abs(values[order]))) * d[:, None] * np.sqrt(s.mean() * len(words))
    got = {names[r.w]: r.vector for r in wv.word_vectors(wv._table(wv.cooccurrences(_words(spark, texts), 5), "t_pairs"), 3, 24).collect()}
    got = np.array([got[w] for w in words])
    assert np.abs(got @ got.T - want @ want.T).max() < 1e-3 * np.abs(want @ want.T).max()  # up to the signs


def test_planted_synonyms_are_neighbours(spark):
    """Ten pairs of synonyms, each pair in contexts of its own."""
    rng = random.Random(3)
    texts = []
    for _ in range(1500):
        topic = rng.randrange(10)
        ctx = [f"c{topic}_{rng.randrange(6)}" for _ in range(10)] + [rng.choice(("the", "of", "and")) for _ in range(4)]
        rng.shuffle(ctx)
        texts.append(" ".join([*ctx[:7], f"syn{topic}_{rng.randrange(2)}", *ctx[7:]]))
    texts += ["once upon", "lonely pair"]  # words that occur once
    names = _names(spark, texts)
    vec = {names[r.w]: np.array(r.vector) for r in
           wv.word_vectors(wv._table(wv.cooccurrences(_words(spark, texts), 5), "t_pairs"), 9).collect()}
    assert set(vec) == set(names.values())
    cos = lambda a, b: float(vec[a] @ vec[b] / (np.linalg.norm(vec[a]) * np.linalg.norm(vec[b]) + 1e-12))
    syn = [f"syn{t}_{k}" for t in range(10) for k in range(2)]
    hits = sum(max((o for o in syn if o != w), key=lambda o: cos(w, o))[:-1] == w[:-1] for w in syn)
    assert hits >= 19


def test_document_vectors(spark):
    docs = spark.createDataFrame([(1, "red cat runs"), (2, "red dog runs runs"), (3, None), (4, ""), (5, "blue"), (None, "red cat")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.vector for r in tx.word2vec_vectors(docs).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None} and all(len(v) == 3 for v in got.values())
    assert got[3] == got[4] == got[5] == [0.0, 0.0, 0.0] and got[1] != [0.0, 0.0, 0.0]
    assert tx.word2vec_vectors(docs.limit(0)).count() == 0
