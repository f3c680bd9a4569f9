"""Properties of the queries that have no SQL oracle (MLlib results)."""

import math

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_als_recommend_shape(spark):
    recs = E.queries()["als_recommend"](spark, SF).collect()
    by_user = {}
    for r in recs:
        by_user.setdefault(r.user_id, []).append(r)
    assert by_user
    for rows in by_user.values():
        rows.sort(key=lambda r: r.rank)
        assert [r.rank for r in rows] == list(range(1, len(rows) + 1)) and len(rows) <= 10
        assert all(a.score >= b.score for a, b in zip(rows, rows[1:]))
        assert len({r.item_id for r in rows}) == len(rows)
    assert any(r.item_name != "" for r in recs)


def test_als_rmse_is_finite(spark):
    r = E.queries()["als_rmse"](spark, SF).first()
    assert r.scored_rows > 0 and math.isfinite(r.rmse) and r.rmse >= 0


def test_hashing_tfidf_shape(spark):
    rows = E.queries()["hashing_tfidf"](spark, SF).collect()
    assert rows and all(len(r.features) == 20 and min(r.features) >= 0 for r in rows)


def test_word2vec_vectors_shape(spark):
    """3 finite components per document, every document covered on each run."""
    a = {r.doc_id: r.vector for r in E.queries()["word2vec_vectors"](spark, SF).collect()}
    b = {r.doc_id: r.vector for r in E.queries()["word2vec_vectors"](spark, SF).collect()}
    assert a and all(len(v) == 3 and all(math.isfinite(x) for x in v) for v in a.values())
    assert a.keys() == b.keys()
