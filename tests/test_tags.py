"""Tag extractors and log filters on hand-made edge rows."""

from pyspark.sql import functions as F

from tagfold.functions import tags as T
from tagfold.operators import filters as flt
from tagfold.operators import portrait as pt
from tagfold.schemas import DIM_SEARCH, DIM_SUBJECT, DIM_SUBSUBJECT, DIM_TOTAL_AUTHOR, DIM_TOTAL_INTEREST


def _one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(expr.alias("r")).first()["r"]


def test_java_split_drops_trailing_empties(spark):
    assert _one(spark, T.java_split(F.col("s"), r"\$\$\$"), s="a$$$b$$$$$$") == ["a", "b"]
    assert _one(spark, T.java_split(F.col("s"), r"\$\$\$"), s="$$$") == []
    assert _one(spark, T.java_split(F.col("s"), r"\$\$\$"), s="a$$$") == ["a"]
    assert _one(spark, T.java_split(F.col("s"), r"\$\$\$"), s="") == [""]          # no match: whole input
    assert _one(spark, T.java_split(F.col("s"), r"\$\$\$"), s="$$$$") == ["", "$"]


def test_interest_keywords_dollar_rule(spark):
    kw = lambda s: sorted(_one(spark, T.interest_keywords(F.col("s")), s=s))
    assert kw("Title$$$Alpha,Beta;gamma") == ["alpha", "beta", "gamma"]     # two pieces -> second
    assert kw("<One> two,THREE") == ["onetwo", "three"]                       # '<', blank, '>' removed first
    assert kw("a$$$b$$$c") == []                                              # three pieces -> none
    assert kw("Same,same,SAME") == ["same"]                                   # distinct after lower-casing


def test_modules_skip_short_codes(spark):
    assert sorted(_one(spark, T.interest_modules(F.col("s")), s="ABC;ABCD1;ABCD2;;XY")) == ["ABCD"]
    assert sorted(_one(spark, T.subject_codes(F.col("s")), s="ABC,ABCD1 EFGH;;")) == ["ABCD", "EFGH"]
    assert sorted(_one(spark, T.subsubject_codes(F.col("s")), s="ABC,ABCD1 ABCD1;;")) == ["ABC", "ABCD1"]


def test_author_names(spark):
    got = sorted(_one(spark, T.author_names(F.col("s"), ["staff"]), s="Ann Lee,Bob\r\n;staff，Cy;;"))
    assert got == ["AnnLee", "Bob", "Cy"]


def test_bot_filter(spark):
    df = spark.createDataFrame([("1", "Mozilla/5.0 (compatible; Googlebot/2.1)"), ("2", "Mozilla/5.0 (X11)"),
                                ("3", None), ("4", "python-requests/2.0"), ("5", "x BAIDUSPIDER y")],
                               "id string, ua string")
    assert sorted(r.id for r in flt.bot_filter(df).collect()) == ["2", "3"]


def test_clean_user_and_weights(spark):
    assert _one(spark, T.clean_user(F.col("s")), s=' "a b" ') == "ab"
    assert _one(spark, T.action_weight(F.col("s")), s="buy") == 2.0
    assert _one(spark, T.action_weight(F.col("s")), s="read") == 1.0


def _log(spark, rows):
    cols = ["un", "ac", "ro", "rcc", "rkd", "au", "sw", "vt_ms"]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'bigint' if c == 'vt_ms' else 'string'}" for c in cols))


def test_tag_rows_once_per_row(spark):
    lg = _log(spark, [
        ("u1", "buy", "article", "ABCD1;ABCD2", "t$$$k1,k1,K1", "x", "", 10),
        ("u1", "read", "article", "ABCD1", "t$$$k1", "x", "", 20),
        ("u1", "search", "tushu", "", "", "", "query", 30),
        ("", "read", "article", "ABCD1", "t$$$k1", "x", "", 40),
    ])
    p = pt.log_portrait(lg, [DIM_TOTAL_INTEREST, DIM_SUBJECT, DIM_SUBSUBJECT, DIM_TOTAL_AUTHOR, DIM_SEARCH], [])
    got = {(r.dim, r.module, r.tag): (r.weight, r.last_ms) for r in p.collect()}
    # the buy row lists module ABCD twice (ABCD1, ABCD2) but counts once
    assert got[(DIM_TOTAL_INTEREST, "ABCD", "k1")] == (3.0, 20)
    assert got[(DIM_SUBJECT, "", "ABCD")] == (3.0, 20)
    assert got[(DIM_SUBSUBJECT, "", "ABCD2")] == (2.0, 10)
    assert got[(DIM_TOTAL_AUTHOR, "", "x")] == (3.0, 20)
    assert got[(DIM_SEARCH, "", "query")] == (1.0, 30)
    assert all(r.user == "u1" for r in p.collect())


def test_normalize_type_and_recode(spark):
    df = spark.createDataFrame([("CJFD", 2), ("博士", 1), ("zzz", 3)], "t string, n int")
    out = df.select(flt.normalize_type(F.col("t")).alias("c"), flt.recode_times(F.col("n")).alias("n")).collect()
    assert [(r.c, r.n) for r in out] == [("期刊", 12), ("博士", 1), ("其他", 3)]
