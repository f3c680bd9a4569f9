"""Property tests: the Spark tag extractors against plain-Python statements
of the same rules, on random strings built from the characters that matter
(separators, '$', '<', '>', blanks, case)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagfold.functions import tags as T

ALPHABET = "aAbB$ ,;<>\u0001"
texts = st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=1, max_size=40)


def jsplit(s, pattern):
    """java.lang.String.split(regex) with limit 0."""
    parts = re.split(pattern, s)
    if len(parts) == 1:
        return parts
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def py_keywords(rkd):
    cleaned = re.sub("[< >]", "", rkd)
    pieces = jsplit(cleaned, r"\$\$\$")
    chosen = pieces[1] if len(pieces) == 2 else pieces[0] if len(pieces) == 1 else ""
    return {w.lower() for w in re.split(r"[, ;$]", chosen) if w != ""}


def py_modules(rcc):
    return {c[:4] for c in rcc.split(";") if len(c) >= 4}


def py_subjects(rcc):
    return {c[:4] for c in re.split("[, ;]", rcc) if len(c) >= 4}


def _run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return {r.i: r.r for r in df.select("i", expr(F.col("s")).alias("r")).collect()}


@settings(max_examples=15, deadline=None)
@given(texts)
def test_java_split_matches_jvm_rule(spark, values):
    got = _run(spark, values, lambda c: T.java_split(c, r"\$\$\$"))
    for i, v in enumerate(values):
        assert got[i] == jsplit(v, r"\$\$\$"), v


@settings(max_examples=15, deadline=None)
@given(texts)
def test_keyword_and_module_rules(spark, values):
    kws = _run(spark, values, T.interest_keywords)
    mods = _run(spark, values, T.interest_modules)
    subj = _run(spark, values, T.subject_codes)
    for i, v in enumerate(values):
        assert set(kws[i]) == py_keywords(v) and len(kws[i]) == len(set(kws[i])), v
        assert set(mods[i]) == py_modules(v), v
        assert set(subj[i]) == py_subjects(v), v


weights = st.lists(st.tuples(st.floats(min_value=0.0001, max_value=500, allow_nan=False),
                             st.integers(min_value=-3, max_value=95)), min_size=1, max_size=40)


@settings(max_examples=10, deadline=None)
@given(weights)
def test_decay_never_raises_a_weight(spark, ws):
    from tagfold.operators import portrait as pt
    from tagfold.schemas import TAGS_SCHEMA
    as_of, day = 1706745600000, 86_400_000
    rows = [("u", "RecentRelatedAuthor", "", f"t{i}", w, as_of - d * day) for i, (w, d) in enumerate(ws)]
    df = spark.createDataFrame(rows, TAGS_SCHEMA)
    before = {r[3]: r[4] for r in rows}
    for r in pt.decay_recent_author(df, as_of).collect():
        assert r.weight <= max(before[r.tag], 0.001) + 0.00005, (r.tag, before[r.tag], r.weight)
        assert r.last_ms == as_of
    nested = df.withColumn("latest_ms", F.lit(as_of - 3 * day))
    for r in pt.decay_guest_nested(nested, as_of).collect():
        assert r.weight <= before[r.tag] + 0.00005 and r.weight >= 0.01
    low = pt.decay_recent_interest(df, as_of, min_weight=0.01, fraction=0.01).collect()
    for r in low:
        assert r.weight <= max(before[r.tag], 0.001) + 0.00005


author_texts = st.lists(st.text(alphabet="ab ,;\r\n，s", max_size=14), min_size=1, max_size=40)


def py_authors(au, stops):
    cleaned = re.sub("[\r \n]", "", au)
    return {x for x in re.split("[,，;]", cleaned) if x != "" and x not in stops}


def py_subsubjects(rcc):
    return {c for c in re.split("[, ;]", rcc) if c != ""}


@settings(max_examples=15, deadline=None)
@given(author_texts)
def test_author_and_subsubject_rules(spark, values):
    stops = ["s", "ab"]
    auth = _run(spark, values, lambda c: T.author_names(c, stops))
    sub = _run(spark, values, T.subsubject_codes)
    for i, v in enumerate(values):
        assert set(auth[i]) == py_authors(v, stops) and len(auth[i]) == len(set(auth[i])), v
        assert set(sub[i]) == py_subsubjects(v), v
