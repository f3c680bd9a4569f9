"""Statistics jobs on hand-made rows: the edge rules the generated tables
never trigger (\\N markers, recoded counts, header lines, '-' agents,
malformed rows, ranking ties)."""

from tagfold.operators import stats as st


def test_journal_purchase_stats_edges(spark):
    rows = [("c1", 2, "2024-03-05 10:00:00", "A", "S"),       # times 2 -> 12
            ("c1", 1, "2024-03-05 23:59:59", "A", "S"),       # same day, same keys -> summed
            ("c1", 3, "2024-03-06 00:00:00", "A", "S"),
            ("c2", 5, "2024-03-05 10:00:00", "\\N", "S"),     # null-marker album dropped
            ("c3", 5, "2024-03-05 10:00:00", "A", "\\N"),     # null-marker subject dropped
            ("c4", 5, "garbage", "A", "S")]                   # no y-m-d date -> dropped
    df = spark.createDataFrame(rows, "code string, times int, datetime string, album string, subject string")
    out = {(r.code, r.datadate): r for r in st.journal_purchase_stats(df, "RUN").collect()}
    assert set(out) == {("c1", "2024-03-05"), ("c1", "2024-03-06")}
    r = out[("c1", "2024-03-05")]
    assert (r.buycount, r.year, r.month, r.browsecount, r.subjectsubcategory, r.createon) == (13, 2024, 3, 0, "", "RUN")


def test_web_log_parse_and_counts(spark):
    good = "2024-01-01 00:00:01 ip GET /x - 80 u g Agent+1 - 200 0 0 15"
    lines = [good, good, good.replace("Agent+1", "Agent+2"),
             "#Fields: date time s-ip cs-method cs-uri-stem q port user g cs(User-Agent) r s w t z",
             good.replace("Agent+1", "-"),
             "too few fields here"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    counts = {(r.date, r.userAgent): r["count"] for r in st.ua_daily_counts(st.parse_web_log(df)).collect()}
    assert counts == {("2024-01-01", "Agent+1"): 2, ("2024-01-01", "Agent+2"): 1}


def test_ranking_ties_and_limit(spark):
    log = spark.createDataFrame([("article", r) for r in ["R2", "R1", "R3", "R3", "R1", "R9"]] + [("tushu", "R7")],
                                "ro string, ri string")
    top = [(r.ri, r.visits) for r in st.resource_ranking(log, "article", 3).collect()]
    assert top == [("R1", 2), ("R3", 2), ("R2", 1)]       # ties broken by id, tushu rows ignored


def test_user_category_tags_order_and_bad_rows(spark):
    rows = [("u1", 5, "B"), ("u1", 5, "A"), ("u1", 9, "C"), ("u1", 1, "D"), ("u2", -1, "X"), ("u2", 2, "Y")]
    df = spark.createDataFrame(rows, "user string, count int, category string")
    got = {r.UserName: r.JournalsInterests for r in st.user_category_tags(df, 3).collect()}
    assert got == {"u1": "C;A;B", "u2": "Y"}


def test_top_articles_by_type_one_title_per_file(spark):
    events = spark.createDataFrame([("F1", "CJFD"), ("F1", "期刊"), ("F2", "博士"), ("F3", None)],
                                   "fileName string, dataType string")
    titles = spark.createDataFrame([("F1", "b-title"), ("F1", "a-title"), ("F2", "t2"), ("", "blank")],
                                   "fileName string, title string")
    got = {(r.FileName, r.DataType): (r.Title, r.BuyCount) for r in st.top_articles_by_type(events, titles, 10).collect()}
    assert got == {("F1", "期刊"): ("a-title", 2), ("F2", "博士"): ("t2", 1)}
