"""Readers and writers on hand-made lines."""

import os
import tempfile

from pyspark.sql import functions as F

from tagfold.schemas import PORTRAIT_COLUMNS
from tagfold.sinks import writers as wr
from tagfold.sources import readers as rd


def _tmp():
    return tempfile.mkdtemp(prefix="tagfold-test-")


def test_parse_log_lines_rejects_and_defaults(spark):
    lines = spark.createDataFrame([
        ('2024-01-01 [INFO 1] {"vt":"5","un":"a","ac":"buy","ua":null}',),
        ('no marker {"vt":"6"}',),
        ('x 2] {"vt": "7", "un": ',),                        # truncated JSON
        ('x 3] {"vt":8,"ri":"R1"}',),                        # number into a string field
        ('a 1] b 2] {"vt":"9"}',),                           # three pieces
    ], "value string")
    parsed = rd.parse_log_lines(lines).collect()
    assert [r.ok for r in parsed] == [True, False, False, True, False]
    good = rd.read_raw_log(lines).collect()
    assert [(r.vt, r.un, r.ac, r.ua, r.ri) for r in good] == [("5", "a", "buy", "", ""), ("8", "", "", "", "R1")]


def test_portrait_text_roundtrip_with_separator_and_quotes(spark):
    row = {c: "" for c in PORTRAIT_COLUMNS}
    row.update(UserName="u&1", Age=None, Gender=2,
               ConcenedSubject='{"a&b":{"weight":1.0,"dateTime":"1"}}',
               SearchKeyword='{"q\\"x":{"weight":2.0,"dateTime":"2"}}', latest_log_time="t")
    df = spark.createDataFrame([tuple(row[c] for c in PORTRAIT_COLUMNS)],
                               ", ".join(f"{c} {'int' if c in ('Age', 'Gender') else 'string'}"
                                         for c in PORTRAIT_COLUMNS))
    path = wr.write_delimited(df, os.path.join(_tmp(), "p"), "&")
    back = rd.read_portrait_text(spark, path, "&").first()
    assert back.UserName == "u&1" and back.Age == 0 and back.Gender == 2
    assert back.ConcenedSubject == row["ConcenedSubject"]
    assert back.SearchKeyword == row["SearchKeyword"]
    assert back.TotalRelatedAuthor == "{}"


def test_related_authors_and_preferences(spark):
    d = _tmp()
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write('u1&"{""x"":{""weight"":1.0,""dateTime"":""1""}}"&\n&{}&{}\n')
    ra = rd.read_related_authors(spark, os.path.join(d, "a.txt")).collect()
    assert [(r.UserName, r.RecentRelatedAuthor) for r in ra] == [("u1", "{}")]
    with open(os.path.join(d, "p.txt"), "w") as f:
        f.write('1;ann;{"H131":{"k":0.2989}};t\n2;bob;not json;t\n')
    pp = {r.id: r.prefList for r in rd.read_preference_portrait(spark, os.path.join(d, "p.txt")).collect()}
    assert pp["1"] == {"H131": {"k": 0.2989}} and pp["2"] == {}


def test_raw_catalogue_and_whole_files(spark):
    d = _tmp()
    with open(os.path.join(d, "c.txt"), "w") as f:
        f.write("1::x::T&itle::Con&tent::a::b::CLS::z\nbad::line\n")
    cat = rd.read_raw_catalogue(spark, os.path.join(d, "c.txt")).collect()
    assert [(r.id, r.title, r.content, r["class"]) for r in cat] == [("1", "Title", "Content", "CLS")]
    os.makedirs(os.path.join(d, "docs"))
    for n, t in [("a.txt", "one\ntwo"), ("b.txt", "three")]:
        with open(os.path.join(d, "docs", n), "w") as f:
            f.write(t)
    files = {os.path.basename(r.file_name): r.content for r in rd.read_whole_files(spark, os.path.join(d, "docs")).collect()}
    assert files == {"a.txt": "one\ntwo", "b.txt": "three"}


def test_glob_and_cells(spark):
    assert rd.glob_to_like("Mozilla/5.0+*") == "Mozilla/5.0+%"
    assert rd.glob_to_like("a_b?%") == "a\\_b_\\%"
    log = spark.createDataFrame([("1", "u", "g", "read", "article", "R1", "k", "s", "ua", "C1", "au")],
                                "vt string, un string, gki string, ac string, ro string, ri string, rkd string, "
                                "sw string, ua string, rcc string, au string")
    for c in ["klc", "p", "ci", "rccc", "pfc", "dt", "di", "jg", "sou"]:
        log = log.withColumn(c, F.lit(""))
    cells = wr.log_to_cells(log).collect()
    assert [c.qualifier for c in cells] == sorted(wr.CELL_QUALIFIERS)  # byte order within a row key
    assert len({c.row_key for c in cells}) == 1 and cells[0].row_key.endswith("-1")
    back = rd.cell_range_scan(wr.log_to_cells(log), "0", "g", wr.CELL_QUALIFIERS).first()
    assert (back.un, back.vt, back.ri) == ("u", "1", "R1")


def test_tables_go_to_the_session_checkpoint_folder(spark):
    from tagfold.session import checkpoint_dir, materialized
    base = checkpoint_dir(spark)
    assert base == spark.sparkContext.getCheckpointDir()
    calls = []

    def build():
        calls.append(1)
        return spark.range(5).withColumnRenamed("id", "x")
    a = materialized(spark, "test-table", build)
    b = materialized(spark, "test-table", build)
    assert len(calls) == 1 and a.count() == 5 and b.count() == 5
    import re
    norm = lambda u: re.sub(r"^file:/+", "/", u)  # noqa: E731 -- file:/x and file:///x are the same path
    assert all(norm(f).startswith(norm(base).rstrip("/")) for f in a.inputFiles())


def test_rows_to_cells_any_table(spark):
    people = spark.createDataFrame([(1, "ann", 30), (2, "bob", None)], "id int, name string, age int")
    cells = wr.rows_to_cells(people, F.col("id").cast("string"), ["name", "age"], "info").collect()
    assert [(c.row_key, c.family, c.qualifier, c.value) for c in cells] == [
        ("1", "info", "age", "30"), ("1", "info", "name", "ann"), ("2", "info", "age", None), ("2", "info", "name", "bob")]


def test_publish_location_switches_plain_and_partitioned_tables(spark):
    d = _tmp()
    a, b = os.path.join(d, "a"), os.path.join(d, "b")
    spark.range(3).write.parquet(a)
    spark.range(5).write.parquet(b)
    wr.publish_location(spark, "pub_plain", a)
    assert spark.table("pub_plain").count() == 3
    wr.publish_location(spark, "pub_plain", b)
    assert spark.table("pub_plain").count() == 5
    pa, pb = os.path.join(d, "pa"), os.path.join(d, "pb")
    spark.range(4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(pa)
    spark.range(6).withColumn("k", F.col("id") % 3).write.partitionBy("k").parquet(pb)
    wr.publish_location(spark, "pub_parts", pa)
    assert spark.table("pub_parts").count() == 4
    wr.publish_location(spark, "pub_parts", pb)
    assert spark.table("pub_parts").count() == 6 and os.path.isdir(pa)


def test_cells_compute_their_row_key_once_per_row(spark):
    from tagfold.schemas import LOG_FIELDS
    log = spark.range(3).select(*[F.concat(F.lit(c), F.col("id").cast("string")).alias(c) for c in LOG_FIELDS])
    log = log.unionByName(log)  # repeated rows share their key
    plan = wr.log_to_cells(log)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("explode(") < plan.index("md5(")  # the key lies below the cells
    got = [(r.row_key, r.qualifier, r.value) for r in wr.log_to_cells(log).collect()]
    assert got == sorted(got) and len(got) == 6 * len(wr.CELL_QUALIFIERS)


def test_crawlers_are_found_by_plain_searches(spark):
    import re
    from tagfold.functions.tags import BOT_MARKERS, is_human, least_markers
    agents = [None, "", "Mozilla/5.0 (X11; Linux)", "ro.bo.t", "ROBOT", "Windows; U; MSIE 9", "windows, u, msie", "+galaxy+nexus+",
              *BOT_MARKERS, *[m.upper() for m in BOT_MARKERS], *[f"é {m} x" for m in BOT_MARKERS], *[m[:-1] for m in BOT_MARKERS]]
    df = spark.createDataFrame([(a,) for a in agents], "ua string").select("ua", is_human(F.col("ua")).alias("human"))
    old = re.compile("|".join(re.escape(m.lower()) for m in BOT_MARKERS))
    assert all(r.human == (not old.search((r.ua or "").lower())) for r in df.collect())
    assert "RLIKE" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(least_markers(["Bot", "Googlebot", "bot", "spider"])) == ["bot", "spider"]
