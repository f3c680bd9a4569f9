"""The command-line jobs end to end on files derived from the sf0.001 tables."""

import os
import tempfile

from pyspark.sql import functions as F

from tagfold import jobs
from tagfold.operators import filters as flt
from tagfold.operators import portrait as pt
from tagfold.plans import fixtures as fx
from tagfold.sources import readers as rd

SF = "/root/testdata/sf0.001"


def test_jobs_chain(spark):
    d = tempfile.mkdtemp(prefix="tagfold-jobs-")
    p = lambda name: os.path.join(d, name)
    log = fx.log(spark, SF)
    fx.raw_log_lines(log).write.text(p("raw"))
    fx.web_log_lines(log).write.text(p("web"))

    jobs.main(["format-log", "--input", p("raw"), "--output", p("log")], spark)
    formatted = spark.read.parquet(p("log"))
    want = flt.bot_filter(rd.read_raw_log(spark.read.text(p("raw"))))
    assert formatted.count() == want.count() > 0

    jobs.main(["portrait-update", "--log", p("log"), "--output", p("p1"), "--as-of", "2024-01-16 00:00:00"], spark)
    jobs.main(["portrait-update", "--portrait", p("p1"), "--log", p("log"), "--output", p("p2"),
               "--as-of", "2024-02-01 00:00:00", "--wide-output", p("wide"), "--table", "jobs_portrait"], spark)
    p1, p2 = spark.read.parquet(p("p1")), spark.read.parquet(p("p2"))
    assert p1.count() > 0 and spark.table("jobs_portrait").count() == p2.count()
    # the non-decayed dimensions simply double when the same log is folded in twice
    j = (p1.where(F.col("dim") == "ConcenedSubject").alias("a")
         .join(p2.alias("b"), ["user", "dim", "module", "tag"]))
    assert j.where(F.abs(F.col("b.weight") - 2 * F.col("a.weight")) > 1e-9).count() == 0
    wide = rd.read_portrait_text(spark, p("wide"))
    assert wide.count() == pt.log_users(formatted).count()

    jobs.main(["serving", "--portrait", p("p2"), "--output", p("serving"), "--as-of", "2024-02-01 00:00:00"], spark)
    assert spark.read.parquet(p("serving")).where("hasPortrait = 1").count() > 0

    jobs.main(["ranking", "--log", p("log"), "--output", p("rank"), "--n", "5"], spark)
    assert spark.read.csv(p("rank")).count() == 5

    jobs.main(["ua-stats", "--input", p("web"), "--output", p("ua")], spark)
    assert spark.read.csv(p("ua")).count() > 0

    jobs.main(["cells", "--log", p("log"), "--output", p("cells")], spark)
    assert spark.read.parquet(p("cells")).count() == 11 * formatted.count()


def test_text_file_jobs(spark):
    d = tempfile.mkdtemp(prefix="tagfold-jobs-")
    p = lambda name: os.path.join(d, name)
    with open(p("journal.tsv"), "w") as f:
        f.write("c1\t2\t2024-03-05 10:00:00\tA\tS\nc1\t1\t2024-03-05 11:00:00\tA\tS\nshort\tline\n")
    jobs.main(["journal-stats", "--input", p("journal.tsv"), "--output", p("journal"), "--created-on", "RUN"], spark)
    assert [r.buycount for r in spark.read.parquet(p("journal")).collect()] == [13]
    with open(p("cat.tsv"), "w") as f:
        f.write("u1\tx\tx\t3\tx\tx\tA\nu1\tx\tx\t5\tx\tx\tB\nbad\n")
    jobs.main(["category-tags", "--input", p("cat.tsv"), "--output", p("cat")], spark)
    assert [r.JournalsInterests for r in spark.read.parquet(p("cat")).collect()] == ["B;A"]
    with open(p("ratings.csv"), "w") as f:
        f.write("\n".join(f"{u},{i},{(u * i) % 5 + 1}" for u in range(1, 8) for i in range(1, 9)) + "\nbad,row\n")
    jobs.main(["als", "--ratings", p("ratings.csv"), "--model", p("model"), "--output", p("als")], spark)
    assert spark.read.parquet(p("als/recommendations")).count() > 0
    assert os.path.isdir(p("model"))


def test_keywords_from_whole_files(spark):
    d = tempfile.mkdtemp(prefix="tagfold-jobs-")
    os.makedirs(os.path.join(d, "docs"))
    texts = {"a.txt": "apple apple banana\ncherry", "b.txt": "banana date", "c.txt": "apple"}
    for name, text in texts.items():
        with open(os.path.join(d, "docs", name), "w") as f:
            f.write(text)
    jobs.main(["keywords", "--text-dir", os.path.join(d, "docs"), "--output", os.path.join(d, "kw"), "--k", "1"], spark)
    top = {os.path.basename(r.doc_id): r.term for r in spark.read.parquet(os.path.join(d, "kw")).collect()}
    # a: apple x2 (df 2) vs cherry x1 (df 1): 2*ln(4/3)=0.575 < ln(4/2)=0.693 -> cherry
    assert top == {"a.txt": "cherry", "b.txt": "date", "c.txt": "apple"}
