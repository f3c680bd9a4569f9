"""A corpus pipeline of five stages over ``documents``.

quality rules -> near copies -> benchmark decontamination -> personal data ->
packing. Each stage works on what its predecessor kept; all but the last return
the columns of the documents. A stage that filters collects the rows to leave
out, by a hash of id and text (and host, for its rules), and reads the documents
once more without them, so texts are shuffled only where those rows are too many
to broadcast.

Edge cases: null ids and texts are handled as in the operators; a repeated row
of a document that stays is dropped with the near copies; an empty table gives
empty stages; extra columns are carried through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagfold.llm import decontam, hostrules, jaccard, packing, pii
from tagfold.llm.common import prepare, small, table, written


def _hosted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row_key``, the hash of id, text and host; hashes skip
    nulls, so a flag tells a missing host from a missing text."""
    return docs.withColumn("_row_key", F.xxhash64("doc_id", "text", F.col("source").isNull(), "source"))


def _without(docs: DataFrame, keys: DataFrame, keyed=jaccard.keyed) -> DataFrame:
    """``docs`` but the rows whose key is in ``keys``, a column of hashes."""
    out = written(keys.toDF("_pipeline_out").distinct(), "pipeline_out")
    return keyed(docs).join(small(out), F.col("_row_key") == F.col("_pipeline_out"), "left_anti").drop("_row_key")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules of their host let pass."""
    prepare(spark)
    judged = hostrules.judged(_hosted(docs).select("_row_key", "source", "text"), ["_row_key"])
    return _without(docs, judged.filter("NOT kept").select("_row_key"), _hosted)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of every group of near copies, once."""
    prepare(spark)
    groups = written(jaccard.joined(docs), "pipeline_groups")
    again = written(groups.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key"), "pipeline_again")
    out = groups.filter("key <> first").select("key")
    kept = _without(docs, out.unionByName(again))
    # documents given more than once, by rows: one of each that stays
    twice = again.join(out.distinct(), "key", "left_anti").withColumnRenamed("key", "_pipeline_key")
    once = (jaccard.keyed(docs).join(small(written(twice, "pipeline_twice")), F.col("_row_key") == F.col("_pipeline_key"))
            .dropDuplicates(["_row_key"]).select(*docs.columns))
    return kept.unionByName(once)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    prepare(spark)
    rows = jaccard.keyed(docs).select(F.col("_row_key").alias("doc_id"), "text")
    leaks = decontam.find_leaks(rows, table(spark, sf_dir, "benchmark"))
    return _without(docs, leaks.select("doc_id"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    prepare(spark)
    return pii.masked(docs, pii.fitted(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality),
    ("near copies", near_copies),
    ("benchmark decontamination", decontaminated),
    ("personal data", masked),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read by the next."""
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline_" + name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


# The packing needs a tokenizer and the field a fitted model, which SQL lacks.
ORACLE_SQL = None
