"""Text features (M1-M6): tokens, TF-IDF keywords, MLlib feature pipelines.

Keyword extraction is plain DataFrame work: tokens are exploded, term
frequencies and document frequencies are partial aggregates (map-side
combined, so a term present in every document still ships one row per map
task), and the per-document top-k is ``row_number() <= k`` (WindowGroupLimit
trims each document before the window's exchange). The tf x df join reads two
written tables and shuffles the rows of rare terms only.

IDF is MLlib's: ``ln((N + 1) / (df + 1))``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonmaps import json_string
from ..functions.stopwords import ENGLISH_STOP_WORDS
from ..session import scratch_path
from .wordvec import document_vectors, threshold

# most terms whose document frequencies are shipped to all tasks
FREQUENT = 1 << 18

# A token is a run of letters, marks and digits of any script, lower-cased.
# Han characters are written without blanks; each is a token of its own.
TOKEN_SPLIT = r"[^\p{L}\p{M}\p{N}]+"
UNSPACED = r"(\p{IsHan})"


def token_array(text: Column) -> Column:
    """Lower-cased tokens of the whole text, of any length."""
    spaced = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), UNSPACED, " $1 ")
    return F.filter(F.split(spaced, TOKEN_SPLIT), lambda t: t != "")


def _table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared folder, and a scan of it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def term_frequencies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, term, tf) over the whole text of every document."""
    toks = docs.select(F.col(id_col).alias("doc_id"), F.explode(token_array(F.col(text_col))).alias("term"))
    return toks.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def _frequencies_in_place(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``term_frequencies``, written, where most documents are one row: these
    are counted where they lie, and only rows that share an id are summed by a
    shuffle of their terms."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    many = _table(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                  .select(F.col("doc_id").alias("_id")), "repeated_ids")

    def run(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            size = b.column(1).value_lengths().to_numpy()
            ends = np.cumsum(size)
            at = 0
            while at < len(size):
                end = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + (1 << 20), "right")))
                told = b.column(1).slice(at, end - at).flatten().dictionary_encode()
                n = max(len(told.dictionary), 1)
                key, tf = np.unique(np.repeat(np.arange(end - at), size[at:end]) * n + told.indices.to_numpy(), return_counts=True)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at + key // n)), told.dictionary.take(pa.array(key % n)), pa.array(tf, pa.int64())],
                                                 names=["doc_id", "term", "tf"])
                at = end

    kind = docs.schema["doc_id"].dataType.simpleString()
    whole = (docs.select("doc_id", token_array(F.col("text")).alias("terms")).where(F.size("terms") > 0)
             .mapInArrow(run, f"doc_id {kind}, term string, tf long"))
    if not many.limit(1).count():
        return _table(whole, "tf")
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    summed = whole.join(many, same, "left_semi").groupBy("doc_id", "term").agg(F.sum("tf").alias("tf"))
    return _table(whole.join(many, same, "left_anti").unionByName(summed), "tf")


def tfidf(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int | None = None,
          frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, term, tf, df, score) with ``score = tf * ln((N+1)/(df+1))``.

    N is one scalar (a count job, or given where a document is several rows,
    whose terms add up); the document frequencies come from the
    (doc, term) aggregate, so a document counts once per term. Both sides of
    the join are written tables: tokenising runs once. The ``FREQUENT`` most
    frequent terms at most, which are most rows, meet their document
    frequencies where they lie; only the rows of rarer terms are shuffled, none
    of which is in many documents."""
    if n_docs is None:
        n_docs = docs.count()
        tf = _frequencies_in_place(docs, id_col, text_col)
    else:
        tf = _table(term_frequencies(docs, id_col, text_col), "tf")
    df = _table(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "df")
    idf = F.log((F.lit(n_docs) + 1.0) / (F.col("df") + 1.0))
    least = threshold(df, "df", frequent)
    top = df.where(F.col("df") >= least).select(F.col("term").alias("_term"), "df")  # at most ``frequent`` rows
    told = tf.join(F.broadcast(top), F.col("term") == F.col("_term"), "left").drop("_term")
    rare = told.where(F.col("df").isNull()).drop("df").join(df.where(F.col("df") < least), "term")
    every = told.where(F.col("df").isNotNull()).unionByName(rare.select(*told.columns))
    return every.select("doc_id", "term", "tf", "df", (F.col("tf") * idf).alias("score"))


def top_keywords(scored: DataFrame, k: int) -> DataFrame:
    """The k highest-scoring terms per document (ties by term), ranked."""
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), F.asc("term"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def tfidf_keywords(docs: DataFrame, k: int = 25) -> DataFrame:
    """M3: (doc_id, rank, term, score) -- top-k TF-IDF terms of each document."""
    top = top_keywords(tfidf(docs), k)
    return top.select("doc_id", F.col("rank").cast("int").alias("rank"), "term",
                      F.round("score", 6).alias("score"))


def line_keywords(lines: DataFrame, n_docs: int, k: int = 25) -> DataFrame:
    """M3 over documents given as rows of lines (doc_id, text), as
    ``readers.read_file_lines`` reads files of any size: term counts are summed
    per task and then per document, so no document is ever one string."""
    top = top_keywords(tfidf(lines, n_docs=n_docs), k)
    return top.select("doc_id", F.col("rank").cast("int").alias("rank"), "term", F.round("score", 6).alias("score"))


def catalog_keywords(items: DataFrame, id_col: str = "doc_id", class_col: str = "source",
                     text_col: str = "text", k: int = 10) -> DataFrame:
    """Per catalogue item the JSON score map ``{class: {keyword:
    score}}`` of its k best TF-IDF keywords (scores with four decimals,
    keywords by score desc then term)."""
    top = top_keywords(tfidf(items, id_col, text_col), k)
    entry = F.concat(json_string(F.col("term")), F.lit(":"),
                     F.format_string("%.4f", F.round("score", 4)))
    per_doc = top.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("rank").alias("k"), entry.alias("e")))).alias("es"))
    cls = items.select(F.col(id_col).alias("doc_id"), F.col(class_col).alias("class"))
    j = per_doc.join(cls, "doc_id")
    body = F.concat(F.lit("{"), F.array_join(F.transform("es", lambda x: x["e"]), ","), F.lit("}"))
    return j.select("doc_id", "class", F.concat(F.lit("{"), json_string(F.col("class")), F.lit(":"), body,
                                                F.lit("}")).alias("keywords"))


def catalogue_scores(items: DataFrame, k: int = 10) -> DataFrame:
    """(id, class, keyword, score) of catalogue items: the given keyword
    map where there is one, else the k best TF-IDF keywords of the title (over
    the items without a map)."""
    given = items.where(F.col("keywords").isNotNull()).select("id", "class", F.explode("keywords").alias("keyword", "score"))
    bare = items.where(F.col("keywords").isNull()).select("id", "class", "title")
    top = top_keywords(tfidf(bare, "id", "title"), k).select(
        F.col("doc_id").alias("id"), F.col("term").alias("keyword"), "score")
    made = top.join(bare.select("id", "class"), "id").select("id", "class", "keyword", "score")
    return given.unionByName(made).withColumn("score", F.round("score", 4))


def hashing_tfidf(docs: DataFrame, num_features: int = 20) -> DataFrame:
    """M1: whitespace Tokenizer + HashingTF + IDF (MLlib), features as an
    array column."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Tokenizer
    from pyspark.ml.functions import vector_to_array
    pipe = Pipeline(stages=[
        Tokenizer(inputCol="text", outputCol="words"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features),
        IDF(inputCol="tf", outputCol="features")])
    d = _table(docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")), "texts")
    out = pipe.fit(d).transform(d)
    return out.select("doc_id", vector_to_array("features").alias("features"))


def count_tfidf(docs: DataFrame, vocab_size: int = 5, stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """M2: tokens + stop words removed + count vectorizer over a vocabulary of
    ``vocab_size`` + IDF; intermediates dropped; features rounded to 6 decimals.

    The token table is written once and read by the vocabulary, the IDF fit and
    the transform. The vocabulary is the ``vocab_size`` most frequent terms,
    ties by term: a partial aggregate plus a top-k (only ``vocab_size`` words
    reach the driver), handed to ``CountVectorizerModel.from_vocabulary``;
    MLlib's own fit breaks count ties arbitrarily."""
    from pyspark.ml.feature import IDF, CountVectorizerModel
    from pyspark.ml.functions import vector_to_array
    content = F.filter(token_array(F.col("text")), lambda t: ~t.isin(list(stop_words)))
    tok = _table(docs.select("doc_id", content.alias("content")), "tokens")
    counts = tok.select(F.explode("content").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    vocab = [r.term for r in counts.orderBy(F.desc("n"), F.asc("term")).limit(vocab_size).collect()]
    feat = CountVectorizerModel.from_vocabulary(vocab, inputCol="content", outputCol="feature").transform(tok)
    out = IDF(inputCol="feature", outputCol="features").fit(feat).transform(feat)
    return out.select("doc_id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


def word2vec_vectors(docs: DataFrame, vector_size: int = 3, window: int = 5) -> DataFrame:
    """M6: document vectors, the mean of the vectors of all their words. Every
    distinct token has a vector; see ``wordvec`` for how they are learned."""
    docs = docs.select("doc_id", "text")
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() < cores:  # a table of few files, which all steps would read in as few tasks
        docs = docs.repartition(cores)
    tok = _table(docs.select("doc_id", token_array(F.col("text")).alias("words")), "tokens")
    return document_vectors(tok, vector_size, window)
