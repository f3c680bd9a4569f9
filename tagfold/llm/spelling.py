"""Spelling variants by an index of variable-length grams.

Words are counted over all texts. Grams of 2 to 4 letters are counted over the
words, and those in more than T words' places are the frequent ones: the pruned
dictionary. From every place of a word the gram is extended letter by letter
while it is frequent, so rare beginnings stay short and common ones get long. A
gram depends on its own letters alone (or also on the word's end, which it then
touches), so one edit affects only the grams that cover its place; the largest
such number, counted per word, is the word's affected-gram bound. Two words one
edit apart share all other grams, at the same distance from the start where
they lie before the edit and from the end where they lie after it. So of the
grams in one common order, rare ones first, the ``bound + 1`` first of both
words have one in common, and only those lists are merged; the longer lists are
never opened. As the single edit lies on one side of that gram, its list is
keyed by the gram with all letters of its other side: a beginning of the word up
to the gram's end, or an end from its start. What shares a list is verified by
its edit distance.

T is such that each length has at most ``DICTIONARY`` frequent grams (a count
above total / DICTIONARY can be reached by no more), so the dictionary is small
whatever the corpus. A list of more than ``LIST`` words is not joined as it is:
its words are split by what is left of their other letters after a deletion (of
more than ``LONG`` letters: by their halves), which words one edit apart share
too, so hot lists lose no pair and are not compared all with all.

Edge cases: null and empty texts and a null id (an empty one before the colon)
are allowed; repeated rows count as often as they occur; a very long text is
read in slices cut between words; a very long word is a word like others; ties
between forms go to the smallest word by code points; an empty table gives an
empty result; extra columns are left aside by name.
"""

from __future__ import annotations

import collections
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, written

MIN_LETTERS = 7
MIN_COUNT = 2
DELETE_EVERY = 31
RATIO = 10
SHORT_GRAM, LONG_GRAM = 2, 4
DICTIONARY = 100_000
MIN_T = 32
LIST = 64
LONG = 64
SLICE = 1 << 20
# a link of forms multiplies the count by RATIO, and counts are below 10**18
ROUNDS = 5

RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)
GAP = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = {k: k + 32 for k in range(65, 91)}


def raw_runs(text: str) -> collections.Counter:
    """Counts of the runs of enough letters, of a text read in slices."""
    out = collections.Counter()
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + SLICE) if at + SLICE < len(text) else None
        end = gap.start() if gap else len(text)
        out.update(RUN.findall(text[at:end] if at or gap else text))
        at = end
    return out


def text_words(doc_id, text: str | None) -> collections.Counter:
    """Counts of a document's words of at least ``MIN_LETTERS`` letters."""
    lowered, out = collections.Counter(), collections.Counter()
    for run, n in raw_runs(text or "").items():
        lowered[run.lower() if run.isascii() else run.translate(LOWER)] += n
    head = ("" if doc_id is None else str(doc_id)) + ":"
    for run, n in lowered.items():
        h = zlib.crc32((head + run).encode())
        if h % DELETE_EVERY == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1:]
        if len(run) >= MIN_LETTERS:
            out[run] += n
    return out


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over all documents."""
    def run(batches):
        for b in batches:
            words = collections.Counter()
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                words.update(text_words(doc_id, text.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.string()), pa.array(words.values(), pa.int64())],
                                             names=["word", "n"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


# ---------------------------------------------------------------- index

def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams and their counts, at most ``DICTIONARY`` per length."""
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    least = max(MIN_T, -(-total // DICTIONARY))

    def run(batches):
        for b in batches:
            grams = collections.Counter()
            for w in b.column(0).to_pylist():
                for q in range(SHORT_GRAM, LONG_GRAM + 1):
                    grams.update([w[p:p + q] for p in range(len(w) - q + 1)])
            yield pa.RecordBatch.from_arrays([pa.array(grams.keys(), pa.string()), pa.array(grams.values(), pa.int64())],
                                             names=["gram", "n"])

    counts = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in counts.filter(F.col("n") > int(least)).collect()}


def grams_of(word: str, frequent) -> list[tuple[int, int]]:
    """(start, end) of the word's grams, one from every place."""
    out = []
    for p in range(len(word) - SHORT_GRAM + 1):
        end, last = p + SHORT_GRAM, min(p + LONG_GRAM, len(word))
        while end < last and word[p:end] in frequent:
            end += 1
        out.append((p, end))
    return out


def affected(grams: list[tuple[int, int]]) -> int:
    """The most grams that cover one place: no edit affects more."""
    edge = collections.Counter()
    for p, end in grams:
        edge[p] += 1
        edge[end] -= 1
    now = most = 0
    for p in sorted(edge):
        now += edge[p]
        most = max(most, now)
    return most


def list_entries(word: str, frequent) -> list[int]:
    """The lists that a word is in and looks into, two for each of its ``bound
    + 1`` rarest grams: the length of the beginning up to the gram's end, and
    that of the end from its start as a number below 0. Grams outside the
    dictionary are rarer than those in it."""
    grams = grams_of(word, frequent)
    order = sorted((frequent.get(word[p:e], 0), p - e, word[p:e], p) for p, e in grams)
    first = order[:affected(grams) + 1]
    return sorted({p - size for _, size, _, p in first} | {p - len(word) for *_, p in first})


def postings(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """(key, word, n, cut) for every list entry; a key is the hash of the
    beginning or end that ``cut`` names."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def run(batches):
        known = shared.value
        for b in batches:
            rows = [(w, n, c) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for c in list_entries(w, known)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in
                                              enumerate((pa.string(), pa.int64(), pa.int32()))],
                                             names=["word", "n", "cut"])

    rows = words.select("word", "n").mapInArrow(run, "word string, n long, cut int")
    part = F.expr("if(cut > 0, left(word, cut), right(word, -cut))")
    return rows.select(F.xxhash64(F.col("cut") > 0, part).alias("key"), "word", "n", "cut")


def split_lists(entries: DataFrame) -> DataFrame:
    """(key, word, n) with the keys of lists over ``LIST`` words split."""
    heavy = entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > LIST).select("key")
    heavy = small(written(heavy, "op12_heavy"))
    light = entries.join(heavy, "key", "left_anti").select("key", "word", "n")
    rest = F.expr("if(cut > 0, substring(word, cut + 1), left(word, length(word) + cut))")
    hot = entries.join(heavy, "key", "left_semi").select("key", "word", "n", rest.alias("rest"))
    size = F.length("rest")
    cut = F.transform(F.sequence(F.lit(0), size), lambda i: F.when(i == 0, F.col("rest")).otherwise(
        F.concat(F.col("rest").substr(F.lit(1), i - 1), F.col("rest").substr(i + 1, size))))
    half = F.array(*[F.concat(F.lit(f"{side}:"), x) for k in (1, 0) for side, x in (
        ("l", F.expr(f"left(rest, (length(rest) - {k}) DIV 2)")), ("r", F.expr(f"right(rest, (length(rest) - {k}) DIV 2)")))])
    none = F.array().cast("array<string>")
    parts = F.concat(F.when(size <= LONG + 1, cut).otherwise(none), F.when(size >= LONG, half).otherwise(none))
    hot = (hot.select("key", "word", "n", F.explode(F.array_distinct(parts)).alias("part"))
           .select(F.xxhash64("key", "part").alias("key"), "word", "n"))
    return light.unionByName(hot)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, n_word, n_near_word) of words one edit apart, both ways."""
    entries = written(postings(words, gram_dictionary(words)), "op12_entries")
    lists = split_lists(entries)
    a, b = lists.toDF("key", "word", "n_word"), lists.toDF("_key", "near", "n_near_word")
    same = ((F.col("key") == F.col("_key")) & (F.col("word") < F.col("near"))
            & (F.levenshtein("word", "near", 1) == 1))
    one = a.join(b, same).select("word", "near", "n_word", "n_near_word").distinct()
    one = written(one, "op12_pairs")
    return one.unionByName(one.select(F.col("near").alias("word"), F.col("word").alias("near"),
                                      F.col("n_near_word").alias("n_word"), F.col("n_word").alias("n_near_word")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the paths' ends, by doubling their steps."""
    cur = written(forms.select("word", F.col("form").alias("root")), "op12_steps")
    for _ in range(ROUNDS):
        step = cur.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        nxt = cur.join(step, F.col("root") == F.col("_word"), "left")
        nxt = written(nxt.select("word", F.coalesce("_root", "root").alias("root"),
                                 F.col("_root").isNotNull().alias("moved")), "op12_steps")
        cur = nxt.select("word", "root")
        if nxt.filter("moved").isEmpty():
            break
    return cur


def spelling_variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = written(word_counts(docs), "op12_words")
    best = F.min(F.struct((-F.col("n_near_word")).alias("m"), F.col("near")))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    j = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("best.m") >= RATIO * F.col("n"), F.col("best")).alias("best"))
    j = written(j.select("word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.m")).alias("form_n")), "op12_forms")
    ends = roots(j.filter("form IS NOT NULL"))
    return (j.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
