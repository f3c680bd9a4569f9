"""Benchmark decontamination by a BM25 index searched with block-max WAND.

The test items are cut into entries of a few dozen words and indexed by word
bigrams (words are lower-cased runs of letters and digits). An entry's impacts
are divided by its score against itself, so one threshold asks every entry for
the same share. Every passage of every document is a query. The pivot test of
WAND runs first on all passages of a document at once: the sum of the largest
impacts of a passage's bigrams bounds its score for any entry. Passages that
reach the threshold walk the posting lists with block-max WAND and return all
entries above it. What is retrieved is verified on the document: the shares
of the item's question (all but its last sentence) and answer (the last one)
that occur in it, by word trigrams, and by its bigram an item of two words.

The index is built in blocks of ``BLOCK_ITEMS`` items, each of which all
documents are searched with, so its size in memory is bounded; document
frequencies are those of all items.

Edge cases: null and empty texts, and items of fewer than two words, match
nothing; repeated documents each give their rows; items repeated in id and text
are one item, and different texts under one id or a null id are items of their
own, each giving its rows; a null document or item id is kept; an empty table on
either side gives an empty result; extra columns are left aside.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, shingle_hashes, utf8, word_hashes, written

PASSAGE_WORDS = 64
STRIDE = 32
ENTRY_WORDS = 40
BLOCK_ITEMS = 20_000
THRESHOLD = 0.4
MIN_PART = 0.5
MIN_ITEM = 0.7
K1, B = 1.2, 0.75
POSTING_BLOCK = 64
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def words_of(text) -> np.ndarray:
    """Hashes of the lower-cased runs of letters, digits and non-ASCII bytes."""
    b = lower_ascii(utf8(text))
    if not len(b):
        return np.zeros(0, dtype=np.uint64)
    edge = np.ones(len(b) + 2, dtype=bool)
    edge[1:-1] = ~(((b >= 97) & (b <= 122)) | ((b >= 48) & (b <= 57)) | (b >= 128))
    change = np.flatnonzero(edge[1:] != edge[:-1])
    return word_hashes(b, change[0::2], change[1::2])


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words; none in a shorter sequence."""
    return shingle_hashes(words, n) if len(words) >= n else words[:0]


def entries_of(text) -> list[np.ndarray]:
    """An item's words in entries of ENTRY_WORDS; a rest of under half joins the last."""
    w = words_of(text)
    cuts = list(range(0, len(w), ENTRY_WORDS))
    if len(cuts) > 1 and len(w) - cuts[-1] < ENTRY_WORDS // 2:
        cuts.pop()
    return [w[a:b] for a, b in zip(cuts, [*cuts[1:], len(w)])]


def parts_of(text: str) -> tuple[str, str]:
    """(question, answer): all but the last sentence, and that; a single
    sentence is cut at two thirds of its words."""
    s = [x for x in SENTENCE.split(text.strip()) if x.strip()]
    if len(s) > 1:
        return " ".join(s[:-1]), s[-1]
    w = text.split()
    k = max(1, 2 * len(w) // 3)
    return " ".join(w[:k]), " ".join(w[k:])


class Index:
    """Impact-ordered postings of a block of entries, with block maxima."""

    def __init__(self, rows, n_entries: int, mean_terms: float):
        """rows: (item, entry terms, their counts, their document frequencies)."""
        self.item = [r[0] for r in rows]
        lists: dict[int, list[tuple[int, float]]] = {}
        for e, (_, terms, tf, df) in enumerate(rows):
            tf, df = np.asarray(tf, dtype=float), np.asarray(df, dtype=float)
            idf = np.log(1 + (n_entries - df + 0.5) / (df + 0.5))
            impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * tf.sum() / max(1.0, mean_terms)))
            for t, x in zip(terms, impact / impact.sum()):
                lists.setdefault(t, []).append((e, float(x)))
        self.terms = np.array(sorted(lists), dtype=np.int64).view(np.uint64)
        order = np.argsort(self.terms, kind="stable")
        self.lists = [lists[int(t)] for t in self.terms[order].view(np.int64)]
        self.terms = self.terms[order]
        self.most = np.array([max(x for _, x in p) for p in self.lists])
        self.block_most = [[max(x for _, x in p[i:i + POSTING_BLOCK]) for i in range(0, len(p), POSTING_BLOCK)]
                           for p in self.lists]

    def look_up(self, g: np.ndarray) -> np.ndarray:
        """Term numbers of bigram hashes, -1 for those of no entry."""
        at = np.minimum(np.searchsorted(self.terms, g), len(self.terms) - 1)
        return np.where(self.terms[at] == g, at, -1)

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all (entry, score) with a score of ``threshold`` or more."""
        cur = {t: 0 for t in terms}
        out = []
        end = len(self.item)

        def at(t):
            return self.lists[t][cur[t]][0] if cur[t] < len(self.lists[t]) else end

        def skip(t, entry):
            p = self.lists[t]
            while cur[t] < len(p) and p[cur[t]][0] < entry:
                nxt = (cur[t] // POSTING_BLOCK + 1) * POSTING_BLOCK  # whole blocks below entry
                cur[t] = nxt if nxt < len(p) and p[nxt][0] <= entry else cur[t] + 1

        while True:
            live = sorted((t for t in terms if at(t) < end), key=at)
            bound, pivot = 0.0, -1
            for i, t in enumerate(live):
                bound += self.most[t]
                if bound >= threshold - 1e-9:
                    pivot = i
                    break
            if pivot < 0:
                return out
            entry = at(live[pivot])
            while pivot + 1 < len(live) and at(live[pivot + 1]) == entry:
                pivot += 1
            for t in live[:pivot + 1]:
                skip(t, entry)
            here = [t for t in live[:pivot + 1] if at(t) == entry]
            if sum(self.block_most[t][cur[t] // POSTING_BLOCK] for t in here) >= threshold - 1e-9:
                score = sum(self.lists[t][cur[t]][1] for t in here)
                if score >= threshold - 1e-9:
                    out.append((entry, score))
            for t in here:
                cur[t] += 1


def known(items: DataFrame) -> DataFrame:
    """(item, item_id, text) of the different items; ``item`` is the hash of
    both, as benchmarks may use one id for several texts."""
    return (items.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
            .select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text"))


def indexed(items: DataFrame) -> DataFrame:
    """(item, entry, terms, tf, df) per entry of the :func:`known` ``items``."""
    def run(batches):
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for e, w in enumerate(entries_of(text)):
                    u, n = np.unique(grams(w, 2), return_counts=True)
                    cols[0] += [item] * len(u)
                    cols[1] += [e] * len(u)
                    cols[2] += u.view(np.int64).tolist()
                    cols[3] += n.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                cols, [pa.int64(), pa.int32(), pa.int64(), pa.int32()])], names=["item", "entry", "term", "tf"])

    terms = written(items.select("item", "text").mapInArrow(run, "item long, entry int, term long, tf int"),
                    "op10_terms")
    df = written(terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "op10_df")
    return (terms.join(df, "term").groupBy("item", "entry")
            .agg(F.collect_list(F.struct("term", "tf", "df")).alias("t"))
            .select("item", "entry", "t.term", "t.tf", "t.df"))


def searched(docs: DataFrame, index: Index, texts: dict, threshold: float) -> DataFrame:
    """(doc_id, item_id, bm25, question_overlap, answer_overlap, item_overlap);
    ``texts`` has (item_id, text) by item."""
    sc = docs.sparkSession.sparkContext
    overlap = {}
    for item, (item_id, text) in texts.items():
        q, a = parts_of(text)
        width = 2 if len(words_of(text)) == 2 else 3
        overlap[item] = item_id, [(n, np.unique(grams(words_of(x), n))) for x, n in ((q, 3), (a, 3), (text, width))]
    shared = sc.broadcast((index, overlap))

    def run(batches):
        ix, parts = shared.value
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words_of(text)
                g = grams(w, 2)
                if not len(g):
                    continue
                t = ix.look_up(g)
                if not (t >= 0).any():
                    continue
                # pivot test: no entry can score more than the sum of the maxima
                reach = np.concatenate(([0.0], np.cumsum(np.where(t >= 0, ix.most[t], 0.0))))
                starts = np.arange(0, max(1, len(w) - PASSAGE_WORDS + STRIDE), STRIDE)
                ends = np.minimum(starts + PASSAGE_WORDS - 1, len(g))
                best: dict[int, float] = {}
                for s, e in zip(starts, ends):
                    if reach[e] - reach[s] >= threshold - 1e-9:
                        terms = np.unique(t[s:e])
                        for entry, score in ix.search(terms[terms >= 0].tolist(), threshold):
                            item = ix.item[entry]
                            best[item] = max(best.get(item, 0.0), score)
                if best:
                    own = {2: g, 3: np.unique(grams(w, 3))}
                    for item, score in sorted(best.items()):
                        item_id, grams_of = parts[item]
                        share = [float(np.isin(p, own[n]).mean()) if len(p) else None for n, p in grams_of]
                        for c, v in zip(out, [doc, item_id, round(score, 6), *share]):
                            c.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, [b.column(0).type, pa.int64()] + [pa.float64()] * 4)],
                names=["doc_id", "item_id", "bm25", "question_overlap", "answer_overlap", "item_overlap"])

    src = docs.select("doc_id", "text")
    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, item_id long, bm25 double, "
                               "question_overlap double, answer_overlap double, item_overlap double")


def retrieved(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """All (document, item) pairs above the BM25 threshold, with overlaps."""
    items = written(known(items), "op10_items")
    ix = written(indexed(items), "op10_index")
    stats = ix.agg(F.count(F.lit(1)).alias("n"), F.avg(F.aggregate("tf", F.lit(0), lambda a, x: a + x)).alias("m")).first()
    blocks = max(1, -(-items.count() // block_items))
    which = F.pmod(F.xxhash64("item"), F.lit(blocks))
    out = None
    for k in range(blocks):
        rows = ix.filter(which == k).orderBy("item", "entry").collect()  # about block_items items
        if not rows:
            continue
        texts = {r.item: (r.item_id, r.text) for r in items.filter(which == k).collect()}
        part = searched(docs, Index([(r.item, r.term, r.tf, r.df) for r in rows], stats.n, stats.m), texts, threshold)
        part = written(part, "op10_block") if blocks > 1 else part
        out = part if out is None else out.unionByName(part)
    if out is None:
        spark = docs.sparkSession
        return spark.createDataFrame([], "doc_id long, item_id long, bm25 double, question_overlap double, "
                                         "answer_overlap double, item_overlap double")
    return out


def leaked():
    """A retrieved pair is a leak when question and answer both occur, or
    nearly the whole item does."""
    part = lambda c: F.coalesce(F.col(c), F.lit(1.0)) >= MIN_PART  # noqa: E731  too short to have a trigram
    return (part("question_overlap") & part("answer_overlap") & (F.col("item_overlap") >= MIN_PART)) | \
        (F.col("item_overlap") >= MIN_ITEM)


def find_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, overlaps) of every leak."""
    return retrieved(docs, items).filter(leaked())
