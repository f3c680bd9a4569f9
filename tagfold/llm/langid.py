"""Language identification by bit-sliced Bloom filters of n-grams.

All byte trigrams of a language go into its Bloom filter; the filters are
sliced by bit, so one row of the shared table holds a bit per filter and the
AND of an n-gram's few rows names every language that has it. A second filter
per language holds those of its trigrams that make up at least ``MIN_SHARE`` of
its text: in a large corpus nearly every trigram occurs in every language once,
and these tell which ones belong there. A text's trigrams are looked up at
once, counted per filter, corrected for the false positives that the filter's
own fill predicts; a language's score is the sum over its two filters, and the
largest decides.

The table has at least ``BITS`` rows per trigram of the largest language, up to
``MAX_SLICES`` rows; it is filled by a Spark aggregate, and only its rows reach
the driver. Beyond that bound (there are 2**24 trigrams) all are still
inserted, and the correction accounts for the fuller filters.

Edge cases: a null text or one without a letter is ``und``; without a labelled
row so is everything; rows without a language teach nothing; languages that tie
are decided by their labelled trigrams, then by name, and so is a text none of
whose trigrams is known, with score 0; a long text costs its length; repeated
rows count as often as they occur; an empty table gives an empty result; extra
columns are left aside.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _mix, utf8, written

# share of a language's trigrams that makes one frequent
MIN_SHARE = 1 / 10_000
# rows of the table: per trigram of the largest language, least and most
BITS = 8
SLICES, MAX_SLICES = 1 << 17, 1 << 24
# rows that an n-gram sets
HASHES = 3
LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in LETTER.finditer(text))


def trigrams(text: str) -> np.ndarray:
    """The lower-cased text's byte trigrams as numbers; runs of digits, marks
    and blanks count as one blank."""
    b = utf8(" " + text.lower() + " ")
    letter = ((b >= 97) & (b <= 122)) | (b >= 128)
    keep = letter | np.concatenate(([True], letter[:-1]))
    b = np.where(letter, b, 32)[keep].astype(np.int64)
    return (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]


def counted(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of every trigram of every language in ``docs``."""
    def run(batches):
        seen: dict[str, list] = {}

        def merge(parts):
            grams = np.concatenate([p[0] for p in parts])
            counts = np.concatenate([p[1] for p in parts])
            u, at = np.unique(grams, return_inverse=True)
            return u, np.bincount(at, weights=counts, minlength=len(u)).astype(np.int64)

        for b in batches:
            own: dict[str, list] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own.setdefault(lang, []).append(trigrams(text))
            for lang, g in own.items():
                seen.setdefault(lang, []).append(np.unique(np.concatenate(g), return_counts=True))
                if len(seen[lang]) > 8:
                    seen[lang] = [merge(seen[lang])]
        for lang, parts in seen.items():
            u, c = merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u, pa.int64()),
                                              pa.array(c, pa.int64())], names=["lang", "gram", "n"])

    return (docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), "text")
            .mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def slots(grams: np.ndarray, slices: int, hashes: int = HASHES) -> np.ndarray:
    """The table rows of every n-gram, one line per hash."""
    h = _mix(grams.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.stack([((h + np.uint64(k) * step) % np.uint64(slices)).astype(np.int64) for k in range(hashes)])


def filled(marked: DataFrame, slices: int) -> DataFrame:
    """(row, word, mask) of the table: the bits of 64 filters to a word, from
    rows (bit, gram). Map-side sums leave at most ``slices`` rows per word."""
    def run(batches):
        for b in batches:
            bit, gram = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            at = slots(gram, slices)
            mask = (np.uint64(1) << (bit % 64).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at.ravel()), pa.array(np.tile(bit // 64, len(at))),
                                              pa.array(np.tile(mask, len(at)))], names=["row", "word", "mask"])

    return (marked.select(F.col("bit").cast("long"), "gram").mapInArrow(run, "row long, word long, mask long")
            .groupBy("row", "word").agg(F.bit_or("mask").alias("mask")))


class SlicedFilters:
    """Bloom filters in one table of bit masks: filter i of ``names`` is bit
    i % 64 of word i // 64. A name may have several filters, which add up;
    names that tie are decided by their order."""

    def __init__(self, names: list[str], table: np.ndarray, hashes: int = HASHES):
        self.names, self.table, self.hashes = names, table, hashes
        self.langs = list(dict.fromkeys(names))
        self.lang_of = np.array([self.langs.index(x) for x in names], dtype=np.int64)
        # chance that a foreign n-gram finds all its rows set
        self.false_rate = np.array([(self._bit(table, i).sum() / len(table)) ** hashes for i in range(len(names))])

    @classmethod
    def of(cls, rows: list[tuple[str, int]], slices: int = SLICES) -> SlicedFilters:
        """One filter per name, from (name, n-gram) rows."""
        names = sorted({x for x, _ in rows})
        table = np.zeros((slices, max(1, -(-len(names) // 64))), dtype=np.uint64)
        for i, name in enumerate(names):
            at = slots(np.array([g for x, g in rows if x == name], dtype=np.int64), slices)
            table[at.ravel(), i // 64] |= np.uint64(1) << np.uint64(i % 64)
        return cls(names, table)

    @staticmethod
    def _bit(masks: np.ndarray, i: int) -> np.ndarray:
        return (masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """The bits of all filters that hold each n-gram."""
        at = slots(grams, len(self.table), self.hashes)
        mask = self.table[at[0]]
        for k in range(1, self.hashes):
            mask = mask & self.table[at[k]]
        return mask

    def counts(self, grams: np.ndarray) -> np.ndarray:
        """N-grams per filter, corrected for false positives."""
        u, n = np.unique(grams, return_counts=True)
        mask = self.masks(u)
        hits = np.array([(self._bit(mask, i).astype(np.int64) * n).sum() for i in range(len(self.names))])
        return np.maximum(0.0, (hits - len(grams) * self.false_rate) / (1 - self.false_rate))

    def predict(self, text) -> tuple[str, float]:
        if not text or not self.langs or not has_letter(text):
            return "und", 0.0
        c = np.bincount(self.lang_of, weights=self.counts(trigrams(text)), minlength=len(self.langs))
        best = int(np.argmax(c))
        return self.langs[best], float(c[best] / c.sum()) if c.sum() > 0 else 0.0


def learned(docs: DataFrame, min_share: float = MIN_SHARE) -> SlicedFilters:
    """The filters of the labelled rows of ``docs``; what reaches the driver is
    one row per language and the table's masks."""
    spark = docs.sparkSession
    counts = written(counted(docs), "op7_counts")
    langs = written(counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("grams")), "op7_langs")
    order = sorted(((r.lang, r.total, r.grams) for r in langs.collect()), key=lambda r: (-r[1], r[0]))
    if not order:
        return SlicedFilters([], np.zeros((1, 1), dtype=np.uint64))
    largest = max(r[2] for r in order)
    slices = min(MAX_SLICES, max(SLICES, 1 << (BITS * largest - 1).bit_length()))
    rank = spark.createDataFrame([(i, *r[:2]) for i, r in enumerate(order)], "i long, lang string, total long")
    marked = (counts.join(F.broadcast(rank), "lang")  # one row per language
              .select(F.explode(F.when(F.col("n") >= min_share * F.col("total"), F.array(2 * F.col("i"), 2 * F.col("i") + 1))
                                .otherwise(F.array(2 * F.col("i")))).alias("bit"), "gram"))
    names = [r[0] for r in order for _ in range(2)]
    table = np.zeros((slices, -(-len(names) // 64)), dtype=np.uint64)
    masks = written(filled(marked, slices), "op7_masks").toArrow()
    row, word, mask = (masks.column(i).to_numpy() for i in range(3))
    table[row, word] = mask.view(np.uint64)
    return SlicedFilters(names, table)


def predicted(docs: DataFrame, keys: list[str], model: SlicedFilters) -> DataFrame:
    """``keys`` with lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            rows = [m.predict(t) for t in b.column(len(keys)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))),
                                              pa.array([r[0] for r in rows], pa.string()),
                                              pa.array([r[1] for r in rows], pa.float64())],
                                             names=[*keys, "lang_pred", "score"])

    src = docs.select(*keys, "text")
    schema = ", ".join([f"`{k}` {src.schema[k].dataType.simpleString()}" for k in keys] + ["lang_pred string", "score double"])
    return src.mapInArrow(run, schema)


def held_out():
    """A quarter of the documents, by their id."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 4 == 2


def identify_languages(docs: DataFrame) -> DataFrame:
    """The digest per document; learns from the rows that are not held out."""
    model = learned(docs.filter(~held_out()).select("lang", "text"))
    out = predicted(docs.select("doc_id", held_out().alias("held_out"), "text"), ["doc_id", "held_out"], model)
    return out.select("doc_id", "held_out", "lang_pred", "score")
