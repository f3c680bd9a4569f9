"""Packing by non-negative least squares over length combinations.

A document's ids (with an end id) are cut at the window; what is left over is
one shorter piece. Piece lengths are counted in grains (rounded up), so the
histogram has a fixed number of bins whatever the corpus. Combinations of one
to three bins that fill the window exactly are enumerated, repeat counts are
solved against the histogram by non-negative least squares and rounded down,
and the pieces left over are packed greedily, also on the histogram. That plan
(bounded by the bins) is all the driver holds; pieces take their places in it
by their rank among the pieces of their bin.

Edge cases: a null or empty text is one piece of the end id; a null document
id is kept; repeated rows are packed as often as they occur; ties in length
are ranked by the written order of the pieces; an empty table gives an empty
result; extra columns are left aside.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import written
from .tokens import word_ids

WINDOW = 4096
GRAIN = 8
DEPTH = 3
END_ID = 2

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, bin int, place long"


def pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, grain: int = GRAIN) -> DataFrame:
    """One row per piece; ``place`` counts the pieces of a bin within one task
    (``part``). Write the result before using it twice."""
    def run(batches):
        words, seen = word_ids(tokenizer), {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            ids, bounds = words.ids(batch.column(1))
            out = []
            for d, a, b in zip(batch.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                own = np.append(ids[a:b], np.uint32(END_ID)).astype("<u4")
                total = len(own)
                for s in range(0, total, window):
                    p = own[s:s + window]
                    k = -(-len(p) // grain)
                    place = seen.get(k, 0)
                    seen[k] = place + 1
                    out.append((d, s, len(p), zlib.crc32(p.tobytes()), total, part, k, place))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()])],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "bin", "place"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


# ------------------------------------------------------------ the plan

def combinations(bins: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Non-increasing combinations of at most ``depth`` bins adding up to ``bins``."""
    out = [(bins,)]
    if depth >= 2:
        out += [(a, bins - a) for a in range((bins + 1) // 2, bins)]
    if depth >= 3:
        out += [(a, b, bins - a - b) for a in range((bins + 2) // 3, bins - 1)
                for b in range(max(1, (bins - a + 1) // 2), min(a, bins - a - 1) + 1)]
    return out


def nnls(combos: list[tuple[int, ...]], hist: np.ndarray, rounds: int = 600) -> np.ndarray:
    """Repeat counts x >= 0 that make ``A x`` closest to ``hist``, where A has a
    column per combination; by accelerated projected gradient on the sparse A,
    restarted whenever the step turns against the gradient."""
    width = max(map(len, combos))
    rows = np.array([[c[i] if i < len(c) else 0 for i in range(width)] for c in combos])  # bin 0: unused slot
    scale = max(1.0, float(hist.max()))
    goal = hist / scale
    goal[0] = 0

    def times(x):
        y = np.zeros(len(hist))
        for i in range(width):
            y += np.bincount(rows[:, i], weights=x, minlength=len(hist))
        y[0] = 0
        return y

    def back(r):
        return r[rows].sum(axis=1)

    v = np.ones(len(combos))  # largest eigenvalue of A'A, by power steps
    for _ in range(30):
        v = back(times(v))
        top = np.linalg.norm(v)
        v /= top
    step = 1 / (1.05 * top)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        gradient = back(times(y) - goal)
        nxt = np.maximum(0, y - step * gradient)
        if np.dot(gradient, nxt - x) > 0:
            t = 1.0
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y, x, t = nxt + (t - 1) / t2 * (nxt - x), nxt, t2
    return x * scale


def plan(hist: np.ndarray, bins: int, depth: int = DEPTH) -> list[tuple[dict[int, int], int]]:
    """[(bin -> copies, repeats)]: sequences that use up ``hist`` (pieces per
    bin, index 1 to ``bins``)."""
    left = hist.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []

    def use(combo, repeats):
        need: dict[int, int] = {}
        for k in combo:
            need[k] = need.get(k, 0) + 1
        repeats = min([repeats, *(int(left[k]) // m for k, m in need.items())])
        if repeats > 0:
            for k, m in need.items():
                left[k] -= m * repeats
            out.append((need, repeats))

    combos = combinations(bins, depth)
    for combo, x in zip(combos, nnls(combos, hist.astype(float))):
        use(combo, int(np.floor(x + 1e-9)))
    # greedily: fill a window with the longest pieces that still fit, and repeat
    # that filling as often as its pieces last
    while left.any():
        combo, room = [], bins
        taken = np.zeros_like(left)
        k = room
        while room and k:
            k = min(k, room)
            fit = np.flatnonzero(left[1:k + 1] > taken[1:k + 1])
            if not len(fit):
                break
            k = int(fit[-1]) + 1
            n = min(room // k, int(left[k] - taken[k]))
            combo += [k] * n
            taken[k] += n
            room -= k * n
        use(combo, int(left.max()))
    return out


class Places:
    """Where the piece of a rank in its bin goes: (sequence, order there)."""

    def __init__(self, steps: list[tuple[dict[int, int], int]]):
        self.by_bin: dict[int, list[tuple]] = {}
        used: dict[int, int] = {}
        first = 0
        for need, repeats in steps:
            order = 0
            for k, m in need.items():
                self.by_bin.setdefault(k, []).append((used.get(k, 0), m, first, order))
                used[k] = used.get(k, 0) + m * repeats
                order += m
            first += repeats
        self.tables = {k: np.array(v, dtype=np.int64) for k, v in self.by_bin.items()}
        del self.by_bin
        self.sequences = first

    def find(self, k: np.ndarray, rank: np.ndarray):
        seq, order = np.zeros(len(k), dtype=np.int64), np.zeros(len(k), dtype=np.int64)
        for b in np.unique(k):
            at = np.flatnonzero(k == b)
            t = self.tables[int(b)]
            row = t[np.searchsorted(t[:, 0], rank[at], side="right") - 1]
            inside = rank[at] - row[:, 0]
            seq[at] = row[:, 2] + inside // row[:, 1]
            order[at] = row[:, 3] + inside % row[:, 1]
        return seq, order


def packed(docs: DataFrame, tokenizer: str, window: int = WINDOW, grain: int = GRAIN, depth: int = DEPTH) -> DataFrame:
    """Every piece with its sequence and its offset in it."""
    p = written(pieces(docs, tokenizer, window, grain), "op2_pieces")
    counts = written(p.groupBy("part", "bin").agg(F.count(F.lit(1)).alias("n")), "op2_counts")
    bins = window // grain
    hist = np.zeros(bins + 1, dtype=np.int64)
    for r in counts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # at most window / grain rows
        hist[r.bin] = r.n
    places = Places(plan(hist, bins, depth))

    # rank in the bin = pieces of the bin in earlier tasks + place within the task
    before = F.sum("n").over(Window.partitionBy("bin").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = counts.select(F.col("part").alias("_part"), F.col("bin").alias("_bin"),
                           F.coalesce(before, F.lit(0)).alias("first"))
    ranked = p.join(firsts, (F.col("part") == F.col("_part")) & (F.col("bin") == F.col("_bin")))

    def seat(batches):
        for b in batches:
            seq, order = places.find(b.column(5).to_numpy(), b.column(6).to_numpy())
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(seq), pa.array(order)],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens",
                                                    "sequence_id", "_order"])

    seated = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "bin",
                           (F.col("first") + F.col("place")).alias("rank")).mapInArrow(
        seat, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, _order long")
    # at most `window` pieces share a sequence
    ahead = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("_order")
                                 .rowsBetween(Window.unboundedPreceding, -1))
    return seated.withColumn("offset", F.coalesce(ahead, F.lit(0))).drop("_order")


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def pack_documents(docs: DataFrame) -> DataFrame:
    """The digest per piece."""
    return packed(docs, tokenizer_path())
