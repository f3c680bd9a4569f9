"""Removal of repeated byte strings by a logarithmic family of suffix arrays.

A string of ``LENGTH`` bytes is repeated when it starts anywhere else too.
Documents come in batches. Each batch gets a sparse suffix array: every string
of ``LENGTH`` bytes has one anchor, the gram of ``GRAM`` bytes in it with the
smallest hash, and only suffixes at anchors are kept, ordered by their first
gram and then by the fingerprint of their run (all the strings around them that
have this anchor). Any order in which equal beginnings are neighbours will do,
so hashes stand for the bytes. A new array is scanned against every level of
the family for suffixes that begin alike, then levels of equal size merge, so
there are at most logarithmically many and each suffix is rewritten as often.

What the scans find is settled exactly. Suffixes whose whole runs are equal
repeat all their strings. Where only the beginnings agree, each distinct run's
bytes travel to one task per beginning, and its strings are compared there;
beginnings with more than ``CROWDED`` distinct runs are compared by a shuffle
of the single strings instead.

Edge cases: a null text is empty; a text shorter than ``LENGTH`` has no such
string; rows repeating an id or a text are compared like any others, as rows
are told apart by a hash of id and text (rows equal in both lose the same); texts
longer than ``BLOCK`` bytes are handled in overlapping blocks; an empty table
gives an empty result; extra columns are left aside.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _BASE, _BYTE, _mix, powers, small, utf8, written
from .jaccard import keyed

LENGTH = 200
GRAM = 24
BATCHES = 4
BLOCK = 1 << 20
CROWDED = 100_000
_INVERSE_BASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_INVERSE = np.ones(1, dtype=np.uint64)
_RUN = np.uint64(0xD6E8FEB86659FD93)


def inverse_powers(n: int) -> np.ndarray:
    global _INVERSE
    if len(_INVERSE) < n:
        p = np.full(1 << (n - 1).bit_length(), _INVERSE_BASE, dtype=np.uint64)
        p[0] = 1
        _INVERSE = np.multiply.accumulate(p)
    return _INVERSE


def prefix_hash(b: np.ndarray) -> np.ndarray:
    """H with hash(b[i:j]) = (H[j] - H[i]) * inverse_power(i), modulo 2**64."""
    h = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[b] * powers(len(b) + 1)[:len(b)], out=h[1:])
    return h


def anchored(b: np.ndarray, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK):
    """Runs of the strings of ``length`` bytes that share an anchor:
    (gram hash, fingerprint, first string, last string)."""
    out = []
    for at in range(0, max(0, len(b) - length + 1), block):
        x = b[at:at + block + length - 1]
        h, inv = prefix_hash(x), inverse_powers(len(x) + 1)
        g = _mix((h[gram:] - h[:-gram]) * inv[:len(x) - gram + 1])
        # smallest hash, leftmost among equals, in every window of grams
        m = (g >> np.uint64(32) << np.uint64(32)) | np.arange(len(g), dtype=np.uint64)
        width, span = length - gram + 1, 1
        while span * 2 <= width:
            m = np.minimum(m[:-span], m[span:])
            span *= 2
        if width > span:
            m = np.minimum(m[:span - width], m[width - span:])
        a = (m & np.uint64(0xFFFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(a[1:] != a[:-1]) + 1
        lo = np.concatenate(([0], cut))
        hi = np.concatenate((cut, [len(a)])) - 1
        p = a[lo]
        f = _mix((h[hi + length] - h[lo]) * inv[lo] + _mix((p - lo).astype(np.uint64) * _RUN + (hi - lo).astype(np.uint64)))
        out.append((g[p], f, lo + at, hi + at))
    if not out:
        z = np.zeros(0, dtype=np.uint64)
        return z, z, z.astype(np.int64), z.astype(np.int64)
    return tuple(np.concatenate(c) for c in zip(*out))


def suffixes(docs: DataFrame) -> DataFrame:
    """(g, f, doc_id) of every anchored suffix; here and below ``doc_id`` is
    what tells the rows apart, in :func:`trimmed` the hash of id and text."""
    def run(batches):
        for b in batches:
            g, f, d = [], [], []
            ids = b.column(0)
            for i, t in enumerate(b.column(1).to_pylist()):
                x = anchored(utf8(t))
                g.append(x[0])
                f.append(x[1])
                d.append(np.full(len(x[0]), i))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(g).view(np.int64)), pa.array(np.concatenate(f).view(np.int64)),
                 ids.take(pa.array(np.concatenate(d)))], names=["g", "f", "doc_id"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "g long, f long, doc_id long")


class SuffixFamily:
    """Levels of suffix arrays; a level of rank r holds 2**r batches."""

    def __init__(self):
        self.levels: dict[int, DataFrame] = {}
        self.repeated: list[DataFrame] = []  # beginnings found twice

    @staticmethod
    def _sorted(entries: DataFrame) -> DataFrame:
        # rows of one beginning are spread by document, so a hot one is no single task
        return written(entries.repartition("g", F.pmod("doc_id", F.lit(16))).sortWithinPartitions("g", "f"), "op6_level")

    def add(self, entries: DataFrame) -> None:
        new = self._sorted(entries)
        keys = new.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
        found = [keys.filter("n > 1").select("g")]
        for level in self.levels.values():
            found.append(new.select("g").distinct().join(level.select("g").distinct(), "g"))
        for df in found:
            self.repeated.append(written(df, "op6_found"))
        rank = 0
        while rank in self.levels:
            old = self.levels.pop(rank)
            merged = self._sorted(old.unionByName(new))
            _drop(old)
            _drop(new)
            new, rank = merged, rank + 1
        self.levels[rank] = new

    def _union(self, frames):
        out = frames[0]
        for df in frames[1:]:
            out = out.unionByName(df)
        return out

    def matches(self) -> DataFrame:
        """The suffixes whose beginning was found twice."""
        keys = written(self._union(self.repeated).distinct().withColumnRenamed("g", "_g"), "op6_keys")
        return self._union(list(self.levels.values())).join(small(keys), F.col("g") == F.col("_g")).drop("_g")


def _drop(df: DataFrame) -> None:
    """Delete a merged level's files."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def judged(matches: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Per row: the suffixes that need a look, (g, f, repeated, ship,
    crowded): its whole run is repeated; its run is to be compared."""
    runs = written(matches.groupBy("g", "f").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep")), "op6_runs")
    kinds = written(runs.groupBy("g").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
                    .withColumnRenamed("g", "_g"), "op6_kinds")
    runs = written(runs.join(small(kinds), F.col("g") == F.col("_g"), "left")
                   .select(F.col("g").alias("_g"), F.col("f").alias("_f"), (F.col("n") > 1).alias("repeated"), "rep",
                           F.coalesce("kinds", F.lit(1)).alias("kinds")).filter("repeated OR kinds > 1"), "op6_judged")
    rows = matches.join(small(runs), (F.col("g") == F.col("_g")) & (F.col("f") == F.col("_f")))
    # of equal runs, those of one document stand for all in the comparison
    ship = (F.col("kinds") > 1) & (~F.col("repeated") | F.col("doc_id").eqNullSafe(F.col("rep")))
    return (rows.select("doc_id", F.struct("g", "f", "repeated", ship.alias("ship"), (F.col("kinds") > crowded).alias("crowded"))
                        .alias("s")).distinct()
            .groupBy("doc_id").agg(F.collect_list("s").alias("s"))
            .select(F.col("doc_id").alias("_d"), "s.g", "s.f", "s.repeated", "s.ship", "s.crowded"))


CONTEXT = "g long, doc_id long, first long, bytes binary, crowded boolean"


def contexts(docs_with: DataFrame) -> DataFrame:
    """The bytes of every run to be compared."""
    def run(batches):
        for b in batches:
            out = [[], [], [], [], []]
            cols = [c.to_pylist() for c in b.columns]
            for doc, text, g, f, _, ship, crowded in zip(*cols):
                want = {(x, y): c for x, y, s, c in zip(g, f, ship, crowded) if s}
                if not want:
                    continue
                raw = utf8(text)
                ag, af, lo, hi = anchored(raw)
                raw = raw.tobytes()
                for x, y, i, j in zip(ag.view(np.int64).tolist(), af.view(np.int64).tolist(), lo.tolist(), hi.tolist()):
                    c = want.get((x, y))
                    if c is not None:
                        for col, v in zip(out, (x, doc, i, raw[i:j + LENGTH], c)):
                            col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()])],
                names=["g", "doc_id", "first", "bytes", "crowded"])

    return docs_with.mapInArrow(run, CONTEXT)


def string_hashes(raw: bytes) -> np.ndarray:
    b = np.frombuffer(raw, dtype=np.uint8)
    h = prefix_hash(b)
    return _mix((h[LENGTH:] - h[:-LENGTH]) * inverse_powers(len(b) + 1)[:len(b) - LENGTH + 1])


def _ranges(doc, first, flags):
    """(doc, from, to) of the runs of set flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return [(doc, first + int(i), first + int(j) - 1) for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def compared(ctx: DataFrame) -> DataFrame:
    """(doc_id, s0, s1): ranges of repeated strings among the runs of ``ctx``."""
    def settle(rows):
        hashes = [string_hashes(r[2]) for r in rows]
        _, at, n = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        twice = n[at] > 1
        out, i = [], 0
        for (doc, first, _), h in zip(rows, hashes):
            out += _ranges(doc, first, twice[i:i + len(h)])
            i += len(h)
        return out

    def batch(out):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[], [], []])],
                                          names=["doc_id", "s0", "s1"])

    def near(batches):
        rows, last = [], None
        for b in batches:
            for g, doc, first, raw in zip(*(b.column(i).to_pylist() for i in range(4))):
                if g != last and len(rows) >= 5000:  # a beginning is never cut
                    yield batch(settle(rows))
                    rows = []
                rows.append((doc, first, raw))
                last = g
        if rows:
            yield batch(settle(rows))

    def single(batches):
        for b in batches:
            h, d, s = [], [], []
            for doc, first, raw in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                x = string_hashes(raw)
                h.append(x.view(np.int64))
                d += [doc] * len(x)
                s.append(first + np.arange(len(x)))
            if h:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h)), pa.array(d, pa.int64()),
                                                  pa.array(np.concatenate(s))], names=["h", "doc_id", "s0"])

    out = (ctx.filter("NOT crowded").repartition("g").sortWithinPartitions("g")
           .mapInArrow(near, "doc_id long, s0 long, s1 long"))
    if ctx.filter("crowded").limit(1).count():
        strings = written(ctx.filter("crowded").mapInArrow(single, "h long, doc_id long, s0 long"), "op6_strings")
        twice = written(strings.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                        .select(F.col("h").alias("_h")), "op6_twice")
        out = out.unionByName(strings.join(small(twice), F.col("h") == F.col("_h"))
                              .select("doc_id", "s0", F.col("s0").alias("s1")))
    return out


def trimmed(docs: DataFrame, batches: int = BATCHES, crowded: int = CROWDED) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) per document;
    ``kept`` are the remaining bytes."""
    docs = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = docs.select(F.col("_row_key").alias("doc_id"), "text")
    family = SuffixFamily()
    which = F.pmod(F.xxhash64("doc_id"), F.lit(batches))
    for k in range(batches):
        family.add(suffixes(rows.filter(which == k)))
    looks = written(judged(written(family.matches(), "op6_matches"), crowded), "op6_looks")

    # only rows with a match are read again, by their keys where those are few
    keys = looks.select("_d")
    some = docs.join(small(keys), F.col("_row_key") == F.col("_d"), "left_semi")
    # rows equal in id and text are looked at once: what they share is known to be repeated
    equal = written(some.groupBy("_row_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
                    .select(F.col("_row_key").alias("_e")), "op6_equal")
    same = F.col("_row_key") == F.col("_e")
    once = some.join(small(equal), same, "left_anti").unionByName(
        some.join(small(equal), same, "left_semi").dropDuplicates(["_row_key"]))
    looked = once.join(looks, F.col("_row_key") == F.col("_d"))
    ctx = written(contexts(looked.select("_row_key", "text", "g", "f", "repeated", "ship", "crowded")), "op6_contexts")
    ranges = (compared(ctx).groupBy("doc_id").agg(F.collect_list("s0").alias("s0"), F.collect_list("s1").alias("s1")))
    info = written(looks.select("_d", "g", "f", "repeated").join(
        ranges.withColumnRenamed("doc_id", "_r"), F.col("_d") == F.col("_r"), "left").drop("_r"), "op6_info")

    def cut(bs):
        for b in bs:
            out = [[], [], [], [], []]
            cols = [c.to_pylist() for c in b.columns[1:]]
            for text, g, f, repeated, s0, s1 in zip(*cols):
                raw = utf8(text)
                edge = np.zeros(len(raw) + 1, dtype=np.int64)
                if g:
                    whole = {(x, y) for x, y, r in zip(g, f, repeated) if r}
                    if whole:
                        ag, af, lo, hi = anchored(raw)
                        hit = np.array([k in whole for k in zip(ag.view(np.int64).tolist(), af.view(np.int64).tolist())],
                                       dtype=bool)
                        if hit.any():
                            np.add.at(edge, lo[hit], 1)
                            np.add.at(edge, hi[hit] + LENGTH, -1)
                    if s0:
                        np.add.at(edge, np.array(s0), 1)
                        np.add.at(edge, np.array(s1) + LENGTH, -1)
                gone = np.cumsum(edge[:-1]) > 0
                spans = int(gone[0]) + int(((~gone[:-1]) & gone[1:]).sum()) if len(gone) else 0
                kept = raw[~gone].tobytes()
                for c, v in zip(out, (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(out, [pa.int64()] * 3 + [pa.string(), pa.binary()]))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    none = [F.lit(None).cast(t).alias(c) for c, t in (("g", "array<bigint>"), ("f", "array<bigint>"),
                                                      ("repeated", "array<boolean>"), ("s0", "array<bigint>"),
                                                      ("s1", "array<bigint>"))]
    clean = docs.join(small(keys), F.col("_row_key") == F.col("_d"), "left_anti").select("doc_id", "text", *none)
    hit = some.join(info, F.col("_row_key") == F.col("_d")).select("doc_id", "text", "g", "f", "repeated", "s0", "s1")
    return clean.mapInArrow(cut, schema).unionByName(hit.mapInArrow(cut, schema))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The digest per document."""
    return trimmed(docs).drop("kept")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS (
  SELECT rid, s, b[s:s + 199] AS g
  FROM (SELECT rid, b, unnest(range(1, octet_length(b) - 198)) AS s FROM d)),
f AS (SELECT rid, s FROM (SELECT rid, s, count(*) OVER (PARTITION BY g) AS c FROM w) WHERE c > 1),
i AS (
  SELECT rid, min(s) AS a, max(s) + 199 AS z
  FROM (SELECT rid, s, sum(fresh) OVER (PARTITION BY rid ORDER BY s) AS k
        FROM (SELECT rid, s, CASE WHEN s > lag(s) OVER (PARTITION BY rid ORDER BY s) + 200 THEN 1 ELSE 0 END AS fresh FROM f))
  GROUP BY rid, k),
gap AS (
  SELECT rid, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) + 1 AS x, a - 1 AS y FROM i
  UNION ALL SELECT d.rid, coalesce(z, 0) + 1, octet_length(b) FROM d LEFT JOIN (SELECT rid, max(z) AS z FROM i GROUP BY rid) e ON d.rid = e.rid),
k AS (
  SELECT d.rid, list_reduce(list_prepend(''::BLOB, list(CASE WHEN y >= x THEN b[x:y] ELSE ''::BLOB END ORDER BY x)), lambda p, q: p || q) AS kept
  FROM gap JOIN d ON d.rid = gap.rid GROUP BY d.rid)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(octet_length(b) - octet_length(kept) AS BIGINT) AS n_removed,
       coalesce(n, 0) AS n_spans, sha256(kept) AS kept_sha256
FROM d JOIN k ON d.rid = k.rid LEFT JOIN (SELECT rid, count(*) AS n FROM i GROUP BY rid) j ON j.rid = d.rid
"""
