"""Exact Jaccard join of documents as a join in a metric space.

Jaccard distance between shingle sets is a metric, and a link is a distance of
at most a quarter. Documents as the first pivots would not tell most documents
apart: unrelated ones are at distance one from every pivot, and windows of the
triangle inequality then replicate everything. So the first pivots are sets of
one shingle. A document of n shingles is at distance 1 - 1/n from each of its
own and at distance one from all others; it lies on the border of n Voronoi
regions, and the first n // 4 + 1 of them in a fixed order of the pivots are
enough for every linked pair to share a region.

Regions join recursively. In one with at most ``REGION`` members each member is
measured against a member taken as pivot; of the other pairs only those that no
chain of links joins yet, and that share enough regions, are measured. A larger
region's shingle is common: it moves to the end of the pivots' order, and the
members alone join anew in that order (two documents whose only shared regions
are large are both members). Documents that are mostly made of common shingles
stay in large regions. These get the most central documents as pivots; members
that the pivot's links do not reach are compared, in blocks, with the members
in a window of the distance to the pivot, a quarter to either side by the
triangle inequality.

Equal sets are one node throughout. A node is the 64-bit hash of its set, and
shingles are compared by 64-bit hashes.

Edge cases: a null or empty text, or one without words, has no shingles and
links with nothing; fewer than five words are one shingle; rows repeating a
text or an id are copies; a null id is never the smallest one; an empty table
gives an empty result; extra columns are left aside.
"""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ARROW_ROWS, _mix, shingle_set, small, written
from .graph import components

# members of a region that is joined in one place
REGION = 128
# common shingles that are shipped to all tasks (8 bytes each)
MAX_COMMON = 1_000_000
# nodes that a task compares others with at once
BLOCK = 1024
# pairs of a region's members that a task hands over at once
PAIRS = 1 << 16
_NODE = np.uint64(0x9E3779B97F4A7C15)


@contextmanager
def _rows_per_batch(spark, n: int):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, str(ARROW_ROWS))


def node_of(s: np.ndarray) -> int:
    """Hash of a shingle set."""
    whole = np.append(_mix(s), np.array([len(s)], dtype=np.uint64) * _NODE)
    return int(_mix(np.sum(whole, keepdims=True)).view(np.int64)[0])


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row_key``, the hash of id and text: rows with one key are
    repeated rows."""
    return docs.withColumn("_row_key", F.xxhash64("doc_id", "text"))


def nodes(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n, v): set size and node of every document."""
    def run(batches):
        for b in batches:
            sets = [shingle_set(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())], names=["doc_id", "key", "n", "v"])

    return docs.select("doc_id", "key", "text").mapInArrow(run, "doc_id long, key long, n long, v long")


def entries(docs: DataFrame, common: np.ndarray) -> DataFrame:
    """(h, v, n, u, core): a document's first n // 4 + 1 shingles, common ones
    last; ``u`` counts its other shingles, ``core`` marks a common one."""
    shared = docs.sparkSession.sparkContext.broadcast(common)  # at most MAX_COMMON

    def run(batches):
        c = shared.value
        for b in batches:
            h, v, n, u, core = [], [], [], [], []
            for t in b.column(0).to_pylist():
                s = shingle_set(t)
                k = len(s)
                if not k:
                    continue
                node = node_of(s)
                if len(c):
                    at = np.minimum(np.searchsorted(c, s), len(c) - 1)
                    known = c[at] == s
                    s = np.concatenate((s[~known], s[known]))
                    light = int(k - known.sum())
                else:
                    light = k
                p = k // 4 + 1
                h.append(s[:p])
                v.append(np.full(p, node, dtype=np.int64))
                n.append(np.full(p, k, dtype=np.int32))
                u.append(np.full(p, light, dtype=np.int32))
                core.append(np.arange(p) >= light)
            if h:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(h).view(np.int64)), *(pa.array(np.concatenate(x)) for x in (v, n, u, core))],
                    names=["h", "v", "n", "u", "core"])

    return docs.select("text").mapInArrow(run, "h long, v long, n int, u int, core boolean")


REGIONS = "h long, large boolean, v array<bigint>, n array<int>"


def regions(e: DataFrame, most: int = REGION) -> DataFrame:
    """Regions of two members or more: one row each with all members, or, of a
    region with more than ``most``, a row per member."""
    def run(batches):
        keep = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
        open_large = None  # shingle whose members go out one by one

        def out(cols, last):
            nonlocal keep, open_large
            h, v, n = cols
            if not len(h):
                return None
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (v[1:] != v[:-1])  # copies
            h, v, n = h[new], v[new], n[new]
            start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            end = np.concatenate((start[1:], [len(h)]))
            if not last and end[-1] - start[-1] <= most and h[-1] != open_large:
                keep = [x[start[-1]:] for x in (h, v, n)]
                start, end = start[:-1], end[:-1]
            else:
                keep = [x[:0] for x in (h, v, n)]
            rows = [[], [], [], []]
            size = end - start
            for i in np.flatnonzero((size > 1) | (h[start] == open_large) if open_large is not None else size > 1):
                a, z = int(start[i]), int(end[i])
                if z - a > most or h[a] == open_large:
                    open_large = h[a]
                    for j in range(a, z):
                        for c, x in zip(rows, (h[a], True, [v[j]], [n[j]])):
                            c.append(x)
                else:
                    for c, x in zip(rows, (h[a], False, v[a:z], n[a:z])):
                        c.append(x)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, [pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32())])],
                names=["h", "large", "v", "n"])

        for b in batches:
            r = out([np.concatenate((k, b.column(i).to_numpy())) for i, k in enumerate(keep)], False)
            if r is not None:
                yield r
        r = out(keep, True)
        if r is not None:
            yield r

    return e.select("h", "v", "n").repartition("h").sortWithinPartitions("h", "v").mapInArrow(run, REGIONS)


def keys_of(v: DataFrame, reps: DataFrame) -> DataFrame:
    """(v, _k): the distinct nodes ``v``, written, and the keys of their texts.
    Nodes have one key each in ``reps``, so that nothing else is shuffled while
    the nodes are few."""
    v = small(v.select(F.col("v").alias("_v")))
    return written(reps.join(v, F.col("v") == F.col("_v"), "left_semi").select("v", F.col("key").alias("_k")), "op4_keys")


def measured(pairs: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """(a, b, shared, either): sizes of intersection and union of the sets of
    the pairs ``(a, b)``; repeated rows and pairs may repeat it. ``texts`` is
    (key, text), ``reps`` (v, key)."""
    pairs = written(pairs, "op4_pairs")
    used = pairs.select(F.col("a").alias("v")).unionByName(pairs.select(F.col("b").alias("v"))).distinct()
    some = keys_of(written(used, "op4_used"), reps)
    # only the texts of the pairs are shuffled
    t = texts.join(small(some), F.col("key") == F.col("_k")).select("v", "text")
    j = (pairs.join(t.select(F.col("v").alias("a"), F.col("text").alias("ta")), "a")
         .join(t.select(F.col("v").alias("b"), F.col("text").alias("tb")), "b"))

    def run(batches):
        last, own = None, None
        for b in batches:
            rows = [[], [], [], []]
            for x, y, tx, ty in zip(*(b.column(i).to_pylist() for i in range(4))):
                if y != last:
                    own, last = shingle_set(ty), y
                s = shingle_set(tx)
                k = len(np.intersect1d(s, own, assume_unique=True))
                for c, v in zip(rows, (x, y, k, len(s) + len(own) - k)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["a", "b", "shared", "either"])

    return written(j.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long, shared long, either long"), "op4_measured")


def sets_of(v: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """(v, s): the shingle sets of the distinct nodes ``v``, as bytes."""
    keys = keys_of(v, reps).select("_k")

    def run(batches):
        for b in batches:
            s = [shingle_set(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([node_of(x) for x in s], pa.int64()),
                                              pa.array([x.tobytes() for x in s], pa.binary())], names=["v", "s"])

    return written(texts.join(small(keys), F.col("key") == F.col("_k"), "left_semi").select("text")
                   .mapInArrow(run, "v long, s binary").dropDuplicates(["v"]), "op4_sets")


def open_pairs(batches, most: int = PAIRS):
    """(level, k, a, b, na, nb): the pairs of each region (level, k, members)
    whose sizes allow a link and that no chain of links joins, at most ``most``
    and a member's pairs to a batch: a few regions may have millions."""
    out = [[], [], [], [], [], []]

    def batch():
        r = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [pa.int32()] + [pa.int64()] * 5)],
                                       names=["level", "k", "a", "b", "na", "nb"])
        for c in out:
            c.clear()
        return r

    for b in batches:
        for level, k, x in zip(*(b.column(i) for i in range(3))):
            level, k = level.as_py(), k.as_py()
            x = sorted((r["n"], r["v"], r["root"], r["moved"]) for r in x.as_py())
            for i, (n, v, root, mv) in enumerate(x):
                for n2, v2, root2, mv2 in x[i + 1:]:
                    if 4 * n < 3 * n2:
                        break
                    if root != root2 and not (mv and mv2):
                        pair = ((v, v2, n, n2) if v > v2 else (v2, v, n2, n))
                        for c, y in zip(out, (level, k, *pair)):
                            c.append(y)
                if len(out[0]) >= most:
                    yield batch()
    yield batch()


def linked(m: DataFrame) -> DataFrame:
    return m.filter("4 * shared >= 3 * either").select("a", "b")


def _alike(x: str, y: str):
    """Sizes that a link allows."""
    return (4 * F.col(x) >= 3 * F.col(y)) & (4 * F.col(y) >= 3 * F.col(x))


def _best(rows: DataFrame) -> DataFrame:
    """Of rows (v, pv, c) the pivot with the most shared regions per node."""
    return (rows.groupBy("v").agg(F.max(F.struct("c", "pv")).alias("x"))
            .select(F.col("v").alias("a"), F.col("x.pv").alias("b")))


class Join:
    """One run of the join; ``measure`` measures pairs of nodes, ``sets``
    brings the shingle sets of nodes."""

    def __init__(self, measure, sets, block: int = BLOCK):
        self.measure, self.sets, self.block = measure, sets, block
        self.links: list[DataFrame] = []  # those since the last components
        self.told: DataFrame | None = None

    def roots(self) -> DataFrame:
        if self.links:
            self.told = written(components(reduce(DataFrame.unionByName, self.links), self.told), "op4_roots")
            self.links = []
        return small(self.told.select(F.col("node").alias("_v"), "root"))

    def add(self, pairs: DataFrame) -> None:
        self.links.append(linked(self.measure(pairs)))

    # ---- regions of a bounded size

    def members(self, groups: DataFrame) -> DataFrame:
        """Rows (gid, level, k, pv, pn, v, n) of the regions (level, members);
        ``k`` regions have the same members, the first of which is the pivot."""
        g = written(groups.groupBy("level", "members").agg(F.count(F.lit(1)).alias("k"))
                    .withColumn("gid", F.xxhash64("level", "members")).withColumn("p", F.element_at("members", 1)), "op4_groups")
        return g.select("gid", "level", "k", F.col("p.v").alias("pv"), F.col("p.n").alias("pn"),
                        F.explode("members").alias("x")).select("gid", "level", "k", "pv", "pn", "x.v", "x.n")

    def stars(self, member: DataFrame) -> DataFrame:
        """Likely links: each node and the pivot it shares most regions with."""
        return _best(member.filter("v <> pv").filter(_alike("n", "pn")).repartition("v")
                     .groupBy("v", "pv").agg(F.sum("k").alias("c")))

    def crossing(self, member: DataFrame, moved: DataFrame) -> DataFrame:
        """The pairs of a region that no chain of links joins yet and that
        share enough regions. ``moved`` (level, v) are the members of that
        level which join anew in the next one, where pairs of them are found:
        so a pair is of one level.

        Two documents with c shared regions of a level have at most c plus the
        rest of the longer one in common, as all their shared shingles up to
        the end of the shorter prefix are such regions."""
        again = moved.select(F.col("level").alias("_l"), F.col("v").alias("_w"))
        told = (member.join(self.roots(), F.col("v") == F.col("_v"), "left")
                .join(small(again), (F.col("level") == F.col("_l")) & (F.col("v") == F.col("_w")), "left")
                .groupBy("gid", "level", "k").agg(F.collect_list(F.struct(
                    "v", "n", F.coalesce("root", "v").alias("root"), F.col("_w").isNotNull().alias("moved"))).alias("x"))
                .filter(F.size(F.array_distinct("x.root")) > 1))

        rest = F.greatest(*[F.col(z) - F.floor(F.col(z) / 4) - 1 for z in ("na", "nb")])
        return (told.select("level", "k", "x").mapInArrow(open_pairs, "level int, k long, a long, b long, na long, nb long")
                .groupBy("level", "a", "b", "na", "nb").agg(F.sum("k").alias("c"))
                .filter(F.col("c") + rest >= F.ceil(3 * (F.col("na") + F.col("nb")) / 7)).select("a", "b"))

    # ---- regions of any size, by document pivots

    @staticmethod
    def central(rows: DataFrame) -> DataFrame:
        """Rows (v, n, u, pv, pn) of regions (r, v, n, u): the pivot is the
        member with the fewest uncommon shingles."""
        p = written(rows.groupBy(F.col("r").alias("_r")).agg(F.min(F.struct("u", "v", "n")).alias("p")), "op4_central")
        return rows.join(small(p), F.col("r") == F.col("_r")).select(
            "v", "n", "u", F.col("p.v").alias("pv"), F.col("p.n").alias("pn"))

    def by_document_pivots(self, central: DataFrame) -> DataFrame | None:
        """Links of large regions. Regions with common members make a cluster,
        which gets its most central document as pivot. Only members that the
        pivot's links do not reach are left to compare, in blocks, with the
        members whose distance to the pivot is at most a quarter from theirs."""
        pairs = central.filter("v <> pv").select(F.col("v").alias("a"), F.col("pv").alias("b"))
        cluster = written(components(pairs), "op4_clusters").select(F.col("node").alias("_c"), F.col("root").alias("cluster"))
        node = (central.groupBy("v").agg(F.min("n").alias("n"), F.min("u").alias("u"))
                .join(small(cluster), F.col("v") == F.col("_c")).drop("_c")
                .join(self.roots(), F.col("v") == F.col("_v"), "left")
                .select("v", "n", "u", "cluster", F.coalesce("root", "v").alias("root")))
        node = written(node, "op4_nodes")
        # the pivot is taken from the cluster's largest component
        parts = node.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct("u", "v")).alias("p"))
        heads = written(parts.groupBy(F.col("cluster").alias("_c")).agg(
            F.max(F.struct("m", "root", "p")).alias("x"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
            .select("_c", F.col("x.p.v").alias("pv"), F.col("x.root").alias("proot")), "op4_heads")
        node = written(node.join(small(heads), F.col("cluster") == F.col("_c")).drop("_c"), "op4_open")
        if not node.limit(1).count():
            return None
        d = self.measure(node.filter("v <> pv").select(F.col("v").alias("a"), F.col("pv").alias("b")))
        d = written(d.select(F.col("a").alias("_v"), F.floor(4 * (F.col("either") - F.col("shared")) / F.col("either"))
                             .cast("int").alias("cell")).distinct(), "op4_distances")
        node = written(node.join(small(d), F.col("v") == F.col("_v"), "left").select(
            "v", "cluster", "root", (F.col("root") != F.col("proot")).alias("outside"), F.coalesce("cell", F.lit(0)).alias("cell")),
            "op4_cells")

        # windows: members go to the cells of all they can link with
        near = node.withColumn("t", F.explode(F.sequence(F.greatest(F.col("cell") - 1, F.lit(0)), F.col("cell") + 1)))
        count = written(near.groupBy(F.col("cluster").alias("_c"), F.col("t").alias("_t")).agg(
            F.sum((F.col("outside") & (F.col("cell") == F.col("t"))).cast("int")).alias("no"), F.count(F.lit(1)).alias("nm"))
            .filter("no > 0").select("_c", "_t", F.ceil(F.col("no") / self.block).cast("int").alias("ob"),
                                     F.ceil(F.col("nm") / (8 * self.block)).cast("int").alias("mb")), "op4_blocks")
        near = near.join(small(count), (F.col("cluster") == F.col("_c")) & (F.col("t") == F.col("_t")))
        one = lambda n: F.pmod(F.xxhash64("v"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        asks = (near.filter(F.col("outside") & (F.col("cell") == F.col("t"))).withColumn("o", one("ob"))
                .withColumn("m", every("mb")).withColumn("kind", F.lit(0)))
        told = near.withColumn("m", one("mb")).withColumn("o", every("ob")).withColumn("kind", F.lit(1))
        cols = ["cluster", "t", "o", "m", "kind", "v", "root"]
        rows = asks.select(*cols).unionByName(told.select(*cols))
        rows = rows.select(F.xxhash64("cluster", "t", "o", "m").alias("key"), "kind", "v", "root")
        sets = self.sets(node.select("v")).withColumnRenamed("v", "_v")
        rows = rows.join(sets, F.col("v") == F.col("_v")).select("key", "kind", "v", "root", "s")

        def run(batches):
            key, asked, parent = None, None, {}
            own: list[tuple[int, int, np.ndarray]] = []

            def find(x):  # components so far, by their roots
                while parent.setdefault(x, x) != x:
                    parent[x] = x = parent[parent[x]]
                return x

            for b in batches:
                a, z = [], []
                for k, kind, v, root, raw in zip(*(b.column(i).to_pylist() for i in range(5))):
                    if k != key:
                        key, asked, parent, own = k, None, {}, []
                    s = np.frombuffer(raw, dtype=np.uint64)
                    if kind == 0:
                        own.append((v, root, s))
                        continue
                    if asked is None:
                        if not own:
                            continue
                        h = np.concatenate([x[2] for x in own])
                        who = np.repeat(np.arange(len(own)), [len(x[2]) for x in own])
                        order = np.argsort(h, kind="stable")
                        asked = (h[order], who[order], np.array([len(x[2]) for x in own]))
                    h, who, size = asked
                    lo, hi = np.searchsorted(h, s, "left"), np.searchsorted(h, s, "right")
                    n = hi - lo
                    at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                    shared = np.bincount(who[at], minlength=len(size))
                    for i in np.flatnonzero(4 * shared >= 3 * (size + len(s) - shared)):
                        x, y = find(own[i][1]), find(root)
                        if x != y:
                            parent[x] = y
                            a.append(v)
                            z.append(own[i][0])
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["a", "b"])

        return written(rows.repartition("key").sortWithinPartitions("key", "kind", "v").mapInArrow(run, "a long, b long"), "op4_found")


def joined(docs: DataFrame, region: int = REGION, max_common: int = MAX_COMMON, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, first) of every document;
    ``first`` is the key of its component's document of smallest id."""
    spark = docs.sparkSession
    docs = keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).withColumnRenamed("_row_key", "key")
    base = written(nodes(docs), "op4_nodes")
    reps = written(base.filter("v IS NOT NULL").groupBy("v").agg(F.min("key").alias("key"), F.max("key").alias("last")), "op4_reps")
    copied = reps.filter("key <> last").select(F.col("v").alias("_v"), F.col("key").alias("_k"))
    copies = written(base.join(small(copied), F.col("v") == F.col("_v"))
                     .filter("key <> _k").select(F.col("key").alias("_c")), "op4_copies")
    texts = docs.select("key", "text")
    firsts = texts.join(small(copies), F.col("key") == F.col("_c"), "left_anti")

    run = Join(lambda pairs: measured(pairs, texts, reps), lambda v: sets_of(v, texts, reps), block)
    groups: list[DataFrame] = []
    large: list[DataFrame] = []
    # small tables come by Arrow, which starts no Python workers beside those of the texts
    moved: list[DataFrame] = [spark.createDataFrame(pa.table({"level": pa.array([], pa.int32()), "v": pa.array([], pa.int64())}))]
    common = np.zeros(0, dtype=np.uint64)
    level, before = firsts, None
    while True:
        with _rows_per_batch(spark, 4096):  # of texts as well
            e = entries(level, common)
            if len(common):
                e = written(e, "op4_entries")
                large.append(e.filter("core").select(F.col("h").alias("r"), "v", "n", "u"))
            r = written(regions(e.filter("NOT core"), region), "op4_regions")
        at = len(groups)
        groups.append(r.filter("NOT large").select(F.lit(at).alias("level"), F.arrays_zip("v", "n").alias("members")))
        hot = r.filter("large").select("h", F.element_at("v", 1).alias("v"), F.element_at("n", 1).alias("n"))
        members = written(hot.select("v").distinct(), "op4_members")
        n = members.count()
        # members that hardly get fewer are told apart by document pivots instead
        room = max_common - len(common) if before is None or 2 * n <= before else 0
        most = hot.groupBy("h").agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), "h")
        new = [x.h for x in most.limit(room + 1).collect()] if n and room > 0 else []
        rest, new = len(new) > room or room <= 0, new[:max(room, 0)]
        taken = spark.createDataFrame(pa.table({"_h": pa.array(new, pa.int64())}))  # at most max_common
        if n and rest:  # what is not taken stays a region
            large.append(hot.join(F.broadcast(taken), F.col("h") == F.col("_h"), "left_anti")
                         .select(F.col("h").alias("r"), "v", "n", F.col("n").alias("u")))
        if not new:
            break
        before = n
        if rest:
            members = written(hot.join(F.broadcast(taken), F.col("h") == F.col("_h"), "left_semi").select("v").distinct(), "op4_members")
        moved.append(members.select(F.lit(at).alias("level"), "v"))
        common = np.union1d(common, np.array(new, dtype=np.int64).view(np.uint64))
        level = texts.join(small(keys_of(members, reps).select("_k")), F.col("key") == F.col("_k"), "left_semi")

    member = run.members(reduce(DataFrame.unionByName, groups))
    star = run.stars(member)
    if large:
        central = written(run.central(written(reduce(DataFrame.unionByName, large), "op4_large")), "op4_told_apart")
        star = star.unionByName(_best(central.filter("v <> pv").filter(_alike("n", "pn"))
                                      .groupBy("v", "pv").agg(F.count(F.lit(1)).alias("c"))))
    run.add(star)
    run.add(run.crossing(member, reduce(DataFrame.unionByName, moved)))
    if large:
        found = run.by_document_pivots(central)
        if found is not None:
            run.links.append(found)
    roots = run.roots()
    x = written(base.join(roots, F.col("v") == F.col("_v"), "left")
                .select("doc_id", "key", "n", F.coalesce("root", "v").alias("root")), "op4_told")
    # a missing id comes after all others
    least = written(x.filter("root IS NOT NULL").groupBy(F.col("root").alias("_r")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("least")), "op4_least")
    return (x.join(small(least), F.col("root") == F.col("_r"), "left")
            .select("doc_id", "key", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
                    F.when(F.col("n") == 0, F.col("key")).otherwise(F.col("least.key")).alias("first")))


def join_near_copies(docs: DataFrame) -> DataFrame:
    """The digest per document."""
    return joined(docs).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS x
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS c FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id
                    GROUP BY p.doc_id, q.doc_id)
  JOIN n AS na ON na.doc_id = a JOIN n AS nb ON nb.doc_id = b
  WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
"""
