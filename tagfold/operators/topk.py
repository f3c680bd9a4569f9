"""Exact top-k search over vectors by cells.

Items are grouped into cells by direction (nearest of a few pivots) and by norm
(quarter octaves). A cell is known by its widest angle to the pivot and its
least and greatest norm, from which follows the most that any of its items can
score with a query. Every query first visits the cells of highest bound until
they hold k items; its k-th score so far is a threshold, and of the other cells
it visits those whose bound reaches it, and takes from them the items that reach
it. No other pair is scored, and none that could matter is left out.

Sizes. Pivots are a parameter, so there are at most ``pivots * 128 + 1`` cells,
whose summary goes to the driver and the tasks. Items of one vector are one node
with their k least ids (more cannot be among k best), so a vector that a third
of the items share is one node. A cell is cut into blocks of ``BLOCK`` nodes and
the queries that visit a block into groups of ``GROUP``, so a popular cell is
many tasks' work and a task holds one block at a time.

Null vectors have no row; equal scores (six decimals) go to the smaller id.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

PIVOTS = 64
BLOCK = 2048
GROUP = 8192
DIGITS = 6
# more than rounding and arithmetic can move a score
SLACK = 2e-6


def _table(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _matrix(col):
    """The vectors of an Arrow column of lists, one per row."""
    import numpy as np
    if not len(col):
        return np.zeros((0, 0))
    size = np.diff(col.offsets.to_numpy())
    if (size != size[0]).any():
        raise ValueError("vectors differ in length")
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=float).reshape(len(col), size[0])


def _lists(x):
    """The rows of a matrix as an Arrow column of lists."""
    import numpy as np
    at = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(np.ascontiguousarray(x).ravel()))


def vector_nodes(items: DataFrame, k: int) -> DataFrame:
    """(node, vec, ids): distinct vectors with their ``k`` least ids."""
    v = items.select("id", F.col("vec").cast("array<double>").alias("vec")).where(F.col("vec").isNotNull())
    w = Window.partitionBy("vec").orderBy("id")
    least = v.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)
    return least.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.xxhash64("vec").alias("node"), "vec", "ids")


class CellIndex:
    """Items (id, vec) in cells, for searches of at most ``k`` best."""

    def __init__(self, items: DataFrame, k: int, pivots: int = PIVOTS, block: int = BLOCK, group: int = GROUP):
        import numpy as np
        self.k, self.block, self.group = k, block, group
        ship_package(items.sparkSession)
        nodes = _table(vector_nodes(items, k), "topk_nodes")
        nonzero = nodes.where(F.exists("vec", lambda x: x != 0))
        sample = [r.vec for r in nonzero.select("vec").orderBy(F.xxhash64("node"), "node").limit(pivots).collect()]
        p = np.array(sample, dtype=float)
        self.pivots = p / np.linalg.norm(p, axis=1)[:, None] if len(p) else p
        self.nodes = _table(self._assigned(nodes), "topk_cells")
        rows = self.nodes.groupBy("cell").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("m"), F.max("angle").alias("angle"),
            F.min("norm").alias("lo"), F.max("norm").alias("hi")).orderBy("cell").collect()
        self.summary = [tuple(r) for r in rows]  # at most 128 rows per pivot
        self.visits: list[tuple[DataFrame, int]] = []

    def _assigned(self, nodes: DataFrame) -> DataFrame:
        pivots = self.pivots

        def run(batches):
            import numpy as np
            for b in batches:
                vecs = b.column("vec").to_pylist()
                cell, angle, norm = [], [], []
                for at in range(0, len(vecs), 1024):
                    x = np.array(vecs[at:at + 1024], dtype=float)
                    n = np.sqrt((x * x).sum(axis=1))
                    safe = np.where(n > 0, n, 1)
                    cos = (x / safe[:, None]) @ pivots.T if len(pivots) else np.zeros((len(x), 1))
                    best = cos.argmax(axis=1)
                    step = np.clip(np.floor(4 * np.log2(safe)), -64, 63).astype(int) + 64
                    cell += np.where(n > 0, best * 128 + step, -1).tolist()
                    angle += np.where(n > 0, np.arccos(np.clip(cos.max(axis=1), -1, 1)), 0.0).tolist()
                    norm += n.tolist()
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int64()), pa.array(angle, pa.float64()),
                                                  pa.array(norm, pa.float64())], names=[*b.schema.names, "cell", "angle", "norm"])

        kind = nodes.schema["ids"].dataType.simpleString()
        return nodes.mapInArrow(run, f"node long, vec array<double>, ids {kind}, cell long, angle double, norm double")

    def _visits(self, queries: DataFrame, kind: str, first: bool) -> DataFrame:
        """(q, vec, cell, least): the cells a query has to visit; in the first pass
        those of highest bound that hold k items, in the second the others that
        reach its threshold ``least`` (null: all others)."""
        pivots, summary, k, slack = self.pivots, self.summary, self.k, SLACK

        def run(batches):
            import numpy as np
            cells = np.array([s[0] for s in summary], dtype=np.int64)
            held = np.array([s[2] for s in summary], dtype=np.int64)
            wide, lo, hi = (np.array([s[i] for s in summary], dtype=float) for i in (3, 4, 5))
            axis = pivots[np.maximum(cells // 128, 0)] if len(pivots) else None
            for b in batches:
                vecs, names = _matrix(b.column("vec")), b.column("q")
                least = np.full(len(vecs), -np.inf)
                if not first:
                    least = b.column("least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                for at in range(0, len(vecs), 256):
                    x = vecs[at:at + 256]
                    n = np.sqrt((x * x).sum(axis=1))[:, None]
                    if axis is None:
                        bound = np.zeros((len(x), len(cells)))
                    else:
                        cos = (x / np.where(n > 0, n, 1)) @ axis.T
                        near = np.cos(np.maximum(np.arccos(np.clip(cos, -1, 1)) - wide - 1e-9, 0))
                        size = np.where(near >= 0, hi, lo)
                        bound = n * size * near
                        if kind == "damped":
                            bound = bound / (n * size + 1)
                    order = np.argsort(-bound, axis=1, kind="stable")
                    before = np.cumsum(held[order], axis=1) - held[order]
                    seed = np.zeros(bound.shape, dtype=bool)
                    np.put_along_axis(seed, order, before < k, axis=1)
                    if first:
                        go = seed
                    else:
                        t = least[at:at + 256, None]
                        # the bound is as exact as the numbers it is made of
                        go = ~seed & (bound + slack * np.maximum(1, np.abs(bound)) >= t)
                    i, j = np.nonzero(go)
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(at + i)), _lists(x[i]), pa.array(cells[j]), pa.array(least[at + i])],
                        names=["q", "vec", "cell", "least"])

        q = queries.schema["q"].dataType.simpleString()
        return queries.mapInArrow(run, f"q {q}, vec array<double>, cell long, least double")

    def _scored(self, visits: DataFrame, kind: str) -> DataFrame:
        """(q, id, score) of the k best of every block visited, of those that
        reach the query's threshold."""
        spark = visits.sparkSession
        visits = _table(visits, "topk_visits")
        asked = {r.cell: r.n for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per cell
        sizes = spark.createDataFrame([(s[0], s[1], math.ceil(s[1] / self.block), math.ceil(asked[s[0]] / self.group))
                                       for s in self.summary if s[0] in asked], "_cell long, size long, blocks int, groups int")
        sizes = F.broadcast(sizes)
        self.visits.append((visits.join(sizes, F.col("cell") == F.col("_cell")), len(asked)))
        some = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        q_type = visits.schema["q"].dataType.simpleString()
        ids = self.nodes.schema["ids"].dataType.simpleString()
        told = (self.nodes.join(sizes, F.col("cell") == F.col("_cell")).withColumn("block_no", some("node", "blocks"))
                .withColumn("group_no", every("groups"))
                .select("cell", "block_no", "group_no", F.lit(0).alias("kind"), F.lit(None).cast(q_type).alias("q"), "vec", "ids",
                        F.lit(None).cast("double").alias("least")))
        asks = (visits.join(sizes, F.col("cell") == F.col("_cell")).withColumn("group_no", some("q", "groups"))
                .withColumn("block_no", every("blocks"))
                .select("cell", "block_no", "group_no", F.lit(1).alias("kind"), "q", "vec", F.lit(None).cast(ids).alias("ids"), "least"))
        k, digits = self.k, DIGITS
        item = self.nodes.schema["ids"].dataType.elementType.simpleString()

        def run(batches):
            import numpy as np

            def best(x, own, names, least):
                """Rows of x, ids and scores."""
                out = [[], [], []]
                dot = x @ own.T
                if kind == "damped":
                    n, m = np.sqrt((x * x).sum(axis=1)), np.sqrt((own * own).sum(axis=1))
                    dot = dot / (np.outer(n, m) + 1)
                score = np.round(dot, digits) + 0.0
                reach = score >= least[:, None]
                for r in np.flatnonzero(reach.any(axis=1)).tolist():
                    s, at = score[r], np.flatnonzero(reach[r])
                    if len(at) > k:
                        at = at[s[at] >= np.partition(s[at], len(at) - k)[len(at) - k]]
                    found = sorted((-s[i], d) for i in at.tolist() for d in names[i])[:k]
                    out[0] += [r] * len(found)
                    out[1] += [d for _, d in found]
                    out[2] += [-float(s) for s, _ in found]
                return out

            key, members, names, own = None, [], [], None
            for b in batches:
                col = [b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "block_no", "group_no", "kind")]
                vecs, least = _matrix(b.column("vec")), b.column("least").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                new = np.ones(len(vecs), dtype=bool)
                new[1:] = np.any([c[1:] != c[:-1] for c in col], axis=0)
                start = np.flatnonzero(new).tolist()
                for at, end in zip(start, [*start[1:], len(vecs)]):
                    now = tuple(int(c[at]) for c in col[:3])
                    if now != key:
                        key, members, names, own = now, [], [], None
                    if col[3][at] == 0:
                        members.append(vecs[at:end])
                        names += b.column("ids").slice(at, end - at).to_pylist()
                    elif members:
                        own = np.concatenate(members) if own is None else own
                        for i in range(at, end, 256):
                            j = min(end, i + 256)
                            out = best(vecs[i:j], own, names, least[i:j])
                            yield pa.RecordBatch.from_arrays(
                                [b.column("q").take(pa.array(np.array(out[0], dtype=np.int64) + i)),
                                 pa.array(out[1], b.column("ids").type.value_type), pa.array(out[2], pa.float64())],
                                names=["q", "id", "score"])

        key = ["cell", "block_no", "group_no"]
        return (told.unionByName(asks).repartition(*key).sortWithinPartitions(*key, "kind")
                .mapInArrow(run, f"q {q_type}, id {item}, score double"))

    def search(self, queries: DataFrame, kind: str) -> DataFrame:
        """(q, rank, id, score): the k best items of every query (q, vec) by
        dot product (``dot``) or ``dot / (norm * norm + 1)`` (``damped``)."""
        w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc("id"))
        cut = lambda df: df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= self.k)
        queries = _table(queries.select("q", F.col("vec").cast("array<double>").alias("vec"))
                         .where(F.col("vec").isNotNull()), "topk_queries")
        one = _table(cut(self._scored(self._visits(queries, kind, True), kind)), "topk_first")
        least = one.where(F.col("rank") == self.k).select(F.col("q").alias("_q"), F.col("score").alias("least"))
        open_q = queries.join(least, F.col("q") == F.col("_q"), "left").drop("_q")
        two = self._scored(self._visits(open_q, kind, False), kind)
        return cut(one.select("q", "id", "score").unionByName(two.select("q", "id", "score"))).select("q", "rank", "id", "score")

    def pairs_scored(self) -> int:
        """Pairs of a query and a node that the searches so far have scored."""
        return sum(v.agg(F.sum("size")).first()[0] or 0 for v, _ in self.visits)


def similar_items(items: DataFrame, k: int = 10, **cells) -> DataFrame:
    """The ``k`` most similar other items of each item (id, vec) by
    ``dot / (norm * norm + 1)``: (id, rank, other, score). Items of one vector
    are searched for once, with one more id each in case it is the item's own."""
    index = CellIndex(items, k + 1, **cells)
    found = index.search(index.nodes.select(F.col("node").alias("q"), "vec"), "damped")
    lists = found.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("best"))
    own = items.where(F.col("vec").isNotNull()).select("id", F.xxhash64(F.col("vec").cast("array<double>")).alias("node"))
    rows = own.join(_table(lists, "topk_lists"), F.col("node") == F.col("q"))
    best = F.slice(F.filter("best", lambda x: x["id"] != F.col("id")), 1, k)
    return (rows.select("id", F.posexplode(best).alias("p", "x"))
            .select("id", (F.col("p") + 1).alias("rank"), F.col("x.id").alias("other"), F.col("x.score").alias("score")))


def top_items(users: DataFrame, items: DataFrame, k: int = 10, **cells) -> DataFrame:
    """The ``k`` items (id, vec) of greatest dot product for every user
    (q, vec), over all items: (q, rank, id, score)."""
    return CellIndex(items, k, **cells).search(users, "dot")
