"""A Merkle manifest of documents as a postorder append log.

Every source is a tree of fan-out 16 over its documents by id, and the subroots
of all sources are the leaves of one more tree. A builder takes an aligned block
of 256 consecutive nodes of a tree and appends the nodes of its two levels in
the order in which they are complete, the postorder of its subtree; the blocks'
roots are the nodes of the next round, until a tree has one block left. Where a
node lies in a log follows from the sizes of the subtrees before it
(``postorder``), so no pointers are stored: a proof takes its siblings from the
log of its block by position and the levels above from the block's own proof,
which goes down from the root, once per block and not once per document.

Builders are keyed by (source, block), so a source that holds a third of all
rows is as many builders as its length asks for, each of at most 256 nodes.
Indexes in a source come from a range partition and prefix sums per partition.

Edge cases: every column may be null (``-`` in the leaf); null ids come first,
and ties are ordered by leaf, so repeated rows are neighbours with equal leaves;
a null id is never tampered with; a null source is a source of its own, before
all others; very long texts are hashed where they are scanned and never
shuffled; an empty table gives an empty result; extra columns are left aside.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small, written

FANOUT = 16
LEVELS = 2
BLOCK = FANOUT ** LEVELS
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def H(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h = 0
    while FANOUT ** h < n:
        h += 1
    return h


def postorder(level: int, index: int, n: int, top: int) -> int:
    """Position in the log of node ``index`` of ``level``, in a tree of ``n``
    leaves with ``top`` levels above them: what is complete once its last leaf
    is there, but its own ancestors."""
    end = min((index + 1) * FANOUT ** level, n)
    below = sum(-(-end // FANOUT ** j) for j in range(level + 1))
    return below + sum((end - 1) // FANOUT ** j for j in range(level + 1, top + 1)) - 1


def append_log(leaves: list[str], top: int) -> list[str]:
    """Digests of all nodes of the tree of ``top`` levels over ``leaves``, in
    completion order."""
    log: list[str] = []
    runs: list[list[str]] = [[] for _ in range(top + 1)]

    def add(level, digest):
        log.append(digest)
        if level < top:
            runs[level].append(digest)
            if len(runs[level]) == FANOUT:
                close(level)

    def close(level):
        digest, runs[level] = H("".join(runs[level])), []
        add(level + 1, digest)

    for leaf in leaves:
        add(0, leaf)
    for level in range(top):
        if runs[level]:
            close(level)
    return log


def block_top(n: int) -> int:
    """Levels that a block of a round of ``n`` nodes builds."""
    return LEVELS if n > BLOCK else height(n)


def block_siblings(log: list[str], n: int, top: int):
    """``[(place in run, siblings)]`` by level for each of the ``n`` first nodes
    of a block's log."""
    levels = [[log[postorder(k, i, n, top)] for i in range(-(-n // FANOUT ** k))] for k in range(top)]
    for leaf in range(n):
        steps = []
        for k, nodes in enumerate(levels):
            i = leaf // FANOUT ** k
            first = i - i % FANOUT
            steps.append((i - first, "".join(nodes[first:i] + nodes[i + 1:first + FANOUT])))
        yield steps


def fold(digest: str, steps) -> str:
    """The root over ``digest``, from its place and siblings level by level."""
    for place, siblings in steps:
        digest = H(siblings[:64 * place] + digest + siblings[64 * place:])
    return digest


# ---------------------------------------------------------------- leaves

def leaf_digest(text) -> F.Column:
    def field(c):
        s = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    cols = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


def leaf_rows(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, digest, tampered): ``tree`` orders a null source first,
    ``tampered`` is null where nothing is changed."""
    hit = (F.crc32(F.col("doc_id").cast("string")) % 5) == 0
    low = F.translate("text", UPPER, LOWER)
    changed = F.when(hit & F.col("text").isNotNull() & (F.col("text") != low), leaf_digest(low))
    return docs.select(F.coalesce(F.concat(F.lit("+"), F.col("source")), F.lit("")).alias("tree"), "doc_id",
                       leaf_digest(F.col("text")).alias("digest"), changed.alias("tampered"))


def indexed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx``, their place in their tree, and ``n``, its leaves."""
    at = (rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
          .withColumn("_at", F.monotonically_increasing_id()))
    at = written(at, f"{name}_sorted").withColumn("_part", F.shiftright("_at", 33))
    runs = at.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("tree")
    runs = runs.select("tree", "_part", "_first", F.sum("_n").over(w).alias("n"),
                       (F.sum("_n").over(w.orderBy("_part")) - F.col("_n")).alias("_before"))
    j = at.join(small(written(runs, f"{name}_runs")), ["tree", "_part"])
    return j.withColumn("idx", F.col("_before") + F.col("_at") - F.col("_first")).drop("_at", "_part", "_first", "_before")


# ---------------------------------------------------------------- builders

def build(rows: DataFrame, extra: list[str], name: str) -> list[DataFrame]:
    """The rounds of the trees over ``rows`` (tree, idx, n, digest and
    ``extra``), leaves first: tables of (tree, block, n, log, nodes), where
    ``nodes`` has the extra columns of the block's nodes in order."""
    rounds, cur = [], rows
    while True:
        node = F.struct("idx", "digest", *[F.col(c) for c in extra])
        seg = cur.groupBy("tree", F.expr(f"idx DIV {BLOCK}").alias("block")).agg(
            F.first("n").alias("n"), F.array_sort(F.collect_list(node)).alias("nodes"))
        seg = seg.select("tree", "block", "n", F.col("nodes.digest").alias("leaves"),
                         *[F.col(f"nodes.{c}").alias(c) for c in extra])

        def run(batches):
            for b in batches:
                logs = [append_log(x.as_py(), block_top(n))
                        for x, n in zip(b.column("leaves"), b.column("n").to_pylist())]
                keep = [i for i, c in enumerate(b.schema.names) if c != "leaves"]
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(i) for i in keep], pa.array([len(x) for x in b.column("leaves")], pa.int32()),
                     pa.array(logs, pa.list_(pa.string()))],
                    names=[*[b.schema.names[i] for i in keep], "width", "log"])

        kinds = ", ".join(f"`{c}` {seg.schema[c].dataType.simpleString()}" for c in seg.columns if c != "leaves")
        seg = written(seg.mapInArrow(run, f"{kinds}, width int, log array<string>"), f"{name}_log")
        rounds.append(seg)
        more = seg.filter(F.col("n") > BLOCK)
        if more.isEmpty():
            return rounds
        cur = more.select("tree", F.col("block").alias("idx"), F.expr(f"(n + {BLOCK - 1}) DIV {BLOCK}").alias("n"),
                          F.element_at("log", -1).alias("digest"))
        extra = []


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest) of the root of each tree."""
    out = None
    for seg in rounds:
        r = seg.filter(F.col("n") <= BLOCK).select("tree", F.element_at("log", -1).alias("digest"))
        out = r if out is None else out.unionByName(r)
    return out


def log_rows(rounds: list[DataFrame]) -> DataFrame:
    """(tree, pos, level, idx, digest): the nodes of the trees at their postorder
    positions in the log of their whole tree."""
    n_all = rounds[0].groupBy("tree").agg(F.first("n").alias("_leaves"))
    out = None
    for r, seg in enumerate(rounds):
        def run(batches, r=r):
            for b in batches:
                for row in range(b.num_rows):
                    x = b.slice(row, 1).to_pylist()[0]
                    top, all_top = block_top(x["n"]), height(x["_leaves"])
                    out = []
                    for k in range(0 if r == 0 else 1, top + 1):
                        for i in range(-(-x["width"] // FANOUT ** k)):
                            level, index = r * LEVELS + k, x["block"] * FANOUT ** (LEVELS - k) + i
                            out.append((x["tree"], postorder(level, index, x["_leaves"], all_top), level, index,
                                        x["log"][postorder(k, i, x["width"], top)]))
                    yield pa.RecordBatch.from_pylist(
                        [dict(zip(("tree", "pos", "level", "idx", "digest"), o)) for o in out],
                        schema=pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("level", pa.int32()),
                                          ("idx", pa.int64()), ("digest", pa.string())]))

        rows = (seg.join(n_all, "tree").select("tree", "block", "n", "width", "log", "_leaves")
                .mapInArrow(run, "tree string, pos long, level int, idx long, digest string"))
        out = rows if out is None else out.unionByName(rows)
    return out


# ---------------------------------------------------------------- proofs

STEPS = "array<struct<place:int,siblings:string>>"
_STEPS = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))


def _steps(steps):
    return [{"place": p, "siblings": s} for p, s in steps]


def proofs(rounds: list[DataFrame], above: DataFrame, extra: list[str], kinds: str, each, name: str) -> DataFrame:
    """Proofs go down from ``above`` (tree, steps and other columns, per tree)
    to the leaves. ``each(row, steps of a leaf, its place in the row)`` gives
    the output tuple of a leaf, of columns ``kinds``."""
    keep = [c for c in above.columns if c not in ("tree", "steps")]
    seg_steps = None
    for r in range(len(rounds) - 1, -1, -1):
        seg = rounds[r]
        last = seg.filter(F.col("n") <= BLOCK).join(above, "tree")
        if seg_steps is not None:
            last = last.unionByName(seg.filter(F.col("n") > BLOCK).join(seg_steps, ["tree", "block"]))
        if r:
            def run(batches):
                for b in batches:
                    for i in range(b.num_rows):
                        x = b.slice(i, 1).to_pylist()[0]
                        up = [(s["place"], s["siblings"]) for s in x["steps"]]
                        w = x["width"]
                        mine = [_steps([*s, *up]) for s in block_siblings(x["log"], w, block_top(x["n"]))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([x["tree"]] * w, pa.string()),
                             pa.array([x["block"] * BLOCK + j for j in range(w)], pa.int64()),
                             *[pa.array([x[c]] * w, pa.string()) for c in keep], pa.array(mine, _STEPS)],
                            names=["tree", "block", *keep, "steps"])

            cols = ", ".join(f"`{c}` string" for c in keep)
            out = last.select("tree", "block", "n", "width", "log", *keep, "steps").mapInArrow(
                run, f"tree string, block long{', ' + cols if cols else ''}, steps {STEPS}")
            seg_steps = written(out, f"{name}_steps")

    def leaves(batches):
        for b in batches:
            for i in range(b.num_rows):
                x = b.slice(i, 1).to_pylist()[0]
                up = [(s["place"], s["siblings"]) for s in x["steps"]]
                own = block_siblings(x["log"], x["width"], block_top(x["n"]))
                # the first nodes of the log are not contiguous: by position
                x["leaves"] = [x["log"][postorder(0, j, x["width"], block_top(x["n"]))] for j in range(x["width"])]
                out = [each(x, [*s, *up], j) for j, s in enumerate(own)]
                yield pa.RecordBatch.from_arrays([pa.array(col, t) for col, t in zip(zip(*out), each.types)],
                                                 names=each.names)

    return last.select("tree", "block", "n", "width", "log", *extra, *keep, "steps").mapInArrow(leaves, kinds)


def _source_leaf(x, steps, j):
    return x["source_tree"][j], _steps(steps), x["leaves"][j], x["root"]


_source_leaf.names = ["tree", "steps", "subroot", "root"]
_source_leaf.types = [pa.string(), _STEPS, pa.string(), pa.string()]


def _document_leaf(x, steps, j):
    leaf = x["leaves"][j]
    folded = fold(x["tampered"][j] or leaf, steps)
    return (x["doc_id"][j], leaf, x["subroot"], x["root"], H("".join(s for _, s in steps)), folded, folded == x["root"])


_document_leaf.names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
_document_leaf.types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]


def manifest(docs: DataFrame):
    """(rounds of the source trees, rounds of the tree of subroots)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", "n_chars", "text")
    leaves = written(leaf_rows(docs), "op13_leaves")
    lower = build(indexed(leaves, ["doc_id", "digest"], "op13"), ["doc_id", "tampered"], "op13")
    subroots = written(roots(lower).select(F.lit("").alias("tree"), F.col("tree").alias("source_tree"), "digest"),
                       "op13_subroots")
    upper = build(indexed(subroots, ["source_tree"], "op13_sources"), ["source_tree"], "op13_sources")
    return lower, upper


def merkle_proofs(docs: DataFrame) -> DataFrame:
    """The digest per document: its leaf, subroot, root and proof, and the root
    folded from the leaf as it is after tampering."""
    lower, upper = manifest(docs)
    top = roots(upper).select("tree", F.col("digest").alias("root"), F.array().cast(STEPS).alias("steps"))
    by_source = proofs(upper, top, ["source_tree"], f"tree string, steps {STEPS}, subroot string, root string",
                       _source_leaf, "op13_sources")
    above = written(by_source, "op13_above")
    return proofs(lower, above, ["doc_id", "tampered"], "doc_id long, leaf string, subroot string, root string, "
                  "proof_sha256 string, folded_root string, verified boolean", _document_leaf, "op13")
