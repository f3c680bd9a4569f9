"""Word vectors of every word, learned as tables (M6).

Words that occur in the same contexts get near vectors: the matrix N of
co-occurrences in a window (nearer ones count more, as under a window of random
width) is scaled by the words' totals, ``A = D^-1/2 N D^-1/2`` with ``D`` the
totals plus their mean, so that a few words seen only with each other make no
factor of their own. Its leading eigenvectors are found by subspace iteration:
the block of candidate vectors is a table with one row per word, a step is a
join of N with that table and a sum per word, and only the block's inner
products, a dozen numbers squared, reach the driver. The first eigenvector, which
only tells how frequent a word is, is left out.

Nothing of the vocabulary's size is held in one place and no word is dropped.
The distinct pairs of a corpus are many times its texts, so N is kept as a table
of pairs only where both words are rare. The ``FREQUENT`` most frequent words at
most (most of any text's words) have their rows of the block in every task, a
few ten MB: products of N with them are summed over the texts, in which they
are small numbers, and no pair of them is ever a row. A rare word has the list of
the frequent words around it, which is bounded, as it is rare. Rare words'
totals, lists and vectors are tables.

Texts are cut into segments, each with the next window's words behind it, so a
very long text is many small rows and no pair is counted twice. A null or empty
text has the zero vector. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

SEGMENT = 2000
# pairs of words that are summed at once
BATCH = 1 << 20
# most words whose vectors are shipped to all tasks (8 bytes a number)
FREQUENT = 1 << 19
# candidate vectors beyond those asked for, which speed up convergence
EXTRA = 5


def _table(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cooccurrences(words: DataFrame, window: int, segment: int = SEGMENT, frequent: int = 0):
    """(a, b, n), a <= b: weights of the pairs of words (by hash) at most
    ``window`` apart in ``words``, an array of tokens per row. With ``frequent``
    the same matrix as ``Cooccurrences``, from written ``words`` (doc_id, words)."""
    if frequent:
        return Cooccurrences(words, window, segment, frequent)
    ids = words.where(F.size("words") > 1).select(F.transform("words", lambda t: F.xxhash64(t)).alias("w"))
    starts = F.explode(F.sequence(F.lit(0), F.expr(f"(size(w) - 1) DIV {segment}")))
    segs = ids.select("w", starts.alias("s")).select(F.expr(f"slice(w, s * {segment} + 1, {segment} + {window})").alias("w"))

    def run(batches):
        import numpy as np

        def pairs(w, row, place):
            names, code = np.unique(w, return_inverse=True)
            codes, weight = [], []
            for d in range(1, window + 1):
                ok = (row[d:] == row[:-d]) & (place[:-d] < segment)
                x, y = code[:-d][ok], code[d:][ok]
                codes.append(np.minimum(x, y) * len(names) + np.maximum(x, y))
                weight.append(np.full(len(x), window - d + 1))
            codes, at = np.unique(np.concatenate(codes), return_inverse=True)
            n = np.bincount(at, np.concatenate(weight), len(codes)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(names[codes // len(names)]), pa.array(names[codes % len(names)]), pa.array(n)], names=["a", "b", "n"])

        for b in batches:
            at = 0
            sizes = np.array([len(x) for x in b.column(0)], dtype=np.int64)
            ends = np.cumsum(sizes)
            while at < len(sizes):
                end = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + BATCH // window, "right")))
                part = b.column(0).slice(at, end - at)
                w = part.flatten().to_numpy()
                size = sizes[at:end]
                row = np.repeat(np.arange(len(size)), size)
                place = np.arange(len(w)) - np.repeat(np.cumsum(size) - size, size)
                if len(w) > window:
                    yield pairs(w, row, place)
                elif len(w) > 1:  # a few words: the offsets beyond them have no pairs
                    pad = window + 1
                    yield pairs(np.append(w, np.full(pad, w[0])), np.append(row, -1 - np.arange(pad)), np.append(place, np.zeros(pad, int)))
                at = end

    return segs.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _both(pairs: DataFrame) -> DataFrame:
    """(w, c, n): every pair from both of its words."""
    ends = F.array(F.struct(F.col("a").alias("w"), F.col("b").alias("c")), F.struct(F.col("b").alias("w"), F.col("a").alias("c")))
    return pairs.select(F.explode(ends).alias("e"), "n").select("e.w", "e.c", "n")


def _inner(rows: DataFrame, left: list, right: list):
    """The matrix of sums of products of two lists of columns."""
    import numpy as np
    r = rows.agg(*[F.sum(x * y) for x in left for y in right]).first()
    return np.array([v or 0.0 for v in r], dtype=float).reshape(len(left), len(right))


def _combined(cols: list, matrix) -> list:
    """Columns times a small matrix."""
    out = []
    for j in range(matrix.shape[1]):
        out.append(sum((c * float(x) for c, x in zip(cols, matrix[:, j])), F.lit(0.0)))
    return out


def threshold(counts: DataFrame, column: str, most: int) -> int:
    """The least count that at most ``most`` rows of ``counts`` reach."""
    at, held = 0, 0
    sizes = counts.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).collect()  # one row per different count
    for r in sorted(sizes, key=lambda r: -r[column]):
        held += r.rows
        if held > most:
            return r[column] + 1
        at = r[column]
    return at


class Cooccurrences:
    """The matrix of co-occurrences of ``words`` (doc_id, words) in parts:
    ``texts`` (doc_id, c, r, head), the segments with frequent words as numbers,
    -1 for a rare one, and the rare ones' hashes in ``r``, of which ``head`` are
    not of the next segment; ``rare`` (w, near), rare words with the frequent
    ones around them, ``number * (window + 1) + weight`` each; ``pairs`` (a, b, n)
    of rare words. ``names`` are the frequent words' hashes in order."""

    def __init__(self, words: DataFrame, window: int, segment: int, frequent: int):
        import numpy as np
        self.window, self.segment = window, segment
        ship_package(words.sparkSession)
        sc = words.sparkSession.sparkContext
        counts = _table(words.select(F.explode("words").alias("t")).groupBy(F.xxhash64("t").alias("w"))
                        .agg(F.count(F.lit(1)).alias("n")), "w2v_counts")
        least = threshold(counts, "n", frequent)
        top = counts.where(F.col("n") >= least).select("w", _signs().alias("bits")).orderBy("w").toArrow()  # at most ``frequent`` rows
        self.names, self.bits = (top.column(i).to_numpy().astype(np.int64) for i in range(2))
        shared = sc.broadcast(self.names)

        def coded(batches):
            for b in batches:
                w = b.column(1).flatten().to_numpy()
                names = shared.value
                at = np.minimum(np.searchsorted(names, w), max(len(names) - 1, 0))
                known = names[at] == w if len(names) else np.zeros(len(w), dtype=bool)
                ends = np.cumsum([0, *b.column(1).value_lengths().to_numpy()])
                rares = np.concatenate(([0], np.cumsum(~known)))[ends]
                heads = np.minimum(ends[:-1] + segment, ends[1:])
                head = np.concatenate(([0], np.cumsum(~known)))[heads] - rares[:-1]
                lists = lambda x, o, t: pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(x, t))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), lists(np.where(known, at, -1), ends, pa.int32()), lists(w[~known], rares, pa.int64()), pa.array(head, pa.int32())],
                    names=["doc_id", "c", "r", "head"])

        ids = words.where(F.size("words") > 0).select("doc_id", F.transform("words", lambda t: F.xxhash64(t)).alias("w"))
        starts = F.explode(F.sequence(F.lit(0), F.expr(f"(size(w) - 1) DIV {segment}")))
        segs = ids.select("doc_id", "w", starts.alias("s")).select(
            "doc_id", F.expr(f"slice(w, s * {segment} + 1, {segment} + {window})").alias("w"))
        kind = words.schema["doc_id"].dataType.simpleString()
        self.texts = _table(segs.mapInArrow(coded, f"doc_id {kind}, c array<int>, r array<long>, head int"), "w2v_texts")
        found = _table(self.texts.where(F.size("r") > 0).select("c", "r").mapInArrow(self._around(), "w long, near array<int>, b long, n long"), "w2v_rare")
        self.pairs = _table(found.where(F.col("b").isNotNull()).groupBy(F.col("w").alias("a"), "b").agg(F.sum("n").alias("n")), "w2v_pairs")
        empty = F.array().cast("array<int>").alias("near")
        lists = (found.where(F.col("b").isNull()).select("w", "near").unionByName(self.pairs.select(F.col("a").alias("w"), empty))
                 .unionByName(self.pairs.select(F.col("b").alias("w"), empty)))
        self.rare = lists.groupBy("w").agg(F.flatten(F.collect_list("near")).alias("near"))

    def _around(self):
        """Rows (w, near) of the rare words of a batch and (w, b, n), w <= b, of pairs of them."""
        window, segment = self.window, self.segment

        def run(batches):
            import numpy as np
            for b in batches:
                c, row, place = _positions(b.column(0))
                rare = c < 0
                name = np.zeros(len(c), dtype=np.int64)
                name[rare] = b.column(1).flatten().to_numpy()
                w, near, pairs = [], [], [[], [], []]
                for d in range(1, min(window, len(c) - 1) + 1):
                    ok = (row[d:] == row[:-d]) & (place[:-d] < segment)
                    x, y, weight = np.flatnonzero(ok & (rare[:-d] | rare[d:])), None, window - d + 1
                    y = x + d
                    for one, other in ((x, y), (y, x)):
                        go = rare[one] & ~rare[other]
                        w.append(name[one[go]])
                        near.append(c[other[go]].astype(np.int64) * (window + 1) + weight)
                    go = rare[x] & rare[y]
                    one, other = name[x[go]], name[y[go]]
                    for to, v in zip(pairs, (np.minimum(one, other), np.maximum(one, other), np.full(len(one), weight))):
                        to.append(v)
                if not w:
                    continue
                w, near = np.concatenate(w), np.concatenate(near)
                order = np.argsort(w, kind="stable")
                w, near = w[order], near[order]
                start = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1]))) if len(w) else np.zeros(0, dtype=int)
                lists = pa.ListArray.from_arrays(pa.array([*start.tolist(), len(w)], pa.int32()), pa.array(near, pa.int32()))
                none = pa.nulls(len(start), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(w[start]), lists, none, none], names=["w", "near", "b", "n"])
                a, z, n = (np.concatenate(p) for p in pairs)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.list_(pa.int32())), pa.array(z), pa.array(n, pa.int64())],
                                                 names=["w", "near", "b", "n"])

        return run

    def _in_texts(self, told):
        """Sums over the texts of the vectors of the frequent words around each."""
        window, segment = self.window, self.segment

        def run(batches):
            import numpy as np
            x = np.vstack((told.value, np.zeros((1, told.value.shape[1]))))
            out = np.zeros(told.value.shape)
            for b in batches:
                codes, rows, places = _positions(b.column(0))
                ends = np.cumsum(b.column(0).value_lengths().to_numpy())
                at = 0
                while at < len(codes):
                    end = max(int(ends[np.searchsorted(ends, at, "right")]), int(ends[np.searchsorted(ends, at + BATCH // 4, "right") - 1]))
                    c, row, place = codes[at:end], rows[at:end] - rows[at], places[at:end]
                    at = end
                    pos = np.arange(len(c)) + (row + 1) * window  # blanks between the rows
                    code = np.full(int(pos[-1]) + window + 1, len(x) - 1)
                    code[pos] = c
                    code[code < 0] = len(x) - 1
                    vec = x[code]
                    tail = pos[place >= segment]
                    left, right = np.zeros(vec.shape), np.zeros(vec.shape)
                    for d in range(1, window + 1):
                        right[:-d] += (window - d + 1) * vec[d:]
                    vec[tail] = 0
                    right[tail] = 0
                    for d in range(1, window + 1):
                        left[d:] += (window - d + 1) * vec[:-d]
                    use = c >= 0
                    sums, c = (left + right)[pos[use]], c[use]
                    for j in range(sums.shape[1]):
                        out[:, j] += np.bincount(c, sums[:, j], len(out))
            yield _coded_rows(out)

        return run

    def _near(self, told, k: int, to_frequent: bool):
        """Of rows (w, near, vector): the vectors summed per frequent word, or
        each row with the sum of the frequent words' vectors (a list)."""
        base = self.window + 1

        def run(batches):
            import numpy as np
            x = told.value
            out = np.zeros((len(x), k))
            for b in batches:
                size = b.column(1).value_lengths().to_numpy()
                p = b.column(1).flatten().to_numpy()
                code, weight, row = p // base, p % base, np.repeat(np.arange(len(size)), size)
                own = np.array(b.column(2).flatten()).reshape(-1, k)
                for j in range(k):
                    if to_frequent:
                        out[:, j] += np.bincount(code, weight * own[row, j], len(out))
                    else:
                        own[:, j] = np.bincount(row, weight * x[code, j], len(size))
                if not to_frequent:
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.FixedSizeListArray.from_arrays(pa.array(own.ravel()), k).cast(pa.list_(pa.float64()))],
                                                     names=[*b.schema.names, "own"])
            if to_frequent:
                yield _coded_rows(out)

        return run

    def times(self, x, block: DataFrame, cols: list):
        """N times a block of ``len(cols)`` columns: ``x`` of the frequent
        words, the Columns ``cols`` of the table ``block`` (w, near, ...) of the
        rare ones. The product's rows of the frequent words, and ``block`` with
        those of the rare ones as an array ``y``."""
        import numpy as np
        k = len(cols)
        told = block.sparkSession.sparkContext.broadcast(np.ascontiguousarray(x))
        fields = ", ".join(f"y{j} double" for j in range(k))
        listed = block.select("w", "near", F.array(*cols).alias("vec"))
        sums = (self.texts.select("c").mapInArrow(self._in_texts(told), f"code int, {fields}")
                .unionByName(listed.mapInArrow(self._near(told, k, True), f"code int, {fields}")))
        got = sums.groupBy("code").agg(*[F.sum(f"y{j}") for j in range(k)]).toArrow()  # at most FREQUENT rows
        y = np.zeros(x.shape)
        y[got.column(0).to_numpy()] = np.column_stack([got.column(j + 1).to_numpy() for j in range(k)])
        every = block.select("w", "near", F.array(*cols).alias("vec"), F.struct(*block.columns).alias("row"))
        kind = every.schema["row"].dataType.simpleString()
        own = every.mapInArrow(self._near(told, k, False), f"w long, near array<int>, vec array<double>, row {kind}, own array<double>")
        return y, _with_pairs(own.select("row.*", "own"), self.pairs, listed.select("w", "vec"), k)


def _positions(lists):
    """Elements of an Arrow array of lists, their rows and their places."""
    import numpy as np
    size = lists.value_lengths().to_numpy().astype(np.int64)
    flat = lists.flatten().to_numpy()
    return flat, np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)


def _coded_rows(out):
    import numpy as np
    code = np.flatnonzero(out.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(code, pa.int32()), *(pa.array(out[code, j]) for j in range(out.shape[1]))],
                                      names=["code", *(f"y{j}" for j in range(out.shape[1]))])


def _with_pairs(block: DataFrame, pairs: DataFrame, told: DataFrame, k: int) -> DataFrame:
    """``block`` with ``y``: its column ``own`` plus the sums over ``pairs`` of
    the vectors ``told`` (w, vec)."""
    j = _both(pairs).join(told.select(F.col("w").alias("c"), "vec"), "c")
    sums = j.groupBy(F.col("w").alias("_w")).agg(*[F.sum(F.col("n") * F.get("vec", i)).alias(f"_y{i}") for i in range(k)])
    y = F.array(*[F.get("own", i) + F.coalesce(F.col(f"_y{i}"), F.lit(0.0)) for i in range(k)])
    out = block.join(sums, F.col("w") == F.col("_w"), "left")
    return out.select(*[c for c in block.columns if c != "own"], y.alias("y"))


def _signs():
    """The bits that a word's first candidate vectors are made of."""
    return F.xxhash64("w", F.lit(7))


class _Pairs:
    """Written pairs alone: a matrix without frequent words."""

    def __init__(self, pairs: DataFrame):
        import numpy as np
        self.pairs, self.names, self.bits = pairs, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.rare = _both(pairs).select("w").distinct().withColumn("near", F.array().cast("array<int>"))

    def times(self, x, block: DataFrame, cols: list):
        own = F.array(*[F.lit(0.0)] * len(cols))
        told = block.select("w", F.array(*cols).alias("vec"))
        return x * 0.0, _with_pairs(block.withColumn("own", own), self.pairs, told, len(cols))


def word_vectors(pairs, size: int, rounds: int = 2) -> DataFrame:
    """(w, vector) of every word of written ``pairs`` (or ``Cooccurrences``),
    after ``rounds`` rounds of the subspace iteration."""
    import numpy as np
    n = _Pairs(pairs) if isinstance(pairs, DataFrame) else pairs
    spark = n.pairs.sparkSession
    k = size + 1 + EXTRA
    rare = _table(n.rare, "w2v_lists")
    tf, totals = n.times(np.ones((len(n.names), 1)), rare, [F.lit(1.0)])
    totals = _table(totals.select("w", "near", F.get("y", 0).alias("s")), "w2v_totals")
    tf = tf[:, 0]
    r = totals.agg(F.count(F.lit(1)).alias("n"), F.sum("s").alias("s")).first()
    n_words = r.n + int((tf > 0).sum())
    if not n_words:
        return totals.select("w", F.array().cast("array<double>").alias("vector"))
    mean = float(((r.s or 0.0) + tf.sum()) / n_words)
    scale, scale_f = F.sqrt(mean / (F.col("s") + mean)), np.sqrt(mean / (tf + mean))[:, None]
    bit = lambda i: F.when(F.shiftright(_signs(), i).bitwiseAND(F.lit(1)) == 1, 1.0).otherwise(-1.0)
    # one column starts near the leading vector, so the others are left to the rest
    cols = [F.sqrt(F.col("s") / mean), *[bit(i) for i in range(1, k)]]
    xf = np.where((n.bits[:, None] >> np.arange(k)) & 1 == 1, 1.0, -1.0) * (tf > 0)[:, None]
    xf[:, 0] = np.sqrt(tf / mean)
    table = totals

    def orthonormal(g):
        values, vectors = np.linalg.eigh(g)
        keep = values > 1e-10 * max(values.max(), 1e-300)
        return vectors[:, keep] / np.sqrt(values[keep])

    for i in range(rounds + 1):
        turn = orthonormal(_inner(table, cols, cols) + xf.T @ xf)
        xf = xf @ turn
        block = table.select("w", "near", "s", F.array(*_combined(cols, turn)).alias("x"))
        x = [F.get("x", j) for j in range(xf.shape[1])]
        yf, step = n.times(scale_f * xf, block, [scale * c for c in x])
        yf = scale_f * yf / mean
        table = _table(step, "w2v_step")
        cols = [scale * F.get("y", j) / mean for j in range(len(x))]
        if i < rounds:
            xf = yf
    # eigenvectors within the block, the first of which is left out
    inner = _inner(table, x, cols) + xf.T @ yf
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-np.abs(values), kind="stable")[1:size + 1]
    use = vectors[:, order] * np.sqrt(np.abs(values[order]))
    use *= np.where(use[np.abs(use).argmax(axis=0), np.arange(use.shape[1])] < 0, -1.0, 1.0)
    root = float(np.sqrt(n_words))
    cols = [scale * c * root for c in _combined(x, use)]
    cols += [F.lit(0.0)] * (size - len(cols))  # a corpus of fewer factors
    out = table.select("w", F.array(*cols).alias("vector"))
    if not len(n.names):
        return out
    vf = np.zeros((len(n.names), size))
    vf[:, :use.shape[1]] = scale_f * (xf @ use) * root
    seen = tf > 0
    told = pa.table({"w": pa.array(n.names[seen]), "vector": pa.array(list(vf[seen]), pa.list_(pa.float64()))})
    return out.unionByName(spark.createDataFrame(told))


def document_vectors(words: DataFrame, size: int, window: int = 5, rounds: int = 2, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, vector): the mean vector of a document's words, from written
    ``words`` (doc_id, words)."""
    import numpy as np
    counts = cooccurrences(words, window, frequent=frequent)
    spark = words.sparkSession
    vectors = _table(word_vectors(counts, size, rounds), "w2v_vectors")
    names = spark.createDataFrame(pa.table({"_w": pa.array(counts.names)}))
    known = vectors.join(F.broadcast(names), F.col("w") == F.col("_w"), "left_semi").toArrow()  # at most ``frequent`` rows
    told = np.zeros((len(counts.names) + 1, size))
    if len(known):
        told[np.searchsorted(counts.names, known.column("w").to_numpy())] = known.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, size)
    shared, segment = spark.sparkContext.broadcast(told), counts.segment

    def run(batches):
        for b in batches:
            c, row, place = _positions(b.column(1))
            own = place < segment
            vec, row = shared.value[c[own]], row[own]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.bincount(row, vec[:, j], b.num_rows)) for j in range(size))],
                                             names=["doc_id", *(f"v{j}" for j in range(size))])

    kind = words.schema["doc_id"].dataType.simpleString()
    near = counts.texts.select("doc_id", "c").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"v{j} double" for j in range(size)))
    far = (counts.texts.select("doc_id", F.explode(F.slice("r", F.lit(1), F.col("head"))).alias("w"))
           .join(vectors, "w").select("doc_id", *[F.get("vector", i).alias(f"v{i}") for i in range(size)]))
    sums = near.unionByName(far).groupBy("doc_id").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(size)])
    n = F.greatest(F.size("words"), F.lit(1))
    mean = F.array(*[F.round(F.coalesce(F.col(f"v{i}") / n, F.lit(0.0)), 6) + F.lit(0.0) for i in range(size)])
    sums = sums.withColumnRenamed("doc_id", "_doc")
    return words.join(sums, F.col("doc_id").eqNullSafe(F.col("_doc")), "left").select("doc_id", mean.alias("vector"))
