"""Helpers that the operators share: scans, written tables, checked
broadcasts, and word / shingle hashing over UTF-8 bytes in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from ..session import scratch_path, ship_package
from ..sources.tables import table_path

# Rows of a text table that one Arrow batch may carry to a Python worker.
ARROW_ROWS = 1024
# ... and their bytes: rows of long texts, as joined pairs of them, go in smaller batches
ARROW_BYTES = 4 << 20
# Rows that a scan decodes at once: the texts of a decoded batch lie in one array,
# and arrays of many MB make the executors' heaps grow to their limit
SCAN_ROWS = 256
# A side of a join is broadcast only when it is at most so many rows, with so
# many bytes of texts and lists in all; beyond that the join shuffles.
BROADCAST_ROWS = 400_000
BROADCAST_BYTES = 32 << 20

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators: scans and Arrow batches of few rows and
    bytes, as texts can be long, and the package itself shipped to the executors'
    Python workers."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and return a scan
    of it: later uses read files, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """Hint a broadcast of an already written table if its counted rows are at
    most ``BROADCAST_ROWS`` and their texts and lists, where it has any, at most
    ``BROADCAST_BYTES``; beyond that leave the join to shuffle (AQE splits
    skewed keys there, as both sides are plain exchanges)."""
    wide = [F.coalesce(F.octet_length(F.to_json(F.struct(f.name)) if isinstance(f.dataType, (ArrayType, StructType, MapType))
                                      else F.col(f.name)).cast("long"), F.lit(0))
            for f in df.schema if isinstance(f.dataType, (StringType, BinaryType, ArrayType, StructType, MapType))]
    size = F.sum(sum(wide, F.lit(0))) if wide else F.lit(0)
    rows, held = df.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), size).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (held or 0) <= BROADCAST_BYTES else df


# ---------------------------------------------------------------- words

def _mix(x):
    """Finaliser of splitmix64 on a uint64 array."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS = {_BASE: np.ones(1, dtype=np.uint64), _INVERSE: np.ones(1, dtype=np.uint64)}
# bytes of a text whose words are hashed at once
SPAN = 1 << 18
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def powers(n: int, base=_BASE):
    """The first n powers (at least) of an odd 64-bit base, modulo 2**64."""
    if len(_POWERS[base]) < n:
        p = np.full(1 << (n - 1).bit_length(), base, dtype=np.uint64)
        p[0] = 1
        _POWERS[base] = np.multiply.accumulate(p)
    return _POWERS[base]


def utf8(text) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)


def lower_ascii(b: np.ndarray) -> np.ndarray:
    return _LOWER[b]


def word_spans(b: np.ndarray):
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes."""
    if not len(b):
        z = np.zeros(0, dtype=np.int64)
        return z, z
    edge = np.ones(len(b) + 2, dtype=np.bool_)
    edge[1:-1] = (b == 32) | ((b >= 9) & (b <= 13))
    change = np.flatnonzero(edge[1:] != edge[:-1])
    return change[0::2], change[1::2]


def word_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: the polynomial of its bytes, a difference of
    the text's running sums divided by the power at the word's start."""
    n = len(starts)
    out = np.zeros(n, dtype=np.uint64)
    i = 0
    while i < n:
        # the words of a bounded span; a longer word is a span of its own
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SPAN, "right")))
        at, size = starts[i], int(ends[j - 1] - starts[i])
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[b[at:at + size]] * powers(size)[:size], out=sums[1:])
        first, last = starts[i:j] - at, ends[i:j] - at
        out[i:j] = (sums[last] - sums[first]) * powers(size, _INVERSE)[first]
        i = j
    return _mix(out + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, width: int = 5) -> np.ndarray:
    """64-bit hash of every run of ``width`` words; of a shorter, non-empty
    sequence the whole as one; none without words."""
    n = len(words)
    if not n:
        return words
    w = min(width, n)
    out = np.full(n - w + 1, w, dtype=np.uint64)
    for j in range(w):
        out *= _BASE
        out += words[j:n - w + 1 + j]
    return _mix(out)


def shingle_set(text, width: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, lower-casing A-Z."""
    b = lower_ascii(utf8(text))
    s = np.sort(shingle_hashes(word_hashes(b, *word_spans(b)), width))
    new = np.ones(len(s), dtype=bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return s[new]
