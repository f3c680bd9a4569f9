"""Quality rules by host.

Every document is measured against a few rules. Per host and rule the share of
failing documents is shrunk towards the corpus by a beta prior whose two
parameters are fitted to the hosts' shares by their moments (empirical Bayes).
The shrunk share is the mean of the host's beta posterior. A host is strict in a
rule when the corpus' mean share lies far in the lower tail of that posterior
(``TAIL`` deviations below its mean) and the shrunk share is at least the rule's
bar times the corpus' mean: the host is surely worse, and by much, however rare
the failure is. Documents of a host that is strict in a rule must pass that
rule; all documents must pass the base rules.

Edge cases: a null or empty text has no words, so it fails the base rules; a
null host is a host of its own; repeated rows count and are returned as often
as they occur; an empty table gives an empty result; extra columns are left
aside by name before anything else is computed; a very long text is measured
whole; hosts of equal shares are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shingle_hashes, small, utf8, word_hashes, word_spans, written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
BLANK = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
TAIL = 3.0
# shrunk share of a strict host, as a multiple of the corpus' mean share
BARS = {"base": 1.5, "symbols": 1.5, "dup_lines": 1.5, "word_length": 1.5}

BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)"
# rule -> a document fails it (soft rules decide at strict hosts only)
RULES = {
    "base": BASE_FAILED,
    "symbols": "(10 * n_symbols > n_words)",
    "dup_lines": "(100 * n_dup_lines > 30 * n_lines)",
    "word_length": "(word_chars < 3 * n_words OR word_chars > 12 * n_words)",
}


def measure(text) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    b = utf8(text)
    raw = b.tobytes()
    starts, ends = word_spans(b)
    n = len(starts)
    if not n:
        return 0, 0, len(raw) - len(raw.translate(None, SYMBOLS)), 0, 0, 0
    heads = np.concatenate(([0], np.cumsum((b & 0xC0) != 0x80)))
    lines = [x for x in raw.split(b"\n") if x.strip(BLANK)]
    repeat = 0
    if n >= 5:
        h = shingle_hashes(word_hashes(b, starts, ends))
        _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(count[inverse] > 1)
        if len(twice):
            edge = np.zeros(n + 1, dtype=np.int64)
            np.add.at(edge, twice, 1)
            np.add.at(edge, twice + 5, -1)
            repeat = int((np.cumsum(edge) > 0).sum())
    return (n, int((heads[ends] - heads[starts]).sum()), len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeat, len(lines))


def measured(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of ``docs`` with the measures of its ``text``."""
    def run(batches):
        for batch in batches:
            rows = [measure(t) for t in batch.column(len(keys)).to_pylist()]
            cols = [batch.column(i) for i in range(len(keys))]
            cols += [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, *MEASURES])

    src = docs.select(*keys, "text")
    schema = ", ".join([f"`{k}` {src.schema[k].dataType.simpleString()}" for k in keys]
                       + [f"{m} long" for m in MEASURES])
    return src.mapInArrow(run, schema)


def host_verdicts(measures: DataFrame, host: str = "source") -> DataFrame:
    """One row per host: its documents, the shrunk failure share of each rule,
    the rules it is strict in and whether there are any. ``measures`` is read
    twice, so write it first."""
    fails = [F.sum(F.expr(rule).cast("long")).alias(f"k_{r}") for r, rule in RULES.items()]
    hosts = measures.groupBy(host).agg(F.count(F.lit(1)).alias("n"), *fails)
    # moments over the hosts: one row
    moments = hosts.agg(*[f(F.col(f"k_{r}") / F.col("n")).alias(f"{m}_{r}") for r in RULES
                          for m, f in (("mean", F.avg), ("var", F.var_samp))])
    out = hosts.crossJoin(F.broadcast(moments))  # a single row of moments
    for r in RULES:
        m, v = F.col(f"mean_{r}"), F.col(f"var_{r}")
        # weight of the prior in documents; without spread between hosts, or
        # with a single host, the prior weighs as much as one document
        weight = F.when(v > 0, F.greatest(F.lit(1.0), F.least(F.lit(1e6), m * (1 - m) / v - 1))).otherwise(F.lit(1.0))
        share = (F.col(f"k_{r}") + m * weight) / (F.col("n") + weight)
        spread = F.sqrt(share * (1 - share) / (F.col("n") + weight + 1))
        out = out.withColumn(f"share_{r}", share).withColumn(
            f"strict_{r}", (share - m > TAIL * spread) & (share >= BARS[r] * m))
    strict = [F.col(f"strict_{r}") for r in RULES]
    return out.select(host, "n", *[f"share_{r}" for r in RULES], *strict, F.greatest(*strict).alias("strict_host"))


def judged(docs: DataFrame, keys: list[str], host: str = "source") -> DataFrame:
    """``keys`` and the measures of every document with ``base_failed``,
    ``failed`` (any rule), ``strict_host`` and ``kept``."""
    cols = list(dict.fromkeys([*keys, host]))
    m = written(measured(docs, cols), "op8_measures")
    verdict = written(host_verdicts(m, host), "op8_hosts").select(
        F.col(host).alias("_host"), "strict_host", *[f"strict_{r}" for r in RULES])
    j = m.join(small(verdict), F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    base, failed = F.expr(BASE_FAILED), F.expr(" OR ".join(RULES.values()))
    fallen = F.greatest(*[F.coalesce(F.col(f"strict_{r}"), F.lit(False)) & F.expr(rule) for r, rule in RULES.items()])
    return j.select(*cols, *MEASURES, base.alias("base_failed"), failed.alias("failed"), "strict_host",
                    (~base & ~fallen).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """The digest per document."""
    return judged(docs, ["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c
  FROM (SELECT rid, i, ws[i:i + 4] AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM d))),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM win, (SELECT unnest(range(0, 5)) AS k) WHERE c > 1 GROUP BY rid),
ln AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
m AS (
  SELECT d.rid, doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         len(l) AS n_lines
  FROM d JOIN ln ON d.rid = ln.rid LEFT JOIN cov ON d.rid = cov.rid),
f AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS r1, 10 * n_symbols > n_words AS r2,
         100 * n_dup_lines > 30 * n_lines AS r3, word_chars < 3 * n_words OR word_chars > 12 * n_words AS r4
  FROM m),
h AS (
  SELECT source, rule, count(*) AS n, count(*) FILTER (WHERE failed) AS k
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS rule, unnest([r1, r2, r3, r4]) AS failed FROM f) GROUP BY source, rule),
mo AS (SELECT rule, avg(k / n) AS mean, var_samp(k / n) AS var FROM h GROUP BY rule),
b AS (
  SELECT source, rule, n, mean, w, (k + mean * w) / (n + w) AS share FROM (
    SELECT h.*, mean, CASE WHEN var > 0 THEN greatest(1.0, least(1e6, mean * (1 - mean) / var - 1)) ELSE 1.0 END AS w
    FROM h JOIN mo ON h.rule = mo.rule)),
s AS (
  SELECT source, bool_or(strict AND rule = 2) AS s2, bool_or(strict AND rule = 3) AS s3, bool_or(strict AND rule = 4) AS s4
  FROM (SELECT source, rule, share - mean > 3 * sqrt(share * (1 - share) / (n + w + 1)) AND share >= 1.5 * mean AS strict FROM b)
  GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 AS base_failed,
       NOT (r1 OR s2 AND r2 OR s3 AND r3 OR s4 AND r4) AS kept
FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source
"""
