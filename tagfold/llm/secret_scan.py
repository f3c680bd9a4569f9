"""Secret scan by a battery of randomness tests, in DataFrame functions only.

Three plain rules (an assigned value, an access key id, a hex run) give the
base spans. The method adds spans: every long run of encoding characters is a
candidate; its encoding is inferred from the characters it uses, and its
symbols are tested for being random in that alphabet: chi-squared uniformity
over five bins, the number of runs about the middle of the alphabet, and
lag-one serial correlation, combined by Fisher's method.

A claim of "secret" has to reject that the token is made of words: identifiers
fall apart at case changes and digits into words. Two tests look at these: a
letter-trigram model of all words of the table tells how likely they are, and
their mean length is held against that of words; the larger p-value counts, as
a claim has to reject both. Within each length stratum
the Benjamini-Hochberg rule over these p-values bounds the share of false
claims. A claimed token that the battery cannot tell from random
(``RANDOM_LEVEL``) is a secret, unless it overlaps a base span.

Positions need no Python: ``split`` and ``regexp_extract_all`` on one pattern
give the gaps and the matches in order, and a running sum of their lengths per
document gives the code-point offsets.

Edge cases: a null text is empty; a null id is kept; repeated rows each get
their own, equal result; ties in start are ordered by kind; an empty table
gives an empty result; a table without words claims nothing; a long text costs
its length, and a match of any length is one token; extra columns are left
aside.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import small, written

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (
    ASSIGN,
    r"AKIA[A-Z0-9]{14,}+",
    # a maximal run, as the leftmost match would be
    r"(?<![0-9a-f])[0-9a-f]{16,}+",
    r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+",
)
MIN_ASSIGNED = 12
# share of false claims in a stratum
FALSE_DISCOVERIES = 0.05
# a claimed token whose battery has a smaller p-value is not random
RANDOM_LEVEL = 0.001
# mean and deviation of the length of an identifier's words
PIECE_LENGTH = (4.0, 2.5)
# p-values are counted in bins of this width in log10
STEP = 0.02
BINS = 5
# encoding -> alphabet, in the order of its symbols (fixed values)
ALPHABETS = {
    "hex": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def matches(docs: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end, token) of every match of the four
    patterns; ``th`` is the text's hash, so that rows repeating an id with
    another text stay apart."""
    def entries(k: int):
        gaps = F.transform(F.split("text", PATTERNS[k], -1), lambda s: F.length(s))
        found = F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))
        rows = F.transform(F.arrays_zip(gaps.alias("gap"), found.alias("token")),
                           lambda x, i: F.struct(F.lit(k).alias("kind"), i.alias("i"), x["gap"].alias("gap"),
                                                 x["token"].alias("token")))
        return F.when(F.col("text").rlike(PATTERNS[k]), rows)

    empty = F.array().cast("array<struct<kind:int,i:int,gap:int,token:string>>")
    rows = (docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
            .select("doc_id", "th", F.explode(F.concat(*[F.coalesce(entries(k), empty) for k in range(len(PATTERNS))]))
                    .alias("m")).select("doc_id", "th", "m.*"))
    rows = rows.distinct()  # repeated rows are combined before they are shuffled
    here = Window.partitionBy("doc_id", "th", "kind").orderBy("i")
    end = F.sum(F.col("gap") + F.coalesce(F.length("token"), F.lit(0))).over(
        here.rowsBetween(Window.unboundedPreceding, 0))
    ok = F.col("token").isNotNull() & (
        (F.col("kind") != 0) | (F.length(F.regexp_extract("token", ASSIGN, 2)) >= MIN_ASSIGNED))
    return (rows.withColumn("end", end).filter(ok)
            .select("doc_id", "th", "kind", (F.col("end") - F.length("token")).alias("start"), "end", "token"))


def encoding(token):
    """Name of the inferred encoding, or null where the characters suggest
    words, numbers or markup rather than an encoding."""
    body = F.rtrim(token, F.lit("="))
    digit, upper, lower = body.rlike("[0-9]"), body.rlike("[A-Z]"), body.rlike("[a-z]")
    mixed = digit & upper & lower
    return (F.when(body.rlike("^[0-9a-f]+$|^[0-9A-F]+$") & digit & (upper | lower), "hex")
            .when(body.rlike("^[A-Z2-7]+$") & digit & upper, "base32")
            .when(body.rlike("^[A-Za-z0-9]+$") & mixed, "base62")
            .when(body.rlike("^[A-Za-z0-9+/]+$") & mixed, "base64")
            .when(body.rlike("^[A-Za-z0-9_-]+$") & mixed, "base64url"))


def tested(candidates: DataFrame) -> DataFrame:
    """``candidates`` (with a ``token``) that have an encoding, with
    ``p_value`` of the combined tests under "random in its alphabet"."""
    def case(values: dict):
        out = F.lit(None)
        for name, v in values.items():
            out = F.when(F.col("encoding") == name, F.lit(v)).otherwise(out)
        return out

    c = candidates.withColumn("encoding", encoding(F.col("token"))).filter(F.col("encoding").isNotNull())
    c = c.withColumn("alphabet", case(ALPHABETS)).withColumn("size", case({k: float(len(v)) for k, v in ALPHABETS.items()}))
    body = F.rtrim("token", F.lit("="))
    body = F.when(F.col("encoding") == "hex", F.upper(body)).otherwise(body)
    c = c.withColumn("codes", F.transform(F.split(body, ""), lambda ch: F.instr(F.col("alphabet"), ch) - 1.0))
    # split on nothing may end with an empty string, which is no symbol
    c = c.withColumn("codes", F.filter("codes", lambda x: x >= 0)).withColumn("n", F.size("codes").cast("double"))
    c = c.filter(F.col("n") >= 16)

    chi = F.lit(0.0)
    bin_of = F.transform("codes", lambda x: F.floor(x * BINS / F.col("size")))
    for b in range(BINS):
        share = (F.ceil((b + 1) * F.col("size") / BINS) - F.ceil(b * F.col("size") / BINS)) / F.col("size")
        seen = F.col("n") - F.size(F.array_remove(bin_of, b))
        chi = chi + F.pow(seen - F.col("n") * share, F.lit(2)) / (F.col("n") * share)
    c = c.withColumn("chi", chi)

    pairs = lambda f: F.aggregate(  # noqa: E731  sum of f over neighbours
        F.sequence(F.lit(1), F.size("codes") - 1), F.lit(0.0),
        lambda acc, i: acc + f(F.element_at("codes", i), F.element_at("codes", i + 1)))
    total = lambda f: F.aggregate("codes", F.lit(0.0), lambda acc, x: acc + f(x))
    half = F.col("size") / 2
    c = c.withColumn("above", total(lambda x: (x >= half).cast("double")))
    c = c.withColumn("below", F.col("n") - F.col("above"))
    c = c.withColumn("runs", 1 + pairs(lambda x, y: ((x >= half) != (y >= half)).cast("double")))
    c = c.withColumn("mean", total(lambda x: x) / F.col("n"))
    c = c.withColumn("var", total(lambda x: (x - F.col("mean")) * (x - F.col("mean"))))
    c = c.withColumn("lag", pairs(lambda x, y: (x - F.col("mean")) * (y - F.col("mean"))))

    ab = 2 * F.col("above") * F.col("below")
    runs_mean = 1 + ab / F.col("n")
    runs_var = ab * (ab - F.col("n")) / (F.col("n") * F.col("n") * (F.col("n") - 1))
    z_runs = F.when(runs_var > 0, (F.col("runs") - runs_mean) / F.sqrt(runs_var)).otherwise(F.lit(10.0))
    z_lag = F.when(F.col("var") > 0, F.col("lag") / F.col("var") * F.sqrt("n")).otherwise(F.lit(10.0))

    def two_sided(z):
        """Normal tail by the logistic approximation of its distribution."""
        a = F.abs(z)
        return F.greatest(F.lit(1e-30), 2 / (1 + F.exp(F.least(F.lit(300.0), 1.5976 * a + 0.070566 * a * a * a))))

    # closed forms: a chi-squared tail with 4 degrees, then Fisher's with 6
    p_chi = F.greatest(F.lit(1e-30), F.exp(-F.col("chi") / 2) * (1 + F.col("chi") / 2))
    x = -(F.log(p_chi) + F.log(two_sided(z_runs)) + F.log(two_sided(z_lag)))
    c = c.withColumn("p_value", F.greatest(F.lit(1e-30), F.exp(-x) * (1 + x + x * x / 2)))
    return c.drop("alphabet", "size", "codes", "chi", "above", "below", "runs", "mean", "var", "lag")


def tail(z):
    """Upper tail of the normal distribution, by its logistic approximation."""
    x = F.greatest(F.lit(-20.0), F.least(F.lit(20.0), z))
    return F.greatest(F.lit(1e-30), 1 / (1 + F.exp(F.least(F.lit(300.0), 1.5976 * x + 0.070566 * x * x * x))))


def pieces(token):
    """A token's letters in lower case, with one blank at every case change
    that starts a word and in place of everything else."""
    t = F.regexp_replace(token, "([a-z])([A-Z])", "$1 $2")
    t = F.regexp_replace(t, "([A-Z])([A-Z][a-z])", "$1 $2")
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(t), "[^a-z]+", " ")), F.lit(" "))


def trigrams(piece):
    return F.transform(F.sequence(F.lit(1), F.length(piece) - 2), lambda i: F.substring(piece, i, 3))


def word_model(docs: DataFrame) -> DataFrame:
    """(gram, n): letter trigrams of all words of the table, at most 27 ** 3
    rows. Words are counted first, so a frequent word is cut up once."""
    words = (docs.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Z]?[a-z]+"), F.lit(0))).alias("w"))
             .groupBy(F.lower("w").alias("w")).agg(F.count(F.lit(1)).alias("n")))
    return (words.select(F.explode(trigrams(F.concat(F.lit(" "), "w", F.lit(" ")))).alias("gram"), "n")
            .groupBy("gram").agg(F.sum("n").alias("n")))


def worded(scored: DataFrame, model: DataFrame) -> DataFrame:
    """``scored`` with ``word_p``: the p-value of a token under "made of words",
    the larger of that of its log-probability in the table's trigrams and that
    of its pieces' mean length."""
    counts = {r.gram: r.n for r in model.collect()}  # bounded by the alphabet
    if not counts:
        return scored.withColumn("word_p", F.lit(1.0))
    letters = " abcdefghijklmnopqrstuvwxyz"
    context: dict[str, int] = {}
    for g, n in counts.items():
        context[g[:2]] = context.get(g[:2], 0) + n
    logs = {a + b + c: math.log((counts.get(a + b + c, 0) + 0.1) / (context.get(a + b, 0) + 2.7))
            for a in letters for b in letters for c in letters}
    total = sum(counts.values())
    mean = sum(n * logs[g] for g, n in counts.items()) / total
    # neighbouring trigrams depend on each other: twice the single variance
    var = 2 * sum(n * (logs[g] - mean) ** 2 for g, n in counts.items()) / total
    table = F.split(F.lit(",".join(f"{v:.6f}" for v in logs.values())), ",").cast("array<double>")
    place = lambda g, i: F.instr(F.lit(letters), F.substring(g, i, 1)) - 1
    value = lambda g: F.element_at(table, place(g, 1) * 729 + place(g, 2) * 27 + place(g, 3) + 1)
    s = scored.withColumn("_piece", pieces(F.col("token")))
    s = s.withColumn("_m", (F.length("_piece") - 2).cast("double"))
    s = s.withColumn("_sum", F.when(F.col("_m") > 0, F.aggregate(trigrams(F.col("_piece")), F.lit(0.0),
                                                                 lambda a, g: a + value(g))))
    z = (F.col("_m") * mean - F.col("_sum")) / F.sqrt(F.col("_m") * max(var, 1e-9))
    n = F.size(F.split(F.trim("_piece"), " "))
    length = (F.length(F.trim("_piece")) - n + 1) / n
    short = (PIECE_LENGTH[0] - length) / (PIECE_LENGTH[1] / F.sqrt(n))
    p = F.when(F.col("_m") > 0, F.greatest(tail(z), tail(short)))
    return s.withColumn("word_p", F.coalesce(p, F.lit(1.0))).drop("_piece", "_m", "_sum")


def stratum():
    """Length strata are powers of two."""
    return F.floor(F.log2("n")).cast("int")


def p_bin():
    return F.floor(-F.log10("word_p") / STEP).cast("int")


def claims(scored: DataFrame, q: float = FALSE_DISCOVERIES) -> DataFrame:
    """(stratum, cut_bin): in each length stratum the largest ``word_p`` that
    Benjamini and Hochberg's rule rejects. P-values are counted in narrow bins,
    so only a bounded histogram is ranked; a bin is taken at its upper edge,
    which can only reject less."""
    bins = scored.groupBy(stratum().alias("stratum"), p_bin().alias("bin")).agg(F.count(F.lit(1)).alias("k"))
    upto = Window.partitionBy("stratum").orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    edge = F.pow(F.lit(10.0), -F.col("bin") * STEP)
    ranked = (bins.withColumn("rank", F.sum("k").over(upto))
              .withColumn("m", F.sum("k").over(Window.partitionBy("stratum"))))
    return (ranked.filter(edge <= q * F.col("rank") / F.col("m"))
            .groupBy("stratum").agg(F.min("bin").alias("cut_bin")))


def spans(docs: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, end) of every span, base and added."""
    found = written(matches(docs.select("doc_id", "text")), "op9_matches")
    base = found.filter("kind < 3").select("doc_id", "th", "kind", "start", "end")
    model = written(word_model(docs.select("text")), "op9_words")
    scored = written(worded(tested(found.filter("kind = 3")), model), "op9_scored")
    cut = written(claims(scored), "op9_cuts")
    kept = (scored.withColumn("stratum", stratum()).join(small(cut), "stratum")
            .filter((p_bin() >= F.col("cut_bin")) & (F.col("p_value") >= RANDOM_LEVEL))
            .select("doc_id", "th", "kind", "start", "end"))
    b = base.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), F.col("start").alias("_s"), F.col("end").alias("_e"))
    free = kept.join(b, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t"))
                     & (F.col("start") < F.col("_e")) & (F.col("_s") < F.col("end")), "left_anti")
    return base.unionByName(free)


def digest(found: DataFrame, kinds: tuple, n_base: int) -> DataFrame:
    """Per (doc_id, th): counts of the base kinds, their hash, and all spans."""

    text = lambda rows: F.array_join(F.transform(rows, lambda x: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in kinds]), x["kind"] + 1), x["start"].cast("string"),
        x["end"].cast("string"))), ",")
    rows = found.groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("s"),
        *[F.sum((F.col("kind") == i).cast("long")).alias(f"n_{k}") for i, k in enumerate(kinds[:n_base])])
    return rows.select("doc_id", "th", *[f"n_{k}" for k in kinds[:n_base]],
                       F.sha2(text(F.filter("s", lambda x: x["kind"] < n_base)), 256).alias("base_sha256"),
                       text(F.col("s")).alias("spans"))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """The digest per document."""
    counts = [f"n_{k}" for k in KINDS[:3]]
    found = written(digest(spans(docs), KINDS, 3), "op9_digest")
    found = small(found.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), *counts, "base_sha256", "spans"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"))
    return (rows.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), "left")
            .select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                    F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
                    F.coalesce("spans", F.lit("")).alias("spans")))
