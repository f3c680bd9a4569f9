"""Preference formatting of paired conversations.

Two conversations of a pair, chosen and rejected, share their first turns up
to the first difference. That common prefix is rendered once as the prompt;
what follows is rendered for each side as a completion, with the character
ranges that count for the loss (the assistant's turns).

The first difference is found without gathering a conversation: each turn of a
side is reduced to a count and a sum of hashes, turns are compared, and the
smallest differing turn of the pair is kept. A rendered part is returned in
blocks of ``BLOCK`` turns, so no record grows with its conversation.

Where a table holds no preferences, ``derived`` makes pairs that share turns:
the conversation as it stands is chosen, and the same turns with the last
assistant turn's text taken from another conversation are rejected.

Edge cases: a row without a pair belongs to no conversation; a row without a
turn comes before the others; null roles and texts are rendered as nothing and
equal only each other; repeated rows count once; several rows of one turn are
ordered by their hash and, beyond a block's worth, spread over sub-blocks; a
side that is missing has an empty common prefix; a derived pair without an
answer to take or to replace is all prompt; a long text is carried once per side and
rendered where it falls, whole; an empty table gives an empty
result; extra columns are left aside.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, written

BLOCK = 64


def paired(conversations: DataFrame) -> DataFrame:
    """(pair_id, side, turn, role, text): conversations 2k and 2k + 1 are the
    chosen and the rejected one of pair k."""
    c = F.col("conv_id").cast("long")
    side = F.when(F.pmod(c, F.lit(2)) == 0, "chosen").otherwise("rejected")
    return conversations.filter(c.isNotNull()).select(F.floor(c / 2).cast("long").alias("pair_id"), side.alias("side"),
                                                      F.col("turn").cast("long").alias("turn"), "role", "text")


def derived(conversations: DataFrame) -> DataFrame:
    """(pair_id, side, turn, role, text): every conversation c is the chosen
    side of pair c; in the rejected one its last assistant turn has the text of
    the last assistant turn of the other conversation of 2k and 2k + 1. Where
    that has none, both sides are the same."""
    c = F.col("conv_id").cast("long")
    rows = conversations.filter(c.isNotNull()).select(c.alias("pair_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    # one row per conversation, combined map-side
    last = written(rows.filter("role = 'assistant'").groupBy("pair_id").agg(
        F.max(F.struct("turn", "text")).alias("last")).select("pair_id", "last.*"), "op5_last")
    own = last.select(F.col("pair_id").alias("_p"), F.col("turn").alias("_turn"))
    other = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("_q"), F.col("text").alias("_answer"))
    swap = own.join(other, F.col("_p") == F.col("_q")).drop("_q")
    replaced = (F.col("role") == "assistant") & F.col("turn").eqNullSafe(F.col("_turn")) & F.col("_p").isNotNull()
    rejected = rows.join(swap, F.col("pair_id") == F.col("_p"), "left").withColumn(
        "text", F.when(replaced, F.col("_answer")).otherwise(F.col("text")))
    return (rows.select("pair_id", F.lit("chosen").alias("side"), "turn", "role", "text")
            .unionByName(rejected.select("pair_id", F.lit("rejected").alias("side"), "turn", "role", "text")))


def formatted(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(pair_id, part, block, sub, rendered, loss_mask, n_turns) of rows
    (pair_id, side, turn, role, text)."""
    h = F.xxhash64(F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text"))
    turn = F.coalesce("turn", F.lit(-1))
    rows = turns.filter("pair_id IS NOT NULL").select(
        "pair_id", "side", turn.alias("turn"), "role", "text", h.alias("h"), F.floor(turn / block).cast("long").alias("block"))
    is_chosen = F.col("side") == "chosen"
    # decimal sums do not overflow; hashes stand for the texts here
    digest = lambda keep: F.sum(F.when(keep, F.col("h").cast("decimal(38,0)")))
    per_turn = written(rows.select("pair_id", "side", "turn", "h").distinct().groupBy("pair_id", "turn").agg(
        digest(is_chosen).alias("c"), digest(~is_chosen).alias("r"),
        F.sum(is_chosen.cast("long")).alias("nc"), F.sum((~is_chosen).cast("long")).alias("nr")), "op5_turns")
    differs = ~(F.col("c").eqNullSafe(F.col("r")) & (F.col("nc") == F.col("nr")))
    first = written(per_turn.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn"))).alias("first"))
                    .withColumnRenamed("pair_id", "_pair"), "op5_first")
    crowded = written(per_turn.filter(F.greatest("nc", "nr") > block)
                      .select(F.col("pair_id").alias("_p"), F.col("turn").alias("_t"),
                              F.greatest("nc", "nr").alias("_n")), "op5_crowded")
    r = rows.distinct()  # repeated rows are combined before they are shuffled
    r = r.join(small(first), F.col("pair_id") == F.col("_pair"))
    r = r.join(small(crowded), (F.col("pair_id") == F.col("_p")) & (F.col("turn") == F.col("_t")), "left")
    shared = F.col("first").isNull() | (F.col("turn") < F.col("first"))
    r = r.filter(~shared | is_chosen)  # the prompt once
    r = r.withColumn("part", F.when(shared, "prompt").otherwise(F.col("side")))
    # place of the hash among as many equal ranges as the turn needs
    ranges = F.ceil(F.col("_n") / block)
    r = r.withColumn("sub", F.when(F.col("_n").isNull(), 0).otherwise(
        F.least(ranges - 1, F.floor((F.col("h") / 2.0 ** 64 + 0.5) * ranges))).cast("long"))
    # a crowded turn is a block of its own
    r = r.withColumn("alone", F.when(F.col("_n").isNull(), F.lit(None)).otherwise(F.col("turn")))

    head = F.concat(F.lit("<|"), F.coalesce("role", F.lit("")), F.lit("|>\n"))
    body = F.concat(F.coalesce("text", F.lit("")), F.lit("<|end|>\n"))
    g = (r.groupBy("pair_id", "part", "block", "alone", "sub")
         .agg(F.array_sort(F.collect_list(F.struct("turn", "h", head.alias("head"), body.alias("body"), "role"))).alias("t")))
    # at most a block of turns: running offsets by summing the rows before
    size = lambda x: F.length(x["head"]) + F.length(x["body"])
    before = lambda i: F.aggregate(F.slice("t", F.lit(1), i), F.lit(0), lambda a, x: a + size(x))
    ranges = F.transform("t", lambda x, i: F.when(x["role"] == "assistant", F.concat_ws(
        ":", before(i) + F.length(x["head"]), before(i + 1))))
    return g.select("pair_id", "part", F.coalesce(F.col("alone"), F.col("block") * block).alias("first_turn"), "sub",
                    F.concat_ws("", F.transform("t", lambda x: F.concat(x["head"], x["body"]))).alias("rendered"),
                    F.when(F.col("part") == "prompt", F.lit("")).otherwise(F.array_join(ranges, ",")).alias("loss_mask"),
                    F.size("t").cast("long").alias("n_turns"))


def format_preferences(conversations: DataFrame) -> DataFrame:
    """All pairs of ``conversations``, by conversation number."""
    return formatted(paired(conversations))


def format_derived_preferences(conversations: DataFrame) -> DataFrame:
    """One pair per conversation, against another's answer."""
    return formatted(derived(conversations))


_FORMATTED = """,
f AS (
  SELECT pair_id, min(turn) FILTER (WHERE NOT same) AS first FROM (
    SELECT coalesce(c.pair_id, j.pair_id) AS pair_id, coalesce(c.turn, j.turn) AS turn,
           coalesce(c.role = j.role AND c.text = j.text, false) AS same
    FROM (SELECT * FROM r WHERE side = 'chosen') c
    FULL JOIN (SELECT * FROM r WHERE side = 'rejected') j ON c.pair_id = j.pair_id AND c.turn = j.turn)
  GROUP BY pair_id),
s AS (
  SELECT r.pair_id, CASE WHEN first IS NULL OR turn < first THEN 'prompt' ELSE side END AS part, turn // 64 * 64 AS first_turn,
         turn, role, '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body
  FROM r JOIN f ON r.pair_id = f.pair_id
  WHERE NOT ((first IS NULL OR turn < first) AND side = 'rejected')),
o AS (
  SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY pair_id, part, first_turn ORDER BY turn) AS upto FROM s)
SELECT pair_id, part, first_turn, CAST(0 AS BIGINT) AS sub, string_agg(head || body, '' ORDER BY turn) AS rendered,
       CASE WHEN part = 'prompt' THEN '' ELSE coalesce(string_agg(
         CASE WHEN role = 'assistant' THEN CAST(upto - length(body) AS BIGINT) || ':' || CAST(upto AS BIGINT) END, ','
         ORDER BY turn), '') END AS loss_mask,
       count(*) AS n_turns
FROM o GROUP BY pair_id, part, first_turn
"""

PAIRED_ORACLE = """
WITH r AS (
  SELECT DISTINCT conv_id // 2 AS pair_id, CASE WHEN conv_id % 2 = 0 THEN 'chosen' ELSE 'rejected' END AS side,
         turn, role, text
  FROM conversations)""" + _FORMATTED

ORACLE = """
WITH l AS (
  SELECT conv_id, turn, text FROM conversations WHERE role = 'assistant'
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1),
w AS (SELECT a.conv_id, a.turn, b.text FROM l a JOIN l b ON b.conv_id = xor(a.conv_id, 1)),
r AS (
  SELECT DISTINCT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM conversations
  UNION ALL
  SELECT DISTINCT c.conv_id, 'rejected', c.turn, c.role, CASE WHEN w.conv_id IS NULL THEN c.text ELSE w.text END
  FROM conversations c LEFT JOIN w ON w.conv_id = c.conv_id AND w.turn = c.turn AND c.role = 'assistant')""" + _FORMATTED
