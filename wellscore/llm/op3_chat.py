"""Chat formatting after cumulative-snapshot collapse.

Logged conversations are often snapshots of one growing conversation. Each turn gets the
rolling hash of the turns up to it (two running exclusive-ors of position-coded hashes); a
conversation whose full hash is the prefix hash of a longer one is dropped by an anti-join,
and of equal conversations the one with the least id stays.

Edge cases: rows without a conv_id belong to no conversation and are left out; a null role
or text is empty; turns sort by (turn, role, text) with null turns first, so ties are
deterministic; fully repeated rows are one turn; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellscore.llm.common import table_rows


def turn_prefixes(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, p1, p2, last): every turn with the hash of all turns up to it."""
    t = table_rows(conversations, conv_id="conv_id", turn="turn", role="role", text="text").filter("conv_id IS NOT NULL")
    t = t.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    w = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    t = t.withColumn("pos", F.row_number().over(w)).withColumn("last", F.lead(F.lit(1)).over(w).isNull())
    running = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    h = [F.bit_xor(F.xxhash64(F.lit(s), "pos", "role", "text")).over(running).alias(p) for s, p in ((1, "p1"), (2, "p2"))]
    return t.select("conv_id", "pos", "role", "text", "last", *h)


def maximal(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that no longer one continues."""
    p = turn_prefixes(conversations).select("conv_id", "pos", "p1", "p2", "last")
    full = p.filter("last").groupBy("pos", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    prefixes = p.filter("NOT last").select("pos", "p1", "p2").distinct()
    return full.join(prefixes, ["pos", "p1", "p2"], "left_anti").select("conv_id", F.col("pos").cast("long").alias("n_turns"), "n_copies")


def render(conversations: DataFrame, open_: str = "<|im_start|>", close: str = "<|im_end|>\n") -> DataFrame:
    """One row per maximal conversation: conv_id, n_turns, n_copies, rendered."""
    kept = maximal(conversations)
    turns = turn_prefixes(conversations).select("conv_id", "pos", F.concat(F.lit(open_), "role", F.lit("\n"), "text", F.lit(close)).alias("s"))
    whole = turns.join(kept, "conv_id").groupBy("conv_id", "n_turns", "n_copies").agg(F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("t"))
    return whole.select("conv_id", "n_turns", "n_copies", F.array_join(F.col("t.s"), "").alias("rendered"))


SQL = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM t),
p AS (SELECT conv_id, pos, string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY pos) AS prefix,
      count(*) OVER (PARTITION BY conv_id) AS n FROM o),
f AS (SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_copies, prefix FROM p WHERE pos = n GROUP BY n, prefix),
m AS (SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.pos < p.n AND p.pos = f.n_turns AND p.prefix = f.prefix))
SELECT m.conv_id, m.n_turns, m.n_copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM m JOIN o USING (conv_id) GROUP BY ALL
"""
