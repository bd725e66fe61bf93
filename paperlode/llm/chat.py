"""Chat formatting with cumulative-snapshot collapse, in DataFrame operations only.

Chat logs hold a conversation once for each state it was saved in. Every turn gets a hash of its
role, text and position; the running XOR of these identifies the prefix that ends there. A
conversation goes if its whole is a proper prefix of another, or equals one of smaller conv_id.
What is left is rendered with role markers.

Results for odd input: turns are ordered by turn (nulls first), then role and text; a repeated
row is a turn of its own; null roles and texts count as empty strings; rows without conv_id belong
to no conversation and give no row. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved, table

#: Turns of one conversation that are numbered together; longer ones are numbered chunk by chunk.
CHUNK = 1024
#: Marks around a rendered turn.
BEGIN, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def rolling_prefixes(turns: DataFrame) -> DataFrame:
    """Turns with pos (from 1) and the hash (h1, h2) of the prefix that ends there.

    A running XOR can be summed up chunk by chunk, so no task has to hold or sort a whole very
    long conversation: what it meets is one row for each chunk of the others.
    """
    t = turns.where("conv_id is not null").select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(2**62))).alias("chunk"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "text"]
    within = Window.partitionBy("conv_id", "chunk").orderBy(*order)
    sizes = t.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "chunk", F.sum("n").over(before).alias("skip")).where("skip is not null")
    t = t.withColumn("rank", F.row_number().over(within)).join(offsets, ["conv_id", "chunk"], "left")
    t = t.withColumn("pos", F.col("rank") + F.coalesce("skip", F.lit(0))).drop("rank", "skip")
    running = Window.partitionBy("conv_id", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    for h, seed in (("h1", 11), ("h2", 47)):
        t = t.withColumn(h, F.xxhash64(F.lit(seed), "pos", F.length("role"), "role", "text"))
    carried = t.groupBy("conv_id", "chunk").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
    carried = carried.select("conv_id", "chunk", *(F.bit_xor(f"x{i}").over(before).alias(f"c{i}") for i in (1, 2))).where("c1 is not null")
    for h in ("h1", "h2"):
        t = t.withColumn(h, F.bit_xor(h).over(running))
    t = t.join(carried, ["conv_id", "chunk"], "left")
    for i in (1, 2):
        t = t.withColumn(f"h{i}", F.col(f"h{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))))
    return t.select("conv_id", "pos", "role", "text", "h1", "h2")


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that no other one starts with."""
    ends = prefixes.groupBy("conv_id").agg(F.max(F.struct("pos", "h1", "h2")).alias("e"))
    ends = ends.select("conv_id", F.col("e.pos").alias("n_turns"), F.col("e.h1").alias("h1"), F.col("e.h2").alias("h2"))
    whole = ends.groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    longest = ends.select("conv_id", F.col("n_turns").alias("last"))
    proper = prefixes.join(longest, "conv_id").where("pos < last").groupBy("pos", "h1", "h2").agg(F.count("*").alias("n"))
    on = (whole.n_turns == proper.pos) & (whole.h1 == proper.h1) & (whole.h2 == proper.h2)
    return whole.join(proper, on, "left_anti").select("conv_id", "n_turns", "n_copies")


def render(turns: DataFrame) -> DataFrame:
    """conv_id and the rendered text of conversations given as (conv_id, pos, role, text)."""
    one = F.concat(F.lit(BEGIN), "role", F.lit(MIDDLE), "text", F.lit(END))
    return (
        turns.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", one.alias("one")))).alias("all"))
        .select("conv_id", F.array_join(F.transform("all", lambda x: x["one"]), "").alias("rendered"))
    )


def format_chats(turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and rendered of every maximal conversation."""
    prefixes = saved(rolling_prefixes(turns), "chat")
    kept = maximal(prefixes.select("conv_id", "pos", "h1", "h2"))
    text = render(prefixes.select("conv_id", "pos", "role", "text").join(kept.select("conv_id"), "conv_id", "left_semi"))
    return kept.join(text, "conv_id")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = format_chats(table(spark, sf_dir, "conversations"))
    return chats.select("conv_id", "n_turns", "n_copies", F.sha2("rendered", 256).alias("rendered_sha256"), F.length("rendered").cast("long").alias("n_chars"))


SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
p AS (
  SELECT conv_id, pos, list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY pos) AS turns,
    count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM t),
f AS (SELECT min(conv_id) AS conv_id, n_turns, count(*) AS n_copies, turns FROM p WHERE pos = n_turns GROUP BY n_turns, turns),
q AS (SELECT DISTINCT turns FROM p WHERE pos < n_turns),
k AS (SELECT f.* FROM f ANTI JOIN q ON f.turns = q.turns),
r AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY pos) AS rendered
      FROM t GROUP BY conv_id)
SELECT k.conv_id, n_turns, n_copies, sha256(rendered) AS rendered_sha256, length(rendered) AS n_chars
FROM k JOIN r ON k.conv_id = r.conv_id
"""
