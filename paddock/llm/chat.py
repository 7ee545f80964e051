"""Chat formatting by perspective rotation.

Every participant of a conversation (a role other than ``system``) gets the
dialogue from its side: its own messages are the assistant's, those of others
are users' with their role as name, system messages stay. The mask marks what
is learned: the assistant's texts with their end marks.

A rendered dialogue is cut into parts at message borders: a message belongs to
part floor(its offset / ``part_chars``), so a part holds a bounded number of
messages, whatever the length of the conversation, and one longer message
stays whole. Offsets are running lengths over (conversation, perspective).
Rows are range-partitioned in dialogue order, so a conversation that holds a
third of all rows is many partitions; each sums its own rows and adds what
earlier partitions of the same dialogue hold, a frame of at most one row per
partition boundary. The ranged rows are written first: all readers see the same
partitions, and a lost executor repeats nothing before them.

Nulls and ties: messages go by turn (nulls last), role, text. A null text is
empty, a null role is a user without a name and no participant. Messages
without a conversation id form one conversation. A conversation without a
participant gives no row. The chat marks inside texts are broken by a space.
Columns of the input beyond the four are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import stored
from paddock.session import shuffle_parts

PART_CHARS = 32_768
SALTS = 16
# The marks of the chat format.
BEGIN, FINISH = "<|im_start|>", "<|im_end|>"


def _head(role: Column, perspective: Column) -> Column:
    name = F.coalesce(F.concat(F.lit(" name="), role), F.lit(""))
    return F.concat(F.lit(BEGIN), F.when(role == perspective, "assistant").when(role == "system", "system")
                    .otherwise(F.concat(F.lit("user"), name)), F.lit("\n"))


def messages(chats: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A row per message and perspective, in dialogue ranges: conv_id,
    perspective, turn, role, head, body, offset (of the head, code points)."""
    broken = F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    m = chats.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"),
                     broken.alias("body"), F.monotonically_increasing_id().alias("row"))
    who = (m.filter("role is not null and role <> 'system'").select(F.col("conv_id").alias("c"), F.col("role").alias("perspective"))
            .distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    both = m.join(who, F.col("conv_id").eqNullSafe(F.col("c")) & (F.pmod("row", F.lit(SALTS)) == F.col("salt")))
    each = both.select("conv_id", "perspective", "turn", "role", "row", _head(F.col("role"), F.col("perspective")).alias("head"),
                       F.concat("body", F.lit(FINISH + "\n")).alias("body"))
    order = [F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("body"), F.col("row")]
    ranged = stored(each.withColumn("size", F.length("head") + F.length("body"))
                    .repartitionByRange(shuffle_parts(chats.sparkSession), "conv_id", "perspective", *order)
                    .withColumn("piece", F.spark_partition_id()), "chat-ranges")
    inside = Window.partitionBy("piece", "conv_id", "perspective").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("conv_id", "perspective").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy("piece", "conv_id", "perspective").agg(F.sum("size").alias("size"))
              .withColumn("before", F.sum("size").over(across)).filter("before is not null")
              .select(F.col("piece").alias("p"), F.col("conv_id").alias("c"), F.col("perspective").alias("s"), "before"))
    here = (F.col("piece") == F.col("p")) & F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("s"))
    zero = F.lit(0).cast("long")
    return (ranged.withColumn("local", F.coalesce(F.sum("size").over(inside), zero)).join(before, here, "left")
                  .withColumn("offset", F.col("local") + F.coalesce("before", zero))
                  .select("conv_id", "perspective", "turn", "role", "head", "body", "size", "offset"))


def render(chats: DataFrame, part_chars: int = PART_CHARS, **columns) -> DataFrame:
    """conv_id, perspective, part, n_messages, text, masks (start:end, comma-
    joined, code points of the part's text), n_masked."""
    rows = messages(chats, **columns).withColumn("part", F.floor(F.col("offset") / part_chars))
    own = F.col("role") == F.col("perspective")
    item = F.struct("offset", "head", "body", F.coalesce(own, F.lit(False)).alias("own"))
    parts = rows.groupBy("conv_id", "perspective", "part").agg(F.array_sort(F.collect_list(item)).alias("all"))
    start = lambda x: x["offset"] - F.col("all")[0]["offset"] + F.length(x["head"])
    stop = lambda x: start(x) + F.length(x["body"]) - 1  # noqa: E731  (the line break is not learned)
    mine = F.filter("all", lambda x: x["own"])
    return parts.select(
        "conv_id", "perspective", "part", F.size("all").cast("long").alias("n_messages"),
        F.array_join(F.transform("all", lambda x: F.concat(x["head"], x["body"])), "").alias("text"),
        F.array_join(F.transform(mine, lambda x: F.concat_ws(":", start(x).cast("string"), stop(x).cast("string"))), ",").alias("masks"),
        F.aggregate(mine, F.lit(0).cast("long"), lambda n, x: n + stop(x) - start(x)).alias("n_masked"))
