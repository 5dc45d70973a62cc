"""Chat formatting: logged snapshots of one conversation collapse to the longest, then each is rendered.

A turn's hash covers its place, role and text; the running sums of two such
hashes name every prefix of a conversation. A conversation whose own name is
also the name of a proper prefix of another one was a snapshot of it, and an
anti-join drops it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.common import partitions, spread_join, written


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, place ``n``, number of turns ``of`` and the 16-byte name of the prefix that ends at each turn.

    Turns stand in order of turn (null last), role and text. Null roles and
    texts differ from empty ones. Turns with a null conv_id make one
    conversation of their own.
    """
    rows = turns.select("conv_id", "turn", "role", "text")
    whole = Window.partitionBy("conv_id")
    order = whole.orderBy(F.col("turn").isNull(), "turn", "role", "text")
    placed = rows.withColumn("n", F.row_number().over(order))
    tag = lambda salt: F.xxhash64(F.lit(salt), "n", F.col("role").isNull(), "role", F.col("text").isNull(), "text")
    # Sums of signed 64-bit values in decimal, so that none overflows; two of them make chance equality negligible.
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    hashed = placed.select("conv_id", "turn", "role", "text", "n", tag("a").cast("decimal(20,0)").alias("ha"), tag("b").cast("decimal(20,0)").alias("hb"))
    sums = hashed.withColumns({"a": F.sum("ha").over(running), "b": F.sum("hb").over(running), "of": F.count("*").over(whole)})
    return sums.select("conv_id", "n", "of", F.unhex(F.md5(F.concat_ws(":", "n", "a", "b"))).alias("name"))


def collapsed(turns: DataFrame) -> DataFrame:
    """One row for each conversation: conv_id, n_turns, state and kept_id.

    ``state`` is ``kept``, ``copy`` of the conversation with the same turns and
    the smallest conv_id (``kept_id``), or ``prefix`` of a longer one. Repeated
    turns stand next to each other. An empty table gives no rows. Columns other
    than conv_id, turn, role and text don't matter.
    """
    named = written(prefixes(turns), "turn-prefixes")
    last = named.where("n = of")
    whole = last.groupBy("name").agg(F.min(F.struct(F.col("conv_id").isNull(), "conv_id")).alias("m")).select("name", F.col("m.conv_id").alias("kept_id"))
    proper = named.where("n < of").select("name").distinct()
    maximal = whole.join(proper, "name", "left_anti").withColumn("maximal", F.lit(True))
    # A conversation may be logged very often: its rows are dealt to many tasks.
    found = spread_join(last, maximal, "name", ("conv_id",), partitions(turns))
    state = F.when(F.col("maximal").isNull(), "prefix").when(F.col("conv_id").eqNullSafe(F.col("kept_id")), "kept").otherwise("copy")
    return found.select("conv_id", F.col("n").alias("n_turns"), state.alias("state"), F.when(F.col("maximal"), F.col("kept_id")).alias("kept_id"))


def rendered(turns: DataFrame, start: str = "<|", mid: str = "|>\n", end: str = "<|end|>\n") -> DataFrame:
    """(conv_id, n_turns, state, kept_id, chat): every conversation, ``chat`` rendered for the kept ones, else null."""
    states = collapsed(turns)
    kept = states.where("state = 'kept'").select(F.col("conv_id").alias("k"))
    line = F.concat(F.lit(start), F.coalesce("role", F.lit("")), F.lit(mid), F.coalesce("text", F.lit("")), F.lit("\n" + end))
    rows = turns.select("conv_id", "turn", "role", "text").join(kept, F.col("conv_id").eqNullSafe(F.col("k")), "left_semi")
    entry = F.struct(F.col("turn").isNull().alias("late"), "turn", "role", "text", line.alias("line"))
    chats = rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["line"]), "").alias("chat"))
    right = chats.withColumnRenamed("conv_id", "k")
    return states.join(right, F.col("conv_id").eqNullSafe(F.col("k")), "left").select("conv_id", "n_turns", "state", "kept_id", "chat")
