"""A uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in blocks (a hash of the row). How many rows each block sends to each
shard is drawn first, as a matrix with the block sizes as row sums and the
shard sizes as column sums: the law that a uniformly random permutation of all
rows gives to these counts. Then each block permutes its rows and deals them
by its row of the matrix, and each shard permutes what it receives. The result
is a uniform permutation, yet no step needs all rows, or a whole shard, in one
task.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.llm.common import numbered, written

#: Rows that a block or a piece of a shard aims at; both are sorted in one task, with spill.
BLOCK_ROWS = 4_000
MOST_BLOCKS = 4_096


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Good ones among ``draws`` out of ``good + bad`` without replacement, exactly.

    Inversion from the mode outward, by the ratios of neighbouring chances.
    """
    from math import exp, lgamma

    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    log_choose = lambda n, k: lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    chance = exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(good + bad, draws))
    u = rng.random() - chance
    if u <= 0:
        return mode
    up, down, p_up, p_down = mode, mode, chance, chance
    while up < high or down > low:
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
    return mode


def communication_matrix(block_sizes: list[int], shard_sizes: list[int], seed: int) -> list[list[int]]:
    """Rows that each block sends to each shard."""
    rng, left, matrix = random.Random(seed), list(shard_sizes), []
    for size in block_sizes:
        row, draws, rest = [], size, sum(left)
        for s, room in enumerate(left):
            rest -= room
            taken = draws if s == len(left) - 1 else hypergeometric(rng, room, rest, draws)
            row.append(taken)
            draws -= taken
        left = [room - taken for room, taken in zip(left, row, strict=True)]
        matrix.append(row)
    return matrix


def _mixed_hash(salt: str, seed: int, *keys: Column) -> Column:
    return F.xxhash64(F.lit(f"{salt}:{seed}"), *keys)


def sharded(df: DataFrame, shards: int = 8, seed: int = 42, checksum: str | None = None) -> DataFrame:
    """``df`` (doc_id, text or a ``checksum`` of it, and any others) with int ``shard`` and long ``slot``, gapless from 0 in each shard.

    Shard sizes differ by one row at most. A row's place depends on the whole
    table, its doc_id, its text and the seed, and ties are broken by all other
    columns (but maps), so reruns agree; equal rows are interchangeable. Null
    doc_ids and texts count as values of their own; an empty table gives no
    rows. Columns of ``df`` may have any names; its own ``shard`` and ``slot``
    are replaced. Only counts (blocks times shards, 4,096 blocks at most) come
    to the driver.
    """
    whole, names, restored = numbered(df)
    restored = [c for c, n in zip(restored, names, strict=True) if n not in ("shard", "slot")]
    doc_id = F.col(names["doc_id"])
    text = F.col(names[checksum]) if checksum else F.crc32(F.coalesce(F.col(names["text"]).cast("string"), F.lit("")))
    keys = [F.coalesce(doc_id.cast("string"), F.lit("null")), text]
    others = F.xxhash64(*[F.col(n) for n, t in whole.dtypes if "map<" not in t])
    rows = whole.withColumns({"_a": _mixed_hash("deal", seed, *keys), "_b": _mixed_hash("order", seed, *keys), "_k": text, "_o": others})
    total = df.count()
    blocks = max(1, min(MOST_BLOCKS, -(-total // BLOCK_ROWS)))
    rows = rows.withColumn("_block", F.pmod(_mixed_hash("block", seed, *keys), F.lit(blocks)).cast("int"))
    counted = {r["_block"]: r["count"] for r in rows.groupBy("_block").count().collect()}
    sizes = [counted.get(b, 0) for b in range(blocks)]
    matrix = communication_matrix(sizes, [total // shards + (s < total % shards) for s in range(shards)], seed)

    # Each block's row of the matrix as running sums: the rank of a row decides its shard.
    ends = []
    for row in matrix:
        run, sums = 0, []
        for x in row:
            run += x
            sums.append(run)
        ends.append(sums)
    spark = df.sparkSession
    plan = F.broadcast(spark.createDataFrame(list(enumerate(ends)), "_p int, _ends array<long>"))
    rank = F.row_number().over(Window.partitionBy("_block").orderBy("_a", doc_id, "_k", "_o")).cast("long")
    dealt = rows.withColumn("_rank", rank).join(plan, F.col("_block") == F.col("_p"))
    dealt = dealt.withColumn("shard", F.expr("CAST(size(filter(_ends, e -> e < _rank)) AS INT)")).drop("_rank", "_p", "_ends")

    # A shard is permuted in pieces: its rows fall into ranges of a hash, and each range is sorted by itself.
    pieces = max(1, min(MOST_BLOCKS // shards, -(-total // (shards * BLOCK_ROWS))))
    dealt = dealt.withColumn("_piece", F.pmod(_mixed_hash("piece", seed, *keys), F.lit(pieces)).cast("int"))
    held = sorted((r["shard"], r["_piece"], r["count"]) for r in dealt.groupBy("shard", "_piece").count().collect())
    run, starts = {}, []
    for s, piece, count in held:
        starts.append((s, piece, run.get(s, 0)))
        run[s] = run.get(s, 0) + count
    begin = F.broadcast(spark.createDataFrame(starts, "_s int, _q int, _begin long"))
    place = F.row_number().over(Window.partitionBy("shard", "_piece").orderBy("_b", doc_id, "_k", "_o")).cast("long")
    placed = dealt.withColumn("_place", place).join(begin, (F.col("shard") == F.col("_s")) & (F.col("_piece") == F.col("_q")))
    return placed.withColumn("slot", F.col("_begin") + F.col("_place") - 1).select(*restored, "shard", "slot")


def narrow(documents: DataFrame) -> DataFrame:
    """doc_id, size and text_crc32 of each document, written once so that the shuffle carries no texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = F.when(F.col("text").isNull(), 1).otherwise(F.octet_length(text) + 1).cast("long")
    return written(documents.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.crc32(text).alias("text_crc32")), "rows")
