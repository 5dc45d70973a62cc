"""New S1 rows as a stream, joined with a static pool: append mode, no state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.operators.blocking import Channel, not_blank, top_per


def stream_candidates(s1: DataFrame, pool: DataFrame, channel: Channel, within: tuple[str, ...] = ("country",)) -> DataFrame:
    """(s1_id, cand_id, priority, channel_mask) of each new row of ``s1``, a streaming or batch table of keyed entities.

    Pool keys are capped by id as in batch. A stream can't know how often S1
    will hold a key, so no S1 key is dropped.
    """
    on = [*within, *channel.keys]
    ok = not_blank(*channel.keys, least=channel.least)
    right = top_per(pool.where(ok).select(F.col("entity_id").alias("cand_id"), *on), on, [F.col("cand_id")], channel.most)
    left = s1.where(ok).select(F.col("entity_id").alias("s1_id"), *on)
    return left.join(right, on).select("s1_id", "cand_id", F.lit(channel.priority).alias("priority"), F.lit(channel.bit).alias("channel_mask"))
