"""Mixing sources to target weights by repetition rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import running_sums, written

#: Source tables of up to so many rows are broadcast; larger ones are joined by a shuffle.
MOST_BROADCAST = 10_000


def word_count(text: str = "text") -> Column:
    """Blank-separated words of a text; 0 for null."""
    clean = F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    body = F.trim(clean)
    return F.when(body == "", F.lit(0)).otherwise(F.length(body) - F.length(F.replace(body, F.lit(" "), F.lit(""))) + 1).cast("long")


def source_targets(sizes: DataFrame, most: float = 3.0) -> DataFrame:
    """(source, source_size, target, rate) from rows of (source, size).

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and share
    the total of all sizes by weight. No target exceeds ``most`` times its
    source's size; what is cut off is shared by weight among the others until
    none is above. Sources that fill first are those with the least size for
    their weight, so one pass in that order finds the level. A source of size 0 has
    target 0 and rate 0. There may be any number of sources: places and running
    sums are found by ranges.
    """
    by_name = [F.col("source").isNull(), F.col("source")]
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weighed = running_sums(totals, by_name, {"rank": F.lit(1)}).withColumn("weight", (F.col("rank") % 3 + 1).cast("long")).withColumn("cap", F.col("source_size") * F.lit(most))
    fill = F.col("cap") / F.col("weight")
    filled = written(running_sums(weighed, [fill, *by_name], {"cap_before": F.col("cap"), "weight_before": F.col("weight")}), "filled")
    total, weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (F.lit(float(total or 0)) - F.col("cap_before")) / (F.lit(weights or 0) - F.col("weight_before"))
    # The level of the first source, in order of filling, that stays below its cap; every later one has the same.
    levelled = filled.withColumn("level", level)
    lowest = levelled.where(F.col("level") * F.col("weight") <= F.col("cap")).agg(F.min(F.struct(fill.alias("fill"), by_name[0].alias("last"), "source", "level")).alias("x")).first()["x"]
    target = F.least("cap", F.lit(lowest["level"]) * F.col("weight")) if lowest else F.col("cap")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return filled.withColumn("target", target).withColumn("rate", rate).select("source", "source_size", "target", "rate")


def copies(rate: Column, *keys: Column, seed: int = 42) -> Column:
    """floor(rate), and one more with the fraction as probability, drawn by a hash of the keys."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def narrow(documents: DataFrame) -> DataFrame:
    """doc_id, source, size and text digest of each document, written once so that texts are read once."""
    digest = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return written(documents.select("doc_id", "source", word_count().alias("size"), digest.alias("digest")), "rows")


def mixture(df: DataFrame, most: float = 3.0, seed: int = 42, size: str | None = None, digest: str | None = None) -> DataFrame:
    """``row``, a struct of all columns of ``df`` (doc_id, text, source and any others), with size, source_size, target and copies.

    ``copies`` is how often the mix holds the row: the whole part of its
    source's rate, and one more by a draw that doc_id, text digest and seed
    decide, so reruns agree and repeated rows are drawn alike. Draws are
    independent: of a source with fraction f the words taken differ from the
    target with standard deviation sqrt(f * (1 - f) * sum of squared sizes).
    Null and empty texts have size 0 and are drawn as any other row. An empty
    table gives no rows. ``size`` and ``digest`` name columns that hold these
    already, as in ``narrow``.
    """
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))
    name = F.col(f"row.{digest}") if digest else F.md5(F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    sized = rows.withColumns({"size": F.col(f"row.{size}") if size else word_count("row.text"), "source": F.col("row.source").cast("string")})
    targets = written(source_targets(sized.select("source", "size"), most), "targets")
    right = targets.withColumnRenamed("source", "s")
    right = F.broadcast(right) if targets.count() <= MOST_BROADCAST else right
    joined = sized.join(right, F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.withColumn("copies", copies(F.col("rate"), F.col("row.doc_id"), name, seed=seed)).drop("s", "source", "rate")


def mixed(df: DataFrame, most: float = 3.0, seed: int = 42) -> DataFrame:
    """The mix itself: each row of ``df`` as often as ``mixture`` says, with the columns of ``df``, whatever their names."""
    whole = mixture(df, most, seed).where("copies > 0")
    return whole.select("row", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).select("row.*")
