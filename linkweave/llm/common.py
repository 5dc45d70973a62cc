"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.sources.scratch import written

#: A word of the contracts: a run of anything but the six ASCII blanks.
BLANK_WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch sent to Python; texts can be long, so few.
BATCH_BYTES = 8 << 20
A_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def partitions(df: DataFrame) -> int:
    """Partitions that the session gives to a shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``df`` with columns c0, c1, ..., so that no name of a caller's clashes with one made here; the new names by the old ones; and the columns that restore ``df``."""
    names = {c: f"c{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names, [F.col(f"`{n}`").alias(c) for c, n in names.items()]


def spread_join(rows: DataFrame, right: DataFrame, key: str, by: tuple[str, ...], salts: int, how: str = "left") -> DataFrame:
    """``rows`` joined by ``key`` with ``right``, which has one row for each key, so that the rows of a frequent key are dealt to many tasks.

    Rows have a salt, a hash of their columns ``by``. The pairs of key and salt
    that occur, at most ``salts`` for a key, meet ``right`` first, and the rows
    then meet those pairs. ``rows`` is read twice.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)))
    pairs = salted.select(key, "_salt").distinct().join(right, key)
    return salted.join(pairs, [key, "_salt"], how).drop("_salt")


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with sums over all rows before each one in ``order``, which has no ties; 0 for the first.

    Rows are dealt into ranges of the order and summed there; of each range,
    of which there are as many as shuffle partitions, its totals come to the
    driver.
    """
    dealt = written(df.repartitionByRange(partitions(df), *order).withColumn("_range", F.spark_partition_id()), "ranges")
    rows = dealt.groupBy("_range").agg(*[F.sum(c).alias(n) for n, c in sums.items()]).orderBy("_range").collect()
    offsets, run = [], [0] * len(sums)
    for r in rows:
        offsets.append((r["_range"], *run))
        run = [x + r[n] for x, n in zip(run, sums, strict=True)]
    kinds = {n: dealt.groupBy().agg(F.sum(c).alias(n)).schema[n].dataType for n, c in sums.items()}
    values = [tuple([o[0], *(float(x) if k.typeName() == "double" else x for x, k in zip(o[1:], kinds.values(), strict=True))]) for o in offsets]
    before = F.broadcast(df.sparkSession.createDataFrame(values, "_r int, " + ", ".join(f"_{n} {k.simpleString()}" for n, k in kinds.items())))
    window = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.withColumns({n: F.coalesce(F.sum(c).over(window), F.lit(0).cast(kinds[n])) for n, c in sums.items()})
    joined = inside.join(before, F.col("_range") == F.col("_r"))
    return joined.withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_range", "_r", *[f"_{n}" for n in sums])


def slices(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``column`` holds about ``most`` bytes; a longer value is a run of its own."""
    n = batch.num_rows
    if not n:
        return
    lengths = np.asarray(
        pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64
    )
    ends = np.cumsum(lengths)
    lo = 0
    while lo < n:
        base = ends[lo] - lengths[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def raw_texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and the n + 1 offsets; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[at[0] : at[-1]], at - at[0]


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, A_Z, A_Z.lower())


def hex64(values: np.ndarray) -> list[str]:
    """16 lowercase hex digits each."""
    return [f"{v:016x}" for v in values.tolist()]


__all__ = ["A_Z", "BLANK_WORD", "hex64", "lowered", "numbered", "partitions", "raw_texts", "running_sums", "slices", "spread_join", "written"]
