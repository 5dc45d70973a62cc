"""URL rules by a sort-merge range join.

A host is turned round label by label, so that a rule for a host and all its
subdomains is an interval of sorted keys. Pages and rules are dealt into key
ranges; a rule goes to every range that its interval meets. Within a range one
sorted sweep keeps a stack of the rules whose intervals are open: hosts nest, so a
rule leaves the stack when the sweep passes its end. Each stack entry holds the
paths of its host's rules by length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import lowered, partitions

#: Keys drawn for each range, to cut ranges of like size; they decide no result.
KEYS_PER_RANGE = 64


def url_parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://`` or for null."""
    whole = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.expr(f"substring(coalesce(CAST(`{url}` AS STRING), ''), instr(coalesce(CAST(`{url}` AS STRING), ''), '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return lowered(host), path


def reversed_host(host: Column) -> Column:
    """Labels last to first, each followed by a dot, so a subdomain's key starts with its domain's."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")))


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url", page_id: str = "page_id") -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    ``rules`` has host, path and verdict. A rule fits its host and all
    subdomains if the page's path starts with its path. Of several, the one
    with the longest host and path together wins, then the longer host, then
    the smaller verdict. Without one, ``rule`` is null and the verdict is
    ``default``. Urls that are null or hold no ``://`` have an empty host and
    path, which no rule fits. Repeated rows are judged alike, an empty table
    gives no rows, and columns other than the two named don't matter.
    """
    spark = pages.sparkSession
    host, path = url_parts(url)
    # The hash parts the pages of one host, however many, over several ranges.
    keyed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path")).withColumn("rhost", reversed_host(F.col("host")))
    keyed = keyed.withColumn("key", F.concat("rhost", F.lit("\x00"), F.hex(F.xxhash64("page_id", "path"))))
    ranges = partitions(pages)
    total = keyed.count()
    drawn = keyed.select("key").sample(min(1.0, ranges * KEYS_PER_RANGE / max(total, 1)), seed=7).limit(2 * ranges * KEYS_PER_RANGE).collect() if ranges > 1 else []
    keys = sorted(r[0] for r in drawn)
    cuts = np.array(sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)} if keys else set()), dtype=object)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(dtype=object), side="right").astype(np.int32))

    @F.pandas_udf("int")
    def range_end(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(dtype=object) + "\U0010ffff", side="right").astype(np.int32))

    rule_keys = rules.select(lowered(F.coalesce("host", F.lit(""))).alias("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict").alias("verdict")).where("host <> ''")
    rule_keys = rule_keys.withColumn("rhost", reversed_host(F.col("host"))).distinct()
    sent = rule_keys.withColumn("r", F.explode(F.sequence(range_of("rhost"), range_end("rhost"))))
    rows = keyed.select(range_of("key").alias("r"), "key", F.lit(1).alias("kind"), "page_id", "host", "path", F.lit(None).cast("string").alias("verdict")).unionByName(
        sent.select("r", F.col("rhost").alias("key"), F.lit(0).alias("kind"), F.lit(None).cast(keyed.schema["page_id"].dataType).alias("page_id"), "host", "path", "verdict")
    )
    swept = rows.repartition(ranges, "r").sortWithinPartitions("r", "key", "kind").select("r", "key", "kind", "page_id", "host", "path", "verdict")
    kind = keyed.schema["page_id"].dataType.simpleString()

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, str, dict[str, str], list[int]]] = []  # reversed host, host, verdicts by path, lengths of paths
        at = None
        for batch in batches:
            keep, found, verdicts = [], [], []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5, 6)]
            for i, (r, key, what, host, path, verdict) in enumerate(zip(*columns, strict=True)):
                if r != at:
                    stack, at = [], r
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if what == 0:
                    if not stack or stack[-1][0] != key:
                        stack.append((key, host, {}, []))
                    _, _, paths, lengths = stack[-1]
                    paths[path] = min(verdict, paths.get(path, verdict))
                    if len(path) not in lengths:
                        bisect.insort(lengths, len(path), key=lambda x: -x)
                    continue
                best = None
                for _, rule_host, paths, lengths in stack:
                    for length in lengths:
                        if length <= len(path) and path[:length] in paths:
                            score = (len(rule_host) + length, len(rule_host))
                            if best is None or score > best[0]:
                                best = (score, rule_host + path[:length], paths[path[:length]])
                            break
                keep.append(i)
                found.append(best[1] if best else None)
                verdicts.append(best[2] if best else default)
            part = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(3), part.column(4), part.column(5), pa.array(found, pa.string()), pa.array(verdicts, pa.string())], names=["page_id", "host", "path", "rule", "verdict"])

    return swept.mapInArrow(kernel, f"page_id {kind}, host string, path string, rule string, verdict string")
