"""SimHash document fingerprints and the search of near ones by permuted block tables.

A document's terms are its blank-separated words, A-Z lower-cased. Each term's
64-bit hash votes on 64 signed counters with weight ``16 * (1 + ln(count))``,
rounded to an integer; a fingerprint bit is 1 where the counter is positive.
Equal texts get equal fingerprints; a text without words (null, empty) gets 0.

``near_fingerprints`` finds every pair within a Hamming radius: 64 bits are cut
into blocks, and for each choice of ``radius`` blocks that may differ one table
is keyed by the bits of all others, so that two fingerprints within the radius
share a key in at least one table.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import hex64, partitions, slices, spread_join, written

#: Rows of one table key that a single task compares; larger groups are cut into tiles.
MOST_IN_GROUP = 16_384
_HASHES: dict[bytes, int] = {}
_WEIGHTS = np.array([0] + [round(16 * (1 + log(c))) for c in range(1, 4096)], dtype=np.float64)


def _term_hash(word: bytes) -> int:
    found = _HASHES.get(word)
    if found is None:
        if len(_HASHES) > 400_000:  # keeps a worker's memory bounded
            _HASHES.clear()
        found = _HASHES[word] = xxhash.xxh3_64_intdigest(word)
    return found


def simhash(raw: bytes) -> int:
    """Fingerprint of one UTF-8 text, unsigned."""
    terms = Counter(raw.lower().split())
    if not terms:
        return 0
    hashes = np.fromiter(map(_term_hash, terms), dtype=">u8", count=len(terms))
    counts = np.fromiter(terms.values(), dtype=np.int64, count=len(terms))
    if counts.max() < 4096:
        weights = _WEIGHTS[counts]
    else:
        weights = np.rint(16 * (1 + np.log(counts)))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    votes = 2 * (weights @ bits) - weights.sum()
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def with_fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with a signed 64-bit fingerprint column; a column of that name in ``df`` is replaced."""

    @F.pandas_udf("long")
    def of(texts):
        found = np.fromiter((simhash((x or "").encode()) for x in texts), dtype=np.uint64, count=len(texts))
        return __import__("pandas").Series(found.view(np.int64))

    return df.withColumn(out, of(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def edited_with_next(df: DataFrame) -> DataFrame:
    """Fingerprints of each text, of its edited text and of the next document.

    ``df`` has doc_id and text. The next document is the one before it by
    doc_id (null ids come last; rows of one id in order of their text's hash, then text); the
    last one's next is the first. The edited text is the text with its last
    third (rounded down) of code points replaced by as many first ones of the
    next text, or all of a shorter one.

    Rows are dealt into ranges of doc_id, and the first row of each range also
    goes to the range before it, so a text is shuffled once.
    """
    lowest = -(1 << 63)
    rows = df.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("k"),
    )
    parts = partitions(df)
    ids = rows.select("k")
    cuts = ids.approxQuantile("k", [i / (4 * parts) for i in range(1, 4 * parts)], 0.0005)
    bounds = np.unique(np.array(cuts, dtype=np.float64)).astype(np.int64)

    @F.pandas_udf("int")
    def bucket_of(k):
        return __import__("pandas").Series(np.searchsorted(bounds, k.to_numpy(), side="right").astype(np.int32))

    # One row for each range, of which there are four times the shuffle partitions at most.
    heads = sorted((r[1], r[0]) for r in ids.groupBy(bucket_of("k").alias("b")).agg(F.max("k")).collect())
    head_keys = np.array([h[0] for h in heads], dtype=np.int64)
    targets = np.array([h[1] for h in heads[1:] + heads[:1]], dtype=np.int32)

    @F.pandas_udf("int")
    def halo_of(k):
        values = k.to_numpy()
        at = np.minimum(np.searchsorted(head_keys, values), len(head_keys) - 1)
        return __import__("pandas").Series(np.where(head_keys[at] == values, targets[at], -1).astype(np.int32))

    dealt = (
        rows.withColumn("b", bucket_of("k"))
        .withColumn("halo", halo_of("k") if len(heads) else F.lit(-1))
        .select("doc_id", "text", "k", F.explode(F.expr("IF(halo < 0, array(named_struct('b', b, 'extra', 0)), array(named_struct('b', b, 'extra', 0), named_struct('b', halo, 'extra', 1)))")).alias("to"))
        .select("to.b", "to.extra", "k", "doc_id", "text")
        .repartition(parts, "b")
        .withColumn("h", F.xxhash64("text"))
        .sortWithinPartitions("b", "extra", F.desc("k"), F.desc("h"), F.desc("text"))
        .select("b", "extra", "doc_id", "text")
    )
    return dealt.mapInArrow(_edit, _EDITED)


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fp long, edited_fp long, next_fp long"


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    last = None  # the bucket, doc_id, text and fingerprint of the row whose next is awaited

    def pair(row, text, fp):
        _, doc_id, own, own_fp = row
        k = len(own) // 3
        raw = (own[: len(own) - k] + text[:k]).encode()
        out.append((doc_id, len(own), hashlib.sha256(raw).hexdigest(), own_fp, simhash(raw), fp))

    def flush():
        columns = list(zip(*out, strict=True))
        out.clear()
        signed = [pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in columns[3:]]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string()), *signed],
            names=["doc_id", "n_chars", "edited_sha256", "fp", "edited_fp", "next_fp"],
        )

    for whole in batches:
        for batch in slices(whole, "text"):
            for b, extra, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if extra and (last is None or last[0] != b):
                    continue  # a second row tied with the first of the next range
                fp = simhash(text.encode())
                if last is not None and last[0] == b:
                    pair(last, text, fp)
                last = None if extra else (b, doc_id, text, fp)
            if len(out) > 2000:
                yield flush()
    if out:
        yield flush()


def block_masks(rows: int, radius: int) -> list[int]:
    """Masks of the block tables: the fewest blocks whose table keys outnumber the rows."""
    for blocks in range(radius + 1, 17):
        edges = [round(64 * i / blocks) for i in range(blocks + 1)]
        kept = blocks - radius
        if 64 * kept / blocks >= log(max(rows, 2), 2) or comb(blocks + 1, radius) > 60:
            break
    parts = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [sum(c) for c in combinations(parts, kept)]


def near_fingerprints(fps: DataFrame, radius: int = 3, column: str = "fp", pairs: bool = False) -> DataFrame:
    """All fingerprints within ``radius`` bits of another one.

    ``fps`` has a signed 64-bit ``column``; null is left out and repeats count
    once. Returns (fp, n_links), a row for each fingerprint with a link; with
    ``pairs`` (a, b), a row for each link, a < b. A table key that many
    fingerprints share is cut into tiles, and each pair of tiles is compared in
    a task of its own: nothing is capped. A pair is counted in the first table
    that holds it.
    """
    unique = written(fps.where(F.col(column).isNotNull()).select(F.col(column).alias("fp")).distinct(), "fps")
    masks = block_masks(unique.count(), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    keyed = unique.select("fp", F.explode(tables).alias("x")).select("x.t", "x.key", "fp")
    sizes = keyed.groupBy("t", "key").count().where(F.col("count") > 1)
    hot = written(sizes.where(F.col("count") > MOST_IN_GROUP), "hot-keys")
    if hot.isEmpty():
        cells = keyed.withColumns({"i": F.lit(0), "j": F.lit(0), "own": F.lit(0)})
    else:
        cut = keyed.join(hot, ["t", "key"], "left").withColumn("s", F.coalesce(F.ceil(F.col("count") * 2 / MOST_IN_GROUP), F.lit(1)).cast("int"))
        cut = cut.withColumn("own", F.expr("CAST(pmod(xxhash64(fp), s) AS INT)"))
        cells = cut.select("t", "key", "fp", "own", F.explode(F.expr("sequence(0, s - 1)")).alias("o")).select(
            "t", "key", "fp", "own", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j")
        )
    sorted_cells = cells.repartition(partitions(fps), "t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j").select("t", "key", "i", "j", "own", "fp")
    every = np.array(masks, dtype=np.uint64)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def compare(block: np.ndarray):
            # Rows of one cell stand together; row x meets row x + d for every distance d inside its cell.
            new = np.any(block[1:, :4] != block[:-1, :4], axis=1)
            cell = np.concatenate([[0], np.cumsum(new)])
            fp, own, table = block[:, 5].view(np.uint64), block[:, 4], block[:, 0]
            across = block[:, 2] != block[:, 3]
            live = np.arange(len(block) - 1)
            d, left, right = 1, [], []
            while len(live):
                live = live[live + d < len(block)]
                live = live[cell[live] == cell[live + d]]
                far = fp[live] ^ fp[live + d]
                ok = np.bitwise_count(far) <= radius
                ok &= ~across[live] | (own[live] != own[live + d])
                for x in np.flatnonzero(ok):
                    t = int(table[live[x]])
                    if not t or not np.any((every[:t] & far[x]) == 0):
                        left.append(live[x])
                        right.append(live[x] + d)
                d += 1
            a, b = fp[np.array(left, dtype=np.int64)].view(np.int64), fp[np.array(right, dtype=np.int64)].view(np.int64)
            if pairs:
                return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
            value, count = np.unique(np.concatenate([a, b]), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(value), pa.array(count.astype(np.int64))], names=["fp", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)]))
            if sum(map(len, held)) > 100_000:
                block = np.concatenate(held)
                same = np.all(block[:, :4] == block[-1, :4], axis=1)
                cut_at = len(block) - int(same[::-1].argmin()) if not same.all() else 0
                held = [block[cut_at:]]
                if cut_at:
                    yield compare(block[:cut_at])
        if held and sum(map(len, held)):
            yield compare(np.concatenate(held))

    if pairs:
        return sorted_cells.mapInArrow(kernel, "a long, b long")
    return sorted_cells.mapInArrow(kernel, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n_links"))


def fingerprint_report(documents: DataFrame, radius: int = 3) -> DataFrame:
    """One row for each document: fingerprints, likenesses, class of equal fingerprints and number of near classes.

    Null texts are empty and have fingerprint 0. Repeated rows stand next to
    each other in the order of the next documents. A single row is its own next
    document; an empty table gives no rows. Columns other than doc_id and text
    don't matter.
    """
    rows = written(edited_with_next(documents), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("class_id"))
    links = near_fingerprints(rows.select("fp"), radius)
    found = classes.join(links, "fp", "left")
    like = lambda a, b: F.lit(1.0) - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / F.lit(64.0)
    text16 = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return spread_join(rows, found, "fp", ("doc_id", "edited_sha256"), partitions(documents)).select(
        "doc_id", "n_chars", "edited_sha256",
        text16("fp").alias("fingerprint"), text16("edited_fp").alias("edited_fingerprint"),
        like("fp", "edited_fp").alias("near_edited"), like("fp", "next_fp").alias("near_next"),
        "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


__all__ = ["block_masks", "edited_with_next", "fingerprint_report", "hex64", "near_fingerprints", "simhash", "with_fingerprints"]
