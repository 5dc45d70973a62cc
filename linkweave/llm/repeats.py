"""Repeated passages by longest-previous-factor arrays.

A passage repeats if a string of ``length`` bytes starts at two places. To find
all of them without a suffix array of the whole corpus, every string is named
by an anchor: of the eight-byte grams that start early enough in it, the one
with the smallest hash, leftmost of equals. Equal strings have equal anchors at equal
distances, so the strings that an anchor stands for can only repeat at the
same anchor's other places. Anchors, told apart by the ``key`` bytes from the
anchor on, that occur once are done with. For the others the bytes around each place
are gathered by anchor, and there a suffix array (prefix doubling) puts
the strings in order. In it the previous and the next smaller position of each
string give its longest previous factor; where that has ``length`` bytes or
more, the string repeats an earlier one.

Texts that are equal as a whole take part once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import partitions, raw_texts, slices, spread_join, written

GRAM = 8
#: Bytes from an anchor on that tell anchors apart.
KEY = 64
#: Places of one anchor that a task sorts together; strings of anchors with more are counted as rows.
MOST_PLACES = 20_000
#: Bytes that one suffix sort takes, whole anchors together; an anchor with more than twice KERNEL_BYTES is ordered by digests.
SORT_BYTES, KERNEL_BYTES = 1 << 18, 4 << 20


def anchors(body: np.ndarray, offsets: np.ndarray, length: int, key: int = KEY) -> np.ndarray:
    """Rows of (text, first, last, anchor): strings of ``length`` bytes that start at first..last have that anchor.

    Texts lie end to end in ``body``, of fewer than 2 ** 32 bytes; positions are inside the text.
    """
    width = length - key + 1
    out = []
    n = len(body)
    if n < length:
        return np.zeros((0, 4), np.int64)
    padded = np.concatenate([body, np.zeros(GRAM, np.uint8)])
    grams = np.zeros(n, np.uint64)
    for i in range(GRAM):
        grams |= padded[i : i + n].astype(np.uint64) << np.uint64(8 * i)
    grams *= np.uint64(0x9E3779B97F4A7C15)
    grams ^= grams >> np.uint64(32)
    grams *= np.uint64(0xD6E8FEB86659FD93)
    bits = 32
    order = ((grams >> np.uint64(bits)) << np.uint64(bits)) | np.arange(n, dtype=np.uint64)
    del grams, padded
    # Sliding minimum over `width` places: within blocks from the left and from the right.
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = order
    grid = full.reshape(blocks, width)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = n - width + 1
    least = np.minimum(right[:starts], left[width - 1 : width - 1 + starts])
    place = (least & np.uint64((1 << bits) - 1)).astype(np.int64)
    change = np.flatnonzero(place[1:] != place[:-1]) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change - 1, [starts - 1]])
    # Cut the runs at the texts' bounds and leave out strings that cross one.
    text = np.searchsorted(offsets, first, side="right") - 1
    text_last = np.searchsorted(offsets, last, side="right") - 1
    for i in range(int((text_last - text).max(initial=0)) + 1):
        t = text + i
        ok = t <= text_last
        t = np.minimum(t, len(offsets) - 2)
        lo = np.maximum(first, offsets[t])
        hi = np.minimum(last, offsets[t + 1] - length)
        ok &= lo <= hi
        out.append(np.column_stack([t, lo - offsets[t], hi - offsets[t], place[first] - offsets[t]])[ok])
    rows = np.concatenate(out)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def suffix_order(body: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The class of the ``length``-byte string at each of ``starts``, equal for equal strings, in suffix order.

    Prefixes grow two- or threefold with each sort. What follows the end of
    ``body`` reads as empty; no string of ``starts`` reaches that far.
    """
    n = len(body)
    padded = np.concatenate([body, np.zeros(GRAM, np.uint8)])
    value = np.zeros(n, np.uint64)
    for i in range(GRAM):
        value |= padded[i : i + n].astype(np.uint64) << np.uint64(8 * (GRAM - 1 - i))
    _, rank = np.unique(value, return_inverse=True)
    rank, size = rank.astype(np.int64), GRAM
    while size < length:
        top = int(rank.max(initial=0)) + 2
        parts = 3 if 2 * size < length and top**3 < 1 << 63 else 2
        after = np.concatenate([rank + 1, np.zeros(length, np.int64)])
        last = parts * size >= length
        at = starts if last else np.arange(n)
        key = rank[at]
        for k in range(1, parts):
            key = key * top + after[at + min(k * size, length - size)]
        _, rank = np.unique(key, return_inverse=True)
        size = parts * size
    return rank if size > GRAM else rank[starts]


def digest_order(body: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Classes as ``suffix_order`` gives them, in order of 128-bit digests, in far less memory."""
    raw = body.tobytes()
    digest = xxhash.xxh3_128_digest
    names = np.frombuffer(b"".join(digest(raw[i : i + length]) for i in starts.tolist()), dtype="V16")
    return np.unique(names, return_inverse=True)[1]


def longest_factors(places: np.ndarray, common: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the longest previous factors of suffixes, and the place of such an earlier match; 0 and -1 where under ``least``.

    ``places`` are positions in suffix order, ``common[i]`` how long a prefix
    entry i shares with the entry before it. A longest previous factor lies at
    the previous or the next smaller position in suffix order, and is as long
    as the least of ``common`` on the way there. Both are found for all
    suffixes at once: each looks at its neighbour's own nearest smaller
    position while it stands on a larger one, and stops when the way has
    fallen below ``least``.
    """
    n = len(places)
    longest, match = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for step in (-1, 1):
        at = np.arange(n) + step
        way = common.astype(np.int64) if step < 0 else np.append(common[1:], 0).astype(np.int64)
        way[0 if step < 0 else n - 1 :][:1] = 0
        live = np.flatnonzero(way >= least)
        while len(live):
            on = at[live]
            found = live[places[on] < places[live]]
            better = found[way[found] > longest[found]]
            longest[better], match[better] = way[better], places[at[better]]
            live = live[places[on] >= places[live]]
            on = at[live]
            way[live], at[live] = np.minimum(way[live], way[on]), at[on]
            live = live[way[live] >= least]
    return longest, match


def repeated_starts(rank: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ``starts``, ascending positions, whether the string there also starts earlier, and whether it starts later.

    Suffixes are ordered by their first ``length`` bytes (``rank``, the class
    of each), then by position, so common prefixes count as ``length`` or as less; the factors of
    the mirrored positions are those that come later.
    """
    order = np.lexsort((starts, rank))
    same = rank[order][1:] == rank[order][:-1]
    common = np.concatenate([[0], np.where(same, length, 0)])[: len(starts)]
    earlier, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    earlier[order] = longest_factors(starts[order], common, length)[0] >= length
    later[order] = longest_factors(-starts[order], common, length)[0] >= length
    return earlier, later


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Union of [s, s + length) over ascending starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    lows = starts[np.concatenate([[0], cut])]
    highs = starts[np.concatenate([cut - 1, [len(starts) - 1]])] + length
    return list(zip(lows.tolist(), highs.tolist(), strict=True))


_PLACES = "key long, text_key string, first int, around binary, strings int"


def text_table(documents: DataFrame, length: int, key: int = KEY) -> DataFrame:
    """A row for each document: doc_id, text_key, n_bytes, its digest, and the keys of its anchors (a text's first row in a task has them)."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 18):
                body, offsets = raw_texts(batch.column(2))
                rows = anchors(body, offsets, length, key)
                keys: list[list[int]] = [[] for _ in range(batch.num_rows)]
                raw = body.tobytes()
                base = offsets.tolist()
                for text, place in zip(rows[:, 0].tolist(), rows[:, 3].tolist(), strict=True):
                    at = base[text] + place
                    keys[text].append(xxhash.xxh3_64_intdigest(raw[at : at + key]))
                flat = np.array([k for row in keys for k in row], dtype=np.uint64).view(np.int64)
                ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.diff(offsets)), batch.column(3), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["doc_id", "text_key", "n_bytes", "sha", "keys"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_key"), text.alias("text"), F.sha2(text, 256).alias("sha"))
    return rows.mapInArrow(kernel, "doc_id long, text_key string, n_bytes long, sha string, keys array<long>")


def repeated_runs(documents: DataFrame, length: int = 400, keep_first: bool = False, key: int = KEY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, copies, runs).

    ``rows``: doc_id, text_key, n_bytes, sha of each document; ``copies``:
    text_key and how many rows have that text; ``runs``: text_key and an array of
    (lo, hi), maximal byte runs that repeated strings cover, for texts with any. With
    ``keep_first`` the first occurrence, by text_key and position, isn't covered.
    """
    spark = documents.sparkSession
    rows = written(text_table(documents, length, key), "texts")
    first_row = F.expr("min(IF(doc_id IS NULL, NULL, doc_id))")
    copies = written(rows.groupBy("text_key").agg(F.count("*").alias("n_rows"), first_row.alias("rep"), F.first("keys").alias("keys")), "copies")
    pairs = copies.select("text_key", "rep", F.explode("keys").alias("key"))
    shared = written(pairs.groupBy("key").count().where("count > 1"), "shared-anchors")
    wanted = written(pairs.distinct().join(shared, "key").groupBy("text_key", "rep").agg(F.collect_list("key").alias("wanted")), "wanted")

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_key"), text.alias("text"))
    right = wanted.withColumnsRenamed({"text_key": "t", "rep": "r"})
    held = docs.join(right, (F.col("text_key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("r"))).select("text_key", "wanted", "text")
    places = written(_gathered(held, length, key), "places")
    counts = places.groupBy("key").count().where(F.col("count") > MOST_PLACES)
    hot = written(counts.select("key"), "hot-anchors")
    found = _sorted_cells(places.join(hot, "key", "left_anti") if not hot.isEmpty() else places, length, keep_first, partitions(documents))
    if not hot.isEmpty():
        found = found.unionByName(_by_digest(places.join(hot, "key"), length, keep_first))
    merged = found.groupBy("text_key").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("runs"))
    return rows.drop("keys"), copies.select("text_key", "n_rows", "rep"), written(merged, "runs")


def _gathered(held: DataFrame, length: int, key: int) -> DataFrame:
    """The bytes around each place of a wanted anchor: key, text_key, first, around, strings."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 18):
                body, offsets = raw_texts(batch.column(2))
                rows = anchors(body, offsets, length, key)
                raw, base = body.tobytes(), offsets.tolist()
                names = batch.column(0).to_pylist()
                wanted = [set(x) for x in batch.column(1).to_pylist()]
                out: list[tuple] = []
                for text, first, last, place in rows.tolist():
                    at = base[text]
                    k = xxhash.xxh3_64_intdigest(raw[at + place : at + place + key])
                    k = k - (1 << 64) if k >> 63 else k
                    if k in wanted[text]:
                        out.append((k, names[text], first, raw[at + first : at + last + length], last - first + 1, place - first))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "text_key", "first", "around", "strings", "anchor"])

    return held.mapInArrow(kernel, _PLACES + ", anchor int")


def _sorted_cells(places: DataFrame, length: int, keep_first: bool, parts: int) -> DataFrame:
    """(text_key, lo, hi) from a suffix array over the places of whole anchors."""

    def solve(cells: list[list[tuple]]) -> list[tuple[str, int, int]]:
        out: list[tuple[str, int, int]] = []
        groups, owners = [], []
        for cell in cells:
            unique = sorted(set(cell))  # a text's copies may be there twice
            by_bytes: dict[tuple, list[tuple]] = {}
            for place in unique:
                by_bytes.setdefault((place[2], place[4]), []).append(place)
            if len(by_bytes) == 1 and not keep_first:
                if len(unique) > 1:
                    out.extend((t, f, f + n - 1 + length) for t, f, _, n, _ in unique)
                continue
            groups.append(list(by_bytes.values()))
        if not groups:
            return out
        # Equal strings have equal anchors, so strings of different cells differ by themselves.
        blobs, at, size = [], [], 0
        for group in groups:
            for same in group:
                owners.append(same)
                at.append(size)
                blobs.append(same[0][2])
                size += len(same[0][2])
        body = np.frombuffer(b"".join(blobs), np.uint8)
        n_strings = np.array([same[0][3] for same in owners])
        starts = np.concatenate([np.arange(a, a + n) for a, n in zip(at, n_strings.tolist(), strict=True)])
        rank = suffix_order(body, starts, length) if len(body) <= 2 * KERNEL_BYTES else digest_order(body, starts, length)
        before, after = repeated_starts(rank, starts, length)
        edge = np.concatenate([[0], np.cumsum(n_strings)])
        for i, same in enumerate(owners):
            earlier, later = before[edge[i] : edge[i + 1]], after[edge[i] : edge[i + 1]]
            for j, (text, first, _, n, _) in enumerate(same):
                if keep_first:
                    hit = earlier | (j > 0)
                else:
                    hit = earlier | later | (len(same) > 1)
                out.extend((text, lo, hi) for lo, hi in _runs(np.flatnonzero(hit) + first, length))
        return out

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: list[list[tuple]] = []
        last, size = None, 0

        def batch_of(rows: list[tuple[str, int, int]]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32())], names=["text_key", "lo", "hi"])

        for whole in batches:
            for batch in slices(whole, "around"):
                for k, *place in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                    if k != last:
                        if cells and (size > SORT_BYTES or len(cells[-1]) > 1000):
                            yield batch_of(solve(cells))
                            cells, size = [], 0
                        cells.append([])
                        last = k
                    cells[-1].append(tuple(place))
                    size += len(place[2])
        if cells:
            yield batch_of(solve(cells))

    dealt = places.repartition(parts, "key").sortWithinPartitions("key").select("key", "text_key", "first", "around", "strings", "anchor")
    return dealt.mapInArrow(kernel, "text_key string, lo int, hi int")


def _by_digest(places: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """(text_key, lo, hi) for anchors with very many places: each string's digest is counted, so no task holds an anchor's places."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "around", 1 << 19):
                texts, at, names = [], [], []
                for text, first, around, strings in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                    for i in range(strings):
                        names.append(xxhash.xxh3_128_digest(around[i : i + length]))
                    texts.extend([text] * strings)
                    at.extend(range(first, first + strings))
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(at, pa.int32()), pa.array(names, pa.binary())], names=["text_key", "at", "name"])

    once = places.dropDuplicates(["text_key", "first"])  # a text's copies may be there twice
    strings = written(once.select("text_key", "first", "around", "strings").mapInArrow(digests, "text_key string, at int, name binary"), "digests")
    # A string may be as frequent as there are documents: its places are counted by a salt, and meet the sums by salt.
    salted = strings.withColumn("salt", F.pmod(F.xxhash64("text_key", "at"), F.lit(partitions(places))))
    first = F.min(F.struct("text_key", "at")).alias("first")
    parts = written(salted.groupBy("name", "salt").agg(F.count("*").alias("n"), first), "digest-counts")
    repeated = parts.groupBy("name").agg(F.sum("n").alias("n"), F.min("first").alias("first")).where("n > 1").drop("n")
    hit = salted.join(parts.select("name", "salt").join(repeated, "name"), ["name", "salt"])
    if keep_first:
        hit = hit.where((F.col("text_key") != F.col("first.text_key")) | (F.col("at") != F.col("first.at")))
    return hit.select("text_key", F.col("at").alias("lo"), (F.col("at") + length).alias("hi"))


def removed(documents: DataFrame, length: int = 400, keep_first: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and text_key.

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else (with ``keep_first``: earlier, by text and position). Null
    texts are empty. Of rows with equal texts of ``length`` bytes or more all
    bytes go; shorter texts stay whole. Empty tables give no rows.
    """
    rows, copies, runs = repeated_runs(documents, length, keep_first)
    alone = copies.where("n_rows = 1" if not keep_first else "true").join(runs, "text_key").select(F.col("text_key").alias("t"), F.col("rep").alias("r"), "runs")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(text).alias("text_key"), text.alias("text"))
    held = docs.join(alone, (F.col("text_key") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("r"))).select("text_key", "runs", "text")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for whole in batches:
            for batch in slices(whole, "text"):
                body, offsets = raw_texts(batch.column(2))
                out: list[tuple] = []
                for i, (name, spans) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                    own = body[offsets[i] : offsets[i + 1]]
                    gone = np.zeros(len(own) + 1, np.int32)
                    for span in spans:
                        gone[span["lo"]] += 1
                        gone[span["hi"]] -= 1
                    gone = np.cumsum(gone)[:-1] > 0
                    n_spans = int(np.count_nonzero(gone & ~np.concatenate([[False], gone[:-1]])))
                    out.append((name, int(gone.sum()), n_spans, hashlib.sha256(own[~gone].tobytes()).hexdigest()))
                columns = list(zip(*out, strict=True)) or [()] * 4
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["t", "cut", "spans", "kept"])

    parts = held.mapInArrow(kernel, "t string, cut long, spans long, kept string").dropDuplicates(["t"])
    many = copies.select(F.col("text_key").alias("m"), (F.col("n_rows") > 1).alias("many"))
    whole = F.col("many") & (F.col("n_bytes") >= length)
    found = many.join(parts, F.col("m") == F.col("t"), "left").select(F.col("m").alias("text_key"), "many", "cut", "spans", "kept")
    joined = spread_join(rows, found, "text_key", ("doc_id",), partitions(documents))
    if keep_first:
        keeper = rows.groupBy("text_key").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("k")).select("text_key", F.col("k.doc_id").alias("keeper"))
        joined = spread_join(joined, keeper, "text_key", ("doc_id",), partitions(documents))
        whole = whole & ~F.col("doc_id").eqNullSafe(F.col("keeper"))
    empty = F.sha2(F.lit(""), 256)
    return joined.select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("cut", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, empty).otherwise(F.coalesce("kept", F.col("sha"))).alias("kept_sha256"), "text_key",
    )
