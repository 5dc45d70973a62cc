"""Benchmark decontamination by a prefix-filtered set join.

An item's windows are its runs of ``window`` words; an item of fewer words, but
not none, is one window. A window occurs in a document only if all of its
shingles do, so one of them, the rarest in the corpus, is a necessary prefix.
Documents are probed for prefix shingles; a hit at a word position fixes where
the window would have to start, which must lie inside the document
(positional and length bounds), and the document's words there must equal the
window's (exact containment).

Benchmark tables may be of any size: a bit table of fixed size, built from the
prefix shingles, is all that is sent to the tasks. Its false hits are dropped
by the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import numbered, raw_texts, slices, written

#: Bits of the probe table: 2 MB whatever the benchmark's size.
PROBE_BITS = 24
_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_TO_SPACE = bytes(0x20 if i in _SEPARATORS and not 0x41 <= i <= 0x5A else (i + 32 if 0x41 <= i <= 0x5A else i) for i in range(256))
_MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)
#: A word's hash is the sum of its bytes' values times powers of BASE, whose inverse modulo 2 ** 64 takes off where it starts.
_BASE, _SEGMENT = 0x9E3779B97F4A7C15, 1 << 20
_TABLE = np.frombuffer(_TO_SPACE, np.uint8)
_VALUES = np.frombuffer(b"".join(xxhash.xxh3_64_digest(bytes([i])) for i in range(256)), np.uint64).copy()
_POWERS: dict[str, np.ndarray] = {}


def words_of(raw: bytes) -> list[bytes]:
    """Runs of digits, letters a-z and code points from U+0080 on, after A-Z is lower-cased."""
    return raw.translate(_TO_SPACE).split()


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n - 1 at least."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


class Words:
    """The words of texts that lie end to end: where each starts and ends, its hash, and the first word of each text (n + 1 places)."""

    def __init__(self, body: np.ndarray, offsets: np.ndarray):
        self.lowered = _TABLE[body]
        inside = self.lowered != 0x20
        before = np.concatenate([[False], inside])[:-1]
        after = np.concatenate([inside, [False]])[1:]
        bounds = offsets[(offsets > 0) & (offsets < len(body))]
        before[bounds] = False  # no word crosses from one text to the next
        after[bounds - 1] = False
        self.starts, self.ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = np.zeros(len(self.starts), np.uint64)
        lo = 0
        while lo < len(self.starts):  # words that end within a segment, or one longer word
            at = self.starts[lo]
            hi = max(lo + 1, int(np.searchsorted(self.ends, at + _SEGMENT, side="right")))
            part = self.lowered[at : self.ends[hi - 1]]
            up, down = _powers(max(len(part), _SEGMENT))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[part] * up[: len(part)], dtype=np.uint64)])
            a, z = self.starts[lo:hi] - at, self.ends[lo:hi] - at
            self.hashes[lo:hi] = (sums[z] - sums[a]) * down[a]
            lo = hi
        self.hashes ^= self.hashes >> np.uint64(31)
        self.hashes *= np.uint64(0xD6E8FEB86659FD93)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The word at which each run of ``size`` words of one text starts, and the run's signed 64-bit hash."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        total = np.zeros(n, np.uint64)
        for i in range(size):
            total += self.hashes[i : i + n] * np.uint64(_MIX[i % len(_MIX)] + 2 * (i // len(_MIX)))
        total ^= total >> np.uint64(29)
        owner = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        at = np.flatnonzero(owner[:n] == owner[size - 1 :])
        return at, (total * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)[at]

    def phrase(self, lo: int, hi: int) -> str:
        """Words lo to hi - 1, space-joined."""
        return b" ".join(self.lowered[a:z].tobytes() for a, z in zip(self.starts[lo:hi].tolist(), self.ends[lo:hi].tolist(), strict=True)).decode()


def item_windows(benchmark: DataFrame, window: int, shingle: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, phrase, w, size, shingles): the distinct windows of each item.

    ``size`` is the shingle size, smaller for windows of fewer words.
    """
    source = benchmark.select(F.col(item).cast("string").alias("item"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                out: list[tuple] = []
                body, offsets = raw_texts(batch.column(1))
                for i, name in enumerate(batch.column(0).to_pylist()):
                    own = body[offsets[i] : offsets[i + 1]]
                    words = Words(own, np.array([0, len(own)]))
                    n = len(words.starts)
                    w = min(window, n)
                    size = min(shingle, w)
                    ids = words.shingles(size)[1].tolist() if w else []
                    for k in range(n - w + 1 if w else 0):
                        out.append((name, words.phrase(k, k + w), w, size, ids[k : k + w - size + 1]))
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item", "phrase", "w", "size", "shingles"])

    return source.mapInArrow(kernel, "item string, phrase string, w int, size int, shingles array<long>").distinct()


def _bit_table(ids: DataFrame) -> np.ndarray:
    """2 ** PROBE_BITS bits, set where a ``shingle`` hashes to; the rows collected are bounded by the table's words."""
    slot = f"shiftrightunsigned(shingle, {64 - PROBE_BITS})"
    words = ids.select(F.expr(f"shiftright({slot}, 6)").alias("at"), F.expr(f"shiftleft(1L, CAST({slot} & 63 AS INT))").alias("bit"))
    table = np.zeros(1 << (PROBE_BITS - 6), np.int64)
    for at, bits in words.groupBy("at").agg(F.bit_or("bit")).toLocalIterator():
        table[at] = bits
    return table.view(np.uint64)


def _in_table(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    slot = ids.view(np.uint64) >> np.uint64(64 - PROBE_BITS)
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def text_key(text: str = "text"):
    """A digest that stands for the whole text."""
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))


def shingle_counts(documents: DataFrame, wanted: DataFrame, sizes: list[int], text: str = "text") -> DataFrame:
    """(size, shingle, n): how often the corpus holds each wanted (size, shingle), all documents counted."""
    spark = documents.sparkSession
    tables = {s: spark.sparkContext.broadcast(_bit_table(wanted.where(F.col("size") == s))) for s in sizes}

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                body, offsets = raw_texts(batch.column(0))
                words = Words(body, offsets)
                for s, table in tables.items():
                    ids = words.shingles(s)[1]
                    value, count = np.unique(ids[_in_table(table.value, ids)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), s, np.int32)), pa.array(value), pa.array(count.astype(np.int64))], names=["size", "shingle", "n"])

    got = documents.select(F.col(text).cast("string").alias("text")).mapInArrow(kernel, "size int, shingle long, n long")
    return got.groupBy("size", "shingle").agg(F.sum("n").alias("n"))


def probe(documents: DataFrame, prefixes: DataFrame, sizes: list[int], window: int, text: str = "text") -> DataFrame:
    """A row for each document: doc_id, text_key, n_words and hits, the places of prefix shingles with the words around."""
    spark = documents.sparkSession
    tables = {s: spark.sparkContext.broadcast(_bit_table(prefixes.where(F.col("size") == s))) for s in sizes}
    hit = pa.struct([("size", pa.int32()), ("shingle", pa.int64()), ("at", pa.int32()), ("lo", pa.int32()), ("around", pa.string())])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 1 << 20):
                body, offsets = raw_texts(batch.column(2))
                words = Words(body, offsets)
                n_words = np.diff(words.first)
                hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
                for s, table in tables.items():
                    places, ids = words.shingles(s)
                    found = np.flatnonzero(_in_table(table.value, ids))
                    owner = np.searchsorted(words.first, places[found], side="right") - 1
                    for k, doc in zip(found.tolist(), owner.tolist(), strict=True):
                        start, end = int(words.first[doc]), int(words.first[doc + 1])
                        at = int(places[k])
                        lo = max(start, at + s - window)
                        hits[doc].append({"size": s, "shingle": int(ids[k]), "at": at - start, "lo": lo - start, "around": words.phrase(lo, min(end, at + window))})
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), pa.array(hits, pa.list_(hit))], names=["doc_id", "text_key", "n_words", "hits"])

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(kernel, "doc_id long, text_key string, n_words long, hits array<struct<size:int,shingle:long,at:int,lo:int,around:string>>")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """One row for each document with the benchmark windows in it.

    Returns doc_id, text_key, n_words, n_hit (words inside any occurrence of a
    window), n_items and items (ids of items with occurring windows, sorted as
    strings). Null and empty texts have no words; items without words never
    occur; items with null ids count as no item, but their windows hit.
    Documents without a hit have 0, 0 and an empty array; repeated rows have
    the same result each.
    """
    windows = written(item_windows(benchmark, window, shingle), "windows")
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())
    phrases = windows.select("phrase", "w", "size", "shingles").distinct()
    offered = phrases.select("phrase", "w", "size", F.posexplode("shingles").alias("offset", "shingle"))
    counts = shingle_counts(documents, offered.select("size", "shingle").distinct(), sizes)
    ranked = offered.join(counts, ["size", "shingle"], "left").groupBy("phrase", "w", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("first")
    )
    # A window whose rarest shingle the corpus lacks can't occur.
    prefixes = written(ranked.where("first.n > 0").select("phrase", "w", "size", "first.shingle", "first.offset"), "prefixes")
    docs = written(probe(documents, prefixes, sizes, window), "probed")

    places = docs.where(F.size("hits") > 0).select("doc_id", "text_key", "n_words", F.explode("hits").alias("h")).select("doc_id", "text_key", "n_words", "h.*").distinct()
    start = F.col("at") - F.col("offset")
    held = places.join(prefixes, ["size", "shingle"]).where((start >= 0) & (start + F.col("w") <= F.col("n_words")))
    exact = F.array_join(F.slice(F.split("around", " "), start - F.col("lo") + 1, F.col("w")), " ") == F.col("phrase")
    found = written(held.where(exact).select("doc_id", "text_key", "phrase", start.alias("start"), (start + F.col("w")).alias("stop")), "occurrences")

    key = ["doc_id", "text_key"]
    # Words covered: each span adds what lies beyond all spans before it.
    spans = found.select(*key, "start", "stop").distinct()
    before = F.expr("max(stop) OVER (PARTITION BY doc_id, text_key ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    covered = spans.withColumn("before", F.coalesce(before, F.lit(0))).groupBy(*key).agg(F.sum(F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "before"))).alias("n_hit"))
    items = found.select(*key, "phrase").distinct().join(windows.select("phrase", "item"), "phrase").where("item IS NOT NULL")
    items = items.groupBy(*key).agg(F.sort_array(F.collect_set("item")).alias("items"))
    hits = covered.join(items.withColumnsRenamed({"doc_id": "i", "text_key": "t"}), F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t")), "left").select("doc_id", "text_key", "n_hit", "items")
    right = hits.withColumnsRenamed({"doc_id": "i", "text_key": "t"})
    return docs.select("doc_id", "text_key", "n_words").join(right, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("t")), "left").select(
        *key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    ).withColumn("n_items", F.size("items").cast("long"))


def decontaminated(documents: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3) -> DataFrame:
    """The rows of ``documents`` that hold no benchmark window, all columns as they were, whatever their names.

    Null and empty texts hold none and stay, as does everything if the
    benchmark is empty; an empty table gives no rows.
    """
    whole, names, restored = numbered(documents)
    doc_id, text = F.col(names["doc_id"]).cast("long"), F.col(names["text"])
    found = contamination(whole.select(doc_id.alias("doc_id"), text.alias("text")), benchmark, window, shingle)
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_t"))
    rows = whole.withColumn("_key", text_key(names["text"]))
    return rows.join(hit, doc_id.eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_t")), "left_anti").select(*restored)
