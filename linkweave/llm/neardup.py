"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are majority votes over the XXH64 (seed 42) of word shingles.
Distinct fingerprints are sorted by population count, then value, and packed
into tiles. Two tiles are compared, by exclusive-or and bit counts, unless
their population counts differ beyond the radius, since then no pair of theirs
can link. Within a pair of tiles the same holds of strips of 256, where bits
that all fingerprints of a strip share give a second lower bound. Each pair of
tiles is a task and returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkweave.llm.common import numbered, partitions, raw_texts, slices, spread_join, written
from linkweave.llm.components import components

#: Leading bits that, with the population count, name a cell of the histogram tiles are cut from.
CELL_BITS = 10
STRIP = 256
LEAST_TILE, MOST_TILE = 1 << 12, 1 << 17


def shingle_hashes(raw: bytes, words: int) -> np.ndarray:
    """XXH64 (seed 42) of each shingle of one UTF-8 text; of the whole sequence if it has fewer words."""
    found = raw.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(found))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(found) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], 42) for a, b in spans), dtype=np.uint64, count=len(found) - k + 1)


def majority(hashes: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each run of hashes, the bits that over half of them set; a run is not empty."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    votes = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    return np.packbits(2 * votes > counts[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def remixed(hashes: np.ndarray) -> np.ndarray:
    """Independent hashes from hashes."""
    out = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


def fingerprints_of(body: np.ndarray, offsets: np.ndarray, words: int, marks: bool = False) -> tuple[np.ndarray, ...]:
    """Fingerprints of texts that lie end to end; with ``marks`` of their shingle sets, also those of the remixed hashes, the sizes and the digests."""
    n = len(offsets) - 1
    out, out2, sizes, digests = (np.zeros(n, np.uint64) for _ in range(4))
    held, rows, size = [], [], 0

    def flush():
        nonlocal held, rows, size
        if rows:
            counts = np.array([len(h) for h in held])
            hashes, starts = np.concatenate(held), np.concatenate([[0], np.cumsum(counts)[:-1]])
            out[rows] = majority(hashes, starts, counts)
            if marks:
                out2[rows] = majority(remixed(hashes), starts, counts)
        held, rows, size = [], [], 0

    for i in range(n):
        hashes = shingle_hashes(body[offsets[i] : offsets[i + 1]].tobytes(), words)
        if marks:
            hashes = np.unique(hashes)
            sizes[i] = len(np.unique(hashes.astype(np.uint32)))
            digests[i] = xxhash.xxh64_intdigest(hashes.tobytes())
        if len(hashes):
            held.append(hashes)
            rows.append(i)
            size += len(hashes)
        if size > 60_000:
            flush()
    flush()
    return (out, out2, sizes, digests) if marks else (out,)


#: Columns that ``with_simhash`` adds.
MARKS = ("fp", "fp2", "size", "node")


def with_simhash(df: DataFrame, words: int = 4, text: str = "text", carry: tuple[str, ...] = ("doc_id",), marks: bool = False) -> DataFrame:
    """The ``carry`` columns and ``fp``, the signed fingerprint of ``text``, with ``marks`` all of MARKS, where a repeated shingle counts once; null and empty texts have 0."""
    source = df.select(*carry, F.col(text).cast("string").alias("_text"))
    fields = [*source.drop("_text").schema.fields]
    names = MARKS if marks else MARKS[:1]
    schema = source.drop("_text").schema
    for name in names:
        schema = schema.add(name, "long")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                found = fingerprints_of(*raw_texts(batch.column(len(fields))), words, marks)
                own = [pa.array(f.view(np.int64)) for f in found]
                yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(fields))), *own], names=[*carry, *names])

    return source.mapInArrow(kernel, schema)


def _strips(fps: np.ndarray) -> tuple[np.ndarray, ...]:
    at = np.arange(0, len(fps), STRIP)
    pops = np.bitwise_count(fps)
    return np.bitwise_and.reduceat(fps, at), np.bitwise_or.reduceat(fps, at), np.minimum.reduceat(pops, at).astype(np.int16), np.maximum.reduceat(pops, at).astype(np.int16)


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links between two tiles, or within one, each sorted by population count."""
    nodes = a if same else np.concatenate([a, b])
    shift = 0 if same else len(a)
    root = np.arange(len(nodes))
    a_and, a_or, a_lo, a_hi = _strips(a)
    b_and, b_or, b_lo, b_hi = (a_and, a_or, a_lo, a_hi) if same else _strips(b)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(a_and)):
        near = (b_lo <= a_hi[i] + radius) & (b_hi >= a_lo[i] - radius)
        near &= np.bitwise_count((a_and[i] & ~b_or) | (b_and & ~a_or[i])) <= radius
        if same:
            near[:i] = False
        left = a[i * STRIP : (i + 1) * STRIP]
        for j in np.flatnonzero(near):
            hit = np.bitwise_count(left[:, None] ^ b[j * STRIP : (j + 1) * STRIP][None, :]) <= radius
            if same and i == j:
                np.fill_diagonal(hit, False)
            x, y = np.nonzero(hit)
            if not len(x):
                continue
            x, y = x + i * STRIP, y + j * STRIP + shift
            while np.any(root[root[x]] != root[x]) or np.any(root[root[y]] != root[y]):
                root = root[root]
            differ = root[x] != root[y]
            if differ.any():
                for u, v in np.unique(np.column_stack([root[x[differ]], root[y[differ]]]), axis=0).tolist():
                    u, v = find(u), find(v)
                    if u != v:
                        root[max(u, v)] = min(u, v)
                root = root[root]
    while np.any(root[root] != root):
        root = root[root]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def _tiling(cells: DataFrame, radius: int) -> tuple[DataFrame, DataFrame, int] | None:
    """Where the cells (pop, lead) go: their tile and number of pieces, each tile's first and last partner, and the number of tiles; None without rows."""
    spark = cells.sparkSession
    # 65 population counts times 2 ** CELL_BITS leading bits: a bounded histogram.
    counted = sorted((r["pop"], r["lead"], r["count"]) for r in cells.groupBy("pop", "lead").count().collect())
    total = sum(c for _, _, c in counted)
    size = min(MOST_TILE, max(LEAST_TILE, total // 48))
    placed, low, high, tile, held = [], [], [], -1, size
    for pop, lead, count in counted:
        if held + count > size:
            tile, held = tile + 1, 0
            low.append(pop)
            high.append(pop)
        pieces = -(-count // size)  # a large cell is dealt over several tiles
        placed.append((pop, lead, tile, pieces))
        held += count
        high[tile] = pop
        for _ in range(pieces - 1):
            tile += 1
            low.append(pop)
            high.append(pop)
            held = size
    if not placed:
        return None
    first = [next(i for i in range(t + 1) if high[i] >= low[t] - radius) for t in range(len(low))]
    last = [max(i for i in range(t, len(low)) if low[i] <= high[t] + radius) for t in range(len(low))]
    where = F.broadcast(spark.createDataFrame(placed, "pop int, lead int, tile int, pieces int"))
    reach = spark.createDataFrame([(t, first[t], last[t]) for t in range(len(low))], "tile int, first int, last int")
    return where, reach, len(low)


def near_links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(u, v) signed fingerprints: a forest with the connectivity of all links within ``radius`` bits.

    ``fps`` has distinct, non-null signed ``fp``.
    """
    spark = fps.sparkSession
    cells = fps.withColumns({"pop": F.bit_count("fp"), "lead": F.shiftrightunsigned("fp", 64 - CELL_BITS).cast("int")})
    plan = _tiling(cells, radius)
    if plan is None:
        return spark.createDataFrame([], "u long, v long")
    where, reach, tiles = plan
    packed = (
        cells.join(where, ["pop", "lead"])
        .select((F.col("tile") + F.expr("CAST(pmod(xxhash64(fp), pieces) AS INT)")).alias("tile"), "fp")
        .groupBy("tile")
        .applyInArrow(_pack, "tile int, blob binary")
    )
    sent = packed.join(F.broadcast(reach), "tile").select("tile", "blob", F.explode(F.sequence("first", "last")).alias("other"))
    pairs = sent.select(F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), "tile", "blob")

    def compare(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        blobs = dict(zip(table.column("tile").to_pylist(), table.column("blob").to_pylist(), strict=True))
        u, v = forest(np.frombuffer(blobs[x], np.uint64), np.frombuffer(blobs[y], np.uint64), radius, x == y) if x in blobs and y in blobs else (np.zeros(0, np.uint64),) * 2
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return pairs.repartition(max(partitions(fps), min(tiles * 4, 2000)), "x", "y").groupBy("x", "y").applyInArrow(compare, "u long, v long")


def _pack(table: pa.Table) -> pa.Table:
    fps = table.column("fp").to_numpy().astype(np.int64).view(np.uint64)
    fps = fps[np.lexsort((fps, np.bitwise_count(fps)))]
    return pa.table({"tile": pa.array([table.column("tile")[0].as_py()], pa.int32()), "blob": pa.array([fps.tobytes()], pa.binary())})


def near_duplicate_classes(df: DataFrame, radius: int = 4, words: int = 4, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns of each row (doc_id among them), ``fp``, ``root`` (the component's smallest fingerprint) and ``component_id``.

    ``component_id`` is the smallest doc_id reachable over links of at most
    ``radius`` differing bits; rows without a doc_id take part, and a component
    of such rows only has none. Texts without words have fingerprint 0 and
    link as any other. Repeated rows share a component. An empty table gives
    no rows. Columns that aren't carried don't matter.
    """
    docs = written(with_simhash(df, words, carry=carry), "simhash")
    unique = written(docs.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-unique")
    roots = components(near_links(unique.select("fp"), radius))
    named = unique.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = written(named, "simhash-roots")
    smallest = named.groupBy("root").agg(F.min("id").alias("component_id"))
    found = named.join(smallest, "root").select("fp", "root", "component_id")
    return spread_join(docs, found, "fp", ("doc_id",), partitions(df))


#: Of a cell: texts on a side, and distinct shingles on a side beyond one text's.
CELL_TEXTS, CELL_SHINGLES = 256, 1 << 20
#: Candidates of a pair of tiles held before cells are cut from them, and shared shingles in one matrix product.
MOST_HELD, MOST_SHARED = 4_000_000, 1 << 14
#: Size classes of shingle sets for each factor of 1 / similarity.
SIZE_STEPS = 16


def _near_pairs(a: np.ndarray, b: np.ndarray, same: bool, radius: int, similarity: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All places (in a, in b) of candidates of two tiles (records fp, fp2, node, size), a strip of a with one of b at a time."""
    for i in range(0, len(a), STRIP):
        left = a[i : i + STRIP]
        for j in range(i if same else 0, len(b), STRIP):
            right = b[j : j + STRIP]
            if min(left["size"].max(), right["size"].max()) < similarity * max(left["size"].min(), right["size"].min()):
                continue
            x, y = np.nonzero(np.bitwise_count(left["fp"][:, None] ^ right["fp"][None, :]) <= radius)
            m, n = left["size"][x], right["size"][y]
            ok = (np.bitwise_count(left["fp2"][x] ^ right["fp2"][y]) <= radius) & (np.minimum(m, n) >= similarity * np.maximum(m, n))
            if same and i == j:
                ok &= x < y
            if ok.any():
                yield x[ok] + i, y[ok] + j


def _blocks(root: np.ndarray, size: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The block of each place that ``of`` has: places of one root lie together."""
    places = np.unique(of)
    places = places[np.lexsort((places, root[places]))]
    block = np.zeros(len(root), np.int64)
    block[places] = np.cumsum(np.maximum(size[places] / CELL_SHINGLES, 1 / CELL_TEXTS)).astype(np.int64)
    return block


def _cells(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, bytes]]:
    """The candidates (places p in a and q in b) as cells: nodes of a, nodes of b, and a bit for each pair of them.

    Texts with candidates in common come into the same cells, so a family of k texts is sent about
    k / CELL_TEXTS times and not k times.
    """
    shift = 0 if same else len(a)
    root = np.arange(shift + len(b))
    for _ in range(2):
        np.minimum.at(root, p, root[q + shift])
        np.minimum.at(root, q + shift, root[p])
    bp, bq = (_blocks(root, a["size"], np.concatenate([p, q])),) * 2 if same else (_blocks(root[:shift], a["size"], p), _blocks(root[shift:], b["size"], q))
    if same:  # else a pair of blocks makes two cells
        p, q = np.where(bp[p] <= bp[q], p, q), np.where(bp[p] <= bp[q], q, p)
    order = np.lexsort((bq[q], bp[p]))
    p, q = p[order], q[order]
    ends = np.flatnonzero((np.diff(bp[p]) != 0) | (np.diff(bq[q]) != 0)) + 1
    for u, v in zip(np.split(p, ends), np.split(q, ends), strict=True):
        left, x = np.unique(u, return_inverse=True)
        right, y = np.unique(v, return_inverse=True)
        hit = np.zeros((len(left), len(right)), bool)
        hit[x, y] = True
        yield a["node"][left], b["node"][right], np.packbits(hit).tobytes()


_RECORD = np.dtype([("fp", "<u8"), ("fp2", "<u8"), ("node", "<i8"), ("size", "<i8")])


def near_candidates(nodes: DataFrame, radius: int, similarity: float) -> DataFrame:
    """(cell, left, right, hit): all pairs of nodes (fp, fp2, node, size) within both radii whose sizes allow the similarity.

    Found by tiled exact comparison. A row has up to CELL_TEXTS nodes on a side, and
    ``hit`` has a bit for each pair of them. Tiles are cut by size, and tiles whose sizes differ too much aren't compared.
    """
    spark = nodes.sparkSession
    steps = F.floor(F.log(F.col("size").cast("double")) * (SIZE_STEPS / -math.log(similarity))).cast("int")
    cells = nodes.where("size > 0").withColumns({"pop": steps, "lead": F.lit(0)})
    plan = _tiling(cells, SIZE_STEPS + 1)
    if plan is None:
        return spark.createDataFrame([], "cell string, left array<long>, right array<long>, hit binary")
    where, reach, tiles = plan

    def pack(table: pa.Table) -> pa.Table:
        out = np.zeros(table.num_rows, _RECORD)
        for name in _RECORD.names:
            out[name] = table.column(name).to_numpy().astype(np.int64).view(out[name].dtype)
        out = out[np.lexsort((out["node"], out["size"]))]
        return pa.table({"tile": pa.array([table.column("tile")[0].as_py()], pa.int32()), "blob": pa.array([out.tobytes()], pa.binary())})

    def compare(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        blobs = {t: np.frombuffer(b, _RECORD) for t, b in zip(table.column("tile").to_pylist(), table.column("blob").to_pylist(), strict=True)}
        found: list[tuple[np.ndarray, np.ndarray, bytes]] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            if held:
                p, q = (np.concatenate(z) for z in zip(*held, strict=True))
                found.extend(_cells(blobs[x], blobs[y], p, q, x == y))
                held.clear()

        if x in blobs and y in blobs:
            size = 0
            for p, q in _near_pairs(blobs[x], blobs[y], x == y, radius, similarity):
                held.append((p, q))
                size += len(p)
                if size > MOST_HELD:
                    flush()
                    size = 0
            flush()
        kinds = {"left": pa.list_(pa.int64()), "right": pa.list_(pa.int64()), "hit": pa.binary()}
        own = {name: pa.array([f[i] for f in found], kind) for i, (name, kind) in enumerate(kinds.items())}
        return pa.table({"cell": pa.array([f"{x} {y} {i}" for i in range(len(found))], pa.string())} | own)

    dealt = cells.join(where, ["pop", "lead"]).withColumn("tile", F.col("tile") + F.expr("CAST(pmod(xxhash64(node), pieces) AS INT)"))
    packed = dealt.select("tile", *[F.col(n).cast("long") for n in _RECORD.names]).groupBy("tile").applyInArrow(pack, "tile int, blob binary")
    sent = packed.join(F.broadcast(reach), "tile").select("tile", "blob", F.explode(F.sequence("first", "last")).alias("other"))
    pairs = sent.select(F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"), "tile", "blob")
    return pairs.repartition(max(partitions(nodes), min(tiles * 4, 2000)), "x", "y").groupBy("x", "y").applyInArrow(compare, "cell string, left array<long>, right array<long>, hit binary")


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each on the right; sets are arrays without repeats."""
    values = [np.concatenate(s) for s in (left, right)]
    common = np.intersect1d(*values)
    both = np.zeros((len(left), len(right)), np.int64)
    sides = []
    for sets, v in zip((left, right), values, strict=True):
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(common, v)
        ok = at < len(common)
        ok[ok] = common[at[ok]] == v[ok]
        order = np.argsort(at[ok], kind="stable")
        sides.append((owner[ok][order], at[ok][order]))
    for lo in range(0, len(common), MOST_SHARED):
        product = []
        for sets, (owner, at) in zip((left, right), sides, strict=True):
            i, j = np.searchsorted(at, [lo, lo + MOST_SHARED])
            dense = np.zeros((len(sets), min(MOST_SHARED, len(common) - lo)), np.float32)
            dense[owner[i:j], at[i:j] - lo] = 1
            product.append(dense)
        both += (product[0] @ product[1].T).astype(np.int64)
    return both


def cell_links(table: pa.Table, cell: pa.Table, similarity: float) -> pa.Table:
    """(u, v): a forest with the connectivity of the links of one cell, given the sets (node, shingles) of its nodes."""
    shingles = table.column("shingles")
    sets = {}
    for nodes, chunk in zip(table.column("node").chunks, shingles.chunks, strict=True):
        at, values = chunk.offsets.to_numpy() - chunk.offsets[0].as_py(), chunk.flatten().to_numpy()
        sets |= {n: values[at[i] : at[i + 1]] for i, n in enumerate(nodes.to_pylist())}
    left, right = cell.column("left")[0].as_py(), cell.column("right")[0].as_py()
    hit = np.unpackbits(np.frombuffer(cell.column("hit")[0].as_py(), np.uint8), count=len(left) * len(right)).reshape(len(left), len(right)).astype(bool)
    a, b = [sets[n] for n in left], [sets[n] for n in right]
    both = shared(a, b)
    total = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :]
    x, y = np.nonzero(hit & (both >= similarity * (total - both)))
    nodes, place = np.unique(np.array([*left, *right], np.int64), return_inverse=True)
    x, y = place[x], place[y + len(left)]
    root, was = np.arange(len(nodes)), None
    while was is None or np.any(root != was):
        was = root.copy()
        np.minimum.at(root, x, root[y])
        np.minimum.at(root, y, root[x])
        root = root[root]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.table({"u": nodes[child], "v": nodes[root[child]]})


def shingle_sets(rows: DataFrame, words: int) -> DataFrame:
    """(node, shingles) of rows (node, text): distinct shingle hashes, cut to 32 bits, which shifts no similarity by more than chance equals do."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                body, at = raw_texts(batch.column(1))
                sets = [np.unique(shingle_hashes(body[at[i] : at[i + 1]].tobytes(), words).astype(np.uint32).view(np.int32)) for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int32()))], names=["node", "shingles"])

    return rows.select("node", "text").mapInArrow(kernel, "node long, shingles array<int>")


def radius_for(similarity: float) -> int:
    """Bits within which fingerprints of shingle sets of this similarity lie, but for a tail of about 3.5 standard deviations; 20 at 0.8."""
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(64 * differ + 3.5 * math.sqrt(64 * differ * (1 - differ)))


def similar_classes(df: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """doc_id, _digest and ``root`` of each row of ``df`` (doc_id, text, _digest): groups of texts alike in word shingles.

    Two texts link if the Jaccard similarity of their shingle sets is at least
    ``similarity``. Candidates come from tiled comparison of two independent
    fingerprints, both within ``radius_for(similarity)`` bits.
    All candidates are verified on the whole texts, by matrix products over the
    shingles that the texts of a cell share; of the links a forest is kept.
    Texts with equal shingle sets are one node; texts without words are one group.
    """
    radius = radius_for(similarity)
    docs = written(with_simhash(df, words, carry=("doc_id", "_digest"), marks=True), "fingerprints")
    rep = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_digest", "fp", "fp2", "size")).alias("rep")
    nodes = written(docs.groupBy("node").agg(rep).select("node", "rep.fp", "rep.fp2", "rep.doc_id", "rep._digest", "rep.size"), "nodes")
    texts = df.select("doc_id", "_digest", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cells = written(near_candidates(nodes.select("node", "fp", "fp2", "size"), radius, similarity), "cells")
    asked = written(cells.select("cell", F.explode(F.array_distinct(F.concat("left", "right"))).alias("node")), "asked")
    wanted = asked.select("node").distinct().join(nodes, "node").select("node", F.col("doc_id").alias("_i"), F.col("_digest").alias("_t"))
    held = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("_digest") == F.col("_t")))
    sets = written(shingle_sets(held.select("node", "text"), words), "shingles").dropDuplicates(["node"])

    def verify(table: pa.Table, cell: pa.Table) -> pa.Table:
        return cell_links(table.select(["node", "shingles"]), cell, similarity)

    links = asked.join(sets, "node").groupBy("cell").cogroup(cells.groupBy("cell")).applyInArrow(verify, "u long, v long")
    labels = components(written(links, "links"))
    named = nodes.select("node").join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return docs.join(named, "node").select("doc_id", "_digest", "root")


def keep_one(df: DataFrame, similarity: float = 0.8, words: int = 5) -> DataFrame:
    """The rows of ``df`` (doc_id, text and any others) of which each group of near duplicates keeps one.

    Groups are those of ``similar_classes``; null texts are empty, and texts
    without words are one group. Kept is the smallest doc_id (null last), of
    several such rows the one whose text has the smallest digest; of rows alike
    in both, one. All columns are kept as they were, whatever their names. An
    empty table gives no rows.
    """
    whole, names, restored = numbered(df)
    doc_id, text = F.col(names["doc_id"]), F.coalesce(F.col(names["text"]).cast("string"), F.lit(""))
    keyed = whole.withColumn("_digest", F.md5(text))
    classes = similar_classes(keyed.select(doc_id.alias("doc_id"), text.alias("text"), "_digest"), similarity, words)
    chosen = classes.groupBy("root", "doc_id", "_digest").count().groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_digest", "count")).alias("x")
    ).select("x.doc_id", "x._digest", "x.count")
    chosen = written(chosen, "kept").alias("c")
    kept = keyed.alias("d").join(chosen, F.col(f"d.{names['doc_id']}").eqNullSafe(F.col("c.doc_id")) & (F.col("d._digest") == F.col("c._digest")), "left_semi")
    if not chosen.where("count > 1").isEmpty():  # repeated rows
        kept = kept.dropDuplicates([names["doc_id"], "_digest"])
    return kept.select(*restored)
