"""Candidate generation: capped equi-joins in several channels, merged and budgeted.

A channel joins S1 to the pool on a key and the country. Keys that S1 holds
too often are dropped whole; of a pool key the lowest ids stay. Both happen before the
join, so a common key can't multiply. All ties are broken by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkweave.functions import text as t
from linkweave.functions.fixed import MAIL_DOMAINS_SHORT
from linkweave.sources.scratch import written

PAIR = ("s1_id", "cand_id")


@dataclass(frozen=True)
class Channel:
    """A key of one or more columns, its cap, priority and bit, and the least length of its columns."""

    keys: tuple[str, ...]
    most: int
    priority: int
    bit: int
    least: int = 1


@dataclass(frozen=True)
class Profile:
    """Channels and budgets of a blocker."""

    channels: tuple[Channel, ...]
    most_by_source: dict[int, int] = field(default_factory=lambda: {2: 8, 3: 10})
    most_other: int = 5
    most_total: int = 18
    similarity_top_k: int = 15
    least_similarity: float = 0.22
    grams: tuple[int, int] = (3, 4)


def _channels(exact: int, address: int, street: int, domain: int, tokens: int) -> tuple[Channel, ...]:
    return (
        Channel(("name_token_sorted_key",), exact, 1, 1),
        Channel(("name_no_legal",), exact, 1, 2),
        Channel(("address_clean",), address, 2, 4, 8),
        Channel(("street_number", "first_token"), street, 2, 8),
        Channel(("domain_root",), domain, 3, 16, 3),
        Channel(("first_token", "second_token"), tokens, 4, 32),
    )


SPARSE = Profile(_channels(200, 100, 50, 100, 25))
DENSE = replace(SPARSE, channels=_channels(250, 150, 80, 150, 40), most_by_source={2: 20, 3: 25}, most_other=10, most_total=40, similarity_top_k=25, least_similarity=0.20)
SIMILARITY_BIT, SEMANTIC_BIT = 64, 128


def not_blank(*keys: str, least: int = 1) -> Column:
    """All keys are there, not blank, and long enough."""
    return reduce(and_, [F.col(k).isNotNull() & (F.trim(F.col(k)) != "") & (F.length(F.col(k)) >= least) for k in keys])


def block_on_keys(s1: DataFrame, cands: DataFrame, channel: Channel, s1_id: str = "entity_id", cand_id: str = "entity_id", within: tuple[str, ...] = ("country",)) -> DataFrame:
    """(s1_id, cand_id, priority, channel_mask) of one channel."""
    missing = [k for k in (*channel.keys, *within) if k not in s1.columns or k not in cands.columns]
    if missing:
        raise ValueError(f"no key columns {missing}")
    on = [*within, *channel.keys]
    ok = not_blank(*channel.keys, least=channel.least)
    group = Window.partitionBy(*on)
    left = s1.where(ok).select(F.col(s1_id).alias("s1_id"), *on).withColumn("_n", F.count("*").over(group)).where(F.col("_n") <= channel.most).drop("_n")
    right = cands.where(ok).select(F.col(cand_id).alias("cand_id"), *on).withColumn("_n", F.row_number().over(group.orderBy("cand_id"))).where(F.col("_n") <= channel.most).drop("_n")
    return left.join(right, on).select(*PAIR, F.lit(channel.priority).alias("priority"), F.lit(channel.bit).alias("channel_mask"))


def rare_keys(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The rows whose key occurs ``most`` times at most."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).where(F.col("_n") <= most).drop("_n")


def merge_channels(*parts: DataFrame) -> DataFrame:
    """One row for each pair: best priority, and the bitwise or of its channels."""
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy(*PAIR).agg(F.min("priority").alias("priority_rank"), F.bit_or("channel_mask").alias("channel_mask"))


def top_per(df: DataFrame, by: list[str], order: list[Column], most: int) -> DataFrame:
    """The first ``most`` rows of each group."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= most).drop("_r")


def budget(pairs: DataFrame, sources: DataFrame | None = None, profile: Profile = SPARSE) -> DataFrame:
    """Pairs within the budget of each source and of all, by priority, then id.

    ``sources`` has cand_id and source_type; without it only the total counts.
    """
    order = [F.col("priority_rank"), F.col("cand_id")]
    if sources is not None:
        typed = pairs.join(sources.select("cand_id", "source_type"), "cand_id", "left")
        ranked = typed.withColumn("_r", F.row_number().over(Window.partitionBy("s1_id", F.when(F.col("source_type").isin(*profile.most_by_source), F.col("source_type"))).orderBy(*order)))
        most = F.lit(profile.most_other)
        for source, cap in profile.most_by_source.items():
            most = F.when(F.col("source_type") == source, cap).otherwise(most)
        pairs = ranked.where(F.col("_r") <= most).drop("_r", "source_type")
    return top_per(pairs, ["s1_id"], order, profile.most_total) if profile.most_total > 0 else pairs


def block(s1: DataFrame, cands: DataFrame, profile: Profile = SPARSE, similar: DataFrame | None = None, semantic: DataFrame | None = None) -> DataFrame:
    """All channels over keyed tables (entity_id, country, keys; source_type in ``cands`` if known).

    ``similar`` and ``semantic`` are pairs (s1_id, cand_id) of a similarity
    join and of an encoder; they enter as priority 5 and 6.
    """
    parts = [block_on_keys(s1, cands, c) for c in profile.channels]
    if similar is not None:
        parts.append(similar.select(*PAIR, F.lit(5).alias("priority"), F.lit(SIMILARITY_BIT).alias("channel_mask")))
    if semantic is not None:
        known = semantic.join(s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
        parts.append(known.select(*PAIR, F.lit(6).alias("priority"), F.lit(SEMANTIC_BIT).alias("channel_mask")))
    sources = cands.select(F.col("entity_id").alias("cand_id"), "source_type") if "source_type" in cands.columns else None
    return budget(merge_channels(*parts), sources, profile)


def block_to_pairs(s1: DataFrame, cands: DataFrame, profile: Profile = DENSE, **channels) -> DataFrame:
    """(s1_id, cand_id) of ``block``."""
    return block(s1, cands, profile, **channels).select(*PAIR)


def run_blocking(s1: DataFrame, cands: DataFrame, most: int = 40, **channels) -> DataFrame:
    """``block`` with the dense profile and ``most`` candidates for each S1 row."""
    return block(s1, cands, replace(DENSE, most_total=most), **channels)


def merge_candidates(*parts: DataFrame, within: tuple[str, ...] = ()) -> DataFrame:
    """Candidate tables with different columns as one: best priority, all channels, best score of each pair.

    ``within`` names columns that a pair decides and by which all parts are partitioned alike.
    """
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rules = {"priority_rank": F.min, "channel_mask": F.bit_or, "semantic_score": F.max}
    return every.groupBy(*within, *PAIR).agg(*[f(c).alias(c) for c, f in rules.items() if c in every.columns]).drop(*within)


def _pairs(left: DataFrame, right: DataFrame, on: list[str], priority: int, most: int) -> DataFrame:
    """Pairs of equal keys; of a key's candidates the first ``most`` ids, since only so many of an S1 row are kept, by priority and then by id."""
    a = left.select(F.col("entity_id").alias("s1_id"), *on)
    b = top_per(right.select(F.col("entity_id").alias("cand_id"), *on).dropna(subset=on).distinct(), on, [F.col("cand_id")], most)
    return a.join(b, on).select(*PAIR, F.lit(priority).alias("priority"))


def _best(parts: list[DataFrame], most: int) -> DataFrame:
    merged = reduce(DataFrame.unionByName, parts).groupBy(*PAIR).agg(F.min("priority").alias("priority"))
    return top_per(merged, ["s1_id"], [F.col("priority"), F.col("cand_id")], most)


def three_channel_candidates(s1: DataFrame, cands: DataFrame, most: int = 8, rare: int = 20) -> DataFrame:
    """Name, address and gated two-token joins within a country; (s1_id, cand_id, priority)."""
    a, b = (d.withColumns(t.blocking_keys("business_name", "business_address", squeeze=False)).select("entity_id", "country", "cname", "caddr", "t0", "t1") for d in (s1, cands))
    two = (F.length("t0") >= 4) & (F.length("t1") >= 4)
    rare_left = rare_keys(a.where(two), ["country", "t0", "t1"], rare)
    return _best(
        [
            _pairs(a.where(F.length("cname") > 2), b.where(F.length("cname") > 2), ["country", "cname"], 1, most),
            _pairs(a.where(F.length("caddr") > 8), b.where(F.length("caddr") > 8), ["country", "caddr"], 2, most),
            _pairs(rare_left, b.where(two), ["country", "t0", "t1"], 3, most),
        ],
        most,
    )


def six_channel_candidates(s1: DataFrame, cands: DataFrame, most: int = 8) -> DataFrame:
    """Name, domain, address, street number with first word, rare two-token and rare prefix joins within a country."""
    a, b = (d.withColumns(t.blocking_keys("business_name", "business_address", squeeze=True)) for d in (s1, cands))
    own_domain = F.col("domain").isNotNull() & ~F.col("domain").isin(MAIL_DOMAINS_SHORT)
    street = F.col("snum").isNotNull() & (F.length("t0") >= 3)
    two, prefix = (F.length("t0") >= 4) & (F.length("t1") >= 4), F.length("p4") == 4
    return _best(
        [
            _pairs(a.where(F.length("cname") > 2), b.where(F.length("cname") > 2), ["country", "cname"], 1, most),
            _pairs(a.where(own_domain), b.where(own_domain), ["country", "domain"], 1, most),
            _pairs(a.where(F.length("caddr") > 8), b.where(F.length("caddr") > 8), ["country", "caddr"], 2, most),
            _pairs(a.where(street), b.where(street), ["country", "snum", "t0"], 3, most),
            _pairs(rare_keys(a.where(two), ["country", "t0", "t1"], 25), b.where(two), ["country", "t0", "t1"], 4, most),
            _pairs(rare_keys(a.where(prefix), ["country", "p4"], 15), b.where(prefix), ["country", "p4"], 5, most),
        ],
        most,
    )


#: Indexes of the probe in order: name and how many entries of a key are read (None: all).
PROBES = (("domain", 10), ("name", None), ("token", 15), ("prefix", 15), ("address", 10), ("address_token", 10))


def _index(df: DataFrame, probing: bool) -> DataFrame:
    """(entity_id, channel, place, key): the keys of a row, by index; a probe reads one address token, an index holds two."""
    named = df.select("entity_id", F.coalesce("business_name", F.lit("")).alias("raw"), F.coalesce("business_address", F.lit("")).alias("addr"))
    named = named.withColumns({"domain": t.domain_root_unfiltered("raw"), "norm": t.normalize_text("raw"), "norm_a": t.normalize_text("addr")})
    tokens = F.slice(t.significant_tokens(F.col("norm")), 1, 2)
    words = F.filter(F.split("norm_a", " "), lambda w: (F.length(w) >= 4) & ~w.rlike("^[0-9]+$"))
    domain = F.col("domain") if probing else F.when(~F.col("domain").isin(MAIL_DOMAINS_SHORT), F.col("domain"))
    keys = [
        F.array(domain),
        F.array(F.when(F.col("norm") != "", F.col("norm"))),
        tokens,
        F.array(F.when(F.length("norm") >= 4, F.substring("norm", 1, 4))),
        F.array(F.when(F.length("norm_a") > 8, F.col("norm_a"))),
        F.slice(words, 1, 1 if probing else 2),
    ]
    entry = lambda c: lambda key, i: F.struct(F.lit(c).alias("channel"), i.alias("place"), key.alias("key"))
    rows = F.flatten(F.array(*[F.transform(k, entry(c)) for c, k in enumerate(keys)]))
    return named.select("entity_id", F.explode(rows).alias("x")).select("entity_id", "x.*").where("key IS NOT NULL")


def probe_candidates(s1: DataFrame, cands: DataFrame, most: int = 8) -> DataFrame:
    """Six inverted indexes as one table and one join; (s1_id, cand_id, rank), at most ``most`` for each S1 row, in probe order.

    An index lists the ids of a key in order; a probe reads the first of them.
    The name index is read whole and so are its common names: that is the semantics.
    """
    limits = F.create_map(*[F.lit(x) for c, (_, n) in enumerate(PROBES) for x in (c, n or (1 << 31) - 1)])
    entries = _index(cands, probing=False).groupBy("channel", "key", F.col("entity_id").alias("cand_id")).agg(F.count("*").alias("times"))
    # A row that has a key twice is listed twice.
    listed = entries.withColumn("end", F.sum("times").over(Window.partitionBy("channel", "key").orderBy("cand_id").rowsBetween(Window.unboundedPreceding, 0)))
    listed = listed.where(F.col("end") - F.col("times") < limits[F.col("channel")]).select("channel", "key", "cand_id", F.col("end").alias("at"))
    found = _index(s1, probing=True).withColumnRenamed("entity_id", "s1_id").join(listed, ["channel", "key"])
    first = found.groupBy(*PAIR).agg(F.min(F.struct("channel", "place", "at")).alias("o"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("s1_id").orderBy("o", "cand_id")))
    return ranked.where(F.col("rank") <= most).select(*PAIR, "rank")


#: Classes of equal tokens of S1 and of the pool in one cell of the token join, ids that a class holds at most, and ids given out at once.
TOKEN_TILES, MOST_IDS, GIVEN_OUT = (4_096, 2_048), 1_024, 1 << 18
#: S1 ids, and pairs, that one row of lists stands for at most: Spark holds all that comes of a row in memory before it hands the first pair on.
OWN_TOGETHER, PAIRS_TOGETHER = 64, 1 << 12
#: Tables of up to so many rows are broadcast.
MOST_SENT = 1 << 20


def _token_classes(rows: DataFrame) -> DataFrame:
    """(country, key, tokens, ids): rows of equal tokens as one, in pieces of some MOST_IDS."""
    pieces = written(rows.groupBy("key").agg(F.ceil(F.count("*") / MOST_IDS).cast("int").alias("pieces")).where("pieces > 1"), "pieces")
    # Sent to the rows, so that a frequent key's rows don't meet in one task.
    pieces = F.broadcast(pieces) if pieces.count() <= MOST_SENT else pieces
    cut = rows.join(pieces, "key", "left").withColumn("piece", F.expr("CAST(pmod(xxhash64(entity_id), coalesce(pieces, 1)) AS INT)"))
    return cut.groupBy("country", "key", "piece").agg(F.first("tokens").alias("tokens"), F.collect_list("entity_id").alias("ids"))


def token_candidates(s1: DataFrame, cands: DataFrame, name: str = "business_name") -> DataFrame:
    """Distinct pairs that share a significant token within a country.

    Rows of equal tokens are a class. A cell meets some classes of S1 with some of the pool: each token has a
    bit for each pool class, and the bits of a class's tokens are its matches. So no pair is made for each
    token that it shares, and pairs are not shuffled.
    """
    key = F.unhex(F.md5(F.concat(F.length("country").cast("string"), F.lit(":"), "country", F.array_join("tokens", " "))))

    def classes(d: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = d.where("country IS NOT NULL").select("entity_id", "country", F.array_distinct(t.significant_tokens(t.normalize_text(name))).alias("tokens"))
        # An id that has several names in a country has the tokens of all of them.
        rows = rows.groupBy("entity_id", "country").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("tokens")))).alias("tokens"))
        rows = written(rows.where(F.size("tokens") > 0).withColumn("key", key), "tokens")
        return rows, written(_token_classes(rows), "token-classes")

    (left, q), (right, p) = classes(s1), classes(cands)
    tasks = int(s1.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nq, np_ = (x.groupBy("country").agg(F.ceil(F.count("*") / size).cast("int").alias(n)) for x, size, n in ((q, TOKEN_TILES[0], "ni"), (p, TOKEN_TILES[1], "nj")))
    counts = written(nq.join(np_, "country"), "cells")
    tile = lambda n: F.expr(f"CAST(pmod(xxhash64(key, piece), {n}) AS INT)")
    each = lambda n: F.explode(F.expr(f"sequence(0, {n} - 1)"))
    q = q.join(counts, "country").select("country", tile("ni").alias("i"), each("nj").alias("j"), F.lit(1).alias("side"), "tokens", "ids")
    p = p.join(counts, "country").select("country", each("ni").alias("i"), tile("nj").alias("j"), F.lit(0).alias("side"), "tokens", "ids")
    cells = q.unionByName(p).repartition(2 * tasks, "country", "i", "j").sortWithinPartitions("country", "i", "j", "side")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: list[tuple[list[str], pa.Array]] = []
        bits, asked, given = None, [], 0

        def out() -> pa.RecordBatch:
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), pa.concat_arrays(x)) for x in zip(*asked, strict=True)]
            return pa.RecordBatch.from_arrays(lists, ["s1_ids", "cand_ids"])

        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            ids = batch.column("ids")
            for n, (side, tokens) in enumerate(zip(batch.column("side").to_pylist(), batch.column("tokens").to_pylist(), strict=True)):
                if side == 0:
                    if bits is not None:
                        pool, bits = [], None
                    pool.append((tokens, ids[n].values))
                    continue
                if bits is None:
                    place: dict[str, int] = {}
                    at = np.array([(place.setdefault(x, len(place)), c) for c, (own, _) in enumerate(pool) for x in own], np.int64).reshape(-1, 2)
                    bits = np.zeros((len(place), (len(pool) + 7) // 8), np.uint8)
                    np.bitwise_or.at(bits, (at[:, 0], at[:, 1] >> 3), (1 << (at[:, 1] & 7)).astype(np.uint8))
                    flat = pa.concat_arrays([x for _, x in pool])
                    sizes = np.array([len(x) for _, x in pool])
                    classes = np.repeat(np.arange(len(pool)), sizes)
                rows = [place[x] for x in tokens if x in place]
                if not rows:
                    continue
                hit = np.unpackbits(np.bitwise_or.reduce(bits[rows], axis=0), bitorder="little", count=len(pool)).astype(bool)
                found = flat.take(pa.array(np.flatnonzero(hit[classes])))
                every = ids[n].values
                for i in range(0, len(every), OWN_TOGETHER):
                    own = every[i : i + OWN_TOGETHER]
                    width = max(PAIRS_TOGETHER // len(own), 1)
                    asked += [(own, found[j : j + width]) for j in range(0, len(found), width)]
                    given += len(found)
                    if given >= GIVEN_OUT:
                        yield out()
                        asked, given = [], 0
        if asked:
            yield out()

    kinds = {n: d.schema["entity_id"].dataType.simpleString() for n, d in (("s1_ids", s1), ("cand_ids", cands))}
    lists = cells.mapInArrow(match, f"s1_ids array<{kinds['s1_ids']}>, cand_ids array<{kinds['cand_ids']}>")
    pairs = lists.select(F.explode("s1_ids").alias("s1_id"), "cand_ids").select("s1_id", F.explode("cand_ids").alias("cand_id"))
    several = [not x.groupBy("entity_id").count().where("count > 1").isEmpty() for x in (left, right)]
    # Only ids of several countries on both sides could meet twice.
    return pairs.distinct() if all(several) else pairs


def exact_matches(s1: DataFrame, cands: DataFrame) -> DataFrame:
    """(s1_id, cand_id) of equal clean names within a country, all of them; names of under two characters don't match."""
    rows = lambda d, i: d.select(F.col("entity_id").alias(i), "country", t.clean_business_name("business_name").alias("name")).where("name <> ''")
    return rows(s1, "s1_id").join(rows(cands, "cand_id"), ["country", "name"]).select(*PAIR)


def vocabulary_matches(s1: DataFrame, cands: DataFrame, most: dict[str, int] | None = None) -> DataFrame:
    """(s1_id, cand_id, rank) by normalized name alone, only names that S1 has, the first ids of each source.

    ``most`` caps by id prefix: 5 of S2 and 6 of S3.
    """
    caps = most or {"S2-": 5, "S3-": 6}
    left = s1.select(F.col("entity_id").alias("s1_id"), t.normalize_name("business_name").alias("name")).where("name <> ''")
    right = cands.select(F.col("entity_id").alias("cand_id"), t.normalize_name("business_name").alias("name")).join(left.select("name").distinct(), "name", "left_semi")
    prefix = F.substring("cand_id", 1, 3)
    cap = F.create_map(*[F.lit(x) for kv in caps.items() for x in kv])[prefix]
    ranked = right.withColumn("rank", F.row_number().over(Window.partitionBy("name", prefix).orderBy("cand_id"))).where(F.col("rank") <= cap)
    return left.join(ranked, "name").select(*PAIR, "rank")


def coverage(pairs: DataFrame, s1: DataFrame, within: str = "country") -> DataFrame:
    """Share of S1 rows with a candidate, by ``within``."""
    has = pairs.select("s1_id").distinct().withColumn("hit", F.lit(1))
    rows = s1.select(F.col("entity_id").alias("s1_id"), within).join(has, "s1_id", "left")
    return rows.groupBy(within).agg(F.count("*").alias("n_s1"), F.count("hit").alias("n_covered"), (F.count("hit") / F.count("*")).alias("coverage"))
