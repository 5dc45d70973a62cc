"""Readers and writers of entity tables, id maps, pair files and model metadata."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkweave.functions.text import id_list
from linkweave.sources.scratch import written

ENTITY_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
TRUTH_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])
NULL_TOKENS = ("", "NULL", "null", "None")
CODECS = ("zstd", "snappy", "lz4", "uncompressed")
DATASET_NAMES = tuple(f"{split}_{part}.tsv" for split in ("train", "test") for part in ("source1", "source2", "source3")) + ("train_ground_truth.tsv",)
ID_COLUMNS = ("entity_id", "source1_entity_id", "source2_entity_id", "source3_entity_id", "id")


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = ENTITY_SCHEMA, columns: Iterable[str] | None = None, limit: int | None = None) -> DataFrame:
    """Tab-separated rows with a header, no quoting; the null tokens become null.

    ``limit`` takes the first rows by the first column, so reruns agree.
    """
    df = spark.read.csv(path, sep="\t", quote="", header=True, schema=schema, emptyValue="", nullValue="")
    df = df.select(*[F.when(~F.col(f.name).isin(*NULL_TOKENS), F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema])
    if columns:
        df = df.select(*columns)
    return df.orderBy(df.columns[0]).limit(limit) if limit else df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines cut at tabs, for files whose number of columns is in question."""
    return spark.read.text(path).select(F.split("value", "\t").alias("parts"))


def read_either(spark: SparkSession, parquet: str, tsv: str, schema: T.StructType = ENTITY_SCHEMA) -> DataFrame:
    """The Parquet table if there is one, else the TSV file."""
    return spark.read.parquet(parquet) if exists(spark, parquet) else read_tsv(spark, tsv, schema)


def _store(spark: SparkSession, path: str):
    """The path as the store's own object, and the store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in whatever store it is."""
    at, store = _store(spark, path)
    return store.exists(at)


def first_existing(spark: SparkSession, paths: Iterable[str]) -> str:
    """The first of ``paths`` that is there."""
    tried = list(paths)
    for path in tried:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of {tried}")


def find_dataset(spark: SparkSession, roots: Iterable[str], names: Iterable[str] = DATASET_NAMES) -> dict[str, str]:
    """Paths of the known files under the roots, in any store; of each name the first hit, by root and then by path."""
    found: dict[str, str] = {}
    wanted = set(names)
    for root in roots:
        at, store = _store(spark, root)
        if not store.exists(at):
            continue
        listed, here = store.listFiles(at, True), []
        while listed.hasNext():
            file = listed.next().getPath()
            if file.getName() in wanted:
                here.append((file.toString(), file.getName()))
        for path, name in sorted(here):
            found.setdefault(name, path)
    return found


def looked_up(df: DataFrame, ids: Iterable[str], column: str = "entity_id") -> DataFrame:
    """The rows of a few ids; the filter reaches the scan."""
    return df.where(F.col(column).isin(list(ids)))


def id_column(df: DataFrame, names: Iterable[str] = ID_COLUMNS) -> str:
    """The first of the known id column names that ``df`` has."""
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"no id column among {df.columns}")


def entity_ids(*frames: DataFrame) -> DataFrame:
    """Distinct ids of entity tables, and of the lists in truth tables."""
    parts = []
    for df in frames:
        parts.append(df.select(F.trim(F.col(id_column(df)).cast("string")).alias("entity_id")))
        if "matched_entity_ids" in df.columns:
            parts.append(df.select(F.explode(id_list("matched_entity_ids")).alias("entity_id")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("entity_id IS NOT NULL AND entity_id <> ''").distinct()


def in_order(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """``df`` numbered from 0 without gaps in ``order``, which has no ties.

    Rows are dealt into ranges of the order, as many as there are shuffle
    partitions; each is numbered by itself and shifted by the count of those
    before, of which one number each comes to the driver.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    shift, starts = 0, []
    for r in dealt.groupBy("_range").count().orderBy("_range").collect():
        starts.append((r["_range"], shift))
        shift += r["count"]
    before = F.broadcast(spark.createDataFrame(starts, "_range int, _before long"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_n", place).join(before, "_range").withColumn(out, F.col("_before") + F.col("_n") - 1).drop("_range", "_before", "_n")


def id_map(ids: DataFrame) -> DataFrame:
    """(entity_id, entity_id_int): ids in order, numbered from 0 without gaps; ``ids`` are distinct."""
    return in_order(ids.select("entity_id"), ["entity_id"], "entity_id_int")


#: Id maps of up to so many rows are broadcast, so that the rows that ask for ids stay where they are.
MOST_SENT = 1 << 20


def _sent(ids: DataFrame) -> DataFrame:
    """``ids`` with a hint to broadcast it if its rows are few."""
    return F.broadcast(ids) if ids.count() <= MOST_SENT else ids


def with_id_ints(df: DataFrame, ids: DataFrame, column: str = "entity_id", out: str = "entity_id_int") -> DataFrame:
    """``df`` with the number of an id; null for an id the map lacks."""
    right = ids.select(F.col("entity_id").alias("_id"), F.col("entity_id_int").alias(out))
    return df.join(_sent(right), F.col(column) == F.col("_id"), "left").drop("_id")


def decoded_pairs(pairs: DataFrame, ids: DataFrame, left: str = "s1_int", right: str = "cand_int") -> DataFrame:
    """Pairs of numbers as pairs of ids (s1_id, cand_id)."""
    one = ids.select(F.col("entity_id_int").alias(left), F.col("entity_id").alias("s1_id"))
    two = ids.select(F.col("entity_id_int").alias(right), F.col("entity_id").alias("cand_id"))
    return pairs.join(_sent(one), left, "left").join(_sent(two), right, "left").drop(left, right)


def convert_tsv(spark: SparkSession, tsv: str, parquet: str, codec: str = "zstd", ids: DataFrame | None = None, schema: T.StructType = ENTITY_SCHEMA) -> int:
    """TSV to Parquet, with id numbers if a map is given; the number of rows written."""
    if codec not in CODECS:
        raise ValueError(f"codec {codec}")
    df = read_tsv(spark, tsv, schema)
    if ids is not None:
        df = with_id_ints(df, ids, id_column(df))
    write_parquet(df, parquet, codec)
    return spark.read.parquet(parquet).count()


def write_parquet(df: DataFrame, path: str, codec: str = "zstd") -> None:
    """Replaces the table at ``path``, which ``df`` may read: written beside it, then moved there, so that readers find the old table or the new one.

    A failed write leaves the old table as it was.
    """
    spark = df.sparkSession
    at, store = _store(spark, path)
    fresh, old = (_store(spark, f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}")[0] for kind in ("new", "old"))
    df.write.option("compression", codec).parquet(fresh.toString())
    had = store.exists(at)
    if had and not store.rename(at, old):
        raise OSError(f"can't move {path} aside")
    if not store.rename(fresh, at):
        if had:
            store.rename(old, at)
        raise OSError(f"can't move the new table to {path}")
    if had:
        store.delete(old, True)


def append_parquet(df: DataFrame, path: str, rows_per_file: int = 1_000_000, codec: str = "zstd") -> None:
    """Adds rows to the table at ``path`` in files of bounded length; tasks write as they go, so no chunk is held."""
    df.write.mode("append").option("compression", codec).option("maxRecordsPerFile", rows_per_file).parquet(path)


def pair_lists(pairs: DataFrame, entities: DataFrame, out: str, order: list | None = None, most: int | None = None, within: tuple[str, ...] = ()) -> DataFrame:
    """One row for each entity of ``entities`` (s1_id, ordinal): its candidates comma-joined in order, empty if none.

    ``within`` names columns that s1_id decides and by which the pairs are partitioned already: then lists move, and no pairs.
    """
    key = F.struct(*(order or [F.col("priority_rank")]), F.col("cand_id").alias("_id"))
    ids = F.transform(F.array_sort(F.collect_list(key)), lambda x: x["_id"])
    lists = pairs.groupBy(*within, "s1_id").agg(F.array_join(F.slice(ids, 1, most) if most else ids, ",").alias(out)).drop(*within)
    return entities.join(lists, "s1_id", "left").withColumn(out, F.coalesce(out, F.lit("")))


def write_tsv(df: DataFrame, path: str, ordinal: str | None = None, parts: bool = False) -> None:
    """One TSV file with header, no quotes, in the order of ``ordinal`` if given; with ``parts`` as many as there are tasks, each with a header."""
    rows = df.orderBy(ordinal).drop(ordinal) if ordinal else df
    (rows if parts else rows.coalesce(1)).write.mode("overwrite").csv(path, sep="\t", quote="", header=True, emptyValue="")


def write_metadata(spark: SparkSession, path: str, metadata: dict) -> None:
    """A JSON file in any store, replaced if it is there."""
    at, store = _store(spark, path)
    out = store.create(at, True)
    try:
        out.write(bytearray(json.dumps(metadata, indent=2, sort_keys=True).encode()))
    finally:
        out.close()


def read_metadata(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def entity_lists(spark: SparkSession, data, id_col: str = "source1_entity_id", list_col: str = "matched_entity_ids") -> tuple[DataFrame, DataFrame]:
    """(entities, pairs): s1_id of every entity, and (s1_id, cand_id), of a table, a pandas frame, a Parquet or TSV path, or a dict of lists.

    Ids stand comma-joined in the list column, or as arrays. Without the named
    columns the known ones are taken, else the first two.
    """
    if isinstance(data, dict):
        rows = [(str(k), v if isinstance(v, str) else ",".join(sorted(str(x) for x in v))) for k, v in data.items()]
        df = spark.createDataFrame(rows, f"{id_col} string, {list_col} string")
    elif isinstance(data, DataFrame):
        df = data
    elif hasattr(data, "to_dict"):
        df = spark.createDataFrame(data.astype(object).where(data.notna(), None))
    elif str(data).rstrip("/").endswith(".parquet"):
        df = spark.read.parquet(str(data))
    else:
        df = spark.read.csv(str(data), sep="\t", quote="", header=True, emptyValue="", nullValue="")
    pick = lambda wanted, known, place: next((c for c in (wanted, *known) if c in df.columns), df.columns[place])
    one = pick(id_col, ID_COLUMNS, 0)
    two = pick(list_col, ("matched_entity_ids", "candidate_entity_ids"), 1)
    ids = F.col(two) if dict(df.dtypes)[two].startswith("array") else id_list(two)
    listed = df.select(F.col(one).cast("string").alias("s1_id"), ids.alias("ids"))
    return listed.select("s1_id").distinct(), listed.select("s1_id", F.explode("ids").alias("cand_id")).distinct()


def cached(spark: SparkSession, path: str, build) -> DataFrame:
    """The table at ``path``, built and written first if it isn't there."""
    if not exists(spark, path):
        write_parquet(build(), path)
    return spark.read.parquet(path)
