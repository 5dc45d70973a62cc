"""Plans that hold where a name is frequent: pairs dealt by one side, scans made once, lists cut before they are made."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linkweave.operators import assign, blocking, metrics
from linkweave.plans import registry
from linkweave.plans import views as v
from linkweave.sources import tables


@pytest.fixture(scope="module")
def frequent(spark, tmp_path_factory):
    """200 documents, 150 of one name and five languages."""
    at = tmp_path_factory.mktemp("frequent")
    rows = [(i, ("Same name" if i % 4 else f"Name {i % 3}") + f"\n{i % 7}", "en" if i % 5 else "de", "web", 10 + i % 2) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    return str(at)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_frequent_name_is_dealt(spark, frequent, monkeypatch):
    """Every pair once, those of an id together, about as many in each part as are allowed."""
    monkeypatch.setattr(v, "PAIRS_EACH", 200)
    s1, pool = v.sides(v.entities(spark, frequent))
    on = ["country", "business_name"]
    want = {(r[0], r[1]) for r in s1.select(F.col("entity_id").alias("a"), *on).join(pool.select(F.col("entity_id").alias("b"), *on), on).select("a", "b").collect()}
    for each in ("s1_id", "cand_id"):
        rows = v.dealt_pairs(spark, frequent, each).collect()
        assert len(rows) == len(want) and {(r["s1_id"], r["cand_id"]) for r in rows} == want
        parts, sizes = defaultdict(set), defaultdict(int)
        for r in rows:
            parts[r[each]].add((r["name_key"], r["deal"]))
            sizes[bytes(r["name_key"]), r["deal"]] += 1
        assert all(len(x) == 1 for x in parts.values())
        assert len(sizes) > 10 and max(sizes.values()) < 1000 < len(want)


def test_no_pair_moves_for_the_top_of_its_s1(spark, frequent):
    """the windows of an S1 lie where its pairs are made; two shuffles make the sides, none follows the join."""
    plan = plan_of(assign.top_per(v.dealt_scores(spark, frequent), [*v.DEALT, "s1_id"], [F.desc("p"), F.col("cand_id")], 4))
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")]


@pytest.mark.parametrize("width", [1, 2, 32])
def test_greedy_from_the_first_of_each_candidate(spark, monkeypatch, width):
    """whatever the first width, greedy takes what a scan takes, and a sweep scans once."""
    monkeypatch.setattr(assign, "FIRST_OF_EACH", width)
    monkeypatch.setattr(assign, "WIDER", 2)
    rng = random.Random(7)
    rows = [(f"S1-{s}", f"S2-{c}", rng.randint(1, 20) / 20) for s in range(4) for c in range(30)]
    df, used, free, want = spark.createDataFrame(rows, "s1_id string, cand_id string, p double"), defaultdict(int), set(), set()
    for s, c, p in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if p >= 0.2 and c not in free and used[s] < 3:
            used[s] += 1
            free.add(c)
            want.add((s, c))
    assert {(r["s1_id"], r["cand_id"]) for r in assign.assign_greedy(df, 0.2, most=3).collect()} == want
    seen = []
    monkeypatch.setattr(metrics, "assign_greedy", lambda pairs, tau, **_: seen.append(pairs.columns) or assign.assign_greedy(pairs, tau))
    metrics.greedy_sweep(df.select("s1_id").distinct(), df.select("s1_id", "cand_id").limit(3), df, [0.2, 0.5, 0.9]).collect()
    assert len(seen) == 1 and "tau" not in seen[0]


def test_ids_of_few_rows_are_sent(spark):
    """neither coding nor decoding deals the pairs anew."""
    ids = tables.id_map(spark.createDataFrame([(f"S{i}",) for i in range(9)], "entity_id string"))
    pairs = spark.range(20).select(F.concat(F.lit("S"), F.col("id") % 9).alias("s1_id"), F.concat(F.lit("S"), F.col("id") % 7).alias("cand_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    coded = tables.with_id_ints(tables.with_id_ints(pairs, ids, "s1_id", "s1_int"), ids, "cand_id", "cand_int").drop("s1_id", "cand_id")
    back = tables.decoded_pairs(coded, ids)
    plan = plan_of(back)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, pairs.collect()))


def test_lists_are_cut_before_they_are_made(spark, frequent, monkeypatch):
    """no list of more than two ids of a source is made."""
    seen = []
    real = tables.pair_lists
    monkeypatch.setattr(tables, "pair_lists", lambda pairs, *a, **k: seen.append(pairs.groupBy("s1_id").count().agg(F.max("count")).first()[0]) or real(pairs, *a, **k))
    registry.cap_ids(spark, frequent)
    assert seen == [4]


def test_merging_moves_no_pair(spark, frequent):
    """F16: parts that are partitioned alike are merged where they lie."""
    pairs = v.dealt_scores(spark, frequent)
    one, two = pairs.where("p < 0.6").drop("p").withColumn("priority_rank", F.lit(1)), pairs.where("p >= 0.4").withColumnRenamed("p", "semantic_score")
    merged = blocking.merge_candidates(one, two, within=v.DEALT)
    plan = plan_of(merged)
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")]
    assert merged.count() == pairs.count()


def test_recall_of_lists(spark, tmp_path):
    """candidate files in parts, an entity in two lines, an empty list; as the pairs give it."""
    rows = [("S1-1", "S2-1,S2-2"), ("S1-1", "S2-2,S3-1"), ("S1-2", ""), ("S1-3", "S2-9")]
    df = spark.createDataFrame(rows, "s1_id string, ids string").repartition(3)
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-5"), ("S1-3", "S2-9"), ("S1-4", "S2-9")], "s1_id string, cand_id string")
    tables.write_tsv(df, str(tmp_path / "out"), parts=True)
    assert len(list((tmp_path / "out").glob("part-*"))) > 1
    got = metrics.written_recall(spark, str(tmp_path / "out"), truth).first()
    pairs = df.select("s1_id", F.explode(F.split("ids", ",")).alias("cand_id")).where("cand_id <> ''")
    assert got.asDict() == metrics.blocking_recall(truth, pairs).first().asDict()
    assert (got["total"], got["captured"], got["n_pairs"]) == (4, 2, 4)
