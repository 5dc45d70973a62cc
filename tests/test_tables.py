"""Sources and sinks, adapters, audits, sweeps and the encoder hook."""

import os
import random
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from linkweave.functions import text as t
from linkweave.operators import assign, blocking, metrics, model, validate, vectors
from linkweave.sources import tables


def test_find_dataset(spark, tmp_path):
    for folder, name in (("a/x", "train_source1.tsv"), ("b", "train_source1.tsv"), ("b", "test_source2.tsv"), ("b", "other.tsv")):
        os.makedirs(tmp_path / folder, exist_ok=True)
        (tmp_path / folder / name).write_text("x\n")
    got = tables.find_dataset(spark, [str(tmp_path / "none"), str(tmp_path / "a"), str(tmp_path / "b")])
    assert {k: os.path.basename(os.path.dirname(v)) for k, v in got.items()} == {"train_source1.tsv": "x", "test_source2.tsv": "b"}


def test_replacing_a_table_that_is_read(spark, tmp_path):
    """The old table stays until the new one is there, and may be read to make it."""
    path = str(tmp_path / "t")
    tables.write_parquet(spark.range(5).toDF("x"), path)
    tables.write_parquet(spark.read.parquet(path).withColumn("x", F.col("x") * 2), path)
    assert sorted(r["x"] for r in spark.read.parquet(path).collect()) == [0, 2, 4, 6, 8]

    @F.udf("long")
    def fails(x):
        raise ValueError("no")

    with pytest.raises(Exception, match="no"):
        tables.write_parquet(spark.read.parquet(path).select(fails("x").alias("x")), path)
    assert spark.read.parquet(path).count() == 5
    tables.append_parquet(spark.range(10).toDF("x"), path, rows_per_file=3)
    assert spark.read.parquet(path).count() == 15
    assert tables.cached(spark, path, lambda: 1 / 0).count() == 15
    assert tables.cached(spark, str(tmp_path / "new"), lambda: spark.range(2)).count() == 2
    assert sorted(x for x in os.listdir(tmp_path) if ".old-" in x) == []


def test_metadata_and_lines(spark, tmp_path):
    path = str(tmp_path / "m.json")
    tables.write_metadata(spark, path, {"b": 1, "a": ["é"]})
    tables.write_metadata(spark, path, {"b": 2, "a": ["é"]})
    assert tables.read_metadata(spark, path) == {"b": 2, "a": ["é"]}
    (tmp_path / "l.tsv").write_text("a\tb\nc\n")
    assert sorted(tuple(r["parts"]) for r in tables.read_lines(spark, str(tmp_path / "l.tsv")).collect()) == [("a", "b"), ("c",)]
    (tmp_path / "s.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tX\tY\tus\nS1-2\tX\tY\tus\n")
    rows = tables.read_either(spark, str(tmp_path / "s.parquet"), str(tmp_path / "s.tsv"))
    assert rows.count() == 2 and [r["entity_id"] for r in tables.looked_up(rows, ["S1-2", "S1-9"]).collect()] == ["S1-2"]


def test_entity_lists(spark, tmp_path):
    """The same entities and pairs from a dict, a pandas frame, a table, an array column and files."""
    lists = {"S1-1": "S2-2, S2-1,", "S1-2": "", "S1-3": "S3-1"}
    frame = pd.DataFrame({"source1_entity_id": list(lists), "matched_entity_ids": [x or None for x in lists.values()]})
    table = spark.createDataFrame([(k, x) for k, x in lists.items()], "id string, candidate_entity_ids string")
    arrays = spark.createDataFrame([("S1-1", ["S2-1", "S2-2"]), ("S1-2", []), ("S1-3", ["S3-1"])], "a string, b array<string>")
    table.write.parquet(str(tmp_path / "p.parquet"))
    frame.to_csv(tmp_path / "f.tsv", sep="\t", index=False)
    for data in (lists, {k: [x.strip() for x in v.split(",") if x.strip()] for k, v in lists.items()}, frame, table, arrays, str(tmp_path / "p.parquet"), str(tmp_path / "f.tsv")):
        entities, pairs = tables.entity_lists(spark, data)
        assert {r["s1_id"] for r in entities.collect()} == set(lists)
        assert {tuple(r) for r in pairs.collect()} == {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-3", "S3-1")}


def test_numbers_in_order(spark):
    rng = random.Random(1)
    ids = [f"S1-{rng.randint(0, 10**9):010d}" for _ in range(500)]
    got = {r["entity_id"]: r["entity_id_int"] for r in tables.id_map(spark.createDataFrame([(x,) for x in set(ids)], "entity_id string")).collect()}
    assert got == {x: i for i, x in enumerate(sorted(set(ids)))}
    assert tables.id_map(spark.createDataFrame([], "entity_id string")).count() == 0


def test_audit(spark, tmp_path):
    m, c = str(tmp_path / "m"), str(tmp_path / "c")
    expected = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    out = lambda rows, column, path: tables.write_tsv(spark.createDataFrame(rows, f"source1_entity_id string, {column} string"), path)
    out([("S1-1", "S2-1"), ("S1-2", "")], "matched_entity_ids", m)
    out([("S1-1", "S2-1,S3-1"), ("S1-2", "S2-2")], "candidate_entity_ids", c)
    fine = validate.audited(spark, m, c, expected)
    assert validate.exit_code(fine) == 0 and validate.audit_lines(fine) == ["no violations"]
    out([("S1-1", "S2-9"), ("S1-1", "S2-9")], "wrong", m)
    found = validate.audited(spark, m, c, expected, known=spark.createDataFrame([("S2-1",), ("S2-2",), ("S3-1",)], "entity_id string"))
    assert {r["check"] for r in found.collect()} == {"header", "not_a_candidate", "matches:missing_entity", "matches:repeated_entity", "matches:unknown_id"}
    assert validate.exit_code(found) == 1 and len(validate.audit_lines(found)) == 5
    gone = validate.audited(spark, str(tmp_path / "none"), c, expected)
    assert {r["check"] for r in gone.collect()} >= {"file:missing", "matches:missing_entity"}
    small = validate.audited(spark, m, c, expected, most=3)
    assert {r["check"] for r in small.collect()} >= {"file:too large"}
    truth = spark.createDataFrame([("S1-1", "S3-1"), ("S1-2", "S2-7")], "s1_id string, cand_id string")
    row = metrics.written_recall(spark, c, truth).first()
    assert (row["total"], row["captured"], row["n_pairs"], row["recall_pct"]) == (2, 1, 3, 50.0)


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(6)
    rows = sorted({(f"S1-{rng.randint(0, 12)}", f"S{rng.randint(2, 3)}-{rng.randint(0, 25)}") for _ in range(150)})
    rows = [(s, c, round(rng.random(), 2), rng.randint(1, 9)) for s, c in rows]
    pairs = spark.createDataFrame(rows, "s1_id string, cand_id string, p double, rank int")
    truth = spark.createDataFrame([r[:2] for r in rows if rng.random() < 0.3], "s1_id string, cand_id string")
    return pairs.select("s1_id").distinct(), truth, pairs


def test_sweeps_are_their_single_runs(scored):
    """Each row of a sweep in one plan is what its threshold gives by itself."""
    entities, truth, pairs = scored
    plain = lambda df: {tuple(r.asDict().items()) for r in df.collect()}
    taus = [0.3, 0.5, 0.8]
    for sweep, single in ((metrics.greedy_sweep, assign.assign_greedy), (metrics.order_sweep, assign.assign_in_order)):
        rows = sweep(entities, truth, pairs, taus)
        for tau in taus:
            assert plain(rows.where(F.col("tau") == tau).drop("tau")) == plain(metrics.evaluate(entities, truth, single(pairs, tau)))
    grid = metrics.anchor_grid(entities, truth, pairs, [0.6, 0.9], taus)
    assert grid.count() == 6
    for anchor in (0.6, 0.9):
        row = grid.where((F.col("anchor") == anchor) & (F.col("tau") == 0.5)).drop("anchor", "tau")
        assert plain(row) == plain(metrics.evaluate(entities, truth, assign.assign_anchor(pairs, anchor, 0.5)))
    best = metrics.best_threshold(metrics.threshold_sweep(entities, truth, pairs)).first()
    board = {r["approach"]: r for r in metrics.scoreboard(entities, truth, pairs).collect()}
    assert board["model"]["f05_macro"] == best["f05_macro"] and board["model"]["tau"] == best["tau"] and board["heuristic"]["delta_f05"] == 0


def test_greedy_with_repeated_pairs(spark):
    """A pair that is there twice is one pair, and a chain longer than any limit of rounds ends."""
    rows = [("S1-1", "S2-1", 0.9), ("S1-1", "S2-1", 0.9), ("S1-2", "S2-1", 0.8)]
    got = assign.assign_greedy(spark.createDataFrame(rows, "s1_id string, cand_id string, p double"), 0.1, most=1)
    assert [tuple(r) for r in got.collect()] == [("S1-1", "S2-1", 0.9)]


def test_splits(spark):
    rows = spark.createDataFrame([(f"S1-{i % 20:02d}", i) for i in range(60)] + [(None, 60)], "s1_id string, x int")
    first = {r["s1_id"]: r["split"] for r in model.prefix_split(rows).collect()}
    assert [k for k, s in sorted((k, s) for k, s in first.items() if k) if s == "train"] == [f"S1-{i:02d}" for i in range(12)] and first[None] is None
    a, b, c = ({r["s1_id"]: r["split"] for r in model.shuffled_split(rows.repartition(n), seed=seed).collect()} for n, seed in ((1, 1), (5, 1), (2, 2)))
    assert a == b != c and sum(s == "train" for s in a.values()) == 12


def test_encoder_hook(spark):
    """Whole tables in batches, the encoder made once for each task; mean-pooled word vectors as a stand-in."""

    def encoder():
        def encode(texts):
            words = [x.split() or [""] for x in texts]
            return np.array([np.mean([[len(w), sum(map(ord, w)) % 97, 1.0] for w in ws], axis=0) for ws in words])

        return encode

    names = ["acme ltd", "acme limited", "zebra", None, ""] * 3
    rows = spark.createDataFrame([(f"S{1 + (i > 7)}-{i}", "all", n) for i, n in enumerate(names)], "id string, part string, text string")
    found = vectors.encoded(rows, encoder).collect()
    assert len(found) == 15 and all(np.allclose(r["vector"], encoder()([r["text"] or ""])[0], rtol=1e-6) for r in found)
    frame = vectors.encoded(rows, encoder)
    pairs = vectors.semantic_candidates(vectors.dense_top_k(frame.where("id LIKE 'S1%'"), frame.where("id LIKE 'S2%'"), top_k=2))
    assert pairs.columns == ["s1_id", "cand_id", "semantic_score"] and pairs.count() == 16


def test_blocking_wrappers(spark):
    keys = "entity_id string, country string, name_token_sorted_key string, name_no_legal string, address_clean string, street_number string, first_token string, second_token string, domain_root string, source_type int"
    s1 = spark.createDataFrame([("S1-1", "us", "a b", "a b", "", "", "a", "b", "", 1)], keys)
    pool = spark.createDataFrame([(f"S2-{i}", "us", "a b", "a b", "", "", "a", "b", "", 2) for i in range(30)], keys)
    assert blocking.run_blocking(s1, pool, most=7).count() == 7
    got = blocking.block_to_pairs(s1, pool)
    assert got.columns == ["s1_id", "cand_id"] and got.count() == 20


def test_importances(spark):
    rng = random.Random(5)
    rows = [(f"S1-{i}", rng.random() / 2 + i % 2 / 2, rng.random(), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "s1_id string, f double, g double, target int")
    found = model.importances(model.fit(df, ["g", "f"], trees=3, depth=2), ["g", "f"])
    assert [n for n, _ in found] == ["f", "g"] and found[0][1] > 0.8


def test_phonetic_first_token(spark):
    rows = spark.createDataFrame([("Robert Co",), ("rupert",), ("",), (None,)], "n string")
    got = [r[0] for r in rows.select(t.phonetic_first_token(t.clean_text("n"))).collect()]
    assert got[0] == got[1] and got[0] and not got[2] and not got[3]


@pytest.mark.parametrize("step", [3, 8_192])
def test_sparse_products(step, monkeypatch):
    monkeypatch.setattr(vectors, "STEP", step)
    rng = np.random.default_rng(4)
    x, y = (np.where(rng.random((n, 40)) < 0.1, rng.random((n, 40)), 0) for n in (30, 17))
    packed = []
    for m in (x, y):
        r, c = np.nonzero(m)
        z = np.zeros(len(r), vectors._SPARSE)
        z["row"], z["gram"], z["weight"] = r, c * 7 - 90, m[r, c]
        packed.append(z)
    assert np.allclose(vectors._sparse_products(packed[0], 30, packed[1], 17), x @ y.T)
    assert not vectors._sparse_products(packed[0], 30, packed[1][:0], 17).any()


def test_tfidf_over_many_tiles(spark, monkeypatch):
    """The same neighbours whatever the tiles."""
    rng = random.Random(3)
    name = lambda: " ".join("".join(rng.choice("abcd") for _ in range(5)) for _ in range(2))
    pool = spark.createDataFrame([(f"p{i}", "xy"[i % 2], name()) for i in range(60)], "id string, part string, text string")
    s1 = spark.createDataFrame([(f"s{i}", "xy"[i % 2], name()) for i in range(25)] + [("s-", "z", "lonely"), ("s0-", "x", None)], "id string, part string, text string")
    whole = {tuple(r) for r in vectors.tfidf_top_k(s1, pool, 5, 0.1).collect()}
    monkeypatch.setattr(vectors, "SPARSE_TILES", (4, 7))
    assert {tuple(r) for r in vectors.tfidf_top_k(s1, pool, 5, 0.1).collect()} == whole and len(whole) > 30


def test_sparse_products_hold_few_at_once():
    """Many common grams make no dense block (F2, F3, F5: 60,000 grams x 512 rows were 245 MB)."""
    rng = np.random.default_rng(5)
    packed = []
    for n in (8, 512):
        z = np.zeros(60_000, vectors._SPARSE)
        z["row"], z["gram"], z["weight"] = np.sort(rng.integers(0, n, 60_000)), rng.permutation(60_000), 0.5
        packed.append(z)
    tracemalloc.start()
    out = vectors._sparse_products(packed[0], 8, packed[1], 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.sum() == 15_000 and peak < 64 << 20


def test_tfidf_compares_equal_texts_once_and_finds_all(spark, monkeypatch):
    """Copies on both sides, frequent and rare grams, against all products of ``tfidf``."""
    rng = random.Random(8)
    name = lambda: " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(2, 7))) for _ in range(rng.randrange(1, 4)))
    texts = [name() for _ in range(40)]
    rows = [(f"s{i:03}", "xy"[i % 2], texts[i % 40 if i % 3 else 0]) for i in range(90)], [(f"p{i:03}", "xy"[i % 2], texts[i % 40 if i % 4 else 2]) for i in range(150)]
    s1, pool = (spark.createDataFrame(x, "id string, part string, text string") for x in rows)
    w = {}
    for r in vectors.tfidf(s1, pool).union(vectors.tfidf(pool, pool)).collect():
        w.setdefault((r["id"], r["part"]), {})[r["gram"]] = r["weight"]
    want = set()
    for a, part, _ in rows[0]:
        sims = [(-round(sum(x * w.get((b, part), {}).get(g, 0) for g, x in w.get((a, part), {}).items()), 9), b) for b, other, _ in rows[1] if other == part]
        want |= {(a, b, -s) for s, b in sorted(sims)[:5] if -s >= 0.1}
    for width, step in ((4_096, 1_024), (8, 7)):
        monkeypatch.setattr(vectors, "DENSE_GRAMS", width)
        monkeypatch.setattr(vectors, "POOL_STEP", step)
        got = {(r["s1_id"], r["cand_id"]): r["similarity"] for r in vectors.tfidf_top_k(s1, pool, 5, 0.1).collect()}
        assert set(got) == {(a, b) for a, b, _ in want} and all(abs(got[a, b] - s) < 2e-9 for a, b, s in want)
    assert vectors._distinct_texts(s1.withColumn("key", F.md5("text"))).count() < 60


def test_grams_in_python_are_those_of_spark(spark):
    df = spark.createDataFrame([("",), ("ab",), ("a bcd  é\U0001f600xyz",), (" lead and trail ",)], "t string")
    for by_word in (False, True):
        for r in df.select("t", vectors.char_grams(F.col("t"), by_word=by_word).alias("g")).collect():
            assert sorted(r["g"]) == sorted(vectors._grams_of(r["t"], by_word=by_word))


@pytest.mark.parametrize("family", ["boosted", "linear"])
def test_equal_rows_are_fitted_and_scored_once(spark, family, monkeypatch):
    """20,000 rows of 40 kinds are 40 rows with weights (F6), and the scores are those of every row."""
    seen = []
    fit = model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, df: seen.append(df.count()) or fit(self, df))
    rows = spark.range(20_000).select("id", (F.col("id") % 20).cast("double").alias("f"), (F.col("id") % 7 % 2).cast("int").alias("target"), F.when(F.col("id") % 20 % 3 == 0, "dev").otherwise("train").alias("split"))
    fitted = model.fit(rows, ["f"], trees=3, depth=2, family=family)
    assert seen == [40 if family == "boosted" else 26]
    few = {r["id"]: r["p"] for r in model.score(fitted, rows, ["f"]).collect()}
    monkeypatch.setattr(model, "MOST_SENT", 0)
    assert {r["id"]: r["p"] for r in model.score(fitted, rows, ["f"]).collect()} == few and len(few) == 20_000
