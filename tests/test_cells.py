"""Pairs of equal names that meet in cells."""

import random

import pytest
from pyspark.sql import functions as F

from linkweave.functions import similarity as sim
from linkweave.functions.text import split_name
from linkweave.operators import cells, features, keys, model
from linkweave.plans import registry
from linkweave.plans import views as v


@pytest.fixture
def sides(spark):
    """S1 and pool, keyed: a frequent name, nulls, missing addresses, an id with two rows."""
    names = ["Acme Pvt. Ltd.", "foo.com", "Foo Foo", None]
    rows = [(f"e{i % 78}", names[i % 4] if i % 3 else "same GmbH", [f"{i % 5} Long Road 56000{i % 2}", "", None][i % 3 % (1 + i % 3)], "xy"[i % 2], f"t{i % 9}") for i in range(80)]
    raw = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, text_key string")
    keyed = keys.key_columns(raw)
    return keyed.where("pmod(hash(entity_id), 3) = 0"), keyed.where("pmod(hash(entity_id), 3) <> 0")


def test_scores_of_one_with_many():
    """F2: to the bit what the scores of each pair are; long strings, blanks, repeated tokens and other scripts among them."""
    rng = random.Random(1)

    def text():
        kind = rng.randrange(6)
        if kind == 0:
            return rng.choice(["", "  ", "x" * 70 + " a", "a\0b c", "ab " * 21, "ab " * 22])
        if kind < 4:
            return f"{rng.randrange(300)} src{rng.randrange(4)}"
        return " ".join(rng.choice(["a", "b", "ab", "abc", "éa", "12", "src1", "long road"]) for _ in range(rng.randrange(7)))

    others = [text() for _ in range(300)]
    many = sim.Many(others)
    for a in [text() for _ in range(40)]:
        got = many.of(a)
        for j, b in enumerate(others):
            blank = not a.strip() or not b.strip()
            assert tuple(x[j] for x in got) == ((0.0, 0.0, 0.0) if blank else (sim.jaro(a, b), sim.token_set_ratio(a, b), sim.token_sort_ratio(a, b)))


def test_pairs_leave_cells_as_lists(spark, sides, monkeypatch):
    """F2: no pair is scored in Python by itself or joined, whatever the pieces of a cell."""
    plan = None
    found = []
    for met, given in ((8_192, 1 << 16), (3, 1)):
        monkeypatch.setattr(cells, "MOST_MET", met)
        monkeypatch.setattr(cells, "GIVEN_OUT", given)
        df = features.features_of_equal_names(*sides)
        found.append(sorted(map(tuple, df.collect())))
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert found[0] == found[1] and len(found[0]) > 50
    assert "ArrowEvalPython" not in plan and "Join" not in plan[: plan.index("MapInArrow")]


@pytest.mark.parametrize(("met", "given", "kinds"), [(8_192, 1 << 16, 1 << 18), (3, 1, 5)])
def test_kinds_stand_for_all_pairs(spark, sides, monkeypatch, met, given, kinds):
    """F1: fitted on kinds with their number and scored by cells, every pair has the target, split and p that it has when all pairs are written."""
    monkeypatch.setattr(features, "PAIRS_EACH", 40)
    s1, pool = sides
    side = lambda d, i: d.select(F.col("entity_id").alias(i), "text_key")
    truth = side(s1, "s1_id").join(side(pool, "cand_id"), "text_key").select("s1_id", "cand_id")
    rows = model.with_split(features.labelled(features.features_of_equal_names(s1, pool), truth)).cache()
    fitted = model.fit(rows, features.FEATURES, trees=3, depth=3)
    want = sorted((r["s1_id"], r["cand_id"], r["target"], r["split"], round(r["p"], 9)) for r in model.score(fitted, rows, features.FEATURES).collect())
    for name, x in (("MOST_MET", met), ("GIVEN_OUT", given), ("MOST_KINDS", kinds)):
        monkeypatch.setattr(cells, name, x)
    names = F.array(*[F.lit(x) for x in model.SPLITS])
    split = F.element_at(names, F.col("group_of")).alias("split")
    few, scored = features.kinds_of_equal_names(s1, pool, "text_key", F.array_position(names, split_name("s1_id")))
    few = few.select("*", split)
    assert few.count() < len(want) == few.agg(F.sum("number")).first()[0] and {r[2] for r in want} == {0, 1}
    fitted = model.fit(few, features.FEATURES, trees=3, depth=3, weight="number")
    got = scored(model.score(fitted, few, features.FEATURES)).select("s1_id", "cand_id", "target", split, "p").collect()
    assert sorted((r["s1_id"], r["cand_id"], r["target"], r["split"], round(r["p"], 9)) for r in got) == want


def test_keys_only_of_names_on_both_sides(spark, tmp_path):
    """rows that meet nobody get no keys, and the pairs are the same."""
    rows = [(i, f"Name {i % 9 if i % 2 else i}\nx", [None, "en", "de"][i % 3], "web", 10) for i in range(90)] + [(95, None, "en", "web", 0), (91, None, "en", "web", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    few, all_ = v.keyed_alike(spark, str(tmp_path)), v.keyed(spark, str(tmp_path))
    assert sum(x.count() for x in few) < sum(x.count() for x in all_) == 92
    got = sorted(map(tuple, registry.pair_features(spark, str(tmp_path)).collect()))
    assert got == sorted(map(tuple, features.features_of_equal_names(*all_).collect())) and len(got) > 20
