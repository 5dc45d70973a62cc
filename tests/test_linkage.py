"""Linkage operators on worked examples and against plain restatements."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.functions import similarity as sim
from linkweave.functions import text as t
from linkweave.operators import assign, blocking, features, keys, metrics, model, profile, validate, vectors
from linkweave.sources import tables
from linkweave.streaming.blocking import stream_candidates

NAMES = [
    ("Acme (India) Pvt. Ltd.", "acme india pvt ltd", "acme india", "pvt ltd", "acme india", "acme", "india"),
    ("Smith & Co", "smith and co", "smith", "co", "smith", "smith", "and"),
    ("Société Générale SARL", "societe generale sarl", "societe generale", "sarl", "generale societe", "societe", "generale"),
    ("Foo ﬁlms LLC", "foo films llc", "foo films", "llc", "films foo", "foo", "films"),
    ("Limited", "limited", "", "ltd", "limited", "limited", None),
    ("Øst ß GmbH & Co", "st gmbh and co", "st", "gmbh", "st", "gmbh", "and"),
    ("A--B ++ C-D **x**", "a b c d x", "a b c d x", None, "a b c d x", None, None),
    ("टाटा लिमिटेड", "tata limited", "tata", "ltd", "tata", "tata", "limited"),
    (None, None, None, None, None, None, None),
]


def test_name_keys(spark):
    df = spark.createDataFrame([(str(i), r[0], None) for i, r in enumerate(NAMES)], "entity_id string, business_name string, business_address string")
    got = {r["entity_id"]: r for r in keys.key_columns(df).collect()}
    for i, (_, clean, bare, form, key, t0, t1) in enumerate(NAMES):
        r = got[str(i)]
        assert (r["name_clean"], r["name_no_legal"], r["legal_form"], r["name_token_sorted_key"], r["first_token"], r["second_token"]) == (clean, bare, form, key, t0, t1)
    with pytest.raises(ValueError):
        keys.ensure_keys(df.drop("business_name"))
    assert keys.ensure_keys(df).columns[-10:] == list(keys.KEY_COLUMNS)


def test_extraction(spark):
    rows = [("Wilford www.example.net", "example", None, None), ("john@gmail.com", None, None, None), ("ACME.co.in", "acme", None, None), ("https://www.foo-bar.io/x", "foo-bar", None, None), ("12/A, Road 500081", None, "12", "500081"), ("560001", None, None, "560001"), ("A12 B", None, None, None), ("प्लॉट १२३ road 45", None, "१२३", None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "s string")
    got = df.select("s", t.domain_root("s"), t.street_number("s"), t.pincode("s")).collect()
    assert [tuple(r) for r in got] == rows


def test_soundex(spark):
    rows = [("Ashcraft", "A226"), ("Tymczak", "T522"), ("Pfister", "P236"), ("Honeyman", "H555"), ("Étienne", "T500"), ("9abc", "A120"), ("", None), ("123", None)]
    got = spark.createDataFrame([(r[0],) for r in rows], "s string").select("s", t.soundex("s")).collect()
    assert [tuple(r) for r in got] == rows


def test_string_scores():
    assert round(sim.jaro("martha", "marhta"), 5) == 0.94444 and round(sim.jaro_winkler("martha", "marhta"), 5) == 0.96111
    assert sim.token_sort_ratio("b a", "a b") == 1.0 and sim.token_set_ratio("a b c", "a b") == 1.0
    assert sim.partial_ratio("abc", "xxabcxx") == 1.0
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 9))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert sim.common_subsequence(a, b) == table[-1][-1]
        assert 0 <= sim.partial_ratio(a, b) <= 1 and sim.partial_ratio(a, b) == pytest.approx(sim.partial_ratio(b, a))


SCORED = [("S1-1", "S2-1", 0.90), ("S1-2", "S2-1", 0.80), ("S1-3", "S2-2", 0.60), ("S1-4", "S2-2", 0.60)]
SCORED += [("S1-5", f"S2-{10 + i}", 0.95 - i / 100) for i in range(7)] + [("S1-5", f"S3-{10 + i}", 0.95 - i / 100) for i in range(8)] + [("S1-6", "S2-16", 0.50)]


def pairs_of(df):
    return {(r["s1_id"], r["cand_id"]) for r in df.collect()}


def test_assignment_policies_differ(spark):
    df = spark.createDataFrame(SCORED, "s1_id string, cand_id string, p double")
    late, early, greedy = pairs_of(assign.assign_best_then_cap(df, 0.4)[1]), pairs_of(assign.assign_cap_then_best(df, 0.4)), pairs_of(assign.assign_greedy(df, 0.4))
    assert ("S1-1", "S2-1") in late & early & greedy and ("S1-3", "S2-2") in late & early & greedy
    assert ("S1-6", "S2-16") not in late and ("S1-6", "S2-16") in early & greedy
    assert Counter(c[:2] for s, c in greedy if s == "S1-5") == {"S2": 6, "S3": 5}
    assert Counter(c[:2] for s, c in early if s == "S1-5") == {"S2": 5, "S3": 6}


def test_greedy_equals_a_scan(spark):
    rng = random.Random(3)
    rows = list({(f"S1-{rng.randint(0, 8)}", f"S2-{rng.randint(0, 25)}"): 0 for _ in range(150)})
    rows = [(s, c, rng.randint(0, 20) / 20) for s, c in rows]
    free, room, want = set(), Counter(), set()
    for s, c, p in sorted(rows, key=lambda r: (-r[2], r[0], r[1])):
        if p >= 0.3 and c not in free and room[s] < 3:
            free.add(c)
            room[s] += 1
            want.add((s, c))
    assert pairs_of(assign.assign_greedy(spark.createDataFrame(rows, "s1_id string, cand_id string, p double"), 0.3, most=3)) == want


def test_metrics_toy(spark):
    truth = {"S1-1": "S2-10 S3-20", "S1-2": "", "S1-3": "S2-30 S2-31 S3-30", "S1-4": "S2-40"}
    pred = {"S1-1": "S2-10 S3-20 S2-99", "S1-2": "", "S1-3": "S2-30 S2-31 S3-30", "S1-4": ""}
    pred["S1-3"] = "S2-30 S2-31"
    frame = lambda d: spark.createDataFrame([(k, c) for k, v in d.items() for c in v.split()], "s1_id string, cand_id string")
    ids = spark.createDataFrame([(k,) for k in truth], "s1_id string")
    (row,) = metrics.evaluate(ids, frame(truth), frame(pred)).collect()
    assert row["f05_macro"] == pytest.approx((0.71429 + 1 + 1.25 * (2 / 3) / (0.25 + 2 / 3) + 0) / 4, abs=1e-4)
    assert (row["singleton_accuracy"], row["candidate_recall"], row["num_singletons"]) == (1.0, 0.66667, 1)
    assert row["precision_macro"] == 0.88889 and row["recall_macro"] == pytest.approx(5 / 9, abs=1e-4)
    assert {r["size"]: r["entities"] for r in profile.cluster_histogram(ids, frame(truth)).collect()} == {0: 1, 1: 1, 2: 1, 3: 1}


def test_channels_caps_and_masks(spark):
    s1 = spark.createDataFrame([(f"S1-{i}", "x", "k" if i < 4 else "rare") for i in range(5)], "entity_id string, country string, key string")
    pool = spark.createDataFrame([(f"S2-{i:02d}", "x", "rare") for i in range(9)] + [("S2-99", "x", "k"), ("S2-98", "y", "rare"), ("S2-97", "x", " ")], "entity_id string, country string, key string")
    channel = blocking.Channel(("key",), 3, 1, 4)
    got = blocking.block_on_keys(s1, pool, channel)
    assert pairs_of(got) == {("S1-4", f"S2-0{i}") for i in range(3)}  # k is too frequent in S1; of rare the lowest ids
    merged = blocking.merge_channels(got, got, got.withColumns({"priority": F.lit(2), "channel_mask": F.lit(1)}))
    assert {(r["priority_rank"], r["channel_mask"]) for r in merged.collect()} == {(1, 5)}
    assert pairs_of(stream_candidates(s1, pool, channel)) == {("S1-4", f"S2-0{i}") for i in range(3)} | {(f"S1-{i}", "S2-99") for i in range(4)}
    with pytest.raises(ValueError):
        blocking.block_on_keys(s1.drop("key"), pool, channel)


def test_pair_feature_toy(spark):
    columns = "entity_id string, name_clean string, address_clean string, legal_form string, domain_root string, street_number string"
    s1 = spark.createDataFrame([("1", "acme corporation", "100 main st suite 200 new york ny", "corp", "acmecorp", "100"), ("2", "global logistics services", "50 harbour road singapore", "llc", None, "50")], columns)
    pool = spark.createDataFrame([("10", "acme corp", "100 main street new york", "corp", "acmecorp", "100"), ("11", "acme supplies inc", "999 broadway", "inc", "acmesupplies", "999"), ("20", "global logistics co", "50 harbour road", "co", "globallogistics", "50")], columns)
    pairs = spark.createDataFrame([("1", "10"), ("1", "11"), ("2", "20")], "s1_id string, cand_id string")
    got = {r["cand_id"]: r for r in features.pair_features(pairs, s1, pool).collect()}
    names = ("name_len_diff", "exact_clean_name", "exact_legal_match", "exact_street_num_match", "exact_pincode_match", "domain_root_match", "has_s3_domain", "both_have_address", "cands_per_s1", "claims_per_cand")
    assert [got["10"][n] for n in names] == [7, 0, 1, 1, -1, 1, 1, 1, 2, 1]
    assert [got["11"][n] for n in names] == [1, 0, 0, 0, -1, 0, 1, 1, 2, 1]
    assert [got["20"][n] for n in names] == [6, 0, 0, 1, -1, 0, 1, 1, 1, 1]
    assert round(got["11"]["name_len_ratio"], 5) == 0.94118


def test_dense_and_gram_joins(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", 5)
    rng = random.Random(2)
    rows = [(i, "a" if i % 2 else "b", [rng.gauss(0, 1) for _ in range(4)]) for i in range(40)]
    q, p = (spark.createDataFrame(r, "id long, part string, vector array<double>") for r in (rows[:15], rows[15:]))
    dot = lambda x, y: sum(a * b for a, b in zip(x, y, strict=True))
    want = set()
    for i, part, x in rows[:15]:
        best = sorted((-dot(x, y) / (dot(x, x) * dot(y, y)) ** 0.5, j) for j, other, y in rows[15:] if other == part)[:3]
        want |= {(i, j) for s, j in best if -s >= 0.1}
    assert pairs_of(vectors.dense_top_k(q, p, 3, 0.1)) == want


def test_checks(spark):
    rows = [("S1-1", "S2-1, S2-2"), ("S1-2", "S2-1,,S2-2"), ("S1-3", "S1-9"), ("S1-4", "X9-1"), ("S1-5", "S2-1,S2-1"), ("S1-6", "S2-7"), ("S1-8", "")]
    m = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "s1_id string, matched_entity_ids string, ordinal int")
    c = spark.createDataFrame([("S1-6", "S2-8", 5)], "s1_id string, candidate_entity_ids string, ordinal int")
    expected = spark.createDataFrame([(f"S1-{i + 1}", i) for i in range(7)], "s1_id string, ordinal int")
    got = {(r["check"], r["s1_id"]) for r in validate.violations(m, c, expected).collect()}
    for check, s1 in (("forbidden_characters", 1), ("empty_token", 2), ("s1_in_list", 3), ("bad_prefix", 4), ("duplicate_id", 5), ("missing_entity", 7), ("extra_entity", 8)):
        assert (f"matches:{check}", f"S1-{s1}") in got
    assert ("not_a_candidate", "S1-6") in got and ("matches:order", "S1-8") in got and ("matches:order", "S1-1") not in got


def test_sources_round_trip(spark, tmp_path):
    path = str(tmp_path / "s1.tsv")
    with open(path, "w") as f:
        f.write('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-2\tThe "Q" Co\tNULL\tus\nS1-1\tnull\tNone\t\n')
    got = [tuple(r) for r in tables.read_tsv(spark, path).orderBy("entity_id").collect()]
    assert got == [("S1-1", None, None, None), ("S1-2", 'The "Q" Co', None, "us")]
    ids = tables.id_map(tables.entity_ids(tables.read_tsv(spark, path)))
    assert {(r[0], r[1]) for r in ids.collect()} == {("S1-1", 0), ("S1-2", 1)}
    assert tables.convert_tsv(spark, path, str(tmp_path / "p"), "snappy", ids) == 2
    tables.write_tsv(spark.createDataFrame([("S1-1", "", 0), ("S1-2", "S2-1", 1)], "s1_id string, ids string, o int"), str(tmp_path / "out"), "o")
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text() == "s1_id\tids\nS1-1\t\nS1-2\tS2-1\n"
    assert tables.first_existing(spark, [str(tmp_path / "none"), path]) == path


def test_model_round_trip(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"S1-{i}", rng.random(), i % 2) for i in range(200)]
    df = model.with_split(spark.createDataFrame([(s, x / 2 + y / 2, y) for s, x, y in rows], "s1_id string, f double, target int"))
    fitted = model.fit(df, ["f"], trees=5, depth=2)
    model.save(fitted, str(tmp_path / "m"), 0.5, ["f"], {"x": 1})
    again, meta = model.load(spark, str(tmp_path / "m"))
    assert meta["threshold"] == 0.5
    got = model.score(again, df, ["f"]).collect()
    assert sum((r["p"] > 0.5) == (r["target"] == 1) for r in got) > 190


def test_model_families(spark):
    """Each family separates classes that one feature separates; a boundary that no line draws takes trees."""
    rng = random.Random(6)
    points = [(f"S1-{i}", rng.random(), rng.random()) for i in range(600)]
    even = model.with_split(spark.createDataFrame([(s, x, y, int(x > 0.5)) for s, x, y in points], "s1_id string, f double, g double, target int")).cache()
    for family in model.FAMILIES:
        fitted = model.fit(even, ["f", "g"], trees=5, depth=3, family=family)
        got = model.score(fitted, even, ["f", "g"]).collect()
        assert sum((r["p"] > 0.5) == (r["target"] == 1) for r in got) > 570, family
        assert model.importances(fitted, ["f", "g"])[0][0] == "f", family
    odd = model.with_split(spark.createDataFrame([(s, x, y, int((x > 0.5) != (y > 0.5))) for s, x, y in points], "s1_id string, f double, g double, target int")).cache()
    _, best, losses = model.fit_best(odd, ["f", "g"], trees=20, depth=4)
    assert best in ("boosted", "forest") and losses[best] == min(losses.values()) < losses["linear"] - 0.1
    with pytest.raises(ValueError):
        model.fit(odd, ["f"], family="none")


def test_random_negatives(spark):
    """Within a country, never in the truth, as many as drawn less repeats and truths; the same whatever the partitions; without a country or a pool none."""
    s1 = [(f"S1-{i}", "xyz"[i % 3]) for i in range(60)] + [("S1-n", None), ("S1-w", "w")]
    pool = [(f"S2-{i}", "xy"[i % 2]) for i in range(40)] + [("S2-n", None)]
    truth = spark.createDataFrame([(s, p) for s, c in s1 for p, k in pool[:20] if c == k], "s1_id string, cand_id string")
    frame = lambda rows, n: spark.createDataFrame(rows, "entity_id string, country string").repartition(n)
    runs = [sorted(map(tuple, features.random_negatives(truth, frame(s1, n), frame(pool + pool[:m], n), per_s1=5).collect())) for n, m in ((1, 0), (7, 0), (3, 9))]
    assert runs[0] == runs[1] == runs[2]
    country, drawn = dict(s1 + pool), Counter(s for s, _ in runs[0])
    assert all(country[s] == country[p] for s, p in runs[0]) and not set(runs[0]) & {tuple(r) for r in truth.collect()}
    assert set(drawn) <= {s for s, c in s1 if c in ("x", "y")} and max(drawn.values()) <= 5 and len(drawn) > 30
    empty = frame(pool, 1).limit(0)
    assert features.random_negatives(truth, frame(s1, 1), empty).count() == 0 and features.random_negatives(truth, empty, frame(pool, 1)).count() == 0


@pytest.mark.parametrize("most", [2_048, 5])
def test_latent_top_k_decomposes_each_part(spark, most, monkeypatch):
    """Against numpy, parts in a task or distributed: each part has factors of its own, and S1 and pool are projected on the same ones."""
    monkeypatch.setattr(vectors, "MOST_LOCAL", most)
    rng = random.Random(2)
    name = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(2))
    pool = [(f"p{c}{i}", c, name()) for c in "xy" for i in range(20)]
    s1 = [(f"s{c}{i}", c, t[:-1] + "a") for i, (_, c, t) in enumerate(pool[::5])]
    frame = lambda rows: spark.createDataFrame(rows, "id string, part string, text string")
    got = {(r["s1_id"], r["cand_id"]): r["similarity"] for r in vectors.latent_top_k(frame(s1), frame(pool), top_k=50, least=-1.0, dimensions=4).collect()}
    weights = [(r["id"], r["gram"], r["weight"]) for r in vectors.tfidf(frame(s1 + pool), frame(pool), **vectors.LATENT).collect()]
    want = {}
    for c in "xy":
        own, asked = [r for r in pool if r[1] == c], [r for r in s1 if r[1] == c]
        both = [r for r in weights if r[0] in {x[0] for x in asked + own}]
        grams, ids = sorted({g for _, g, _ in both}), [r[0] for r in asked + own]
        m = np.zeros((len(ids), len(grams)))
        for i, g, w in both:
            m[ids.index(i), grams.index(g)] = w
        z = m @ np.linalg.svd(m[len(asked) :])[2][:4].T
        z /= np.linalg.norm(z, axis=1)[:, None]
        want |= {(a, b): z[ids.index(a)] @ z[ids.index(b)] for a, *_ in asked for b, *_ in own}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_leading_vectors_with_restarts(monkeypatch):
    """Against numpy: many steps, restarts, and a matrix of lower rank than factors asked for."""
    monkeypatch.setattr(vectors, "MOST_COLUMNS", 40)
    monkeypatch.setattr(vectors, "STEP_COLUMNS", 4)
    draw = np.random.default_rng(5)
    for rank, k in ((90, 12), (7, 12)):
        m = draw.standard_normal((120, rank)) @ (draw.standard_normal((rank, 200)) * np.linspace(3, 0.2, rank)[:, None])
        calls = []
        got = vectors._leading(lambda v, m=m, calls=calls: calls.append(v.shape[1]) or m.T @ (m @ v), 200, k)
        want = np.linalg.svd(m)[2][: min(rank, k)].T
        assert got.shape == want.shape and np.abs(got @ got.T - want @ want.T).max() < 1e-6
        assert set(calls) == {4} and (rank == 7 or len(calls) > 10)


@pytest.mark.parametrize("most", [1 << 22, 5])
def test_latent_top_k_over_texts_once(spark, most, monkeypatch):
    """Copies weigh in the fit, are compared once and all come back; in chunks, steps, groups and tiles of few rows; parts without known grams have no pairs."""
    for name, value in (("MOST_LOCAL", most), ("CHUNK_BYTES", 400), ("ROWS_AT_ONCE", 3), ("FREQUENT", 8), ("GRAM_BLOCK", 16), ("FEW_ROWS", 0), ("STEP_COLUMNS", 4), ("MOST_COLUMNS", 24), ("PROJECTED_TOGETHER", 4), ("LATENT_TILE", 6)):
        monkeypatch.setattr(vectors, name, value)
    rng = random.Random(8)
    texts = [" ".join("".join(rng.choice("abcd") for _ in range(4)) for _ in range(3)) for _ in range(24)]
    pool = [(f"p{i:03}", "x", texts[i % 24 if i % 3 else 0]) for i in range(70)] + [("pz", "z", "q"), ("pn", None, "abcd"), ("pe", "x", None)]
    s1 = [(f"s{i:03}", "x", texts[i % 7]) for i in range(20)] + [("sz", "z", "abcd abca"), ("so", "only", "abcd"), ("sn", None, "abcd")]
    pool += [(f"pw{i}", "w", f"{i:03}{i:03}") for i in range(110)]
    frame = lambda rows: spark.createDataFrame(rows, "id string, part string, text string").repartition(3)
    got = {(r["s1_id"], r["cand_id"]): r["similarity"] for r in vectors.latent_top_k(frame(s1), frame(pool), top_k=100, least=-1.0, dimensions=6, max_df=0.9).collect()}
    options = vectors.LATENT | {"max_df": 0.9}
    weights = [(r["id"], r["gram"], r["weight"]) for x in (s1, pool) for r in vectors.tfidf(frame(x), frame(pool), **options).where("part = 'x'").collect()]
    ids, grams = sorted({i for i, *_ in weights}), sorted({g for _, g, _ in weights})
    m = np.zeros((len(ids), len(grams)))
    for i, g, w in weights:
        m[ids.index(i), grams.index(g)] = w
    z = m @ np.linalg.svd(m[[i[0] == "p" for i in ids]])[2][:6].T
    z /= np.linalg.norm(z, axis=1)[:, None]
    want = {(a, b): z[i] @ z[j] for i, a in enumerate(ids) for j, b in enumerate(ids) if a[0] == "s" and b[0] == "p"}
    assert len(grams) > 24 and got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_token_candidates_by_classes(spark, monkeypatch):
    """All pairs that share a token, whatever the tiles, with copies, repeated ids and no join row for each shared token."""
    rng = random.Random(6)
    words = [f"word{i}" for i in range(30)]
    side = lambda p, n: [(f"{p}{i % (n - 4)}", ["x", "y", None][i % 5 % 3], " ".join(rng.sample(words, rng.randrange(0, 4))) if i % 3 else "word1 word2 same") for i in range(n)]
    a, b = side("s", 40), side("p", 70)
    frame = lambda x: spark.createDataFrame(x, "entity_id string, country string, business_name string")
    want = {(i, j) for i, c, n in a for j, d, m in b if c == d and c and set(n.split()) & set(m.split())}
    for tiles, most, given in (((4_096, 2_048), 1_024, 1 << 18), ((3, 5), 2, 1)):
        monkeypatch.setattr(blocking, "TOKEN_TILES", tiles)
        monkeypatch.setattr(blocking, "MOST_IDS", most)
        monkeypatch.setattr(blocking, "GIVEN_OUT", given)
        found = blocking.token_candidates(frame(a), frame(b))
        got = [tuple(r) for r in found.collect()]
        assert set(got) == want and len(got) == len(want)
    assert not [x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x and "token#" in x]


def test_token_candidates_bound_pairs_of_a_row(spark, monkeypatch):
    """a row of lists stands for some 4,096 pairs at most, however many equal names there are; together they are all pairs, each once."""
    frame = lambda p, n: spark.createDataFrame([(f"{p}{i}", "x", "word1" if i % 50 else f"word1 word{i}") for i in range(n)], "entity_id string, country string, business_name string")
    a, b = frame("s", 130), frame("p", 9_000)
    made, kind = [], type(a)
    whole = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *x, **y: made.append(whole(self, *x, **y)) or made[-1])
    found = blocking.token_candidates(a, b)
    lists = made[-1].selectExpr("size(s1_ids) * size(cand_ids) AS n").agg({"n": "max"}).first()[0]
    assert lists <= blocking.PAIRS_TOGETHER
    assert found.count() == found.distinct().count() == 130 * 9_000


def test_features_of_equal_names(spark, monkeypatch):
    """The features of all pairs of equal names, a frequent name in parts, with no window or join on pairs."""
    names = ["Acme Pvt. Ltd.", "foo.com", "Foo Foo", None]
    rows = [(f"e{i}", names[i % 4] if i % 3 else "same GmbH", [f"{i % 5} Long Road 56000{i % 2}", "", None][i % 3 % (1 + i % 3)], "xy"[i % 2]) for i in range(60)]
    raw = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string")
    keyed = keys.key_columns(raw)
    s1, pool = keyed.where("pmod(hash(entity_id), 3) = 0"), keyed.where("pmod(hash(entity_id), 3) <> 0")
    side = lambda d, i: d.select(F.col("entity_id").alias(i), "country", "business_name")
    pairs = side(s1, "s1_id").join(side(pool, "cand_id"), ["country", "business_name"]).select("s1_id", "cand_id")
    want = sorted(map(tuple, features.pair_features(pairs, s1, pool).collect()))
    for each in (1 << 19, 5):
        monkeypatch.setattr(features, "PAIRS_EACH", each)
        found = features.features_of_equal_names(s1, pool)
        assert found.columns == ["s1_id", "cand_id", *features.FEATURES]
        assert sorted(map(tuple, found.collect())) == want and len(want) > 50
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan[: plan.index("Join")]
