"""Toxicity on held-out labels and a planted chain; chat snapshots against brute force; the pipeline's stages on a small corpus."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkweave.llm import chat, toxicity


def texts(n, seed):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    bad = ["vilezor", "vilemak", "grumpf"]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(5, 300))]
        junk, toxic = rng.random() < 0.3, rng.random() < 0.2
        if junk:
            words = [w + "###" for w in words] + ["spamword"]
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), int(not junk), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    rows = texts(900, 1)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), "clash") for i, t, _, _ in rows] + [(None, None, None, None, None, None), (10_000, "", "en", "s", 0, "")], "doc_id long, text string, lang string, source string, n_chars long, p_toxic string").repartition(4)
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows[:600]] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_held_out_accuracy(corpus):
    rows, docs, labels = corpus
    chain = toxicity.fitted(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, chain).collect()}
    assert len(got) == 902 and not got[None]["rejected"] and not got[10_000]["rejected"]
    held = rows[600:]
    right = sum(got[i]["rejected"] == bool(x) for i, _, _, x in held)
    assert right / len(held) > 0.97
    clean = toxicity.clean(docs, chain)
    assert clean.columns == docs.columns
    assert clean.count() == sum(not r["rejected"] for r in got.values())


def test_no_labels(spark, corpus):
    _, docs, labels = corpus
    chain = toxicity.fitted(docs, labels.limit(0))
    assert toxicity.scored(docs, chain).where("rejected").count() == 0
    chain = toxicity.fitted(docs, labels.where("toxic = 0"))
    assert toxicity.scored(docs, chain).where("rejected").count() == 0
    assert toxicity.scored(docs.limit(0), chain).count() == 0


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    first = rng.integers(0, 2, 400)
    rows = [np.array(sorted({int(1 + y), *rng.integers(10, 60, 5).tolist()})) for y in first]
    chain = toxicity.fit_chain(rows, np.column_stack([first, first]), ("a", "b"))
    assert chain.models[1].chained[0] > 0  # the second model leans on the first one's probability
    p = chain.probabilities(rows)
    assert ((p[:, 1] > 0.5) == first).mean() > 0.95


def test_chat(spark):
    rng = random.Random(4)
    convs, rows = {}, []
    for c in range(60):
        if c % 3 and convs:
            base = list(rng.choice(list(convs.values())))
            turns = base[: rng.randint(1, len(base))] + [("user", f"x{rng.randint(0, 5)}")] * rng.randint(0, 1)
        else:
            turns = [(("user", "assistant")[k % 2], rng.choice(["hi", "", None, "hello there", "ok"])) for k in range(rng.randint(1, 6))]
        convs[c] = turns
        rows += [(c, k * 2, r, t, 1) for k, (r, t) in enumerate(turns)]
    convs[None] = [("user", "alone")]
    rows.append((None, 0, "user", "alone", 1))
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n int").repartition(4)
    got = {r["conv_id"]: r for r in chat.rendered(table).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values())
        same = [k for k, o in convs.items() if o == turns and k is not None] or [None]
        state = "prefix" if longer else "kept" if c == min(same, key=lambda x: (x is None, x)) else "copy"
        assert (got[c]["n_turns"], got[c]["state"]) == (len(turns), state)
        text = "".join(f"<|{r}|>\n{t or ''}\n<|end|>\n" for r, t in turns)
        assert got[c]["chat"] == (text if state == "kept" else None)
    assert chat.rendered(table.limit(0)).count() == 0


def test_copies_share_a_fold():
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(1, 1 << 40, 12)) for _ in range(150)]
    folds = toxicity.folds_of(base * 3, 4)
    assert (folds[:150] == folds[150:300]).all() and (folds[:150] == folds[300:]).all() and set(folds.tolist()) == {0, 1, 2, 3}


def test_clean_with_clashing_columns(corpus):
    _, docs, labels = corpus
    chain = toxicity.fitted(docs, labels)
    wide = docs.withColumns({c: F.concat_ws("-", F.lit(c), "doc_id") for c in ("rejected", "p_quality", "_text", "ids", "c1", "c0", "_l", "_y0")})
    out = toxicity.clean(wide, chain)
    assert out.columns == wide.columns
    rows = out.collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r["doc_id"] for r in toxicity.clean(docs, chain).collect())
    assert all(r["rejected"] == (f"rejected-{r['doc_id']}" if r["doc_id"] is not None else "rejected") for r in rows)


def brute_pipeline(rows, bench, chain):
    """The stages restated: ids that each keeps, of rows (doc_id, text, source); stages before the mix are exact but for the classifier, which is given."""
    p = chain.probabilities([toxicity.feature_ids((t or "").encode()) for _, t, _ in rows])[:, -1]
    rows = [r for r, x in zip(rows, p, strict=True) if x < chain.threshold]
    words = [(t or "").lower().split() for _, t, _ in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a == b or min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) >= 0.8 * len(a | b):
                x, y = find(i), find(j)
                group[max(x, y)] = min(x, y)
    best = {}
    for i, (d, t, _) in enumerate(rows):
        key = (d is None, d if d is not None else 0, hashlib.md5((t or "").encode()).hexdigest(), i)
        best[find(i)] = min(best.get(find(i), key), key)
    rows = [rows[k[-1]] for k in best.values()]
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for t in bench:
        w = cut(t)
        n = min(10, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1) if w}
    holds = lambda w: any(tuple(w[k : k + n]) in windows for n in {len(x) for x in windows} for k in range(len(w) - n + 1))
    rows = [r for r in rows if not holds(cut(r[1]))]
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    names = sorted(size, key=lambda s: (s is None, s))
    weight, free, left, target = {s: i % 3 + 1 for i, s in enumerate(names)}, set(names), float(sum(size.values())), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        target |= {s: 3.0 * size[s] if s in over else level * weight[s] for s in over or free}
        left -= sum(target[s] for s in over)
        free = free - set(over) if over else set()
    out = Counter()
    for d, t, s in rows:
        rate = target[s] / size[s] if size[s] else 0.0
        draw = int(hashlib.md5(f"42:{'null' if d is None else d}:{hashlib.md5((t or '').encode()).hexdigest()}".encode()).hexdigest()[:12], 16) / (1 << 48)
        out[d] += int(rate) + (draw < rate - int(rate))
    return out


@pytest.fixture(scope="module")
def corpus_dir(spark, corpus, tmp_path_factory):
    rows, docs, labels = corpus
    path = tmp_path_factory.mktemp("corpus")
    docs = docs.drop("p_toxic")
    asked = "item words that the benchmark asks for exactly as they are here"
    more = [(20_000 + i, rows[i][1], "en", "t", 1) for i in range(50)] + [(30_000, rows[601][1] + " tail " + asked, "en", "t", 1)]
    more += [(40_000 + i, " ".join(rows[60 + i][1].split()[1:]), "en", "u", 1) for i in range(40)]
    more += [more[3], more[3], (None, None, None, None, None), (None, "", None, None, None), (None, rows[5][1], "en", None, 1), (50_000, "word", "en", "u", 1), (50_001, "long " * 200 + " ".join(f"x{i}" for i in range(20_000)), "en", None, 1)]
    docs.unionByName(docs.sparkSession.createDataFrame(more, docs.schema)).withColumn("_size", F.lit("mine")).write.parquet(str(path / "documents.parquet"))
    labels.write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(1, asked), (2, None), (3, "")], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return path


def test_pipeline(spark, corpus, corpus_dir):
    """All stages against their restatement, on null, empty and long texts, repeated rows and a clashing column."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rows, _, labels = corpus
    docs = spark.read.parquet(str(corpus_dir / "documents.parquet"))
    frame = corpus_pipeline.run(spark, str(corpus_dir))
    assert frame.columns == [*docs.columns, "shard", "slot"]
    out = frame.collect()
    chain = toxicity.fitted(docs, labels)
    want = brute_pipeline([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], ["item words that the benchmark asks for exactly as they are here"], chain)
    assert Counter(r["doc_id"] for r in out) == +want
    ids, toxic = {r["doc_id"] for r in out}, {i for i, _, _, x in rows if x}
    assert len(ids & toxic) <= 5 and not ids & {20_000 + i for i in range(50)} and 30_000 not in ids
    shards = {}
    for r in out:
        shards.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1


def test_pipeline_of_an_empty_table(spark, corpus_dir, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(str(corpus_dir / f"{name}.parquet")).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_chat_with_tied_turns(spark):
    """Repeated turns stand next to each other and tied turn numbers in order of role and text."""
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "a"), (2, 2, "user", "b"), (3, 5, "user", "a"), (4, None, "user", "a"), (4, 0, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: (r["n_turns"], r["state"], r["kept_id"]) for r in chat.rendered(table).collect()}
    assert got == {1: (3, "kept", 1), 2: (3, "copy", 1), 3: (1, "prefix", None), 4: (2, "kept", 4)}
