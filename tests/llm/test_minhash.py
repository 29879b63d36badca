from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from boreline.llm import minhash
from boreline.llm.components import components


def components_by_hand(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    sets = {}
    for key, text in rows:
        words = (text or "").encode().lower().split()
        width = min(5, len(words))
        sets[key] = frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if words else frozenset()
    owners, edges = defaultdict(list), []
    for key, found in sets.items():
        both = Counter(o for s in found for o in owners[s])
        edges += [(key, o) for o, n in both.items() if 100 * n >= 75 * (len(found) + len(sets[o]) - n)]
        for s in found:
            owners[s].append(key)
    top = components_by_hand(sets, edges)
    return {k: (len(s), top[k], k == top[k]) for k, s in sets.items()}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5000, 5000 + k) for k in range(1, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame([*edges, (None, 3), (7, 7)], "u bigint, v bigint")).collect()}
    real = [(a, b) for a, b in edges if a != b]
    assert got == components_by_hand({n for e in real for n in e}, real)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_is_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert result(minhash.op5_minhash(spark, sf_dir)) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_chains_in_one_bucket_are_found_whole(spark, docs):
    """Copies of copies: far from the first, each near the one before; no pair may be lost to the leader."""
    rng, words = random.Random(3), [f"w{k}" for k in range(120)]
    rows = []
    for k in range(120):
        words = list(words)
        for _ in range(2):
            words[rng.randrange(len(words))] = f"n{k}x{rng.random()}"
        rows.append((k, " ".join(words)))
    rng.shuffle(rows)
    assert result(minhash.near_duplicates(docs(rows))) == brute(rows)


def test_odd_rows(spark, docs, odd_rows):
    rows = minhash.near_duplicates(docs(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (5, 1, 5, True), (6, 1, 5, False), (None, 1, None, True), (-8, 1, -8, True)} <= got
    assert minhash.near_duplicates(docs([])).count() == 0


def test_block_links_are_exact():
    rng = random.Random(1)
    sets = [sorted(rng.sample(range(9), rng.randint(3, 8))) for _ in range(60)]
    block = pd.DataFrame({"rep": range(60), "component": range(60), "shingles": [np.array(s, np.uint64).tobytes() for s in sets]})
    got = {tuple(r) for r in minhash._links_in_block(75)(block).to_numpy().tolist()}
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]})}
    assert got == want and want


def test_shingles_follow_ascii_space_only():
    hashes = minhash.WordHashes()
    assert len(minhash.shingle_set("A b c d e f", hashes)) == 1
    assert (minhash.shingle_set("A B c", hashes) == minhash.shingle_set("a\x0bb C", hashes)).all()
    assert (minhash.shingle_set("É a", hashes) != minhash.shingle_set("é a", hashes)).all()


def test_two_classes_of_a_bucket_are_compared_as_a_pair(docs, monkeypatch):
    """Six in ten shingles in common, or a part of a text: candidates that are not linked, and no reason to fill blocks."""

    def refuse(percent):
        def found(block):
            raise AssertionError("a pair was dealt to a block")

        return found

    monkeypatch.setattr(minhash, "_links_in_block", refuse)
    words = [f"w{k}" for k in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:300] + [f"x{k}" for k in range(100)])), (3, " ".join(words[:250]))]
    rows += [(4, " ".join(f"y{k}" for k in range(300))), (5, " ".join(f"y{k}" for k in range(310)))]
    rows += [(6, " ".join(f"z{k}" for k in range(300))), (7, " ".join(f"z{k}" for k in range(200)))]
    pairs = [r for r in rows if r[0] != 3]
    assert result(minhash.near_duplicates(docs(pairs))) == brute(pairs)
    monkeypatch.undo()
    assert result(minhash.near_duplicates(docs(rows))) == brute(rows)


def test_only_texts_of_candidates_are_read_again(spark):
    rows = spark.range(40_000).selectExpr("id AS rep", "'t' AS text").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS rep, 't' AS text"))
    wanted = spark.range(-5, 400, 7).selectExpr("id AS rep")
    kept = {r.rep for r in minhash._probable(rows, wanted).collect()}
    assert {k for k in range(2, 400, 7)} <= kept and len(kept) < 200
    assert minhash._probable(rows, wanted.limit(0)).count() == 0


def test_whole_sets_are_one_python_step_a_task(spark):
    """Two of them in one task hold two workers at once, and an executor keeps both."""
    base = spark.createDataFrame([(k, f"text {k}") for k in (*range(-50, 50), 7, None)], "rep bigint, text string")
    reps = spark.createDataFrame([(k, 2) for k in (-50, 7, 9, 1000)], "rep bigint, weight bigint")
    sets = minhash._whole_sets(minhash._among(base, reps), "rep", "text")
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    python = plan.index("MapInArrow"), plan.index("ArrowEvalPython")
    assert python[0] < plan.index("Exchange") < python[1]
    assert sorted(r.rep for r in sets.collect()) == [-50, 7, 7, 9]
