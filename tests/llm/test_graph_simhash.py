import random

import numpy as np
import pytest
import xxhash

from tickloom.llm import graph, simhash


def brute_print(text, k=4):
    words = text.encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(max(1, len(words) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """doc -> smallest doc reachable over fingerprints 4 bits apart at most."""
    label = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a, x in prints.items():
            for b, y in prints.items():
                if (x ^ y).bit_count() <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_fingerprint_is_the_majority_of_shingle_hashes():
    rng = random.Random(1)
    texts = ["", " ", "a", "A b c D", "a b c d e", "Ä Ö b \x0b c d", "x " * 50]
    texts += [" ".join(rng.choice(["a", "bb", "Ccc", "é"]) for _ in range(n)) for n in range(1, 70)]
    for text in texts:
        assert simhash.fingerprint(text) == brute_print(text)


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_bit_planes_find_all_close_pairs(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = np.concatenate([base ^ (np.uint64(1) << rng.integers(0, 64, 12).astype(np.uint64)) for _ in range(30)])
    stops = np.sort(rng.integers(1, len(values), 5).tolist() + [len(values)])
    ends = np.array([stops[stops > i].min() for i in range(len(values))])
    got = set(zip(*(x.tolist() for x in simhash.close_pairs(values, ends, radius))))
    want = {
        (i, j)
        for i in range(len(values))
        for j in range(i + 1, ends[i])
        if (int(values[i]) ^ int(values[j])).bit_count() <= radius
    }
    assert got == want and want


@pytest.mark.parametrize("count", [10, 100_000, 10**7, 10**10])
def test_any_two_values_within_the_radius_share_a_mask(count):
    rng = random.Random(count)
    masks = simhash._masks(count, 4)
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for _ in range(4):
            y ^= 1 << rng.randrange(64)
        assert any(x & m == y & m for m in masks)


def test_components_are_those_of_all_links(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, rng.randrange(200, 260)) for _ in range(50)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(5, 5)]
    label = {x: x for pair in links for x in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "u long, v long")).collect()}
    label.pop(5)
    assert got == label


@pytest.mark.parametrize("tile", [1024, 4])
def test_classes_match_brute_force(spark, monkeypatch, tile):
    """Also with tiles so small that every bucket is cut."""
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(5)
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.randint(60, 200))] for _ in range(12)]
    docs = []
    for i in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
        docs.append((1000 - i, " ".join(words)))
    docs += [(2000, None), (2001, ""), (2002, "a b")]
    want = brute_classes({d: brute_print(t or "") for d, t in docs})
    rows = simhash.simhash_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{brute_print(t or ''):016x}" for d, t in docs}
    kept = simhash.one_of_each(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_one_component_of_most_fingerprints(spark):
    """A chain through 2,000 values: each differs from the next by one bit, the ends by very many."""
    rng = random.Random(9)
    value, chain = rng.getrandbits(64), []
    while len(set(chain)) < 2000:
        chain.append(value)
        value ^= 1 << rng.randrange(64)
    alone = [rng.getrandbits(64) for _ in range(50)]
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in {*chain, *alone}]
    got = simhash.fingerprint_groups(spark.createDataFrame(signed, "fp long")).groupBy("root").count().collect()
    assert sorted(r["count"] for r in got) == [1] * 50 + [len(set(chain))]


def test_a_hot_component_is_joined_over_an_exchange_of_its_own(spark):
    """Between the aggregate by root and the join lies an exchange, which Spark may split."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, "c")], "doc_id long, text string")
        classes = simhash.simhash_classes(docs)
        plan = classes._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(xxhash64(root" in plan
        assert {r.doc_id: r.component_id for r in classes.collect()} == {1: 1, 2: 1, 3: 3}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
