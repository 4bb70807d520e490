import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tickloom.llm import exact, mixing, sharding


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_groups(spark, fan_in):
    texts = ["a b", "a  b", "a\t\nb", "a b", "", None, " ", "c", "c"]
    docs = [(100 - i, texts[i % len(texts)]) for i in range(80)]
    groups = defaultdict(list)
    for d, t in docs:
        groups[re.sub("[ \t-\r]+", " ", t or "")].append(d)
    want = {d: (min(g), len(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for d in g}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    rows = exact.exact_groups(df, fan_in=fan_in).collect()
    assert {r.doc_id: (r.keep_id, r.group_size, r.text_sha256) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.keep_id) for r in rows)
    assert sorted(r.doc_id for r in exact.drop_copies(df).collect()) == sorted(min(g) for g in groups.values())


def test_digests_that_agree_without_proof_are_not_merged(spark):
    runs = spark.createDataFrame([(0, "d", (1, 2), 5), (1, "d", (3, 2), 4), (1, "d", (1, 2), 9)],
                                 "run int, digest string, proof struct<hash: long, bytes: int>, id long")
    got = {(r.keep_id, r.group_size) for r in exact.merge_runs(runs, 2, 2).collect()}
    assert got == {(5, 2), (4, 1)}


def test_merges_are_of_sorted_runs(spark):
    runs = exact.digest_runs(spark.createDataFrame([(1, "a"), (2, "a")], "doc_id long, text string"))
    plan = exact.merge_runs(runs, 64)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("SortAggregate") == 2 * 3 and "HashAggregate" not in plan


def test_longest_first_is_the_greedy_schedule():
    got = sharding.longest_first([("a", 7), ("b", 6), ("c", 5), ("d", 4), ("e", 3)], 2)
    assert got == {"a": 0, "b": 1, "c": 1, "d": 0, "e": 0}


def test_shards(spark):
    docs = [(i, f"text {i % 400} " + "y" * (i % 37)) for i in range(3000)] + [(5000 + i, "hot") for i in range(200)]
    docs += [(9000, None), (9001, "")]
    rows = sharding.placed(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(rows) == len(docs)
    sizes, slots, homes = Counter(), defaultdict(list), defaultdict(set)
    texts = dict(docs)
    for r in rows:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
        homes[texts[r.doc_id] or ""].add(r.shard)
        assert r.size == len((texts[r.doc_id] or "").encode()) + 8 and r.law == "bytes" and r.grown_shard is None
    assert set(sizes) == set(range(24)) and all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = 200 * 11
    assert max(v for s, v in sizes.items() if s not in homes["hot"]) <= 1.1 * sum(sizes.values()) / 24
    assert hot <= sum(sizes.values()) / 2


def brute_targets(sizes, share, most):
    """Clamp, share the excess by weight, repeat."""
    names = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        free = [s for s in names if s not in capped]
        w = sum(weight[s] for s in free)
        target = {s: most * sizes[s] for s in capped} | {s: left * weight[s] / w for s in free}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


@pytest.mark.parametrize("counts", [(5, 80, 30, 7), (100, 1, 1, 1), (10, 10, 10, 10)])
def test_mix_meets_the_targets(spark, counts):
    docs = []
    for s, n in zip(("a", "b", "ä", None), counts):
        docs += [(len(docs) + i, "w " * (1 + i % 9), s) for i in range(n)]
    docs += [(9000, None, "a"), (9001, "", "b")]
    sizes = Counter()
    for _, t, s in docs:
        sizes[s] += len((t or "").split())
    want = brute_targets(sizes, 1.5, 2.0)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(df).collect()
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
    assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
    assert sorted(rows, key=str) == sorted(mixing.mix(df.repartition(5)).collect(), key=str)
    copies = mixing.repeated(mixing.mix(df)).groupBy("doc_id").count().collect()
    by_id = {r.doc_id: r for r in rows}
    assert all(abs(c["count"] * by_id[c.doc_id].size - by_id[c.doc_id].taken) <= by_id[c.doc_id].size / 2 for c in copies if by_id[c.doc_id].size)


def test_mix_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "a b", "x")], "doc_id long, text string, source string")
    plan = mixing.mix(df.withColumn("n", F.lit(1)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_copies_go_by_row(spark):
    docs = [(1, "copied"), (None, "copied"), (None, "unique"), (2, "copied"), (2, "another"), (3, None), (None, ""), (None, "unique")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in exact.drop_copies(df).collect()]
    assert sorted(got, key=str) == sorted([(1, "copied"), (None, "unique"), (None, "unique"), (2, "another"), (3, None)], key=str)
