import numpy as np
import pytest
import xxhash

from stormgrid.llm import simhash as S
from stormgrid.llm.components import components


def fingerprint(text, k=4):
    w = (text or "").encode().lower().split()
    parts = [b" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def labels(values, distance):
    f = np.array(values, dtype=np.uint64)
    comp = np.arange(len(f))
    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f ^ f[i]) <= distance):
            comp[comp == comp[j]] = comp[i]
    return comp


def test_fingerprints(spark):
    texts = [None, "", " \n", "One", "one two three", "a b c d e f g", "A  b\tc d", "é ß Z" * 9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint % (1 << 64) for r in S.fingerprints(docs).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("distance,chunk", [(4, 50), (2, 1024), (0, 7)])
def test_links_connect_as_all_pairs_do(spark, distance, chunk):
    rng = np.random.default_rng(distance)
    values = {int(x) for x in rng.integers(0, 1 << 63, 60, dtype=np.uint64)} | {0, (1 << 64) - 1}
    for c in list(values)[:3]:
        for _ in range(150):
            x = c
            for b in rng.integers(0, 64, rng.integers(1, 8)):
                x ^= 1 << int(b)
            values.add(x)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint bigint")
    got = {r.node: r.component for r in components(S.links(frame, distance, chunk)).collect()}
    groups = {}
    for v, c in zip(signed, labels([v % (1 << 64) for v in signed], distance).tolist(), strict=True):
        groups.setdefault(c, []).append(v)
    assert got == {v: min(g) for g in groups.values() if len(g) > 1 for v in g}


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base, "q"), (3, base + " end", "q"), (9, base, "q"), (4, "other words entirely here now", "q"), (None, base, "q"), (7, None, None), (8, "", "x"), (8, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = S.near_duplicates(docs)
    assert got.columns.count("component_id") == 1
    groups = labels([fingerprint(t) for _, t, _ in rows], 4)
    want = []
    for (k, t, _), g in zip(rows, groups, strict=True):
        want.append((k, fingerprint(t), min(r[0] for r, h in zip(rows, groups, strict=True) if h == g and r[0] is not None)))
    assert sorted(((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_keep_one_of_each_component(spark):
    rows = [(2, "a b c d e", "x"), (1, "A b c d e", "y"), (1, "A b c d e", "y"), (None, "z z z z", None), (4, None, None), (6, "", "t")]
    out = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(out.collect(), key=repr) == sorted([(1, "A b c d e", "y"), (None, "z z z z", None), (4, None, None)], key=repr)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(none).collect() == [] and S.keep_one(none).collect() == []
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (50, 50)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_chunk_pairs_of_one_key_spread_over_tasks(spark):
    from pyspark.sql import functions as F

    rows = [(7, p, [p], 20) for p in range(20)] + [(8, 0, [1], 1)]
    pairs = S.chunk_pairs(spark.createDataFrame(rows, "key long, part int, held array<bigint>, parts int"), tile=2)
    found = pairs.select("part", "other_part", "held", "other", F.spark_partition_id().alias("task")).collect()
    assert sorted((r.part, r.other_part) for r in found) == [(a, b) for a in range(20) for b in range(a + 1, 20)]
    assert all(r.held == [r.part] and r.other == [r.other_part] for r in found)
    assert len({r.task for r in found}) > 1


def test_links_of_large_nodes_are_dealt(spark):
    import random

    rng, parent = random.Random(5), list(range(400))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    edges = [(7, i) for i in range(120, 300)] + [(i, 350) for i in range(300, 340)] + [(rng.randrange(400), rng.randrange(400)) for _ in range(120)]
    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), node_links=5).collect()}
    assert got == {x: root(x) for e in edges if e[0] != e[1] for x in e}
