import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stormgrid.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """Root, and for every node the list of (left, right) texts on its way up."""
    ways, groups = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        parents, owners = [], []
        for at in range(0, len(digests), 8):
            run = digests[at : at + 8]
            for j in range(len(run)):
                for i in groups[at + j]:
                    ways[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            parents.append(h("".join(run)))
            owners.append([i for g in groups[at : at + 8] for i in g])
        digests, groups = parents, owners
    return digests[0], ways


def expected(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the contract's columns."""
    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    found = {}
    for lang in langs:
        own = sorted(((r[0], leaf_of(*r), r) for r in rows if r[2] == lang), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        found[lang] = own, *tree([d for _, d, _ in own])
    root, tops = tree([found[lang][1] for lang in langs])
    out = []
    for lang, top in zip(langs, tops):
        own, subroot, ways = found[lang]
        for (doc_id, digest, row), way in zip(own, ways):
            start = leaf_of(*row[:4], row[4] and row[4].translate(LOWER)) if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else digest
            folded = start
            for left, right in way + top:
                folded = h(left + folded + right)
            out.append((doc_id, digest, subroot, root, h("".join(a + b for a, b in way + top)), folded, folded == root))
    return sorted(out, key=repr)


def through_query(spark, rows, tmp_path):
    from stormgrid.llm.queries import QUERIES

    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    frame.withColumn("digest", F.lit("x")).withColumn("rank", F.lit(1)).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, QUERIES["op12_merkle_manifest"](spark, str(tmp_path)).collect()), key=repr)


@pytest.mark.parametrize(
    "sizes", [{"a": 1}, {"a": 1, None: 1, "b": 1}, {"a": 8, "é": 9, "z": 64, None: 65}, {"a": 600, "b": 1, "c": 513, "d": 512}, {f"l{i}": 1 + i % 3 for i in range(70)}]
)
def test_equals_plain_trees(spark, tmp_path, sizes):
    rows = []
    for lang, n in sizes.items():
        rows += [(len(rows) + i * 7, f"s{i % 3}", lang, i, f"Text Nr {i} {lang}") for i in range(n)]
    assert through_query(spark, rows, tmp_path) == expected(rows)


def test_nulls_ties_repeats_and_long_texts(spark, tmp_path):
    rows = [(None, None, None, None, None), (None, "s", "a", 3, ""), (3, "s", "a", 3, "X" * 200_000), (3, "s", "a", 3, "y"), (3, "s", "a", 4, "Y")]
    rows += [(3, "s", "a", 3, "y")] * 20 + [(-5, "Ü", "", 0, "Ünï A")]
    assert through_query(spark, rows, tmp_path) == expected(rows)


def test_many_levels(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merkle, "DIGITS", 1)
    monkeypatch.setattr(merkle, "SPAN", 8)
    rows = [(i, "s", "a" if i % 5 else "b", i, str(i)) for i in range(700)]
    assert through_query(spark, rows, tmp_path) == expected(rows)


def test_empty_table(spark, tmp_path):
    assert through_query(spark, [], tmp_path) == []


def test_proofs_are_exploded_without_a_join(spark):
    nodes = spark.range(2000).select(F.lit("a").alias("grp"), F.lit(2000).cast("bigint").alias("total"), F.col("id").alias("rank"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    above = spark.range(4).select(F.lit("a").alias("grp"), F.lit(2000).cast("bigint").alias("below"), F.col("id").alias("rank"), F.expr("struct(cast(array() as array<struct<left:string,right:string>>) as steps, 's' as subroot, 'r' as root)").alias("above"))
    plan = merkle._descend(nodes, ["rank"], above)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
