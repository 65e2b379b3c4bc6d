import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from stormgrid.llm import common
from stormgrid.llm import decontaminate as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(docs, items, window=10):
    """Hit words and items of each document, by comparing every window."""
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for item, body in items:
            b = words(body)
            n = min(window, len(b))
            parts = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in parts:
                    hit.update(range(i, i + n))
                    found.add(item)
        out.append((len(w), len(hit), sorted(found)))
    return out


def made(seed, docs=60):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("aa bb cc Dd é x1".split()) + rng.choice(["", ",", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(12)] + [(3, None), (40, "one two three")]
    rows = [(i, text(rng.randint(0, 60)) + " " + rng.choice(items)[1].__str__() + " " + text(5)) for i in range(docs)]
    return rows + [(100, None), (101, ""), (102, "one, TWO three")], items


@pytest.mark.parametrize("seed,block,segment", [(1, 10**6, 1 << 18), (2, 20, 50), (3, 1, 1)])
def test_equals_brute_force(spark, seed, block, segment):
    rows, items = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = D.build_index(docs, segment_words=segment)
    found = D.search(index, spark.createDataFrame(items, "item_id long, text string"), block_words=block).collect()
    got = {r.key: (r.n_words, r.n_hit, list(r["items"])) for r in found}
    assert len(found) == len(rows) and got == {k: v for (k, _), v in zip(rows, brute(rows, items), strict=True)}


def test_spans_do_not_cross_documents(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, "c a")], "doc_id long, text string").coalesce(1)
    found = D.search(D.build_index(docs), spark.createDataFrame([(9, "a b c"), (None, "c")], "item_id long, text string"))
    assert sorted((r.key, [tuple(s) for s in r.spans], list(r["items"])) for r in found.collect()) == [(1, [(0, 3)], [9]), (2, [(0, 3)], [9]), (2, [(0, 3)], [9]), (3, [(0, 1)], [])]


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta gamma"), (2, "alpha x x x beta gamma"), (3, "alpha beta")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "alpha beta gamma")], "item_id long, text string")
    index = D.build_index(docs)
    hits = lambda slop: sorted(r.key for r in D.search(index, items, window=None, slop=slop).where("n_hit > 0").collect())
    assert hits(0) == [] and hits(1) == [1] and hits(3) == [1, 2]


def test_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "q")], "doc_id long, text string, items string")
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert D.search(D.build_index(none), items).collect() == []
    assert [r.n_hit for r in D.search(D.build_index(docs), items.limit(0)).collect()] == [0]


def test_clean_keeps_rows_and_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", "en"), (None, "x y", None), (None, "a b c", None), (2, None, "fr"), (2, None, "fr")], "doc_id long, text string, lang string")
    out = D.clean(docs, spark.createDataFrame([(1, "B c")], "item_id long, text string"))
    assert out.columns == docs.columns and sorted(map(repr, out.collect())) == sorted(map(repr, docs.where("text IS NULL OR text = 'x y'").collect()))


def test_proximity_names_the_document_of_the_match(spark):
    docs = spark.createDataFrame([(1, "x y z"), (2, "alpha gamma beta delta"), (3, "q alpha q q beta gamma")], "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(5, "alpha beta gamma")], "item_id long, text string")
    found = {r.key: (list(r["items"]), list(r.near_items)) for r in D.search(D.build_index(docs), items, near=2).collect()}
    assert found == {1: ([], []), 2: ([], [5]), 3: ([], [5])}


@pytest.mark.parametrize("seed,segment,near", [(4, 1 << 18, 1), (5, 30, 2), (6, 1, 3)])
def test_proximity_against_every_place(spark, seed, segment, near):
    rng = random.Random(seed)
    letters = "a b c d e f g h".split()
    rows = [(i, " ".join(rng.choices(letters, k=rng.randint(0, 14)))) for i in range(60)]
    items = [(i, " ".join(rng.sample(letters, rng.randint(1, 5)))) for i in range(8)]
    index = D.build_index(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), segment_words=segment)
    got = {r.key: list(r.near_items) for r in D.search(index, spark.createDataFrame(items, "item_id long, text string"), near=near, block_words=9).collect()}
    for key, text in rows:
        w, want = text.split(), []
        for item, body in items:
            b = body.split()
            if any(all(any(0 <= p + k + s < len(w) and w[p + k + s] == x for s in range(-near, near + 1)) for k, x in enumerate(b)) for p in range(-near - 1, len(w) + near + 1)):
                want.append(item)
        assert got[key] == want, (text, got[key], want)


def test_a_task_holds_one_segment_at_a_time(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(f"{rng.randrange(10**9):x}" for _ in range(20_000))) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = D.build_index(docs, segment_words=20_000)
    files = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    groups = [m.row_group(g) for m in files for g in range(m.num_row_groups)]
    assert len(groups) > len(files) and {g.num_rows for g in groups} == {1}
    assert not any(g.column(c).is_stats_set and g.column(c).statistics.has_min_max for g in groups for c in range(g.num_columns))

    found = D.search(index, spark.createDataFrame([(5, " ".join(rows[3][1].split()[50:65]))], "item_id long, text string"))

    def seen(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([b.num_rows], pa.int32()), "bytes": pa.array([b.nbytes], pa.int64())})

    batches = index.coalesce(1).mapInArrow(seen, "rows int, bytes long").collect()
    assert sum(b.rows for b in batches) == len(groups) and sum(b.bytes for b in batches) > 2 * common.BATCH_BYTES
    assert max(b.bytes for b in batches) < common.BATCH_BYTES + (1 << 20)
    assert {r.key: (r.n_words, r.n_hit, list(r["items"])) for r in found.collect()} == {i: (20_000, *((15, [5]) if i == 3 else (0, []))) for i in range(24)}
