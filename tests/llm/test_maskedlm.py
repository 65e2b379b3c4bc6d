import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stormgrid.llm import maskedlm as M
from stormgrid.llm.perplexity import TOKEN

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    rng = np.random.default_rng(0)
    # The token between two others is always the same for the pair around it.
    text = lambda: " ".join(f"a{k} m{k} b{k}" for k in rng.integers(0, 4, 60))
    docs = spark.createDataFrame([(i, text().replace("0", "x").replace("1", "y").replace("2", "z").replace("3", "w")) for i in range(400)], "doc_id long, text string").repartition(2)
    return docs, M.fit(docs, rounds=2)


def by_hand(model, text):
    """Sum over the places of one text, each computed by itself."""
    tokens = re.findall(TOKEN, text or "")
    classes = [M.token_class(t) for t in tokens]
    counts = {r.token: r.n for r in model.counted.collect()}
    total = 0.0
    for p, token in enumerate(tokens):
        around = [classes[q] if 0 <= q < len(tokens) else M.CLASSES for q in (p - 2, p - 1, p + 1, p + 2)]
        logits = model.network.hidden(np.array([around]))[2][0].astype(np.float64)
        total += logits[classes[p]] - np.log(np.exp(logits).sum()) + np.log(counts.get(token, 1) / (model.sizes.get(classes[p], 0) + 1))
    return len(tokens), total


def test_learns_from_both_sides(trained):
    _, model = trained
    c = M.token_class
    context = np.array([[c("bx"), c("ay"), c("by"), c("ax")], [c("by"), c("az"), c("bz"), c("ax")]])
    assert model.network.hidden(context)[2].argmax(axis=1).tolist() == [c("my"), c("mz")]


@pytest.mark.parametrize("hot", [0, 3, 1000])
def test_scores_equal_place_by_place(spark, trained, hot, monkeypatch):
    _, model = trained
    monkeypatch.setattr(M, "REMEMBERED", 1)
    texts = ["ax mx bx ay", "my", "ay AY by unknown 12 !! unknown", "", None, "mz Mz 'mz' ax"]
    got = {r.doc_id: r for r in M.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, hot_tokens=hot).collect()}
    for i, t in enumerate(texts):
        n, total = by_hand(model, t)
        assert got[i].n_tokens == n and got[i].log_likelihood == pytest.approx(total, abs=1e-3)


def test_classes_cover_all_tokens():
    tokens = ["a", "the", "running", "T", "The", "Running", "AB", "ABCD", "aB", "McDonald", "1", "12345", "!", "!?!?", "___", "é", "Ünï", "中文", "ß"]
    assert {0 <= M.token_class(t) < M.CLASSES for t in tokens} == {True}
    assert M.token_class("walking") == M.token_class("talking") and M.token_class("The") != M.token_class("the")


def test_counts_cover_the_corpus(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b, c"), (3, None)], "doc_id long, text string")
    model = M.fit(docs)
    assert {r.token: r.n for r in model.counted.collect()} == {"a": 2, "b": 2, "c": 1, ",": 1} and sum(model.sizes.values()) == 6


def mean(spark, docs, model):
    return M.score(docs, model).agg(F.sum("log_likelihood") / F.sum("n_tokens")).first()[0]


def test_the_layout_of_the_rows_does_not_matter(spark):
    """The given documents in 1, 5 and 16 partitions, trained in several blocks: the same scores, and all better than untrained."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    models = {n: M.fit(docs.repartition(n), block_bytes=100_000) for n in (1, 5, 16)}
    found = {n: {r.doc_id: r.mean_log_likelihood for r in M.score(docs, m).collect()} for n, m in models.items()}
    for n in (5, 16):
        assert max(abs(found[n][i] - found[1][i]) for i in found[1] if found[1][i] is not None) < 0.02
    one = models[1]
    untrained = M.Model(M.Network.start(), one.sizes, one.counted)
    trained = mean(spark, docs, one)
    assert trained > mean(spark, docs, untrained) + 1.0
    assert trained == pytest.approx(mean(spark, docs, models[16]), abs=0.005)


def test_every_row_trains_once(spark):
    """Copies spread over rounds and blocks, and no row is left out."""
    docs = spark.createDataFrame([("one text",)] * 2000 + [(f"text {i}",) for i in range(500)] + [(None,), ("",)], "text string").repartition(7)
    rows = M.dealt(docs, "text", 3, 1000)
    assert rows.count() == 2500
    held = rows.groupBy("round", "block").agg(F.count("*").alias("n"), F.count_if(F.col("text") == "one text").alias("copies")).collect()
    assert len(held) > 15 and max(r.copies for r in held) < 400
    assert M.fit(docs).counted.where("token = 'text'").first().n == 2500


def test_edges(spark):
    rows = [(1, None, 2), (2, "", 2), (None, "a b", 2), (4, "a b", None), (4, "a b", None), (5, "w " * 20_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = M.score(docs, M.fit(docs)).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 2, 2, 2, 20_000]
    assert {(r.log_likelihood, r.mean_log_likelihood) for r in got if r.n_tokens == 0} == {(0.0, None)}
    assert M.score(docs.limit(0), M.fit(docs.limit(0))).collect() == []


def test_a_batch_trains_as_by_hand():
    """One step of the network against gradients written out plainly, in double precision."""
    rng = np.random.default_rng(4)
    flat, counts = rng.integers(0, M.CLASSES, 300).astype(np.int16), np.array([0, 120, 1, 179, 0])
    context = M.windows(flat, counts, M.CLASSES)
    ends = np.cumsum(counts)
    for begin, end in zip(ends - counts, ends, strict=True):
        for i in range(begin, end):
            assert context[i].tolist() == [flat[j] if begin <= j < end else M.CLASSES for j in (i - 2, i - 1, i + 1, i + 2)]
    network = M.Network.start()
    w = {k: v.astype(np.float64) for k, v in network.weights.items()}
    inputs = w["embed"][context].reshape(len(flat), -1)
    hidden = np.hstack([np.tanh(inputs @ w["in"] + w["in_bias"]), np.ones((len(flat), 1))])
    wrong = np.exp(hidden @ w["out"])
    wrong /= wrong.sum(axis=1, keepdims=True)
    wrong[np.arange(len(flat)), flat] -= 1
    wrong /= len(flat)
    back = (wrong @ w["out"][:-1].T) * (1 - hidden[:, :-1] ** 2)
    embed = np.zeros_like(w["embed"])
    np.add.at(embed, context.reshape(-1), (back @ w["in"].T).reshape(-1, M.WIDTH))
    start = network.packed()
    network.train(context, flat)
    for name, grad in {"out": hidden.T @ wrong, "in": inputs.T @ back, "in_bias": back.sum(axis=0), "embed": embed}.items():
        squares = 0.01 + grad**2
        assert np.allclose(network.squares[name], squares, atol=1e-6)
        assert np.allclose(network.weights[name], w[name] - M.RATE * grad / np.sqrt(squares + 1e-6), atol=1e-5)
    assert (M.Network.start().packed() == start).all()


def test_big_tables_move_in_small_types():
    """Windows keep the type of their classes, and a task's classes are short integers."""
    found, counts = M.Counted().add([b"a b, c", b"", "é 12".encode()])
    assert found.dtype == np.int16 == M.windows(found, counts, M.CLASSES).dtype and counts.tolist() == [4, 0, 2]
