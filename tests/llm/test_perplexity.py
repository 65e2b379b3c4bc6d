import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from stormgrid.llm import perplexity as P

TEXTS = ["the cat sat on the mat", "the cat ran", "a dog sat on the log", "the dog ran on", "the cat sat", "a cat and a dog sat on the mat and ran"]


def reference(texts, vocabulary):
    """Interpolated modified Kneser-Ney by plain dictionaries."""
    of = P.token_ids(vocabulary)
    c3 = Counter()
    for t in texts:
        ids = [0, 0, *of([t.encode()])[0].tolist()]
        c3.update(zip(ids, ids[1:], ids[2:], strict=False))
    c2 = Counter((v, w) for _, v, w in c3)
    c1 = Counter(w for _, w in c2)

    def cuts(c):
        n = [0] + [sum(v == i for v in c.values()) for i in range(1, 5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
        return [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.0), i * 0.95) if n[i] else 0.5 * min(i, 1) for i in (1, 2, 3)]

    d1, d2, d3 = cuts(c1), cuts(c2), cuts(c3)
    cut = lambda d, c: d[min(c, 3) - 1] if c else 0
    total1, gamma1 = sum(c1.values()), sum(cut(d1, c) for c in c1.values())
    p1 = lambda w: (c1[w] - cut(d1, c1[w])) / total1 + gamma1 / total1 / len(vocabulary)
    by2, by3 = defaultdict(list), defaultdict(list)
    for (v, _), c in c2.items():
        by2[v].append(c)
    for (u, v, _), c in c3.items():
        by3[u, v].append(c)

    def p2(v, w):
        if v not in by2:
            return p1(w)
        return (c2[v, w] - cut(d2, c2[v, w]) + sum(cut(d2, c) for c in by2[v]) * p1(w)) / sum(by2[v])

    def p3(u, v, w):
        if (u, v) not in by3:
            return p2(v, w)
        return (c3[u, v, w] - cut(d3, c3[u, v, w]) + sum(cut(d3, c) for c in by3[u, v]) * p2(v, w)) / sum(by3[u, v])

    return p3


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    return P.fit(docs, docs.select("doc_id"))


def test_probabilities_equal_reference(spark, model):
    p3, v = reference(TEXTS, model.vocabulary), len(model.vocabulary) + 1
    rng = np.random.default_rng(0)
    keys = [tuple(int(x) for x in rng.integers(0, v, 3)) for _ in range(400)]
    keys = [(a, b, c or 1) for a, b, c in keys]
    got = model.scores(np.array([a << 42 | b << 21 | c for a, b, c in keys], dtype=np.int64))
    assert np.allclose(got, [math.log(p3(*k)) for k in keys], rtol=1e-4, atol=1e-4)


def test_probabilities_sum_to_one(model):
    v = len(model.vocabulary)
    for a, b in ((0, 0), (0, 9), (9, 8), (3, 3)):
        keys = np.array([a << 42 | b << 21 | c for c in range(1, v + 1)], dtype=np.int64)
        assert np.exp(model.scores(keys)).sum() == pytest.approx(1, abs=1e-4)


def test_shapes():
    assert [P.shape(t) for t in ("abc", "Abc", "ABC", "aBc", "A", "12", "!!", "É")] == ["<lower>", "<Title>", "<UPPER>", "<miXed>", "<Title>", "<number>", "<signs>", "<Title>"]


def test_classifier_on_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    judged = P.classify(docs, labels).join(labels, "doc_id").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert len(judged) == labels.count() and np.mean(good) > 0.98 and np.mean(bad) < 0.35


def test_edges(spark):
    rows = [(1, None, "en", "q"), (2, "", None, "q"), (None, "word here", None, None), (3, "ab " * 5000, "xx", "q"), (3, "ab " * 5000, "xx", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = P.classify(docs, none).collect()
    assert sorted((r.doc_id or 0, r.kept, r.perplexity) for r in got) == [(0, True, None), (1, False, None), (2, False, None), (3, True, None), (3, True, None)]
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    assert len(P.classify(docs, labels).collect()) == 5
    assert P.classify(docs.limit(0), labels).collect() == []


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * (i % 50 + 1)) for i in range(3000)], "doc_id long, text string")
    chosen = P.trusted_sample(docs, docs.select("doc_id"), chars=5000)
    total = docs.join(chosen, "doc_id").selectExpr("sum(length(text))").first()[0]
    assert 2500 < total <= 5000


def test_counts_cover_all_trusted_text(spark):
    """More text than the bounded sample of earlier rounds (6 million characters) held, one document as long as that by itself."""
    rows = [(i, "ab cd " * 1500) for i in range(100)] + [(100, "ef gh " * 1_100_000), (101, "not trusted")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = P.fit(docs, docs.where("doc_id <= 100").select("doc_id"))
    assert {r.word: r.n for r in model.words.collect()} == {"ab": 150_000, "cd": 150_000, "ef": 1_100_000, "gh": 1_100_000}
    ids = model.vocabulary
    key = lambda *words: sum(ids[w] << 21 * (2 - i) for i, w in enumerate(words))
    seen, unseen = model.scores(np.array([key("ef", "gh", "ef"), key("ef", "gh", "ab")]))
    assert seen > math.log(0.99) > unseen


def test_numbered_words_equal_whole_texts(monkeypatch):
    """Tokens found word by word, with a memory that is emptied now and then, are those of the whole texts."""
    import random
    import re

    monkeypatch.setattr(P, "REMEMBERED", 20)
    rng = random.Random(1)
    bits = ["a", "Ab", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "_", "__", "1", "²", "½", "é", "ß", "中文", "!", "...", "'", "٣", "e\u0301", "\x00", "\u200b", "😀"]
    numbered = P.Numbered(["a", "zz"])
    for _ in range(500):
        texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))).encode() for _ in range(rng.randint(0, 6))] + [b"ab\xc3 \xff\xfe x\xe4\xb8"] * rng.randint(0, 1)
        found, counts = numbered.of(texts)
        want, names = [re.findall(P.TOKEN, t.decode("utf-8", "replace")) for t in texts], list(numbered.tokens)
        assert [names[i] for i in found] == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]
    assert names[:2] == ["a", "zz"]


def test_a_worker_keeps_words_of_one_vocabulary(monkeypatch):
    """Words met in one task are not looked up again in the next, and another vocabulary starts anew."""
    import numpy as np

    asked = []
    monkeypatch.setattr(P.Words, "of", lambda self, words: asked.extend(words) or np.full(len(words), 7 if self is one else 8))
    one, two = (P.Words(np.zeros(0, np.int64), np.zeros(0, np.int32)) for _ in range(2))
    for words, new, want in [(one, ["a", ",", "b"], 7), (one, [], 7), (two, ["a", ",", "b"], 8)]:
        asked.clear()
        with P.reader(words) as of:
            ids, counts = of([b"a, b a", b"", b"b"])
        assert (asked, ids.tolist(), counts.tolist()) == (new, [want] * 5, [4, 0, 1])
