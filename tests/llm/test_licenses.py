import random
import re

import pytest

from stormgrid.llm import licenses as L

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return [w.decode() for w in WORD.findall((text or "").encode().lower())]


def brute(text, templates, threshold, block):
    w, found = words(text), set()
    for t in L.in_parts(templates, block):
        phrase = t.text.split()
        least = 1 if len(set(phrase)) < 10 else threshold
        if t.phrase:
            found |= {(t.label, i, 1.0) for i in range(len(w) - len(phrase) + 1) if w[i : i + len(phrase)] == phrase}
            continue
        for start in range(0, max(len(w), 1), block // 2):
            held = set(w[start : start + block])
            share = len(set(phrase) & held) / len(set(phrase))
            if share >= least - 1e-9:
                found.add((t.label, start, share))
    return found


def texts(seed):
    rng = random.Random(seed)
    pool = "the of general public license all rights reserved cc by nc 4 0 mit apache version released under and a gnu this work is licensed x y z".split()
    every = [None, "", "CC-BY", "cc\nby cc by", "General  Public, License!", "All rights\n\nreserved.", "all all rights reserved"]
    every += [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 300))) for _ in range(60)]
    return every + [f"{'zz ' * rng.randint(0, 100)}{t.text} {'yy ' * rng.randint(0, 100)}" for t in L.TEMPLATES]


@pytest.mark.parametrize("seed,threshold,block", [(1, 0.8, 64), (2, 0.5, 64), (3, 1.0, 50)])
def test_equals_brute_force(spark, seed, threshold, block):
    rows = list(enumerate(texts(seed)))
    out = L.scan(spark.createDataFrame(rows, "doc_id long, text string"), threshold=threshold, block=block)
    every = L.BASE + L.TEMPLATES
    for r, (_, text) in zip(sorted(out.collect()), rows, strict=True):
        want = brute(text, every, threshold, block)
        assert {(m.label, m.word, m.containment) for m in r.matches} == want
        places = [(label, i) for t in L.BASE for label, i, _ in brute(text, [t], threshold, block)]
        starts = [i for _, i in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words(text)), len(starts), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for x, _ in places})) and r.labels == ",".join(sorted({x for x, _, _ in want}))
        assert r.score == max((c for _, _, c in want), default=0.0)


def test_frequencies_count_every_word(spark):
    docs = spark.createDataFrame([(1, "a b A"), (2, None), (3, "b,c")], "doc_id long, text string").repartition(2)
    assert L.frequencies(docs, ["a", "b", "z"]) == {"a": 2, "b": 2, "z": 0}


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "cc by", "q")], "doc_id long, text string, score string")
    out = L.scan(docs)
    assert out.columns.count("score") == 1 and out.first().score == 1.0
    assert L.scan(docs.limit(0)).collect() == []
    for wrong in (L.Template("x", ""), L.Template("x", "w " * 40, phrase=True)):
        with pytest.raises(ValueError):
            L.scan(docs, templates=[wrong])


def test_sentences_about_other_licenses_have_no_label(spark):
    rows = [
        (1, "released under the apache license"), (2, "licensed under cc by 4 0"), (3, "under the sea the album was released by a label holding the license"),
        (4, "released under the MIT license"), (5, "Licensed under CC BY NC 4.0"), (6, "Licensed under the Apache License, Version 2.0"),
    ]
    got = {r.doc_id: r.labels for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "", 2: "cc-by", 3: "", 4: "mit", 5: "cc-by,cc-by-nc", 6: "apache-2.0"}


def test_whole_texts_are_found_in_parts(spark):
    whole = next(t for t in L.TEMPLATES if t.label == "mit" and len(t.text.split()) > 32)
    parts = L.in_parts([whole])
    assert " ".join(p.text for p in parts) == whole.text and all(16 <= len(p.text.split()) <= 32 for p in parts)
    words = whole.text.split()
    torn = " ".join(w for i, w in enumerate(words) if i % 12 != 5)  # some words lost on the way
    rows = [(1, "x y " * 500 + torn + " z" * 700), (2, " ".join(words[: len(words) // 3])), (3, " ".join(sorted(set(words))[:12]))]
    got = {r.doc_id: r.labels for r in L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "mit", 2: "mit", 3: ""}
