"""The stages of the pipeline on the small tables, each against a plain version of its decision."""

import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent))

import corpus_pipeline as C  # noqa: E402
from test_decontaminate import brute as windows  # noqa: E402
from test_simhash import fingerprint, labels  # noqa: E402

from stormgrid.session import materialize  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in C.STAGES:
        docs.append(materialize(stage(spark, docs[-1], FOLDER)))
    return docs


def ids(frame):
    return {r.doc_id for r in frame.select("doc_id").collect()}


def test_all_but_the_last_return_documents(spark, steps):
    assert all(d.columns == steps[0].columns for d in steps[1:-1]) and len(C.STAGES) == 5
    text = {r.doc_id: r.text for r in steps[0].collect()}
    assert all(r.text == text[r.doc_id] for d in steps[1:-1] for r in d.collect())


def test_filters_keep_clean_documents(spark, steps):
    good = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1").collect()}
    long = {r.doc_id for r in steps[1].selectExpr("doc_id", "size(split(text, ' ')) AS n").where("n > 20").collect()}
    assert len(good & ids(steps[1])) >= 0.97 * len(good) and len(good & ids(steps[2])) >= 0.95 * len(good & long)
    assert len(ids(steps[0])) > len(ids(steps[2]))


def test_one_document_of_each_group(steps):
    rows = sorted((r.doc_id, r.text) for r in steps[2].collect())
    groups = labels([fingerprint(t) for _, t in rows], 4)
    least = {g: min(k for (k, _), h in zip(rows, groups, strict=True) if h == g) for g in np.unique(groups)}
    assert ids(steps[3]) == set(least.values()) and steps[3].count() == len(least)


def test_contaminated_documents_go(spark, steps):
    rows = [(r.doc_id, r.text) for r in steps[3].collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert ids(steps[4]) == {k for (k, _), (_, hit, _) in zip(rows, windows(rows, items), strict=True) if not hit}


def test_last_stage_encodes(steps):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    text = {r.doc_id: r.text for r in steps[4].collect()}
    out = steps[5].collect()
    assert len(out) == len(text) and all(list(memoryview(bytes(r.ids)).cast("I")) == tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids for r in out)


def test_nulls_and_repeats_pass(spark):
    clean = "The river of the valley is wide and it runs to the sea in summer with cold water"
    rows = [(None, clean, None, None, None), (1, None, "en", "s", 0), (1, "", None, None, None), (2, clean, "en", "s", 5), (2, clean, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).collect() == [], name
        docs = materialize(stage(spark, docs, FOLDER))
    assert docs.count() <= 1
