import array
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stormgrid.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "B", "é", "É", "é", "ΑΣ", "İ", "ß", "<|endoftext|>", "<|start", " ", "\x1c", "\x85", "\n", "'s", "'LL", "1", "٣", "½", "漢字", "🙂", "ﬁ", "!!", "the", "tion", "한국", "xyz" * 30]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(encode, text):
    return list(memoryview(encode(text.encode())).cast("I"))


def test_equals_library_on_mixed_texts(library):
    encode, rng = bpe.encoder(PATH), random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9)))
        assert ids(encode, text) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_word_and_forgetful_memory(library):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(30_000)) + " the end"
    assert ids(bpe.encoder(PATH, words_kept=1), text) == library.encode(text, add_special_tokens=False).ids


def test_merge_takes_leftmost_of_lowest_rank():
    # aaa: both pairs have rank 0, the left one merges first.
    assert bpe.merge_word([1, 1, 1], {1 << 32 | 1: 0}, [2]) == [2, 1]
    assert bpe.merge_word([1, 2, 3], {1 << 32 | 2: 5, 2 << 32 | 3: 1}, [0, 9, 0, 0, 0, 8]) == [1, 9]
    assert bpe.merge_word([7], {}, []) == [7] and bpe.merge_word([], {}, []) == []


def test_rows_nulls_and_clashing_columns(spark, library):
    rows = [(1, None, "x", b"y"), (2, "", "x", b"y"), (3, "The cat's hat", None, None), (3, "The cat's hat", None, None), (None, "x <|endoftext|> y", "x", b"y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids binary")
    out = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert len(out) == 5
    for r in out:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert list(array.array("I", bytes(r.ids))) == want and r.n_tokens == len(want)
        assert r.decoded == library.decode(want, skip_special_tokens=False)


def test_plain_text_round_trip(spark):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "naïve 🙂")], "doc_id long, text string")
    assert sorted(r.plain for r in bpe.plain_text(bpe.encode(docs, PATH), PATH).collect()) == ["naïve 🙂", "the cat sat on the mat"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, PATH), PATH).collect() == []
