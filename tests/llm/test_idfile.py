import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stormgrid.llm import idfile
from stormgrid.session import work_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
@pytest.mark.parametrize("high", [1, 2, 50, 49_408, 2**32 - 1])
def test_pages_round_trip(n, high):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, high, n, dtype=np.uint32)
    ids[rng.random(n) < 0.03] = high - 1
    page = idfile.pack(ids)
    assert (idfile.unpack(page) == ids).all() and len(idfile.unpack(page)) == n
    if n > 300:
        assert (idfile.unpack(page, 1, 3) == ids[128:384]).all() and (idfile.unpack(page, 2) == ids[256:]).all()


def test_outliers_are_exceptions():
    ids = np.full(128, 7, dtype=np.uint32)
    ids[[3, 90]] = 2**31
    assert len(idfile.pack(ids)) == 4 * 5 + 6 + 2 * 5  # width 0: nothing but the two exceptions


def test_written_and_read_back(spark):
    rows = [(5, "The cat"), (None, "x"), (2, None), (2, "b"), (9, " ".join(f"word{i}" for i in range(3000))), (7, ""), (9, "a<|endoftext|>")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n_tokens int").repartition(3)
    path = work_path(spark, "ids-test")
    idfile.write(docs, path, PATH, end_id=2, page_ids=50)
    tokenizer, start, want = Tokenizer.from_file(PATH), 0, []
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], dtype="<u4")
        want.append((k, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [(r.key, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in idfile.read(spark, path).collect()]
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty_table(spark):
    path = work_path(spark, "ids-test")
    idfile.write(spark.createDataFrame([], "doc_id long, text string"), path, PATH, end_id=2)
    assert idfile.read(spark, path).collect() == []


def test_words_equal_whole_texts():
    import random

    from test_bpe import PARTS

    encode, tokenizer, rng = idfile.library_encoder(PATH, words_kept=40, pieces_kept=60), Tokenizer.from_file(PATH), random.Random(3)
    for _ in range(2000):
        text = "".join(rng.choice([*PARTS, "\x00", "don't", "AB12cd", "_-", "'S", " x", "Œuvre", "ÀÉ×÷ß", "ŉſŸ", "señor,", "ĲÇ'S", "e\u0301"]) for _ in range(rng.randint(0, 12)))
        got = list(memoryview(b"".join(encode([text.encode()]))).cast("I"))
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_worker_keeps_its_encoder():
    """The next task of a worker takes the encoder with all words met; a text has the same ids either way, whatever stands beside it."""
    encode, texts = idfile.worker_encoder(PATH), [b"The cat's 12 hats", b"", b" hats,\x0bcat ", "Œuvre\u00a0x\x85y".encode(), b"a<|endoftext|> b"]
    assert idfile.worker_encoder(PATH) is encode
    want = [Tokenizer.from_file(PATH).encode(t.decode(), add_special_tokens=False).ids for t in texts]
    for _ in range(2):
        assert [list(memoryview(b).cast("I")) for b in encode(texts)] == want
        assert [list(memoryview(encode([t])[0]).cast("I")) for t in texts] == want
