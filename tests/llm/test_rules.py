import re

from stormgrid.llm import rules as R


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, w in enumerate(wins) if wins.count(w) > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t", "one", "a b c d e", "a b c d e a b c d e", "x " * 30, "a b c d e f a b c d e g a b c d e", "l1\nl1\n \nl1\nL1\n", "\u00a0no break\x1cspace 🙂 é",
    "#|<> &&& the\r\nthe\r\nthe", "1 2 3 4 5 6 " * 3 + "7", "w " + " ".join(str(i % 7) for i in range(40)), "\nlead and trail\n",
]


def test_measures_equal_brute_force(spark):
    docs = spark.createDataFrame([(i, t, "q") for i, t in enumerate(TEXTS)], "doc_id long, text string, kept string")
    out = R.judge(docs)
    assert out.columns.count("kept") == 1
    for r in out.collect():
        n, chars, signs, lines, repeats = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, signs, lines, repeats), repr(r.text)
        assert r.base_failed == (n < 10 or 100 * repeats > 20 * n)


def test_thresholds(spark):
    clean = "The river of the valley is wide and it runs to the sea in summer with cold water. " * 1
    texts = {"clean": clean, "signs": clean.replace(" ", "*** "), "loud": clean.upper(), "lines": "\n".join(["of it"] * 3 + [clean + str(i) for i in range(2)]), "strange": " ".join(f"zq{i}" for i in range(60))}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    got = {r.doc_id: r.kept for r in R.judge(docs).collect()}
    assert got["clean"] and not got["signs"] and not got["loud"] and not got["strange"]


def test_long_text_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = spark.createDataFrame([(1, long), (2, long + " " + long), (2, "a\n" * 30_000)], "doc_id long, text string")
    assert sorted((r.n_words, r.n_repeat_words, r.n_dup_lines) for r in R.judge(docs).collect()) == [(30_000, 0, 0), (30_000, 30_000, 29_999), (60_000, 60_000, 0)]
    assert R.judge(docs.limit(0)).collect() == []


def test_one_projection_without_python_or_shuffle(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = R.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
