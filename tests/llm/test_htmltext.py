import random
import re
import time
import pytest

from stormgrid.llm import htmltext as H

LONG = "This is a sentence of the article that is long enough to matter for the sums of a window of lines."

CASES = {
    "article": (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a>Home</a></nav><div class='ad'>{LONG}</div><article><h1>Head</h1><p>One <b>two<br>three</p><p>Four</p></article><footer>&copy; x</footer>", "Head\n\nOne two three\n\nFour"),
    "unclosed inline": ("<article><p><b>A<br><p>B</p><p>C</article>D", "A\n\nB\n\nC"),
    "inside an article": (f"<article><header><h1>T</h1></header><p>x</p><aside>side</aside><form>f</form><div class='cookie-notice'>n</div><p>y</p><section id='comments'><p>{LONG}</p></section><footer>f</footer></article>", "T\n\nx\n\ny"),
    "no article": (f"<ul class=menu><li><a href=x>Home</a></ul><div><a href=1>Link one</a> <a href=2>Link two</a></div><div></div><div></div><div></div><p>{LONG}</p><p>short</p><div></div><div></div><div></div><div>tiny</div>", f"{LONG}\n\nshort"),
    "references": ("<article><p>a &lt;b&gt; &amp;amp; &eacute;&#233;&nbsp;c  \n d</p></article>", "a <b> &amp; éé c d"),
    "scripts": ("<article><p>a</p><script>var t='</p><p>no</p>';</script><!-- <p>no</p> --><p>b</p><style>x", "a\n\nb"),
    "less than": ("<article><p>1 < 2 and a<3</p></article>", "1 < 2 and a<3"),
    "hidden": ("<article><p>a</p><div hidden>b</div><div style='display: none'>c</div></article>", "a"),
    "header outside": ("<header><p>site</p></header><main><p>a</p></main>", "a"),
    "text only": ("just text", "just text"), "empty": ("", ""), "null": (None, ""), "no text": ("<div><p></p></div>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_main_text(name):
    page, want = CASES[name]
    assert H.main_text(page or "") == want


def test_surge_and_dive():
    gap = "<div></div>" * 4
    page = f"<p>few</p>{gap}<p>{LONG}</p><p>x</p>{gap}<p>few</p>{gap}<p>{LONG}</p>"
    assert H.main_text(page) == f"{LONG}\n\nx\n\n{LONG}"


def test_rows(spark):
    rows = [(i, "u", page, "q") for i, (page, _) in enumerate(CASES.values())] + [(0, "u", "<p>" + "word " * 100_000, None), (0, None, "<a \"" * 2000, None)]
    got = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = got.collect()
    assert [r.text for r in out[: len(CASES)]] == [want for _, want in CASES.values()] and all(r.n_chars == len(r.text) for r in out) and out[-2].n_chars == 499_999
    assert H.extract(spark.createDataFrame([], "page_id long, html string")).collect() == []


def test_whole_pages_of_the_table(spark):
    """Every page of the test table shows a document under a title of its first characters."""
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in H.extract(spark.read.parquet(f"{folder}/pages.parquet")).collect():
        number = int("".join(c for c in r.url.split("://")[1].split("/")[2].split(".")[0].split("?")[0].split("#")[0] if c.isdigit()))
        lines = [" ".join(x.split()) for x in texts[number].split("\n")]
        assert r.text.split("\n\n")[1:] == [x for x in lines if x]


def test_articles_are_weighed_not_switched_on():
    gap = "<div></div>" * 4
    # A teaser or comment in an article does not displace the text outside it.
    assert H.main_text(f"<div><p>{LONG}</p><p>more</p></div>{gap}<article><p>Read on</p></article>") == f"{LONG}\n\nmore"
    assert H.main_text(f"<div><p>{LONG}</p></div><article class='comment'><p>I say {LONG}</p></article>") == LONG
    assert H.main_text(f"<p>{LONG}</p><main hidden><p>{LONG} twice</p></main><article id='comment-7'>{LONG}</article>") == LONG
    # The threshold holds inside as well, with more weight.
    assert H.main_text(f"<article><p>{LONG}</p>{gap}<p>ad</p>{gap}<p>A short but whole sentence.</p></article>{gap}<p>A short but whole sentence.</p>") == f"{LONG}\n\nA short but whole sentence."
    assert H.main_text(f"<article><p>{LONG}</p></article><div>tiny</div>") == LONG


#: The tokens as one pattern, in order of precedence: comment, element whose content is no markup, other declaration, tag.
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({H.RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<[!?][^>]*>|<(/?)([a-z][a-z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.IGNORECASE | re.DOTALL,
)


def test_tokens_equal_one_pattern():
    rng = random.Random(8)
    parts = ["<", ">", "a", "<a ", "</a>", "<p>", "<script", "</script >", "<!--", "-->", "<!", "?", '"', "'", "=", " ", "<b x='", "<i y=\"", "/>", "<Style>", "x"]
    for _ in range(20_000):
        page = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        want = [(m.start(), m.end(), bool(m[2]), (m[3] or "").lower(), m[4] or "") for m in TOKEN.finditer(page)]
        assert list(H.tokens(page)) == want, page


@pytest.mark.parametrize("part", ["<a ", "<a href=x>", "<a \"'", "<script ", "</b><i>", "<p><b>", "<!", "<!--", "<a \"\" '", "<div></span>"])
def test_broken_markup_takes_linear_time(part):
    page = part * (1_000_000 // len(part))
    began = time.process_time()
    H.main_text(page + "'")
    assert time.process_time() - began < 20  # seconds where a quadratic scan takes hours; 1 to 3 on an idle machine


def test_kept_lines_against_plain_sums():
    """Every window added up by itself, stretches found line by line."""
    rng = random.Random(9)
    for _ in range(300):
        blocks = [("<article>" if rng.random() < 0.1 else "</article>" if rng.random() < 0.1 else "") + f"<p>{'<a>' if rng.random() < 0.2 else ''}{'w' * rng.choice([0, 1, 5, 30, 90])}</p>" for _ in range(12)]
        page = "".join(blocks)
        lines = H.lines_of(page)
        weights = [H.weight_of(*line) for line in lines]
        sums = [sum(weights[j] for j in range(i, min(i + H.WINDOW, len(lines))) if all(lines[k][3] == lines[i][3] for k in range(i, j + 1))) for i in range(len(lines))]
        least = max(min(H.SURGE, max(sums)), 1)

        def stretch(i):
            """Lines of positive sum around i, all inside or all outside."""
            a = b = i
            while a > 0 and sums[a - 1] and lines[a - 1][3] == lines[i][3]:
                a -= 1
            while b + 1 < len(lines) and sums[b + 1] and lines[b + 1][3] == lines[i][3]:
                b += 1
            return range(a, b + 1)

        want = [line[0] for i, line in enumerate(lines) if weights[i] and max(sums[j] for j in stretch(i)) >= least]
        assert H.main_text(page) == "\n\n".join(want)
