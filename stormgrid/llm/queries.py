"""The queries of this subpackage and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgrid.llm import bpe, conversations, decontaminate, htmltext, idfile, licenses, maskedlm, merkle, perplexity, rules, simhash, urlfilter, warc
from stormgrid.llm.common import load
from stormgrid.session import work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    QUERIES[function.__name__] = function
    return function


def word_vocabulary() -> str:
    """Path of the word-level vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Digest of item ids as the contract states it: sorted as text, comma-joined.
ITEMS_DIGEST = "sha2(array_join(array_sort(transform(items, i -> cast(i AS string))), ','), 256)"


@query
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie inside ten-word windows of benchmark items."""
    index = decontaminate.build_index(load(spark, folder, "documents"))
    found = decontaminate.search(index, load(spark, folder, "benchmark"), near=decontaminate.NEAR)
    return found.select(
        F.col("key").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.expr(ITEMS_DIGEST).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


SQL["op1_decontaminate"] = r"""
WITH item AS (SELECT item_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '\x00', ' ', 'g'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_win AS (SELECT item_id, least(10, len(w)) AS n, w[i:i + least(10, len(w)) - 1] AS b, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
size_of AS (SELECT DISTINCT n FROM item_win),
doc_win AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size_of WHERE len(w) >= n)),
hit AS (SELECT d.r, d.i, d.n, b.item_id FROM doc_win d JOIN item_win b ON d.n = b.n AND d.s = b.s),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
place AS (SELECT r, w AS v, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM doc),
often AS (SELECT word, count(*) AS n FROM place GROUP BY word),
part AS (SELECT b, n, unnest(range(1, len(b) + 1)) AS k, unnest(b) AS word FROM (SELECT DISTINCT b, n FROM item_win)),
rarest AS (SELECT b, part.n, arg_min(k, (coalesce(often.n, 0), k)) AS k FROM part LEFT JOIN often USING (word) GROUP BY b, part.n),
anchor AS (SELECT DISTINCT r, v, b, n, p - k + shift AS a FROM rarest JOIN place ON word = b[k], range(-2, 3) s(shift)),
close AS (SELECT DISTINCT r, b FROM anchor WHERE len(list_filter(range(1, n + 1), lambda k: list_contains(v[CAST(greatest(a + k - 2, 1) AS BIGINT):CAST(greatest(a + k + 2, 0) AS BIGINT)], b[k]))) = n),
beside AS (SELECT r, count(DISTINCT item_id) AS n_near_items FROM close JOIN item_win USING (b) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
  CAST(coalesce(n_near_items, 0) AS BIGINT) AS n_near_items
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r) LEFT JOIN beside USING (r)"""


@query
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Perplexity, bound and verdict of every document."""
    judged = perplexity.classify(load(spark, folder, "documents"), load(spark, folder, "labels"))
    return judged.select("doc_id", "lang", "n_tokens", "perplexity", "bound", "kept")


#: Given rules: verdict, host, path.
GIVEN_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url; a url's label is that of the document whose number ends its path."""
    pages, labels = load(spark, folder, "pages").select("page_id", "url"), load(spark, folder, "labels")
    number = F.expr(r"try_cast(regexp_extract(url, '://[^/?#]*/[a-z]+/([0-9]+)', 1) AS bigint)")
    shown = pages.select("url", number.alias("doc_id")).join(labels, "doc_id")
    labelled = shown.select("url", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urlfilter.judge(pages, GIVEN_RULES, labelled).select("page_id", "host", "path", "rule", "verdict")


@query
def op4_masked_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Masked pseudo-likelihood of every document under a network trained on the same corpus."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return maskedlm.score(docs, maskedlm.fit(docs))


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = rules.judge(load(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_IN_RANGE = " AND ".join(
    f"({expression} {sign} {bound} OR n_words < {rule.from_words})"
    for rule in rules.RULES
    for sign, bound in ((">=", rule.low), ("<=", rule.high))
    if bound is not None
    for expression in [{
        "mean_word_chars": "CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END", "symbol_ratio": "CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END",
        "capital_ratio": "CASE WHEN word_chars > 0 THEN n_capitals / word_chars ELSE 0 END", "stop_word_ratio": "CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0 END",
        "dup_line_ratio": "CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END",
    }[rule.measure]]
)
SQL["op5_quality_rules"] = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) > 5)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM win) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
measured AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals,
  len(list_filter(w, lambda x: list_contains([{", ".join("'" + x + "'" for x in rules.STOP_WORDS)}], lower(x)))) AS n_stop,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS held FROM doc),
counted AS (SELECT *, len(held) AS n_lines, CAST(len(held) - len(list_distinct(held)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_rep FROM measured LEFT JOIN rep USING (r)),
based AS (SELECT *, n_words < 10 OR 100 * n_rep > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_rep AS n_repeat_words, base_failed, NOT base_failed AND {_IN_RANGE} AS kept FROM based"""


@query
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(load(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


#: The id that ends each document.
END_ID = 2


@query
def op7_id_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, read back from the files they were written to, as digests."""
    path = work_path(spark, "ids")
    idfile.write(load(spark, folder, "documents").select("doc_id", "text"), path, word_vocabulary(), END_ID)
    return idfile.read(spark, path).select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_html_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(load(spark, folder, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


@query
def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and templates found in every document."""
    return licenses.scan(load(spark, folder, "documents").select("doc_id", "text")).drop("matches")


def _listed(templates: list[licenses.Template], distinct: bool) -> str:
    rows = []
    for t in templates:
        words = sorted(set(t.text.split())) if distinct else t.text.split()
        rows.append(f"('{t.label}', [{', '.join(repr(w) for w in words)}])")
    return "VALUES " + ", ".join(rows)


SQL["op9_license_scan"] = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
phrase(label, p) AS ({_listed(licenses.BASE, False)}),
template(label, p) AS ({_listed(licenses.in_parts(licenses.TEMPLATES), True)}),
word AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
place AS (SELECT r, i - 1 AS i, label FROM word JOIN phrase ON w[i] = p[1] AND w[i:i + len(p) - 1] = p),
block AS (SELECT r, w[s + 1:s + {licenses.BLOCK}] AS b FROM (SELECT r, w, unnest(range(0, len(w), {licenses.BLOCK // 2})) AS s FROM doc)),
alike AS (SELECT r, label, CASE WHEN len(p) < {licenses.SHORT} THEN 1 ELSE {licenses.THRESHOLD} END AS least, len(list_filter(p, lambda x: list_contains(b, x))) / len(p) AS c FROM block, template),
base AS (SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM place GROUP BY r),
found AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(c) AS score
  FROM (SELECT r, label, c FROM alike WHERE c >= least - 1e-9 UNION ALL SELECT r, label, 1.0::DOUBLE FROM place) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(base.labels, '') AS base_labels, coalesce(found.labels, '') AS labels, coalesce(score, 0) AS score
FROM doc LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""


@query
def op10_bpe_codec(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, word_vocabulary(), decoded=True, drop=("text",))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "utf-8"), 256).alias("decoded_sha256"))


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults planted in every conversation and their cheapest repair."""
    damaged = conversations.damage(load(spark, folder, "conversations"))
    return conversations.repair(damaged, present="present")


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, way to the root, and check of every document after a third of them was tampered with."""
    def leaf(text):
        return merkle.leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = load(spark, folder, "documents")
    leaves = docs.select("doc_id", "lang", leaf(F.col("text")).alias("leaf"), F.when(hit, leaf(lowered)).alias("tampered"))
    proved = merkle.manifest(leaves, "lang", "doc_id", carried=("tampered",))
    folded = proved.withColumn("folded_root", merkle.fold(F.col("steps"), F.coalesce("tampered", "leaf")))
    return folded.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query
def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's record, written to archives and read back through their index."""
    path, pages = work_path(spark, "warc"), load(spark, folder, "pages")
    warc.write(pages, path)
    found = warc.read(spark, path, pages.schema["page_id"].dataType.simpleString())
    return found.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The checksum table of CRC-32 in SQL, and the checksum of an ASCII text by it.
_CRC_TABLE = "SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS v FROM range(256) b(n))"
_CRC = "xor(list_reduce(list_transform(string_split({0}, ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"

SQL["op11_warc"] = r"""
WITH page AS (SELECT page_id, coalesce(html, '') AS html, row_number() OVER w AS r, first_value(page_id) OVER w AS top
  FROM pages WINDOW w AS (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST)),
hashed AS (SELECT *, sha1(html) AS h FROM page),
cut AS (SELECT *, list_transform(range(8), lambda j: list_reduce(list_transform(string_split(substr(h, CAST(5 * j + 1 AS BIGINT), 5), ''), lambda c: strpos('0123456789abcdef', c) - 1), lambda a, d: 16 * a + d, 0)) AS v FROM hashed)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> s) & 31 AS BIGINT) + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN r = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN r > 1 THEN top END AS refers_to
FROM cut"""


def _field(value: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN '-' ELSE strlen(CAST({value} AS VARCHAR)) || ':' || {value} END"


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op12_merkle_manifest"] = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
doc AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, sha256({" || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", "text"]))}) AS leaf,
  CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN sha256({" || ".join(map(_field, ["doc_id", "source", "lang", "n_chars", _LOWERED]))}) END AS changed FROM documents, crc),
own AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n, row_number() OVER () AS r FROM doc),
node(g, lvl, idx, h, n) AS (SELECT g, 0, idx, leaf, n FROM own
  UNION ALL SELECT g, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY g, lvl, idx // 8, n),
sub AS (SELECT g, h FROM node WHERE n = 1),
top(lvl, idx, h, n) AS (SELECT 0, g, h, (SELECT count(*) FROM sub) FROM sub
  UNION ALL SELECT lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY lvl, idx // 8, n),
beside AS (
  SELECT r, s.lvl, s.idx AS idx, own.idx >> (3 * s.lvl) AS me, s.h FROM own JOIN node s ON s.g = own.g AND s.n > 1 AND s.idx // 8 = (own.idx >> (3 * s.lvl)) // 8
  UNION ALL SELECT r, 100 + s.lvl, s.idx, own.g >> (3 * s.lvl), s.h FROM own JOIN top s ON s.n > 1 AND s.idx // 8 = (own.g >> (3 * s.lvl)) // 8),
step AS (SELECT r, lvl, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx < me), '') AS a, coalesce(string_agg(h, '' ORDER BY idx) FILTER (idx > me), '') AS b FROM beside GROUP BY r, lvl),
way AS (SELECT r, string_agg(a || b, '' ORDER BY lvl) AS siblings, list([a, b] ORDER BY lvl) AS steps FROM step GROUP BY r),
folded AS (SELECT own.*, coalesce(siblings, '') AS siblings, list_reduce(list_prepend([coalesce(changed, leaf), ''], coalesce(steps, [])), lambda x, s: [sha256(s[1] || x[1] || s[2]), ''])[1] AS folded_root FROM own LEFT JOIN way USING (r))
SELECT doc_id, leaf, sub.h AS subroot, (SELECT h FROM top WHERE n = 1) AS root, sha256(siblings) AS proof_sha256, folded_root, folded_root = (SELECT h FROM top WHERE n = 1) AS verified
FROM folded JOIN sub USING (g)"""

#: States of the repaired sequence: nothing yet, after s, after u, after a; and what a user or assistant row put there leads to.
_NEXT = "CASE WHEN {0} = 2 THEN 3 ELSE 2 END"
_SAYS = "CASE WHEN {0} = 2 THEN 'assistant' ELSE 'user' END"
_EDITED = f"""SELECT t.g, t.i + 1 AS i, CASE edit WHEN 'D' THEN st WHEN 'K' THEN CASE c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE {_NEXT.format("st")} END AS st,
  cost + CASE edit WHEN 'D' THEN 2 WHEN 'K' THEN 5 * cut ELSE 1 + 5 * cut END AS cost, audit || edit AS audit,
  o || CASE edit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || role || ':' || text ELSE chr(10) || {_SAYS.format("st")} || ':' || text END AS o
  FROM t JOIN coded ON coded.g = t.g AND coded.i = t.i + 1, (VALUES ('D'), ('K'), ('R')) e(edit)
  WHERE edit = 'D' OR NOT gone AND (edit = 'R' OR (c = 's' AND st = 0) OR (c = 'u' AND st <> 2) OR (c = 'a' AND st = 2))"""
_INSERTED = f"""SELECT g, i, CASE n WHEN 0 THEN st WHEN 1 THEN {_NEXT.format("st")} ELSE {_NEXT.format(f"({_NEXT.format('st')})")} END AS st, cost + 5 * n AS cost, audit || repeat('I', n) AS audit,
  o || CASE WHEN n > 0 THEN chr(10) || {_SAYS.format("st")} || ':' ELSE '' END || CASE WHEN n > 1 THEN chr(10) || {_SAYS.format(f"({_NEXT.format('st')})")} || ':' ELSE '' END AS o
  FROM ({{0}}) made, (VALUES (0), (1), (2)) v(n)"""
SQL["op13_conversation_repair"] = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, dense_rank() OVER (ORDER BY conv_id) AS g, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s FROM conversations),
kind AS (SELECT *, {_CRC.format("s")} % 20 AS k FROM given, crc),
damaged AS (SELECT g, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN k = 0 THEN 0 WHEN k = 3 THEN 2 ELSE 1 END)) FROM kind),
placed AS (SELECT *, substr(role, 1, 1) AS c, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
marked AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
  WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS mark, lag(c) OVER (PARTITION BY g ORDER BY i) || c AS pair FROM placed),
coded AS (SELECT g, i, c, role, text, mark IN ('blank', 'duplicate') AS gone, CASE WHEN mark = 'truncated' THEN 1 ELSE 0 END AS cut FROM marked),
t(g, i, st, cost, audit, o) AS (
  {_INSERTED.format("SELECT DISTINCT g, CAST(0 AS BIGINT) AS i, 0 AS st, 0 AS cost, '' AS audit, '' AS o FROM given")}
  UNION ALL SELECT g, i, st, cost, audit, o FROM (SELECT *, row_number() OVER (PARTITION BY g, i, st ORDER BY cost, audit) AS nth FROM ({_INSERTED.format(_EDITED)}) every) best WHERE nth = 1),
size AS (SELECT g, coalesce(max(i), 0) AS n FROM (SELECT DISTINCT g FROM given) LEFT JOIN marked USING (g) GROUP BY g),
done AS (SELECT t.*, row_number() OVER (PARTITION BY t.g ORDER BY cost, audit) AS nth FROM t JOIN size ON size.g = t.g AND size.n = t.i WHERE st IN (0, 3)),
counted AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (mark = 'blank') AS blank, count(*) FILTER (mark = 'duplicate') AS duplicate,
  count(*) FILTER (mark = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY g)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(substr(o, 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, g FROM given) JOIN done USING (g) LEFT JOIN counted USING (g) WHERE nth = 1"""
