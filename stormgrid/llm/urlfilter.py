"""URL filtering: given host and path rules, then association rules mined by FP-growth.

Every url becomes a set of tokens (host labels, path parts with digits masked,
query names, a fragment mark). Spark's FP-growth mines the token sets of labelled
urls together with their label; rules that end in the bad label are pruned by
support, confidence and lift, and dropped if a rule on fewer of the same tokens
is at least as confident. Rules match by an inverted index: a rule is posted
under its rarest token, the tokens of each different url look their postings up,
and a rule fits if the url has all its tokens.

Only DataFrame functions and Spark ML's FP-growth are used.

Defined results: a null url, or one without "://", has an empty host and path,
fits no given rule and has no tokens, so it is allowed; repeated urls are judged
alike; labels that are null are not used; without labelled urls no rule is mined
and everything outside the given rules is allowed; of two equally long given
rules the blocking one wins; columns called host, path, rule or verdict are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.session import materialize

BAD = "label:block"


@dataclass(frozen=True)
class Mining:
    """Share of labelled urls a rule must cover, and how sure and how telling it must be."""

    support: float = 0.002
    confidence: float = 0.6
    lift: float = 1.5


def host_of(url: Column) -> Column:
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(raw, ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a url; none without a host."""
    host, path = host_of(url), F.lower(path_of(url))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    named = lambda mark, parts: F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.concat(F.lit(mark), p))
    every = F.concat(
        named("host:", F.split(host, r"\.")),
        named("path:", F.transform(F.split(path, r"[/.]"), lambda p: F.regexp_replace(p, "[0-9]+", "0"))),
        named("query:", F.transform(F.split(query, "&"), lambda p: F.regexp_extract(p, "^([^=]*)", 1))),
        F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.when(host != "", F.array_distinct(every)).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules from labelled urls (url, bad boolean): tokens, anchor (their rarest), support, confidence, lift."""
    baskets = labelled.where("bad IS NOT NULL").select(
        F.array_union(tokens_of(F.col("url")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array(F.lit("label:allow")))).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=mining.support, minConfidence=mining.confidence).fit(baskets)
    found = model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("lift") >= mining.lift))
    found = found.where(~F.exists("antecedent", lambda t: t.startswith("label:")))
    rules = materialize(found.select(F.array_sort("antecedent").alias("tokens"), "support", "confidence", "lift"))
    counts = materialize(model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq"))
    posted = rules.select("*", F.explode("tokens").alias("token")).join(counts, "token")
    anchored = materialize(
        posted.groupBy("tokens", "support", "confidence", "lift").agg(F.min_by("token", F.struct("freq", "token")).alias("anchor"))
    )
    # A rule is spare if another on a proper part of its tokens is as confident.
    part = anchored.select(F.col("tokens").alias("part"), F.col("confidence").alias("sure"), "anchor")
    exploded = anchored.select(F.col("tokens").alias("whole"), F.col("confidence").alias("own"), F.explode("tokens").alias("anchor"))
    spare = exploded.join(part, "anchor").where(
        (F.size("part") < F.size("whole")) & (F.col("sure") >= F.col("own")) & (F.size(F.array_except("part", "whole")) == 0)
    )
    return materialize(anchored.join(spare.select(F.col("whole").alias("tokens")).distinct(), "tokens", "left_anti"))


def matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The different urls that some mined rule fits, with its tokens (the surest rule's)."""
    different = urls.select("url").distinct().withColumn("has", tokens_of(F.col("url")))
    postings = rules.select("anchor", "tokens", "confidence")
    hit = different.select("url", "has", F.explode("has").alias("anchor")).join(postings, "anchor").where(F.size(F.array_except("tokens", "has")) == 0)
    return hit.groupBy("url").agg(F.max_by(F.array_join("tokens", " "), F.struct("confidence", F.array_join("tokens", " "))).alias("mined"))


def given_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest of the given (verdict, host, path) rules that fits; null if none does."""
    every = F.array(*[
        F.struct(F.lit(len(h + p)).alias("size"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"), F.lit(h).alias("host"), F.lit(p).alias("path"))
        for v, h, p in rules
    ])
    fits = F.filter(every, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.array_max(fits)


def judge(pages: DataFrame, given: list[tuple[str, str, str]], labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """All columns of `pages` with host, path, rule, verdict and `mined` (tokens of the mined rule that decided)."""
    rules = mine(labelled, mining)
    base = pages.drop("host", "path", "rule", "verdict", "mined").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = base.withColumn("__fit", given_rule(F.col("host"), F.col("path"), given) if given else F.lit(None).cast("struct<rule:string,verdict:string>"))
    open_urls = ruled.where(F.col("__fit").isNull() & (F.col("host") != ""))
    judged = ruled.join(matches(open_urls, rules), "url", "left")
    mined = F.when(F.col("__fit").isNull(), F.col("mined"))
    return judged.select(
        *[F.col(f"`{c}`") for c in base.columns], F.col("__fit.rule").alias("rule"),
        F.coalesce(F.col("__fit.verdict"), F.when(mined.isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), mined.alias("mined"),
    )
