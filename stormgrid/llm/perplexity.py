"""Quality classifier: perplexity under an interpolated modified Kneser-Ney trigram model.

The model is fitted on all trusted text of one half (below). Tokens are runs of
letters, of digits or of signs; one that is not in the model's vocabulary (words met
twice) counts as its shape: lower case, capitalised, upper case, mixed, number or
signs. Counts, continuation counts and discounts are grouped and joined by n-gram
key over the cluster, and the finished tables stay there: they grow with the text.
Only what there is one of for each word of the vocabulary is broadcast: its 64-bit
hash, its id and two numbers.

Log-probabilities are written as a sum of what single n-grams add. Without any
n-gram a token has its back-off from the word before and its own probability. A seen
pair adds what it differs by. A trigram adds the back-off weight of its first two
words, if they were seen before some word, or, if it was seen itself, the whole
difference from the pair's value. So each n-gram is looked up by itself: a task packs
the n-grams of a slice of texts with the number of their document, by shard of the
first two words; the shard's task holds its part of the tables and answers with one
sum for each document; the sums of a slice meet again by its number. Documents go
through this in `ROUNDS` rounds, so that the n-grams on their way take a part of the
disk only.

Trusted documents fall into two halves by hash. The model is fitted on one; the
other gives the bounds, since a model finds its own text too likely. A document
is kept if its perplexity is at most a quantile, times a margin, of the trusted
documents of its language and length class; a class with fewer than
`LEAST_TRUSTED` of them takes the bound of its length over all languages, and
that, where it has too few as well, the bound over all.

Defined results: null, empty and blank texts have no perplexity and are not kept;
repeated rows are judged alike; null languages form one language; labels that
are null are not trusted; without trusted text every document that has a token is
kept (there is nothing to hold it against); an empty table gives no rows; columns
named like an added one are replaced; a context whose discounts leave its back-off no
weight gives it `LEAST_WEIGHT`.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.llm.common import WordMemory, append_columns, process_memory, release_memory, share, slices, small_batches, texts_of
from stormgrid.session import materialize, stored_steps, work_path

#: Rounds in which documents are scored: each has its share of n-grams on disk at a time.
ROUNDS = 8
#: Entries of the tables that a shard holds, about, and shards at least and at most.
SHARD_ENTRIES, SHARDS = 1 << 22, (64, 1000)
#: Entries of the tables in one stored row.
PACKED = 1 << 18
#: Words that a task remembers, and their bytes.
REMEMBERED, REMEMBERED_BYTES = 300_000, 16 << 20
LEAST_WEIGHT = 1e-30
#: Quantile of trusted perplexities, and the factor above it that is still kept.
QUANTILE, MARGIN = 0.99, 1.5
#: A class of fewer trusted documents takes the bound of the next wider one.
LEAST_TRUSTED = 30
#: Upper bounds of the length classes, in tokens.
LENGTHS = [16, 64, 256]
TOKEN = r"[^\W\d_]+|\d+|[^\w\s]+|_+"
SHAPES = ["<lower>", "<Title>", "<UPPER>", "<miXed>", "<number>", "<signs>"]
BEGIN = 0
#: Bits of one token id inside an n-gram key; three fit 63 bits.
BITS = 21
#: Bits of one token id inside the tables, where the third word has its own column.
WIDE = 27
PAIR_MASK = (1 << WIDE) - 1
#: In place of the third word: the back-off weight of a pair as context, and what a pair adds as a pair.
AS_CONTEXT, AS_PAIR = -1, 0


def shape(token: str) -> str:
    if token.isalpha():
        if token.islower():
            return SHAPES[0]
        if token.isupper() and len(token) > 1:
            return SHAPES[2]
        return SHAPES[1] if token[1:].islower() or len(token) == 1 else SHAPES[3]
    return SHAPES[4] if token.isdigit() else SHAPES[5]


def token_ids(vocabulary: dict[str, int]):
    """A function from texts to the ids of all their tokens and the number of each text."""
    import re

    find = re.compile(TOKEN).findall

    class Ids(dict):
        def __missing__(self, token: str) -> int:
            return vocabulary[shape(token)]

    ids = Ids(vocabulary)

    def of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lists = [find(t.decode("utf-8", "replace")) for t in texts]
        counts = np.array([len(x) for x in lists], dtype=np.int64)
        flat = np.fromiter((i for x in lists for i in map(ids.__getitem__, x)), dtype=np.int64, count=int(counts.sum()))
        return flat, counts

    return of


def before(flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens two and one before each token, texts begun by two begin marks."""
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    one, two = np.full(len(flat), BEGIN, dtype=np.int64), np.full(len(flat), BEGIN, dtype=np.int64)
    one[1:], two[2:] = flat[:-1], flat[:-2]
    return np.where(place > 1, two, BEGIN), np.where(place > 0, one, BEGIN)


def trusted_sample(docs: DataFrame, trusted: DataFrame, chars: int) -> DataFrame:
    """Ids of trusted documents with at most `chars` characters in all, by the order of their hash.

    For trials only: the classifier fits on all trusted text of its half.
    `trusted` has doc_id. Hashes fall into so many buckets that a few hundred hold
    a multiple of the bound; their sums alone reach the driver.
    """
    sizes = materialize(
        docs.select("doc_id", F.length("text").alias("n")).where(F.col("n").between(1, chars)).join(trusted.select("doc_id").distinct(), "doc_id")
    )
    total = sizes.agg(F.sum("n")).first()[0] or 0
    buckets = max(256, 64 * -(-total // chars))
    bucket = F.pmod(F.xxhash64("doc_id"), F.lit(buckets))
    sums = sizes.where(bucket < 256).groupBy(bucket.alias("b")).agg(F.sum("n").alias("n")).orderBy("b").collect()
    held = np.cumsum([r.n for r in sums])
    last = [r.b for r, h in zip(sums, held, strict=True) if h <= chars or h == held[0]]
    return sizes.where(bucket <= (last[-1] if last else -1)).select("doc_id").distinct()


class Words:
    """The vocabulary by hash, with the ids of its words and, by id, the logarithms of back-off weight and own probability."""

    def __init__(self, hashes: np.ndarray, ids: np.ndarray, weight: np.ndarray | None = None, own: np.ndarray | None = None) -> None:
        self.hashes, self.ids, self.weight, self.own = hashes, ids, weight, own
        #: Tells this vocabulary from others.
        self.key = uuid.uuid4().hex

    def of(self, words: list[str]) -> np.ndarray:
        """Ids of words, those of their shapes where they are not in the vocabulary."""
        hashes = word_hashes(words)
        if not len(self.hashes):
            known, ids = np.zeros(len(words), dtype=bool), np.zeros(len(words), dtype=np.int64)
        else:
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            known, ids = self.hashes[at] == hashes, self.ids[at].astype(np.int64)
        for i in np.flatnonzero(~known).tolist():
            ids[i] = 1 + SHAPES.index(shape(words[i]))
        return ids


def word_hashes(words: list[str]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(w.encode(), digest_size=8).digest() for w in words), dtype="<i8")


class Split(WordMemory):
    """Tokens of texts as numbers. No token spans white space, so a text has the tokens of its words in order."""

    def __init__(self) -> None:
        super().__init__(REMEMBERED, REMEMBERED_BYTES)
        self.find = re.compile(TOKEN).findall

    def number(self, tokens: list[str]) -> Iterable[int]:
        raise NotImplementedError

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        tokens, ends, find = [], [], self.find
        for word in words:
            word = word.decode("utf-8", "replace")
            if word.isalpha():
                tokens.append(word)
            else:
                tokens += find(word)
            ends.append(len(tokens))
        return np.fromiter(self.number(tokens), dtype=np.int32, count=len(tokens)), np.diff(ends, prepend=0)


class Numbered(Split):
    """Numbers of tokens in the order they are met, after the `given` ones."""

    def __init__(self, given: Iterable[str] = ()) -> None:
        super().__init__()
        #: Tokens with their numbers, in the order of these.
        self.tokens = {t: i for i, t in enumerate(given)}

    def number(self, tokens: list[str]) -> Iterable[int]:
        known = self.tokens
        return [known.setdefault(t, len(known)) for t in tokens]


class Reader(Split):
    """The vocabulary's ids of tokens, as `token_ids`; a worker remembers words from task to task."""

    def __init__(self, words: Words) -> None:
        super().__init__()
        self.vocabulary = words

    def number(self, tokens: list[str]) -> Iterable[int]:
        different = [*dict.fromkeys(tokens)]
        return map(dict(zip(different, self.vocabulary.of(different).tolist(), strict=True)).__getitem__, tokens)


@contextmanager
def reader(words: Words) -> Iterator[Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]]:
    """A function from texts to the ids of all their tokens and the number of each text.

    Between tasks a worker keeps the words it has met, for one vocabulary at a time, but not the vocabulary.
    """
    kept = process_memory("words of a vocabulary")
    if words.key not in kept:
        kept.clear()
        kept[words.key] = Reader(words)
    mine = kept[words.key]
    mine.vocabulary = words
    try:
        yield lambda texts: (lambda ids, counts: (ids.astype(np.int64), counts))(*mine.of(texts))
    finally:
        mine.vocabulary = None


def shard_of(pair, shards: int):
    """The shard of a pair of words, of numbers or of a column."""
    if isinstance(pair, np.ndarray):
        return ((pair >> WIDE) * 31 + (pair & PAIR_MASK) * 1_000_003) % shards
    return ((F.shiftright(pair, WIDE) * 31 + pair.bitwiseAND(F.lit(PAIR_MASK)) * 1_000_003) % shards).cast("int")


def planes(*arrays: np.ndarray) -> bytes:
    """Arrays as their bytes by place within the number, compressed."""
    raw = b"".join(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays)
    return pa.compress(raw, codec="zstd", asbytes=True)


def from_planes(data: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    sizes = [np.dtype(k).itemsize for k in kinds]
    raw, at, out = np.frombuffer(pa.decompress(data, n * sum(sizes), codec="zstd"), dtype=np.uint8), 0, []
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.ascontiguousarray(raw[at : at + n * size].reshape(size, n).T).view(kind).reshape(n))
        at += n * size
    return out


def questions(two: np.ndarray, one: np.ndarray, flat: np.ndarray, place: np.ndarray, shards: int) -> Iterator[tuple[int, int, bytes]]:
    """Trigrams and pairs with the number of their document, as one packed row for each shard."""
    pair = np.concatenate([two << WIDE | one, one << WIDE | flat])
    third = np.concatenate([flat, np.full(len(flat), AS_PAIR)]).astype("<i4")
    where = np.concatenate([place, place]).astype("<i4")
    key = shard_of(pair, shards) << 2 * WIDE | pair
    # Equal keys may come in any order: their answers are added up.
    order = np.argsort(key)
    key = key[order]
    bounds = np.searchsorted(key >> 2 * WIDE, np.arange(shards + 1))
    for i in np.flatnonzero(np.diff(bounds)).tolist():
        a, b = bounds[i], bounds[i + 1]
        yield i, int(b - a), planes(np.diff(pair[order[a:b]], prepend=0), third[order[a:b]], where[order[a:b]])


class Shard:
    """One shard of the tables: sorted pairs and third words with their values."""

    def __init__(self, parts: list[tuple[np.ndarray, ...]]) -> None:
        pair, third, value = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, t) for t in ("i8", "i4", "f4"))
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        self.pairs = pair[first]
        number = np.repeat(np.arange(len(first)), np.diff(first, append=len(pair)))
        self.keys, self.values = number << WIDE + 1 | (third.astype(np.int64) + 1), value
        context = third == AS_CONTEXT
        self.weights = np.zeros(len(first), dtype=np.float32)
        self.weights[number[context]] = value[context]

    def answers(self, pair: np.ndarray, third: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.zeros(len(pair), dtype=np.float32)
        # Questions come sorted by pair: each different one is searched for once.
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        wanted = pair[first]
        number = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        known = np.repeat(self.pairs[number] == wanted, np.diff(first, append=len(pair)))
        number = np.repeat(number, np.diff(first, append=len(pair)))
        out = np.where(known & (third != AS_PAIR), self.weights[number], np.float32(0))
        rows = np.flatnonzero(known)
        key = number[rows] << WIDE + 1 | (third[rows].astype(np.int64) + 1)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        out[rows[hit]] = self.values[at[hit]]
        return out


#: Rows on their way to a shard: its tables, questions of a slice, or what a slice keeps (its documents), which passes through.
TABLE, QUESTION, KEPT = 0, 1, 2
MOVED = "shard int, kind int, slice bigint, n int, docs int, data binary"
MOVED_NAMES = ["shard", "kind", "slice", "n", "docs", "data"]


def moved(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=MOVED_NAMES)


def answered(asked: DataFrame, tables: DataFrame) -> DataFrame:
    """The questions' sums by document, one row for each shard and slice, and the rows that pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, held = None, [], None
        for batch in batches:
            for i in range(batch.num_rows):
                shard, kind, piece, n, docs, data = (batch.column(c)[i] for c in range(6))
                if shard.as_py() != number:
                    number, parts, held = shard.as_py(), [], None
                if kind.as_py() == TABLE:
                    pair, third, value = from_planes(data.as_buffer(), n.as_py(), "<i8", "<i4", "<f4")
                    parts.append((np.cumsum(pair), third, value))
                elif kind.as_py() == KEPT:
                    yield batch.slice(i, 1)
                else:
                    if held is None:
                        held, parts = Shard(parts), []
                    pair, third, where = from_planes(data.as_buffer(), n.as_py(), "<i8", "<i4", "<i4")
                    value = held.answers(np.cumsum(pair), third)
                    sums = np.bincount(where, value, docs.as_py()).astype("<f4")
                    yield moved([(number, QUESTION, piece.as_py(), len(sums), len(sums), planes(sums))])
        del parts, held
        release_memory()

    return asked.unionByName(tables).repartition("shard").sortWithinPartitions("shard", "kind", "slice").mapInArrow(run, MOVED)


def summed(found: DataFrame, work: Callable[[np.ndarray, bytes], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """`work(sums by document, what the slice kept)` for every slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total, kept = None, 0.0, None
        for batch in batches:
            for i in range(batch.num_rows):
                _, kind, piece, n, _, data = (batch.column(c)[i] for c in range(6))
                if piece.as_py() != number:
                    if kept is not None:
                        yield work(total, kept)
                    number, total, kept = piece.as_py(), 0.0, None
                if kind.as_py() == KEPT:
                    kept = data.as_py()
                else:
                    total = total + from_planes(data.as_buffer(), n.as_py(), "<f4")[0].astype(np.float64)
        if kept is not None:
            yield work(total, kept)

    return found.repartition("slice").sortWithinPartitions("slice", "kind", "shard").mapInArrow(run, schema)


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Has Spark remove the shuffle files of a step once it is stored: nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old)


class Model:
    """Vocabulary and tables: `words` (word, h, n) and packed `tables` by shard are DataFrames."""

    def __init__(self, words: DataFrame, known: Words, tables: DataFrame, shards: int) -> None:
        self.words, self.known, self.tables, self.shards = words, known, tables, shards

    @property
    def vocabulary(self) -> dict[str, int]:
        """The words with their ids, on the driver: for small models."""
        words = [r.word for r in self.words.collect()]
        return {w: i + 1 for i, w in enumerate(SHAPES)} | dict(zip(words, self.known.of(words).tolist(), strict=True))

    def scores(self, keys: np.ndarray) -> np.ndarray:
        """Natural log-probability of the last token of each trigram key (three ids of `BITS` bits)."""
        mask = (1 << BITS) - 1
        two, one, last = keys >> 2 * BITS, keys >> BITS & mask, keys & mask
        place, n = np.arange(len(keys)), len(keys)
        rows = [(shard, QUESTION, 0, size, n, data) for shard, size, data in questions(two, one, last, place, self.shards)]
        asked = self.tables.sparkSession.createDataFrame([*rows, (0, KEPT, 0, 0, n, b"")], MOVED)
        own = self.known.weight[one].astype(np.float64) + self.known.own[last]

        def work(total: np.ndarray, _: bytes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(total + np.zeros(n))], names=["i", "sum"])

        schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("sum", T.DoubleType())])
        found = {r.i: r.sum for r in summed(answered(asked, self.tables), work, schema).collect()}
        return own + np.array([found[i] for i in range(n)])


def fit(docs: DataFrame, trusted: DataFrame) -> Model | None:
    """The model of all trusted documents; None if they hold no token."""
    spark = docs.sparkSession
    with dropping_shuffles(spark):
        return _fit(spark, docs, trusted)


def _fit(spark: SparkSession, docs: DataFrame, trusted: DataFrame) -> Model | None:
    small_batches(spark)
    path, words_path = work_path(spark, "tables"), work_path(spark, "words")
    # Texts and counts on the way are removed once the tables are stored.
    with stored_steps(spark):
        sample = materialize(docs.where(F.length("text") > 0).join(trusted.select("doc_id").distinct(), "doc_id", "left_semi").select("text"), codec="zstd")
        sample.mapInArrow(_words, "word string, h bigint, n bigint").groupBy("word", "h").agg(F.sum("n").alias("n")).write.parquet(words_path, compression="zstd")
        counted = spark.read.schema("word string, h bigint, n bigint").parquet(words_path)
        tokens = counted.agg(F.sum("n")).first()[0]
        if not tokens:
            return None
        # A hash for each word of the vocabulary; the most frequent words have the lowest ids, which pack best.
        known = counted.where("n > 1")
        hashes = known.orderBy(F.desc("n"), "h").select("h").toArrow().column(0).to_numpy()
        size = len(SHAPES) + len(hashes)
        if size >> WIDE:
            raise ValueError(f"{size} different tokens do not fit {WIDE} bits")
        order = np.argsort(hashes, kind="stable")
        dictionary = Words(hashes[order], (order + 1 + len(SHAPES)).astype(np.int32))
        shards = min(max(SHARDS[0], -(-2 * tokens // SHARD_ENTRIES)), SHARDS[1])
        shared = share(spark, dictionary)

        def trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with reader(shared()) as of:
                for whole in batches:
                    for batch in slices(whole, "text"):
                        flat, counts = of(texts_of(batch, "text"))
                        two, one = before(flat, counts)
                        yield from sent(TABLE, shards, *added(two << WIDE | one, flat, np.ones(len(flat), dtype=np.int64)))

        def pairs(shard: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            ctx, w, _ = parts[0]
            pair = (ctx & PAIR_MASK) << WIDE | w
            yield from sent(TABLE, shards, *added(pair, np.zeros(len(pair), dtype=np.int64), np.ones(len(pair), dtype=np.int64)))

        def together(shard: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            yield moved([packed(shard, TABLE, 0, *added(*(np.concatenate(p) for p in zip(*parts, strict=True))))])

        three = materialize(by_shard(sample.mapInArrow(trigrams, MOVED), together))
        two = materialize(by_shard(by_row(three, pairs), together))
        d3, d2 = discounts(times_met(three)), discounts(times_met(two))

        def sums(shard: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            """For each word, how many pairs end with it, and the sum and held-back part of the counts of those that begin with it."""
            pair, _, c = parts[0]
            for column, numbers in ((pair & PAIR_MASK, (np.ones(len(c)), np.zeros(len(c)), np.zeros(len(c)))), (pair >> WIDE, (np.zeros(len(c)), c, taken(d2, c)))):
                ids, place = np.unique(column, return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids)] + [pa.array(np.bincount(place, n)) for n in numbers], names=["id", "ends", "total", "held"])

        words = by_row(two, sums, "id bigint, ends double, total double, held double").groupBy("id").agg(F.sum("ends").alias("ends"), F.sum("total").alias("total"), F.sum("held").alias("held"))
        table = words.toArrow()
        ends, total2, weight2 = np.zeros(size + 1), np.ones(size + 1), np.ones(size + 1)
        ids, every = table.column("id").to_numpy(), table.column("total").to_numpy()
        ends[ids] = table.column("ends").to_numpy()
        begins = every > 0
        total2[ids[begins]] = every[begins]
        weight2[ids[begins]] = np.maximum(table.column("held").to_numpy()[begins] / every[begins], LEAST_WEIGHT)
        d1 = discounts([0, *[int((ends == i).sum()) for i in range(1, 5)]])
        cut = np.where(ends > 0, taken(d1, ends), 0.0)
        p1 = (ends - cut) / ends.sum() + cut.sum() / ends.sum() / size
        dense = share(spark, (total2, weight2, p1))

        def seen_after(shard: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            """The trigrams' own part and back-off weight, sent to their last two words; the weights of their contexts."""
            ctx, w, c = parts[0]
            first = np.flatnonzero(np.diff(ctx, prepend=-1))
            cuts, length = taken(d3, c), np.diff(first, append=len(ctx))
            total = np.add.reduceat(c, first)
            weight = np.maximum(np.add.reduceat(cuts, first) / total, LEAST_WEIGHT)
            yield moved([packed(shard, KEPT, 0, ctx[first], np.full(len(first), AS_CONTEXT), np.log(weight), kind="<f4")])
            more, weight = (c - cuts) / np.repeat(total, length), np.repeat(weight, length)
            yield from sent(QUESTION, shards, (ctx & PAIR_MASK) << WIDE | w, ctx >> WIDE, more.astype("<f4"), weight.astype("<f4"))

        def valued(shard: int, kind: int, n: int, data: bytes, state: dict) -> Iterator[pa.RecordBatch]:
            if kind == TABLE:
                pair, _, c = unpacked(data, n, "<i8")
                total, weight, own = dense()
                v, w = pair >> WIDE, pair & PAIR_MASK
                rest = weight[v] * own[w]
                state["pair"], state["p2"] = pair, (c - taken(d2, c)) / total[v] + rest
                yield moved([packed(shard, TABLE, 0, pair, np.full(n, AS_PAIR), np.log(state["p2"] / rest), kind="<f4")])
            elif kind == KEPT:
                yield moved([(shard, TABLE, 0, n, 0, bytes(data))])
            else:
                pair, u, more, weight = unpacked(data, n, "<f4", "<f4")
                p2 = state["p2"][np.searchsorted(state["pair"], pair)]
                ctx = u.astype(np.int64) << WIDE | pair >> WIDE
                yield from sent(TABLE, shards, ctx, pair & PAIR_MASK, np.log(weight + more / p2).astype("<f4"))

        def finished(shard: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            pair, third, value = (np.concatenate(p) for p in zip(*parts, strict=True))
            order = np.lexsort((third, pair))
            for number, at in enumerate(range(0, len(order), PACKED)):
                rows = order[at : at + PACKED]
                yield moved([packed(shard, TABLE, number, pair[rows], third[rows], value[rows], kind="<f4")])

        values = by_shard(two.unionByName(by_row(three, seen_after)), valued, whole=False)
        by_shard(values, finished, kind="<f4").write.parquet(path)
    dictionary.weight, dictionary.own = np.log(weight2).astype(np.float32), np.log(p1, out=np.zeros_like(p1), where=p1 > 0).astype(np.float32)
    return Model(known, dictionary, spark.read.schema(MOVED).parquet(path), shards)


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Different words with their hashes and counts, handed on when they are many."""
    numbered, times = Numbered(), np.zeros(0, dtype=np.int64)

    def taken() -> pa.RecordBatch:
        held = list(numbered.tokens)
        return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(word_hashes(held), pa.int64()), pa.array(times)], names=["word", "h", "n"])

    for whole in batches:
        for batch in slices(whole, "text"):
            more = np.bincount(numbered.of(texts_of(batch, "text"))[0], minlength=len(numbered.tokens))
            more[: len(times)] += times
            times = more
            if len(times) > REMEMBERED:
                yield taken()
                numbered, times = Numbered(), times[:0]
    if len(times):
        yield taken()


def discounts(n: list[int]) -> list[float]:
    """Modified discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    return [min(max(i - (i + 1) * y * n[i + 1] / n[i], 0.0), i * 0.95) if n[i] else 0.5 * min(i, 1) for i in (1, 2, 3)]


def taken(d: list[float], c: np.ndarray) -> np.ndarray:
    return np.where(c == 1, d[0], np.where(c == 2, d[1], d[2]))


def times_met(table: DataFrame) -> list[int]:
    """How many n-grams of a packed table have the counts 1 to 4, after a 0."""
    names = [f"n{i}" for i in range(1, 5)]

    def counts(shard: int, parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        c = parts[0][2]
        yield pa.RecordBatch.from_arrays([pa.array([int((c == i).sum())], pa.int64()) for i in range(1, 5)], names=names)

    return [0, *by_row(table, counts, ", ".join(f"{n} bigint" for n in names)).agg(*[F.sum(n) for n in names]).first()]


def added(pair: np.ndarray, third: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, ...]:
    """Different n-grams in ascending order with the sums of their counts."""
    order = np.lexsort((third, pair))
    pair, third = pair[order], third[order].astype(np.int64)
    first = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(third, prepend=-1) != 0))
    return pair[first], third[first], np.add.reduceat(c[order], first) if len(first) else c


def packed(shard: int, kind_of_row: int, number: int, pair: np.ndarray, third: np.ndarray, *values: np.ndarray, kind: str = "<i8") -> tuple:
    data = planes(np.diff(pair, prepend=0), third.astype("<i4"), *[v.astype(kind) for v in values])
    return shard, kind_of_row, number, len(pair), 0, data


def unpacked(data: bytes, n: int, *kinds: str) -> tuple[np.ndarray, ...]:
    pair, third, *values = from_planes(data, n, "<i8", "<i4", *kinds)
    return np.cumsum(pair), third, *values


def sent(kind: int, shards: int, pair: np.ndarray, third: np.ndarray, *values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """N-grams in order of their pairs, one packed row for each shard."""
    key = shard_of(pair, shards) << 2 * WIDE | pair
    order = np.argsort(key, kind="stable")
    bounds = np.searchsorted(key[order] >> 2 * WIDE, np.arange(shards + 1))
    for i in np.flatnonzero(np.diff(bounds)).tolist():
        rows = order[bounds[i] : bounds[i + 1]]
        yield moved([packed(i, kind, 0, pair[rows], third[rows], *[v[rows] for v in values], kind=values[0].dtype.str)])


def by_row(table: DataFrame, work: Callable, schema: str | None = None) -> DataFrame:
    """`work(shard, [n-grams])` of every row of a table of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work(batch.column(0)[i].as_py(), [unpacked(batch.column(5)[i].as_buffer(), batch.column(3)[i].as_py(), "<i8")])

    return table.mapInArrow(run, schema or MOVED)


def by_shard(rows: DataFrame, work: Callable, whole: bool = True, kind: str = "<i8") -> DataFrame:
    """`work(shard, parts)` of every shard, or with `whole` false `work(shard, kind, n, data, state)` of its rows in the order of their kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, parts, state = None, [], {}
        for batch in batches:
            for i in range(batch.num_rows):
                shard, kind_of_row, n, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(3)[i].as_py(), batch.column(5)[i].as_buffer()
                if shard != number:
                    if parts:
                        yield from work(number, parts)
                    number, parts, state = shard, [], {}
                if whole:
                    parts.append(unpacked(data, n, kind))
                else:
                    yield from work(shard, kind_of_row, n, data, state)
        if parts:
            yield from work(number, parts)
        del parts, state
        release_memory()

    return rows.repartition("shard").sortWithinPartitions("shard", "kind", "slice").mapInArrow(run, MOVED)


def score(docs: DataFrame, model: Model | None, text: str = "text", drop: tuple[str, ...] = ()) -> DataFrame:
    """Adds n_tokens and perplexity (null without tokens or model); the rows are stored."""
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("perplexity", T.DoubleType())]
    if model is None:
        return materialize(append_columns(docs, text, _no_model, fields, drop))
    spark = docs.sparkSession
    kept = [f for f in docs.schema.fields if f.name not in ("n_tokens", "perplexity") and f.name not in drop]
    names = [f.name for f in kept]
    shared, shards = share(spark, model.known), model.shards

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        known, number = shared(), TaskContext.get().partitionId() << 32
        with reader(known) as of:
            for whole in batches:
                for batch in slices(whole, text):
                    flat, counts = of(texts_of(batch, text))
                    two, one = before(flat, counts)
                    place = np.repeat(np.arange(len(counts)), counts)
                    own = np.bincount(place, known.weight[one].astype(np.float64) + known.own[flat], len(counts))
                    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
                    rows = pa.RecordBatch.from_arrays([*columns, pa.array(counts), pa.array(own)], names=[*names, "n_tokens", "perplexity"])
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                        out.write_batch(rows)
                    yield moved([(number % shards, KEPT, number, 0, len(counts), sink.getvalue().to_pybytes())])
                    for shard, size, data in questions(two, one, flat, place, shards):
                        yield moved([(shard, QUESTION, number, size, len(counts), data)])
                    number += 1
        release_memory()

    def work(total: np.ndarray, data: bytes) -> pa.RecordBatch:
        rows = pa.ipc.open_stream(data).read_next_batch()
        counts, own = (rows.column(len(names) + i).to_numpy() for i in range(2))
        with np.errstate(invalid="ignore", divide="ignore"):
            value = np.exp(-(own + total) / counts)
        return pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(value, pa.float64(), mask=counts == 0)], names=rows.schema.names)

    small_batches(spark)
    needed = docs.select(*[F.col(f"`{n}`") for n in dict.fromkeys([*names, text])])
    turn = F.pmod(F.xxhash64(F.col(f"`{text}`"), F.lit("round")), F.lit(ROUNDS))
    scored = []
    with dropping_shuffles(spark):
        for i in range(ROUNDS):
            asked = needed.where(turn == i).mapInArrow(ask, MOVED)
            scored.append(materialize(summed(answered(asked, model.tables), work, T.StructType(kept + fields))))
    every = scored[0]
    for more in scored[1:]:
        every = every.unionByName(more)
    return every


def _no_model() -> Callable[[list[bytes]], tuple]:
    of = token_ids({s: i for i, s in enumerate(SHAPES)})

    def work(texts: list[bytes]) -> tuple:
        counts = of(texts)[1]
        return counts, [None] * len(counts)

    return work


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN, keep_text: bool = False) -> DataFrame:
    """All columns of `docs` (without the text unless `keep_text`) with n_tokens, perplexity, bound and kept."""
    trusted = labels.where("quality = 1 AND toxic = 0").select("doc_id").distinct()
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    model = fit(docs, trusted.where(half == 0))
    size = F.lit(len(LENGTHS))
    for i, bound in reversed(list(enumerate(LENGTHS))):
        size = F.when(F.col("n_tokens") < bound, i).otherwise(size)
    base = docs.drop("bound", "kept")
    scored = score(base, model, drop=() if keep_text else ("text",)).withColumn("__class", size)
    known = scored.where("perplexity IS NOT NULL").select("doc_id", "lang", "__class", "perplexity").join(trusted.where(half == 1), "doc_id", "left_semi")
    bound = F.when((F.count("*") >= LEAST_TRUSTED) | (F.grouping_id() == 3), F.percentile_approx("perplexity", quantile, 10_000) * margin)
    limits = materialize(
        known.cube("lang", "__class").agg(bound.alias("bound"), F.grouping_id().alias("g"))
    )
    own = limits.where("g = 0").select(F.col("lang").alias("__l"), F.col("__class").alias("__c"), F.col("bound").alias("b0"))
    across = limits.where("g = 2").select(F.col("__class").alias("__d"), F.col("bound").alias("b1"))
    every = limits.where("g = 3").select(F.col("bound").alias("b2"))
    judged = (
        scored.join(own, F.col("lang").eqNullSafe(F.col("__l")) & (F.col("__class") == F.col("__c")), "left")
        .join(F.broadcast(across), F.col("__class") == F.col("__d"), "left").join(F.broadcast(every), F.lit(True), "left")
    )
    bound = F.coalesce("b0", "b1", "b2")
    kept = F.when(F.col("n_tokens") == 0, False).otherwise(bound.isNull() | (F.col("perplexity") <= bound))
    return judged.select(*[F.col(f"`{c}`") for c in scored.columns if c != "__class"], bound.alias("bound"), kept.alias("kept"))
