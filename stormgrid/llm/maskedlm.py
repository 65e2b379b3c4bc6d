"""Masked pseudo-likelihood of documents under a bidirectional window network.

The network sees the `SIDE` tokens on either side of a place and predicts the
token on it, in two levels: embeddings of the neighbours, one hidden layer and a
softmax give the token's class; the token's own share of its class is its count in
the corpus over that of all tokens of the class and one more, which is left for a
token that the corpus has not. A document's score is the sum over its places of
the log-probability of the token there given its neighbours.

Every token belongs to one of `CLASSES` classes by its shape and ending (short ones
by their whole form), so the neighbours move the probability of each. The table of
counts holds every token. Its `HOT` most frequent ones go to the tasks, all others
are joined with the documents by token, so the table may grow with the corpus.

Training goes through every document once and does not depend on how the rows lie:
rows are dealt by their hash to `ROUNDS` rounds and within them to blocks of about
`BLOCK_BYTES` bytes. In a round each block trains a copy of the network, in numpy,
from the same start, on its rows in the order of their hashes; the copies and their
accumulated squares are averaged by the number of tokens and start the next round.
So a copy's share of the text is the same however many tasks there are, and more
text means more copies. Rows alike in all columns that are more than `COPIES` are
dealt by their place instead, so they spread over blocks. The same pass counts the
tokens, and tasks hand on one sum of copies each.

Defined results: null, empty and blank texts have no tokens and score 0 with a
null mean; repeated rows score alike; very long texts are trained and scored whole,
a slice at a time; a corpus without tokens keeps the untrained network; an empty
table gives no rows; columns named like an added one are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.llm.common import append_columns, share, slices, small_batches, texts_of
from stormgrid.llm.perplexity import SHAPES, Numbered, shape
from stormgrid.session import materialize

SIDE, WIDTH, HIDDEN = 2, 8, 16
ROUNDS, BLOCK_BYTES, GROUPS, COPIES = 3, 2 << 20, 16, 256
#: Tokens whose counts are broadcast; the counts of all others are joined by token.
HOT = 1 << 17
#: Tokens that a task remembers while it counts, and beside the frequent ones while it scores.
REMEMBERED = 300_000
BATCH, RATE = 1024, 0.1
SEED = 11
#: Logits up to which exponentials of a row cannot overflow.
SAFE = 60.0
#: Tokens of a block that are trained in one go.
HELD_TOKENS = 1 << 20
#: Classes of each shape for tokens of up to `SHORT` characters, by their whole form, and for longer ones, by their last two.
SHORT = 3
SPANS = dict(zip(SHAPES, [(40, 24), (8, 16), (3, 3), (1, 2), (4, 4), (12, 2)], strict=True))
FIRST = {name: sum(sum(SPANS[n]) for n in SHAPES[:i]) for i, name in enumerate(SHAPES)}
CLASSES = sum(map(sum, SPANS.values()))


def token_class(token: str) -> int:
    name = shape(token)
    short, long = SPANS[name]
    if len(token) <= SHORT:
        return FIRST[name] + zlib.crc32(token.encode()) % short
    return FIRST[name] + short + zlib.crc32(token[-2:].encode()) % long


class Network:
    """Weights and accumulated squares by name, in single precision; the last row of `out` are the biases of the classes."""

    def __init__(self, weights: dict[str, np.ndarray], squares: dict[str, np.ndarray]) -> None:
        self.weights, self.squares = weights, squares

    @classmethod
    def start(cls, classes: int = CLASSES) -> Network:
        rng = np.random.default_rng(SEED)
        normal = lambda *size: rng.normal(0, 1 / np.sqrt(size[0]), size).astype(np.float32)
        weights = {
            "embed": rng.normal(0, 0.5, (classes + 1, WIDTH)).astype(np.float32), "in": normal(2 * SIDE * WIDTH, HIDDEN), "in_bias": np.zeros(HIDDEN, np.float32),
            "out": np.vstack([normal(HIDDEN, classes) * np.float32(0.1), np.zeros((1, classes), np.float32)]),
        }
        return cls(weights, {k: np.full_like(v, 0.01) for k, v in weights.items()})

    def hidden(self, context: np.ndarray, room: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, hidden values with a one beside them, and logits of all classes (in `room` if given), small enough for their exponentials."""
        w = self.weights
        inputs = w["embed"].take(context.reshape(-1), axis=0).reshape(len(context), -1)
        hidden = np.ones((len(context), HIDDEN + 1), dtype=np.float32)
        sums = inputs @ w["in"]
        sums += w["in_bias"]
        np.tanh(sums, out=hidden[:, :-1])
        logits = np.matmul(hidden, w["out"], out=room)
        # Hidden values are within 1, so the weights bound the logits; mostly no row need be shifted.
        if float(np.abs(w["out"]).sum(axis=0).max()) > SAFE:
            logits -= logits.max(axis=1, keepdims=True)
        return inputs, hidden, logits

    def scores(self, context: np.ndarray, target: np.ndarray, at_once: int = 512) -> np.ndarray:
        """Log-probability of the target classes."""
        classes = self.weights["out"].shape[1]
        room, ones, found = np.empty((at_once, classes), np.float32), np.ones(classes, np.float32), np.empty(len(target), np.float32)
        for i in range(0, len(target), at_once):
            wanted = target[i : i + at_once]
            logits = self.hidden(context[i : i + at_once], room[: len(wanted)])[2]
            found[i : i + at_once] = logits[np.arange(len(wanted)), wanted]
            np.exp(logits, out=logits)
            found[i : i + at_once] -= np.log(logits @ ones)
        return found

    def train(self, context: np.ndarray, target: np.ndarray) -> None:
        """One pass over shuffled windows, by adaptive gradient steps."""
        both = self.packed()
        every, squares = np.split(both, 2)
        self.weights, self.squares = (own := self.unpacked(both)).weights, own.squares
        w = self.weights
        order = np.random.default_rng(SEED).permutation(len(target))
        classes = w["out"].shape[1]
        # The large table of a batch stays in one place and is passed over as seldom as can be.
        room, ones, steps = np.empty((BATCH, classes), np.float32), np.ones(classes, np.float32), (np.arange(WIDTH) * len(w["embed"]))[:, None]
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            near = context.take(rows, axis=0)
            inputs, hidden, wrong = self.hidden(near, room[: len(rows)])
            np.exp(wrong, out=wrong)
            total = wrong @ ones
            wrong[np.arange(len(rows)), target.take(rows)] -= total
            # What makes errors of the exponentials is multiplied in on the narrow side of each product.
            scale = 1 / (total * np.float32(len(rows)))[:, None]
            back = wrong @ w["out"][:-1].T
            back *= scale * (1 - hidden[:, :-1] ** 2)
            hidden *= scale
            cells = near.T.astype(np.int64)[:, None] + steps
            embed = np.bincount(cells.reshape(-1), (w["in"] @ back.T).reshape(-1), w["embed"].size).astype(np.float32).reshape(WIDTH, -1).T
            grads = {"out": hidden.T @ wrong, "in": inputs.T @ back, "in_bias": np.ones(len(rows), np.float32) @ back, "embed": embed}
            grad = np.concatenate([grads[k].reshape(-1) for k in sorted(grads)])
            squares += grad**2
            every -= RATE * grad / np.sqrt(squares + 1e-6)

    def packed(self) -> np.ndarray:
        """Weights, then squares, as one row of numbers."""
        return np.concatenate([t[k].reshape(-1) for t in (self.weights, self.squares) for k in sorted(t)])

    def unpacked(self, flat: np.ndarray) -> Network:
        """A network of these numbers; ones in single precision are not copied."""
        at, tables = 0, ({}, {})
        for table in tables:
            for k in sorted(self.weights):
                size = self.weights[k].size
                table[k] = flat[at : at + size].astype(np.float32, copy=False).reshape(self.weights[k].shape)
                at += size
        return Network(*tables)


def windows(flat: np.ndarray, counts: np.ndarray, classes: int) -> np.ndarray:
    """The neighbours of every token, `classes` where a text has none."""
    padded = np.full(len(flat) + SIDE * (len(counts) + 1), classes, dtype=flat.dtype)
    place = np.arange(len(flat)) + np.repeat(np.arange(1, len(counts) + 1) * SIDE, counts)
    padded[place] = flat
    out = np.empty((len(flat), 2 * SIDE), dtype=flat.dtype)
    for i, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        out[:, i] = padded[place + d]
    return out


class Known(Numbered):
    """Numbers of tokens, with the classes of those that were not given."""

    def __init__(self, given: Iterable[str] = ()) -> None:
        super().__init__(given)
        self.first, self.classes = len(self.tokens), np.zeros(0, dtype=np.int16)

    def new(self) -> list[str]:
        return [*islice(self.tokens, self.first, None)]

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        numbers, counts = super().of(texts)
        more = islice(self.tokens, self.first + len(self.classes), None)
        self.classes = np.concatenate([self.classes, np.fromiter(map(token_class, more), dtype=np.int16)])
        return numbers, counts


class Counted:
    """Tokens of a task with their classes and counts, handed on when they are many."""

    def __init__(self) -> None:
        self.known, self.times = Known(), np.zeros(0, dtype=np.int64)

    def add(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Classes of all tokens and the number of each text."""
        numbers, counts = self.known.of(texts)
        times = np.bincount(numbers, minlength=len(self.known.tokens))
        times[: len(self.times)] += self.times
        self.times = times
        return self.known.classes[numbers], counts

    def taken(self) -> pa.RecordBatch:
        n = len(self.known.tokens)
        columns = [pa.array(self.known.new(), pa.string()), pa.array(self.known.classes, pa.int32()), pa.array(self.times, pa.int64()), pa.nulls(n, pa.binary())]
        self.known, self.times = Known(), np.zeros(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays(columns, names=["token", "class", "n", "weights"])


def dealt(docs: DataFrame, text: str, rounds: int, block_bytes: int) -> DataFrame:
    """Texts with the round and block that train on them and their order within it."""
    rows = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash")).where(F.length("text") > 0)
    weighed = rows.groupBy("hash").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    total = materialize(weighed.agg(F.sum("bytes").alias("bytes"))).first().bytes or 0
    many = materialize(weighed.where(F.col("n") > COPIES).select(F.col("hash").alias("_hash")))
    if not many.isEmpty():
        rows = rows.join(many, F.col("hash") == F.col("_hash"), "left")
        own = F.when(F.col("_hash").isNotNull(), F.xxhash64(F.monotonically_increasing_id())).otherwise(F.col("hash"))
        rows = rows.select("text", own.alias("hash"))
    blocks = max(1, round(total / rounds / block_bytes))
    place = F.xxhash64("hash", F.lit("block"))
    return rows.withColumns({"round": F.pmod(place, F.lit(rounds)), "block": F.pmod(F.shiftright(place, 20), F.lit(blocks))})


class Model:
    """The trained network, how many tokens each class has, and the count table of the corpus (token, n)."""

    def __init__(self, network: Network, sizes: dict[int, int], counted: DataFrame) -> None:
        self.network, self.sizes, self.counted = network, sizes, counted


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES) -> Model:
    spark = docs.sparkSession
    small_batches(spark)
    network, tables = Network.start(), []
    rows = dealt(docs, text, rounds, block_bytes)
    for number in range(rounds):
        first = share(spark, network)

        def run(batches: Iterator[pa.RecordBatch], first=first) -> Iterator[pa.RecordBatch]:
            begin = first()
            start = begin.packed()
            own, block, seen, everything, total = None, None, 0, 0, np.zeros(len(start))
            held: list[tuple[np.ndarray, np.ndarray]] = []
            counted = Counted()

            def learn() -> None:
                """Trains on the texts held so far as one pass, so steps do not depend on how rows were cut into batches."""
                nonlocal seen
                flat, counts = (np.concatenate(parts) for parts in zip(*held, strict=True))
                own.train(windows(flat, counts, CLASSES), flat)
                seen += len(flat)
                held.clear()

            def close() -> None:
                nonlocal total, everything
                if held:
                    learn()
                if own is not None and seen:
                    total += own.packed().astype(np.float64) * seen
                    everything += seen

            for whole in batches:
                numbers = whole.column(whole.schema.get_field_index("block")).to_pylist()
                edges = [i for i in range(len(numbers)) if i == 0 or numbers[i] != numbers[i - 1]] + [len(numbers)]
                for a, b in zip(edges, edges[1:]):
                    if own is None or numbers[a] != block:
                        close()
                        own, block, seen = begin.unpacked(start), numbers[a], 0
                    for batch in slices(whole.slice(a, b - a), "text"):
                        held.append(counted.add(texts_of(batch, "text")))
                        if sum(len(flat) for flat, _ in held) >= HELD_TOKENS:
                            learn()
                        if len(counted.known.tokens) > REMEMBERED:
                            yield counted.taken()
            if len(counted.known.tokens):
                yield counted.taken()
            close()
            if everything:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()), pa.array([everything], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["token", "class", "n", "weights"])

        def add(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, seen = 0.0, 0
            for batch in batches:
                total, seen = total + sum(np.frombuffer(raw, np.float64) for raw in batch["weights"]), seen + int(batch["n"].sum())
            yield pd.DataFrame({"n": [seen], "weights": [total.tobytes()]})

        mine = rows.where(F.col("round") == number).repartition("block").sortWithinPartitions("block", "hash", "text")
        found = materialize(mine.select("block", "text").mapInArrow(run, "token string, class int, n bigint, weights binary"))
        sums = found.where("token IS NULL").withColumn("part", F.spark_partition_id() % GROUPS).groupBy("part").applyInPandas(add, "n bigint, weights binary").collect()
        if sums:
            network = network.unpacked(sum(np.frombuffer(m.weights, np.float64) for m in sums) / sum(m.n for m in sums))
        tables.append(found.where("token IS NOT NULL").select("token", "class", "n"))
    counted = tables[0]
    for more in tables[1:]:
        counted = counted.unionByName(more)
    counted = materialize(counted.groupBy("token").agg(F.sum("n").alias("n"), F.first("class").alias("class")))
    # One row for each class.
    sizes = {r["class"]: r.n for r in counted.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    return Model(network, sizes, counted)


def score(docs: DataFrame, model: Model, text: str = "text", hot_tokens: int = HOT) -> DataFrame:
    """All columns of `docs` but the text, with n_tokens, log_likelihood (sum over all places) and mean_log_likelihood."""
    fields = [
        T.StructField("n_tokens", T.LongType()), T.StructField("log_likelihood", T.DoubleType()), T.StructField("__rare", T.ArrayType(T.StringType())),
    ]
    # A token met once adds log 1 to what its class has for it.
    more = model.counted.where("n > 1")
    top = more.orderBy(F.desc("n"), "token").limit(hot_tokens).toArrow()
    inside = -np.log(np.array([model.sizes.get(i, 0) + 1 for i in range(CLASSES)], dtype=np.float64))
    shared = share(docs.sparkSession, (model.network, inside, top.column("token").to_pylist(), top.column("n").to_numpy(), top.column("class").to_numpy()))

    def make():
        trained, share_of, frequent, times, classes = shared()
        classes, logs = classes.astype(np.int16), np.log(times.astype(np.float64))
        known = Known(frequent)

        def work(texts):
            nonlocal known
            if len(known.classes) > REMEMBERED:
                known = Known(frequent)
            found, counts = known.of(texts)
            flat = np.concatenate([classes, known.classes])[found]
            away = found >= len(frequent)
            value = trained.scores(windows(flat, counts, CLASSES), flat) + share_of[flat]
            value += np.concatenate([logs, np.zeros(len(known.classes))])[found]
            sums = np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])
            ends = np.cumsum(counts)
            rare = pa.array(known.new(), pa.string()).take(pa.array(found[away] - len(frequent)))
            bounds = np.concatenate([[0], np.cumsum(away)])[np.concatenate([[0], ends])]
            return counts, sums[ends] - sums[ends - counts], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rare)

        return work

    based = materialize(append_columns(docs.withColumn("__row", F.monotonically_increasing_id()), text, make, fields, drop=(text,)))
    rest = more.select("token", F.log("n").alias("log_n"))
    met = based.select("__row", F.explode("__rare").alias("token")).join(rest, "token").groupBy("__row").agg(F.sum("log_n").alias("__more"))
    whole = F.col("log_likelihood") + F.coalesce("__more", F.lit(0.0))
    kept = [F.col(f"`{n}`") for n in based.columns if n not in ("n_tokens", "log_likelihood", "mean_log_likelihood", "__row", "__rare")]
    return based.join(met, "__row", "left").select(
        *kept, "n_tokens", whole.alias("log_likelihood"), F.when(F.col("n_tokens") > 0, whole / F.col("n_tokens")).alias("mean_log_likelihood")
    )
