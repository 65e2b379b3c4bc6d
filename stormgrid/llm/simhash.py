"""SimHash near-duplicates by pivot distance tables.

Fingerprints within `distance` bits of each other are linked; the classes are
the connected components of the links.

The method keeps, for every fingerprint, its Hamming distances to reference
fingerprints (pivots). By the triangle inequality two linked fingerprints differ
by at most `distance` in every coordinate of the table. Coordinates of whole
fingerprints alone let through about half of all pairs each, so the tables are
also kept for blocks of the bits: the 64 bits are cut into `distance` + 2 blocks,
so a linked pair agrees on at least two whole blocks, and there the differences
of all block coordinates must be 0. Equal block coordinates are a join key, one
for each pair of blocks; no link is lost. Pairs that share a key are discarded
by the largest coordinate difference of the whole-fingerprint table, and the
survivors verified by their bits.

Copies share a fingerprint, so keys hold different fingerprints only. Keys with
more than `CHUNK` of them (large groups of near copies) are dealt into chunks of
about that size by hash, and chunk pairs are compared as separate rows. `TILE`
chunks make a tile; pairs of a key are dealt by their two tiles, so the work is
spread over all tasks, a chunk travels once per tile and not per chunk, and each pair of chunks gives at most as many links as it
has fingerprints (a star for each component of its links), never all pairs.

Defined results: null, empty and blank texts have fingerprint zero, linked like
any other; repeated rows and equal texts share a class; a class is named by its
smallest id, null if it has no other; an empty table gives no rows; columns
called like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.llm.common import append_columns
from stormgrid.llm.components import components
from stormgrid.session import materialize

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Different fingerprints of one key that one task compares with each other or with as many more.
CHUNK = 1024
#: Chunks of one key in a tile; two tiles are compared in one place.
TILE = 8
#: Reference fingerprints of the table of whole fingerprints, and of each block's table.
PIVOTS = 16


def pivots(number: int = PIVOTS) -> list[int]:
    """Reference fingerprints: fixed random 64-bit numbers."""
    return [int(x) for x in np.random.default_rng(7).integers(0, 1 << 64, number, dtype=np.uint64)]


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Adds `fingerprint` (bigint): bit i is 1 if set in over half of the shingles' XXH64 hashes."""
    def make():
        from xxhash import xxh64_intdigest

        weights = np.uint64(1) << np.arange(64, dtype=np.uint64)

        def one(raw: bytes) -> int:
            words = raw.lower().split()
            if not words:
                return 0
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            n = max(len(words) - shingle + 1, 1)
            last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
            counts, hashed = np.zeros(64, dtype=np.int64), []
            spans = list(zip(starts[:n].tolist(), last.tolist(), strict=True))
            for at in range(0, n, 1 << 16):  # a very long text in bounded memory
                hashed = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans[at : at + (1 << 16)]], dtype="<u8")
                bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            return int(weights[2 * counts > n].sum(dtype=np.uint64).astype(np.int64))

        return lambda texts: [[one(t) for t in texts]]

    return append_columns(docs, text, make, [T.StructField("fingerprint", T.LongType())], drop=(text,))


def _distance(a: Column, b: int, mask: int = (1 << 64) - 1) -> Column:
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    other = a.bitwiseXOR(F.lit(signed(b)).cast("bigint"))
    return F.bit_count(other if mask == (1 << 64) - 1 else other.bitwiseAND(F.lit(signed(mask)).cast("bigint"))).cast("tinyint")


def blocks(number: int) -> list[int]:
    """Masks of `number` blocks that cover 64 bits."""
    bounds = [64 * i // number for i in range(number + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:], strict=False)]


def keyed(distinct: DataFrame, distance: int) -> DataFrame:
    """A row for each fingerprint and pair of blocks: the key made of the two blocks' pivot distances."""
    references, masks = pivots(), blocks(distance + 2)
    fp = F.col("fingerprint")
    tables = distinct.select("fingerprint", *[F.xxhash64(*[_distance(fp, p, m) for p in references]).alias(f"b{i}") for i, m in enumerate(masks)])
    keys = F.array(*[F.xxhash64(F.lit(i), F.lit(j), f"b{i}", f"b{j}") for i, j in combinations(range(len(masks)), 2)])
    return tables.select("fingerprint", F.explode(keys).alias("key"))


def chunk_pairs(chunks: DataFrame, tile: int = TILE) -> DataFrame:
    """Each two chunks of a key once, dealt over the tasks by key and tiles.

    The number of partitions is given, since adaptive coalescing goes by bytes: chunks are small, their pairs much work.
    """
    several, own = chunks.where("parts > 1"), F.expr(f"part div {tile}").cast("int")
    last = F.expr(f"(parts - 1) div {tile}").cast("int")
    number, by = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["key", "tile", "other_tile"]
    left = several.select("key", "part", "held", own.alias("tile"), F.explode(F.sequence(own, last)).alias("other_tile"))
    right = several.select("key", F.col("part").alias("other_part"), F.col("held").alias("other"), F.explode(F.sequence(F.lit(0), own)).alias("tile"), own.alias("other_tile"))
    return left.repartition(number, *by).join(right.repartition(number, *by), by).where("part < other_part")


def links(distinct: DataFrame, distance: int = DISTANCE, chunk: int = CHUNK) -> DataFrame:
    """Pairs (a, b) with the same connected components as all fingerprints within `distance` bits of each other."""
    rows = materialize(keyed(distinct, distance))
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    spread = F.pmod(F.xxhash64("fingerprint", F.lit("chunk")), F.ceil(F.col("n") / chunk)).cast("int")
    chunks = materialize(
        rows.join(sizes, "key").groupBy("key", spread.alias("part")).agg(F.collect_list("fingerprint").alias("held"), F.first(F.ceil(F.col("n") / chunk)).cast("int").alias("parts"))
    )
    pairs = chunks.where(F.size("held") > 1).select("held", F.lit(None).cast("array<bigint>").alias("other")).unionByName(chunk_pairs(chunks).select("held", "other"))
    references = np.array(pivots(), dtype=np.uint64)

    def near(a: np.ndarray, b: np.ndarray, table_a: np.ndarray, table_b: np.ndarray) -> np.ndarray:
        """Which pairs are linked: those not discarded by a coordinate, verified by their bits."""
        passed = np.abs(table_a[:, None, 0] - table_b[None, :, 0]) <= distance
        i, j = np.nonzero(passed)
        for k in range(1, len(references)):
            keep = np.abs(table_a[i, k] - table_b[j, k]) <= distance
            i, j = i[keep], j[keep]
            if len(i) < 256:
                break
        keep = np.abs(table_a[i] - table_b[j]).max(axis=1, initial=0) <= distance
        i, j = i[keep], j[keep]
        keep = np.bitwise_count(a[i] ^ b[j]) <= distance
        return np.stack([i[keep], j[keep]])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple[np.ndarray, np.ndarray]] = []
            for held, other in zip(batch["held"], batch["other"], strict=True):
                first = np.sort(np.asarray(held, dtype=np.int64)).view(np.uint64)
                alone = other is None
                second = first if alone else np.sort(np.asarray(other, dtype=np.int64)).view(np.uint64)
                if alone and len(first) == 2:
                    if int(first[0] ^ first[1]).bit_count() <= distance and np.abs(np.diff(np.bitwise_count(first[:, None] ^ references).astype(np.int16), axis=0)).max() <= distance:
                        out.append((first[:1], first[1:]))
                    continue
                out.append(forest(first, second, alone))
            a = np.concatenate([x for x, _ in out]) if out else np.empty(0, np.uint64)
            b = np.concatenate([x for _, x in out]) if out else np.empty(0, np.uint64)
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    def forest(first: np.ndarray, second: np.ndarray, alone: bool) -> tuple[np.ndarray, np.ndarray]:
        """A star for each component that the links between the two lists make, around its smallest fingerprint."""
        nodes = first if alone else np.concatenate([first, second])
        label = np.arange(len(nodes))
        table_first = np.bitwise_count(first[:, None] ^ references).astype(np.int16)
        table_second = table_first if alone else np.bitwise_count(second[:, None] ^ references).astype(np.int16)
        shift = 0 if alone else len(first)
        for at in range(0, len(first), 256):
            i, j = near(first[at : at + 256], second, table_first[at : at + 256], table_second)
            i, j = i + at, j + shift
            apart = label[i] != label[j]  # also rules out a fingerprint with itself
            i, j = i[apart], j[apart]
            bounds = np.append(np.flatnonzero(np.diff(i, prepend=-1)), len(i))
            for start, stop in zip(bounds, bounds[1:], strict=False):
                x = int(i[start])
                for other in np.unique(label[j[start:stop]]).tolist():
                    if other != label[x]:
                        label[label == other] = label[x]
        least = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(least, label, nodes.view(np.int64))
        least = least[label].view(np.uint64)
        return least[least != nodes], nodes[least != nodes]

    return pairs.mapInPandas(compare, "a bigint, b bigint").distinct()


def classes(marked: DataFrame, key: str, distance: int) -> DataFrame:
    """For each different fingerprint its component and the smallest key of the component."""
    distinct = materialize(marked.groupBy("fingerprint").agg(F.min(F.col(f"`{key}`")).alias("least")))
    label = components(materialize(links(distinct.select("fingerprint"), distance)))
    # Only fingerprints with a link are in `label`; a component's name is the least key of its fingerprints.
    joined = materialize(distinct.join(label, distinct["fingerprint"] == label["node"]).select("fingerprint", "component", "least"))
    names = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = materialize(joined.join(names, "component").select("fingerprint", "component", "component_id"))
    return distinct.join(linked, "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("component"), F.coalesce("component_id", "least").alias("component_id")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """All columns but the text, with `fingerprint` and `component_id` (smallest key reachable)."""
    marked = materialize(fingerprints(docs.drop("component_id"), text, shingle))
    return marked.join(classes(marked, key, distance).drop("component"), "fingerprint")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each component, all columns: that of the smallest key, of equal keys that of the smallest row.

    Null keys come last. Rows travel by their fingerprint, key and hash; the texts
    are read a second time and kept where those match, so no text is shuffled
    beyond the join with the rows that stay.
    """
    print_of = materialize(fingerprints(docs.select(F.col(f"`{key}`").alias("k"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("h"), F.col(f"`{text}`").alias("t")), "t", shingle))
    of = classes(print_of, "k", distance).select("fingerprint", "component")
    order = F.struct(F.col("k").isNull().alias("none"), "k", "h")
    # The least row of each fingerprint first, so a component of many copies is small before the join.
    least = print_of.groupBy("fingerprint").agg(F.min(order).alias("o"))
    stay = materialize(least.join(of, "fingerprint").groupBy("component").agg(F.min("o").alias("o")).select(F.col("o.h").alias("__h")))
    hashed = docs.withColumn("__h", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    # Rows that are equal in every column share a hash; one of them stays.
    return hashed.join(stay, "__h", "left_semi").dropDuplicates(["__h"]).drop("__h")
