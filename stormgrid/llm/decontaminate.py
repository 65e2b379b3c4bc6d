"""Benchmark decontamination with a distributed positional inverted index.

`build_index` stores the postings of every training token: each task cuts its
documents into segments of a bounded number of words and writes, for each
segment, the sorted terms, where the list of each term starts, and the places
(word numbers within the segment) of each list. A segment is one row, so an
index of any size is an ordinary table, no key gathers rows, and a very common
word makes long lists inside segments but no large group. Segments are stored,
read and sent to Python one at a time, so a task's memory does not grow with the
documents it is dealt.

`search` reads each segment once. For every query window it takes the terms from
the rarest to the most frequent in that segment, shifts each list by the term's
offset in the window, and keeps the places that all lists share; places that
cross the end of a document do not count. Proximity matches (`slop` or `near` above 0) are
windows for which some place of the document has every term at most so many words
from where the window puts it; each list gives the rarest term's places, shifted.

Terms are 64-bit hashes of lower-cased words. A false match needs a word other
than the right one with an equal hash between nine right neighbours; for a
billion different words against a million query words that has a chance below
one in ten thousand.

Queries reach the tasks in blocks of at most `block_words` words, each broadcast
by itself, so a query set of any size goes through bounded memory.

Defined results: null and empty texts have no words and no hits; an item without
words matches nothing; items with equal windows are all reported; very long texts are indexed whole, in a segment of their own if need be; a null item id
marks words as hit and names no item; repeated documents each get their own row;
an empty table of either kind gives no hits or no rows; other columns of the
inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stormgrid.llm.common import release_memory, share, short_batches, slices, texts_of
from stormgrid.session import materialize

WINDOW = 10
#: Words that a term may stand away in the proximity matches of the query.
NEAR = 2
SEGMENT_WORDS = 1 << 18
BLOCK_WORDS = 1_000_000
#: Bytes of text hashed at a time; a longer document is hashed alone.
HASHED_BYTES = 500_000
SEED = 20240229


class WordHasher:
    """Hashes of the words of many texts at once.

    A word is a run of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased.
    """

    def __init__(self) -> None:
        random = np.random.default_rng(SEED)
        table = random.integers(1, 1 << 63, 256, dtype=np.uint64)
        byte = np.arange(256)
        letter = (byte >= 0x80) | ((byte >= 0x30) & (byte <= 0x39)) | ((byte >= 0x61) & (byte <= 0x7A))
        upper = (byte >= 0x41) & (byte <= 0x5A)
        table[upper] = table[byte[upper] + 32]
        self.table, self.word = table, letter | upper
        self.base = int(random.integers(1, 1 << 62)) * 2 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) >= n:
            return
        size = 1 << (n - 1).bit_length()
        for name, base in (("up", self.base), ("down", self.inverse)):
            powers = np.empty(size, dtype=np.uint64)
            powers[0] = 1
            held = 1
            while held < size:
                powers[held : 2 * held] = powers[:held] * np.uint64(pow(base, held, 1 << 64))
                held *= 2
            setattr(self, name, powers)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words in order, and the number of words of each text."""
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        self._powers(len(data))
        inside = self.word[data]
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=np.int8(0)))
        starts, ends = edge[::2], edge[1::2]
        sums = np.cumsum(self.table[data] * self.up[: len(data)])
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        hashes = (sums[ends - 1] - before) * self.down[starts]
        hashes ^= hashes >> np.uint64(32)
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        counts = np.diff(np.searchsorted(starts, bounds))
        return hashes, counts


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Stores the positional index of `text` in the shared folder and returns it, a row for each segment."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"segment bigint, keys array<{kind}>, starts binary, terms binary, list_starts binary, postings binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hasher, part, made = WordHasher(), TaskContext.get().partitionId(), 0
        keys, hashes, counts, held = [], [], [], 0

        def segment() -> pa.RecordBatch:
            words = np.concatenate(hashes) if hashes else np.empty(0, dtype=np.uint64)
            order = np.argsort(words, kind="stable")
            ordered = words[order]
            first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.empty(0, dtype=np.int64)
            starts = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int64)
            columns = [starts, ordered[first], np.append(first, len(ordered)).astype(np.int64), order.astype(np.uint32)]
            every = pa.concat_arrays(keys)
            lists = pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every)
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made], pa.int64()), lists, *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                names=["segment", "keys", "starts", "terms", "list_starts", "postings"],
            )

        for whole in batches:
            for batch in slices(whole, "text", HASHED_BYTES):
                found, number = hasher(texts_of(batch, "text"))
                key = batch.column(batch.schema.get_field_index("key"))
                keys.append(key.take(pa.array(np.arange(len(key)))))  # a slice would hold the texts of its batch
                hashes.append(found)
                counts.append(number)
                held += len(found)
                if held >= segment_words or sum(map(len, keys)) >= segment_words:
                    yield segment()
                    made += 1
                    keys, hashes, counts, held = [], [], [], 0
        if keys:
            yield segment()
        del hasher, keys, hashes, counts
        release_memory()

    short_batches(docs.sparkSession)
    return materialize(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(run, schema), group_rows=1)


@dataclass
class QueryBlock:
    """Windows of some items: indices into `terms`, -1 beyond the end of a shorter window."""

    terms: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    items: list[list]


def query_blocks(items: DataFrame, key: str, text: str, window: int | None, block_words: int) -> Iterator[QueryBlock]:
    """The distinct windows of the items, in blocks of at most `block_words` words or one item.

    Items come to the driver one partition at a time; no more than a block is held.
    """
    hasher = WordHasher()

    def block(rows: list[tuple]) -> QueryBlock:
        found: dict[bytes, list] = {}
        for item, words in rows:
            n = min(window or len(words), len(words))
            for i in range(len(words) - n + 1 if n else 0):
                named = found.setdefault(words[i : i + n].tobytes(), [])
                if item is not None and item not in named:
                    named.append(item)
        widths = np.array([len(w) // 8 for w in found], dtype=np.int64)
        terms, index = np.unique(np.frombuffer(b"".join(found), dtype=np.uint64), return_inverse=True)
        windows = np.full((len(found), int(widths.max(initial=0))), -1, dtype=np.int32)
        windows[np.arange(windows.shape[1]) < widths[:, None]] = index
        return QueryBlock(terms, windows, widths, list(found.values()))

    rows, held = [], 0
    for row in items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).toLocalIterator():
        words, _ = hasher([(row.t or "").encode()])
        if rows and held + len(words) > block_words:
            yield block(rows)
            rows, held = [], 0
        rows.append((row.k, words))
        held += len(words)
    yield block(rows)


def window_places(lists: list[np.ndarray], offsets: np.ndarray, starts: np.ndarray, width: int, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window begins, and their documents: `lists` from the rarest term on, each to be shifted by its offset.

    With slop such a place may lie before its document, which is that of the rarest term.
    """
    doc = np.searchsorted(starts, lists[0], side="right") - 1
    places, doc = (lists[0].astype(np.int64)[:, None] - offsets[0] + np.arange(-slop, slop + 1)).reshape(-1), np.repeat(doc, 2 * slop + 1)
    low, high = starts[doc], starts[doc + 1] - 1
    keep = (places >= low) & (places + width - 1 <= high) if slop == 0 else np.ones(len(places), dtype=bool)
    for postings, offset in zip(lists[1:], offsets[1:], strict=True):
        places, doc, low, high = places[keep], doc[keep], low[keep], high[keep]
        if not len(places):
            return places, doc
        # Kept if the list has a place between the bounds; both bounds are the shifted place itself when slop is 0.
        at = np.searchsorted(postings, np.maximum(places + (offset - slop), low))
        nearest = postings[np.minimum(at, len(postings) - 1)]
        keep = (at < len(postings)) & (nearest <= np.minimum(places + (offset + slop), high))
    return places[keep], doc[keep]


def _segment_matches(block: QueryBlock, starts, terms, list_starts, postings, slop: int, near: int | None):
    """Window, places, documents, and documents by proximity of every window with matches in a segment."""
    if not len(terms) or not len(block.windows):
        return
    at = np.minimum(np.searchsorted(terms, block.terms), len(terms) - 1)
    size = np.where(terms[at] == block.terms, list_starts[at + 1] - list_starts[at], 0)
    # Padding looks up the extra last entry, which never rules a window out.
    sizes = np.append(size, np.iinfo(np.int64).max)[block.windows]
    for w in np.flatnonzero(sizes.min(axis=1) > 0):
        width = int(block.lengths[w])
        offsets = np.argsort(sizes[w, :width], kind="stable")
        chosen = at[block.windows[w, offsets]]
        lists = [postings[list_starts[t] : list_starts[t + 1]] for t in chosen]
        places, docs = window_places(lists, offsets, starts, width, slop)
        beside = docs if near is None else window_places(lists, offsets, starts, width, near)[1]
        if len(places) or len(beside):
            yield int(w), places, docs, beside


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", window: int | None = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS, near: int | None = None) -> DataFrame:
    """Every indexed document with what was found in it.

    A query is each run of `window` words of an item (the whole item if it has
    fewer, or if `window` is None). Returns key, n_words, `spans` (sorted,
    disjoint [first, end) word ranges that some match covers), `items` (ids of
    the matched items, distinct and sorted), n_hit (words inside spans) and
    `near_items`: the items that match with each word up to `near` places away
    (those of `items` without `near`).
    """
    spark = index.sparkSession
    kind = index.schema["keys"].dataType.elementType.simpleString()
    item_kind = items.schema[key].dataType.simpleString()
    schema = f"segment bigint, row int, key {kind}, n_words bigint, spans array<struct<first:bigint,end:bigint>>, items array<{item_kind}>, near_items array<{item_kind}>"

    def searcher(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared()
            for batch in batches:
                for i in range(batch.num_rows):
                    segment = batch.column(0)[i]
                    keys = batch.column(1).slice(i, 1).flatten()
                    starts, terms, list_starts, postings = (np.frombuffer(batch.column(c)[i].as_buffer(), dtype=d) for c, d in ((2, np.int64), (3, np.uint64), (4, np.int64), (5, np.uint32)))
                    yield found_in(block, segment.as_py(), keys, starts, terms, list_starts, postings)

        return run

    def found_in(block, segment, keys, starts, terms, list_starts, postings) -> pa.RecordBatch:
        n = len(keys)
        edges = np.zeros(len(postings) + 1, dtype=np.int32)
        named: dict[int, set] = {}
        close: dict[int, set] = {}
        for w, places, docs, beside in _segment_matches(block, starts, terms, list_starts, postings, slop, near):
            np.add.at(edges, np.maximum(places, starts[docs]), 1)
            np.add.at(edges, np.minimum(places + block.lengths[w], starts[docs + 1]), -1)
            for held, found in ((named, docs), (close, beside)):
                for d in np.unique(found).tolist():
                    held.setdefault(d, set()).update(block.items[w])
        # A document's first word never continues a span of the one before it.
        covered = np.cumsum(edges[:-1]) > 0
        first = np.flatnonzero(covered & ~np.concatenate([[False], covered[:-1]])) if len(covered) else np.empty(0, dtype=np.int64)
        end = np.flatnonzero(covered & ~np.concatenate([covered[1:], [False]])) + 1 if len(covered) else np.empty(0, dtype=np.int64)
        spans: list[list] = [[] for _ in range(n)]
        for a, b in zip(first.tolist(), end.tolist(), strict=True):
            d = int(np.searchsorted(starts, a, side="right")) - 1
            while a < b:  # spans that touch across documents are cut at the border
                stop = min(b, int(starts[d + 1]))
                if stop > a:
                    spans[d].append({"first": a - int(starts[d]), "end": stop - int(starts[d])})
                a, d = stop, d + 1
        columns = [
            pa.array([segment] * n, pa.int64()), pa.array(np.arange(n), pa.int32()), keys, pa.array(np.diff(starts), pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
            *(pa.array([sorted(ids.get(d, ())) for d in range(n)], pa.list_(item_type)) for ids in (named, close)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["segment", "row", "key", "n_words", "spans", "items", "near_items"])

    item_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_kind]
    short_batches(spark)
    parts = []
    for block in query_blocks(items, key, text, window, block_words):
        parts.append(index.mapInArrow(searcher(share(spark, block)), schema))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    if len(parts) > 1:
        result = result.groupBy("segment", "row").agg(
            F.first("key").alias("key"), F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"), *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near_items")],
        ).withColumn("spans", F.expr(JOINED_SPANS))
    return result.select("key", "n_words", "spans", "items", "near_items", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.first)").alias("n_hit"))


#: Overlapping and touching spans of several blocks become one.
JOINED_SPANS = """aggregate(array_sort(spans), cast(array() as array<struct<first:bigint,end:bigint>>), (held, s) ->
  CASE WHEN size(held) > 0 AND element_at(held, -1).end >= s.first
    THEN concat(slice(held, 1, size(held) - 1), array(named_struct('first', element_at(held, -1).first, 'end', greatest(element_at(held, -1).end, s.end))))
    ELSE concat(held, array(s)) END)"""


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", window: int = WINDOW) -> DataFrame:
    """The documents, all columns, in which no window of an item occurs.

    Documents of equal id and text share their fate, so the hash of both serves as key.
    """
    name = "__decontaminate_key"
    keyed = docs.withColumn(name, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if c in ("doc_id", text)]))
    found = search(build_index(keyed, key=name, text=text), items, key=item_key, window=window)
    bad = materialize(found.where("n_hit > 0").select(F.col("key").alias(name)).distinct())
    return keyed.join(bad, name, "left_anti").drop(name)
