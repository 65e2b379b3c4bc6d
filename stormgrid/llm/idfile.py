"""Token ids in files of patched frame-of-reference blocks.

A page holds the ids of whole documents, in blocks of 128. A block stores its
minimum, the differences from it packed at the width that `PERCENTILE` percent of
them fit, and the others as exceptions: place and full difference. The page
begins with the start of each block, so a reader can unpack any range of blocks.

    page    magic "PFR1", ids, blocks (unsigned 32-bit, little-endian as all below)
            start of each block and of the end, counted from the page's first byte
    block   minimum (32 bits), width (8), exceptions (8)
            128 packed differences, lowest bit first; places (8 bits each); differences (32 bits each)

Pages are rows of a Parquet table that Spark writes to any store it knows: shard,
page, first (ids of the shard before the page), the documents' ids and lengths,
and the page itself. Shards are ranges of document ids in ascending order;
`manifest` has the number of ids before each shard. A page is closed once it
holds `PAGE_IDS` ids; a longer document has a page to itself.

Defined results: null and empty texts have the end id only; documents of equal
id stand in the order of their texts; a null document id comes first; an empty
table gives no pages; other columns are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormgrid.llm.bpe import byte_symbols
from stormgrid.llm.common import WordMemory, process_memory, slices, small_batches, texts_of

BLOCK = 128
PAGE_IDS = 1 << 17
PERCENTILE = 90
MAGIC = b"PFR1"
#: Words and pieces of words whose ids a worker remembers, words looked up and new pieces asked for at a time.
WORDS_KEPT, PIECES_KEPT, WORDS_AT_ONCE, PIECES_AT_ONCE = 600_000, 600_000, 100_000, 2_000
#: Bytes of words that a worker remembers.
BYTES_KEPT = 32 << 20


def pack(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One page from unsigned 32-bit ids."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    table = np.empty(blocks * BLOCK, dtype=np.uint32)
    table[:n] = ids
    table[n:] = ids[-1] if n else 0
    table = table.reshape(blocks, BLOCK)
    low = table.min(axis=1, initial=0xFFFFFFFF)
    delta = table - low[:, None]
    at = max(-(-BLOCK * percentile // 100) - 1, 0)
    width = np.ceil(np.log2(np.sort(delta, axis=1)[:, at].astype(np.float64) + 1)).astype(np.int64)
    outside = delta.astype(np.uint64) >> width[:, None].astype(np.uint64) != 0
    exceptions = outside.sum(axis=1)
    start = 4 * (3 + blocks + 1) + np.concatenate([[0], np.cumsum(6 + BLOCK // 8 * width + 5 * exceptions)])
    out = np.zeros(int(start[-1]), dtype=np.uint8)
    head = np.concatenate([np.frombuffer(MAGIC, dtype="<u4"), [n, blocks], start]).astype("<u4")
    out[: 4 * len(head)] = head.view(np.uint8)
    begin = start[:-1]
    out[begin[:, None] + np.arange(4)] = low.astype("<u4").view(np.uint8).reshape(-1, 4)
    out[begin + 4] = width
    out[begin + 5] = exceptions
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(delta[rows].astype("<u4").reshape(-1, 1).view(np.uint8), axis=1, count=w, bitorder="little")
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        out[begin[rows][:, None] + 6 + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(outside)
    if len(row):
        order = np.arange(len(row)) - np.concatenate([[0], np.cumsum(exceptions)])[row]
        places = begin[row] + 6 + BLOCK // 8 * width[row]
        out[places + order] = place
        values = places + exceptions[row] + 4 * order
        out[values[:, None] + np.arange(4)] = delta[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes()


def unpack(page: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks `first` to `last` (not included; to the end if None)."""
    data = np.frombuffer(page, dtype=np.uint8)
    magic, n, blocks = np.frombuffer(page, dtype="<u4", count=3)
    if int(magic).to_bytes(4, "little") != MAGIC:
        raise ValueError("not a page of ids")
    last = int(blocks) if last is None else min(last, int(blocks))
    begin = np.frombuffer(page, dtype="<u4", count=int(blocks) + 1, offset=12).astype(np.int64)[first:last]
    low = data[begin[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    width, exceptions = data[begin + 4].astype(np.int64), data[begin + 5].astype(np.int64)
    delta = np.zeros((len(begin), BLOCK), dtype=np.uint32)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        packed = data[begin[rows][:, None] + 6 + np.arange(BLOCK // 8 * w)]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
        values = np.zeros((len(rows), BLOCK), dtype=np.uint32)
        for k in range(w):
            values |= bits[:, :, k].astype(np.uint32) << np.uint32(k)
        delta[rows] = values
    if exceptions.sum():
        row = np.repeat(np.arange(len(begin)), exceptions)
        order = np.arange(len(row)) - (np.cumsum(exceptions) - exceptions)[row]
        places = begin[row] + 6 + BLOCK // 8 * width[row]
        values = places + exceptions[row] + 4 * order
        delta[row, data[places + order]] = data[values[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
    ids = (delta + low[:, None]).reshape(-1)
    return ids[: max(0, int(n) - first * BLOCK)]


def library_encoder(path: str, words_kept: int = WORDS_KEPT, pieces_kept: int = PIECES_KEPT) -> Callable[[list[bytes]], list[bytes]]:
    """The tokenizers library on whole texts, asked once for each piece it has not met lately.

    No match of this vocabulary's splitting pattern spans white space, so the ids
    of a text are those of its ASCII-blank-separated words in order. A word of
    ASCII or marked Latin letters is in turn the sequence of its matches,
    lower-cased; other words, and those that may hold a special string, go to the
    library as they are. Normalizing leaves such matches as they are, so many of
    them at a time go to the library's model as one text, cut at blanks only; its
    ids are cut where a token ends a word.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import WhitespaceSplit

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    by_blanks = Tokenizer(tokenizer.model)
    by_blanks.pre_tokenizer = WhitespaceSplit()
    last = np.zeros(1 + max(tokenizer.get_vocab().values()), dtype=bool)
    last[[i for token, i in tokenizer.get_vocab().items() if token.endswith(tokenizer.model.end_of_word_suffix)]] = True
    ids_of: dict[bytes, bytes] = {}
    symbols = {b: s for b, s in enumerate(byte_symbols()) if b != ord(" ")}
    # Printable ASCII and Latin letters with marks: composed already, and lower-cased to letters of the same range.
    plain = re.compile("[!-~\u00c0-\u012f\u0131-\u017f]+").fullmatch
    plain_ascii = re.compile(rb"[!-~]+").fullmatch
    # The vocabulary file's pattern, for ASCII and for the characters of `plain`.
    find = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+").findall
    find_marked = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|[0-9]|(?:[^\s\w]|_)+").findall

    def learn_pieces(new: list[bytes]) -> None:
        for at in range(0, len(new), PIECES_AT_ONCE):
            some = new[at : at + PIECES_AT_ONCE]
            text = b" ".join(some)
            symbolic = text.decode() if text.isascii() else text.decode("latin-1").translate(symbols)
            ids = np.array(by_blanks.encode_batch_fast([symbolic], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = (4 * (np.flatnonzero(last[ids]) + 1)).tolist()
            raw, start = ids.tobytes(), 0
            for piece, end in zip(some, ends, strict=True):
                ids_of[piece] = raw[start:end]
                start = end

    class Ids(WordMemory):
        def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
            parts = []
            for at in range(0, len(words), WORDS_AT_ONCE):
                found = ids_of_words(words[at : at + WORDS_AT_ONCE])
                parts += map(found.__getitem__, words[at : at + WORDS_AT_ONCE])
            return np.frombuffer(b"".join(parts), dtype="<u4"), np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4

    def ids_of_words(missing: list[bytes]) -> dict[bytes, bytes]:
        simple = [w for w in missing if w.isascii()]
        joined, others = b"".join(simple), [w for w in missing if not w.isascii()]
        if b"<|" in joined or not plain_ascii(joined):
            others += [w for w in simple if b"<|" in w or not plain_ascii(w)]
            simple = [w for w in simple if b"<|" not in w and plain_ascii(w)]
        split = {w: [w.lower()] if w.isalpha() else find(w.lower()) for w in simple}
        marked = [(w, w.decode("utf-8", "replace")) for w in others if b"<|" not in w]
        split.update((w, [p.encode() for p in find_marked(text.lower())]) for w, text in marked if plain(text))
        others = [w for w in others if w not in split]
        new = set(chain.from_iterable(split.values())).difference(ids_of)
        if len(ids_of) + len(new) > pieces_kept:
            ids_of.clear()
            new = set(chain.from_iterable(split.values()))
        learn_pieces(list(new))
        get = ids_of.__getitem__
        known = {w: get(pieces[0]) if len(pieces) == 1 else b"".join(map(get, pieces)) for w, pieces in split.items()}
        found = tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in others], add_special_tokens=False)
        return known | {w: array("I", f.ids).tobytes() for w, f in zip(others, found, strict=True)}

    memory = Ids(words_kept, BYTES_KEPT)

    def encode(texts: list[bytes]) -> list[bytes]:
        numbers, counts = memory.of(texts)
        raw, ends = numbers.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    return encode


def worker_encoder(path: str) -> Callable[[list[bytes]], list[bytes]]:
    """The encoder of a vocabulary that a worker keeps from task to task, with the words it has met."""
    kept = process_memory("encoders")
    if path not in kept:
        kept[path] = library_encoder(path)
    return kept[path]


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", page_ids: int = PAGE_IDS) -> None:
    """Tokenizes the documents and writes their pages and the manifest to `folder`, in ascending order of `key`."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"shard int, page int, first bigint, n_ids bigint, keys array<{kind}>, lengths array<bigint>, payload binary"
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode, shard = worker_encoder(vocabulary), TaskContext.get().partitionId()
        page = first = held = 0
        keys, lengths, parts = [], [], []

        def filled() -> pa.RecordBatch:
            every = pa.concat_arrays(keys)
            columns = [
                pa.array([shard], pa.int32()), pa.array([page], pa.int32()), pa.array([first], pa.int64()), pa.array([held], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(every)], pa.int32()), every), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([pack(np.frombuffer(b"".join(parts), dtype="<u4"))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "page", "first", "n_ids", "keys", "lengths", "payload"])

        for whole in batches:
            for batch in slices(whole, "text"):
                column = batch.column(batch.schema.get_field_index("key"))
                for i, raw in enumerate(encode(texts_of(batch, "text"))):
                    ids = raw + end
                    if held and held + len(ids) // 4 > page_ids:
                        yield filled()
                        page, first, held = page + 1, first + held, 0
                        keys, lengths, parts = [], [], []
                    keys.append(column.slice(i, 1))
                    lengths.append(len(ids) // 4)
                    parts.append(ids)
                    held += len(ids) // 4
        if held:
            yield filled()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    # Copies of one row are alike wherever they land, so the text breaks ties within a range only.
    ordered = rows.repartitionByRange(F.col("key").asc_nulls_first()).sortWithinPartitions(F.col("key").asc_nulls_first(), "text")
    ordered.mapInArrow(run, schema).write.parquet(f"{folder}/pages")
    spark = docs.sparkSession
    # One row for each shard, and shards are partitions, so this is small however long the documents.
    totals = spark.read.parquet(f"{folder}/pages").groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    starts = np.concatenate([[0], np.cumsum([r.n for r in totals])]).astype(np.int64).tolist()
    spark.createDataFrame([(r.shard, starts[i], r.n) for i, r in enumerate(totals)], "shard int, shard_start bigint, n_ids bigint").coalesce(1).write.parquet(f"{folder}/manifest")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of the files: key, start (ids before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    pages = spark.read.parquet(f"{folder}/pages")
    kind = pages.schema["keys"].dataType.elementType.simpleString()
    schema = f"key {kind}, start bigint, n_tokens bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                first = batch.column(0)[i].as_py()
                keys, lengths = batch.column(1).slice(i, 1).flatten(), batch.column(2).slice(i, 1).flatten()
                ids = unpack(batch.column(3)[i].as_buffer()).astype("<u4").tobytes()
                bounds = np.concatenate([[0], np.cumsum(lengths.to_numpy())]).astype(np.int64)
                parts = [ids[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(first + bounds[:-1], pa.int64()), pa.array(lengths, pa.int64()), pa.array(parts, pa.binary())],
                    names=["key", "start", "n_tokens", "ids"],
                )

    placed = pages.join(F.broadcast(spark.read.parquet(f"{folder}/manifest").drop("n_ids")), "shard")
    return placed.select((F.col("shard_start") + F.col("first")).alias("first"), "keys", "lengths", "payload").mapInArrow(run, schema)
