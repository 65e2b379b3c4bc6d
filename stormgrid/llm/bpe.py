"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree hold the merge rank of each symbol with its right
neighbour (a large number where the pair has none); every inner node holds the
smaller of its children. The root therefore names the lowest rank in the word
and the walk that prefers the left child finds its leftmost place. A merge
changes three leaves, each in logarithmic time, so a word of n symbols takes
O(n log n) however long it is. Words recur, so each task keeps the ids of the
words it has met, up to a fixed number.

Defined results: null and empty texts give no ids and an empty decoded text;
repeated rows are encoded alike, each on its own; an empty table gives an empty
table; a column already called `ids`, `n_tokens` or `decoded` is replaced.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Callable

import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stormgrid.llm.common import append_columns

#: Words whose ids a task remembers; beyond it the memory starts anew.
WORDS_KEPT = 250_000
NO_RANK = 1 << 60


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(printable) else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Ids, merges and text rules read from a tokenizer file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        #: Rank of a pair (left id above right id), and the id that the merge of each rank makes.
        self.ranks: dict[int, int] = {}
        self.results: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks.setdefault(self.ids[left] << 32 | self.ids[right], rank)
            self.results.append(self.ids[left + right])
        symbols = byte_symbols()
        self.inner = [self.ids[s] for s in symbols]
        self.final = [self.ids[s + self.suffix] for s in symbols]
        split = next(p for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern: str = split["pattern"]["Regex"]

    def names(self) -> list[str]:
        every = self.ids | self.special
        names = [""] * (max(every.values()) + 1)
        for text, i in every.items():
            names[i] = text
        return names


def merge_word(symbols: list[int], ranks: dict[int, int], results: list[int]) -> list[int]:
    """Merges the leftmost pair of lowest rank until no pair of the list has a rank.

    A leaf holds its rank above its own place, so the smallest value, which the
    root holds, is the leftmost pair of the lowest rank. Value and leaf are
    replaced at three places after each merge.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length()
    shift = size.bit_length()
    place = (1 << shift) - 1
    tree = [NO_RANK] * (2 * size)
    get = ranks.get
    leaf = size
    for pair in zip(symbols, symbols[1:]):
        rank = get(pair[0] << 32 | pair[1])
        if rank is not None:
            tree[leaf] = rank << shift | leaf - size
        leaf += 1
    for node in range(size - 1, 0, -1):
        low, other = tree[2 * node], tree[2 * node + 1]
        tree[node] = low if low < other else other
    after = list(range(1, n + 2))
    before = list(range(-1, n))
    while (best := tree[1]) < NO_RANK:
        left = best & place
        right = after[left]
        follower = after[left] = after[right]
        before[follower] = left
        symbol = symbols[left] = results[best >> shift]
        symbols[right] = -1
        previous = before[left]
        rank = get(symbol << 32 | symbols[follower]) if follower < n else None
        changes = [(left, NO_RANK if rank is None else rank << shift | left), (right, NO_RANK)]
        if previous >= 0:
            rank = get(symbols[previous] << 32 | symbol)
            changes.append((previous, NO_RANK if rank is None else rank << shift | previous))
        for leaf, value in changes:
            node = size + leaf
            if node >= 2 * size or tree[node] == value:
                continue
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                low = value if value < other else other
                node >>= 1
                if tree[node] == low:
                    break
                tree[node] = value = low
    return [s for s in symbols if s >= 0]


def encoder(path: str, words_kept: int = WORDS_KEPT) -> Callable[[bytes], bytes]:
    """A function from the UTF-8 bytes of a text to its ids as little-endian unsigned 32-bit integers.

    No match of the splitting pattern spans white space, so a text is the
    sequence of its ASCII-blank-separated chunks, each encoded by itself.
    """
    vocabulary = Vocabulary(path)
    ranks, results, inner, final = vocabulary.ranks, vocabulary.results, vocabulary.inner, vocabulary.final
    pieces = regex.compile(vocabulary.pattern)
    special = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")")
    #: What every special string begins with; a chunk without it holds none.
    marker = os.path.commonprefix(list(vocabulary.special)).encode()
    words: dict[str, bytes] = {}

    def word_ids(word: str) -> bytes:
        if (known := words.get(word)) is None:
            raw = word.encode()
            symbols = [inner[b] for b in raw[:-1]] + [final[raw[-1]]]
            known = array("I", merge_word(symbols, ranks, results)).tobytes()
            if len(words) >= words_kept:
                words.clear()
            if len(word) <= 64:
                words[word] = known
        return known

    def plain_ids(text: str) -> bytes:
        if not text.isascii():
            # Lower-casing goes character by character, so a final sigma is no special case.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return b"".join(map(word_ids, pieces.findall(text.lower())))

    class Chunks(dict):
        def __missing__(self, chunk: bytes) -> bytes:
            text = chunk.decode("utf-8", "replace")
            if marker in chunk:
                ids = b"".join(array("I", [vocabulary.special[p]]).tobytes() if i % 2 else plain_ids(p) for i, p in enumerate(special.split(text)))
            else:
                ids = plain_ids(text)
            if len(self) >= words_kept:
                self.clear()
            if len(chunk) <= 64:
                self[chunk] = ids
            return ids

    chunks = Chunks()
    return lambda text: b"".join(map(chunks.__getitem__, text.split()))


def encode(docs: DataFrame, vocabulary: str, text: str = "text", words_kept: int = WORDS_KEPT, decoded: bool = False, drop: tuple[str, ...] = ()) -> DataFrame:
    """Adds `ids` (little-endian unsigned 32-bit integers) and `n_tokens` to every row.

    With `decoded` the same tasks decode the ids at once, as `decode` does from
    stored ones. Columns in `drop`, such as the text, do not travel back.
    """
    fields = [T.StructField("ids", T.BinaryType()), T.StructField("n_tokens", T.LongType())]
    back = [T.StructField("decoded", T.StringType())] if decoded else []

    def make():
        to_ids = encoder(vocabulary, words_kept)
        to_text = decoder(vocabulary) if decoded else None

        def work(texts):
            ids = [to_ids(t) for t in texts]
            columns = [ids, [len(i) // 4 for i in ids]]
            return [*columns, [to_text(i) for i in ids]] if to_text else columns

        return work

    return append_columns(docs, text, make, fields + back, drop)


def decoder(path: str) -> Callable[[bytes], str]:
    """A function from ids to the vocabulary's strings joined by blanks, special ones included."""
    names = Vocabulary(path).names()
    return lambda ids: " ".join(map(names.__getitem__, memoryview(ids).cast("I")))


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Adds `decoded`, as a tokenizer file without a decoder stands for.

    `plain_text` undoes the byte symbols and word ends instead.
    """
    def make():
        to_text = decoder(vocabulary)
        return lambda rows: [[to_text(r) for r in rows]]

    return append_columns(encoded, ids, make, [T.StructField("decoded", T.StringType())])


def plain_text(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Adds `plain`: readable text, each word end written as one blank, none at the end."""
    def make():
        vocab = Vocabulary(vocabulary)
        back = {s: bytes([b]) for b, s in enumerate(byte_symbols())}
        special = set(vocab.special.values())

        def text_of(i: int, name: str) -> bytes:
            if i in special:
                return name.encode() + b" "
            ends = bool(vocab.suffix) and name.endswith(vocab.suffix)
            stem = name.removesuffix(vocab.suffix) if ends else name
            return b"".join(back[c] for c in stem) + b" " * ends

        parts = [text_of(i, name) for i, name in enumerate(vocab.names())]
        return lambda rows: [[b"".join(map(parts.__getitem__, memoryview(r).cast("I"))).decode("utf-8", "replace").rstrip(" ") for r in rows]]

    return append_columns(encoded, ids, make, [T.StructField("plain", T.StringType())])
