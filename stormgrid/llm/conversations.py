"""Repair of conversation structure by lightest derivations.

A conversation is well formed if the initials of its roles read `(s?(ua)+)?`. The
edits Keep, Rerole, Delete and Insert are deductions over items: an item (entry,
i, state) says that the first i rows can be edited so that the output goes from
state `entry` to `state`; its weight is the pair (cost, audit), the audit being
the edits' initials. Every deduction adds to the cost and lengthens the audit,
so weights are superior functions: Knuth's agenda pops the lightest open item,
which is then final, and stops when the goal item is final. Two equally dear
derivations of an item never are prefixes of one another, because an audit
decides the state it leads to, so the order of (cost, audit) is kept by whatever
follows: ties end with the ASCII-least audit.

Conversations of at most `rows_at_once` rows and `bytes_at_once` bytes are
gathered by a hash shuffle of their ids and derived in one go (equal sequences of
roles and faults once per task). Longer ones are never gathered: their rows are
ordered by range partitions, equal rows collapsed, first occurrences found by
grouped minima, and stretches of `SPAN` rows derived from each entry state to each
exit state. The deduction with two premises, a prefix and the stretch after it,
joins `SPAN` neighbours at a time, level by level. Only the digest of the repaired
text, one running hash by definition, reads such a conversation's rows one after
the other, as a stream.

Defined results: null ids, turns, roles and texts are one space in the text that is
hashed, and null ids form one conversation; rows of equal turn stand in the order
of role and text; a null turn comes first and counts in no gap; an initial other
than s, u, a is never kept; very long texts and conversations are treated like
others; a conversation without rows has zeros, an empty audit and the digest of
the empty string; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormgrid.llm.common import release_memory, small_batches
from stormgrid.session import materialize

START, SYSTEM, USER, ASSISTANT = range(4)
STATES, FINAL = range(4), (START, ASSISTANT)
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state and role that a reroled or inserted row leads to.
NEXT, ROLE = (USER, USER, ASSISTANT, USER), ("user", "user", "assistant", "user")
LEGAL = frozenset({"su", "ua", "au"})
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a stretch, and stretches joined at a time, in long conversations.
SPAN = 64
ROWS_AT_ONCE, BYTES_AT_ONCE = 4096, 16 << 20
#: Role-and-fault sequences whose derivations a task remembers, and their greatest length.
KNOWN, KNOWN_LENGTH = 100_000, 64

Weight = tuple[int, str]


def agenda(axioms: list[tuple[int, str, tuple]], deduce: Callable, goal: Callable[[tuple], bool] | None = None) -> tuple[dict[tuple, Weight], tuple | None]:
    """Finalises items in the order of their weights until one is a goal (all of them without one).

    `deduce(item, weight, chart)` gives the conclusions (cost, audit, item) of the
    deductions that `item` completes together with items already final.
    """
    heap, chart = list(axioms), {}
    heapify(heap)
    while heap:
        cost, audit, item = heappop(heap)
        if item in chart:
            continue
        chart[item] = (cost, audit)
        if goal is not None and goal(item):
            return chart, item
        for conclusion in deduce(item, (cost, audit), chart):
            if conclusion[2] not in chart:
                heappush(heap, conclusion)
    return chart, None


def edits(rows: list[tuple[str, int]]) -> Callable:
    """Deductions over a sequence of (code, repeats).

    A code is the row's initial (x if it is no s, u or a), a capital if the row is
    truncated, or d if it must go. Only such rows are repeated.
    """
    def deduce(item: tuple, weight: Weight, _: dict) -> Iterator[tuple[int, str, tuple]]:
        entry, i, state = item
        cost, audit = weight
        yield cost + INSERT_COST, audit + "I", (entry, i, NEXT[state])
        if i == len(rows):
            return
        code, repeats = rows[i]
        # Deleting a run of rows at once loses nothing: an insertion amid it costs the same and has the greater audit.
        yield cost + DELETE_COST * repeats, audit + "D" * repeats, (entry, i + 1, state)
        if code == "d":
            return
        letter = code.lower()
        extra = TRUNCATED_COST if code.isupper() else 0
        kept = KEEP.get((state, letter))
        if kept is not None:
            yield cost + KEEP_COST + extra, audit + "K", (entry, i + 1, kept)
        if ROLE[state][0] != letter:
            yield cost + REROLE_COST + extra, audit + "R", (entry, i + 1, NEXT[state])

    return deduce


def cheapest(rows: list[tuple[str, int]]) -> Weight:
    """Cost and audit of the lightest repair of a whole conversation."""
    chart, goal = agenda([(0, "", (START, 0, START))], edits(rows), lambda item: item[1] == len(rows) and item[2] in FINAL)
    return chart[goal]


def transfers(rows: list[tuple[str, int]]) -> dict[tuple[int, int], Weight]:
    """The lightest repair of a stretch from each entry state to each exit state."""
    chart, _ = agenda([(0, "", (q, 0, q)) for q in STATES], edits(rows))
    return {(q, r): weight for (q, i, r), weight in chart.items() if i == len(rows)}


def joined(tables: list[dict[tuple[int, int], Weight]]) -> dict[tuple[int, int], Weight]:
    """The transfers of neighbouring stretches together.

    Items are stretches (0, j, p, r) and prefixes (1, j, q, p) of j stretches; a
    prefix and the stretch after it give the next prefix.
    """
    def deduce(item: tuple, weight: Weight, chart: dict) -> Iterator[tuple[int, str, tuple]]:
        kind, j, p, r = item
        cost, audit = weight
        if kind:
            for end in STATES:
                if (other := chart.get((0, j, r, end))) is not None:
                    yield cost + other[0], audit + other[1], (1, j + 1, p, end)
        else:
            for entry in STATES:
                if (other := chart.get((1, j, entry, p))) is not None:
                    yield other[0] + cost, other[1] + audit, (1, j + 1, entry, r)

    axioms = [(cost, audit, (0, j, *key)) for j, table in enumerate(tables) for key, (cost, audit) in table.items()]
    chart, _ = agenda([*axioms, *((0, "", (1, 0, q, q)) for q in STATES)], deduce)
    return {(q, r): weight for (kind, j, q, r), weight in chart.items() if kind and j == len(tables)}


class Editor:
    """Applies an audit to rows given one after the other and hashes the repaired text."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state, self.hash, self.lines = audit, 0, START, hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update((f"\n{role}:{text}" if self.lines else f"{role}:{text}").encode())
        self.lines += 1

    def _insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._line(ROLE[self.state], "")
            self.state, self.at = NEXT[self.state], self.at + 1

    def row(self, role: str, text: str, repeats: int = 1) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += repeats
        if edit == "K":
            self._line(role, text)
            self.state = KEEP[self.state, role[0]]
        elif edit == "R":
            self._line(ROLE[self.state], text)
            self.state = NEXT[self.state]

    def digest(self) -> str:
        self._insertions()
        return self.hash.hexdigest()


def initial(role: str) -> str:
    return role[0] if role[:1] in ("s", "u", "a") else "x"


def examined(roles: list[str], texts: list[str]) -> tuple[str, int, int, int]:
    """Codes of the rows, and how many are blank, duplicate and truncated."""
    codes, seen, blank, duplicate, truncated = [], set(), 0, 0, 0
    for role, text in zip(roles, texts, strict=True):
        end = text.rstrip(BLANKS)
        if not end:
            blank += 1
            codes.append("d")
            continue
        if (role, text) in seen:
            duplicate += 1
            codes.append("d")
            continue
        seen.add((role, text))
        code = initial(role)
        if end[-1] not in ".!?":
            truncated += 1
            code = code.upper()
        codes.append(code)
    return "".join(codes), blank, duplicate, truncated


RESULT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
COLUMNS = [field.split()[0] for field in RESULT.split(", ")]


def _gathered(rows: DataFrame, kind: str) -> DataFrame:
    """Results of conversations that fit one group; rows have conv, turn, role, text, present."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Weight] = {}

        def repaired(turns: list[int | None], roles: list[str], texts: list[str]) -> tuple:
            codes, blank, duplicate, truncated = examined(roles, texts)
            weight = known.get(codes)
            if weight is None:
                weight = cheapest([(c, 1) for c in codes])
                if len(codes) <= KNOWN_LENGTH and len(known) < KNOWN:
                    known[codes] = weight
            editor = Editor(weight[1])
            for role, text in zip(roles, texts, strict=True):
                editor.row(role, text)
            given = [t for t in turns if t is not None]
            gaps = max(given) - min(given) + 1 - len(set(given)) if given else 0
            illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))
            return gaps, blank, duplicate, truncated, illegal, *weight, editor.digest()

        conv, begun = None, False
        held: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            ids, out = [], []
            for c, turn, role, text, present in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if not begun or c != conv:
                    if begun:
                        ids.append(conv)
                        out.append(repaired(*held))
                    conv, begun, held = c, True, ([], [], [])
                if present:
                    held[0].append(turn)
                    held[1].append(role)
                    held[2].append(text)
            if out:
                yield _batch(ids, out, batch.schema.field(0).type)
        if begun:
            yield _batch([conv], [repaired(*held)], batch.schema.field(0).type)
        release_memory()

    ordered = rows.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "text")
    return ordered.select("conv", "turn", "role", "text", "present").mapInArrow(run, f"conv {kind}, {RESULT}")


def _batch(ids: list, out: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = [pa.string() if name in ("audit", "repaired_sha256") else pa.int64() for name in COLUMNS]
    arrays = [pa.array(column, t) for column, t in zip(zip(*out, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(ids, kind), *arrays], names=["conv", *COLUMNS])


_TABLE = "array<struct<entry:int,exit:int,cost:bigint,audit:string>>"


def _stretches(grouped: DataFrame, kind: str, leaves: bool) -> DataFrame:
    """One row per (conv, key): first and last initial, illegal pairs, and transfers of the members in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                members = batch.column(2)[i].as_py()
                if leaves:
                    rows, firsts, lasts, illegal = [], [], [], 0
                    for m in members:
                        firsts.append(m["initial"])
                        lasts.append(m["initial"])
                        illegal += m["repeats"] - 1
                        head = m["repeats"] if m["code"] == "d" else 1
                        rows.append((m["code"], head))
                        if head < m["repeats"]:
                            rows.append(("d", m["repeats"] - head))
                    table = transfers(rows)
                else:
                    firsts, lasts, illegal = [m["first"] for m in members], [m["last"] for m in members], sum(m["illegal"] for m in members)
                    table = joined([{(t["entry"], t["exit"]): (t["cost"], t["audit"]) for t in m["transfers"]} for m in members])
                illegal += sum(a + b not in LEGAL for a, b in zip(lasts, firsts[1:]))
                listed = [{"entry": q, "exit": r, "cost": c, "audit": a} for (q, r), (c, a) in table.items()]
                shape = pa.list_(pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([firsts[0]]), pa.array([lasts[-1]]), pa.array([illegal], pa.int64()), pa.array([listed], shape)],
                    names=["conv", "key", "first", "last", "illegal", "transfers"],
                )

    return grouped.select("conv", "key", "members").mapInArrow(run, f"conv {kind}, key bigint, first string, last string, illegal bigint, transfers {_TABLE}")


def _spread(rows: DataFrame, kind: str) -> DataFrame:
    """Results of long conversations, whose rows are never gathered."""
    # Repeated rows become one with a count, wherever they lie.
    single = rows.where("present").groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("repeats"))
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role")]
    # Bounds of the ranges are values of the keys, so of the text only its beginning serves as one; it sorts as the text does.
    laid = single.repartitionByRange(*order, F.substring("text", 1, 64)).sortWithinPartitions(*order, "text")
    number = F.monotonically_increasing_id()
    laid = materialize(laid.withColumns({"run": F.shiftright(number, 33), "nth": number.bitwiseAND((1 << 33) - 1)}))
    most = laid.agg(F.max("nth"), F.max("run")).first()
    if most[0] is None:
        return rows.sparkSession.createDataFrame([], f"conv {kind}, {RESULT}")
    wide = SPAN
    while wide <= most[0]:
        wide *= SPAN
    laid = laid.withColumn("place", F.col("run") * wide + F.col("nth")).drop("run", "nth")
    levels, reach = 1, SPAN
    while reach <= most[1] * wide + most[0]:
        levels, reach = levels + 1, reach * SPAN
    ends = F.rtrim(F.translate("text", BLANKS, " " * len(BLANKS)))
    firsts = laid.groupBy("conv", "role", F.sha2("text", 256).alias("digest")).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("new"))
    coded = laid.select("conv", "turn", "place", "repeats", F.substring("role", 1, 1).alias("initial"), (ends == "").alias("blank"), (~F.substring(ends, -1, 1).isin(".", "!", "?")).alias("open"))
    coded = coded.join(firsts, "place", "left")
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    coded = materialize(coded.withColumn("code", F.when(F.col("blank") | F.col("new").isNull(), "d").when(F.col("open"), F.upper(known)).otherwise(known)))

    counted = coded.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("repeats")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).when(F.col("new").isNull(), F.col("repeats")).otherwise(F.col("repeats") - 1)).alias("duplicate"),
        F.sum(F.when(~F.col("blank") & F.col("new").isNotNull() & F.col("open"), 1).otherwise(0)).alias("truncated"),
    )
    turns = coded.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count("turn").alias("n"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n"), F.lit(0)).cast("bigint")

    def grouped(frame: DataFrame, place: Column, *fields: str) -> DataFrame:
        member = F.struct(place.alias("place"), *fields)
        return frame.groupBy("conv", F.floor(place / SPAN).alias("key")).agg(F.array_sort(F.collect_list(member)).alias("members"))

    nodes = _stretches(grouped(coded, F.col("place"), "initial", "code", "repeats"), kind, leaves=True)
    for _ in range(levels - 1):
        nodes = _stretches(grouped(nodes, F.col("key"), "first", "last", "illegal", "transfers"), kind, leaves=False)
    ways = F.filter("transfers", lambda t: (t["entry"] == START) & t["exit"].isin(*FINAL))
    # The lesser struct is the cheaper repair, or the ASCII-least of equally cheap ones.
    best = F.array_min(F.transform(ways, lambda t: F.struct(t["cost"], t["audit"])))
    derived = materialize(nodes.select("conv", "illegal", best.alias("best")))

    heads = derived.select("conv", F.lit(-1).cast("bigint").alias("place"), F.lit("").alias("role"), F.col("best.audit").alias("text"), F.lit(0).cast("bigint").alias("repeats"))
    lines = heads.unionByName(laid.select("conv", "place", "role", "text", "repeats")).repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), "place")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, editor = None, None
        for batch in batches:
            for c, place, role, text, repeats in zip(*[column.to_pylist() for column in batch.columns], strict=True):
                if place < 0:
                    if editor is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.field(0).type), pa.array([editor.digest()])], names=["conv", "repaired_sha256"])
                    conv, editor = c, Editor(text)
                else:
                    editor.row(role, text, repeats)
        if editor is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], batch.schema.field(0).type), pa.array([editor.digest()])], names=["conv", "repaired_sha256"])

    digests = lines.select("conv", "place", "role", "text", "repeats").mapInArrow(hashed, f"conv {kind}, repaired_sha256 string")
    out = derived
    for other in (counted, turns, digests):
        named = other.withColumnRenamed("conv", "_conv")
        out = out.join(named, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv")
    return out.select("conv", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"), "repaired_sha256")


def repair(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None,
    rows_at_once: int = ROWS_AT_ONCE, bytes_at_once: int = BYTES_AT_ONCE,
) -> DataFrame:
    """One row per conversation: its faults, the lightest repair, and the digest of the repaired text.

    Rows whose column `present` is false only keep their conversation in the result.
    """
    kind = turns.schema[conv].dataType.simpleString()
    space = F.lit(" ")
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"), F.coalesce(F.col(f"`{role}`"), space).alias("role"),
        F.coalesce(F.col(f"`{text}`"), space).alias("text"), (F.coalesce(F.col(f"`{present}`"), F.lit(False)) if present else F.lit(True)).alias("present"),
    )
    small_batches(turns.sparkSession)
    held = F.sum(F.octet_length("text") + F.octet_length("role"))
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"), held.alias("bytes"))
    long = materialize(sizes.where((F.col("n") > rows_at_once) | (F.col("bytes") > bytes_at_once)).select(F.col("conv").alias("_conv")))
    if long.isEmpty():
        return _gathered(rows, kind).withColumnRenamed("conv", conv)
    same = F.col("conv").eqNullSafe(F.col("_conv"))
    few = _gathered(rows.join(long, same, "left_anti"), kind)
    many = _spread(rows.join(long, same, "left_semi"), kind)
    # A long conversation of which no row is left.
    found = many.withColumnRenamed("conv", "conv_")
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    many = long.join(found, F.col("_conv").eqNullSafe(F.col("conv_")), "left").select(
        F.col("_conv").alias("conv"), *[F.coalesce(c, F.lit(none[c]) if c in none else F.lit(0).cast("bigint")).alias(c) for c in COLUMNS]
    )
    return few.unionByName(many).withColumnRenamed("conv", conv)


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults planted by the checksum of `conv:turn`; a dropped row stays with `present` false."""
    space = F.lit(" ")
    shown = F.concat_ws(":", F.coalesce(F.col(conv).cast("string"), space), F.coalesce(F.col(turn).cast("string"), space))
    kind = F.pmod(F.crc32(F.encode(shown, "utf-8")), F.lit(20))
    told, said = F.coalesce(F.col(role), space), F.coalesce(F.col(text), space)
    rows = turns.select(
        F.col(conv), F.col(turn), F.when(kind == 4, "user").otherwise(told).alias(role),
        F.when(kind <= 1, "").when(kind == 2, F.translate(said, ".!?", "")).otherwise(said).alias(text),
        (kind != 0).alias("present"), F.when(kind == 3, 2).otherwise(1).alias("_copies"),
    )
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copy", "_copies")
