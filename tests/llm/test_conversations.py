import hashlib
import itertools
import random
import re
import zlib

import pytest

from stormgrid.llm import conversations

SMALL = "/root/testdata/sf0.001"
WELL_FORMED = re.compile(r"(s?(ua)+)?\Z").match
CUT = re.compile(r"[^\x20\x09-\x0D]")


def brute(rows):
    """Tries every edit script with few insertions: cost, audit and lines; rows are (role, text) in order."""
    seen, marks = set(), []
    for role, text in rows:
        found = CUT.findall(text)
        marks.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    slots = [[()] + [c for n in (1, 2) for c in itertools.product(("user", "assistant"), repeat=n)] for _ in range(len(rows) + 1)]
    choices = []
    for (role, text), mark in zip(rows, marks):
        extra = 5 if mark == "truncated" else 0
        ways = [(2, "D", None)]
        if mark not in ("blank", "duplicate"):
            ways += [(extra, "K", (role, text)), (1 + extra, "R", ("user", text)), (1 + extra, "R", ("assistant", text))]
        choices.append(ways)
    best = None
    for ways in itertools.product(*choices):
        for inserted in itertools.product(*slots):
            if sum(map(len, inserted)) > 2:
                continue
            cost, audit, lines = sum(w[0] for w in ways) + 5 * sum(map(len, inserted)), "", []
            for i in range(len(rows) + 1):
                audit += "I" * len(inserted[i])
                lines += [(r, "") for r in inserted[i]]
                if i < len(rows):
                    audit += ways[i][1]
                    lines += [ways[i][2]] if ways[i][2] else []
            if WELL_FORMED("".join(r[:1] or "x" for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return marks, best


def plain(rows):
    """Contract columns of rows (turn, role, text) of one conversation by dynamic programming, nothing shared with the operator's agenda."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, marks = set(), []
    for _, role, text in rows:
        found = CUT.findall(text)
        marks.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    want = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
    table = {"": (0, "", ())}

    def inserting(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                letter = want[state][-1]
                new = (cost + 5, audit + "I", (*lines, ("user" if letter == "u" else "assistant") + ":"))
                if letter not in table or new[:2] < table[letter][:2]:
                    table[letter] = new
        return table

    for (_, role, text), mark in zip(rows, marks):
        after = {}
        for state, (cost, audit, lines) in inserting(table).items():
            ways = [(2, "D", state, ())]
            extra = 5 if mark == "truncated" else 0
            if mark not in ("blank", "duplicate"):
                if role[:1] in want[state] and role:
                    ways.append((extra, "K", role[0], (f"{role}:{text}",)))
                letter = want[state][-1]
                ways.append((1 + extra, "R", letter, (("user" if letter == "u" else "assistant") + f":{text}",)))
            for c, edit, to, more in ways:
                new = (cost + c, audit + edit, lines + more)
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        table = after
    cost, audit, lines = min(v for k, v in inserting(table).items() if k in ("", "a"))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (gaps, *(marks.count(m) for m in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        conv_s, turn_s = (" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{conv_s}:{turn_s}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def test_agenda_against_every_script():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool", ""]), rng.choice(["One.", "two", "Three?", " ", ""])) for _ in range(rng.randint(0, 3))]
        marks, best = brute(rows)
        codes, *counts = conversations.examined([r for r, _ in rows], [t for _, t in rows])
        assert counts == [marks.count(m) for m in ("blank", "duplicate", "truncated")]
        weight = conversations.cheapest([(c, 1) for c in codes])
        assert weight == best[:2], rows
        editor = conversations.Editor(weight[1])
        for row in rows:
            editor.row(*row)
        assert editor.digest() == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in best[2]).encode()).hexdigest()


def test_stretches_join_to_the_whole():
    rng = random.Random(6)
    for _ in range(60):
        rows = [(rng.choice("suaxSUAXd"), 1) for _ in range(rng.randint(1, 30))]
        cut = sorted(rng.sample(range(len(rows) + 1), min(3, len(rows))))
        parts = [conversations.transfers(rows[a:b]) for a, b in zip([0, *cut], [*cut, len(rows)])]
        whole = conversations.joined(parts)
        assert min(whole[0, r] for r in conversations.FINAL if (0, r) in whole) == conversations.cheapest(rows)
        assert whole == conversations.transfers(rows)
    assert conversations.transfers([("d", 5), ("u", 1)]) == conversations.transfers([("d", 1)] * 5 + [("u", 1)])


def sample(seed=1, convs=12, most=40):
    rng = random.Random(seed)
    rows = []
    for c in [None, *range(convs)]:
        for t in range(rng.randint(1, most)):
            rows.append((c, rng.choice([t, t, t, None, 3]), rng.choice(["user", "assistant", "user", "assistant", "system", None, "", "tool"]),
                         rng.choice(["Yes.", "no", "Why?", "  ", "", None, "A. b", "x" * 3000 + f"{t}.", f"Text {t}!", "Ünï."])))
    return rows + rows[:5]


@pytest.mark.parametrize("limits", [{}, {"rows_at_once": 3}, {"bytes_at_once": 5000}, {"rows_at_once": 0}])
def test_equals_dynamic_programming(spark, limits):
    rows = sample()
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, cost int").repartition(5)
    out = conversations.repair(conversations.damage(frame), present="present", **limits)
    assert out.columns == ["conv_id", *conversations.COLUMNS]
    after = damaged(rows)
    want = {c: plain([r[1:] for r in after if r[0] == c]) for c in {r[0] for r in rows}}
    assert {r[0]: tuple(r[1:]) for r in out.collect()} == want


def test_conversation_longer_than_a_stretch(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"Text {t}.", "Same.", "", "cut"])) for t in range(9000)]
    rows += [(1, 40, "user", "Often.")] * 500 + [(2, 0, "user", "Hi.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    whole, split = (conversations.repair(frame, rows_at_once=n).orderBy("conv_id").collect() for n in (100_000, 1000))
    assert whole == split and [len(r.audit) >= n for r, n in zip(whole, (9500, 1))] == [True, True]


def test_dropped_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, present boolean"
    frame = spark.createDataFrame([(7, 0, "user", "x", False), (7, 1, "user", "y", None)], schema)
    empty = hashlib.sha256().hexdigest()
    for limit in (10, 0):
        assert [tuple(r) for r in conversations.repair(frame, present="present", rows_at_once=limit).collect()] == [(7, 0, 0, 0, 0, 0, 0, "", empty)]
        assert conversations.repair(frame.limit(0), rows_at_once=limit).collect() == []


def test_given_table(spark):
    from stormgrid.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = damaged(rows)
    want = {c: plain([r[1:] for r in after if r[0] == c]) for c in {r[0] for r in rows}}
    assert {r[0]: tuple(r[1:]) for r in QUERIES["op13_conversation_repair"](spark, SMALL).collect()} == want
