"""Merkle manifest of a dataset by nested-struct rollup.

Rows become leaves; the leaves of each group ascend by their order, and while
more than one node remains, every `WIDTH` consecutive ones become the hash of
their digests. What remains is the group's subroot, and the subroots, ordered by
group, give the root in the same way.

A node's rank is cut into digits to the base `WIDTH`. In blocks of `WIDTH` ** `DIGITS`
nodes the digit columns are grouped away one after the other, the lowest first:
each grouping nests the structs of its children and adds their hash. The rows of
a block are dealt to one task once, and no grouping within needs a shuffle or
holds more than a block. The hashes of the blocks are the nodes of the next level
of blocks, and so on up to the root. On the way down, what lies above a block
(subroot, root and the steps between) is one more row of the block's first
grouping, and rides up its nesting; a transform over the nested structs then puts
down every node's steps, and an explode gives the rows: no join with the leaves.

A proof is the list of a leaf's steps to the root, each with the digests left and
right of it. Ranks come from a range-partitioned layout and one count for each
group and range, so a group may hold all rows.

Defined results: null fields, groups and keys are values of their own and come
first; equal keys stand in the order of their leaves; repeated rows are leaves of
their own; very long texts are hashed whole; an empty table gives no rows; only
the named columns travel, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stormgrid.llm.common import let
from stormgrid.session import materialize

WIDTH, DIGITS = 8, 3
SPAN = WIDTH**DIGITS
_STEPS = "array<struct<left:string,right:string>>"


def sha256(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """`-` for null, else byte count, colon, value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf(*values: Column) -> Column:
    return sha256(F.concat(*map(field, values)))


def _ranked(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with `rank` from 0 within their group and the group's `total`; and the largest total.

    The layout and the counts of its ranges are stored, so ranks do not change when tasks run again.
    """
    keys = [F.asc_nulls_first(c) for c in [group, *order]]
    number = F.monotonically_increasing_id()
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    laid = materialize(laid.withColumns({"run": F.shiftright(number, 33), "nth": number.bitwiseAND((1 << 33) - 1)}))
    pieces = laid.groupBy("run", F.col(group).alias("_group")).agg(F.min("nth").alias("first"), F.count("*").alias("n"))
    all_of = Window.partitionBy("_group")
    before = F.sum("n").over(all_of.orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    pieces = materialize(pieces.select(F.col("run").alias("_run"), "_group", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(all_of).alias("total")))
    most = pieces.agg(F.max("total")).first()[0] or 0
    placed = laid.join(pieces, (F.col("run") == F.col("_run")) & F.col(group).eqNullSafe(F.col("_group")))
    return placed.withColumn("rank", F.col("nth") + F.col("shift")).drop("run", "nth", "_run", "_group", "shift"), most


def _nested(nodes: DataFrame, payload: list[str], above: DataFrame | None = None) -> DataFrame:
    """One row per block: grp, total, block, its digest, nested `kids`, and what `above` has for the block."""
    digits = [F.floor(F.col("rank") / WIDTH**k) % WIDTH for k in range(DIGITS)]
    rows = nodes.select(
        "grp", "total", F.floor(F.col("rank") / SPAN).alias("block"), *[d.cast("int").alias(f"d{k}") for k, d in enumerate(digits)], "digest", *payload
    )
    if above is None:
        rows = rows.withColumn("above", F.lit(None).cast("int"))
    else:
        # `total` is a function of the group; the riders of a group carry it along.
        rows = rows.unionByName(above.select("grp", F.col("below").alias("total"), F.col("rank").alias("block"), "above"), allowMissingColumns=True)
    rows = rows.repartition("grp", "total", "block")
    kids = F.struct(F.col("d0").alias("d"), "digest", *payload)
    for k in range(DIGITS):
        grouped = rows.groupBy("grp", "total", "block", *[f"d{i}" for i in range(k + 1, DIGITS)]).agg(
            F.array_sort(F.collect_list(F.when(F.col(f"d{k}").isNotNull(), kids))).alias("kids"), F.first("above", ignorenulls=True).alias("above")
        )
        hashed = F.when(F.col("total") > WIDTH**k, sha256(F.array_join("kids.digest", ""))).otherwise(F.get("kids", F.lit(0))["digest"])
        rows = grouped.withColumn("digest", hashed)
        kids = F.struct(F.col(f"d{k + 1}").alias("d"), "digest", "kids")
    return rows


def _climb(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Levels of blocks over (grp, total, rank, digest): the last has one node for each group."""
    levels = [nodes]
    while len(levels) == 1 or most > 1:
        below = _nested(levels[-1], [])
        levels.append(materialize(below.select("grp", "total", F.col("block").alias("rank"), "digest").withColumns({"below": F.col("total"), "total": F.ceil(F.col("total") / SPAN)})))
        most = -(-most // SPAN)
    return levels


def _descend(nodes: DataFrame, payload: list[str], above: DataFrame) -> DataFrame:
    """Every node of the level with its steps to the root: grp, payload, digest, above (steps, subroot, root)."""
    blocks = _nested(nodes, payload, above)

    def step(k: int, kids: Column, child: Column) -> Column:
        place = child["d"]
        sides = F.struct(
            F.array_join(F.slice(kids["digest"], 1, place), "").alias("left"), F.array_join(F.slice(kids["digest"], place + 2, WIDTH), "").alias("right")
        )
        return F.when(F.col("total") > WIDTH**k, F.array(sides)).otherwise(F.array().cast(_STEPS))

    def unfold(k: int, kids: Column, steps: Column) -> Column:
        def child(c: Column) -> Column:
            own = F.concat(step(k, kids, c), steps)
            if k == 0:
                return F.struct(c["digest"].alias("digest"), *[c[p].alias(p) for p in payload], own.alias("steps"))
            return let(own, lambda s: unfold(k - 1, c["kids"], s))

        inner = F.transform(kids, child)
        return inner if k == 0 else F.flatten(inner)

    each = F.explode(unfold(DIGITS - 1, F.col("kids"), F.col("above.steps"))).alias("node")
    out = blocks.select("grp", "total", F.col("above.subroot").alias("subroot"), F.col("above.root").alias("root"), each)
    up = F.struct(F.col("node.steps").alias("steps"), "subroot", "root").alias("above")
    return out.select("grp", "total", F.col("node.digest").alias("digest"), *[F.col(f"node.{p}").alias(p) for p in payload], up)


def _proved(levels: list[DataFrame], above: DataFrame, payload: list[str]) -> DataFrame:
    """Goes down from `above` (grp, rank 0, below, above) to the lowest level, whose payload is given."""
    for i in range(len(levels) - 2, -1, -1):
        upper = i > 0
        found = _descend(levels[i], ["rank", "below"] if upper else payload, above)
        above = materialize(found.select("grp", "rank", "below", "above")) if upper else found
    return above


def manifest(leaves: DataFrame, group: str, key: str, digest: str = "leaf", carried: tuple[str, ...] = ()) -> DataFrame:
    """Columns group, key, digest, the carried ones, subroot, root and steps of every leaf."""
    payload = ["key", *[f"c{i}" for i in range(len(carried))]]
    rows = leaves.select(
        F.col(f"`{group}`").alias("grp"), F.col(f"`{key}`").alias("key"), F.col(f"`{digest}`").alias("digest"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)]
    )
    # Repeated rows fall on several ranges by a number of their own, which storing them keeps.
    stored = materialize(rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id())))
    nodes, most = _ranked(stored, "grp", ["key", "digest", "tie"])
    levels = _climb(nodes, most)
    # The subroots are the nodes of one more tree, whose steps every group's top block is given.
    tops, groups = _ranked(levels[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "digest", F.col("below").alias("size")), "grp", ["name"])
    upper = _climb(tops, groups)
    none = F.array().cast(_STEPS)
    root = upper[-1].select("grp", "rank", "below", F.struct(none.alias("steps"), F.lit("").alias("subroot"), F.col("digest").alias("root")).alias("above"))
    proved = _proved(upper, root, ["name", "size"])
    above = materialize(proved.select(
        F.col("name").alias("grp"), F.lit(0).cast("bigint").alias("rank"), F.col("size").alias("below"),
        F.struct("above.steps", F.col("digest").alias("subroot"), "above.root").alias("above"),
    ))
    found = _proved(levels, above, payload)
    return found.select(
        F.col("grp").alias(group), F.col("key").alias(key), F.col("digest").alias(digest), *[F.col(f"c{i}").alias(c) for i, c in enumerate(carried)],
        "above.subroot", "above.root", "above.steps",
    )


def fold(steps: Column, start: Column) -> Column:
    """The root that a leaf and the digests beside its way up give."""
    return F.aggregate(steps, start, lambda h, s: sha256(F.concat(s["left"], h, s["right"])))


def proof_digest(steps: Column) -> Column:
    """Hash of all siblings, level by level, left to right."""
    return sha256(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""))
