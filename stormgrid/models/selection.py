"""Regressions that choose their terms from one cross-product aggregate.

The rows are read once, into the cross products of all candidate terms and the
label; every step of a search then works on that matrix by the sweep operator,
which brings a term into the regression or takes it out again.

`stepwise` adds and drops inputs while the information criterion falls. `splines`
adds hinge pairs max(0, x - k), max(0, k - x) while they explain more, then drops
terms and keeps the set with the least generalised cross-validation. Between two
knots every hinge is a straight line, so the cross products of all hinges follow
from sums by interval, and rows travel with their inputs, not with their hinges.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stormgrid.models import moments

#: A term whose own share of variation (beside the terms chosen) is less cannot be told from them.
INDEPENDENT = 1e-9
#: Unexplained share of variation that counts as none: sums in double precision say no more.
EXACT = 1e-12
MARKS = tuple(i / 20 for i in range(20))


@dataclass(frozen=True)
class Term:
    """An input (knot None) or a hinge of it: above (side 1) or below (side -1) the knot."""

    name: str
    knot: float | None = None
    side: int = 1

    def column(self) -> Column:
        x = F.nanvl(F.col(self.name).cast("double"), F.lit(None))
        if self.knot is None:
            return x
        distance = (x - self.knot) * self.side
        return F.when(distance > 0, distance).when(distance <= 0, 0.0)


@dataclass(frozen=True)
class Chosen:
    """Terms with their coefficients, and the inverse of the label's transformation."""

    terms: list[Term]
    coefficients: list[float]
    intercept: float
    inverse: str

    def predict(self, df: DataFrame, output: str) -> DataFrame:
        """Every row with its forecast, null where a chosen input is missing."""
        value = F.lit(self.intercept)
        for term, weight in zip(self.terms, self.coefficients, strict=True):
            value = value + term.column() * F.lit(weight)
        shaped = F.exp(value) if self.inverse == "exp" else F.pow(value, F.lit(3.0)) if self.inverse == "cube" else value
        return df.withColumn(output, shaped)


class Sweeps:
    """Cross products in correlation form, with some terms swept in; the label is the last row."""

    def __init__(self, centred: np.ndarray) -> None:
        self.scale = np.sqrt(np.maximum(np.diag(centred), 0.0))
        self.scale[self.scale == 0] = 1.0
        self.a = centred / np.outer(self.scale, self.scale)
        self.inside: set[int] = set()

    def sweep(self, k: int) -> None:
        """Brings term k in, or takes it out."""
        a = self.a
        pivot, row = a[k, k], a[k] / a[k, k]
        column = a[:, k].copy()
        a -= np.outer(column, row)
        a[k] = row
        a[:, k] = -column / pivot
        a[k, k] = 1 / pivot
        self.inside ^= {k}

    @property
    def rest(self) -> float:
        """The share of the label's variation that is unexplained."""
        return max(float(self.a[-1, -1]), EXACT)

    def change(self, k: int) -> float | None:
        """How much `rest` falls by bringing k in, or rises by taking it out (None if k depends on the terms inside)."""
        if k not in self.inside and self.a[k, k] < INDEPENDENT:
            return None
        return float(self.a[k, -1] ** 2 / self.a[k, k]) if k in self.inside else float(self.a[k, -1] * self.a[-1, k] / self.a[k, k])

    def coefficients(self) -> dict[int, float]:
        return {k: float(self.a[k, -1] * self.scale[-1] / self.scale[k]) for k in sorted(self.inside)}


def aic(n: int, rest: float, terms: int) -> float:
    """Akaike's criterion; a regression without a degree of freedom left explains nothing."""
    return float("inf") if n - terms < 2 else n * float(np.log(rest)) + 2 * (terms + 1)


def search(centred: np.ndarray, n: int) -> Sweeps:
    """Adds or drops one term at a time, whichever lowers the criterion most, from no term and from all; the better end."""
    ends = []
    for full in (False, True):
        state = Sweeps(centred)
        if full:
            for k in range(len(centred) - 1):
                if state.change(k) is not None:
                    state.sweep(k)
        now = aic(n, state.rest, len(state.inside))
        while True:
            steps = []
            for k in range(len(centred) - 1):
                moved = state.change(k)
                if moved is not None:
                    rest = max(state.rest + (moved if k in state.inside else -moved), EXACT)
                    steps.append((aic(n, rest, len(state.inside) + (-1 if k in state.inside else 1)), k))
            if not steps or min(steps)[0] >= now - 1e-9:
                break
            now, k = min(steps)
            state.sweep(k)
        ends.append((round(now, 9), len(state.inside), sorted(state.inside), state))
    return min(ends, key=lambda e: e[:3])[3]


def _total(df: DataFrame, terms: list[Term], label: Column) -> moments.Total:
    columns = {f"{i}": term.column() for i, term in enumerate(terms)} | {"label": label}
    return moments.total(moments.moments(df, columns), list(columns))


def hinge_total(df: DataFrame, terms: list[Term], label: Column) -> moments.Total:
    """What `_total` gives for hinges, from sums over the intervals between knots.

    A row adds its distance u from the knot below it (the lowest knot below all) to
    tables by interval: number, u, u squared, and with the label for each input;
    number, u of either and their product for each pair of inputs.
    """
    inputs = list(dict.fromkeys(term.name for term in terms))
    marks = [np.array(sorted({t.knot for t in terms if t.name == name})) for name in inputs]
    anchors = [np.concatenate([m[:1], m]) for m in marks]
    sizes, pairs = [len(c) for c in anchors], [(i, j) for i in range(len(inputs)) for j in range(i)]
    values = F.array(*[F.col(name).cast("double") for name in inputs], label.cast("double"))
    rows = df.select(values.alias("values")).where(~F.exists("values", lambda v: v.isNull() | F.isnan(v)))
    schema = moments._schema(T.IntegerType())
    width = len(inputs) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, 0.0
        for batch in batches:
            matrix = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            if not len(matrix):
                continue
            y = matrix[:, -1]
            bins = [np.searchsorted(m, matrix[:, i], side="right") for i, m in enumerate(marks)]
            us = [matrix[:, i] - anchors[i][b] for i, b in enumerate(bins)]
            found = [np.array([y.sum(), y @ y])]
            for b, u, size in zip(bins, us, sizes, strict=True):
                found += [np.bincount(b, w, size) for w in (None, u, u * u, y, u * y)]
            for i, j in pairs:
                found += [np.bincount(bins[i] * sizes[j] + bins[j], w, sizes[i] * sizes[j]) for w in (None, us[i], us[j], us[i] * us[j])]
            n, sums = n + len(matrix), sums + np.concatenate(found)
        if n:
            doubles = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([n], pa.int64()), pa.array([[]], doubles), pa.array([sums.tolist()], doubles)], names=["part", "n", "sums", "products"])

    row = moments.merged(rows.mapInArrow(run, schema)).first()
    names = [*(f"{i}" for i in range(len(terms))), "label"]
    sums, products = np.zeros(len(names)), np.zeros((len(names), len(names)))
    if row is None:
        return moments.Total(names, 0, sums, products)
    flat, at = np.array(row.products), 2
    sums[-1], products[-1, -1] = flat[:2]

    def taken(*shape: int) -> np.ndarray:
        nonlocal at
        at += int(np.prod(shape))
        return flat[at - int(np.prod(shape)) : at].reshape(shape)

    # A hinge in each interval of its input: its value at u = 0, and its slope.
    own, lines = [], []
    for i, name in enumerate(inputs):
        mine = [k for k, t in enumerate(terms) if t.name == name]
        level, slope = np.zeros((len(mine), sizes[i])), np.zeros((len(mine), sizes[i]))
        for at_, k in enumerate(mine):
            place = int(np.searchsorted(marks[i], terms[k].knot))
            inside = slice(place + 1, None) if terms[k].side > 0 else slice(None, place + 1)
            level[at_, inside], slope[at_, inside] = (anchors[i][inside] - terms[k].knot) * terms[k].side, terms[k].side
        own.append(mine)
        lines.append((level, slope))
    for mine, (level, slope), size in zip(own, lines, sizes, strict=True):
        count, u, uu, y, uy = (taken(size) for _ in range(5))
        sums[mine] = level @ count + slope @ u
        products[np.ix_(mine, mine)] = (level * count) @ level.T + (level * u) @ slope.T + (slope * u) @ level.T + (slope * uu) @ slope.T
        products[mine, -1] = products[-1, mine] = level @ y + slope @ uy
    for i, j in pairs:
        count, ui, uj, both = (taken(sizes[i], sizes[j]) for _ in range(4))
        block = lines[i][0] @ (count @ lines[j][0].T + uj @ lines[j][1].T) + lines[i][1] @ (ui @ lines[j][0].T + both @ lines[j][1].T)
        products[np.ix_(own[i], own[j])], products[np.ix_(own[j], own[i])] = block, block.T
    return moments.Total(names, row.n, sums, products)


def _result(total: moments.Total, terms: list[Term], state: Sweeps, inverse: str) -> Chosen:
    found = state.coefficients()
    intercept = total.means[-1] - sum(weight * total.means[k] for k, weight in found.items())
    return Chosen([terms[k] for k in found], list(found.values()), float(intercept), inverse)


def stepwise(df: DataFrame, inputs: list[str], label: Column, inverse: str = "") -> Chosen:
    """Linear regression on the inputs that the information criterion keeps."""
    terms = [Term(name) for name in inputs]
    total = _total(df, terms, label)
    if total.n == 0:
        raise ValueError("no row has all inputs and a label")
    return _result(total, terms, search(total.centred, total.n), inverse)


def gcv(n: int, rest: float, terms: int, penalty: float) -> float:
    """Unexplained share over the squared share of freedom left; each hinge costs half a `penalty` for its knot."""
    spent = (terms + 1 + penalty * terms / 2) / n
    return rest / (1 - spent) ** 2 if spent < 1 else float("inf")


def grown(centred: np.ndarray, pairs: list[tuple[int, int]], most: int, least_gain: float) -> Sweeps:
    """Brings in the hinge pair that explains most, until `most` terms are in or none explains `least_gain` more."""
    state = Sweeps(centred)
    while len(state.inside) + 2 <= most:
        best = (least_gain, None)
        a = state.a
        for pair in pairs:
            open_ = [k for k in pair if k not in state.inside and a[k, k] >= INDEPENDENT]
            block = a[np.ix_(open_, open_)]
            if len(open_) == 2 and block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0] < INDEPENDENT * block[0, 0]:
                open_ = [max(open_, key=lambda k: a[k, -1] ** 2 / a[k, k])]
                block = a[np.ix_(open_, open_)]
            if open_:
                gain = float(a[open_, -1] @ np.linalg.solve(block, a[open_, -1]))
                if gain > best[0] + 1e-12:
                    best = (gain, open_)
        if best[1] is None or state.rest <= EXACT:
            break
        for k in best[1]:
            if state.change(k) is not None:
                state.sweep(k)
    return state


def pruned(centred: np.ndarray, n: int, inside: set[int], penalty: float) -> Sweeps:
    """Drops the term that explains least, one after the other; the set with the least cross-validation."""
    state = Sweeps(centred)
    for k in sorted(inside):
        state.sweep(k)
    best = (gcv(n, state.rest, len(state.inside), penalty), sorted(state.inside))
    while state.inside:
        k = min(sorted(state.inside), key=state.change)
        state.sweep(k)
        now = gcv(n, state.rest, len(state.inside), penalty)
        if now <= best[0]:
            best = (now, sorted(state.inside))
    out = Sweeps(centred)
    for k in best[1]:
        out.sweep(k)
    return out


def splines(
    df: DataFrame, inputs: list[str], label: Column, inverse: str = "", knots: dict[str, list[float]] | None = None, most: int = 21, least_gain: float = 0.001, penalty: float = 2.0,
) -> Chosen:
    """Additive regression splines; knots are given, or the lowest value and quantiles of each input."""
    if knots is None:
        marks = df.approxQuantile(inputs, list(MARKS), 0.001)
        knots = {name: sorted(set(values)) for name, values in zip(inputs, marks, strict=True)}
    terms = [Term(name, float(knot), side) for name in inputs for knot in knots[name] for side in (1, -1)]
    total = hinge_total(df, terms, label)
    if total.n == 0:
        raise ValueError("no row has all inputs and a label")
    centred = total.centred
    inside = grown(centred, [(i, i + 1) for i in range(0, len(terms), 2)], most, least_gain).inside
    return _result(total, terms, pruned(centred, total.n, inside, penalty), inverse)
