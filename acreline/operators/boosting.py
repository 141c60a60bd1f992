"""Gradient boosting of regression trees on binned features, with penalties: level by level or best leaf first.

Features are cut once into at most 255 bins (bin 0 holds missing values), a byte each. A tree needs only the row counts
and gradient sums per (leaf, feature, bin): each task adds up its rows, Spark adds up the tasks, and the split search
sees those sums alone. Of two siblings only the smaller one is counted; the other is the parent less it.

With squared loss the gradient of a row is prediction - label and its curvature 1. For a leaf with gradient sum G and n
rows, and T(G) = G moved towards 0 by ``l1``:

    leaf value  -T(G) / (n + l2)
    gain        (T(G_l)^2 / (n_l + l2) + T(G_r)^2 / (n_r + l2) - T(G)^2 / (n + l2)) / 2 - gamma, has to be positive

Ties go to the first feature, then to the lowest cut. ``leaves = 0`` grows level by level to ``depth``. Otherwise the open
leaf of largest gain is split next, until there are ``leaves``; the children of all leaves that can still be reached are
counted in one wave, so a tree costs about as many passes as it is deep, not one a leaf.

Gradients are rounded to fixed point, so sums are exact and a model does not depend on partitions, on their number, or
on the way rows are held. There are two ways: ``SparkRows`` keeps them in persisted blocks, one job a wave, for any
number of rows; ``HeldRows`` keeps at most ``HELD`` rows in one task, where a wave takes milliseconds.
"""

from __future__ import annotations

import heapq
import itertools
import json
import os
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import partial
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreline.errors import DataValidationError
from acreline.functions.expressions import is_unusable
from acreline.session import ensure_checkpoint_dir

#: Rows that a single task may hold; rows whose values the driver sorts for the bin cuts (of more they are counted by tasks).
HELD, CUT_ROWS = 1 << 18, 100_000
#: Values are counted by the first bits of their doubles, so many bits more a pass, until a place in the order is among so many rows.
FIRST_BITS, MORE_BITS, FEW = 12, 6, 256
#: Cells of sums in one wave, and looked through at a time.
CELLS = 1 << 23
#: Gradients are integers below 2^GRADIENT: a batch of 2^17 rows adds up exactly in a double.
GRADIENT = 34
BINS = 256
#: Rows of a partition of ``SparkRows`` at most (some 50 bytes each), and those a task adds up at a time.
PART_ROWS, BLOCK = 1 << 20, 1 << 16
#: First rows of a table are searched for in groups of so many times the rows wanted.
FAN = 4
#: Rounds after which the blocks of ``SparkRows`` are cut off by a checkpoint.
CHECKPOINT = 25
#: Bytes of a wave's sums that tasks may send to the driver as they are; more are added up by ranges of cells before.
DIRECT, RANGES = 1 << 25, 16


@dataclass(frozen=True)
class Boosting:
    """Settings. ``row_every``: rounds between two draws of rows, 0 for no draw; ``learn_rows``: 0 for all rows."""

    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    leaves: int = 0
    l1: float = 0.0
    l2: float = 1.0
    gamma: float = 0.0
    child_rows: int = 1
    row_share: float = 1.0
    row_every: int = 1
    column_share: float = 1.0
    bins: int = 255
    learn_rows: int = 0
    held_rows: int = HELD

    def __post_init__(self) -> None:
        if self.rounds < 1 or self.depth < 1 or self.child_rows < 1 or self.leaves < 0 or self.leaves == 1:
            raise ValueError("rounds, depth and child_rows start at 1, leaves at 2 (0: level by level)")
        if not 2 <= self.bins < BINS or not 0 < self.row_share <= 1 or not 0 < self.column_share <= 1:
            raise ValueError("bins are 2 to 255, shares above 0 and at most 1")
        if min(self.l1, self.l2, self.gamma, self.rate) < 0 or self.held_rows > HELD:
            raise ValueError(f"penalties and the rate are not negative, held_rows is {HELD} at most")


# --- bins ----------------------------------------------------------------------------------------


def bin_cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` cuts between distinct values, as many rows between two as the values allow."""
    values = np.sort(values[~np.isnan(values)])
    distinct = np.unique(values)
    if len(distinct) > bins:
        at = np.unique(values[_places(len(values), bins)])
        low = np.searchsorted(distinct, at[at < distinct[-1]])
    else:
        low = np.arange(max(0, len(distinct) - 1))
    return _between(distinct[low], distinct[low + 1])


def _places(rows: int, bins: int) -> np.ndarray:
    """Places in the order of all values after which a bin ends."""
    return (np.arange(1, bins) * rows) // bins - 1


def _between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        middle = a + (b - a) / 2
    return np.where((middle < b) & np.isfinite(middle), middle, a)


_SIGN, _NONE = np.uint64(1 << 63), np.uint64((1 << 64) - 1)


def _ordered(values: np.ndarray) -> np.ndarray:
    """Doubles, without missing ones, as unsigned integers in the same order."""
    raw = (values[~np.isnan(values)] + 0.0).view(np.uint64)  # one zero
    return np.where(raw & _SIGN, ~raw, raw | _SIGN)


def _doubles_of(ordered: np.ndarray) -> np.ndarray:
    return np.where(ordered & _SIGN, ordered & ~_SIGN, ~ordered).astype(np.uint64).view(np.float64)


def _columns(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    """Feature by row, many batches at once."""
    kept: list[np.ndarray] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None and batch.num_rows:
            kept.append(_lists(batch.column(0), width))
        if kept and (batch is None or sum(map(len, kept)) >= BLOCK):
            yield np.ascontiguousarray(np.concatenate(kept).T)
            kept = []


def _sums_table(slots: Sequence[int], n: Sequence[np.ndarray], g: Sequence[np.ndarray]) -> pa.RecordBatch:
    cells = [pa.array([x.tobytes() for x in some], pa.binary()) for some in (n, g)]
    return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), *cells], ["slot", "n", "g"])


def _first_bits(batches: Iterator[pa.RecordBatch], width: int, bins: int) -> Iterator[pa.RecordBatch]:
    """Of each feature: rows by the first bits, and the smallest distinct values, one more than there are bins."""
    n, least = np.zeros((width, 1 << FIRST_BITS), np.int64), [np.zeros(0, np.uint64)] * width
    for block in _columns(batches, width):
        for f in range(width):
            v = _ordered(block[f])
            n[f] += np.bincount((v >> np.uint64(64 - FIRST_BITS)).astype(np.int64), minlength=1 << FIRST_BITS)
            least[f] = np.unique(np.concatenate([least[f], np.unique(v)]))[: bins + 1]
    yield _sums_table(range(width), n, least)


def _first_bits_merged(parts: pa.Table, bins: int) -> pa.Table:
    n = sum(np.frombuffer(x.as_py(), np.int64) for x in parts.column(1))
    least = np.unique(np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in parts.column(2)]))[: bins + 1]
    return pa.Table.from_batches([_sums_table([parts.column(0)[0].as_py()], [n], [least])])


def _more_bits(batches: Iterator[pa.RecordBatch], width: int, open_: Mapping[int, np.ndarray], shift: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Rows of each open prefix by its next bits; ``shift`` bits stay below them."""
    n = {f: np.zeros(len(p) << bits, np.int64) for f, p in open_.items()}
    for block in _columns(batches, width):
        for f, prefixes in open_.items():
            v = _ordered(block[f]) >> np.uint64(shift)
            above = v >> np.uint64(bits)
            at = np.minimum(np.searchsorted(prefixes, above), len(prefixes) - 1)
            hit = prefixes[at] == above
            n[f] += np.bincount((at[hit] << bits) + (v[hit] & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=len(n[f]))
    yield _sums_table(list(n), list(n.values()), [np.zeros(0)] * len(n))


def _more_bits_merged(parts: pa.Table) -> pa.Table:
    n = sum(np.frombuffer(x.as_py(), np.int64) for x in parts.column(1))
    return pa.Table.from_batches([_sums_table([parts.column(0)[0].as_py()], [n], [np.zeros(0)])])


def _values_in(batches: Iterator[pa.RecordBatch], width: int, ranges: Mapping[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Of each feature: the distinct values in its ranges (first, last), their rows, and the least value above each range."""
    found = {f: (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.full(len(r[0]), _NONE)) for f, r in ranges.items()}
    for block in _columns(batches, width):
        for f, (first, last) in ranges.items():
            v, rows = np.unique(_ordered(block[f]), return_counts=True)
            end = np.searchsorted(last, v)
            inside = (end < len(last)) & (first[np.minimum(end, len(last) - 1)] <= v)
            above = np.append(v, _NONE)[np.searchsorted(v, last, "right")]
            found[f] = (*_added_up(np.concatenate([found[f][0], v[inside]]), np.concatenate([found[f][1], rows[inside]])), np.minimum(found[f][2], above))
    for f, (v, rows, above) in found.items():
        yield _sums_table([f, -1 - f], [v, above], [rows, above])


def _added_up(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(values, return_inverse=True)
    return distinct, np.bincount(at, rows, len(distinct)).astype(np.int64)


def all_cuts(x: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """``bin_cuts`` of every feature over all rows of ``x``, arrays of one length, without a column in one place.

    A cut lies between two values next to each other in the order of all rows. Tasks count values by the first bits of
    their doubles, in passes: each looks only at prefixes that hold a place wanted, with some bits more, until a prefix has
    few rows or a single value. Then the values of these prefixes are looked at.
    """

    def summed(count: Callable[..., Iterator[pa.RecordBatch]], merge: Callable[[pa.Table], pa.Table] | None) -> list[tuple[int, bytes, bytes]]:
        sums = x.mapInArrow(count, SUMS)
        found = (sums.groupBy("slot").applyInArrow(merge, SUMS) if merge else sums).toArrow()
        return list(zip(*(found[c].to_pylist() for c in ("slot", "n", "g"))))

    cuts: list[np.ndarray] = [np.zeros(0)] * width
    wanted: dict[int, dict[int, tuple[int, int]]] = {}  # of a feature: first value of a range, its last and the rows below
    want: dict[int, np.ndarray] = {}
    shift = 64 - FIRST_BITS
    open_: dict[int, np.ndarray] = {}
    below: dict[int, np.ndarray] = {}

    def look(f: int, prefixes: np.ndarray, rows: np.ndarray, under: np.ndarray) -> None:
        """Which of the prefixes, each with its rows and the rows below it, hold a place: few rows are a range, others stay open."""
        at = np.minimum(np.searchsorted(under + rows, want[f], "right"), len(rows) - 1)
        holding = np.unique(at[(under[at] <= want[f]) & (want[f] < under[at] + rows[at])])
        done = (rows[holding] <= FEW) | (shift == 0)
        for k in holding[done]:
            first = int(prefixes[k]) << shift
            wanted[f][first] = (first + (1 << shift) - 1, int(under[k]))
        stay = holding[~done]
        if len(stay):
            open_[f], below[f] = prefixes[stay], under[stay]

    def first_bits(parts: pa.Table) -> pa.Table:  # a partial has no types that Spark could read
        return _first_bits_merged(parts, bins)

    for f, n, least in summed(partial(_first_bits, width=width, bins=bins), first_bits):
        rows, distinct = np.frombuffer(n, np.int64), np.frombuffer(least, np.uint64)
        if len(distinct) <= bins:
            v = _doubles_of(distinct)
            cuts[f] = _between(v[:-1], v[1:])
            continue
        want[f], wanted[f] = _places(int(rows.sum()), bins), {}
        look(f, np.arange(len(rows), dtype=np.uint64), rows, np.cumsum(rows) - rows)
    while open_:
        bits = min(MORE_BITS, shift)
        shift -= bits
        now, under, open_, below = open_, below, {}, {}
        for f, n, _ in summed(partial(_more_bits, width=width, open_=now, shift=shift, bits=bits), _more_bits_merged):
            rows = np.frombuffer(n, np.int64).reshape(len(now[f]), -1)
            prefixes = (now[f][:, None] << np.uint64(bits)) + np.arange(1 << bits, dtype=np.uint64)
            look(f, prefixes.ravel(), rows.ravel(), (under[f][:, None] + np.cumsum(rows, axis=1) - rows).ravel())
    if want:
        firsts = {f: np.array(sorted(r), np.uint64) for f, r in wanted.items()}
        lasts = {f: np.array([wanted[f][k][0] for k in firsts[f].tolist()], np.uint64) for f in wanted}
        values: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {f: [] for f in want}
        above = {f: np.full(len(firsts[f]), _NONE) for f in want}
        for f, n, g in summed(partial(_values_in, width=width, ranges={f: (firsts[f], lasts[f]) for f in want}), None):
            if f < 0:
                above[-1 - f] = np.minimum(above[-1 - f], np.frombuffer(n, np.uint64))
            else:
                values[f].append((np.frombuffer(n, np.uint64), np.frombuffer(g, np.int64)))
        for f in want:
            v, rows = _added_up(*(np.concatenate(p) for p in zip(*values[f])))
            under = np.array([wanted[f][k][1] for k in firsts[f].tolist()])
            group = np.searchsorted(lasts[f], v)
            inside = np.cumsum(rows) - rows  # rows below a value: those below its range and those before it there
            begin = np.searchsorted(v, firsts[f])
            upto = under[group] + inside - inside[begin][group] + rows
            at = np.unique(np.searchsorted(upto, want[f], "right"))
            after = np.append(v[1:], _NONE)
            last_of_range = np.append(group[1:] != group[:-1], True)
            after = np.where(last_of_range, above[f][group], after)[at]
            some = after != _NONE
            cuts[f] = _between(_doubles_of(v[at][some]), _doubles_of(after[some]))
    return cuts


def binned(values: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Bytes of a matrix: 0 for a missing value, else 1 and the number of cuts below it."""
    out = np.empty(values.shape, np.uint8)
    for f, cut in enumerate(cuts):
        out[:, f] = np.where(np.isnan(values[:, f]), 0, 1 + np.searchsorted(cut, values[:, f], "left"))
    return out


#: Sums of tasks, of a node or of a feature.
SUMS = "slot int, n binary, g binary"


def _lists(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """Binary values of one length as a matrix, without a copy a row."""
    fixed = column.cast(pa.binary(width))
    flat = np.frombuffer(fixed.buffers()[1], np.uint8) if len(fixed) else np.zeros(0, np.uint8)
    return flat[fixed.offset * width : (fixed.offset + len(fixed)) * width].reshape(-1, width)


# --- a tree --------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as arrays; ``feature`` -1 is a leaf, others go left at ``bin`` or below."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    n: np.ndarray

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        at, rows = np.zeros(len(bins), np.int32), np.arange(len(bins))
        while len(rows):
            f = self.feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            node = at[rows]
            at[rows] = np.where(bins[rows, f] <= self.bin[node], self.left[node], self.right[node])
        return at


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


def best_splits(n: np.ndarray, g: np.ndarray, scale: float, s: Boosting) -> tuple[np.ndarray, ...]:
    """(gain, feature, bin, rows left, gradient left) of each node; ``n`` and ``g`` are (node, feature, bin).

    Only cells with rows are looked at: a cut after an empty bin equals that before it. ``g`` stays an integer until the
    gain, so that a sum does not depend on its order; every feature of a node adds up to the same totals, which are taken
    off the running sums (that 64 bits wrap around does no harm to a difference).
    """
    nodes, width, bins = n.shape
    cell = np.flatnonzero(n)
    node, inside = np.divmod(cell, width * bins)
    whole_n, whole_g = n[:, 0].sum(axis=1), g[:, 0].sum(axis=1)
    segment = np.minimum(cell // bins, nodes * width - 1)
    before_n, before_g = (np.cumsum(np.repeat(x, width)) - np.repeat(x, width) for x in (whole_n, whole_g))
    nl, gl = np.cumsum(n.reshape(-1)[cell]) - before_n[segment], np.cumsum(g.reshape(-1)[cell]) - before_g[segment]
    ok = (nl >= s.child_rows) & (whole_n[node] - nl >= s.child_rows)
    node, inside, nl, gl = node[ok], inside[ok], nl[ok], gl[ok]

    def part(grad: np.ndarray, rows: np.ndarray) -> np.ndarray:
        grad = grad / scale
        return (shrunk(grad, s.l1) if s.l1 else grad) ** 2 / (rows + s.l2)

    gain = np.full(nodes, -np.inf)
    best = np.zeros((4, nodes), np.int64)
    if len(node):
        found = (part(gl, nl) + part(whole_g[node] - gl, whole_n[node] - nl) - part(whole_g, whole_n)[node]) / 2 - s.gamma
        first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        gain[node[first]] = np.maximum.reduceat(found, first)
        top = np.flatnonzero(found == gain[node])
        top = top[np.concatenate(([True], node[top][1:] != node[top][:-1]))]  # the first feature, its lowest cut
        best[:, node[top]] = [*np.divmod(inside[top], bins), nl[top], gl[top]]
    return gain, *best


class Rows(Protocol):
    """Where the rows are held. ``start`` begins a round with the columns drawn for it and gives the sums of all its rows;
    ``expand`` sends the rows of split nodes on to their children and gives the sums of the nodes in ``wanted``;
    ``finish`` adds the tree's values. Sums are (node, drawn column, bin)."""

    scale: float
    ahead: int  # leaves that are worth counting in one wave before it is known that they are split

    def start(self, round_: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]: ...

    def expand(self, tree: Tree, nodes: list[int], wanted: list[int]) -> tuple[np.ndarray, np.ndarray]: ...

    def finish(self, value: np.ndarray) -> None: ...


class _Growing:
    """A tree while it grows. ``open[node]`` is the best split of a node that could be split."""

    def __init__(self, rows: Rows, s: Boosting, columns: np.ndarray, sums: tuple[np.ndarray, np.ndarray]) -> None:
        self.rows, self.s, self.columns = rows, s, columns
        self.links: list[list[int]] = [[-1, 0, 0, 0]]  # feature, bin, left, right: also of splits not taken in the end
        self.total = [(int(sums[0][0, 0].sum()), int(sums[1][0, 0].sum()))]
        self.depth, self.parent = [0], [-1]
        self.sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.open: dict[int, tuple] = {}
        self._look([0], *sums)

    def _look(self, nodes: list[int], n: np.ndarray, g: np.ndarray) -> None:
        """Best splits of ``nodes``, whose sums are the rows of ``n`` and ``g``."""
        step = max(1, CELLS // (n.shape[1] * n.shape[2]))
        for at in range(0, len(nodes), step):
            found = best_splits(n[at : at + step], g[at : at + step], self.rows.scale, self.s)
            for i, (gain, feature, cut, nl, gl) in enumerate(zip(*(x.tolist() for x in found)), at):
                if gain > 0:
                    self.open[nodes[i]] = (gain, int(self.columns[feature]), cut, nl, gl)
                    self.sums[nodes[i]] = (n[i], g[i])

    def links_as_tree(self) -> Tree:
        f, b, left, right = (np.array(x, np.int32) for x in zip(*self.links))
        return Tree(f, b, left, right, *[np.zeros(0)] * 3)

    def expand(self, nodes: list[int]) -> None:
        """Children of open nodes, with their own best splits where they may be split again."""
        small: list[int] = []
        for node in nodes:
            gain, feature, cut, nl, gl = self.open[node]
            n, g = self.total[node]
            left, right = len(self.links), len(self.links) + 1
            self.links[node] = [int(feature), int(cut), left, right]
            self.links += [[-1, 0, 0, 0], [-1, 0, 0, 0]]
            self.total += [(int(nl), int(gl)), (n - int(nl), g - int(gl))]
            self.depth += [self.depth[node] + 1] * 2
            self.parent += [node, node]
            if self.depth[left] < self.s.depth:
                small.append(left if nl <= n - nl else right)
        n, g = self.rows.expand(self.links_as_tree(), nodes, small)
        if small:
            above = [self.sums[self.parent[c]] for c in small]
            other = [sum(self.links[self.parent[c]][2:]) - c for c in small]
            n, g = (np.concatenate([x, np.stack([p[i] for p in above]) - x]) for i, x in ((0, n), (1, g)))
            both = [*small, *other]
            may = [i for i, node in enumerate(both) if self.total[node][0] >= 2 * self.s.child_rows]
            if may:
                self._look([both[i] for i in may], n[may], g[may])
        for node in nodes:
            self.sums.pop(node, None)

    def finished(self, taken: set[int]) -> tuple[Tree, np.ndarray]:
        """The tree of the splits in ``taken``, and the value of each node grown, taken or not."""
        s, number, order = self.s, {0: 0}, [0]
        g = np.array([t[1] for t in self.total], np.float64) / self.rows.scale
        n = np.array([t[0] for t in self.total], np.int64)
        own = -shrunk(g, s.l1) / np.maximum(n + s.l2, 1e-300) * s.rate  # a root of a round without rows has none
        value = own.copy()
        for node, (f, _, left, right) in enumerate(self.links):  # parents come before their children
            if f < 0:
                continue
            if node in taken:
                for c in (left, right):
                    number[c] = len(order)
                    order.append(c)
            else:
                value[left] = value[right] = value[node]
        at = lambda c: number[c] if c in number else 0
        kept = [self.links[k] if k in taken else [-1, 0, 0, 0] for k in order]
        gains = [self.open[k][0] if k in taken else 0.0 for k in order]
        left, right = ([at(x[i]) if x[0] >= 0 else 0 for x in kept] for i in (2, 3))
        arrays = [np.array(x, np.int32) for x in ([k[0] for k in kept], [k[1] for k in kept], left, right)]
        return Tree(*arrays, np.where(arrays[0] < 0, own[order], 0.0), np.array(gains), n[order]), value


def _reach(tree: _Growing, queue: list[tuple[float, int]], splits: int, most: int) -> list[int]:
    """Open nodes among the next ``splits`` by what is known so far, also below nodes whose own turn has not come: their
    children are counted in one wave, so that a tree takes about as many waves as it is deep."""
    found, seen = [], list(queue)
    while seen and splits and len(found) < most:
        _, node = heapq.heappop(seen)
        splits -= 1
        if tree.links[node][0] < 0:
            found.append(node)
        for child in tree.links[node][2:] if tree.links[node][0] >= 0 else ():
            if child in tree.open:
                heapq.heappush(seen, (-tree.open[child][0], child))
    return found


def grow(rows: Rows, s: Boosting, columns: np.ndarray, sums: tuple[np.ndarray, np.ndarray]) -> Tree:
    """One tree; its values are added to the rows' predictions."""
    tree = _Growing(rows, s, columns, sums)
    taken: set[int] = set()
    if not s.leaves:
        level = list(tree.open)
        while level:
            tree.expand(level)
            taken.update(level)
            level = [node for node in tree.open if node not in taken]
    else:
        queue = [(-split[0], node) for node, split in tree.open.items()]
        known = set(tree.open)
        while queue and len(taken) + 1 < s.leaves:
            node = queue[0][1]
            if tree.links[node][0] < 0:
                tree.expand(_reach(tree, queue, s.leaves - 1 - len(taken), rows.ahead))
            heapq.heappop(queue)
            taken.add(node)
            for child in tree.links[node][2:]:
                if child in tree.open and child not in known:
                    known.add(child)
                    heapq.heappush(queue, (-tree.open[child][0], child))
    done, value = tree.finished(taken)
    rows.finish(value)
    return done


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(key: np.ndarray, round_: int, s: Boosting, seed: int) -> np.ndarray:
    """Which rows take part in a round, by their key."""
    if s.row_share == 1 or not s.row_every:
        return np.ones(len(key), bool)
    draw = np.uint64((round_ // s.row_every + 1) * 0x9E3779B97F4A7C15 + seed & 0xFFFFFFFFFFFFFFFF)
    return (_mixed(_mixed(key.astype(np.int64).view(np.uint64)) + draw) >> np.uint64(11)).astype(np.float64) < s.row_share * 2.0**53


def gradients(prediction: np.ndarray, label: np.ndarray, scale: float) -> np.ndarray:
    most = float(2**GRADIENT - 1)
    return np.clip(np.rint((prediction - label) * scale), -most, most)


def cells_of(bins: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Number of each row's cell, for the drawn columns."""
    return bins[:, columns].astype(np.int64) + np.arange(len(columns)) * BINS


def added(flat: np.ndarray, slot: np.ndarray, g: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and gradient sums, (slot, column, bin), of rows whose cells are ``flat``, exactly."""
    width = flat.shape[1]
    cells = width * BINS
    n, total = np.zeros(slots * cells, np.int64), np.zeros(slots * cells, np.int64)
    for at in range(0, len(flat), 1 << 17):
        cell = (flat[at : at + (1 << 17)] + (slot[at : at + (1 << 17), None] * cells)).ravel()
        n += np.bincount(cell, minlength=len(n))
        total += np.bincount(cell, np.repeat(g[at : at + (1 << 17)], width), len(n)).astype(np.int64)
    return n.reshape(slots, width, BINS), total.reshape(slots, width, BINS)


class HeldRows:
    """All rows in memory."""

    ahead = 8

    def __init__(self, bins: np.ndarray, label: np.ndarray, key: np.ndarray, base: float, scale: float, s: Boosting, seed: int) -> None:
        self.bins, self.label, self.key, self.s, self.seed, self.scale = bins, label, key, s, seed, scale
        self.prediction = np.full(len(bins), base)

    def start(self, round_: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.node = np.zeros(len(self.bins), np.int32)
        self.kept = drawn(self.key, round_, self.s, self.seed)
        self.g = gradients(self.prediction, self.label, self.scale)
        self.flat = cells_of(self.bins, columns)
        return self._sums(np.flatnonzero(self.kept), np.zeros(1, np.int64))

    def _sums(self, rows: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return added(self.flat[rows], slot[self.node[rows]], self.g[rows], int(slot.max(initial=-1)) + 1)

    def expand(self, tree: Tree, nodes: list[int], wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        going = np.zeros(len(tree.feature), bool)
        going[nodes] = True
        rows = np.flatnonzero(going[self.node])
        at = self.node[rows]
        left = self.bins[rows, tree.feature[at]] <= tree.bin[at]
        self.node[rows] = np.where(left, tree.left[at], tree.right[at])
        slot = np.full(len(tree.feature), -1, np.int64)
        slot[wanted] = np.arange(len(wanted))
        return self._sums(rows[(slot[self.node[rows]] >= 0) & self.kept[rows]], slot)

    def finish(self, value: np.ndarray) -> None:
        self.prediction += value[self.node]


def _counted(batches: Iterator[pa.RecordBatch], tree: Tree, wanted: list[int], round_: int, scale: float, s: Boosting, seed: int, width: int, columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of a whole task: a row for each node that has rows there, its counts and gradient sums as bytes."""
    slot = np.full(len(tree.feature), -1, np.int64)
    slot[wanted] = np.arange(len(wanted))
    n, total = np.zeros((2, len(wanted), len(columns), BINS), np.int64)
    for bins, label, key, prediction in _blocks(batches, width):
        where = slot[tree.leaf_of(bins)]
        rows = np.flatnonzero((where >= 0) & drawn(key, round_, s, seed))
        found = added(cells_of(bins[rows], columns), where[rows], gradients(prediction[rows], label[rows], scale), len(wanted))
        n += found[0]
        total += found[1]
    some = np.flatnonzero(n[:, 0].sum(axis=1)).tolist()
    cells = [pa.array([x[i].tobytes() for i in some], pa.binary()) for x in (n, total)]
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *cells], ["slot", "n", "g"])


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(bins, label, key, prediction) of many batches at once: sums are as large as the nodes wanted, however few the rows."""
    kept: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None and batch.num_rows:
            kept.append(batch)
        if kept and (batch is None or sum(b.num_rows for b in kept) >= BLOCK):
            yield np.concatenate([_bytes(b.column(0), width) for b in kept]), *(np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in kept]) for i in (1, 2, 3))
            kept = []


def _moved(batches: Iterator[pa.RecordBatch], tree: Tree, value: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        new = batch.column(3).to_numpy(zero_copy_only=False) + value[tree.leaf_of(_bytes(batch.column(0), width))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(new)], batch.schema.names)


def _stored(batch: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def _loaded(blocks: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    for block in blocks:
        yield pa.ipc.open_stream(block).read_next_batch()


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in blocks, each of them one value."""
    for bins, label, key, prediction in _blocks(batches, width):
        cells = pa.Array.from_buffers(pa.binary(width), len(bins), [None, pa.py_buffer(np.ascontiguousarray(bins))])
        block = pa.RecordBatch.from_arrays([cells, pa.array(label), pa.array(key), pa.array(prediction)], ["bins", "label", "key", "prediction"])
        yield pa.RecordBatch.from_arrays([pa.array([_stored(block)], pa.binary())], ["block"])


def _sent(blocks: Iterator[bytes], count: Callable[..., Iterator[pa.RecordBatch]], cells: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Sums of a task as they travel: the numbers of the cells that have rows, their counts and gradient sums."""
    for sums in count(_loaded(blocks)):
        if sums.num_rows:
            n, g = (np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in sums.column(i)]) for i in (1, 2))
            some = np.flatnonzero(n)
            cell = sums.column(0).to_numpy()[some // cells] * cells + some % cells  # a wave has CELLS cells at most, a task fewer rows than 2^31
            yield cell.astype(np.int32), n[some].astype(np.int32), g[some]


def _by_range(sums: tuple[np.ndarray, ...], size: int) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    ends = np.searchsorted(sums[0], np.arange(0, int(sums[0][-1]) + size + 1, size))
    for k, (a, b) in enumerate(itertools.pairwise(ends)):
        if b > a:
            yield k, tuple(x[a:b] for x in sums)


def _together(parts: Iterator[tuple[int, tuple[np.ndarray, ...]]], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """The sums of a task's ranges over all tasks that sent some."""
    whole: dict[int, np.ndarray] = {}
    for k, (cell, n, g) in parts:
        both = whole.setdefault(k, np.zeros((2, size), np.int64))
        both[0, cell - k * size] += n
        both[1, cell - k * size] += g
    for k, (n, g) in whole.items():
        some = np.flatnonzero(n)
        yield (some + k * size).astype(np.int32), n[some], g[some]


def _shifted(blocks: Iterator[bytes], move: Callable[..., Iterator[pa.RecordBatch]]) -> Iterator[bytes]:
    return map(_stored, move(_loaded(blocks)))


class SparkRows:
    """Rows in persisted blocks: a job a wave. The values of a tree are added on the way to the sums of the next round.

    The blocks are an RDD and no table: every action on a table leaves its plan with the driver, which cached tables inside
    one another make longer round by round, and a tree takes a dozen actions.
    """

    ahead = 1 << 10

    def __init__(self, table: DataFrame, rows: int, width: int, base: float, scale: float, s: Boosting, seed: int) -> None:
        self.spark = table.sparkSession
        ensure_checkpoint_dir(self.spark)
        # every wave starts a task a partition, which sends its sums: as few as keep all cores busy and stay small
        self.parts = max(self.spark.sparkContext.defaultParallelism, -(-rows // PART_ROWS))
        self.state = table.coalesce(self.parts).withColumn("prediction", F.lit(base))
        cut = self.state.mapInArrow(partial(_cut, width=width), "block binary")
        self.blocks = cut.rdd.map(_first).persist(StorageLevel.MEMORY_AND_DISK)
        self.before: RDD | None = None
        self.file: str | None = None
        self.width, self.scale, self.s, self.seed = width, scale, s, seed

    def _sums(self, tree: Tree, wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        cells = len(self.columns) * BINS
        n, g = np.zeros((2, len(wanted) * cells), np.int64)
        step = max(1, CELLS // cells)
        for at in range(0, len(wanted), step):
            some = wanted[at : at + step]
            count = partial(_counted, tree=tree, wanted=some, round_=self.round, scale=self.scale, s=self.s, seed=self.seed, width=self.width, columns=self.columns)
            sums = self.blocks.mapPartitions(partial(_sent, count=count, cells=cells))
            if self.parts * len(some) * cells * 16 > DIRECT:
                size = -(-len(some) * cells // RANGES)
                dealt = sums.flatMap(partial(_by_range, size=size)).partitionBy(RANGES, int)
                sums = dealt.mapPartitions(partial(_together, size=size))
            for cell, rows, total in sums.collect():
                n[at * cells :][cell] += rows
                g[at * cells :][cell] += total
        return tuple(x.reshape(len(wanted), len(self.columns), BINS) for x in (n, g))

    def start(self, round_: int, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.round, self.columns, none = round_, columns, np.zeros(1, np.int32)
        self.tree = Tree(none - 1, none, none, none, *[np.zeros(1)] * 3)
        sums = self._sums(self.tree, [0])
        self._settle()
        return sums

    def _settle(self) -> None:
        """What the blocks were made from goes, now that they are kept."""
        if self.before is not None:
            self.before.unpersist()
            self.before = None
        file = self.blocks.getCheckpointFile()
        if file and file != self.file:
            self._remove()
            self.file = file

    def _remove(self) -> None:
        if self.file:
            sc = self.spark.sparkContext
            path = sc._jvm.org.apache.hadoop.fs.Path(self.file)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
            self.file = None

    def expand(self, tree: Tree, nodes: list[int], wanted: list[int]) -> tuple[np.ndarray, np.ndarray]:
        self.tree = tree
        return self._sums(tree, wanted)

    def finish(self, value: np.ndarray) -> None:
        if self.round + 1 == self.s.rounds:
            return
        move = partial(_moved, tree=self.tree, value=value, width=self.width)
        self.before = self.blocks
        self.blocks = self.before.mapPartitions(partial(_shifted, move=move)).persist(StorageLevel.MEMORY_AND_DISK)
        if (self.round + 1) % CHECKPOINT == 0:
            self.blocks.checkpoint()

    def release(self) -> None:
        for blocks in (self.before, self.blocks):
            if blocks is not None:
                blocks.unpersist()
        self._remove()


def _first(row: Sequence[Any]) -> Any:
    return row[0]


def boost(rows: Rows, width: int, s: Boosting, seed: int) -> Iterator[Tree]:
    """All rounds; ``seed`` draws the columns of each tree."""
    rng = np.random.default_rng(seed)
    for round_ in range(s.rounds):
        columns = np.sort(rng.permutation(width)[: max(1, int(s.column_share * width))])
        yield grow(rows, s, columns, rows.start(round_, columns))


# --- fitting -------------------------------------------------------------------------------------

NODES = "fit int, tree int, node int, feature int, bin int, left int, right int, value double, gain double, n long"


def _node_table(fit: int, trees: Iterator[Tree]) -> pa.Table:
    made = list(trees)
    size = np.array([len(t.feature) for t in made])
    columns: dict[str, Any] = {"fit": np.full(size.sum(), fit, np.int32), "tree": np.repeat(np.arange(len(made), dtype=np.int32), size)}
    columns["node"] = np.concatenate([np.arange(k, dtype=np.int32) for k in size])
    for name in ("feature", "bin", "left", "right", "value", "gain", "n"):
        columns[name] = np.concatenate([getattr(t, name) for t in made])
    return pa.table(columns)


def _fit_held(batches: Iterator[pa.RecordBatch], plans: Mapping[int, tuple[float, float, int]], s: Boosting, seed: int) -> Iterator[pa.RecordBatch]:
    """The trees of one fit, in one task, from its rows (fit, bins, label, key)."""
    found = [b for b in batches if b.num_rows]
    if not found:
        return
    fit = found[0].column(0)[0].as_py()
    base, scale, width = plans[fit]
    bins = np.concatenate([_bytes(b.column(1), width) for b in found])
    label, key = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in found]) for i in (2, 3))
    held = HeldRows(bins, label, key, base, scale, s, seed)
    yield from _node_table(fit, boost(held, width, s, seed)).to_batches()


def first_rows(rows: DataFrame, most: int, *order: str) -> DataFrame:
    """What ``orderBy(*order).limit(most)`` gives; the first column of ``order`` is a hash, a long.

    A plain limit brings ``most`` rows of every partition to one task. Here counts by the hash's first bits find the end of
    its range that holds the rows wanted. Where many rows share a hash the range stays large: its rows are dealt into
    groups that keep ``most`` rows each, until few groups are left. No task reads more than some FAN x ``most`` rows.
    """
    prefix = F.shiftright(rows[order[0]], 52)
    sizes = {r["p"]: r["n"] for r in rows.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    left, end = 0, None
    for p in sorted(sizes, key=lambda p: (p is not None, p or 0)):  # null comes first, as in the order
        left, end = left + sizes[p], p
        if left >= most:
            break
    if left < sum(sizes.values()):
        rows = rows.filter(prefix.isNull() if end is None else prefix.isNull() | (prefix <= end))
    while left > FAN * most:
        groups = -(-left // (FAN * most))
        place = F.row_number().over(Window.partitionBy("__group").orderBy(*order))
        dealt = rows.withColumn("__group", F.monotonically_increasing_id() % groups).withColumn("__place", place)
        rows, left = dealt.filter(F.col("__place") <= most).drop("__group", "__place"), groups * most
    return rows.orderBy(*order).limit(most)


@dataclass
class _Plan:
    table: DataFrame  # bins, label, key
    source: DataFrame
    cuts: list[np.ndarray]
    rows: int
    base: float
    scale: float


def _planned(matrix: DataFrame, features: Column, label: Column, key: Column, s: Boosting) -> _Plan:
    """Bin cuts, base value and fixed point of a training table, and its rows in bytes."""
    rows = matrix.select(features.alias("x"), label.cast("double").alias("label"), key.alias("key"))
    if s.learn_rows:
        # the key is a hash already; rows with equal keys are ordered by what they hold
        rows = first_rows(rows, s.learn_rows, "key", "label", "x").persist(StorageLevel.MEMORY_AND_DISK)
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_unusable(F.col("label"))).alias("bad"), F.avg("label").alias("mean"),
        F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.size("x")).alias("least"), F.max(F.size("x")).alias("width"),
    ).first()
    if not found["n"] or found["bad"] or found["least"] != found["width"]:
        raise DataValidationError(f"{found['n']} rows to learn from, {found['bad']} labels not usable, {found['least']} to {found['width']} features")
    if found["n"] <= CUT_ROWS:
        some = rows.select("x").toArrow()["x"].combine_chunks()
        values = _lists(some, found["width"]) if isinstance(some, pa.Array) else np.concatenate([_lists(c, found["width"]) for c in some.chunks])
        cuts = [bin_cuts(values[:, f], s.bins) for f in range(found["width"])]
    else:
        cuts = all_cuts(rows.select("x"), found["width"], s.bins)
    # a double's mean of doubles depends on the order; the base only has to be near, so it is cut to 24 bits
    base = float(np.float32(found["mean"]))
    top = max(abs(found["high"] - base), abs(found["low"] - base), 1e-200) * 4
    bits = min(GRADIENT, 62 - int(found["n"]).bit_length()) - int(np.ceil(np.log2(top)))
    width = found["width"]

    @F.arrow_udf("binary")
    def packed(column: pa.Array) -> pa.Array:
        flat = binned(_lists(column, width), cuts)
        return pa.Array.from_buffers(pa.binary(width), len(flat), [None, pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())

    return _Plan(rows.select(packed("x").alias("bins"), "label", "key"), rows, cuts, found["n"], base, 2.0**bits)


def fit_groups(matrices: Sequence[DataFrame], features: Column, label: Column, key: Column, s: Boosting, seed: int) -> list["Ensemble"]:
    """An ensemble for each training table. Tables of at most ``held_rows`` rows are fitted side by side, a task each."""
    plans = [_planned(m, features, label, key, s) for m in matrices]
    small = {i: (p.base, p.scale, len(p.cuts)) for i, p in enumerate(plans) if p.rows <= s.held_rows}
    nodes: dict[int, pa.Table] = {}
    if small:
        tagged = [plans[i].table.select(F.lit(i).alias("fit"), "*") for i in small]
        both = tagged[0]
        for t in tagged[1:]:
            both = both.unionByName(t)
        dealt = both.repartitionById(max(small) + 1, F.col("fit"))  # a fit is a partition
        grown = dealt.mapInArrow(partial(_fit_held, plans=small, s=s, seed=seed), NODES).toArrow()
        for i in small:
            nodes[i] = grown.filter(pc.equal(grown["fit"], i)).sort_by([("tree", "ascending"), ("node", "ascending")])
    for i, p in enumerate(plans):
        if i not in small:
            rows = SparkRows(p.table, p.rows, len(p.cuts), p.base, p.scale, s, seed)
            nodes[i] = _node_table(i, boost(rows, len(p.cuts), s, seed))
            rows.release()
    if s.learn_rows:
        for p in plans:
            p.source.unpersist()
    return [Ensemble.of(nodes[i], p.cuts, p.base) for i, p in enumerate(plans)]


@dataclass
class Ensemble:
    """Fitted trees: node arrays of all trees one after another, ``roots`` where each begins."""

    cuts: list[np.ndarray]
    base: float
    roots: np.ndarray
    nodes: Tree

    @staticmethod
    def of(table: pa.Table, cuts: list[np.ndarray], base: float) -> "Ensemble":
        tree = table["tree"].to_numpy()
        roots = np.concatenate(([0], np.flatnonzero(tree[1:] != tree[:-1]) + 1)).astype(np.int32)
        begin = roots[tree]
        column = {c: table[c].to_numpy() for c in ("feature", "bin", "left", "right", "value", "gain", "n")}
        inner = column["feature"] >= 0
        left, right = (np.where(inner, column[c] + begin, 0).astype(np.int32) for c in ("left", "right"))
        nodes = Tree(column["feature"].astype(np.int16), column["bin"].astype(np.uint8), left, right, column["value"], column["gain"], column["n"])
        return Ensemble(cuts, base, roots, nodes)

    def predict(self, values: np.ndarray, block: int = 1 << 12) -> np.ndarray:
        out = np.full(len(values), self.base)
        t = self.nodes
        for a in range(0, len(values), block):
            bins = binned(values[a : a + block], self.cuts)
            rows = np.arange(len(bins))
            for root in self.roots.tolist():
                at = np.full(len(bins), root, np.int32)
                left = rows
                while len(left):
                    f = t.feature[at[left]]
                    left, f = left[f >= 0], f[f >= 0]
                    node = at[left]
                    at[left] = np.where(bins[left, f] <= t.bin[node], t.left[node], t.right[node])
                out[a : a + block] += t.value[at]
        return out

    def table(self) -> pa.Table:
        """The nodes as rows, with children numbered over all trees."""
        tree = np.repeat(np.arange(len(self.roots), dtype=np.int32), np.diff(np.append(self.roots, len(self.nodes.feature))))
        t = self.nodes
        cut = [float(self.cuts[f][b - 1]) if f >= 0 and b > 0 else None for f, b in zip(t.feature.tolist(), t.bin.tolist())]
        columns = {"tree": tree, "node": np.arange(len(tree), dtype=np.int32), "feature": t.feature.astype(np.int32), "bin": t.bin.astype(np.int32)}
        columns |= {"cut": pa.array(cut, pa.float64()), "left": t.left, "right": t.right, "value": t.value, "gain": t.gain, "n": t.n}
        return pa.table(columns)


# --- the ML stages -------------------------------------------------------------------------------


class _BoostingParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "target column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column the prediction goes to", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "hash of a row's key; empty: hash of the row", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "boosting settings", TypeConverters.identity)
    seed = Param(Params._dummy(), "seed", "seed of the draws", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", keyCol="", settings=asdict(Boosting()), seed=42)

    def boosting(self) -> Boosting:
        return Boosting(**self.getOrDefault("settings"))


def _doubles(df: DataFrame, name: str) -> Column:
    """A vector or an array of numbers as an array of doubles."""
    return vector_to_array(F.col(name)) if isinstance(df.schema[name].dataType, VectorUDT) else F.col(name).cast("array<double>")


class HistogramBoosting(Estimator, _BoostingParams):
    """Learns a boosted ensemble with squared loss."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", predictionCol="prediction", keyCol="", settings=None, seed=42):
        super().__init__()
        values = settings if isinstance(settings, Boosting) else Boosting(**(settings or {}))
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, keyCol=keyCol, settings=asdict(values), seed=seed)

    def fit_all(self, tables: Sequence[DataFrame]) -> list["HistogramBoostingModel"]:
        """A model for each table, side by side where they are small enough."""
        x, y = _doubles(tables[0], self.getOrDefault("featuresCol")), F.col(self.getOrDefault("labelCol"))
        key = F.col(self.getOrDefault("keyCol")) if self.getOrDefault("keyCol") else F.xxhash64(x, y)
        made = fit_groups(tables, x, y, key, self.boosting(), self.getOrDefault("seed"))
        return [self._copyValues(HistogramBoostingModel(e)) for e in made]

    def _fit(self, dataset: DataFrame) -> "HistogramBoostingModel":
        return self.fit_all([dataset])[0]


class HistogramBoostingModel(Model, _BoostingParams, MLReadable, MLWritable):
    """Adds the prediction: map-only, Arrow batches against the trees' arrays."""

    def __init__(self, ensemble: Ensemble) -> None:
        super().__init__()
        self.ensemble = ensemble

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ensemble, name = self.ensemble, self.getOrDefault("featuresCol")
        width = len(ensemble.cuts)

        @F.arrow_udf("double")
        def predicted(column: pa.Array) -> pa.Array:
            return pa.array(ensemble.predict(_lists(column, width)))

        return dataset.withColumn(self.getOrDefault("predictionCol"), predicted(_doubles(dataset, name)))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    """Settings as every stage has them; nodes as Parquet, cuts as one JSON text."""

    def __init__(self, model: HistogramBoostingModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, made = self.sparkSession, self.model.ensemble
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        spark.createDataFrame(made.table().to_pandas()).write.parquet(os.path.join(path, "nodes"))
        text = json.dumps({"cuts": [c.tolist() for c in made.cuts], "base": made.base})
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(os.path.join(path, "cuts"))


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> HistogramBoostingModel:
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        known = json.loads(spark.read.text(os.path.join(path, "cuts")).first()["value"])
        t = spark.read.parquet(os.path.join(path, "nodes")).orderBy("node").toArrow()
        column = {c: t[c].to_numpy() for c in ("tree", "feature", "bin", "left", "right", "value", "gain", "n")}
        roots = np.concatenate(([0], np.flatnonzero(np.diff(column["tree"])) + 1)).astype(np.int32)
        links = [column["feature"].astype(np.int16), column["bin"].astype(np.uint8), column["left"].astype(np.int32), column["right"].astype(np.int32)]
        nodes = Tree(*links, column["value"], column["gain"], column["n"])
        model = HistogramBoostingModel(Ensemble([np.array(c) for c in known["cuts"]], known["base"], roots, nodes))
        DefaultParamsReader.getAndSetParams(model, metadata)
        model._resetUid(metadata["uid"])
        return model
