"""Random-forest regressor, grown on sparse rows.

A row is its few entries (column numbers and values), so work and memory follow the entries and not the
width that the one-hot levels add. Every column may be split at every node: a column of ones at one half,
any other one at the places that its percentiles give (``candidates``). A tree's rows are drawn with
replacement: a row counts as often as its hash says, the same on every run and cluster size.

The rows are written once as bins (``coded``), which every forest on them reads. Up to ``WHOLE * LARGE`` of them are
broadcast, and a task grows whole trees from them. Of more rows, nodes of more than ``LARGE`` drawn rows are split level
by level for all trees at once: every task counts the bins of its rows, the counts meet by node, and only the chosen
splits reach the driver. A node that is no larger is sent with its rows to one task, which grows what is below it, again
by level. No group holds more than ``LARGE`` drawn rows there, and the trees stay tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.models import candidates, tree_table
from caseflow.models.tree_table import DEEPEST, TreeTable
from caseflow.schema import KEY, SEED
from caseflow.session import materialise

LARGE = 65_536  # drawn rows of a node up to which its subtree is grown in one task
MOST_PLACES = 63  # places of a column
ROWS_AT_ONCE = 100_000  # rows of a task whose bins are counted together
SIDES_AT_ONCE = 1 << 25  # rows times splits whose sides are held at a time
TABLE = 2  # entries of a node, by all bins, from which these are counted in a table
ALONE = 4_096  # rows of a node from which its sides are found by itself
WHOLE = 32  # times LARGE: rows of a table up to which every task holds them all and grows whole trees
FLAT = 1e-12  # a variance of no more is none
POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880)])


@dataclass(frozen=True)
class Space:
    """The bins of all columns: one for each column of ones, behind them those of the others."""

    width: int
    entries: int  # the most of a row
    numbers: np.ndarray  # columns that are not all ones, rising
    places: list[np.ndarray]
    first: np.ndarray  # first bin of each of them

    @property
    def n_bins(self) -> int:
        return int(self.first[-1]) + len(self.places[-1]) + 1 if len(self.numbers) else self.width

    @property
    def kind(self) -> type:
        """The numbers that bins are kept as."""
        return np.int16 if self.n_bins < 1 << 15 else np.int32

    def bins(self, indices: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The bins of each row: those of its ones, then of every other column in turn; -1 is none."""
        ones = np.where(np.isin(indices, self.numbers) | (values == 0), -1, indices)
        rest = [
            first + np.searchsorted(places, ((indices == c) * values).sum(axis=1), "left")
            for c, places, first in zip(self.numbers, self.places, self.first, strict=True)
        ]
        return np.column_stack([ones, *rest]).astype(self.kind)

    def split(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Column and threshold of a split behind these bins."""
        column, threshold = at.astype(np.int64), np.full(len(at), 0.5)
        for c, places, first in zip(self.numbers, self.places, self.first, strict=True):
            own = (at >= first) & (at < first + len(places))
            column[own], threshold[own] = c, places[at[own] - first]
        return column, threshold

    def last(self) -> np.ndarray:
        """The last bin of each of the other columns, behind which nothing is left to split."""
        return self.first + np.array([len(p) for p in self.places], np.int64)


def space_of(train: DataFrame) -> Space:
    """Columns and places of the train rows; only the columns that are not all ones come to the driver."""
    entries = train.select(F.explode(F.arrays_zip("indices", "values")).alias("e")).select("e.*")
    found = entries.where("values not in (0.0, 1.0)").select("indices").distinct().collect()
    facts = train.agg(F.max(F.array_max("indices")).alias("last"), F.max(F.size("indices")).alias("entries")).first()
    width = 0 if facts["last"] is None else facts["last"] + 1
    numbers = np.array(sorted(r["indices"] for r in found), np.int64)
    look = tree_table.sparse("indices", "values")
    dense = F.array(*[look(F.lit(int(c))) for c in numbers]).cast("array<double>")
    places = candidates.split_candidates(train.select(dense.alias("numbers")), "numbers", MOST_PLACES)
    kept = [np.array(p, float) for p in places] + [np.zeros(0)] * (len(numbers) - len(places))
    sizes = np.array([len(p) + 1 for p in kept], np.int64)
    return Space(width, max(facts["entries"] or 0, 1), numbers, kept, width + np.cumsum(sizes) - sizes)


def draws(hashes: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson of mean one, from the row's hash."""
    with np.errstate(over="ignore"):
        x = hashes.astype(np.int64).view(np.uint64) + np.uint64(tree + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return np.searchsorted(POISSON, (x >> np.uint64(11)).astype(float) / 2.0**53, "right")


def stable_order(key: np.ndarray) -> np.ndarray:
    """As a stable ``argsort`` of whole numbers from 0 on, by digits of 16 bits: these are sorted without comparisons."""
    order = np.argsort((key & 0xFFFF).astype(np.uint16), kind="stable")
    for shift in range(16, int(key.max(initial=0)).bit_length(), 16):
        order = order[np.argsort(((key >> shift) & 0xFFFF).astype(np.uint16)[order], kind="stable")]
    return order


def counted(node: np.ndarray, bins: np.ndarray, w: np.ndarray, s: np.ndarray, n_bins: int) -> tuple[np.ndarray, ...]:
    """``(node, bin, drawn, sum)`` of the rows' entries, by node and bin, rising."""
    top = (int(node.max(initial=0)) + 1) * n_bins
    kind = np.int32 if max(top, bins.size) < 1 << 31 else np.int64
    bins = bins.astype(kind, copy=False)
    known = np.flatnonzero((bins >= 0).ravel())
    key = ((node.astype(kind) * kind(n_bins))[:, None] + bins).ravel()[known]
    row = np.repeat(np.arange(len(bins), dtype=kind), bins.shape[1])[known]
    order = stable_order(key)
    row, key = row[order], key[order]
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    if not len(start):
        return start, start, start, np.zeros(0)
    first = key[start].astype(np.int64)
    return first // n_bins, first % n_bins, np.add.reduceat(w[row], start), np.add.reduceat(s[row], start)


def best_splits(
    node: np.ndarray, at: np.ndarray, w: np.ndarray, s: np.ndarray, total_w: np.ndarray, total_s: np.ndarray,
    space: Space, least: int,
) -> tuple[np.ndarray, ...]:
    """``(node, bin, left drawn, left sum)`` of the best split of each node that has one.

    Rows of counted bins in their order; totals by node. The rows in a column of ones go right; of
    another column those up to the bin go left. The first of equal splits is taken.
    """
    if not len(node):
        return node, at, w, s
    number = at >= space.width
    column = np.where(number, np.searchsorted(space.first, at, "right"), 0)
    new = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]) | (column[1:] != column[:-1]))))
    size = np.diff(np.concatenate((new, [len(node)])))
    left_w, left_s = np.cumsum(w), np.cumsum(s)
    left_w, left_s = (c - np.repeat(c[new] - x[new], size) for c, x in ((left_w, w), (left_s, s)))
    all_w, all_s = total_w[node], total_s[node]
    left_w, left_s = np.where(number, left_w, all_w - w), np.where(number, left_s, all_s - s)
    right_w = all_w - left_w
    good = (left_w >= least) & (right_w >= least) & ~(number & np.isin(at, space.last()))
    i = np.flatnonzero(good)
    gain = gains(left_w[i], left_s[i], all_w[i], all_s[i])
    i, gain = i[gain > 0], gain[gain > 0]
    if len(i):
        start = np.flatnonzero(np.concatenate(([True], node[i][1:] != node[i][:-1])))
        most = np.repeat(np.maximum.reduceat(gain, start), np.diff(np.concatenate((start, [len(i)]))))
        i = i[gain == most]  # in order, so that the first of a node is the first of its equals
        i = i[np.concatenate(([True], node[i][1:] != node[i][:-1]))]
    return node[i], at[i], left_w[i], left_s[i]


def gains(left_w: np.ndarray, left_s: np.ndarray, all_w: np.ndarray, all_s: np.ndarray) -> np.ndarray:
    """What splits take off the squares: of sums around the node's mean, where the right one is the left one's negative."""
    off = left_s - left_w * (all_s / all_w)
    return off**2 / left_w + off**2 / (all_w - left_w)


def exact(y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The target around its mean, rounded so that its weighted sums are exact, in whatever order they are added up
    or taken from each other."""
    off = y - np.average(y, weights=w)
    most = np.abs(off).max() * w.sum()
    if not 0 < most < np.inf:
        return off
    unit = 2.0 ** (51 - np.ceil(np.log2(most)))
    return np.rint(off * unit) / unit


def goes_right(bins: np.ndarray, at: np.ndarray, space: Space) -> np.ndarray:
    """Whether each row goes right of its own split."""
    right = (bins == at.astype(bins.dtype)[:, None]).any(axis=1)
    shift = bins.shape[1] - len(space.numbers)
    for j, (first, places) in enumerate(zip(space.first, space.places, strict=True)):
        own = np.flatnonzero((at >= first) & (at <= first + len(places)))
        right[own] = bins[own, shift + j] > at[own]
    return right


def tables(cols: np.ndarray, rows: np.ndarray, of: np.ndarray, n: int, w: np.ndarray, s: np.ndarray, n_bins: int) -> np.ndarray:
    """``[n, 2, n_bins + 1]``: drawn rows and their sum by bin, of n sets of rows; the first place is of no bin."""
    out = np.zeros((2, n * (n_bins + 1)))
    base, w, s = of * (n_bins + 1), w[rows], s[rows]
    for col in cols:
        key = base + col[rows]
        out[0] += np.bincount(key, w, out.shape[1])
        out[1] += np.bincount(key, s, out.shape[1])
    return out.reshape(2, n, -1).transpose(1, 0, 2)


def best_of_tables(found: np.ndarray, all_w: np.ndarray, all_s: np.ndarray, space: Space, least: int) -> np.ndarray:
    """The bin of the best split of each node, as ``best_splits`` has it, or -1."""
    drawn, sums = found[:, 0, 1:], found[:, 1, 1:]
    left_w, left_s = all_w[:, None] - drawn, all_s[:, None] - sums
    for first, places in zip(space.first, space.places, strict=True):
        own = slice(first, first + len(places) + 1)
        left_w[:, own], left_s[:, own] = np.cumsum(drawn[:, own], axis=1), np.cumsum(sums[:, own], axis=1)
    good = (left_w >= least) & (all_w[:, None] - left_w >= least)
    good[:, space.last()] = False
    node, at = np.nonzero(good)
    gain = np.zeros(good.shape)
    gain[node, at] = gains(left_w[node, at], left_s[node, at], all_w[node], all_s[node])
    best = gain.argmax(axis=1)
    return np.where(gain[np.arange(len(gain)), best] > 0, best, -1)


def sorted_sides(cols: np.ndarray, starts: np.ndarray, at: np.ndarray, space: Space, shown: np.ndarray) -> np.ndarray:
    """Whether each row goes right of its node's split, where that has one; rows lie by node, ``shown`` has the columns
    that show a bin."""
    sizes = np.diff(starts)
    right = np.zeros(starts[-1], bool)
    some = np.flatnonzero(np.repeat((sizes < ALONE) & (at >= 0), sizes))
    right[some] = goes_right(cols[:, some].T - 1, np.repeat(at, sizes)[some], space)
    for k in np.flatnonzero((sizes >= ALONE) & (at >= 0)):
        own, b = slice(starts[k], starts[k + 1]), at[k]
        if b >= space.width:
            j = np.searchsorted(space.first, b, "right") - 1
            right[own] = cols[len(cols) - len(space.numbers) + j, own] > b + 1
        else:
            for col in cols[shown[:, b + 1]]:
                right[own] |= col[own] == b + 1
    return right


def subtree(bins: np.ndarray, y: np.ndarray, w: np.ndarray, levels: int, least: int, space: Space) -> dict[str, np.ndarray]:
    """All nodes below one, itself the first, of rows that fit a task: one array step for each level.

    Rows lie by node. A node of many rows has a table of all bins; of two such children only the rows of the smaller
    one are counted, the other's table is what is left of their parent's. Nodes of few rows sort their entries.
    """
    feature, threshold, left, right, value = [[-1]], [[0.0]], [[-1]], [[-1]], [[np.average(y, weights=w)]]
    # Columns of ones that no row has an entry in are left out; 0 is no bin.
    used = np.concatenate(((bins >= 0).any(axis=0)[: bins.shape[1] - len(space.numbers)], np.ones(len(space.numbers), bool)))
    cols = np.ascontiguousarray(bins.T[used]) + space.kind(1)
    shown = np.zeros((len(cols), space.n_bins + 1), bool)
    for held, col in zip(shown, cols, strict=True):
        held[col] = True
    wide = TABLE * (space.n_bins + 1) / max(len(cols), 1)  # rows from which a node has a table
    s = w * exact(y, w)
    starts, open_ids, n = np.array([0, len(y)]), np.zeros(1, np.int64), 1
    with_table = np.full(1, 0 if len(y) >= wide else -1)  # which of the tables is a node's
    found = tables(cols, np.arange(len(y)), np.zeros(len(y), np.int64), 1, w, s, space.n_bins) if len(y) >= wide else None
    for _ in range(levels):
        sizes = np.diff(starts)
        node = np.repeat(np.arange(len(sizes)), sizes)
        all_w, all_s = np.add.reduceat(w, starts[:-1]), np.add.reduceat(s, starts[:-1])
        mean = np.add.reduceat(w * y, starts[:-1]) / all_w
        spread = np.add.reduceat(w * (y - mean[node]) ** 2, starts[:-1])
        live = (all_w >= 2 * least) & (spread > FLAT * all_w)
        best = np.full(len(sizes), -1)
        big = np.flatnonzero(live & (with_table >= 0))
        if len(big):
            best[big] = best_of_tables(found[with_table[big]], all_w[big], all_s[big], space, least)
        rows = np.flatnonzero((live & (with_table < 0))[node])
        if len(rows):
            entries = counted(node[rows], cols[:, rows].T - 1, w[rows], s[rows], space.n_bins)
            split, at, _, _ = best_splits(*entries, all_w, all_s, space, least)
            best[split] = at
        split = np.flatnonzero(best >= 0)
        if not len(split):
            break
        at, rows = best[split], np.flatnonzero((best >= 0)[node])
        child = 2 * np.repeat(np.arange(len(split)), sizes[split]) + sorted_sides(cols, starts, best, space, shown)[rows]
        order = rows[stable_order(child)]
        cols, y, w, s = np.take(cols, order, axis=1), y[order], w[order], s[order]
        sizes = np.bincount(child, minlength=2 * len(split))
        starts = np.concatenate(([0], np.cumsum(sizes)))
        ids = n + np.arange(2 * len(split))
        column, place = space.split(at)
        flat = [np.concatenate(x) for x in (feature, threshold, left, right)]
        for array, new in zip(flat, (column, place, ids[::2], ids[1::2]), strict=True):
            array[open_ids[split]] = new
        blank = np.full(len(ids), -1, np.int64)
        feature, threshold, left, right = ([x, f] for x, f in zip(flat, (blank, np.zeros(len(ids)), blank, blank), strict=True))
        value.append(np.add.reduceat(w * y, starts[:-1]) / np.add.reduceat(w, starts[:-1]))
        larger = 2 * np.arange(len(split)) + (sizes[1::2] > sizes[::2])
        told = np.flatnonzero(sizes[larger] >= wide)  # splits of which a child has a table
        with_table, parents = np.full(len(sizes), -1), with_table[split]
        if len(told):
            larger, smaller = larger[told], larger[told] ^ 1
            which = np.full(len(sizes), -1)
            which[smaller] = np.arange(len(told))
            of = np.repeat(which, sizes)
            rows = np.flatnonzero(of >= 0)
            few = tables(cols, rows, of[rows], len(told), w, s, space.n_bins)
            found = np.concatenate((found[parents[told]] - few, few))
            with_table[larger] = np.arange(len(told))
            with_table[smaller] = np.where(sizes[smaller] >= wide, len(told) + np.arange(len(told)), -1)
        open_ids, n = ids, n + len(ids)
    return {
        "feature": np.concatenate(feature), "threshold": np.concatenate(threshold),
        "left": np.concatenate(left), "right": np.concatenate(right), "value": np.concatenate(value),
    }


class Upper:
    """The nodes of one tree that are split level by level, as rising lists."""

    def __init__(self) -> None:
        self.feature, self.threshold, self.left, self.right = [-1], [0.0], [-1], [-1]
        self.value, self.bin, self.depth = [0.0], [-1], [0]
        self.tried: set[int] = set()  # nodes whose split was sought by level

    def grow(self, at: int, column: int, threshold: float, bin_: int, values: Sequence[float]) -> tuple[int, int]:
        a, b = len(self.feature), len(self.feature) + 1
        self.feature[at], self.threshold[at], self.bin[at] = column, threshold, bin_
        self.left[at], self.right[at] = a, b
        for v in values:
            for own, x in ((self.feature, -1), (self.threshold, 0.0), (self.left, -1), (self.right, -1), (self.bin, -1)):
                own.append(x)
            self.value.append(v)
            self.depth.append(self.depth[at] + 1)
        return a, b

    def leaf_of(self, goes: np.ndarray, splits: np.ndarray) -> np.ndarray:
        """The node at which each row ends, by the sides (``sides``) it takes at rising splits."""
        left, right = np.array(self.left), np.array(self.right)
        which = np.searchsorted(splits, self.bin)
        node = np.zeros(len(goes), np.int64)
        rows = np.arange(len(goes) if left[0] >= 0 else 0)
        while len(rows):
            at = node[rows]
            to = np.where(goes[rows, which[at]], right[at], left[at])
            node[rows] = to
            rows = rows[left[to] >= 0]
        return node


def sides(bins: np.ndarray, splits: np.ndarray, space: Space) -> np.ndarray:
    """Whether each row goes right of each split."""
    slot = np.full(space.n_bins + 1, len(splits))  # the last one is that of -1
    slot[splits] = np.arange(len(splits))
    right = np.zeros((len(bins), len(splits) + 1), bool)
    np.put_along_axis(right, slot[bins], True, axis=1)
    shift = bins.shape[1] - len(space.numbers)
    for j, (first, places) in enumerate(zip(space.first, space.places, strict=True)):
        own = np.flatnonzero((splits >= first) & (splits <= first + len(places)))
        right[:, own] = bins[:, shift + j, None] > splits[own]
    return right


def end_nodes(bins: np.ndarray, uppers: Sequence[Upper], space: Space) -> list[np.ndarray]:
    """For every tree the node at which each row ends; trees that split alike ask a row once."""
    splits = np.unique([b for u in uppers for b in u.bin if b >= 0]).astype(np.int64)
    some = max(1, SIDES_AT_ONCE // (len(splits) + 1))
    parts = (sides(bins[i : i + some], splits, space) for i in range(0, len(bins), some))
    found = [[u.leaf_of(goes, splits) for u in uppers] for goes in parts]
    return [np.concatenate(own) for own in zip(*found, strict=True)]


@dataclass(frozen=True)
class Coded:
    """Train rows ``(hash, y, bins)``, written once, what the bins mean, and the rows as tasks hold them, if so few."""

    rows: DataFrame
    space: Space
    n: int
    whole: Broadcast | None


def coded(encoded_train: DataFrame) -> Coded:
    drawn_by = [c for c in (KEY, "y", "indices", "values") if c in encoded_train.columns]
    rows = encoded_train.where(F.col("y").isNotNull()).select(
        F.xxhash64(F.lit(SEED), *drawn_by).alias("hash"), "y", "indices", "values"
    )
    space = space_of(rows)

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            bins = space.bins(*tree_table.padded(df["indices"], df["values"], space.entries))
            yield pd.DataFrame({"hash": df["hash"], "y": df["y"], "bins": [r.tobytes() for r in bins]})

    written = materialise(rows.mapInPandas(code, "hash long, y double, bins binary"), "forest_rows")
    n = written.count()
    if not 0 < n <= WHOLE * LARGE:
        return Coded(written, space, n, None)
    held = written.toArrow().sort_by([("hash", "ascending"), ("bins", "ascending")])  # 100 MB where rows have 20 bins
    bins = np.frombuffer(b"".join(held["bins"].to_pylist()), space.kind).reshape(n, -1)
    return Coded(written, space, n, written.sparkSession.sparkContext.broadcast((held["hash"].to_numpy(), held["y"].to_numpy(), bins)))


def _unpacked(bins: Sequence[bytes], space: Space) -> np.ndarray:
    return np.frombuffer(b"".join(bins), space.kind).reshape(len(bins), -1)


def _blocks(frames: Iterator[pd.DataFrame], space: Space) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(hash, y, bins, bins as stored)`` of a task's rows, so many at once."""
    kept: list[pd.DataFrame] = []

    def block() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        df = pd.concat(kept)
        kept.clear()
        stored = df["bins"].to_numpy(object)
        return df["hash"].to_numpy(), df["y"].to_numpy(float), _unpacked(stored, space), stored

    for frame in frames:
        if len(frame):
            kept.append(frame)
        if sum(map(len, kept)) >= ROWS_AT_ONCE:
            yield block()
    if kept:
        yield block()


def _split_level(rows: DataFrame, uppers: list[Upper], wanted: list[set[int]], space: Space, least: int) -> list:
    """One row for each wanted node: its totals and, where it has one, its best split."""
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for hashes, y, bins, _ in _blocks(frames, space):
            for t, end in enumerate(end_nodes(bins, uppers, space)):
                w = draws(hashes, t)
                mine = np.flatnonzero(w)
                leaf = end[mine]
                open_ids = np.array(sorted(wanted[t]), np.int64)
                inside = np.isin(leaf, open_ids)
                mine, leaf = mine[inside], np.searchsorted(open_ids, leaf[inside])
                if not len(mine):
                    continue
                drawn, total = w[mine].astype(float), w[mine] * y[mine]
                node, at, n, s = counted(leaf, bins[mine], drawn, total, space.n_bins)
                cuts = np.searchsorted(node, np.arange(len(open_ids) + 1))
                all_w = np.bincount(leaf, drawn, len(open_ids))
                all_s = np.bincount(leaf, total, len(open_ids))
                some = [i for i in range(len(open_ids)) if all_w[i]]
                yield pd.DataFrame({
                    "tree": [t] * len(some), "node": [int(open_ids[i]) for i in some],
                    "w": [all_w[i] for i in some], "s": [all_s[i] for i in some],
                    "at": [at[cuts[i]:cuts[i + 1]] for i in some], "n": [n[cuts[i]:cuts[i + 1]] for i in some],
                    "sums": [s[cuts[i]:cuts[i + 1]] for i in some],
                })

    def choose(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["w", "s"])  # sums do not follow the order of arrival
        at = np.concatenate(df["at"].to_list())
        order = np.argsort(at, kind="stable")
        at = at[order]
        n, s = (np.concatenate(df[c].to_list())[order] for c in ("n", "sums"))
        start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        w, total = df["w"].sum(), df["s"].sum()
        n, s = np.add.reduceat(n, start), np.add.reduceat(s, start) - np.add.reduceat(n, start) * (total / w)
        zero = np.zeros(len(start), np.int64)
        found = best_splits(zero, at[start], n, s, np.array([w]), np.zeros(1), space, least)
        split, left_w, left_s = (int(found[1][0]), found[2][0], found[3][0]) if len(found[0]) else (-1, 0.0, 0.0)
        return pd.DataFrame([(df["tree"].iloc[0], df["node"].iloc[0], w, total / w, split, left_w, left_s)],
                            columns=["tree", "node", "w", "mean", "split", "left_w", "left_s"])

    part = "tree int, node int, w double, s double, at array<long>, n array<double>, sums array<double>"
    best = "tree int, node int, w double, mean double, split int, left_w double, left_s double"
    return rows.mapInPandas(count, part).groupBy("tree", "node").applyInPandas(choose, best).collect()


def fit(train: DataFrame | Coded, config: dict) -> TreeTable:
    """All features at every split, bootstrap rows, fixed seed; of encoded rows, or of rows that were coded once
    for several forests."""
    depth, n_trees, least = config["max_depth"], config.get("n_estimators"), config.get("min_samples_leaf")
    if depth is None or depth > DEEPEST:
        raise ValueError(f"trees of depth {depth} are asked for; {DEEPEST} is the deepest")
    known = train if isinstance(train, Coded) else coded(train)
    rows, space = known.rows, known.space
    if known.whole:
        return _grown_whole(known, n_trees, depth, least)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean")).first()
    uppers = [Upper() for _ in range(n_trees)]
    for upper in uppers:
        upper.value[0] = facts["mean"] or 0.0
    # A tree draws about as many rows as there are; the node's own count is found when it is split.
    wanted = [{0} if facts["n"] > LARGE and depth else set() for _ in uppers]
    while any(wanted):
        for upper, own in zip(uppers, wanted, strict=True):
            upper.tried |= own
        best = _split_level(rows, uppers, wanted, space, least)
        wanted = [set() for _ in uppers]
        for r in best:  # one row for each node of more than LARGE drawn rows
            upper = uppers[r["tree"]]
            upper.value[r["node"]] = r["mean"]
            if r["split"] < 0:
                continue
            (column,), (threshold,) = space.split(np.array([r["split"]]))
            sides = (r["left_w"], r["left_s"]), (r["w"] - r["left_w"], -r["left_s"])
            ids = upper.grow(r["node"], int(column), float(threshold), r["split"], [r["mean"] + s / w for w, s in sides])
            wanted[r["tree"]] |= {i for i, (w, _) in zip(ids, sides, strict=True) if w > LARGE and upper.depth[i] < depth}
    return _below(rows, uppers, space, depth, least)


def _grown_whole(known: Coded, n_trees: int, depth: int, least: int) -> TreeTable:
    """Every tree in one task, which holds all rows and draws from them."""
    space, whole, spark = known.space, known.whole, known.rows.sparkSession

    def grow(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, y, bins = whole.value
        for tree in (int(t) for df in frames for t in df["id"]):
            w = draws(hashes, tree)
            levels = depth if w.any() else 0  # a tree that draws no row is the mean
            w = w if w.any() else np.ones(len(y))
            mine = np.flatnonzero(w)
            nodes = subtree(bins[mine], y[mine], w[mine].astype(float), levels, least, space)
            yield pd.DataFrame({"tree": tree, "node": np.arange(len(nodes["value"])), **nodes})

    tasks = min(n_trees, 4 * spark.sparkContext.defaultParallelism)
    grown = spark.range(0, n_trees, 1, tasks).mapInPandas(grow, tree_table.NODES)
    return TreeTable(materialise(grown, "trees"), n_trees, 0.0, 1 / n_trees, depth)


def _below(rows: DataFrame, uppers: list[Upper], space: Space, depth: int, least: int) -> TreeTable:
    """The upper nodes, and below every other end of them what is grown in one task."""
    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for hashes, y, bins, stored in _blocks(frames, space):
            for t, (upper, end) in enumerate(zip(uppers, end_nodes(bins, uppers, space), strict=True)):
                w = draws(hashes, t)
                mine = np.flatnonzero(w)
                leaf = end[mine]
                go = ~np.isin(leaf, list(upper.tried)) & (np.array(upper.depth)[leaf] < depth)
                mine, leaf = mine[go], leaf[go]
                yield pd.DataFrame({
                    "tree": np.full(len(mine), t, np.int32), "top": leaf.astype(np.int32), "hash": hashes[mine],
                    "y": y[mine], "w": w[mine].astype(np.int32), "bins": stored[mine],
                })

    depths = [u.depth for u in uppers]

    def grow(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["hash", "bins"])
        bins = _unpacked(df["bins"].to_list(), space)
        tree, top = int(df["tree"].iloc[0]), int(df["top"].iloc[0])
        nodes = subtree(bins, df["y"].to_numpy(), df["w"].to_numpy(float), depth - depths[tree][top], least, space)
        return pd.DataFrame({"tree": tree, "top": top, "nth": np.arange(len(nodes["value"])), **nodes})

    dealt = rows.mapInPandas(deal, "tree int, top int, hash long, y double, w int, bins binary")
    kinds = "tree int, top int, nth int, feature int, threshold double, left int, right int, value double"
    grown = materialise(dealt.groupBy("tree", "top").applyInPandas(grow, kinds), "subtrees")
    upper_rows = [
        (t, i, u.feature[i], u.threshold[i], u.left[i], u.right[i], u.value[i])
        for t, u in enumerate(uppers) for i in range(len(u.feature))
    ]
    top_nodes = rows.sparkSession.createDataFrame(upper_rows, tree_table.NODES)
    # A subtree's first node takes the place of its end; the others follow the upper nodes in turn.
    sizes = grown.groupBy("tree", "top").agg((F.count(F.lit(1)) - 1).alias("size"))
    before = F.sum("size").over(Window.partitionBy("tree").orderBy("top")) - F.col("size")  # one row for each end
    n_upper = F.element_at(F.array(*[F.lit(len(u.feature)) for u in uppers]), F.col("tree") + 1)
    starts = sizes.select("tree", "top", (before + n_upper - 1).cast("int").alias("start"))

    def placed(c: str):
        return F.when(F.col(c) == 0, F.col("top")).otherwise(F.col("start") + F.col(c))

    below = grown.join(F.broadcast(starts), ["tree", "top"]).select(
        "tree", placed("nth").alias("node"), "feature", "threshold",
        *[F.when(F.col(c) < 0, F.lit(-1)).otherwise(placed(c)).alias(c) for c in ("left", "right")], "value",
    )
    ends = grown.select("tree", F.col("top").alias("node")).distinct()
    kept = top_nodes.join(F.broadcast(ends), ["tree", "node"], "left_anti")
    nodes = materialise(kept.select(*below.columns).unionByName(below), "trees")
    return TreeTable(nodes, len(uppers), 0.0, 1 / len(uppers), depth)
