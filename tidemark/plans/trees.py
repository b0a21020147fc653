"""Growing and asking one classification tree of coded rows, with numpy alone.

Rows are a matrix of whole numbers: first the bins of the numeric features, then
the codes of the category columns. A feature is a numeric column or one known
value of a category column, as after one-hot encoding. A node asks a column and
a cut: bins above the cut and codes equal to it go right. Splits take the largest
fall of the Gini impurity, as MLlib's do, among features drawn for each node.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: What the shares of a leaf add up to. Whole numbers, so that sums do not depend on their order.
WHOLE_SHARE = 1 << 30
#: Falls of the impurity up to this share of it are rounding.
LEAST_GAIN = 1e-12


@dataclass(frozen=True)
class Shape:
    """What all rows of a forest have in common."""

    bins: tuple[int, ...]  # of each numeric column
    sizes: tuple[int, ...]  # known values of each category column
    classes: int

    @property
    def features(self) -> int:
        return len(self.bins) + sum(self.sizes)

    @property
    def row(self) -> np.dtype:
        """A row without its class and weight."""
        return np.dtype([("bins", "u1", (len(self.bins),)), ("codes", "<i4", (len(self.sizes),))])

    @property
    def training_row(self) -> np.dtype:
        return np.dtype([*((n, self.row[n]) for n in self.row.names), ("label", "<i4"), ("weight", "<f8")])

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        return np.hstack([rows["bins"].astype(np.int32), rows["codes"].astype(np.int32)])

    def drawn(self, rng: np.random.Generator, nodes: int, count: int) -> np.ndarray:
        """For each node, ``count`` different features (Floyd's way, for all nodes at once)."""
        out = np.empty((nodes, count), np.int64)
        for at, top in enumerate(range(self.features - count, self.features)):
            new = rng.integers(0, top + 1, nodes)
            out[:, at] = np.where((out[:, :at] == new[:, None]).any(axis=1), top, new)
        return out

    def column_cut(self, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Column of each feature, and the value of those of a category column."""
        first = np.concatenate([np.arange(len(self.bins)), len(self.bins) + np.cumsum([0, *self.sizes])[:-1]])
        column = np.searchsorted(first, feature, side="right") - 1
        return column, feature - first[column]


def goes_right(values: np.ndarray, column, cut, numeric: int) -> np.ndarray:
    return np.where(column < numeric, values > cut, values == cut)


def shares(totals: np.ndarray) -> np.ndarray:
    """Class shares of leaves as whole numbers that add up to WHOLE_SHARE."""
    out = np.floor(totals / totals.sum(axis=1, keepdims=True) * WHOLE_SHARE).astype(np.int64)
    out[np.arange(len(out)), totals.argmax(axis=1)] += WHOLE_SHARE - out.sum(axis=1)
    return out.astype(np.int32)


def _proxy(left: np.ndarray, total: np.ndarray) -> np.ndarray:
    """The larger, the purer the two sides: sums of squares over weights."""
    right = total - left
    wl, wr = left.sum(axis=1), right.sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.einsum("ij,ij->i", left, left) / wl + np.einsum("ij,ij->i", right, right) / wr
    return np.where((wl > 0) & (wr > 0), value, -np.inf)


@dataclass
class Candidates:
    node: np.ndarray
    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray  # class weights
    left_count: np.ndarray


def _numeric(shape: Shape, picked: np.ndarray, at: np.ndarray, m: np.ndarray, y: np.ndarray, w: np.ndarray, count: np.ndarray) -> Candidates | None:
    """Every cut of the drawn numeric features that has rows at or below it. picked: node by column."""
    slots = np.flatnonzero(picked.ravel())
    if not len(slots):
        return None
    width, columns, classes = max(shape.bins), picked.shape[1], shape.classes
    number = np.cumsum(picked.ravel()) - 1
    keys, rows = [], []
    for c in range(columns):
        here = np.flatnonzero(picked[at, c])
        keys.append(number[at[here] * columns + c] * width + m[here, c])
        rows.append(here)
    key, row = np.concatenate(keys), np.concatenate(rows)
    if len(slots) * width <= 2 * len(key):
        group, found = key, np.arange(len(slots) * width)
    else:
        found, group = np.unique(key, return_inverse=True)
    hist = np.bincount(group * classes + y[row], w[row], len(found) * classes).reshape(-1, classes)
    counts = np.bincount(group, count[row], len(found))
    slot = found // width
    starts = np.searchsorted(slot, np.arange(len(slots)))
    below, upto = np.cumsum(hist, axis=0), np.cumsum(counts)
    zero = np.zeros((1, classes))
    left = below - np.concatenate([zero, below])[starts][slot]
    left_count = upto - np.concatenate([[0], upto])[starts][slot]
    return Candidates(slots[slot] // columns, slots[slot] % columns, found % width, left, left_count)


def _valued(shape: Shape, node: np.ndarray, which: int, value: np.ndarray, at, m, y, w, count, totals, counts) -> Candidates:
    """The splits of the drawn values of one category column: rows of the value go right."""
    size, column = shape.sizes[which], len(shape.bins) + which
    order = np.argsort(node * size + value)
    node, value = node[order], value[order]
    known = m[:, column] < size
    asked, own = node * size + value, at * size + np.where(known, m[:, column], 0)
    if len(totals) * size <= 8 * len(at) + 1_000_000:
        table = np.full(len(totals) * size, -1, np.int64)
        table[asked] = np.arange(len(asked))
        slot = table[own]
    else:
        slot = np.minimum(np.searchsorted(asked, own), len(asked) - 1)
        slot = np.where(asked[slot] == own, slot, -1)
    row = np.flatnonzero(known & (slot >= 0))
    hit = slot[row]
    right = np.bincount(hit * shape.classes + y[row], w[row], len(asked) * shape.classes).reshape(-1, shape.classes)
    right_count = np.bincount(hit, count[row], len(asked))
    some = np.flatnonzero(right_count)
    node = node[some]
    return Candidates(node, np.full(len(some), column), value[some], totals[node] - right[some], counts[node] - right_count[some])


def best_of(found: list[Candidates], totals: np.ndarray, counts: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Column and cut of the best split of each node; -1 where none is better than none."""
    column, cut = np.full(len(totals), -1), np.full(len(totals), -1)
    if not found:
        return column, cut
    node, left = np.concatenate([c.node for c in found]), np.concatenate([c.left for c in found])
    left_count = np.concatenate([c.left_count for c in found])
    value = _proxy(left, totals[node])
    value[(left_count < min_leaf) | (counts[node] - left_count < min_leaf)] = -np.inf
    weight = totals.sum(axis=1)
    whole = np.einsum("ij,ij->i", totals, totals) / weight
    best = np.full(len(totals), -np.inf)
    np.maximum.at(best, node, value)
    top = np.flatnonzero((value == best[node]) & (value - whole[node] > LEAST_GAIN * weight[node]))[::-1]
    choice = np.full(len(totals), -1)
    choice[node[top]] = top  # the first of equals, as they come in a fixed order
    good = np.flatnonzero(choice >= 0)
    column[good] = np.concatenate([c.column for c in found])[choice[good]]
    cut[good] = np.concatenate([c.cut for c in found])[choice[good]]
    return column, cut


@dataclass
class Tree:
    """Arrays by node: the column asked (-1: a leaf), the cut, and the place of the left child (the right one is next), or of a leaf's shares."""

    column: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    leaves: np.ndarray

    def answers(self, m: np.ndarray, numeric: int) -> np.ndarray:
        """Shares of every row's leaf."""
        node = np.zeros(len(m), np.int64)
        open_rows = np.arange(len(m))
        while len(open_rows):
            here = node[open_rows]
            column = self.column[here]
            inner = column >= 0
            if not inner.all():
                open_rows, here, column = open_rows[inner], here[inner], column[inner]
            node[open_rows] = self.left[here] + goes_right(m[open_rows, column], column, self.cut[here], numeric)
        return self.leaves[self.left[node]]


def grown(shape: Shape, m: np.ndarray, y: np.ndarray, weight: np.ndarray, count: np.ndarray, drawn: int, min_leaf: int, depth: int, rng: np.random.Generator) -> Tree:
    """A tree of rows that count ``count`` times (none may be 0), with ``drawn`` features tried at each node.

    Two leaves of one node that say the same become one, as in MLlib.
    """
    classes, numeric = shape.classes, len(shape.bins)
    w, count = weight * count, count.astype(np.float64)
    at = np.zeros(len(m), np.int64)
    totals = [np.bincount(y, w, classes)[None, :]]
    columns, cuts, lefts, levels = [], [], [], [0]
    counts = np.array([count.sum()])
    active, made = np.zeros(1, np.int64), 1  # places of the open nodes among those of the level
    for level in range(depth + 1):
        total = totals[-1]
        column, cut, left = (np.full(len(total), -1) for _ in range(3))
        if level < depth and len(active):
            own, own_count = total[active], counts[active]
            feature = shape.drawn(rng, len(active), drawn)
            asked, value = shape.column_cut(feature)
            found = []
            picked = np.zeros((len(active), numeric), bool)
            i, j = np.nonzero(asked < numeric)
            picked[i, asked[i, j]] = True
            if (some := _numeric(shape, picked, at, m, y, w, count)) is not None:
                found.append(some)
            for which in range(len(shape.sizes)):
                i, j = np.nonzero(asked == numeric + which)
                if len(i):
                    found.append(_valued(shape, i, which, value[i, j], at, m, y, w, count, own, own_count))
            best, best_cut = best_of(found, own, own_count, min_leaf)
            split = best >= 0
            number = np.cumsum(split) - 1
            column[active], cut[active] = best, best_cut
            left[active[split]] = made + 2 * np.arange(split.sum())
            kept = np.flatnonzero(split[at])
            m, y, w, count, at = m[kept], y[kept], w[kept], count[kept], at[kept]
            asked = best[at]
            at = 2 * number[at] + goes_right(m[np.arange(len(m)), asked], asked, best_cut[at], numeric)
            born = 2 * int(split.sum())
        else:
            born = 0
        columns.append(column)
        cuts.append(cut)
        lefts.append(left)
        levels.append(levels[-1] + len(total))
        if not born:
            break
        made += born
        totals.append(np.bincount(at * classes + y, w, born * classes).reshape(-1, classes))
        counts = np.bincount(at, count, born)
        # Rows of nodes that cannot split any more leave.
        can = (counts >= 2 * min_leaf) & ((totals[-1] > 0).sum(axis=1) > 1)
        active = np.flatnonzero(can)
        kept = np.flatnonzero(can[at])
        m, y, w, count = m[kept], y[kept], w[kept], count[kept]
        at = (np.cumsum(can) - 1)[at[kept]]
    return _packed(np.concatenate(columns), np.concatenate(cuts), np.concatenate(lefts), np.concatenate(totals), levels)


def _packed(column: np.ndarray, cut: np.ndarray, left: np.ndarray, totals: np.ndarray, levels: list[int]) -> Tree:
    """Nodes without needless leaves, still in order of their level."""
    said = totals.argmax(axis=1)
    for start, end in reversed(list(zip(levels, levels[1:], strict=False))):
        inner = start + np.flatnonzero(column[start:end] >= 0)
        child = left[inner]
        same = inner[(column[child] < 0) & (column[child + 1] < 0) & (said[child] == said[child + 1])]
        column[same] = -1
    keep = np.zeros(len(column), bool)
    keep[0] = True
    for start, end in zip(levels, levels[1:], strict=False):
        inner = start + np.flatnonzero((column[start:end] >= 0) & keep[start:end])
        keep[left[inner]] = keep[left[inner] + 1] = True
    place = np.cumsum(keep) - 1
    column, cut, left, totals, said = column[keep], cut[keep], left[keep], totals[keep], said[keep]
    leaf = column < 0
    left[~leaf] = place[left[~leaf]]
    # The leaves of one class share a row.
    classes = totals.shape[1]
    pure = leaf & ((totals > 0).sum(axis=1) == 1)
    mixed = np.flatnonzero(leaf & ~pure)
    left[pure], left[mixed] = said[pure], classes + np.arange(len(mixed))
    leaves = np.concatenate([np.eye(classes, dtype=np.int32) * WHOLE_SHARE, shares(totals[mixed])])
    return Tree(column.astype(np.int32), cut.astype(np.int32), left.astype(np.int32), leaves)
