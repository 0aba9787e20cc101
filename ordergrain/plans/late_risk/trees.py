"""Growing one decision tree inside a task, as Spark grows it.

Spark grows a tree by a job a level, over rows as objects. Here a task has the drawn rows of one tree as arrays and
grows all levels by counting. The rules are Spark's: candidates of a split from weighted quantiles of 10,000 sampled
rows, features of a node by its reservoir sampling, the first of equal gains, a leaf's least rows, and a split whose
leaves predict the same becomes a leaf. So a tree of rows in one partition is Spark's tree to the last bit; rows of
several partitions are added up in another order, which decides between equal gains in another way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BINS = 32
SAMPLED_ROWS = 10_000
# Bins of so many nodes, and row and feature pairs, are held at once.
NODES_AT_ONCE = 2_048
PAIRS_AT_ONCE = 1 << 18
_EPSILON = 2.0**-52
_XX_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
_LOW_32, _LOW_64 = 0xFFFFFFFF, 0xFFFFFFFFFFFFFFFF

WIDE = "wide array<int>, features int, rows long"
PACKED = "is_late int, row long, part int, features binary"
NODES = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, leftChild int, "
    "rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
)


# --- Spark's random numbers ---------------------------------------------------------------------


def _murmur(words: Iterable[np.ndarray], seed: np.ndarray) -> np.ndarray:
    """MurmurHash3 of two words of 32 bits, for each seed."""
    h = seed
    for k in words:
        k = (k * np.uint64(0xCC9E2D51)) & np.uint64(_LOW_32)
        k = ((k << np.uint64(15)) | (k >> np.uint64(17))) & np.uint64(_LOW_32)
        h = h ^ ((k * np.uint64(0x1B873593)) & np.uint64(_LOW_32))
        h = ((h << np.uint64(13)) | (h >> np.uint64(19))) & np.uint64(_LOW_32)
        h = (h * np.uint64(5) + np.uint64(0xE6546B64)) & np.uint64(_LOW_32)
    h = h ^ np.uint64(8)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = ((h ^ (h >> np.uint64(shift))) * np.uint64(factor)) & np.uint64(_LOW_32)
    return h ^ (h >> np.uint64(16))


class XorShift:
    """Spark's XORShiftRandom, one for each seed."""

    def __init__(self, seeds: np.ndarray) -> None:
        swapped = seeds.astype(np.uint64).byteswap()
        words = (swapped & np.uint64(_LOW_32), swapped >> np.uint64(32))
        low = _murmur(words, np.full(len(seeds), 0x3C074A61, np.uint64))
        self.state = (_murmur(words, low) << np.uint64(32)) | low

    def bits(self, number: int) -> np.ndarray:
        s = self.state
        s = s ^ (s << np.uint64(21))
        s = s ^ (s >> np.uint64(35))
        self.state = s = s ^ (s << np.uint64(4))
        return s & np.uint64((1 << number) - 1)

    def doubles(self) -> np.ndarray:
        high = self.bits(26) << np.uint64(27)
        return (high + self.bits(27)).astype(np.float64) * 2.0**-53

    def series(self) -> Iterator[float]:
        """The doubles of the first seed, one by one."""
        s = int(self.state[0])
        while True:
            value = 0
            for bits in (26, 27):
                s ^= (s << 21) & _LOW_64
                s ^= s >> 35
                s ^= (s << 4) & _LOW_64
                value = (value << bits) + (s & ((1 << bits) - 1))
            yield value * 2.0**-53


def _xxhash(first: np.ndarray, *others: int) -> np.ndarray:
    """Spark's xxhash64 of a long and ints after it."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in _XX_PRIMES)

    def rotated(value: np.ndarray, by: int) -> np.ndarray:
        return (value << np.uint64(by)) | (value >> np.uint64(64 - by))

    def mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))

    start = np.array([(42 + _XX_PRIMES[4] + 8) & _LOW_64], np.uint64)
    h = mixed(rotated(start ^ (rotated(first.view(np.uint64) * p2, 31) * p1), 27) * p1 + p4)
    for other in others:
        h = mixed(rotated((h + p5 + np.uint64(4)) ^ (np.array([other], np.uint64) * p1), 23) * p2 + p3)
    return h


def draws(row: np.ndarray, tree: int, seed: int, shares: list[float]) -> np.ndarray:
    """How often a tree draws the rows, as ``train.draws`` has it; ``shares`` are the chances of so many or fewer."""
    chance = (_xxhash(row, tree, seed) & np.uint64((1 << 52) - 1)).astype(np.float64) / float(1 << 52)
    return np.searchsorted(np.array(shares), chance, "right")


class JavaRandom:
    """java.util.Random."""

    def __init__(self, seed: int) -> None:
        self.state = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def long(self) -> int:
        """The next long, as its 64 bits."""
        parts = []
        for _ in range(2):
            self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
            parts.append(self.state >> 16)
        high, low = parts
        return ((high << 32) + (low - (1 << 32) if low >> 31 else low)) & _LOW_64


def feature_subsets(seeds: list[int], features: int, chosen: int) -> np.ndarray:
    """The features that each node may split by, by reservoir sampling, in its order."""
    subsets = np.tile(np.arange(chosen), (len(seeds), 1))
    random = XorShift(np.array(seeds, np.uint64))
    for feature in range(chosen, features):
        place = (random.doubles() * (feature + 1)).astype(np.int64)
        hit = np.flatnonzero(place < chosen)
        subsets[hit, place[hit]] = feature
    return subsets


def sampled_places(parts: list[int], fraction: float, seed: int) -> np.ndarray:
    """Which rows Spark samples of partitions of the given sizes."""
    first = XorShift(np.array([seed], np.uint64)).bits(32)[0]
    by_part = JavaRandom(int(np.array([first], np.uint64).astype(np.uint32).view(np.int32)[0]))
    found, begin = [], 0
    for size in parts:
        random = XorShift(np.array([by_part.long()], np.uint64)).series()
        if fraction <= 0.4:  # jumps from one sampled row to the next
            places, at, factor = [], -1, math.log1p(-fraction)
            while (at := at + 1 + int(math.log(max(next(random), 5e-11)) / factor)) < size:
                places.append(at)
        else:
            places = [k for k, chance in zip(range(size), random) if chance <= fraction]
        found.append(np.array(places, np.int64) + begin)
        begin += size
    return np.concatenate(found)


# --- rows ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """How a row's features are packed: the ``wide`` ones as doubles, the others, which are 0 or 1, as bits.

    Of the others, ``categories`` are split as two categories, the side with less late weight first.
    """

    wide: tuple[int, ...]
    flags: tuple[int, ...]
    categories: tuple[int, ...] = ()

    @property
    def row_bytes(self) -> int:
        return 8 * len(self.wide) + -(-len(self.flags) // 8)


def _dense(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def wide_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of a partition that have another value than 0 and 1, the number of features and that of rows."""
    found: np.ndarray | None = None
    number = 0
    for batch in batches:
        number += batch.num_rows
        if batch.num_rows:
            values = _dense(batch.column("features"))
            other = ((values != 0.0) & (values != 1.0)).any(axis=0)
            found = other if found is None else found | other
    if found is not None:
        wide = pa.array([np.flatnonzero(found).tolist()], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([wide, pa.array([len(found)], pa.int32()), pa.array([number])], ["wide", "features", "rows"])


def packed(layout: Layout, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their features as bytes."""
    for batch in batches:
        if batch.num_rows:
            values = _dense(batch.column("features"))
            numbers = np.ascontiguousarray(values[:, list(layout.wide)]).view(np.uint8).reshape(len(values), -1)
            bits = np.packbits(values[:, list(layout.flags)] == 1.0, axis=1) if layout.flags else np.zeros((len(values), 0), np.uint8)
            flat = np.ascontiguousarray(np.hstack([numbers, bits]))
            offsets = np.arange(len(values) + 1, dtype=np.int32) * layout.row_bytes
            features = pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
            kept = ["is_late", "row", "part"]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), features], [*kept, "features"])


@dataclass
class DrawnRows:
    """The rows of one tree: class, weight and packed features, and how many each partition has."""

    late: np.ndarray
    weight: np.ndarray
    packed: np.ndarray
    parts: list[int]


def drawn_rows(layout: Layout, batches: Iterable[pa.RecordBatch], times: Callable[[np.ndarray], np.ndarray], weights: dict[int, float]) -> DrawnRows:
    """The packed rows that are drawn by ``times``, each with its class's weight as often as it is drawn."""
    late, weight, rows, parts = [], [], [], {}
    for batch in batches:
        if batch.num_rows:
            labels = batch.column("is_late").to_numpy()
            weighted = times(batch.column("row").to_numpy()) * np.where(labels == 1, weights.get(1, 0.0), weights.get(0, 0.0))
            drawn = np.flatnonzero(weighted > 0)
            part, sizes = np.unique(batch.column("part").to_numpy()[drawn], return_counts=True)
            for p, n in zip(part.tolist(), sizes.tolist()):
                parts[p] = parts.get(p, 0) + n
            late.append((labels[drawn] == 1).astype(np.int8))
            weight.append(weighted[drawn])
            features = batch.column("features")
            begin = np.frombuffer(features.buffers()[1], np.int32)[features.offset]
            size = len(features) * layout.row_bytes
            rows.append(np.frombuffer(features.buffers()[2], np.uint8)[begin : begin + size].reshape(len(features), -1)[drawn])
    sizes = [parts.get(p, 0) for p in range(max(parts) + 1)]
    return DrawnRows(np.concatenate(late), np.concatenate(weight), np.concatenate(rows), sizes)


def thresholds(values: np.ndarray, weights: np.ndarray, expected: float, bins: int) -> np.ndarray:
    """The candidates of a feature from sampled rows, whose weights should add up to ``expected``."""
    other = values != 0.0
    if not other.any():
        return np.zeros(0)
    distinct, place = np.unique(values[other], return_inverse=True)
    counts = np.bincount(place, weights=weights[other])
    # Rows with 0 are counted as what is missing.
    missing = expected - math.fsum(counts.tolist())
    if missing > _EPSILON * int(other.sum()) * 100:
        at = int(np.searchsorted(distinct, 0.0))
        distinct, counts = np.insert(distinct, at, 0.0), np.insert(counts, at, missing)
    middles = (distinct[:-1] + distinct[1:]) / 2.0
    if len(middles) <= bins - 1:
        return middles
    stride = expected / bins
    found, target = [], stride
    sums = np.cumsum(counts).tolist()
    for index in range(1, len(sums)):
        if abs(sums[index - 1] - target) < abs(sums[index] - target):
            found.append(middles[index - 1])
            target += stride
    return np.array(found)


def binned(rows: DrawnRows, layout: Layout, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bin of every row and feature, and the candidates of each feature."""
    number = len(rows.late)
    bins = min(BINS, number)
    needed = max(bins * bins, SAMPLED_ROWS)
    fraction = needed / number if needed < number else 1.0
    sample = sampled_places(rows.parts, fraction, seed) if fraction < 1.0 else np.arange(number)
    total = float(np.cumsum(rows.weight)[-1])
    weights, expected = rows.weight[sample], fraction * total
    splits: list[np.ndarray] = [np.zeros(0)] * (len(layout.wide) + len(layout.flags))
    matrix = np.empty((number, len(splits)), np.uint8)
    for k, feature in enumerate(layout.wide):
        values = np.ascontiguousarray(rows.packed[:, 8 * k : 8 * k + 8]).view(np.float64).reshape(-1)
        splits[feature] = thresholds(values[sample], weights, expected, bins)
        matrix[:, feature] = np.searchsorted(splits[feature], values)
    for k, feature in enumerate(layout.flags):
        byte = rows.packed[:, 8 * len(layout.wide) + k // 8]
        values = (byte >> np.uint8(7 - k % 8)) & np.uint8(1)
        if feature in layout.categories:
            splits[feature], matrix[:, feature] = np.zeros(1), values
            continue
        splits[feature] = thresholds(values[sample].astype(np.float64), weights, expected, bins)
        matrix[:, feature] = np.searchsorted(splits[feature], [0.0, 1.0]).astype(np.uint8)[values]
    return matrix, splits


# --- growing ---------------------------------------------------------------------------------------


def _gini(none: np.ndarray, late: np.ndarray) -> np.ndarray:
    total = none + late
    with np.errstate(invalid="ignore", divide="ignore"):
        one, other = none / total, late / total
        return np.where(total == 0, 0.0, (1.0 - one * one) - other * other)


def _histograms(matrix: np.ndarray, key: np.ndarray, weight: np.ndarray, subsets: np.ndarray, bounds: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight and number of rows by node, place of the feature, bin and class; the rows lie node by node."""
    nodes, chosen = subsets.shape
    cells = nodes * chosen * bins * 2
    weights, rows = np.zeros(cells), np.zeros(cells, np.int64)
    places = np.arange(chosen) * (bins * 2)
    begin = 0
    while begin < nodes:  # whole nodes, so that each node's weights are added up in the order of its rows
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + PAIRS_AT_ONCE // chosen, "right")) - 1)
        end = min(end, nodes)
        low, high = int(bounds[begin]), int(bounds[end])
        node = np.repeat(np.arange(end - begin), np.diff(bounds[begin : end + 1]))
        cell = subsets[begin + node]
        cell += (np.arange(low, high) * matrix.shape[1])[:, None]
        at = matrix.reshape(-1).take(cell).astype(np.int64)
        at *= 2
        at += (node * (chosen * bins * 2) + key[low:high])[:, None]
        at += places
        at = at.reshape(-1)
        size = (end - begin) * chosen * bins * 2
        part = slice(begin * chosen * bins * 2, begin * chosen * bins * 2 + size)
        weights[part] = np.bincount(at, weights=np.repeat(weight[low:high], chosen), minlength=size)
        rows[part] = np.bincount(at, minlength=size)
        begin = end
    shape = (nodes, chosen, bins, 2)
    return weights.reshape(shape), rows.reshape(shape)


@dataclass
class Found:
    """The best split of each node of a group; ``gain`` is minus infinity where none is allowed."""

    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    left_rows: np.ndarray
    turned: np.ndarray
    root: np.ndarray


def _best(
    weights: np.ndarray, rows: np.ndarray, subsets: np.ndarray, splits: np.ndarray, category: np.ndarray, impurity: np.ndarray | None, least: int
) -> Found:
    """The first of the best splits, by feature in the order of the subset, then by bin."""
    nodes, chosen, bins = weights.shape[:3]
    share = np.where(weights[:, :, :2].sum(axis=3) != 0, weights[:, :, :2, 1], np.inf)
    turned = category[subsets] & (share[:, :, 1] < share[:, :, 0])
    for counted in (weights, rows):
        counted[turned, :2] = counted[turned, 1::-1]
    sums = np.cumsum(weights, axis=2)
    counts = np.cumsum(rows.sum(axis=3), axis=2)
    left, whole = sums[:, :, :-1, :], sums[:, :, -1:, :]
    right = whole - left
    left_rows, right_rows = counts[:, :, :-1], counts[:, :, -1:] - counts[:, :, :-1]
    candidate = np.arange(bins - 1) < splits[subsets][:, :, None]
    root = np.zeros(2)
    if impurity is None:  # Spark adds up the two sides of the first candidate
        first = np.flatnonzero(splits[subsets[0]] > 0)
        k = int(first[0]) if len(first) else 0
        root = left[0, k, 0] + right[0, k, 0] if len(first) else whole[0, 0, 0]
        impurity = _gini(root[:1], root[1:])
    left_weight, right_weight = left[..., 0] + left[..., 1], right[..., 0] + right[..., 1]
    total = left_weight + right_weight
    with np.errstate(invalid="ignore", divide="ignore"):
        gain = impurity[:, None, None] - left_weight / total * _gini(left[..., 0], left[..., 1])
        gain -= right_weight / total * _gini(right[..., 0], right[..., 1])
    allowed = candidate & (left_rows >= least) & (right_rows >= least)
    with np.errstate(invalid="ignore"):
        gain = np.where(allowed & (gain >= 0.0), gain, -np.inf).reshape(nodes, -1)
    best = gain.argmax(axis=1)
    node, place, bin_ = np.arange(nodes), best // (bins - 1), best % (bins - 1)
    return Found(
        gain[node, best], subsets[node, place], bin_, left[node, place, bin_], right[node, place, bin_], left_rows[node, place, bin_],
        turned[node, place], root,
    )


@dataclass
class Tree:
    """The nodes, parents before children; ``feature`` is -1 at a leaf. ``threshold`` is the left one of two categories."""

    feature: np.ndarray
    category: np.ndarray
    threshold: np.ndarray
    gain: np.ndarray
    impurity: np.ndarray
    classes: np.ndarray
    rows: np.ndarray
    left: np.ndarray
    right: np.ndarray


def grown(rows: DrawnRows, layout: Layout, seed: int, depth: int, least: int, per_node: int) -> Tree:
    """The tree of the drawn rows. ``per_node`` features are looked at for a node."""
    matrix, splits = binned(rows, layout, seed)
    late, weight = rows.late.astype(np.int64), rows.weight
    rows.packed = np.zeros((0, 0), np.uint8)  # its memory is free
    features = matrix.shape[1]
    numbers = np.array([len(s) for s in splits])
    category = np.zeros(features, bool)
    category[list(layout.categories)] = True
    most = max(int(numbers.max()), 1)  # Spark's quantiles may be one more than its bins
    padded = np.zeros((features, most))
    for k, s in enumerate(splits):
        padded[k, : len(s)] = s
    random = JavaRandom(seed)
    levels: list[dict[str, np.ndarray]] = []
    # The nodes of a level that may be split, in the order in which Spark takes them from its stack.
    classes = np.bincount(late, weights=weight, minlength=2).reshape(1, 2)
    sizes, impurity = np.array([len(late)]), None
    made = 1
    ids, begun = np.array([0]), np.array([0, len(late)])
    nodes: dict[str, list[np.ndarray]] = {name: [] for name in ("id", "feature", "threshold", "gain", "impurity", "valid", "left", "right")}
    stats: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # id, classes, rows of every node
    for level in range(depth + 1):
        number = len(ids)
        if not number or level == depth:
            if number:  # a tree of depth 0 is a leaf
                stats.append((ids, classes, sizes))
            break
        if per_node < features:
            subsets = feature_subsets([random.long() for _ in range(number)], features, per_node)
        else:
            subsets = np.tile(np.arange(features), (number, 1))
        gain, feature, bin_ = np.full(number, -np.inf), np.zeros(number, np.int64), np.zeros(number, np.int64)
        left, right, left_rows = np.zeros((number, 2)), np.zeros((number, 2)), np.zeros(number, np.int64)
        turned = np.zeros(number, bool)
        tried = np.flatnonzero(np.diff(begun))
        for at in range(0, len(tried), NODES_AT_ONCE):
            some = tried[at : at + NODES_AT_ONCE]
            part = slice(begun[some[0]], begun[some[-1] + 1])
            bounds = np.concatenate([begun[some], [part.stop]]) - part.start
            sums, counts = _histograms(matrix[part], late[part], weight[part], subsets[some], bounds, most + 1)
            found = _best(sums, counts, subsets[some], numbers, category, None if impurity is None else impurity[some], least)
            gain[some], feature[some], bin_[some] = found.gain, found.feature, found.bin
            left[some], right[some], left_rows[some], turned[some] = found.left, found.right, found.left_rows, found.turned
            if impurity is None:
                classes = found.root.reshape(1, 2)
        if impurity is None:
            impurity = _gini(classes[:, 0], classes[:, 1])
        if level == 0:
            stats.append((ids, classes, sizes))
        inner = np.flatnonzero(gain > 0)
        children = np.full((number, 2), -1, np.int64)
        children[inner, 0] = made + 2 * np.arange(len(inner))
        children[inner, 1] = children[inner, 0] + 1
        made += 2 * len(inner)
        is_inner = gain > 0
        nodes["id"].append(ids)
        nodes["feature"].append(np.where(is_inner, feature, -1))
        threshold = np.where(category[feature], turned, padded[feature, np.minimum(bin_, most - 1)])
        nodes["threshold"].append(np.where(is_inner, threshold, 0.0))
        nodes["gain"].append(np.where(is_inner, gain, -1.0))
        nodes["impurity"].append(impurity)
        nodes["valid"].append(np.isfinite(gain))
        nodes["left"].append(children[:, 0])
        nodes["right"].append(children[:, 1])
        # Both children of every split, left before right.
        child_ids = children[inner].reshape(-1)
        child_classes = np.stack([left[inner], right[inner]], axis=1).reshape(-1, 2)
        child_rows = np.stack([left_rows[inner], sizes[inner] - left_rows[inner]], axis=1).reshape(-1)
        child_impurity = _gini(child_classes[:, 0], child_classes[:, 1])
        stats.append((child_ids, child_classes, child_rows))
        go_on = (np.abs(child_impurity) >= _EPSILON) & (level + 1 < depth)
        # Rows of the nodes that go on, child by child in Spark's order, which is the reverse; a node's rows keep theirs.
        # A node with fewer rows than two leaves has no split that is allowed, so its rows are left out.
        order = np.flatnonzero(go_on)[::-1]
        held = np.where(child_rows[order] >= 2 * least, child_rows[order], 0)
        node_of = np.repeat(np.arange(number), np.diff(begun))
        goes_right = matrix[np.arange(len(node_of)), feature[node_of]] > bin_[node_of]
        goes_right ^= turned[node_of]
        rank = np.full((number, 2), -1, np.int64)
        slot = np.full(len(child_ids), -1, np.int64)
        slot[order] = np.where(held > 0, np.arange(len(order)), -1)
        rank[inner] = slot.reshape(-1, 2)
        to = rank[node_of, goes_right.astype(np.int64)]
        stay = np.flatnonzero(to >= 0)
        moved = stay[np.argsort(to[stay], kind="stable")]
        matrix, late, weight = matrix[moved], late[moved], weight[moved]
        ids, classes, sizes, impurity = child_ids[order], child_classes[order], child_rows[order], child_impurity[order]
        begun = np.concatenate([[0], np.cumsum(held)])
    return _pruned(made, nodes, stats, category)


def _pruned(made: int, nodes: dict[str, list[np.ndarray]], stats: list[tuple[np.ndarray, np.ndarray, np.ndarray]], category: np.ndarray) -> Tree:
    """The tree without splits whose two sides predict the same."""
    at = np.concatenate([s[0] for s in stats])
    classes, rows = np.empty((made, 2)), np.empty(made, np.int64)
    classes[at], rows[at] = np.concatenate([s[1] for s in stats]), np.concatenate([s[2] for s in stats])
    feature, left, right = (np.full(made, -1, np.int64) for _ in range(3))
    threshold, gain, impurity = np.zeros(made), np.full(made, -1.0), _gini(classes[:, 0], classes[:, 1])
    if nodes["id"]:
        split = np.concatenate(nodes["id"])
        for array, name in ((feature, "feature"), (threshold, "threshold"), (gain, "gain"), (left, "left"), (right, "right")):
            array[split] = np.concatenate(nodes[name])
        impurity[split] = np.where(np.concatenate(nodes["valid"]), np.concatenate(nodes["impurity"]), -1.0)
    late = classes[:, 1] > classes[:, 0]  # the first of equal classes
    for ids, splits in reversed(list(zip(nodes["id"], nodes["feature"]))):  # from the deepest level up
        inner = ids[splits >= 0]
        one, other = left[inner], right[inner]
        same = inner[(feature[one] < 0) & (feature[other] < 0) & (late[one] == late[other])]
        feature[same], left[same], right[same], gain[same], threshold[same] = -1, -1, -1, -1.0, 0.0
    keep = np.zeros(made, bool)
    keep[0] = True
    for ids in nodes["id"]:  # children of what is kept
        inner = ids[(feature[ids] >= 0) & keep[ids]]
        keep[left[inner]] = keep[right[inner]] = True
    place = np.cumsum(keep) - 1
    inner = feature >= 0
    left, right = (np.where(inner, place[np.maximum(side, 0)], -1) for side in (left, right))
    return Tree(*(array[keep] for array in (feature, inner & category[feature], threshold, gain, impurity, classes, rows, left, right)))


def node_table(tree: Tree) -> pa.RecordBatch:
    """The nodes as Spark saves them."""
    number, inner = len(tree.feature), tree.feature >= 0
    stats = pa.ListArray.from_arrays(pa.array(2 * np.arange(number + 1), pa.int32()), pa.array(tree.classes.reshape(-1)))
    ends = pa.array(np.concatenate([[0], np.cumsum(inner)]), pa.int32())
    split = pa.StructArray.from_arrays(
        [pa.array(tree.feature, pa.int32()), pa.ListArray.from_arrays(ends, pa.array(tree.threshold[inner])), pa.array(np.where(tree.category, 2, -1), pa.int32())],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    columns = [
        pa.array(np.arange(number), pa.int32()), pa.array((tree.classes[:, 1] > tree.classes[:, 0]).astype(np.float64)), pa.array(tree.impurity),
        stats, pa.array(tree.rows), pa.array(tree.gain), pa.array(tree.left, pa.int32()), pa.array(tree.right, pa.int32()), split,
    ]
    names = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"]
    return pa.RecordBatch.from_arrays(columns, names)
