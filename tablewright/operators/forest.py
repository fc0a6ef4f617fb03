"""Random forests fitted by counting blocks of rows in numpy, level by level.

The method is that of ``pyspark.ml``: a Poisson number of copies of each row per tree, a random subset of the slots per
node, at most ``maxBins`` bins per slot, the split of the greatest gain in Gini impurity, and leaves of one parent that
predict the same class become one.  There, every row is an object that walks each tree and is added to one counter
after the other, and all rows are kept with their copies per tree, some 0.7 KB each for a hundred trees.  Here rows are
written as blocks of bin numbers, a few bytes each; a task walks all rows of a block through a tree at once and counts
them in a few histograms.  Numbers of copies are drawn anew for every level, from the block's number, so a task that
runs again draws the same.

Bins are cut at quantiles of all rows, where ``pyspark.ml`` takes some 10,000 of them; where a slot has few values, both cut
between all of them.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.session import discard, materialize, share_package

#: Rows of a block, and cells (rows times entries of the fullest row), whichever is reached first.
BLOCK_ROWS = 1 << 17
BLOCK_CELLS = 1 << 22

#: Blocks of a file, which one task reads.
TASK_BLOCKS = 4

#: Entries of vectors that are summed up at a time, and values that stand for those of a slot, if it has more.
SUMMARY_ENTRIES = 1 << 22
SUMMARY_VALUES = 512

#: Entries counted as one if they have at most as many combinations.
JOINT = 1024

#: Levels of a tree that one table of turns covers: it has an entry for every outcome of all their splits.
MOST_DEPTH = 5

#: As in ``pyspark.ml``, which takes more for a mistake.
MOST_CLASSES = 100

#: Slots of the summary that hold no values of the vectors.
LABELS, SIZES = -1, -2

#: Below this an impurity is none, as in ``pyspark.ml``.
EPSILON = np.finfo(float).eps


def takes(estimator: RandomForestClassifier, train: DataFrame) -> bool:
    """Whether :func:`fit` knows these parameters and columns; ``pyspark.ml`` fits the others."""
    attributes = train.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return (
        estimator.getImpurity() == "gini"
        and 1 <= estimator.getMaxDepth() <= MOST_DEPTH
        and estimator.getFeatureSubsetStrategy() in ("auto", "all", "sqrt", "log2", "onethird")
        and (estimator.getBootstrap() or estimator.getSubsamplingRate() == 1.0)
        and estimator.getMinWeightFractionPerNode() == 0.0
        and not estimator.isSet("weightCol")
        and "nominal" not in attributes
        and "ml_attr" not in train.schema[estimator.getLabelCol()].metadata
    )


def fit(estimator: RandomForestClassifier, train: DataFrame) -> Model:
    """The model of ``pyspark.ml`` with these parameters.  ``train`` is read twice."""
    share_package(train.sparkSession)
    rows = train.select(
        F.unwrap_udt(estimator.getFeaturesCol()).alias("vector"), F.col(estimator.getLabelCol()).cast("double").alias("label")
    )
    summary = materialize(rows.mapInArrow(_summarize, "slot int, value double, n double"), "slot-values")
    facts = summary.filter("slot < 0").groupBy("slot", "value").agg(F.sum("n").alias("n")).collect()  # a row per class
    labels = [r["value"] for r in facts if r["slot"] == LABELS]
    classes, total = int(max(labels, default=-1)) + 1, sum(r["n"] for r in facts if r["slot"] == LABELS)
    if not 2 <= classes <= MOST_CLASSES:  # its error, or its model of one class
        return estimator.fit(train)
    size = int(max(r["value"] for r in facts if r["slot"] == SIZES))
    most = int(min(estimator.getMaxBins(), total)) - 1

    def cut(group: pa.Table) -> pa.Table:
        return _cut(total, most, group)

    found = summary.filter("slot >= 0").groupBy("slot").applyInArrow(cut, "slot int, cuts array<double>").collect()
    discard(summary)
    bins = Bins.of(size, {r["slot"]: np.array(r["cuts"]) for r in found})
    encoded = rows.mapInArrow(partial(_encode, bins, classes), "block long, data binary")
    blocks = materialize(encoded, "tree-blocks", TASK_BLOCKS)
    trees = _grow(estimator, blocks, bins, classes)
    discard(blocks)
    return _model(estimator, trees, bins, classes)


# --- bins ------------------------------------------------------------------


class Bins:
    """The cuts of every slot, and the place of every bin in one row of all bins; the last place is for no entry."""

    def __init__(self, cuts: list[np.ndarray]):
        self.cuts = cuts
        counts = np.array([len(c) + 1 for c in cuts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.size = int(self.first[-1])
        self.zero = np.array([np.searchsorted(c, 0.0) for c in cuts], np.int64)
        # The slot and the bin of every place; no slot for the last one.
        self.slot = np.append(np.repeat(np.arange(len(cuts)), counts), -1)
        self.bin = np.append(np.arange(self.size) - np.repeat(self.first[:-1], counts), 0)

    @staticmethod
    def of(size: int, found: dict[int, np.ndarray]) -> Bins:
        return Bins([found.get(i, np.empty(0)) for i in range(size)])


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Entries per row, slots and values of all entries, labels, and the size of the vectors."""
    vectors, labels = batch.columns
    if vectors.null_count or labels.null_count:
        raise ValueError("null in the features or the label")
    kind, size, indices, values = vectors.flatten()
    kind = kind.to_numpy()
    counts = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    slots = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    slots[np.repeat(kind == 0, counts)] = indices.flatten().to_numpy()
    widths = np.where(kind == 0, size.fill_null(0).to_numpy(), counts)
    labels = labels.to_numpy()
    if ((labels < 0) | (labels != np.floor(labels))).any():
        raise ValueError("labels must be whole numbers from 0")
    return counts, slots, values.flatten().to_numpy(), labels, int(widths.max(initial=0))


def _by_slot(slots: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Every slot that has entries, and which these are."""
    small = slots.max(initial=0) < 1 << 15
    order = np.argsort(slots.astype(np.int16) if small else slots, kind="stable")  # short numbers are sorted by their digits
    counts = np.bincount(slots)
    ends = np.cumsum(counts)
    for slot in np.flatnonzero(counts):
        yield int(slot), order[ends[slot] - counts[slot] : ends[slot]]


def _summarize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The values of every slot with their numbers; of many, as many quantiles, each for as many rows."""
    kept, held, labels, widest = [], 0, {}, 0

    def summed() -> pa.RecordBatch:
        slots, values = (np.concatenate(x) for x in zip(*kept, strict=True))
        out = []
        for slot, mine in _by_slot(slots):
            own = np.sort(values[mine])
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            if len(first) > SUMMARY_VALUES:
                at = ((np.arange(SUMMARY_VALUES) + 0.5) * (len(own) / SUMMARY_VALUES)).astype(np.int64)
                found, n = own[at], np.full(SUMMARY_VALUES, len(own) / SUMMARY_VALUES)
            else:
                found, n = own[first], np.diff(np.append(first, len(own)))
            out.append((np.full(len(found), slot), found, n.astype(float)))
        return _summary(*(np.concatenate(x) for x in zip(*out, strict=True)))

    for batch in batches:
        if not batch.num_rows:
            continue
        counts, slots, values, found, width = _entries(batch)
        widest = max(widest, width)
        for value, n in zip(*np.unique(found, return_counts=True)):
            labels[value] = labels.get(value, 0) + n
        number = ~np.isnan(values)
        kept.append((slots[number], values[number]))
        held += len(kept[-1][0])
        if held > SUMMARY_ENTRIES:
            yield summed()
            kept, held = [], 0
    if held:
        yield summed()
    if labels:
        yield _summary(np.full(len(labels), LABELS), np.array([*labels]), np.array([*labels.values()], float))
        yield _summary(np.array([SIZES]), np.array([float(widest)]), np.array([1.0]))


def _summary(slots: np.ndarray, values: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(slots, pa.int32()), pa.array(values, pa.float64()), pa.array(n, pa.float64())], names=["slot", "value", "n"])


def _cut(total: float, most: int, group: pa.Table) -> pa.Table:
    """The cuts of one slot, as ``pyspark.ml`` finds them from values and their numbers."""
    values, place = np.unique(group["value"].to_numpy(), return_inverse=True)
    n = np.bincount(place, group["n"].to_numpy(), len(values))
    absent = total - n.sum()
    if absent > 0.5:  # entries that sparse vectors leave out
        at = int(np.searchsorted(values, 0.0))
        if at < len(values) and values[at] == 0.0:
            n[at] += absent
        else:
            values, n = np.insert(values, at, 0.0), np.insert(n, at, absent)
    middles = values[:-1] / 2 + values[1:] / 2
    if len(middles) > most:
        stride, sums = total / (most + 1), np.cumsum(n)
        target, chosen = stride, []
        for i in range(len(middles)):
            if abs(sums[i] - target) < abs(sums[i + 1] - target):
                chosen.append(i)
                target += stride
        middles = middles[chosen]
    return pa.table({"slot": pa.array([group["slot"][0].as_py()], pa.int32()), "cuts": pa.array([middles.tolist()], pa.list_(pa.float64()))})


# --- blocks ----------------------------------------------------------------


def _encode(bins: Bins, classes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of rows, with numbers of their own."""
    number = (TaskContext.get().partitionId() << 32) if TaskContext.get() else 0
    cells, labels, rows, widest = [], [], 0, 0

    def block() -> pa.RecordBatch:
        wide = np.full((rows, max(1, widest)), bins.size, np.int32)
        at = 0
        for c in cells:
            wide[at : at + len(c), : c.shape[1]] = c
            at += len(c)
        data = pickle.dumps(_joined(wide, np.concatenate(labels), bins.size, classes))
        return pa.record_batch([pa.array([number], pa.int64()), pa.array([data], pa.binary())], names=["block", "data"])

    for batch in batches:
        if not batch.num_rows:
            continue
        counts, slots, values, found, _ = _entries(batch)
        places = np.full(len(slots), bins.size, np.int32)
        for slot, mine in _by_slot(slots):
            if len(bins.cuts[slot]):  # a slot without cuts has nothing to tell
                places[mine] = bins.first[slot] + np.searchsorted(bins.cuts[slot], values[mine])
        width = int(counts.max(initial=0))
        for start in range(0, batch.num_rows, step := max(1, min(BLOCK_ROWS, BLOCK_CELLS // max(1, width)))):
            some = counts[start : start + step]
            if rows and (rows + len(some) > BLOCK_ROWS or (rows + len(some)) * max(width, widest) > BLOCK_CELLS):
                yield block()
                number, cells, labels, rows, widest = number + 1, [], [], 0, 0
            own = np.full((len(some), width), bins.size, np.int32)
            first = int(counts[:start].sum())
            own[np.arange(width) < some[:, None]] = places[first : first + int(some.sum())]
            cells.append(own)
            labels.append(found[start : start + step].astype(np.int64))
            rows, widest = rows + len(some), max(widest, width)
    if rows:
        yield block()


def _joined(wide: np.ndarray, labels: np.ndarray, none: int, classes: int) -> list[tuple[list[np.ndarray], np.ndarray]]:
    """The entries of all rows by their order in the vector, put together into few numbers a row.

    Each is (the places that each of its entries can have, the number: places as digits, and the label as the last).
    """
    alphabets, digits = [], []
    for column in wide.T:
        known = np.flatnonzero(np.bincount(column, minlength=none + 1))
        number = np.zeros(none + 1, np.int64)
        number[known] = np.arange(len(known))
        code = number[column]
        if len(known) > 1 or known[0] != none or not alphabets:
            alphabets.append(known)
            digits.append(code)
    groups: list[list[int]] = []
    for i in sorted(range(len(alphabets)), key=lambda i: -len(alphabets[i])):
        fits = (g for g in groups if len(alphabets[i]) * math.prod(len(alphabets[j]) for j in g) <= JOINT)
        group = next(fits, None)
        if group is None:
            groups.append([i])
        else:
            group.append(i)
    out = []
    for group in groups:
        code = np.zeros(len(labels), np.int64)
        for i in group:
            code = code * len(alphabets[i]) + digits[i]
        code = code * classes + labels
        out.append(([alphabets[i] for i in group], code.astype(np.uint16 if code.max(initial=0) < 1 << 16 else np.uint32)))
    return out


# --- levels ----------------------------------------------------------------


@dataclass(frozen=True)
class Split:
    """A node's rows by class, those of its left child, and how it splits; no slot if it does not."""

    slot: int
    bin: int
    gain: float
    stats: np.ndarray
    left: np.ndarray


@dataclass(frozen=True)
class Open:
    """The nodes of a level of one tree that may split, by place in the level, and the slots drawn for each."""

    places: np.ndarray
    slots: np.ndarray


def _grow(estimator: RandomForestClassifier, blocks: DataFrame, bins: Bins, classes: int) -> list[dict[int, Split]]:
    """The nodes of every tree: the root is 0, the children of i are 2 i + 1 and 2 i + 2."""
    trees, depth, seed, size = estimator.getNumTrees(), estimator.getMaxDepth(), estimator.getSeed(), len(bins.cuts)
    strategy = estimator.getFeatureSubsetStrategy()
    if strategy == "auto":
        strategy = "all" if trees == 1 else "sqrt"
    drawn = {"all": size, "sqrt": math.ceil(math.sqrt(size)), "log2": max(1, math.ceil(math.log2(size))), "onethird": math.ceil(size / 3)}[strategy]
    rate = estimator.getSubsamplingRate() if estimator.getBootstrap() else None
    least = estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
    grown: list[dict[int, Split]] = [{} for _ in range(trees)]
    waiting = {t: [0] for t in range(trees)}
    for level in range(depth):
        first = 2**level - 1
        plan = {}
        for t, nodes in waiting.items():
            slots = [np.sort(np.random.default_rng([seed % 2**63, t, i]).permutation(size)[:drawn]) for i in nodes]
            plan[t] = Open(np.array(nodes) - first, np.array(slots))
        if not plan:
            break
        turns = _Turns.of(level, trees, grown, bins)
        counted = blocks.mapInArrow(partial(_count, bins, classes, turns, seed % 2**63, rate, plan), "tree int, data binary")

        def split(group: pa.Table) -> pa.Table:
            return _split(bins, classes, least, plan, group)

        result = "tree int, place int, slot int, bin int, gain double, stats array<double>, left array<double>"
        found = counted.groupBy("tree").applyInArrow(split, result).collect()
        waiting = {}
        for r in found:  # a row per node
            node = Split(r["slot"], r["bin"], r["gain"], np.array(r["stats"]), np.array(r["left"]))
            i = first + r["place"]
            grown[r["tree"]][i] = node
            if node.slot >= 0:
                sides = (2 * i + 1, node.left), (2 * i + 2, node.stats - node.left)
                waiting.setdefault(r["tree"], []).extend(j for j, stats in sides if _gini(stats) >= EPSILON)
        waiting = {t: sorted(nodes) for t, nodes in waiting.items() if nodes}
    return grown


def _gini(counts: np.ndarray) -> np.ndarray:
    """The impurity of counts by class, the last axis."""
    total = counts.sum(axis=-1)
    out = np.ones(total.shape)
    for k in range(counts.shape[-1]):
        share = counts[..., k] / np.maximum(total, 1)
        out = out - share * share
    return np.where(total > 0, out, 0.0)


@dataclass(frozen=True)
class _Turns:
    """Where rows go at the nodes above a level. All turns of a row in a tree are the bits of one number."""

    level: int
    slots: np.ndarray  # by tree and node
    bins: np.ndarray
    right: np.ndarray  # whether rows without an entry go right

    @staticmethod
    def of(level: int, trees: int, grown: list[dict[int, Split]], bins: Bins) -> _Turns:
        slots, at = np.full((2, trees, 2**level - 1), -2, np.int64)
        for t, nodes in enumerate(grown):
            for i, split in nodes.items():
                if split.slot >= 0 and i < 2**level - 1:
                    slots[t, i], at[t, i] = split.slot, split.bin
        return _Turns(level, slots, at, (slots >= 0) & (bins.zero[np.maximum(slots, 0)] > at))

    def ends(self) -> np.ndarray:
        """The place in the level for every number of turns."""
        turns = np.arange(2 ** (2**self.level - 1))
        node = np.zeros(len(turns), np.int64)
        for _ in range(self.level):
            node = 2 * node + 1 + ((turns >> node) & 1)
        return node - (2**self.level - 1)

    def tables(self, groups: list, bins: Bins, classes: int) -> list[np.ndarray]:
        """For each group of entries the turns by tree and number; together, by exclusive or, they are those of a row."""
        out = []
        for alphabets, _ in groups:
            table = np.zeros((len(self.slots), 1), np.uint16)
            if not out:
                for i in range(self.slots.shape[1]):
                    table[:, 0] |= self.right[:, i].astype(np.uint16) << i
            for known in alphabets:
                flips = np.zeros((len(self.slots), len(known)), np.uint16)
                for i in range(self.slots.shape[1]):
                    other = (bins.bin[known] > self.bins[:, i, None]) != self.right[:, i, None]
                    flips |= ((bins.slot[known] == self.slots[:, i, None]) & other).astype(np.uint16) << i
                table = (table[:, :, None] ^ flips[:, None, :]).reshape(len(table), -1)
            out.append(np.repeat(table, classes, axis=1))
        return out


class _Copies:
    """Poisson numbers of copies, from 16 random bits each; the few bits that leave it open are followed by more."""

    def __init__(self, rate: float):
        shares = [math.exp(-rate)]
        while len(shares) < 100 and sum(shares) < 1 - 1e-17:
            shares.append(shares[-1] * rate / len(shares))
        self.sums = np.cumsum(shares)
        low, high = (np.searchsorted(self.sums, (np.arange(1 << 16) + end) / (1 << 16), side="right") for end in (0, 1 - 2.0**-37))
        self.known = np.where(low == high, low, 255).astype(np.uint8)

    def draw(self, rng: np.random.Generator, rows: int) -> np.ndarray:
        bits = rng.integers(0, 1 << 16, rows, np.uint16)
        copies = self.known[bits]
        unknown = np.flatnonzero(copies == 255)
        exact = (bits[unknown] + rng.random(len(unknown))) / (1 << 16)
        copies[unknown] = np.searchsorted(self.sums, exact, side="right")
        return copies


def _count(
    bins: Bins, classes: int, turns: _Turns, seed: int, rate: float | None, plan: dict[int, Open], batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    """For every tree its rows by open node, bin of the node's slots, and class, after those by node and class."""
    copies = _Copies(rate) if rate is not None else None
    ends = turns.ends()
    nodes, picks, sums = {}, {}, {}
    for t, level in plan.items():
        place = np.full(2**turns.level, len(level.places))
        place[level.places] = np.arange(len(level.places))
        nodes[t] = place[ends].astype(np.uint8)
        # Places of all bins of the drawn slots, node after node.
        counts = np.diff(bins.first)[level.slots].ravel()
        starts = (bins.first[level.slots] + np.arange(len(level.slots))[:, None] * (bins.size + 1)).ravel()
        picks[t] = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("data"), strict=True):
            groups = pickle.loads(data.as_buffer())
            codes = [code.astype(np.intp) for _, code in groups]
            sizes = [[*map(len, alphabets), classes] for alphabets, _ in groups]
            tables = turns.tables(groups, bins, classes) if turns.level else []
            for t, level in plan.items():
                many = len(level.places)
                n, node, use = None, None, None
                if copies is not None:
                    n = copies.draw(np.random.Generator(np.random.SFC64([seed, t, block])), len(codes[0]))
                    use = n > 0
                if turns.level:
                    turn = tables[0][t][codes[0]]
                    for table, code in zip(tables[1:], codes[1:], strict=True):
                        turn ^= table[t][code]
                    node = nodes[t][turn]
                    use = node < many if use is None else use & (node < many)
                rows = slice(None) if use is None else np.flatnonzero(use)
                n = None if n is None else n[rows].astype(float)
                node = None if node is None or many == 1 else node[rows].astype(np.intp)
                full = np.zeros((many, bins.size + 1, classes))
                for (alphabets, _), code, sides in zip(groups, codes, sizes, strict=True):
                    key = code[rows]
                    if node is not None:
                        key += node * math.prod(sides)
                    cells = np.bincount(key, n, many * math.prod(sides)).reshape(many, *sides)
                    axes = range(1, len(sides))
                    for axis, known in zip(axes, alphabets, strict=True):
                        full[:, known] += cells.sum(axis=tuple(a for a in axes if a != axis))
                totals = cells.sum(axis=tuple(axes))
                found = np.concatenate([totals.ravel(), full.reshape(-1, classes)[picks[t]].ravel()])
                sums[t] = sums[t] + found if t in sums else found
    if sums:
        data = pa.array([s.tobytes() for s in sums.values()], pa.binary())
        yield pa.record_batch([pa.array([*sums], pa.int32()), data], names=["tree", "data"])


def _split(bins: Bins, classes: int, least: tuple[int, float], plan: dict[int, Open], group: pa.Table) -> pa.Table:
    """The best split of every open node of one tree."""
    t = group["tree"][0].as_py()
    level = plan[t]
    sums = sum(np.frombuffer(data.as_buffer()) for data in group["data"]).reshape(-1, classes)
    many = len(level.places)
    totals, at, out = sums[:many], many, []
    for place, slots, total in zip(level.places, level.slots, totals, strict=True):
        sizes = np.diff(bins.first)[slots]
        starts = np.cumsum(sizes) - sizes
        counts = sums[at : at + sizes.sum()].copy()
        at += len(counts)
        # What has no entry is in the bin of zero.
        counts[starts + bins.zero[slots]] += total - np.add.reduceat(counts, starts, axis=0)
        upto = np.cumsum(counts, axis=0)
        upto -= np.repeat(upto[starts] - counts[starts], sizes, axis=0)
        inner = np.ones(len(counts), bool)
        inner[starts + sizes - 1] = False
        ends = np.flatnonzero(inner)
        left = upto[ends]
        right = total - left
        all_rows = max(total.sum(), 1)
        gain = _gini(total) - left.sum(axis=1) / all_rows * _gini(left) - right.sum(axis=1) / all_rows * _gini(right)
        gain[(left.sum(axis=1) < least[0]) | (right.sum(axis=1) < least[0]) | (gain < least[1])] = -1.0
        best = int(np.argmax(gain)) if len(gain) else -1
        if best < 0 or gain[best] <= 0:
            out.append((t, int(place), -1, -1, 0.0, total.tolist(), total.tolist()))
            continue
        own = int(np.searchsorted(starts, ends[best], side="right")) - 1
        # Slots without cuts share a start with none, so the last start is the slot's.
        out.append((t, int(place), int(slots[own]), int(ends[best] - starts[own]), float(gain[best]), total.tolist(), left[best].tolist()))
    kinds = [pa.int32()] * 4 + [pa.float64()] + [pa.list_(pa.float64())] * 2
    names = ["tree", "place", "slot", "bin", "gain", "stats", "left"]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


# --- the model -------------------------------------------------------------


def _model(estimator: RandomForestClassifier, grown: list[dict[int, Split]], bins: Bins, classes: int) -> Model:
    """The trees as a model of ``pyspark.ml``, put together by its own constructors."""
    spark = SparkSession.getActiveSession()
    gateway, jvm = spark.sparkContext._gateway, spark._jvm
    ml = jvm.org.apache.spark.ml
    # Looked up once, as each lookup asks the JVM.
    number, new_array = jvm.double, gateway.new_array
    calculator = jvm.org.apache.spark.mllib.tree.impurity.GiniCalculator
    leaf_node, inner_node, below = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    kind = ml.classification.DecisionTreeClassificationModel

    def counted(stats: np.ndarray):
        values = new_array(number, classes)
        for k, n in enumerate(stats.tolist()):
            values[k] = n
        return calculator(values, int(stats.sum()))

    def node(nodes: dict[int, Split], i: int, stats: np.ndarray):
        """(class, make) of a node; make is called for nodes that stay."""
        own, split = float(np.argmax(stats)), nodes.get(i)

        def leaf():
            return leaf_node(own, float(_gini(stats)), counted(stats))

        if split is None or split.slot < 0:
            return own, True, leaf
        left, right = node(nodes, 2 * i + 1, split.left), node(nodes, 2 * i + 2, stats - split.left)
        if left[1] and right[1] and left[0] == right[0]:
            return own, True, leaf

        def inner():
            test = below(split.slot, float(bins.cuts[split.slot][split.bin]))
            return inner_node(own, float(_gini(stats)), split.gain, left[2](), right[2](), test, counted(stats))

        return own, False, inner

    trees = gateway.new_array(kind, len(grown))
    for t, nodes in enumerate(grown):
        _, _, make = node(nodes, 0, nodes[0].stats)
        trees[t] = kind(f"{estimator.uid}_{t}", make(), len(bins.cuts), classes)
    estimator._transfer_params_to_java()
    model = ml.classification.RandomForestClassificationModel(estimator.uid, trees, len(bins.cuts), classes)
    estimator._java_obj.copyValues(model.setParent(estimator._java_obj), ml.param.ParamMap())
    return estimator._copyValues(estimator._create_model(model))
