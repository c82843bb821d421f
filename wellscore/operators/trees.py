"""Regression forests and boosted trees grown in numpy over binned rows, returned as Spark ML models.

The method is that of Spark ML's trainers: thresholds from a sample of rows, at most ``maxBins`` bins a feature,
level by level the split of largest variance reduction, Poisson bootstraps of a forest, boosting on twice the
residual. What differs is where the work is done. Rows are binned once and written in blocks; several features of
few bins share one code, so that one pass over the codes counts them together. A fit of at most ``LOCAL_ROWS`` rows
needs no job per level: a task reads the blocks and grows whole trees.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import regression as ml
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellscore.session import scratch_path

#: Rows of a fit (or of a forest's subtree) that one task holds: some 100 bytes each while a tree grows.
LOCAL_ROWS = 1_000_000

#: Rows of a block, and states of a code shared by features.
BLOCK_ROWS = 65_536
CODE_STATES = 1024

#: Rows that are counted at a time, at least.
PART_ROWS = 16_384


def thresholds(values: np.ndarray, max_bins: int = 32, expected: float | None = None) -> np.ndarray:
    """Where to cut a feature, from sampled values: every midpoint, or where cumulative counts come closest to equal shares.

    As in Spark ML, what is missing to the ``expected`` number of values counts as zeros."""
    values = values[~np.isnan(values)]
    v, n = np.unique(values[values != 0.0], return_counts=True)
    zeros = (len(values) if expected is None else expected) - n.sum()
    if zeros > 2.2e-14 * max(n.sum(), 1):
        at = np.searchsorted(v, 0.0)
        v, n = np.insert(v, at, 0.0), np.insert(n.astype(float), at, zeros)
    mid = (v[:-1] + v[1:]) / 2.0
    if len(mid) <= max_bins - 1:
        return mid
    out, seen, stride = [], np.cumsum(n), n.sum() / max_bins
    target = stride
    for i in range(1, len(v)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            out.append(mid[i - 1])
            target += stride
    return np.array(out)


@dataclass(frozen=True)
class Layout:
    """Cuts of all features, and the features that share a code: (feature, bins, stride) of every code."""

    cuts: list[np.ndarray]
    codes: list[list[tuple[int, int, int]]]

    @classmethod
    def of(cls, cuts: list[np.ndarray]) -> Layout:
        codes: list[list] = []
        states: list[int] = []
        for f in sorted(range(len(cuts)), key=lambda f: -len(cuts[f])):
            bins = len(cuts[f]) + 1
            if bins == 1:  # a constant feature splits nothing
                continue
            g = next((g for g, s in enumerate(states) if s * bins <= CODE_STATES), len(states))
            if g == len(states):
                codes.append([])
                states.append(1)
            codes[g].append((f, bins, states[g]))
            states[g] *= bins
        return cls(cuts, codes)

    @property
    def bins(self) -> int:
        return max((len(c) + 1 for c in self.cuts), default=1)

    def states(self, g: int) -> int:
        return self.codes[g][-1][1] * self.codes[g][-1][2]

    def place(self, f: int) -> tuple[int, int, int]:
        """(code, bins, stride) of a feature."""
        return next((g, bins, stride) for g, code in enumerate(self.codes) for at, bins, stride in code if at == f)

    def encode(self, x: np.ndarray) -> np.ndarray:
        """(codes x rows) of (rows x features); a missing value goes with the largest ones."""
        out = np.zeros((len(self.codes), len(x)), np.uint16)
        for g, code in enumerate(self.codes):
            for f, _, stride in code:
                out[g] += (np.searchsorted(self.cuts[f], x[:, f], side="left") * stride).astype(np.uint16)
        return out


@dataclass
class Rows:
    """Binned rows: codes x rows, and bins one by one (features with cuts x rows) if ``apart``."""

    layout: Layout
    codes: np.ndarray
    apart: dict[int, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        self.n = self.codes.shape[1]
        self.flat = self.codes.ravel()

    def separate(self) -> None:
        for g, code in enumerate(self.layout.codes):
            for f, bins, stride in code:
                self.apart[f] = (self.codes[g] // stride % bins).astype(np.uint8)

    def take(self, rows: np.ndarray) -> Rows:
        return Rows(self.layout, np.take(self.codes, rows, axis=1), {f: x[rows] for f, x in self.apart.items()})


class Sums:
    """What the next split needs: per node weight, sum and sum of squares, and both per bin, added up part by part.

    Parts are small enough for a core's cache."""

    def __init__(self, layout: Layout, k: int, apart: bool, last: bool):
        self.layout, self.k, self.apart = layout, k, apart
        self.states = layout.bins if apart else CODE_STATES
        self.part = max(PART_ROWS, 4 * (k + 1) * self.states)
        self.stats = np.zeros((3, k + 1))
        self.keys = [] if last else [f for code in layout.codes for f, _, _ in code] if apart else list(range(len(layout.codes)))
        self.tables = np.zeros((2, len(self.keys), (k + 1) * self.states))

    def add(self, rows: Rows, lo: int, node: np.ndarray, v: np.ndarray, y: np.ndarray, w: np.ndarray | None) -> None:
        """Rows from ``lo`` on, as many as ``node`` has; node k is no node. v: values ``y`` times weights."""
        hi = lo + len(node)
        for s, x in enumerate((w, v, v * y)):
            self.stats[s] += np.bincount(node, x, self.k + 1)
        base = node * self.states
        at = np.empty_like(base)
        for j, key in enumerate(self.keys):
            np.add(base, rows.apart[key][lo:hi] if self.apart else rows.codes[key, lo:hi], out=at)
            self.tables[0, j] += np.bincount(at, w, self.tables.shape[2])
            self.tables[1, j] += np.bincount(at, v, self.tables.shape[2])

    def histograms(self) -> np.ndarray:
        """(2 x k x features x bins)"""
        lay, k = self.layout, self.k
        out = np.zeros((2, k, len(lay.cuts), lay.bins))
        for j, key in enumerate(self.keys):
            table = self.tables[:, j].reshape(2, k + 1, self.states)[:, :k]
            if self.apart:
                out[:, :, key] = table
                continue
            code = lay.codes[key][::-1]
            table = table[:, :, : lay.states(key)].reshape(2, k, *[b for _, b, _ in code])
            for i, (f, b, _) in enumerate(code):
                out[:, :, f, :b] = table.sum(tuple(a + 2 for a in range(len(code)) if a != i))
        return out


@dataclass
class Level:
    """The splits of a level: its nodes' codes, which states of them go right, and the place of both children in the next."""

    code: np.ndarray
    right: np.ndarray
    child: np.ndarray

    def move(self, rows: Rows, lo: int, node: np.ndarray) -> np.ndarray:
        at = self.code.take(node) * rows.n
        at += np.arange(lo, lo + len(node))
        state = node * self.right.shape[1] + rows.flat.take(at)
        return self.child.take(2 * node + self.right.ravel().take(state))


class Tree:
    """A tree that grows level by level from histograms."""

    def __init__(self, layout: Layout, depth: int, min_rows: int = 1, tried: int | None = None, rng: np.random.Generator | None = None):
        self.layout, self.depth, self.min_rows, self.tried, self.rng = layout, depth, min_rows, tried, rng
        self.feature, self.cut, self.left, self.right = [np.array([-1])], [np.array([np.nan])], [np.array([-1])], [np.array([-1])]
        self.gain, self.stats = [np.array([-1.0])], []
        self.largest = math.inf  # the weight of its largest node
        self.start, self.k, self.levels = 0, 1, []  # the first node of the last level, its nodes, and the splits so far

    def values(self) -> np.ndarray:
        """The prediction of every node of the last level."""
        n, s, _ = self.stats[-1]
        return s / np.maximum(n, 1e-300)

    def full(self) -> bool:
        return len(self.levels) == self.depth or not self.k

    def split(self, hist: np.ndarray) -> np.ndarray:
        """Split the last level by its histograms and go on to its children; which nodes stay leaves."""
        n, s, ss = self.stats[-1]
        best, score = np.zeros(self.k, int), np.full(self.k, -np.inf)
        for lo in range(0, self.k, 256):
            part = slice(lo, lo + 256)
            ln, ls = hist[0, part].cumsum(2)[:, :, :-1], hist[1, part].cumsum(2)[:, :, :-1]
            rn, rs = n[part, None, None] - ln, s[part, None, None] - ls
            ok = (ln >= self.min_rows) & (rn >= self.min_rows)
            if self.tried:
                order = self.rng.random(ok.shape[:2]).argsort(1)
                ok &= (order < self.tried)[:, :, None]
            with np.errstate(divide="ignore", invalid="ignore"):
                q = np.where(ok, ls * ls / ln + rs * rs / rn, -np.inf).reshape(len(ok), -1)
            if q.shape[1]:
                best[part] = q.argmax(1)
                score[part] = np.take_along_axis(q, best[part, None], 1)[:, 0]
        gain = score - s * s / np.maximum(n, 1e-300)
        grows = gain > 1e-12 * ss  # below, it is the rounding of the sums
        bins = self.layout.bins
        f, b = best // max(bins - 1, 1), best % max(bins - 1, 1)
        born = np.cumsum(grows) - 1
        first = self.start + self.k
        self.feature[-1] = np.where(grows, f, -1)
        self.gain[-1] = np.where(grows, gain / np.maximum(n, 1e-300), -1.0)
        self.left[-1] = np.where(grows, first + 2 * born, -1)
        self.right[-1] = np.where(grows, first + 2 * born + 1, -1)
        self.cut[-1] = np.array([self.layout.cuts[i][j] if g else np.nan for i, j, g in zip(f.tolist(), b.tolist(), grows.tolist(), strict=True)])
        self.levels.append(self._level(f, b, grows, born))
        ln = hist[0][np.arange(self.k), f].cumsum(1)[np.arange(self.k), b] if self.k else n
        self.largest = float(np.maximum(ln, n - ln)[grows].max(initial=0.0))
        self.start, self.k = first, 2 * int(grows.sum())
        for held, none in ((self.feature, -1), (self.left, -1), (self.right, -1), (self.gain, -1.0), (self.cut, np.nan)):
            held.append(np.full(self.k, none))
        return ~grows

    def _level(self, f: np.ndarray, b: np.ndarray, grows: np.ndarray, born: np.ndarray) -> Level:
        lay, out = self.layout, 2 * int(grows.sum())
        places = {x: lay.place(x) for x in set(f[grows].tolist())}
        code = np.zeros(self.k + 1, np.int64)
        right = np.zeros((self.k + 1, max((lay.states(g) for g in range(len(lay.codes))), default=1)), np.uint8)
        child = np.full(2 * (self.k + 1), out, np.int64)
        states = np.arange(right.shape[1])
        for x, (g, bins, stride) in places.items():
            of = np.flatnonzero(grows & (f == x))
            code[of] = g
            right[of] = states // stride % bins > b[of, None]
        nodes = np.flatnonzero(grows)
        child[2 * nodes], child[2 * nodes + 1] = 2 * born[nodes], 2 * born[nodes] + 1
        return Level(code, right, child)

    def table(self) -> dict[str, np.ndarray]:
        """All nodes in the order of their ids, those of a level not yet counted as empty ones."""
        n, s, ss = np.concatenate([*self.stats, np.zeros((3, sum(map(len, self.feature)) - sum(x.shape[1] for x in self.stats)))], axis=1)
        n1 = np.maximum(n, 1e-300)
        out = {"feature": self.feature, "cut": self.cut, "left": self.left, "right": self.right, "gain": self.gain}
        return {c: np.concatenate(x) for c, x in out.items()} | {"prediction": s / n1, "impurity": np.maximum(ss / n1 - (s / n1) ** 2, 0.0), "n": n, "s": s, "ss": ss}


def grow(tree: Tree, rows: Rows, y: np.ndarray, w: np.ndarray | None = None, used: np.ndarray | None = None) -> np.ndarray:
    """Grow ``tree`` to its end over rows held here, weighted by ``w``, those not ``used`` left out; its prediction for every row."""
    v = y if w is None else y * w
    node, out, leaf = np.zeros(rows.n, np.int64), np.zeros(rows.n), None
    while True:
        few = bool(rows.apart) and rows.n < tree.k * CODE_STATES // 2  # shared codes would have more states than rows
        sums = Sums(tree.layout, tree.k, few, tree.full())
        for lo in range(0, rows.n, sums.part):
            part = slice(lo, lo + sums.part)
            if tree.levels:
                if leaf is not None:
                    out[part] += leaf.take(node[part])
                node[part] = tree.levels[-1].move(rows, lo, node[part])
            seen = node[part] if used is None else np.where(used[part], node[part], tree.k)
            sums.add(rows, lo, seen, v[part], y[part], None if w is None else w[part])
        tree.stats.append(sums.stats[:, : tree.k])
        values = tree.values()
        if tree.full():
            return out + np.append(values, 0.0).take(node)
        stays = tree.split(sums.histograms())
        leaf = np.append(np.where(stays, values, 0.0), 0.0) if stays.any() else None


def bootstrap(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often a tree's sample holds each row of a block, Poisson of mean 1."""
    return np.random.default_rng([seed, tree, block]).poisson(1.0, n).astype(np.uint8)


@dataclass(frozen=True)
class Plan:
    """What a fit needs in its tasks."""

    layout: Layout
    seed: int
    depth: int
    min_rows: int
    trees: int
    tried: int | None = None
    step: float = 0.0
    rate: float = 1.0

    def tree(self, number: int) -> Tree:
        return Tree(self.layout, self.depth, self.min_rows, self.tried, np.random.default_rng([self.seed, number]))


def forest_trees(plan: Plan, numbers: range, blocks: list[tuple[int, int]], rows: Rows, y: np.ndarray):
    """(number, nodes) of some trees of a forest over all its rows; blocks: (id, rows) in order."""
    rows.separate()
    for t in numbers:
        w = np.concatenate([bootstrap(plan.seed, t, b, n) for b, n in blocks])
        held = np.flatnonzero(w)
        tree = plan.tree(t)
        grow(tree, rows.take(held), y[held], w[held].astype(float))
        yield t, tree.table()


def boosted_trees(plan: Plan, rows: Rows, y: np.ndarray):
    """(number, nodes) of all trees of a boosting over all its rows."""
    so_far = np.zeros(rows.n)
    for t in range(plan.trees):
        tree = plan.tree(t)
        used = None if plan.rate >= 1.0 else tree.rng.random(rows.n) < plan.rate
        out = grow(tree, rows, 2.0 * (y - so_far) if t else y, used=used)
        so_far += plan.step * out if t else out
        yield t, tree.table()


# --- Spark --------------------------------------------------------------------------

BLOCKS = "block long, n int, codes binary, y binary"
NODE = (
    "struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, leftChild: int,"
    " rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def node_batch(tree: int, t: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A tree's nodes as Spark ML saves them."""
    n, inner = len(t["n"]), t["feature"] >= 0
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(inner)), pa.int32()), pa.array(t["cut"][inner]))
    stats = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 3, pa.int32()), pa.array(np.stack([t["n"], t["s"], t["ss"]], axis=1).ravel()))
    split = pa.StructArray.from_arrays([pa.array(t["feature"], pa.int32()), lists, pa.array(np.full(n, -1), pa.int32())], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    cols = [
        pa.array(np.arange(n), pa.int32()), pa.array(t["prediction"]), pa.array(t["impurity"]), stats, pa.array(np.rint(t["n"]), pa.int64()), pa.array(t["gain"]),
        pa.array(t["left"], pa.int32()), pa.array(t["right"], pa.int32()), split,
    ]
    names = ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, tree), pa.int32()), pa.StructArray.from_arrays(cols, names)], ["treeID", "nodeData"])


def matrix(b: pa.RecordBatch, column: str) -> np.ndarray:
    """rows x features of an array column without nulls."""
    x = b.column(column)
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.zeros((0, 0))


def write_blocks(df: DataFrame, layout: Layout, path: str) -> None:
    """``df`` (x: array<double>, y) as blocks of binned rows."""

    def cut(batches):
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 24, []

        def out(codes, y):
            return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([len(y)], pa.int32()), pa.array([codes.tobytes()]), pa.array([y.tobytes()])], ["block", "n", "codes", "y"])

        for b in batches:
            y = b.column("y").to_numpy(zero_copy_only=False).astype(float)
            if np.isnan(y).any():
                raise ValueError("labels must not be null or NaN")
            if len(y):
                held.append((layout.encode(matrix(b, "x")), y))
            if sum(len(y) for _, y in held) >= BLOCK_ROWS:
                yield out(*(np.concatenate(c, axis=-1) for c in zip(*held, strict=True)))
                block, held = block + 1, []
        if held:
            yield out(*(np.concatenate(c, axis=-1) for c in zip(*held, strict=True)))

    df.mapInArrow(cut, BLOCKS).write.parquet(path)


def read_blocks(path: str, layout: Layout) -> tuple[list[tuple[int, int]], Rows, np.ndarray]:
    """All blocks of a written table, in a task: their (id, rows), binned rows and labels."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    files = [f.path for f in store.get_file_info(fs.FileSelector(base)) if f.base_name.startswith("part-")]
    got = sorted((r for f in files for r in pq.ParquetFile(store.open_input_file(f)).read().to_pylist()), key=lambda r: r["block"])
    codes = np.concatenate([np.frombuffer(r["codes"], np.uint16).reshape(len(layout.codes), r["n"]) for r in got], axis=1)
    return [(r["block"], r["n"]) for r in got], Rows(layout, codes), np.concatenate([np.frombuffer(r["y"]) for r in got])


def grown(spark: SparkSession, plan: Plan, path: str, units: list[range]) -> DataFrame:
    """(treeID, nodeData) of trees grown from the blocks at ``path``: a task per unit of a forest's trees, or one task that boosts."""

    def run(batches):
        for b in batches:
            for i in b.column(0).to_pylist():
                blocks, rows, y = read_blocks(path, plan.layout)
                trees = boosted_trees(plan, rows, y) if plan.step else forest_trees(plan, units[i], blocks, rows, y)
                for t, nodes in trees:
                    yield node_batch(t, nodes)

    return spark.range(0, len(units), 1, len(units)).mapInArrow(run, f"treeID int, nodeData {NODE}")


def blocks_of(batches, layout: Layout):
    """(id, binned rows, labels) of every block of a task."""
    for b in batches:
        for block, n, codes, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
            yield block, Rows(layout, np.frombuffer(codes, np.uint16).reshape(len(layout.codes), n)), np.frombuffer(y)


#: Nodes that a task counts for at a time, over all trees of a wave; nodes whose counts are shuffled as one value.
WAVE_NODES = 256
CHUNK = 8


def down(levels: list[Level], rows: Rows) -> np.ndarray:
    """The node of every row in the level after ``levels``."""
    node = np.zeros(rows.n, np.int64)
    for lo in range(0, rows.n, PART_ROWS):
        for level in levels:
            node[lo : lo + PART_ROWS] = level.move(rows, lo, node[lo : lo + PART_ROWS])
    return node


def count_level(table: DataFrame, plan: Plan, trees: dict[int, Tree]) -> None:
    """One pass over all blocks that counts the last level of every tree: its stats and, unless it's full, its splits."""
    todo = {t: (tree.levels, tree.k, tree.full()) for t, tree in trees.items()}
    layout, bins = plan.layout, plan.layout.bins

    def count(batches):
        sums = {t: Sums(layout, k, False, last) for t, (_, k, last) in todo.items()}
        for block, rows, y in blocks_of(batches, layout):
            for t, (levels, _, _) in todo.items():
                w = bootstrap(plan.seed, t, block, rows.n).astype(float)
                node = down(levels, rows)
                for lo in range(0, rows.n, sums[t].part):
                    part = slice(lo, lo + sums[t].part)
                    sums[t].add(rows, lo, node[part], y[part] * w[part], y[part], w[part])
        for t, (_, k, _) in todo.items():
            flat = np.concatenate([sums[t].stats[:, :k].T, sums[t].histograms().transpose(1, 0, 2, 3).reshape(k, -1)], axis=1)
            at = range(0, k, CHUNK)
            cols = [pa.array([t] * len(at), pa.int32()), pa.array(at, pa.int32()), pa.array([flat[i : i + CHUNK].tobytes() for i in at], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["tree", "at", "sums"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py()) for x in t.column("sums"))
        return pa.table({"tree": t.column("tree")[:1], "at": t.column("at")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    fields = "tree int, at int, sums binary"
    got = table.mapInArrow(count, fields).groupBy("tree", "at").applyInArrow(add, fields).collect()
    for t, tree in trees.items():
        flat = np.frombuffer(b"".join(r["sums"] for r in sorted((r for r in got if r["tree"] == t), key=lambda r: r["at"]))).reshape(tree.k, -1)
        tree.stats.append(flat[:, :3].T.copy())
        if not tree.full():
            tree.split(flat[:, 3:].reshape(tree.k, 2, len(layout.cuts), bins).transpose(1, 0, 2, 3))


def forest_wave(table: DataFrame, plan: Plan, numbers: range, path: str) -> tuple[DataFrame, DataFrame | None]:
    """Nodes of some trees of a forest whose rows are too many for a task.

    Their first levels are counted by all tasks. When no node has more rows than a task holds, the rows of every node
    are sent to one task, which grows what is below it. Returns the first nodes and those below."""
    spark, layout = table.sparkSession, plan.layout
    trees = {t: plan.tree(t) for t in numbers}
    growing = dict(trees)
    while growing:
        count_level(table, plan, growing)
        growing = {t: tree for t, tree in growing.items() if not (tree.full() and len(tree.stats) > len(tree.levels)) and tree.k and tree.largest > LOCAL_ROWS}
    cut = {t: tree.levels for t, tree in trees.items() if tree.k and len(tree.stats) == len(tree.levels)}
    firsts = [(t, tree.table(), tree.start if t in cut else None) for t, tree in trees.items()]

    def send(batches):
        for block, rows, y in blocks_of(batches, layout):
            for t, levels in cut.items():
                w, node = bootstrap(plan.seed, t, block, rows.n), down(levels, rows)
                held = np.flatnonzero((w > 0) & (node < levels[-1].child.max(initial=0)))
                held = held[np.argsort(node[held], kind="stable")]
                nodes, at = np.unique(node[held], return_index=True)
                parts = np.split(held, at[1:]) if len(held) else []
                blobs = [pa.array([f(p) for p in parts], pa.binary()) for f in (lambda p: rows.codes[:, p].tobytes(), lambda p: y[p].tobytes(), lambda p: w[p].tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), t), pa.int32()), pa.array(nodes, pa.int32()), pa.array(np.full(len(nodes), block)), *blobs], ["tree", "node", "block", "codes", "y", "w"])

    def below(t: pa.Table) -> pa.Table:
        number, node = t.column("tree")[0].as_py(), t.column("node")[0].as_py()
        got = sorted(t.select(["block", "codes", "y", "w"]).to_pylist(), key=lambda r: r["block"])
        y = np.concatenate([np.frombuffer(r["y"]) for r in got])
        rows = Rows(layout, np.concatenate([np.frombuffer(r["codes"], np.uint16).reshape(len(layout.codes), -1) for r in got], axis=1))
        rows.separate()
        tree = Tree(layout, plan.depth - len(cut[number]), plan.min_rows, plan.tried, np.random.default_rng([plan.seed, number, node + 1]))
        grow(tree, rows, y, np.concatenate([np.frombuffer(r["w"], np.uint8) for r in got]).astype(float))
        nodes = pa.Table.from_batches([node_batch(number, tree.table())])
        size = len(nodes)
        return nodes.append_column("node", pa.array(np.full(size, node), pa.int32())).append_column("size", pa.array(np.full(size, size), pa.int32()))

    fields = f"treeID int, nodeData {NODE}"
    batches = [node_batch(t, {c: x[:start] for c, x in nodes.items()}) for t, nodes, start in firsts]
    top = spark.createDataFrame(pa.Table.from_batches(batches), spark.createDataFrame([], fields).schema)
    if not cut:
        return top, None
    sent = table.mapInArrow(send, "tree int, node int, block long, codes binary, y binary, w binary")
    sent.groupBy("tree", "node").applyInArrow(below, f"{fields}, node int, size int").write.parquet(path)
    grown_below = spark.read.schema(f"{fields}, node int, size int").parquet(path)
    sizes = {(r["treeID"], r["node"]): r["size"] for r in grown_below.where("nodeData.id = 0").select("treeID", "node", "size").collect()}
    offset = {}
    for t in cut:
        free = trees[t].start + trees[t].k
        for node in range(trees[t].k):
            offset[t, node] = (trees[t].start + node, free)
            free += sizes[t, node] - 1
    rows = [(t, node, root, free) for (t, node), (root, free) in offset.items()]
    at = F.broadcast(spark.createDataFrame(rows, "treeID int, node int, root int, free int"))
    new = lambda c: F.when(F.col(f"nodeData.{c}") < 0, -1).when(F.col(f"nodeData.{c}") == 0, F.col("root")).otherwise(F.col(f"nodeData.{c}") + F.col("free") - 1).cast("int")
    data = F.col("nodeData").withField("leftChild", new("leftChild")).withField("rightChild", new("rightChild")).withField("id", new("id"))
    return top, grown_below.join(at, ["treeID", "node"]).select("treeID", data.alias("nodeData"))


def forest_nodes(spark: SparkSession, plan: Plan, path: str, n: int) -> DataFrame:
    """(treeID, nodeData) of a forest over more rows than a task holds, some trees at a time."""
    table = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    each = max(1, min(8, WAVE_NODES * LOCAL_ROWS // (4 * n)))
    out = None
    for i, t in enumerate(range(0, plan.trees, each)):
        for part in forest_wave(table, plan, range(t, min(t + each, plan.trees)), f"{path}/below-{i}"):
            if part is not None:
                out = part if out is None else out.unionByName(part)
    return out


def _json(est, kind: str, uid: str, more: dict) -> str:
    values = lambda of: {p.name: v for p, v in of.items()}
    head = {"class": f"org.apache.spark.ml.regression.{kind}", "timestamp": 0, "sparkVersion": "4.1.2", "uid": uid}
    return json.dumps(head | {"paramMap": values(est._paramMap), "defaultParamMap": values(est._defaultParamMap)} | more)


#: The parameters of an ensemble's trees, as Spark ML saves them.
TREE_PARAMS = ("cacheNodeIds", "checkpointInterval", "featuresCol", "impurity", "labelCol", "leafCol", "maxBins", "maxDepth", "maxMemoryInMB", "minInfoGain", "minInstancesPerNode", "minWeightFractionPerNode", "predictionCol", "seed")


def saved(est, kind: str, nodes: DataFrame, weights: list[float], features: int, path: str) -> None:
    """Write trees as a saved Spark ML ensemble."""
    spark = nodes.sparkSession
    nodes.write.parquet(f"{path}/data")
    meta = _json(est, kind, est.uid, {"numFeatures": features, "numTrees": len(weights)})
    spark.createDataFrame([(meta,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    one = json.loads(meta)
    one = {k: {p: v for p, v in one[k].items() if p in TREE_PARAMS} for k in ("paramMap", "defaultParamMap")}
    head = {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "timestamp": 0, "sparkVersion": "4.1.2"}
    rows = [(i, json.dumps(head | {"uid": f"dtr_{est.uid}_{i}"} | one), float(x)) for i, x in enumerate(weights)]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")


def binned(df: DataFrame, est) -> tuple[DataFrame, Layout, int, int]:
    """(x, y) of the estimator's columns, the layout of the bins, and the numbers of rows and features."""
    rows = df.select(vector_to_array(est.getFeaturesCol()).alias("x"), F.col(est.getLabelCol()).cast("double").alias("y"))
    n = rows.count()
    if not n:
        raise ValueError("no row to fit")
    wanted = max(est.getMaxBins() ** 2, 10_000)  # as many as Spark ML looks at to place the bins of all rows
    seen = np.array([r["x"] for r in (rows if n <= wanted else sampled(rows, wanted / n, est.getSeed())).select("x").collect()])
    bins, missing = min(est.getMaxBins(), n), np.isnan(seen).sum(axis=0)
    return rows, Layout.of([thresholds(seen[:, f], bins, min(n, wanted) - missing[f]) for f in range(seen.shape[1])]), n, seen.shape[1]


def sampled(rows: DataFrame, fraction: float, seed: int) -> DataFrame:
    """The rows that Spark ML's trainers draw to place the bins."""
    spark = rows.sparkSession
    draw = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    return DataFrame(spark._jsparkSession.createDataFrame(rows._jdf.rdd().sample(False, fraction, draw), rows._jdf.schema()), spark)


def plain(est, strategies: tuple[str, ...]) -> bool:
    """Whether the fit asks for nothing but what is built here."""
    unset = ("weightCol", "validationIndicatorCol")
    strategy = est.getFeatureSubsetStrategy()
    known = strategy in strategies or (strategy.replace(".", "", 1).isdigit() and "." in strategy and 0 < float(strategy) <= 1)
    return known and est.getMinInfoGain() == 0 and est.getMinWeightFractionPerNode() == 0 and not any(est.hasParam(p) and est.isSet(p) for p in unset) and est.getMaxBins() <= 256


def tried(est, features: int) -> int | None:
    """How many features a node tries, None for all."""
    s = est.getFeatureSubsetStrategy()
    k = features if s in ("all", "auto") else math.ceil(float(s) * features)
    return None if k >= features else k


class RandomForestRegressor(ml.RandomForestRegressor):
    """Spark ML's forest, its trees grown here."""

    def _fit(self, dataset: DataFrame):
        if not (plain(self, ("all",)) and self.getBootstrap() and self.getSubsamplingRate() == 1):
            return super()._fit(dataset)
        spark, path = dataset.sparkSession, scratch_path(dataset.sparkSession, "forest")
        rows, layout, n, features = binned(dataset, self)
        plan = Plan(layout, self.getSeed() & (2**63 - 1), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getNumTrees(), tried(self, features))
        write_blocks(rows, layout, f"{path}/blocks")
        each = -(-plan.trees // (4 * spark.sparkContext.defaultParallelism))
        if n > LOCAL_ROWS:
            nodes = forest_nodes(spark, plan, path, n)
        else:
            nodes = grown(spark, plan, f"{path}/blocks", [range(t, min(t + each, plan.trees)) for t in range(0, plan.trees, each)])
        saved(self, "RandomForestRegressionModel", nodes, [1.0] * plan.trees, features, f"{path}/model")
        return ml.RandomForestRegressionModel.load(f"{path}/model")


class GBTRegressor(ml.GBTRegressor):
    """Spark ML's boosting of squared loss, its trees grown here."""

    def _fit(self, dataset: DataFrame):
        if not (plain(self, ("all", "auto")) and self.getLossType() == "squared"):
            return super()._fit(dataset)
        spark, path = dataset.sparkSession, scratch_path(dataset.sparkSession, "boosting")
        rows, layout, n, features = binned(dataset, self)
        if n > LOCAL_ROWS:
            return super()._fit(dataset)
        plan = Plan(
            layout, self.getSeed() & (2**63 - 1), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMaxIter(), tried(self, features), self.getStepSize(), self.getSubsamplingRate()
        )
        write_blocks(rows, layout, f"{path}/blocks")
        saved(self, "GBTRegressionModel", grown(spark, plan, f"{path}/blocks", [range(plan.trees)]), [1.0] + [plan.step] * (plan.trees - 1), features, f"{path}/model")
        return ml.GBTRegressionModel.load(f"{path}/model")
