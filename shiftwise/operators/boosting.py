"""Histogram gradient boosting for squared error.

Numeric features become bin numbers (cuts at exact quantiles), categories their
place in a dictionary; a split sends rows above a bin, or rows of one category,
to the right. Each level of a tree is one Spark job: every task adds its rows'
gradients and counts up by (node, feature, bin), the sums are added up across
tasks, and the driver, which sees only that table of fixed size, picks for each
node the split of largest gain (of two children only the lighter one is
counted, the other is what remains of their parent)

    GL^2 / (NL + l2) + GR^2 / (NR + l2) - G^2 / (N + l2)

whose sides both weigh ``min_weight`` or more. A leaf is worth
``step * sum(residuals) / (N + l2)``. Every tree sees a share of the rows and a
share of the features (each category counts as a feature of its own).

Gradients are rounded to whole multiples of a power of two, so sums do not
depend on their order: the same rows give the same trees on any cluster. Rows
lie in chunks (series by hash, each sorted), of which an RDD keeps bin numbers,
labels and predictions; an RDD because a fit is thousands of small jobs over
the same packed arrays. Predictions move on inside the next tree's first job;
every ``keep_every`` trees they are written to the shared checkpoint folder, so
a lost executor recomputes a few trees at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.operators.categories import with_codes
from shiftwise.operators.selection import column_values, cuts
from shiftwise.session import checkpoint_dir, materialize, remove_folder

NEVER = 1 << 30  # a cut that no bin lies above


@dataclass(frozen=True)
class BoostConfig:
    rounds: int = 2000
    step: float = 0.01
    depth: int = 6
    min_weight: int = 5
    row_share: float = 0.8
    column_share: float = 0.8
    l2: float = 1.0
    bins: int = 256
    seed: int = 42
    chunk_rows: int = 16384
    keep_every: int = 25


@dataclass
class Layout:
    """The features: numeric columns with their cuts, then categorical columns with their number of categories.

    A numeric column has one bin more than cuts; a categorical column has a bin 0 for unseen values.
    """

    numeric: list[str]
    cuts: list[np.ndarray]
    categorical: list[str]
    categories: list[int]
    widths: list[int] = field(init=False)
    starts: np.ndarray = field(init=False)

    def __post_init__(self):
        self.widths = [len(c) + 1 for c in self.cuts] + [k + 1 for k in self.categories]
        self.starts = np.concatenate(([0], np.cumsum(self.widths)))

    def is_category(self) -> np.ndarray:
        return np.arange(len(self.widths)) >= len(self.numeric)

    def features(self) -> np.ndarray:
        """Number of each bin's feature: all bins of a numeric column share one, each category has its own (unseen: -1)."""
        out, n = [], 0
        for k, width in enumerate(self.widths):
            if k < len(self.numeric):
                out += [n] * width
                n += 1
            else:
                out += [-1, *range(n, n + width - 1)]
                n += width - 1
        return np.array(out)

    def codes(self, batch: pa.RecordBatch) -> np.ndarray:
        """Bin numbers (rows x columns); a null numeric counts as below all cuts."""
        out = np.zeros((batch.num_rows, len(self.widths)), np.int32)
        for k, (name, at) in enumerate(zip(self.numeric, self.cuts)):
            x = batch.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)
            out[:, k] = np.where(np.isnan(x), 0, np.searchsorted(at, x, "left"))
        for k, name in enumerate(self.categorical, len(self.numeric)):
            out[:, k] = batch.column(f"{name}_code").to_numpy(zero_copy_only=False)
        return out


@dataclass
class Tree:
    """A full tree: nodes in level order; a node that does not split sends all rows left."""

    column: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> "Tree":
        return cls(np.zeros((1 << depth) - 1, np.int32), np.full((1 << depth) - 1, NEVER, np.int32), np.zeros(1 << depth))

    def at(self, codes: np.ndarray, category: np.ndarray, levels: int) -> np.ndarray:
        """Each row's place (from 0) on a level."""
        place, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for level in range(levels):
            node = place + (1 << level) - 1
            column, cut = self.column[node], self.cut[node]
            code = codes[rows, column]
            place = 2 * place + np.where(category[column], code == cut, code > cut)
        return place

    def predict(self, codes: np.ndarray, category: np.ndarray) -> np.ndarray:
        return self.value[self.at(codes, category, len(self.value).bit_length() - 1)]


@dataclass
class BoostedModel:
    layout: Layout
    base: float
    trees: list[Tree]

    def predict(self, codes: np.ndarray) -> np.ndarray:
        category, out = self.layout.is_category(), np.full(len(codes), self.base)
        for tree in self.trees:
            out += tree.predict(codes, category)
        return out


def drawn_rows(cfg: BoostConfig, round_: int, chunk: int, n: int) -> np.ndarray:
    return np.random.default_rng([cfg.seed, 1, round_, chunk]).random(n) < cfg.row_share


def drawn_features(cfg: BoostConfig, round_: int, n: int) -> np.ndarray:
    """True for the features that a tree may split on, one at least."""
    out = np.zeros(n, bool)
    out[np.random.default_rng([cfg.seed, 2, round_]).permutation(n)[: max(1, int(cfg.column_share * n))]] = True
    return out


def unit(rows: int, largest: float, chunk_rows: int) -> float:
    """The power of two that gradients are multiples of: sums of a chunk fit a double's 52 bits, all sums 62 bits."""
    most = 4.0 * largest * max(min(rows, 8 * chunk_rows) / 2.0 ** 52, rows / 2.0 ** 62)
    return 2.0 ** np.ceil(np.log2(most)) if most > 0 else 1.0


def histogram(codes: np.ndarray, residual: np.ndarray, place: np.ndarray, nodes: np.ndarray, layout: Layout,
              columns: list[int]) -> np.ndarray:
    """Sums of residuals and counts by (node, bin), 2 x nodes x bins; ``nodes`` are the level's places that may split."""
    index = np.full(int(place.max(initial=0)) + 1 if len(place) else 1, -1)
    inside = nodes[nodes < len(index)]
    index[inside] = np.arange(len(inside))
    node = index[place]
    kept = node >= 0
    node, codes, residual = node[kept], codes[kept], residual[kept]
    out = np.zeros((2, len(nodes), layout.starts[-1]), np.int64)
    for k in columns:
        width, start = layout.widths[k], layout.starts[k]
        at = node * width + codes[:, k]
        size = len(nodes) * width
        out[0, :, start:start + width] = np.bincount(at, residual, size).reshape(len(nodes), width)
        out[1, :, start:start + width] = np.bincount(at, minlength=size).reshape(len(nodes), width)
    return out


def best_splits(sums: np.ndarray, layout: Layout, allowed: np.ndarray, cfg: BoostConfig, scale: float) -> list[tuple | None]:
    """Per node (column, cut) of largest gain, the first of equals; None where no split gains or weighs enough."""
    grad, count = sums[0].astype(float) * scale, sums[1].astype(float)
    nodes, found = len(grad), []
    features, category = layout.features(), layout.is_category()
    best = np.zeros(nodes)
    pick: list[tuple | None] = [None] * nodes
    for k, width in enumerate(layout.widths):
        span = slice(layout.starts[k], layout.starts[k] + width)
        ok = np.isin(features[span], np.flatnonzero(allowed))
        if not ok.any():
            continue
        g, n = grad[:, span], count[:, span]
        total_g, total_n = g.sum(axis=1, keepdims=True), n.sum(axis=1, keepdims=True)
        right_g, right_n = (g, n) if category[k] else (total_g - np.cumsum(g, axis=1), total_n - np.cumsum(n, axis=1))
        left_g, left_n = total_g - right_g, total_n - right_n
        gain = left_g ** 2 / (left_n + cfg.l2) + right_g ** 2 / (right_n + cfg.l2) - total_g ** 2 / (total_n + cfg.l2)
        gain = np.where(ok & (left_n >= cfg.min_weight) & (right_n >= cfg.min_weight), gain, -1.0)
        at = gain.argmax(axis=1)
        for i in range(nodes):
            if gain[i, at[i]] > best[i] + 1e-9 * abs(best[i]):
                best[i], pick[i] = gain[i, at[i]], (k, int(at[i]))
    return pick


def _next_state(state: RDD, tree: Tree, category: np.ndarray) -> RDD:
    def step(chunk):
        number, codes, y, margin = chunk
        return number, codes, y, margin + tree.predict(codes, category)

    return state.map(step, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)


def _sums(state: RDD, tree: Tree, level: int, nodes: np.ndarray, round_: int, layout: Layout, columns: list[int],
          cfg: BoostConfig, scale: float) -> np.ndarray:
    category = layout.is_category()

    def count(it):
        total = None
        for number, codes, y, margin in it:
            drawn = drawn_rows(cfg, round_, number, len(y))
            codes = codes[drawn]
            residual = np.rint((y[drawn] - margin[drawn]) / scale)
            one = histogram(codes, residual, tree.at(codes, category, level), nodes, layout, columns)
            total = one if total is None else total + one
        return [] if total is None else [total]

    parts = state.mapPartitions(count)
    # few tables are added up at once, many in rounds
    return parts.treeReduce(np.add, 1 if state.getNumPartitions() <= 32 else 2 if state.getNumPartitions() <= 1024 else 3)


def grow(state: RDD, layout: Layout, round_: int, cfg: BoostConfig, scale: float) -> Tree:
    """One tree, level by level."""
    tree = Tree.empty(cfg.depth)
    features = layout.features()
    allowed = drawn_features(cfg, round_, int(features.max(initial=-1)) + 1)
    columns = [k for k, w in enumerate(layout.widths)
               if np.isin(features[layout.starts[k]:layout.starts[k] + w], np.flatnonzero(allowed)).any()]
    category = layout.is_category()
    nodes, asked, parents = np.zeros(1, np.int64), np.zeros(1, np.int64), None
    for level in range(cfg.depth):
        got = _sums(state, tree, level, asked, round_, layout, columns, cfg, scale)
        if parents is None:
            sums = got
        else:  # only the lighter child of each pair was counted, the other is what remains of the parent
            sums = np.empty((2, len(nodes), got.shape[2]), np.int64)
            light = np.isin(nodes, asked)
            sums[:, light] = got
            sums[:, ~light] = parents - got
        after, lighter, split_at = [], [], []
        for i, (place, split) in enumerate(zip(nodes.tolist(), best_splits(sums, layout, allowed, cfg, scale))):
            span = slice(layout.starts[columns[0]], layout.starts[columns[0]] + layout.widths[columns[0]])
            total = sums[:, i, span].sum(axis=1)
            sides = [(place << (cfg.depth - level), total)]
            if split:
                k, cut = split
                node = place + (1 << level) - 1
                tree.column[node], tree.cut[node] = k, cut
                here = sums[:, i, layout.starts[k]:layout.starts[k] + layout.widths[k]]
                right = here[:, cut] if category[k] else here[:, cut + 1:].sum(axis=1)
                sides = [((2 * place) << (cfg.depth - level - 1), total - right),
                         ((2 * place + 1) << (cfg.depth - level - 1), right)]
                after += [2 * place, 2 * place + 1]
                lighter.append(2 * place + int(2 * right[1] < total[1]))
                split_at.append(i)
            for leaf, (g, n) in sides:
                tree.value[leaf] = cfg.step * float(g) * scale / (float(n) + cfg.l2)
        if not after:
            break
        nodes, asked, parents = np.array(after), np.array(lighter), sums[:, split_at]
    return tree


def packed(train: DataFrame, layout: Layout, label: str, order: list[str], chunks: int) -> DataFrame:
    """(chunk, n, codes, labels): bin numbers and labels of a chunk's rows as bytes."""
    series = F.xxhash64(*order[:-1]) if len(order) > 1 else F.xxhash64(*order)
    names = [*layout.numeric, *[f"{c}_code" for c in layout.categorical]]
    rows = train.select(F.pmod(series, F.lit(chunks)).cast("int").alias("_chunk"), *names, F.col(label).cast("double").alias("_label"),
                        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([(f"_o{i}", "ascending") for i in range(len(order))] + [("_label", "ascending")]
                      + [(n, "ascending") for n in names])  # so that equal keys do not stand in the order they came in
        batch = t.combine_chunks().to_batches()[0]
        return pa.table({"chunk": t.column("_chunk").slice(0, 1), "n": pa.array([t.num_rows]),
                         "codes": pa.array([layout.codes(batch).tobytes()], pa.binary()),
                         "labels": pa.array([batch.column("_label").to_numpy().tobytes()], pa.binary())})

    return rows.groupBy("_chunk").applyInArrow(pack, "chunk int, n long, codes binary, labels binary")


def layout_of(train: DataFrame, numeric: list[str], categorical: list[str], dictionary: DataFrame, bins: int) -> Layout:
    """Cuts and category counts: at most ``bins`` numbers a numeric column and one number a category reach the driver."""
    found: dict = {}
    if numeric:
        for r in cuts(column_values(train, numeric), ["column"], bins).collect():
            found.setdefault(r["column"], []).append(r["value"])
    sizes = {r["column"]: r["n"] for r in dictionary.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Layout(list(numeric), [np.array(sorted(found.get(c, []))) for c in numeric], list(categorical),
                  [sizes.get(c, 0) for c in categorical])


def fit_boosting(train: DataFrame, numeric, categorical, dictionary: DataFrame, label: str, order: list[str],
                 cfg: BoostConfig = BoostConfig()) -> BoostedModel:
    """``train`` needs no nulls in its numeric columns (they count as lowest) and its label; ``order`` names the columns
    that say which rows lie together (all but the last) and in which order. ``dictionary``: see ``categories``."""
    spark = train.sparkSession
    train = train.where(F.col(label).isNotNull())
    layout = layout_of(train, list(numeric), list(categorical), dictionary, cfg.bins)
    n, mean, largest = train.agg(F.count(F.lit(1)), F.avg(F.col(label).cast("double")), F.max(F.abs(F.col(label).cast("double")))).first()
    if not n:
        return BoostedModel(layout, 0.0, [])
    chunks = -(-n // cfg.chunk_rows)
    data = materialize(packed(with_codes(train, dictionary, list(categorical)), layout, label, order, chunks), "boosting_chunks")
    base, scale = float(mean), unit(n, float(largest), cfg.chunk_rows)

    def opened(r):
        chunk, n_rows, codes, labels = r
        return chunk, np.frombuffer(codes, np.int32).reshape(n_rows, -1), np.frombuffer(labels), np.full(n_rows, base)

    parts = max(1, min(chunks, 4 * spark.sparkContext.defaultParallelism))
    checkpoint_dir(spark)
    state = data.rdd.map(lambda r: (r["chunk"], tuple(r))).partitionBy(parts, int).values().map(opened).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[Tree] = []
    written = None
    try:
        for round_ in range(cfg.rounds):
            if trees:
                before, state = state, _next_state(state, trees[-1], layout.is_category())
                if round_ % cfg.keep_every == 0:
                    state.checkpoint()
            trees.append(grow(state, layout, round_, cfg, scale))
            if round_:
                before.unpersist()
            if round_ and round_ % cfg.keep_every == 0:
                if written:
                    remove_folder(spark, written)
                written = state.getCheckpointFile()
    finally:
        state.unpersist()
        if written:
            remove_folder(spark, written)
    return BoostedModel(layout, base, trees)


def with_prediction(model: BoostedModel, rows: DataFrame, dictionary: DataFrame, out: str = "prediction") -> DataFrame:
    """``rows`` with the model's prediction; the model, whose size the configuration bounds, is broadcast."""
    coded = with_codes(rows, dictionary, model.layout.categorical)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = rows.columns

    def predict(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            p = shared.value.predict(shared.value.layout.codes(batch))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(p)], names=[*names, out])

    return coded.mapInArrow(predict, coded.select(*names).withColumn(out, F.lit(0.0)).schema)


def save_model(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """One row for the layout and one per tree, as Parquet."""
    lay = model.layout
    head = [(-1, model.base, lay.numeric, [c.tolist() for c in lay.cuts], lay.categorical, lay.categories, None, None, None)]
    rows = [(i, None, None, None, None, None, t.column.tolist(), t.cut.tolist(), t.value.tolist()) for i, t in enumerate(model.trees)]
    spark.createDataFrame(head + rows, MODEL).write.mode("overwrite").parquet(path)


MODEL = ("round int, base double, numeric array<string>, cuts array<array<double>>, categorical array<string>, "
         "categories array<int>, column array<int>, cut array<int>, value array<double>")


def load_model(spark: SparkSession, path: str) -> BoostedModel:
    rows = sorted(spark.read.schema(MODEL).parquet(path).collect(), key=lambda r: r["round"])  # one row per tree
    head = rows[0]
    layout = Layout(head["numeric"], [np.array(c) for c in head["cuts"]], head["categorical"], head["categories"])
    return BoostedModel(layout, head["base"], [Tree(np.array(r["column"], np.int32), np.array(r["cut"], np.int32),
                                                    np.array(r["value"])) for r in rows[1:]])
