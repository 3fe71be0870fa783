"""Hard negatives by an inverted multi-index.

Vectors, scaled to whole numbers, are cut into two halves. Each half has its
own codebook (k-means on a bounded sample, ``SAMPLE`` rows of each dimension by
a hash); a pair of codes is a cell, and cells, in order, fill blocks of bounded
size; a cell larger than a block is spread over several. For an anchor the best
score that a half can reach under a code is the product with the code's centre
plus the anchor half's norm times the code's radius, taken over all rows of the
block. The sum over the halves bounds a cell, and a heap visits the cells in
descending order of that sum (the multi-sequence walk). It stops when no later
cell can reach what is still asked for, so every list is certified:

* positives: the k-th best same-label score found so far;
* negatives: for each positive a window of scores; the window's k-th best or,
  until there are k, its lower end. Cells that lie above every window by their
  lower bound are passed over.

Each anchor first visits its own cell's block, which gives the score that the
others must reach. All anchors meet all blocks (the stated query set against
all rows), in groups of bounded size; per block at most k rows of a list come
back, and one ranking by list merges them. Scores are exact integers.

Rows with a null label or vector, an empty vector, or a null or non-finite
component take no part, nor do vectors whose scaled length is 2**31 or more
(their products would not fit a long). Vectors meet only their own dimension.
Every row counts by itself, repeated ones too: an anchor's copies are other
rows. Ties go to the smaller id, a null id after all others; a row without id
is no anchor. Fewer rows than asked for give shorter lists. Empty tables give
no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftwise.llm.common import table
from shiftwise.session import materialize

EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
SCALE = 256
CODES = 16
SAMPLE = 4096
ELEMENTS = 1 << 20  # components of a block
ANCHORS = 2048  # anchors of a group
STEP = 512  # rows scored at once
SEED = 31
NO_ID = (1 << 63) - 1  # stands for a null id inside, after all others


def usable(vectors: DataFrame, id_col: str, label_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, label, embedding as scaled whole numbers in doubles, dim) of the rows that take part."""
    v = vectors.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                       F.col(vec_col).cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fine)
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * scale * x * scale)
    v = v.where(squares < float(1 << 62))
    return v.withColumns({"embedding": F.transform("embedding", lambda x: F.floor(x * scale).cast("double")),
                          "dim": F.size("embedding")})


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


# --- codebooks ----------------------------------------------------------------------

def centres(x: np.ndarray, codes: int = CODES, rounds: int = 12) -> np.ndarray:
    """k-means centres of the rows; first centres far apart, as k-means++ draws them."""
    rng = np.random.default_rng([SEED, x.shape[1]])
    out = x[:1]
    gap = ((x - out[0]) ** 2).sum(axis=1)
    while len(out) < codes and gap.sum() > 0:
        out = np.vstack([out, x[rng.choice(len(x), p=gap / gap.sum())]])
        gap = np.minimum(gap, ((x - out[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        near = nearest(x, out)
        size = np.bincount(near, minlength=len(out))
        sums = np.zeros_like(out)
        np.add.at(sums, near, x)
        out = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], out)
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(axis=1) - 2 * (x @ book.T)).argmin(axis=1)


def codebooks(v: DataFrame, codes: int = CODES, sample: int = SAMPLE) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Both halves' centres by dimension, fitted in tasks on about ``sample`` rows of each (all, if fewer).

    One small row per dimension reaches the driver.
    """
    share = v.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).select("dim", (F.lit(float(sample)) / F.col("n")).alias("share"))
    draw = F.pmod(F.xxhash64("vec_id", "embedding", "label"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = v.join(share, "dim").where(draw < F.col("share")).select("dim", "vec_id", "embedding")

    def fit(t: pa.Table) -> pa.Table:
        dim = t.column("dim")[0].as_py()
        t = t.take(pa.array(np.argsort(t.column("vec_id").to_numpy(), kind="stable")))
        x = matrix(t.column("embedding"), dim)
        books = [centres(x[:, :dim // 2], codes), centres(x[:, dim // 2:], codes)]
        return pa.table({"dim": pa.array([dim], pa.int32()), "first": [books[0].tobytes()], "second": [books[1].tobytes()]})

    rows = drawn.groupBy("dim").applyInArrow(fit, "dim int, first binary, second binary").collect()
    return {r["dim"]: (np.frombuffer(r["first"]).reshape(-1, r["dim"] // 2) if r["dim"] > 1 else np.zeros((1, 0)),
                       np.frombuffer(r["second"]).reshape(-1, r["dim"] - r["dim"] // 2)) for r in rows}


def with_cells(v: DataFrame, books) -> DataFrame:
    """Adds the codes c1, c2 of the halves (books: broadcast codebooks); a dimension the sample missed has one cell."""
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = matrix(part.column("embedding"), dim)
                first, second = books.value.get(dim, (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2))))
                c1, c2 = nearest(x[:, :dim // 2], first), nearest(x[:, dim // 2:], second)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(c1, pa.int32()), pa.array(c2, pa.int32())],
                                                 names=[*part.schema.names, "c1", "c2"])

    return v.mapInArrow(batches, "vec_id long, label long, embedding array<double>, dim int, c1 int, c2 int")


def cell_blocks(counts: list, elements: int = ELEMENTS) -> list[tuple]:
    """(dim, c1, c2, first block, blocks of the cell): cells in order share blocks, large cells take several."""
    out, block, used, last = [], -1, 0, None
    for dim, c1, c2, n in sorted(counts):
        room = max(1, elements // dim)
        if n > room:
            parts = -(-n // room)
            out.append((dim, c1, c2, block + 1, parts))
            block, used, last = block + parts, room, dim
        else:
            if dim != last or used + n > room:
                block, used, last = block + 1, 0, dim
            out.append((dim, c1, c2, block, 1))
            used += n
    return out


# --- one block ----------------------------------------------------------------------

def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
    """(first[i] + second[j], i, j) in descending order; both sequences descend."""
    heap = [(-(first[0] + second[0]), 0, 0)]
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, i, j
        if j + 1 < len(second):
            heapq.heappush(heap, (-(first[i] + second[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(first):
            heapq.heappush(heap, (-(first[i + 1] + second[0]), i + 1, 0))


class Block:
    """Rows of one block in the order of their cells, with centres and radii of the codes they use."""

    def __init__(self, t: pa.Table, dim: int, books: tuple[np.ndarray, np.ndarray]):
        c1, c2 = t.column("c1").to_numpy(), t.column("c2").to_numpy()
        order = np.lexsort((c2, c1))
        self.row, self.id, self.label = (t.column(c).to_numpy()[order] for c in ("row", "vec_id", "label"))
        x, c1, c2 = matrix(t.column("embedding"), dim)[order], c1[order], c2[order]
        self.half, self.centre, self.radius, at = dim // 2, [], [], []
        for codes, book, part in ((c1, books[0], x[:, :self.half]), (c2, books[1], x[:, self.half:])):
            used, place = np.unique(codes, return_inverse=True)
            radius = np.zeros(len(used))
            np.maximum.at(radius, place, np.sqrt(((part - book[codes]) ** 2).sum(axis=1)))
            self.centre.append(book[used])
            self.radius.append(radius)
            at.append(place)
        grid = at[0] * len(self.radius[1]) + at[1]
        edges = np.searchsorted(grid, np.arange(len(self.radius[0]) * len(self.radius[1]) + 1))
        self.edges = edges.tolist()
        self.longest = float(np.sqrt((x * x).sum(axis=1).max()))
        self.x = x
        self.whole = None  # whole numbers, made when doubles would round

    def scores(self, at: np.ndarray, q: np.ndarray, length: float) -> np.ndarray:
        if length * self.longest < 2 ** 52:  # every partial sum is exact in doubles
            return (self.x[at] @ q).astype(np.int64)
        if self.whole is None:
            self.whole = self.x.astype(np.int64)
        return self.whole[at] @ q.astype(np.int64)

    def visit(self, q: np.ndarray, fits: np.ndarray, floor, take, above: float = np.inf) -> None:
        """Visits cells in descending order of their bounds until that falls below ``floor()``.

        ``take(at, scores)`` gets the rows of visited cells for which ``fits``; cells surely over ``above`` are left out.
        """
        length = float(np.sqrt(q @ q))
        slack = 1 + 1e-12 * length * self.longest
        lows, highs, places = [], [], []
        for part, centre, radius in zip((q[:self.half], q[self.half:]), self.centre, self.radius):
            middle, reach = centre @ part, np.sqrt(part @ part) * radius
            order = np.argsort(-(middle + reach), kind="stable")
            places.append(order.tolist())
            highs.append((middle + reach)[order].tolist())
            lows.append((middle - reach)[order].tolist())
        held, n, width = [], 0, len(self.radius[1])

        def done() -> None:
            at = np.concatenate(held)
            at = at[fits[at]]
            if len(at):
                take(at, self.scores(at, q, length))

        for bound, i, j in walk(*highs):
            if bound + slack < floor():
                break
            cell = places[0][i] * width + places[1][j]
            a, b = self.edges[cell], self.edges[cell + 1]
            if a == b or lows[0][i] + lows[1][j] - slack > above:
                continue
            held.append(np.arange(a, b))
            n += b - a
            if n >= STEP:
                done()
                held, n = [], 0
        if held:
            done()

    def first(self, at: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        best = np.lexsort((self.row[at], self.id[at], -scores))[:k]
        return at[best], scores[best]


class Best:
    """The k first rows found in a window of scores, and the least score that may still enter."""

    def __init__(self, block: Block, k: int, low: int, high: int):
        self.block, self.k, self.floor, self.high = block, k, low, high
        self.at, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, at: np.ndarray, scores: np.ndarray) -> None:
        good = (scores >= self.floor) & (scores <= self.high)
        if good.any():
            self.at, self.scores = self.block.first(
                np.concatenate((self.at, at[good])), np.concatenate((self.scores, scores[good])), self.k)
            if len(self.at) == self.k:
                self.floor = max(self.floor, int(self.scores[-1]))


def positives_in(block: Block, q: np.ndarray, label: int, own: int, least: int | None, k: int) -> Best:
    best = Best(block, k, -NO_ID if least is None else least, NO_ID)
    block.visit(q, (block.label == label) & (block.row != own), lambda: best.floor, best.add)
    return best


def window(score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and largest score s with low * score <= 100 * s <= high * score, in whole numbers."""
    return -(-low * score // 100), high * score // 100


def negatives_in(block: Block, q: np.ndarray, label: int, scores: list[int], k: int, low: int, high: int) -> list[Best]:
    out = [Best(block, k, *window(s, low, high)) for s in scores]
    wide = [b for b in out if b.floor <= b.high]  # a negative positive score leaves no room

    def add(at: np.ndarray, s: np.ndarray) -> None:
        for b in wide:
            b.add(at, s)

    if wide:
        block.visit(q, block.label != label, lambda: min(b.floor for b in wide), add, max(b.high for b in wide))
    return out


# --- all blocks ---------------------------------------------------------------------

FOUND = pa.schema([("anchor", pa.int64()), ("asked", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def searched(index: DataFrame, anchors: DataFrame, books, keys: list[str], one) -> DataFrame:
    """Rows (anchor, asked, row, vec_id, score): ``one(block, anchor)`` yields (asked, Best) for each anchor of a group."""
    def both(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [pa.Table.from_batches([], FOUND)]
        if left.num_rows and right.num_rows:
            dim = left.column("dim")[0].as_py()
            missing = np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2))
            block = Block(left, dim, books.value.get(dim, missing))
            q = matrix(right.column("embedding"), dim)
            for i, a in enumerate(right.drop_columns(["embedding"]).to_pylist()):
                for asked, best in one(block, q[i], a):
                    if len(best.at):
                        parts.append(pa.table([np.full(len(best.at), a["row"]), np.full(len(best.at), asked), block.row[best.at],
                                               block.id[best.at], best.scores], schema=FOUND))
        return pa.concat_tables(parts)

    return index.groupBy(*keys).cogroup(anchors.groupBy(*keys)).applyInArrow(
        both, "anchor long, asked long, row long, vec_id long, score long")


def ranked(found: DataFrame, k: int, *by: str) -> DataFrame:
    """The first k of each list, with their rank; partial lists are cut before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _id(c: str) -> Column:
    return F.when(F.col(c) != NO_ID, F.col(c))


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                   every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = SCALE, codes: int = CODES, elements: int = ELEMENTS, group: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    v = materialize(usable(vectors, id_col, label_col, vec_col, scale), "negatives_vectors")
    books = spark.sparkContext.broadcast(codebooks(v, codes))
    celled = materialize(with_cells(v, books).withColumn("row", F.monotonically_increasing_id()), "negatives_cells")
    counts = celled.groupBy("dim", "c1", "c2").agg(F.count(F.lit(1)).alias("n")).collect()  # codes * codes rows a dimension
    placed = cell_blocks([tuple(r) for r in counts], elements)
    cells = spark.createDataFrame(placed, "dim int, c1 int, c2 int, first int, parts int")
    index = celled.join(F.broadcast(cells), ["dim", "c1", "c2"]).withColumn(
        "block", (F.col("first") + F.pmod("row", F.col("parts"))).cast("int")).drop("first", "parts")
    index = materialize(index, "negatives_index")
    spans = {}
    for dim, _, _, first, parts in placed:
        low_block, high_block = spans.get(dim, (first, first))
        spans[dim] = min(low_block, first), max(high_block, first + parts - 1)
    ranges = spark.createDataFrame([(d, a, b) for d, (a, b) in sorted(spans.items())], "dim int, from_block int, to_block int")

    own = index.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID))
    own = materialize(own.select("row", "vec_id", "label", "embedding", "dim", "block"), "negatives_own")
    groups = max(1, -(-own.count() // group))
    own = own.withColumn("grp", F.pmod("row", F.lit(groups)))
    numbers = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    keys, wide = ["block", "grp"], index.withColumn("grp", numbers)

    def everywhere(a: DataFrame) -> DataFrame:
        return a.drop("block").join(F.broadcast(ranges), "dim").withColumn(
            "block", F.explode(F.sequence("from_block", "to_block"))).drop("from_block", "to_block")

    def best_positives(block: Block, q: np.ndarray, a: dict) -> Iterator:
        if a["block"] != a.get("home"):
            yield 0, positives_in(block, q, a["label"], a["row"], a.get("least"), positives)

    near = materialize(ranked(searched(wide, own, books, keys, best_positives), positives, "anchor"), "negatives_near")
    least = near.groupBy(F.col("anchor").alias("row")).agg(F.when(F.count(F.lit(1)) == positives, F.min("score")).alias("least"))
    asking = materialize(own.join(least, "row", "left").withColumn("home", F.col("block")), "negatives_anchors")
    far = searched(wide, everywhere(asking), books, keys, best_positives)
    chosen = materialize(ranked(near.drop("rank").unionByName(far), positives, "anchor"), "negatives_positives")

    def best_negatives(block: Block, q: np.ndarray, a: dict) -> Iterator:
        return zip(a["scores"], negatives_in(block, q, a["label"], a["scores"], negatives, low, high))

    scores = chosen.groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_set("score")).alias("scores"))
    asking = everywhere(own.join(scores, "row"))
    found = ranked(searched(wide, asking, books, keys, best_negatives), negatives, "anchor", "asked")
    found = found.select("anchor", F.col("asked").alias("score"), "rank", _id("vec_id").alias("negative_id"),
                         F.col("score").alias("negative_score"))
    names = own.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    pairs = chosen.select("anchor", F.col("score"), _id("vec_id").alias("positive_id")).join(names, "anchor")
    return pairs.join(found, ["anchor", "score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")


def relabelled(vectors: DataFrame) -> DataFrame:
    """The query's labels: where vec_id is divisible by 7, (label + 1) % 10."""
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(
        F.col("label")).alias("label"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(relabelled(table(spark, sf_dir, "embeddings")))


#: Brute force: every anchor's product with every row.
SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
scores AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.r, b.vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) a JOIN v b ON len(a.e) = len(b.e) AND a.r <> b.r
),
positives AS (
  SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, r) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY s.score DESC, s.vec_id NULLS LAST, s.r) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor = p.anchor AND NOT s.same
     AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""
