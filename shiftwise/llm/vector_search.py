"""Nearest neighbours by collision-counting hashing over single-projection sorted arrays.

Largest inner product becomes smallest distance by one more component: vectors
get sqrt(M*M - |x|*|x|), queries 0, with M the largest norm of all vectors.
Each hash function is one Gaussian projection; a block of vectors keeps, per
function, its projections sorted. A window centred on the query's projection
collides with the vectors inside it. The windows widen by a constant factor
(virtual rehashing) until enough vectors have collided under at least a
threshold share of the functions; those are verified by their exact inner
product.

Every vector is indexed, in blocks of bounded size; the stated queries meet
every block, in blocks of their own. Per block each query returns its k best,
and one ranking per query merges them. Vectors that are null, empty, zero or
hold null or non-finite components take no part; vectors meet only those of
their own dimension; rows with the query's own vec_id are not its neighbours;
a repeated query id is asked once (its smallest vector). Empty tables give no
rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftwise.llm.common import table

K = 20
FUNCTIONS = 40
THRESHOLD = 0.65  # share of the functions a vector must collide under
VERIFY = 0.3  # share of a block that is verified at least
WIDEN = 1.5
DATA_BLOCK, QUERY_BLOCK = 8192, 4096
SEED = 29


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, embedding as doubles, dim) of the vectors that take part."""
    v = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("embedding").isNotNull() & fine & F.exists("embedding", lambda x: x != 0)).withColumn(
        "dim", F.size("embedding"))


def exact_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products summed component after component, so equal vectors score equally wherever they stand."""
    out = np.zeros(len(x))
    for d in range(x.shape[1]):
        out += x[:, d] * q[d]
    return out


class SortedProjections:
    """The index of one block."""

    def __init__(self, x: np.ndarray, largest: float):
        self.x, n = x, len(x)
        norms = np.minimum((x * x).sum(axis=1), largest)
        lifted = np.hstack([x, np.sqrt(largest - norms)[:, None]])
        rng = np.random.default_rng([SEED, x.shape[1]])
        self.functions = rng.standard_normal((lifted.shape[1], FUNCTIONS))
        p = np.ascontiguousarray((lifted @ self.functions).T)
        self.order = np.argsort(p, axis=1, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(p, self.order, axis=1)
        self.least = min(n, max(10 * K, int(VERIFY * n)))
        self.start = 0.3 * float(np.sqrt(largest))

    def candidates(self, projected: np.ndarray) -> list[np.ndarray]:
        """Per query (rows of ``projected``) the vectors that reach the collision threshold.

        All queries widen together; one that has enough candidates stops.
        """
        n, need = len(self.x), int(np.ceil(THRESHOLD * FUNCTIONS))
        found: list = [None] * len(projected)
        counts = np.zeros((len(projected), n), np.int16)
        active, width = np.arange(len(projected)), self.start
        low = high = np.zeros((FUNCTIONS, 0), np.int64)
        while len(active):
            q = projected[active]
            new_low = np.array([np.searchsorted(v, q[:, j] - width) for j, v in enumerate(self.values)])
            new_high = np.array([np.searchsorted(v, q[:, j] + width, "right") for j, v in enumerate(self.values)])
            if not low.shape[1]:  # at first the windows are empty, at their left ends
                low, high = new_low, new_low
            keep = []
            for at, i in enumerate(active.tolist()):
                ends = zip(self.order, new_low[:, at].tolist(), low[:, at].tolist(), high[:, at].tolist(),
                           new_high[:, at].tolist())
                hit = np.concatenate([x for o, a, b, c, d in ends for x in (o[a:b], o[c:d])])
                counts[i] += np.bincount(hit, minlength=n).astype(np.int16)
                enough = np.flatnonzero(counts[i] >= need)
                if len(enough) >= self.least or (not new_low[:, at].any() and (new_high[:, at] == n).all()):
                    found[i] = enough
                else:
                    keep.append(at)
            active, low, high = active[keep], new_low[:, keep], new_high[:, keep]
            width *= WIDEN
        return found


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, largest: float,
                 k: int = K) -> pd.DataFrame:
    index = SortedProjections(x, largest)
    # every query at the scale of the vectors: only its direction matters
    scale = np.sqrt(largest) / np.sqrt((queries * queries).sum(axis=1))
    projected = (queries * scale[:, None]) @ index.functions[:-1]
    out = []
    for qid, q, c in zip(query_ids.tolist(), queries, index.candidates(projected)):
        c = c[ids[c] != qid]
        if len(c) > 4 * k:  # rough products first; what could be among the k best after rounding stays
            rough = x[c] @ q
            kth = -np.partition(-rough, k)[k]
            c = c[rough >= kth - 1e-9 * (1 + abs(kth))]
        scores = exact_products(x[c], q)
        best = np.lexsort((ids[c], -scores))[:k]
        out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[c][best], "score": scores[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def search(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 20, k: int = K,
           data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The k vectors of largest inner product for every row whose id is divisible by ``every``."""
    v = usable(vectors, id_col, vec_col)
    asked = v.where(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min("embedding").alias("embedding"))
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    n, largest = v.agg(F.count(F.lit(1)), F.max(norm2)).first()
    schema = "query_id long, vec_id long, score double"
    blocks = max(1, -(-n // data_block))
    query_blocks = max(1, -(-(-(-n // every)) // query_block))
    data = (v.withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)))
            .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    queries = (asked.withColumn("query_block", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
               .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    top = float(largest or 0.0)

    def one(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return search_block(left["vec_id"].to_numpy(), np.stack(left["embedding"].to_list()),
                            right["vec_id"].to_numpy(), np.stack(right["embedding"].to_list()), top, k)

    keys = ["dim", "block", "query_block"]
    queries = queries.withColumn("block", F.col("block").cast("long"))
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(one, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))
