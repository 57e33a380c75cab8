"""Approximate nearest neighbours by inner product: inverted lists, scanned with
an adaptive number of dimensions.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, and
queries a zero: Euclidean order then is that of inner products. A random
rotation makes any first d dimensions a fair sample of the distance. Within each
probed list, the distances of all its queries are summed column block by column
block; after each block a pair is abandoned if its distance, projected to all
dimensions, is beyond the query's k-th so far by more than the test's margin
(1 + EPSILON / sqrt(d))^2. A query's k-th starts from some vectors of the cell and
falls with every list. While many pairs are left, a block is a matrix product, later
only what is left is worked out. The k nearest are scored on the original vectors in
double precision.

Lists are fitted to at most about ``SAMPLE`` vectors; every vector is indexed.
A query probes as many lists as gave ``TARGET`` recall for sampled queries among
the sampled vectors (their neighbours lie farther, so more lists are needed than
in the whole), and on until these hold k candidates.

Lists are dealt to cells of at most about ``CELL`` vectors, 16 cells at least as
long as these hold a sixteenth of that (small lists together, a large list over
several cells by hash of the id), a cell's queries to chunks of about ``CHUNK``. A task thus sees a bounded group, however frequent
a vector or a region is, and emits k rows a query at most.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components, that have a null id, or another length than most take no part; rows
of one id are one vector, the least by its components; fewer than k candidates
give that many rows; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaymart.llm.common import written

K = 20
SAMPLE = 8192
MAX_LISTS = 4096
TARGET = 0.97
CELL = 8192
CHUNK = 8192
BLOCK = 16
#: Vectors of a cell that give its queries a first limit.
SEEDS = 256
#: Pairs of a list and its queries worked on together, and share left above which a block is a matrix product.
PAIRS, DENSE = 1 << 20, 0.2
EPSILON = 2.1


@functools.lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def _rotated(x: np.ndarray, largest: float | None) -> np.ndarray:
    """largest: M for vectors, None for queries."""
    extra = np.zeros(len(x)) if largest is None else np.sqrt(np.maximum(0.0, largest**2 - (x * x).sum(axis=1)))
    return np.column_stack([x, extra]) @ rotation(x.shape[1] + 1)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * a @ b.T


def fit_lists(sample: np.ndarray, n_lists: int, rounds: int = 8) -> np.ndarray:
    """Centroids of rotated vectors by Lloyd's iterations."""
    rng = np.random.default_rng(1)
    centroids = sample[rng.choice(len(sample), min(n_lists, len(sample)), replace=False)]
    for _ in range(rounds):
        at = _squares(sample, centroids).argmin(axis=1)
        n = np.bincount(at, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, sample)
        centroids = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centroids)
    return centroids


def probes_for(sample: np.ndarray, queries: np.ndarray, own: np.ndarray, centroids: np.ndarray, k: int,
               target: float) -> int:
    """How many nearest lists hold the target share of the sampled queries' neighbours."""
    if len(sample) < 2 or not len(queries):
        return len(centroids)
    far = _squares(queries, sample)
    far[np.arange(len(queries)), own] = np.inf
    k = min(k, len(sample) - 1)
    near = np.argpartition(far, k - 1, axis=1)[:, :k]
    list_of = _squares(sample, centroids).argmin(axis=1)
    rank = np.argsort(np.argsort(_squares(queries, centroids), axis=1), axis=1)
    needed = np.take_along_axis(rank, list_of[near], axis=1).ravel()
    return int(np.quantile(needed, target, method="higher")) + 1


def _usable(v: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


class Nearest:
    """The k nearest candidates so far of some queries, and the k-th's distance."""

    def __init__(self, n: int, k: int):
        self.k, self.limit = k, np.full(n, np.inf)
        self.q, self.x, self.far = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, q: np.ndarray, x: np.ndarray, far: np.ndarray) -> None:
        self.waiting.append((q, x, far))
        self.size += len(q)
        if self.size > max(len(self.limit) * self.k // 4, 1024):
            self.settle()

    def settle(self) -> None:
        """Keep each query's k nearest, and all as near as the last of them."""
        parts = [(self.q, self.x, self.far), *self.waiting]
        q, x, far = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((far, q))
        q, x, far = q[order], x[order], far[order]
        first = np.searchsorted(q, np.arange(len(self.limit)))
        count = np.diff(np.append(first, len(q)))
        full = count >= self.k
        self.limit[full] = far[first[full] + self.k - 1]
        stay = far <= self.limit[q] + 1e-9
        self.q, self.x, self.far, self.waiting, self.size = q[stay], x[stay], far[stay], [], 0


def _scan(best: Nearest, queries: np.ndarray, held: np.ndarray, qb: list[np.ndarray], xb: list[np.ndarray],
          qn: list[np.ndarray], xn: list[np.ndarray], taken: np.ndarray, own: np.ndarray) -> int:
    """One list's vectors (``held``) against the queries that probe it, block of
    columns by block; returns how many column products were worked out."""
    dim, d, products = sum(b.shape[1] for b in xb), 0, 0
    far = np.zeros((len(queries), len(held)))
    pairs = None
    for k in range(len(xb)):
        width = xb[k].shape[1]
        d += width
        margin = (1 + EPSILON / d**0.5) ** 2 * d / dim if d < dim else 1.0
        if pairs is None:
            far += qn[k][queries][:, None] + xn[k][held] - 2 * (qb[k][queries] @ xb[k][held].T)
            products += far.size * width
            stay = far <= (best.limit[queries] * margin + 1e-9)[:, None]
            if k == 0:
                stay &= ~taken[held] & (own[queries][:, None] != held)
            else:
                stay &= alive
            alive = stay
            if d == dim or stay.mean() <= DENSE:
                i, j = np.nonzero(stay)
                pairs, left = (i, j), far[i, j]
        else:
            i, j = pairs
            left += ((qb[k][queries[i]] - xb[k][held[j]]) ** 2).sum(axis=1)
            products += len(i) * width
            stay = left <= best.limit[queries[i]] * margin + 1e-9
            pairs, left = (i[stay], j[stay]), left[stay]
    i, j = pairs
    best.add(queries[i], held[j], left)
    return products


def scan_cell(ids: np.ndarray, x: np.ndarray, lists: np.ndarray, query_ids: np.ndarray, q: np.ndarray,
              probed: list[np.ndarray], largest: float, k: int, work: list[int] | None = None,
              ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, ids, scores) of each query's best k in the lists it probes here.
    ``work``: gets the column products worked out, and those of all pairs."""
    xr, qr = _rotated(x, largest), _rotated(q, None)
    cuts = range(0, xr.shape[1], BLOCK)
    xb, qb = ([np.ascontiguousarray(m[:, a:a + BLOCK]) for a in cuts] for m in (xr, qr))
    xn, qn = ([(b * b).sum(axis=1) for b in blocks] for blocks in (xb, qb))
    by_id = np.argsort(ids, kind="stable")
    at = np.minimum(np.searchsorted(ids[by_id], query_ids), len(ids) - 1)
    own = np.where(ids[by_id[at]] == query_ids, by_id[at], -1)
    best, taken, products, pairs = Nearest(len(query_ids), k), np.zeros(len(ids), bool), 0, 0
    everyone = np.arange(len(query_ids))
    seeds = np.random.default_rng(len(ids)).permutation(len(ids))[:SEEDS]
    for some in np.array_split(everyone, -(-len(everyone) * max(1, len(seeds)) // PAIRS)):
        products += _scan(best, some, seeds, qb, xb, qn, xn, taken, own)
    best.settle()
    taken[seeds] = True
    # a list's queries, those lists first that are nearest to most of them
    place = np.concatenate([np.arange(len(p)) for p in probed])
    asked = np.concatenate([np.asarray(p, np.int64) for p in probed])
    who = np.repeat(everyone, [len(p) for p in probed])
    found, group = np.unique(asked, return_inverse=True)
    near = np.bincount(group, weights=place) / np.bincount(group)
    for one in np.argsort(near, kind="stable"):
        queries, held = who[group == one], np.flatnonzero(lists == found[one])
        pairs += len(queries) * len(held)
        if len(held):
            for some in np.array_split(queries, -(-len(queries) * len(held) // PAIRS)):
                products += _scan(best, some, held, qb, xb, qn, xn, taken, own)
    best.settle()
    if work is not None:
        work += [products, pairs * xr.shape[1]]
    first = np.searchsorted(best.q, np.arange(len(query_ids) + 1))
    for i, query in enumerate(query_ids.tolist()):
        here = best.x[first[i]:first[i + 1]]
        if len(here):
            scores = (x[here] * q[i]).sum(axis=1)
            top = np.lexsort((ids[here], -scores))[:k]
            yield query, ids[here][top], scores[top]


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest. ``is_query``
    is a condition on vec_id; vectors have vec_id and embedding."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v")).filter(
        F.col("vec_id").isNotNull() & _usable(F.col("v")))
    usable = written(usable.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, y: s + y.cast("double") * y.cast("double")))
    sizes = usable.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest"))
    top = sizes.orderBy(F.desc("n"), "dim").limit(1).collect()
    if not top:
        return spark.createDataFrame([], schema)
    dim, n, largest = top[0].dim, top[0].n, top[0].largest
    usable = usable.filter(F.size("v") == dim)

    share = int(min(1.0, SAMPLE / n) * 2**31)
    sampled = usable.filter(F.pmod(F.xxhash64("vec_id"), F.lit(2**31)) < F.lit(share)).orderBy("vec_id").toPandas()
    sample = _matrix(sampled["v"]) if len(sampled) else np.zeros((0, dim))
    rotated = _rotated(sample, largest)
    if not len(sample):  # the hash chose none of very few
        rotated = np.zeros((1, dim + 1))
    centroids = fit_lists(rotated, min(MAX_LISTS, max(1, round(n**0.5))))
    tries = np.random.default_rng(2).permutation(len(sample))[:256]
    n_probe = probes_for(rotated, _rotated(sample[tries], None), tries, centroids, k, TARGET)
    fitted = spark.sparkContext.broadcast((centroids, largest))

    def to_list(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centroids, largest = fitted.value
        for frame in frames:
            if len(frame):
                yield frame.assign(list=_squares(_rotated(_matrix(frame["v"]), largest), centroids).argmin(axis=1))

    element = usable.schema["v"].dataType.elementType.simpleString()
    listed = written(usable.mapInPandas(to_list, f"vec_id long, v array<{element}>, list int"), "listed")

    # at most MAX_LISTS rows; small lists share a cell, large ones have several
    in_list = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}
    full = min(CELL, max(CELL // 16, -(-n // 16)))
    first_cell, cells_of, cell, filled = {}, {}, 0, 0
    for one in sorted(in_list):
        size = in_list[one]
        parts = -(-size // full)
        if parts > 1 or filled + size > full:
            cell, filled = cell + (filled > 0), 0
        first_cell[one], cells_of[one] = cell, parts
        if parts > 1:
            cell += parts
        else:
            filled += size
    counts = np.array([in_list.get(one, 0) for one in range(len(centroids))])
    layout = spark.sparkContext.broadcast((counts, first_cell, cells_of))

    def to_cell(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, first_cell, cells_of = layout.value
        for frame in frames:
            part = frame.pop("h") % frame["list"].map(cells_of)
            yield frame.assign(cell=frame["list"].map(first_cell) + part)

    placed = listed.withColumn("h", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(2**31))).mapInPandas(
        to_cell, f"vec_id long, v array<{element}>, list int, cell long")

    def to_probes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centroids, _ = fitted.value
        counts, first_cell, cells_of = layout.value
        for frame in frames:
            if not len(frame):
                continue
            near = np.argsort(_squares(_rotated(_matrix(frame["v"]), None), centroids), axis=1, kind="stable")
            enough = np.cumsum(counts[near], axis=1) > k  # k candidates besides the query itself
            rows = []
            for query, v, lists, full in zip(frame["vec_id"], frame["v"], near, enough):
                wanted = max(n_probe, int(full.argmax()) + 1 if full.any() else len(lists))
                by_cell: dict[int, list[int]] = {}
                for one in lists[:wanted].tolist():
                    if counts[one]:
                        for c in range(first_cell[one], first_cell[one] + cells_of[one]):
                            by_cell.setdefault(c, []).append(one)
                rows += [(query, v, c, found) for c, found in by_cell.items()]
            yield pd.DataFrame(rows, columns=["query_id", "q", "cell", "lists"])

    probes = written(listed.filter(is_query).select("vec_id", "v").mapInPandas(
        to_probes, f"query_id long, q array<{element}>, cell long, lists array<int>"), "probes")
    chunks = written(probes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks")), "chunks")
    asked = probes.join(chunks, "cell").withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks"))).drop("chunks")
    held = placed.join(chunks, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))

    def scan(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(held) and len(asked):
            found = scan_cell(held["vec_id"].to_numpy(), _matrix(held["v"]), held["list"].to_numpy(),
                              asked["query_id"].to_numpy(), _matrix(asked["q"]), asked["lists"].to_list(), largest, k)
            out = [pd.DataFrame({"query_id": query, "vec_id": ids, "score": scores}) for query, ids, scores in found]
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = held.drop("chunks").groupBy("cell", "chunk").cogroup(asked.groupBy("cell", "chunk")).applyInPandas(
        scan, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
