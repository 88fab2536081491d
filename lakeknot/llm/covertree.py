"""Exact top-k inner products by dual-tree search over cover trees.

Vectors become integers floor(256 * x). Rows are dealt by place: to the nearest of a few pivots, and by hash within a
pivot's cell, into blocks of about INDEX_ROWS candidates and QUERY_ROWS queries; each block gets a cover tree, built
once and stored: a node's children are centres chosen by farthest-first traversal, so they stand at least as far apart
as the radius that they cover, and radii shrink from level to level. A query block and an index block are searched by
descending both trees together: a pair of nodes is pruned when the largest inner product that their covering radii
allow is below the worst kth score in the query node.

Each query block first searches the index blocks whose centres promise most. Its kth scores then bound the others:
pairs of blocks whose roots can't reach the worst of them are dropped before any tree is sent, and those that are
left start from them. Scores are exact integers (products that a double can't hold are taken with unbounded ones);
a score beyond the range of a long is the end of that range. Ties go to the smaller id.

Vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with a null id; vectors of
different lengths are searched apart; a query's own id is never its answer; repeated ids are answered as rows; with
fewer than k candidates all are returned; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stored

K, EVERY = 5, 50
INDEX_ROWS, QUERY_ROWS = 8192, 2048
LEAF, FANOUT = 48, 24
#: Rows from which pivots are chosen, pivots of one dimension, index blocks that a query block searches before all others.
PIVOT_SAMPLE, PIVOTS, FIRST = 2048, 256, 2
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)
#: The largest double; larger components count as it.
LARGEST = float(np.finfo(np.float64).max)
NONE, LEAST, MOST = -(1 << 63), 1 - (1 << 63), (1 << 63) - 1


class CoverTree:
    """nodes: centre (a row), radius over all descendants, children or rows."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points = ids, points
        self.largest = float(np.abs(points).max()) if points.size else 0.0
        # beyond this distances would overflow; such a block is one leaf that is never pruned
        self.plain = self.largest < 1e100
        with np.errstate(over="ignore"):
            self.norm = np.sqrt((points * points).sum(1))
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.rows: list[np.ndarray | None] = []
        if len(ids) and self.plain:
            self._build(0, np.arange(len(ids)), self._distance(0, np.arange(len(ids))))
        elif len(ids):
            self.centre, self.radius, self.children, self.rows = [0], [np.inf], [[]], [np.arange(len(ids))]

    def _distance(self, centre: int, rows: np.ndarray) -> np.ndarray:
        d = self.points[rows] - self.points[centre]
        return np.sqrt((d * d).sum(1))

    def _build(self, centre: int, rows: np.ndarray, dist: np.ndarray) -> int:
        node = len(self.centre)
        self.centre.append(centre), self.radius.append(float(dist.max())), self.children.append([]), self.rows.append(None)
        if len(rows) <= LEAF or self.radius[node] == 0:
            self.rows[node] = rows
            return node
        centres, near, best = [centre], np.zeros(len(rows), np.int64), dist.copy()
        while len(centres) < FANOUT:
            far = int(best.argmax())
            if best[far] == 0:
                break
            d = self._distance(int(rows[far]), rows)
            closer = d < best
            near[closer], best[closer] = len(centres), d[closer]
            centres.append(int(rows[far]))
        for k, c in enumerate(centres):
            some = near == k
            self.children[node].append(self._build(c, rows[some], best[some]))
        return node

    def freeze(self) -> CoverTree:
        self.centres = self.points[self.centre] if self.centre else self.points[:0]
        self.radii = np.array(self.radius)
        self.centre_norm = self.norm[self.centre] if self.centre else self.norm[:0]
        return self


class DualSearch:
    """The k best rows of index for each of queries; kth: scores that are known to be reached elsewhere already (NONE: not known)."""

    def __init__(self, queries: CoverTree, index: CoverTree, k: int, kth: np.ndarray | None = None):
        self.q, self.r, self.k = queries.freeze(), index.freeze(), k
        self.score = np.full((len(queries.ids), k), NONE, np.int64)
        self.found = np.full((len(queries.ids), k), MOST, np.int64)
        self.least = np.full(len(queries.ids), NONE, np.int64) if kth is None else kth
        self.exact = queries.largest * index.largest * max(1, queries.points.shape[1] if queries.points.ndim > 1 else 1) < EXACT
        self.compared = 0
        if len(queries.ids) and len(index.ids):
            self._descend(0, np.array([0]))

    def _worst(self, rows: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[rows, -1], self.least[rows])

    def _bounds(self, node: int, index_nodes: np.ndarray) -> np.ndarray:
        q, r = self.q, self.r
        rq, rr = q.radii[node], r.radii[index_nodes]
        with np.errstate(over="ignore", invalid="ignore"):
            # |q.r| moves by at most these when both ends move within their radii; a little more for rounding
            reach = q.centre_norm[node] * rr + r.centre_norm[index_nodes] * rq + rq * rr
            product = r.centres[index_nodes] @ q.centres[node]
            out = product + reach + 1e-3 + 1e-9 * (reach + q.centre_norm[node] * r.centre_norm[index_nodes])
        return np.where(np.isnan(out), np.inf, out)

    def _products(self, rows: np.ndarray, some: np.ndarray) -> np.ndarray:
        if self.exact:
            return (self.q.points[rows] @ self.r.points[some].T).astype(np.int64)
        whole = lambda x: np.array([[int(v) for v in row] for row in x.tolist()], object)
        return np.clip(whole(self.q.points[rows]) @ whole(self.r.points[some]).T, LEAST, MOST).astype(np.int64)

    def _rows(self, node: int) -> np.ndarray:
        q = self.q
        return q.rows[node] if q.rows[node] is not None else np.concatenate([self._rows(c) for c in q.children[node]])

    def _descend(self, node: int, frontier: np.ndarray) -> None:
        q, r = self.q, self.r
        rows = self._rows(node)
        frontier = frontier[self._bounds(node, frontier) >= self._worst(rows).min()]
        # the side with the larger radius is opened; a leaf of the index stays
        wider = [n for n in frontier.tolist() if r.rows[n] is None and (q.rows[node] is not None or r.radii[n] > q.radii[node])]
        if wider:
            kept = [n for n in frontier.tolist() if n not in set(wider)]
            opened = np.array(kept + [c for n in wider for c in r.children[n]], np.int64)
            return self._descend(node, opened)
        if q.rows[node] is None:
            for c in q.children[node]:
                self._descend(c, frontier)
            return None
        bound = self._bounds(node, frontier)
        order = np.argsort(-bound, kind="stable")
        frontier, bound = frontier[order], bound[order]
        at = 0
        while at < len(frontier):
            if bound[at] < self._worst(rows).min():
                break
            some = np.concatenate([r.rows[n] for n in frontier[at : at + 8].tolist()])
            at += 8
            self._compare(rows, some)
        return None

    def _compare(self, rows: np.ndarray, some: np.ndarray) -> None:
        q, r, k = self.q, self.r, self.k
        self.compared += len(rows) * len(some)
        s, ids = self._products(rows, some), r.ids[some]
        s[q.ids[rows][:, None] == ids[None, :]] = NONE
        for i in np.flatnonzero((s >= np.maximum(self._worst(rows), LEAST)[:, None]).any(1)):
            row = rows[i]
            hit = np.flatnonzero(s[i] >= max(self._worst(rows[i : i + 1])[0], LEAST))
            score, found = np.concatenate([self.score[row], s[i, hit]]), np.concatenate([self.found[row], ids[hit]])
            best = np.lexsort((found, ~score))[:k]
            self.score[row], self.found[row] = score[best], found[best]


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, z: the integer vectors of rows that take part."""
    ok = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))

    def whole(x):
        y = F.least(F.greatest(x.cast("double") * 256, F.lit(-LARGEST)), F.lit(LARGEST))
        # a double this large is whole, and beyond what floor's long holds
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull() & F.coalesce(ok, F.lit(False))).select("vec_id", F.size("embedding").alias("dim"), F.transform("embedding", whole).alias("z"))


def _tree(key, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("vec_id", kind="stable")
    tree = CoverTree(rows["vec_id"].to_numpy(np.int64), np.stack(rows["z"].to_numpy()).astype(np.float64))
    centre, radius = tree.points[tree.centre[0]].tolist(), float(tree.radius[0])
    tree.points = tree.points.astype(np.int32) if tree.largest < 2**31 else tree.points
    return pd.DataFrame({"dim": [int(key[0])], "block": [int(key[1])], "centre": [centre], "radius": [radius], "rows": [len(rows)], "tree": [pickle.dumps(tree)]})


def _load(raw: bytes) -> CoverTree:
    tree = pickle.loads(raw)
    tree.points = tree.points.astype(np.float64)
    return tree


def pivots(rows: DataFrame, most: int) -> dict[int, np.ndarray]:
    """For each dimension at most `most` rows of a sample of PIVOT_SAMPLE rows, by farthest-first traversal. They only say where blocks are cut."""
    sample, out = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).toPandas(), {}
    for dim, some in sample.groupby("dim"):
        points = np.clip(np.stack(some["z"].to_numpy()).astype(np.float64), -1e100, 1e100)
        chosen, best = [0], ((points - points[0]) ** 2).sum(1)
        while len(chosen) < most and best.max() > 0:
            chosen.append(int(best.argmax()))
            best = np.minimum(best, ((points - points[chosen[-1]]) ** 2).sum(1))
        out[int(dim)] = points[chosen]
    return out


def _cells(rows: DataFrame, of: dict[int, np.ndarray]) -> DataFrame:
    """rows with cell, the nearest pivot's number."""

    def run(batches):
        for b in batches:
            dim, cell = b.column("dim").to_numpy(), np.zeros(b.num_rows, np.int32)
            flat, off = b.column("z").flatten().to_numpy(), np.append(0, np.cumsum(dim.astype(np.int64)))
            for d, p in of.items():
                some = np.flatnonzero(dim == d)
                if len(some) and len(p) > 1:
                    x = np.clip(flat[off[some][:, None] + np.arange(d)], -1e100, 1e100)
                    cell[some] = ((p * p).sum(1)[None, :] - 2 * (x @ p.T)).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], [*b.schema.names, "cell"])

    return rows.mapInArrow(run, "vec_id long, dim int, z array<double>, cell int")


def indexed(rows: DataFrame, size: int, of: dict[int, np.ndarray]) -> DataFrame:
    """dim, block, centre, radius, rows, tree: a cover tree for each block of about `size` rows of one cell."""
    placed = _cells(rows, of)
    # a row for each cell
    parts = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).alias("parts"))
    dealt = placed.join(F.broadcast(parts), ["dim", "cell"]).withColumn("block", (F.col("dim").cast("long") * (1 << 48)) + (F.col("cell").cast("long") * (1 << 36)) + F.pmod(F.xxhash64("vec_id"), "parts"))
    return stored(dealt.select("vec_id", "dim", "block", "z").groupBy("dim", "block").applyInPandas(_tree, "dim int, block long, centre array<double>, radius double, rows long, tree binary"))


def _searched(pairs: DataFrame, queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """q_block, query_id, vec_id, score of pairs of blocks (dim, q_block, r_block, ids, kth)."""

    def run(batches):
        for b in batches:
            for block, raw_q, raw_r, ids, kth in zip(b.column("q_block"), b.column("q"), b.column("r"), b.column("ids"), b.column("kth"), strict=True):
                q, least = _load(raw_q.as_py()), None
                if kth.is_valid:
                    known = dict(zip(ids.as_py(), kth.as_py(), strict=True))
                    least = np.array([known.get(i, NONE) for i in q.ids.tolist()], np.int64)
                found = DualSearch(q, _load(raw_r.as_py()), k, least)
                at, n = np.nonzero(found.score > NONE)
                yield pa.RecordBatch.from_arrays([pa.array([block.as_py()] * len(at), pa.int64()), pa.array(found.q.ids[at], pa.int64()), pa.array(found.found[at, n], pa.int64()), pa.array(found.score[at, n], pa.int64())], ["q_block", "query_id", "vec_id", "score"])

    q = queries.select("dim", F.col("block").alias("q_block"), F.col("tree").alias("q"))
    r = index.select("dim", F.col("block").alias("r_block"), F.col("tree").alias("r"))
    both = pairs.join(q, ["dim", "q_block"]).join(r, ["dim", "r_block"]).repartition("dim", "q_block", "r_block")
    return both.select("q_block", "q", "r", "ids", "kth").mapInArrow(run, "q_block long, query_id long, vec_id long, score long")


def search(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score, from tables of trees of both."""
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    q = queries.select("dim", F.col("block").alias("q_block"), F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    r = index.select("dim", F.col("block").alias("r_block"), F.col("centre").alias("rc"), F.col("radius").alias("rr"))
    # the stated query set against all rows, in blocks: only their roots meet here
    product = F.aggregate(F.zip_with("qc", "rc", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    reach = norm("qc") * F.col("rr") + norm("rc") * F.col("qr") + F.col("qr") * F.col("rr")
    roots = q.join(r, "dim").withColumns({"product": product, "reach": reach, "scale": norm("qc") * norm("rc")})
    order = Window.partitionBy("dim", "q_block").orderBy(F.desc("product"), "r_block")
    roots = stored(roots.select("dim", "q_block", "r_block", (F.col("product") + F.col("reach") + 1e-3 + 1e-9 * (F.col("reach") + F.col("scale"))).alias("bound"), F.row_number().over(order).alias("place")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = lambda rows: rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    blank = [F.lit(None).cast("array<long>").alias(c) for c in ("ids", "kth")]
    first = stored(top(_searched(roots.where(F.col("place") <= FIRST).select("dim", "q_block", "r_block", *blank), queries, index, k)))
    known = first.where(F.col("rank") == k).groupBy("q_block").agg(F.collect_list("query_id").alias("ids"), F.collect_list("score").alias("kth"))
    # a block is bounded when all its queries have k answers
    size = queries.select("dim", F.col("block").alias("q_block"), F.col("rows"))
    known = size.join(known, "q_block", "left").withColumn("worst", F.when(F.size("kth") == F.col("rows"), F.array_min("kth")))
    more = roots.where(F.col("place") > FIRST).join(known, ["dim", "q_block"]).where(F.col("worst").isNull() | (F.col("bound") >= F.col("worst")))
    rest = _searched(more.select("dim", "q_block", "r_block", "ids", "kth"), queries, index, k)
    return top(first.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, index_rows: int = INDEX_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    rows = integers(vectors)
    of = pivots(rows, max(1, min(PIVOTS, -(-rows.count() // index_rows))))
    index = indexed(rows, index_rows, of)
    queries = indexed(rows.where(F.col("vec_id") % every == 0), query_rows, of)
    return search(queries, index, k)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"))


def oracle(k: int = K, every: int = EVERY) -> str:
    return f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS z FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.z, c.z) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % {every} = 0 AND c.vec_id <> q.vec_id AND len(q.z) = len(c.z))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {k}"""
