"""Approximate nearest neighbours by cosine: a hierarchical k-means tree searched best bin first.

The tree is fitted on a bounded sample (SAMPLE vectors, those with the smallest hashed ids); its
nodes are all that is sent to tasks. Every row is indexed: it descends the tree to a leaf, and rows with the
same vector are indexed once, with their K + 1 smallest ids, which is all that any answer can need.
A query walks the tree with a priority queue, nearest centre first, and visits the leaves in the order
they leave the queue. The number of visits is calibrated: for CALIBRATION queries the exact answer is computed
against all rows, and the visits are widened until RECALL of it lies in visited leaves.

Leaves and the queries that visit them are dealt out in pieces of bounded size, so a leaf with a
third of all rows is many tasks. Scores are exact cosines of the original vectors in double precision.
Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a null id and
vectors of another length than the commonest; a repeated row counts once. Columns besides id and vector are not used.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from gritstone.llm.store import stored

K = 5
SAMPLE = 20_000
BRANCHES = 8
LEAF = 400
ROUNDS = 8
CALIBRATION = 200
RECALL = 0.97
PIECE_ROWS = 4096
PIECE_QUERIES = 2048
WALK = 16


class Tree:
    """Centres by node; ``children`` of a node are node numbers, empty for a leaf."""

    def __init__(self, sample: np.ndarray, seed: int = 0):
        self.centres, self.children, self.leaf = [np.zeros(sample.shape[1])], [[]], []
        rng = np.random.default_rng(seed)
        todo = [(0, np.arange(len(sample)))]
        while todo:
            node, rows = todo.pop()
            parts = self.divide(sample[rows], rng) if len(rows) > LEAF else []
            if len(parts) < 2:
                continue
            for centre, members in parts:
                self.children[node].append(len(self.centres))
                todo.append((len(self.centres), rows[members]))
                self.centres.append(centre)
                self.children.append([])
        self.centres = np.array(self.centres, dtype=np.float32)
        self.leaf = [node for node, below in enumerate(self.children) if not below]

    @staticmethod
    def divide(points: np.ndarray, rng: np.random.Generator) -> list[tuple[np.ndarray, np.ndarray]]:
        centres = points[rng.choice(len(points), BRANCHES, replace=False)]
        for _ in range(ROUNDS):
            nearest = (points @ centres.T).argmax(axis=1)
            for k in range(BRANCHES):
                if (nearest == k).any():
                    mean = points[nearest == k].mean(axis=0)
                    centres[k] = mean / (np.linalg.norm(mean) or 1.0)
        nearest = (points @ centres.T).argmax(axis=1)
        return [(centres[k], np.flatnonzero(nearest == k)) for k in range(BRANCHES) if (nearest == k).any()]

    def descend(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: at every node the child with the nearest centre."""
        at = np.zeros(len(points), dtype=np.int32)
        open_nodes = [0] if self.children[0] else []
        while open_nodes:
            node = open_nodes.pop()
            rows = np.flatnonzero(at == node)
            below = np.array(self.children[node], dtype=np.int32)
            if len(rows):
                at[rows] = below[(points[rows] @ self.centres[below].T).argmax(axis=1)]
            open_nodes += [child for child in below.tolist() if self.children[child]]
        return at

    def best_bins(self, query: np.ndarray, visits: int, rows_in: dict[int, int]) -> list[int]:
        """Leaves in the order best-bin-first meets them: ``visits`` of them, and more until K + 1 rows are met."""
        queue, found, met = [(0.0, 0)], [], 0
        while queue and (len(found) < visits or met <= K):
            _, node = heapq.heappop(queue)
            below = self.children[node]
            if not below:
                if rows_in.get(node):
                    found.append(node)
                    met += rows_in[node]
                continue
            for child, near in zip(below, (self.centres[below] @ query).tolist()):
                heapq.heappush(queue, (-near, child))
        return found


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) if len(vectors) else np.zeros((0, 1))


def _units(points: np.ndarray) -> np.ndarray:
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, on the vectors as they are."""
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector): one row per different row that takes part."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias("vec_id"), v.alias("vector")).where(
        F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & ~F.exists("vector", bad)
        & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    size = common[0]["size"] if common else 1
    return rows.where(F.size("vector") == size).distinct()


def exact_best(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, leaf, score): the k best of all rows for a bounded set of queries, by brute force."""
    ids, points = queries["vec_id"].to_numpy(), _matrix(queries["vector"])

    def run(frames):
        for pdf in frames:
            table = _units(_matrix(pdf["vector"])) @ _units(points).T
            for j, query in enumerate(ids):
                best = np.argsort(-table[:, j], kind="stable")[: k + 1]
                yield pd.DataFrame({"query_id": query, "vec_id": pdf["vec_id"].to_numpy()[best],
                                    "leaf": pdf["leaf"].to_numpy()[best], "score": table[best, j]})

    found = rows.mapInPandas(run, "query_id bigint, vec_id bigint, leaf int, score double").where("query_id <> vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def calibrated_visits(tree: Tree, rows: DataFrame, queries: DataFrame, rows_in: dict[int, int], recall: float) -> int:
    """The fewest leaf visits that reach ``recall`` of the exact answers of CALIBRATION queries."""
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).toPandas()
    if not len(chosen):
        return 1
    exact = exact_best(rows, chosen, K).toPandas()
    places = []
    for query, vector in zip(chosen["vec_id"], _units(_matrix(chosen["vector"]))):
        place = {leaf: n for n, leaf in enumerate(tree.best_bins(vector, len(tree.leaf), rows_in), 1)}
        places += [place[leaf] for leaf in exact.loc[exact["query_id"] == query, "leaf"]]
    visits = 1
    while places and np.mean(np.array(places) <= visits) < recall:
        visits += 1
    return visits


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding",
            recall: float = RECALL, seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): the K nearest of ``vectors`` found for every row of ``queries``, itself excluded.

    Nearest first, ties to the smaller id; all candidates where there are fewer than K.
    """
    rows = usable(vectors, key, vector)
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    ranked = stored(
        rows.withColumn("copy", F.row_number().over(by_vector)).where(F.col("copy") <= K + 1)
        .withColumn("head", F.min("vec_id").over(by_vector)), "copies")
    heads = ranked.where(F.col("copy") == 1).select("vec_id", "vector")
    sample = heads.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    tree = Tree(_units(_matrix(sample["vector"])).astype(np.float32), seed)

    def place(frames):
        for pdf in frames:
            yield pdf.assign(leaf=tree.descend(_units(_matrix(pdf["vector"])).astype(np.float32)))

    index = stored(heads.mapInPandas(place, "vec_id bigint, vector array<double>, leaf int"), "index")
    sizes = index.groupBy("leaf").agg(F.count("*").alias("n"))  # a row per leaf, which the sample bounds
    rows_in = {row["leaf"]: row["n"] for row in sizes.collect()}
    asked = usable(queries, key, vector)
    visits = calibrated_visits(tree, index, asked, rows_in, recall)

    def walk(frames):
        for pdf in frames:
            for at in range(0, len(pdf), WALK):  # every query is repeated for each leaf that it visits
                some = pdf.iloc[at : at + WALK]
                leaves = [tree.best_bins(q, visits, rows_in) for q in _units(_matrix(some["vector"])).astype(np.float32)]
                yield some.assign(leaf=leaves).explode("leaf").dropna(subset=["leaf"]).astype({"leaf": "int32"})

    asked = stored(asked.mapInPandas(walk, "vec_id bigint, vector array<double>, leaf int"), "visits")
    pieces = sizes.join(asked.groupBy("leaf").agg(F.count("*").alias("m")), "leaf").select(
        "leaf", F.ceil(F.col("n") / PIECE_ROWS).cast("int").alias("row_pieces"),
        F.ceil(F.col("m") / PIECE_QUERIES).cast("int").alias("query_pieces"))

    def dealt(frame: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one piece of its own side, and in every piece of the other's."""
        return frame.join(pieces, "leaf").select(
            "leaf", "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.col(f"{own}_pieces")).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(f"{other}_pieces") - 1)).alias(other))

    def score(_, members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(asking):
            return pd.DataFrame({"query_id": [], "head": [], "score": []})
        points, wanted = _matrix(members["vector"]), _matrix(asking["vector"])
        near = _units(wanted) @ _units(points).T
        keep = min(K + 1, near.shape[1])
        least = np.partition(near, -keep, axis=1)[:, -keep]
        q, p = np.nonzero(near >= least[:, None] - 1e-12)
        return pd.DataFrame({"query_id": asking["vec_id"].to_numpy()[q], "head": members["vec_id"].to_numpy()[p],
                             "score": cosines(wanted[q], points[p])})

    place_in = ["leaf", "row", "query"]
    scored = dealt(index, "row", "query").groupBy(*place_in).cogroup(
        dealt(asked, "query", "row").groupBy(*place_in)).applyInPandas(score, "query_id bigint, head bigint, score double")
    by_query = Window.partitionBy("query_id")
    best = scored.withColumn("n", F.row_number().over(by_query.orderBy(F.desc("score"), "head"))).where(F.col("n") <= K + 1)
    answers = best.drop("n").join(ranked.select("head", "vec_id"), "head").where("vec_id <> query_id")
    return answers.withColumn("rank", F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))) \
        .where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")
