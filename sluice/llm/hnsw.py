"""Approximate nearest neighbours by inner product: a hierarchical navigable
small-world graph per shard, shard results merged.

Equal vectors are one point of the index with the least ids that have them
(one more than a result can hold, so the query's own id may be among them); a
vector that a third of all rows share is cut to those ids before each shuffle.
Points are dealt to shards of a bounded size at random. A shard's graph is a
table row of flat arrays: for each layer the points in it and their neighbours,
padded with -1. Points enter in order; a point's candidates are the nearest of
those before it (found exactly, by blocks, as a shard is small), of which it
links to a diverse choice; a point with too many links keeps a diverse choice.
Largest inner product becomes least distance by a further coordinate that
gives all points of a shard the same norm.

Queries go to every shard in blocks; each shard answers with its best, scored
in double precision on the original vectors, and the best of all shards win.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither do rows without id; of the usable
vectors of one id the least counts (by components in order); vectors of another length are no candidates; an empty table
gives no rows; ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import scratch_path

NEAREST = 20
SHARD_POINTS = 32768        # a shard holds about so many points, fewer of long vectors
SHARD_BYTES = 64 << 20
LINKS = 16                  # of a point in the upper layers; twice as many in the lowest
CANDIDATES = 64             # from which links are chosen
BREADTH = 160               # points a search of a shard keeps
UPPER_BREADTH = 16          # the same in the upper layers
QUERY_BLOCK = 1024
SALTS = 16

INDEX = "dim int, shard long, n int, ids binary, vectors binary, id_ends binary, layers array<binary>, links array<binary>"


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"),
                          F.col(f"`{embedding}`").cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(
        F.exists("vector", lambda x: F.coalesce(x != 0, F.lit(False))) & ~F.coalesce(bad, F.lit(False))).withColumn(
        "dim", F.size("vector"))


def one_vector(rows: DataFrame) -> DataFrame:
    """``valid`` rows with one vector for each id, the least it has."""
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))


def points(rows: DataFrame, nearest: int) -> DataFrame:
    """``dim, vector, ids``: distinct vectors with their ``nearest + 1`` least ids."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    for keys in (["dim", "vector", "salt"], ["dim", "vector"]):
        # Spark cuts each task's rows to the limit before the shuffle.
        rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy("vec_id"))).filter(
            F.col("nth") <= nearest + 1)
    return rows.groupBy("dim", "vector").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))


def choose(space: np.ndarray, candidates: np.ndarray, likeness: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none) up to ``most``, those
    first that are nearer to the row's point than to any chosen before."""
    n, width = candidates.shape
    given = candidates >= 0
    own = space[np.maximum(candidates, 0)]
    between = own @ own.transpose(0, 2, 1)
    kept = np.zeros((n, width), bool)
    nearest = np.full((n, width), -np.inf, np.float32)
    for c in range(width):
        take = given[:, c] & (kept.sum(axis=1) < most) & (likeness[:, c] > nearest[:, c])
        kept[:, c] = take
        nearest[take] = np.maximum(nearest[take], between[take, c])
    rank = np.where(kept, 0, np.where(given, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    return np.where(np.take_along_axis(given, order, 1), np.take_along_axis(candidates, order, 1), -1)


def layer_links(space: np.ndarray, most: int) -> np.ndarray:
    """Links of the points of a layer, in the order in which they enter."""
    n = len(space)
    forward = np.full((n, LINKS), -1, np.int64)
    for low in range(0, n, 256):
        high = min(n, low + 256)
        like = space[low:high] @ space[:high].T
        like[np.arange(high)[None, :] >= np.arange(low, high)[:, None]] = -np.inf
        width = min(CANDIDATES, high)
        best = np.argpartition(-like, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(like, best, 1)
        order = np.argsort(-value, axis=1, kind="stable")
        best, value = np.take_along_axis(best, order, 1), np.take_along_axis(value, order, 1)
        best = np.where(np.isfinite(value), best, -1)
        got = choose(space, best, value, LINKS)
        forward[low:high, :got.shape[1]] = got
    source, target = np.nonzero(forward >= 0)[0], forward[forward >= 0]
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    like = np.einsum("ij,ij->i", space[source], space[target])
    order = np.lexsort((-like, source))
    source, target, like = source[order], target[order], like[order]
    place = np.arange(len(source)) - np.searchsorted(source, source)
    near = place < CANDIDATES
    both = np.full((n, CANDIDATES), -1, np.int64)
    value = np.full((n, CANDIDATES), -np.inf, np.float32)
    both[source[near], place[near]], value[source[near], place[near]] = target[near], like[near]
    out = np.full((n, most), -1, np.int32)
    for low in range(0, n, 256):
        got = choose(space, both[low:low + 256], value[low:low + 256], most)
        out[low:low + 256, :got.shape[1]] = got
    return out


def build(frame: pd.DataFrame) -> pd.DataFrame:
    """The index row of a shard's ``dim, shard, point, vector, ids``."""
    frame = frame.sort_values("point")      # a random number: the order of entry
    vectors = np.array(frame["vector"].tolist(), np.float64)
    space = vectors.astype(np.float32)
    scale = max(float(np.abs(space).max()), 1e-30)
    space = space / scale
    norms = (space ** 2).sum(axis=1)
    space = np.hstack([space, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]]).astype(np.float32)
    rank = np.random.default_rng(len(vectors)).random(len(vectors))
    level = np.floor(-np.log(1 - rank) / np.log(LINKS)).astype(int)
    layers, links = [], []
    for k in range(level.max() + 1):
        members = np.flatnonzero(level >= k).astype(np.int32)
        own = layer_links(space[members], 2 * LINKS if k == 0 else LINKS)
        links.append(np.where(own >= 0, members[np.maximum(own, 0)], -1).astype(np.int32).tobytes())
        layers.append(members.tobytes())
    ids = frame["ids"].tolist()
    ends = np.cumsum([len(x) for x in ids]).astype(np.int64)
    return pd.DataFrame([{"dim": int(frame["dim"].iloc[0]), "shard": int(frame["shard"].iloc[0]), "n": len(vectors),
                          "ids": np.concatenate(ids).astype(np.int64).tobytes(), "vectors": vectors.tobytes(),
                          "id_ends": ends.tobytes(), "layers": layers, "links": links}])


class Shard:
    """An index row, ready to search."""

    def __init__(self, row) -> None:
        n, dim = int(row["n"]), int(row["dim"])
        self.vectors = np.frombuffer(row["vectors"], np.float64).reshape(n, dim)
        self.low = self.vectors.astype(np.float32)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.ends = np.frombuffer(row["id_ends"], np.int64)
        self.layers = [np.frombuffer(x, np.int32) for x in row["layers"]]
        self.links = [np.frombuffer(x, np.int32).reshape(len(m), -1) for x, m in zip(row["links"], self.layers)]
        self.rows: list = [None]        # row of a point in the links of an upper layer
        for members in self.layers[1:]:
            row = np.zeros(n, np.int32)
            row[members] = np.arange(len(members))
            self.rows.append(row)
        self.seen, self.turn = np.zeros(n, np.int64), 0

    def beam(self, layer: int, starts: list[tuple[float, int]], query: np.ndarray, breadth: int) -> list[tuple[float, int]]:
        """The best points of a layer that are reached from the starts, as a
        heap of (likeness, point)."""
        self.turn += 1
        seen, turn = self.seen, self.turn
        found = list(starts)
        heapq.heapify(found)
        todo = [(-v, p) for v, p in found]
        heapq.heapify(todo)
        seen[[p for _, p in found]] = turn
        links, row = self.links[layer], self.rows[layer]
        while todo:
            value, point = heapq.heappop(todo)
            if len(found) >= breadth and -value < found[0][0]:
                break
            own = links[point if row is None else row[point]]
            own = own[own >= 0]
            own = own[seen[own] != turn]
            seen[own] = turn
            like = self.low[own] @ query
            if len(found) >= breadth:
                better = like > found[0][0]
                own, like = own[better], like[better]
            for p, v in zip(own.tolist(), like.tolist()):
                if len(found) < breadth:
                    heapq.heappush(found, (v, p))
                elif v > found[0][0]:
                    heapq.heapreplace(found, (v, p))
                else:
                    continue
                heapq.heappush(todo, (-v, p))
        return found

    def search(self, query: np.ndarray, breadth: int) -> np.ndarray:
        """The points found by beam searches from the top layer down; a layer's
        beam starts from all points of the one above."""
        query = query.astype(np.float32)
        first = int(self.layers[-1][0])
        found = [(float(self.low[first] @ query), first)]
        for layer in range(len(self.layers) - 1, 0, -1):
            found = self.beam(layer, found, query, UPPER_BREADTH)
        return np.fromiter((p for _, p in self.beam(0, found, query, breadth)), np.int64)

    def nearest(self, query_id: int, query: np.ndarray, nearest: int, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        own = self.search(query, breadth)
        score = (self.vectors[own] * query).sum(axis=1)
        first = np.concatenate([[0], self.ends])[own]
        count = self.ends[own] - first
        total = np.cumsum(count)
        ids = self.ids[np.repeat(first - (total - count), count) + np.arange(total[-1])]
        score = np.repeat(score, count)
        other = ids != query_id
        ids, score = ids[other], score[other]
        order = np.lexsort((ids, -score))[:nearest]
        return ids[order], score[order]


def index(rows: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """The shards of ``valid`` rows, written."""
    spark = rows.sparkSession
    place = scratch_path(spark, "points")
    points(rows, nearest).withColumn("point", F.xxhash64("vector")).write.parquet(place)
    dealt = spark.read.parquet(place)
    bound = F.least(F.lit(SHARD_POINTS), F.greatest(F.floor(F.lit(SHARD_BYTES) / (8 * F.col("dim"))), F.lit(1)))
    shards = dealt.groupBy("dim").agg(F.count("*").alias("n")).select("dim", F.ceil(F.col("n") / bound).alias("shards"))
    dealt = dealt.join(shards, "dim").withColumn("shard", F.pmod(F.xxhash64(F.element_at("ids", 1)), "shards"))
    path = scratch_path(spark, "hnsw")
    total = shards.agg(F.sum("shards")).first()[0] or 1
    # Shards are few and take long to build: a task for each, however small their data.
    (dealt.select("dim", "shard", "point", "vector", "ids").repartition(2 * total, "dim", "shard").groupBy("dim", "shard")
     .applyInPandas(build, INDEX).write.parquet(path))
    return spark.read.parquet(path)


def search(shards: DataFrame, queries: DataFrame, nearest: int = NEAREST, breadth: int = BREADTH) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest points of each query
    (``vec_id, vector, dim``)."""
    blocks = -(-max(1, queries.count()) // QUERY_BLOCK)
    asked = queries.select(F.col("vec_id").alias("query_id"), "vector", "dim",
                           F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block"))
    every = shards.select(F.col("dim").alias("to_dim"), F.col("shard").alias("to_shard"))
    asked = asked.join(every, F.col("dim") == F.col("to_dim")).drop("dim")      # once to every shard
    copies = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))

    def answer(index_rows: pd.DataFrame, asked_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(index_rows) or not len(asked_rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        shard = Shard(index_rows.iloc[0])
        ids = asked_rows["query_id"].tolist()
        found = [shard.nearest(i, np.asarray(v, np.float64), nearest, breadth) for i, v in zip(ids, asked_rows["vector"].tolist())]
        return pd.DataFrame({"query_id": np.repeat(ids, [len(x) for x, _ in found]),
                             "vec_id": np.concatenate([x for x, _ in found]), "score": np.concatenate([y for _, y in found])})

    asked = asked.withColumnRenamed("block", "to_block")
    groups = max(1, blocks * shards.count())
    copies = copies.repartition(groups, "dim", "shard", "block")
    asked = asked.repartition(groups, "to_dim", "to_shard", "to_block")
    found = copies.groupBy("dim", "shard", "block").cogroup(asked.groupBy("to_dim", "to_shard", "to_block")).applyInPandas(
        answer, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score")


def op8_hnsw_search(spark, sf_dir: str) -> DataFrame:
    rows = one_vector(valid(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding"))
    return search(index(rows), rows.filter("vec_id % 20 = 0"))
