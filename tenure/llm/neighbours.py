"""Approximate nearest neighbours by an adaptive dimension scan over inverted lists.

Vectors are turned by a random rotation and dealt to the lists of their nearest centroids. Within each
probed list, distances are summed block of columns by block: after d of D columns, a candidate
is abandoned when a hypothesis test says that its whole distance exceeds the tenth best known. Survivors
are measured on the original vectors.

Centroids come from a bounded sample, and so does the number of lists to probe: neighbours within the sample are farther away
than those among all rows, so the number errs on the safe side. Every vector is indexed. Lists with many vectors or many
queries are split into cells, so no task gets more than CELL_ROWS vectors and CELL_QUERIES queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenure.llm.common import cut, table

K = 10
#: Vectors that centroids are fitted on, at most.
SAMPLE = 20_000
#: Lists: two for each root of the number of vectors, as many as the sample can carry.
MAX_LISTS = 1_000
#: A query probes as many lists as held this share of the true neighbours of CALIBRATED rows of the sample.
TARGET = 0.97
CALIBRATED = 256
#: Columns of a block. Of a randomly turned difference, d of D columns hold a Beta-distributed share
#: of the squared length; a candidate goes when it would take a share this many deviations above the mean to be near.
BLOCK = 16
DEVIATIONS = 2.3
CELL_ROWS = 8_192
CELL_QUERIES = 1_024


def valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and v (array of double), without vectors that take no part: null, empty, zero or with a null or non-finite component."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )


def rotation(dims: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))
    return q * np.sign(np.diag(r))


def centroids(sample: np.ndarray, n_lists: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """k-means on the sample; empty lists keep their last centre."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:n_lists]].copy()
    for _ in range(rounds):
        nearest = nearest_lists(sample, centres, 1)[:, 0]
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest_lists(rows: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, nearest first."""
    out, norms = [], (centres ** 2).sum(axis=1)
    for at in range(0, len(rows), 4_096):
        d = norms - 2 * rows[at:at + 4_096] @ centres.T
        if n == 1:
            out.append(d.argmin(axis=1)[:, None])
        else:
            out.append(np.argsort(d, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.zeros((0, n), np.int64)


def probes_needed(sample: np.ndarray, centres: np.ndarray, k: int, target: float = TARGET) -> int:
    """So many lists, nearest first, hold the share ``target`` of the k nearest of rows of the sample."""
    home = nearest_lists(sample, centres, 1)[:, 0]
    places = []
    norms = (sample ** 2).sum(axis=1)
    for at in range(0, len(sample), max(1, len(sample) // CALIBRATED)):
        d = norms - 2 * sample @ sample[at]
        d[at] = np.inf
        near = np.argsort(d, kind="stable")[: min(k, len(sample) - 1)]
        order = nearest_lists(sample[at:at + 1], centres, len(centres))[0]
        rank = np.empty(len(centres), np.int64)
        rank[order] = np.arange(len(centres))
        places += rank[home[near]].tolist()
    return int(np.quantile(places, target, method="higher")) + 1 if places else 1


def scan(rows: np.ndarray, turned: list[np.ndarray], query: np.ndarray, query_turned: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest rows of a list: places and distances. ``turned``: the rotated rows in column blocks."""
    n, dims = rows.shape
    live = np.arange(n)
    if n > 4 * k:
        partial, at, bound = np.zeros(n), 0, np.inf
        for block in turned:
            width = block.shape[1]
            if at + width >= dims:  # what is left is measured in full
                break
            partial += ((block[live] - query_turned[at:at + width]) ** 2).sum(axis=1)
            at += width
            if not np.isfinite(bound):  # the k most promising give a first bound
                first = live[np.argpartition(partial, k)[:k]]
                bound = ((rows[first] - query) ** 2).sum(axis=1).max()
            share = at / dims + DEVIATIONS * np.sqrt(2 * at * (dims - at) / (dims + 2)) / dims
            stay = partial <= bound * min(1.0, share)
            live, partial = live[stay], partial[stay]
        live = np.union1d(live, first) if at else live
    return live, np.sqrt(((rows[live] - query) ** 2).sum(axis=1))


def neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", probes: int | None = None,
) -> DataFrame:
    """For each query its k nearest vectors found: query_id, rank (from 1), vec_id, score (Euclidean distance, double).

    Vectors that are null, empty, zero, or hold null or non-finite components, and null ids, take no
    part, nor do vectors of another length than the most frequent one (of equally frequent ones
    the longest). A vector of the query's own id is no candidate. Ties go to the smaller vec_id. Rows that
    repeat an id are candidates each; of queries that repeat an id, the smallest vector is searched.
    Fewer candidates than k give fewer rows, none gives none. Extra columns are not read.
    """
    spark = vectors.sparkSession
    own = valid(vectors, id_col, vector_col)
    lengths = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], schema)
    dims, n_rows = lengths[0]["n"], lengths[0]["count"]
    own = own.where(F.size("v") == dims)
    asked = valid(queries, id_col, vector_col).where(F.size("v") == dims).groupBy("vec_id").agg(F.min("v").alias("v"))

    turn = rotation(dims)
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()
    n_lists = int(max(1, min(MAX_LISTS, 2 * n_rows ** 0.5, len(sample) / 4)))
    turned = np.stack(sample["v"].to_numpy()) @ turn
    centres = centroids(turned, n_lists)
    probes = probes or probes_needed(turned, centres, k)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                batch["list"] = nearest_lists(np.stack(batch["v"].to_numpy()) @ turn, centres, 1)[:, 0].astype("int32")
                yield batch

    placed = cut(own.mapInPandas(assign, "vec_id long, v array<double>, list int"), "placed")
    sizes = np.zeros(len(centres), np.int64)
    for r in placed.groupBy("list").count().collect():  # a row per list
        sizes[r["list"]] = r["count"]

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            order = nearest_lists(np.stack(batch["v"].to_numpy()) @ turn, centres, len(centres))
            enough = np.maximum(probes, (np.cumsum(sizes[order], axis=1) <= k).sum(axis=1) + 1)
            lists = [[int(x) for x in o[:n] if sizes[x]] for o, n in zip(order, enough, strict=True)]
            yield pd.DataFrame({"query_id": batch["vec_id"], "q": batch["v"], "lists": lists})

    probing = cut(
        asked.mapInPandas(probe, "query_id long, q array<double>, lists array<int>").select("query_id", "q", F.explode("lists").alias("list")), "probing"
    )
    shape = {r["list"]: r["count"] for r in probing.groupBy("list").count().collect()}  # a row per list
    grid = F.create_map([F.lit(x) for i in range(len(centres)) for x in (
        i, f"{max(1, -(-int(sizes[i]) // CELL_ROWS))},{-(-shape.get(i, 0) // CELL_QUERIES)}")])
    parts = F.split(F.element_at(grid, F.col("list")), ",")
    row_parts, query_parts = parts[0].cast("int"), parts[1].cast("int")
    rows = placed.select(
        "vec_id", "v", "list", F.pmod(F.xxhash64("vec_id", "v"), row_parts).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), query_parts)).alias("j"), query_parts.alias("n"),
    ).where("j < n").drop("n")
    searched = probing.select(
        "query_id", "q", "list", F.explode(F.sequence(F.lit(0), row_parts - 1)).alias("i"), F.pmod(F.xxhash64("query_id"), query_parts).cast("int").alias("j"),
    )

    def search(_: tuple, vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vs) and len(qs):
            ids, matrix = vs["vec_id"].to_numpy(), np.stack(vs["v"].to_numpy())
            rotated = matrix @ turn
            blocks = [np.ascontiguousarray(rotated[:, c:c + BLOCK]) for c in range(0, dims, BLOCK)]
            for query_id, q in zip(qs["query_id"], qs["q"], strict=True):
                live, score = scan(matrix, blocks, q, q @ turn, k + 1)
                other = ids[live] != query_id
                live, score = live[other], score[other]
                best = np.lexsort((ids[live], score))[:k]
                found += [(query_id, ids[live[b]], score[b]) for b in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    cells = rows.groupBy("list", "i", "j").cogroup(searched.groupBy("list", "i", "j"))
    found = cells.applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours(vectors, vectors.where("vec_id % 100 = 0"))
