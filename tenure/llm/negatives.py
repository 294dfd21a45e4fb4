"""Hard-negative mining by angular triangle filtering.

Every vector keeps its angles to a few reference directions. By the triangle inequality of angles, the angle between an anchor and a
row lies between the largest difference and the smallest sum of theirs; its cosine times both norms, widened by more than
rounding can be off, bounds their integer score. A row is scored only if its bounds overlap a window
of scores that is still open: for positives, all above the fifth best lower bound; for negatives, the
stretch that a positive's score opens, above the third best lower bound that lies wholly in it.

Anchors meet all rows in blocks: rows are dealt to blocks of CELL_ROWS, anchors to chunks of CELL_ANCHORS, and a cell is one task's
block and chunk. Results are exact: bounds only leave out rows that can't count. References are fitted on a bounded
sample, which changes how many rows are scored, not what is found.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenure.llm.common import cut, table

POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of its positive's: from, to.
LOW, HIGH = 50, 95
SCALE = 256
#: Reference directions, and vectors that they are fitted on, at most.
REFERENCES, SAMPLE = 8, 20_000
CELL_ROWS, CELL_ANCHORS = 8_192, 2_048
#: Angles are widened by this, and scores by one and this share: far more than their rounding.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
#: Components times 256 from here on have scores that no long holds: such vectors take no part.
TOO_LARGE = 1e15
#: Below this product of norms all sums of a score are exact in doubles.
EXACT = 2.0 ** 52
_LONG = (-(2 ** 63), 2 ** 63 - 1)


def taking_part(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and q (components times 256, rounded down, as doubles) of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < TOO_LARGE))
    kept = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    return kept.select("vec_id", "label", F.transform("v", _floor).alias("q"))


def _floor(x: Column) -> Column:
    """floor(256 x) as a double: beyond 2^52 a double has no fraction."""
    scaled = x * SCALE
    return F.when(F.abs(scaled) < 2.0 ** 52, F.floor(scaled).cast("double")).otherwise(scaled)


def references(sample: np.ndarray, n: int = REFERENCES, rounds: int = 8, seed: int = 17) -> np.ndarray:
    """Unit directions in the middle of the sample's groups (spherical k-means); a unit vector if there is none."""
    norms = np.sqrt((sample ** 2).sum(axis=1))
    units = np.unique(sample[norms > 0] / norms[norms > 0, None], axis=0)
    if not len(units):
        return np.eye(1, sample.shape[1])
    centres = units[np.random.default_rng(seed).permutation(len(units))[:n]].copy()
    for _ in range(rounds):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        size = np.sqrt((sums ** 2).sum(axis=1))
        centres[size > 1e-9] = sums[size > 1e-9] / size[size > 1e-9, None]
    return centres


def norms_and_angles(rows: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to the directions; a zero vector's are right angles, since its scores are zero at any."""
    largest = np.abs(rows).max(axis=1, initial=0.0)
    units = rows / np.where(largest > 0, largest, 1.0)[:, None]  # squares of very large components stay finite
    size = np.sqrt((units ** 2).sum(axis=1))
    cosines = (units @ directions.T) / np.where(size > 0, size, 1.0)[:, None]
    return largest * size, np.arccos(np.clip(cosines, -1.0, 1.0))


def bounds(norm: float, angles: np.ndarray, row_norms: np.ndarray, row_angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of rows with an anchor. ``row_angles``: a row per direction."""
    both = row_angles + angles[:, None]
    near = np.abs(row_angles - angles[:, None]).max(axis=0) - ANGLE_SLACK
    far = np.minimum(both, 2 * math.pi - both).min(axis=0) + ANGLE_SLACK
    size = norm * row_norms
    slack = 1.0 + SCORE_SLACK * size
    return size * np.cos(np.minimum(far, math.pi)) - slack, size * np.cos(np.maximum(near, 0.0)) + slack


def scores(rows: np.ndarray, anchor: np.ndarray, size: float) -> np.ndarray:
    """Integer inner products, exact: in doubles where these suffice, else in Python's integers."""
    if size < EXACT:
        return (rows @ anchor).astype(np.int64)
    left = [int(x) for x in anchor.tolist()]
    return np.array([sum(int(x) * y for x, y in zip(r, left, strict=True)) for r in rows.tolist()], dtype=object)


def kth_largest(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def best(ids: np.ndarray, found: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(found) > 8 * k and found.dtype != object:
        live = np.flatnonzero(found >= np.partition(found, len(found) - k)[len(found) - k])
    else:
        live = np.arange(len(found))
    order = sorted(live.tolist(), key=lambda i: (-int(found[i]), int(ids[i])))
    return np.array(order[:k], dtype=np.int64)


class Block:
    """The rows of one cell, as arrays."""

    def __init__(self, rows: pd.DataFrame):
        self.ids, self.labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
        self.q, self.norms = np.stack(rows["q"].to_numpy()).astype(float), rows["norm"].to_numpy(float)
        self.angles = np.ascontiguousarray(np.stack(rows["angles"].to_numpy()).T)
        self.longest = float(self.norms.max())

    def positives(self, a, k: int) -> list[tuple[int, int]]:
        """The k best rows of the anchor's label in this block: id and score."""
        other = np.flatnonzero((self.labels == a.label) & (self.ids != a.vec_id))
        low, high = bounds(a.norm, np.asarray(a.angles), self.norms[other], self.angles[:, other])
        live = other[high >= kth_largest(low, k)]
        found = scores(self.q[live], np.asarray(a.q, float), a.norm * self.longest)
        return [(int(self.ids[live[i]]), found[i]) for i in best(self.ids[live], found, k)]

    def negatives(self, a, k: int, low_share: int, high_share: int) -> list[tuple[int, int, int, int, int]]:
        """For each positive of the anchor, the k best rows of other labels in its window: slot, positive's id and score, id, score."""
        other = np.flatnonzero(self.labels != a.label)
        low, high = bounds(a.norm, np.asarray(a.angles), self.norms[other], self.angles[:, other])
        wanted = np.zeros(len(other), bool)
        for score in a.scores:
            least, most = low_share * score / 100, high_share * score / 100
            inside = low[(low >= least) & (high <= most)]
            wanted |= (high >= max(least, kth_largest(inside, k))) & (low <= most)
        live = other[wanted]
        found = scores(self.q[live], np.asarray(a.q, float), a.norm * self.longest)
        out = []
        for slot, (positive, score) in enumerate(zip(a.positives, a.scores, strict=True)):
            positive, score = int(positive), int(score)
            if found.dtype == object:
                fits = np.array([low_share * score <= 100 * x <= high_share * score for x in found], bool)
            else:  # rounded inwards, so that integers compare exactly
                fits = (found >= -((-low_share * score) // 100)) & (found <= high_share * score // 100)
            place = live[fits]
            out += [(slot, positive, score, int(self.ids[place[i]]), found[fits][i]) for i in best(self.ids[place], found[fits], k)]
        return out


def _long(score) -> int:
    return min(max(int(score), _LONG[0]), _LONG[1])


def mine(
    vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Rows anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows without id, label or vector, or with a null or non-finite component, take no part, nor do vectors of another length than the
    most frequent one (of equally frequent ones the longest) and those with a component of TOO_LARGE / 256 or more. ``anchors`` tells from vec_id which rows are anchors. A row of
    the anchor's own id is never its positive. Rows that repeat an id are rows each, but the anchor of an
    id is its smallest (label, vector). Scores beyond a long are compared exactly and come out as
    the nearest long. No anchors, positives or negatives give no rows. Extra columns are not read.
    """
    spark = vectors.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    own = taking_part(vectors, id_col, vector_col, label_col)
    lengths = own.groupBy(F.size("q").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], out)
    dims, n_rows = lengths[0]["n"], lengths[0]["count"]
    own = own.where(F.size("q") == dims)
    sample = np.stack(own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("q").toPandas()["q"].to_numpy()).reshape(-1, dims)
    directions = references(sample)

    def measure(batches):
        for batch in batches:
            if len(batch):
                norms, angles = norms_and_angles(np.stack(batch["q"].to_numpy()).reshape(-1, dims), directions)
                batch["norm"], batch["angles"] = norms, list(angles)
                yield batch

    stored = "vec_id long, label long, q array<double>, norm double, angles array<double>"
    rows = cut(own.mapInPandas(measure, stored), "angles")
    asked = rows.where(anchors).groupBy("vec_id").agg(F.min_by(F.struct("label", "q", "norm", "angles"), F.struct("label", "q")).alias("a"))
    asked = cut(asked.select("vec_id", "a.*"), "anchors")

    # Positives: cells of one label each.
    share = lambda key, n: F.pmod(F.xxhash64(key), n).cast("int")
    sizes = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("n_blocks"))
    chunks = asked.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / CELL_ANCHORS).cast("int").alias("n_chunks"))
    shape = sizes.join(chunks, "label")
    cells = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    theirs = rows.join(shape, "label").select("vec_id", "label", "q", "norm", "angles", F.pmod(F.xxhash64("vec_id", "q"), F.col("n_blocks")).cast("int").alias("i"), cells(F.col("n_chunks")).alias("j"))
    ours = asked.join(shape, "label").select("vec_id", "label", "q", "norm", "angles", cells(F.col("n_blocks")).alias("i"), share("vec_id", F.col("n_chunks")).alias("j"))

    def search_positives(_: tuple, vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vs) and len(qs):
            block = Block(vs)
            found = [(a.vec_id, i, str(s)) for a in qs.itertuples(index=False) for i, s in block.positives(a, positives)]
        return pd.DataFrame(found, columns=["anchor_id", "positive_id", "score"]).astype({"anchor_id": "int64", "positive_id": "int64", "score": "str"})

    met = theirs.groupBy("label", "i", "j").cogroup(ours.groupBy("label", "i", "j")).applyInPandas(search_positives, "anchor_id long, positive_id long, score string")
    exact = F.col("score").cast("decimal(38,0)")  # scores may be wider than a long
    ranked = Window.partitionBy("anchor_id").orderBy(F.desc("exact"), "positive_id")
    kept = met.select("anchor_id", "positive_id", exact.alias("exact")).withColumn("slot", F.row_number().over(ranked)).where(F.col("slot") <= positives)
    kept = kept.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("slot", "positive_id", F.col("exact").cast("string").alias("score")))).alias("p"))
    opened = asked.join(kept, asked["vec_id"] == kept["anchor_id"]).select(
        "vec_id", "label", "q", "norm", "angles", F.transform("p", lambda x: x["positive_id"]).alias("positives"), F.transform("p", lambda x: x["score"]).alias("score_texts"),
    )
    opened = cut(opened, "opened")

    # Negatives: cells over all labels.
    n_blocks, n_chunks = -(-n_rows // CELL_ROWS), -(-opened.count() // CELL_ANCHORS)
    if not n_chunks:
        return spark.createDataFrame([], out)
    theirs = rows.withColumn("i", F.pmod(F.xxhash64("vec_id", "q"), F.lit(n_blocks)).cast("int")).withColumn("j", cells(F.lit(n_chunks)))
    ours = opened.withColumn("i", cells(F.lit(n_blocks))).withColumn("j", share("vec_id", F.lit(n_chunks)))

    def search_negatives(_: tuple, vs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(vs) and len(qs):
            block = Block(vs)
            qs["scores"] = [[int(s) for s in texts] for texts in qs["score_texts"]]
            for a in qs.itertuples(index=False):
                found += [(a.vec_id, slot, p, str(ps), i, str(s)) for slot, p, ps, i, s in block.negatives(a, negatives, low, high)]
        return pd.DataFrame(found, columns=["anchor_id", "slot", "positive_id", "ps", "negative_id", "ns"]).astype(
            {"anchor_id": "int64", "slot": "int32", "positive_id": "int64", "ps": "str", "negative_id": "int64", "ns": "str"})

    met = theirs.groupBy("i", "j").cogroup(ours.groupBy("i", "j")).applyInPandas(
        search_negatives, "anchor_id long, slot int, positive_id long, ps string, negative_id long, ns string"
    ).select("anchor_id", "slot", "positive_id", F.col("ps").cast("decimal(38,0)").alias("ps"), "negative_id", F.col("ns").cast("decimal(38,0)").alias("ns"))
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("ns"), "negative_id")
    inside = lambda c: F.greatest(F.least(F.col(c), F.lit(_LONG[1])), F.lit(_LONG[0])).cast("long")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", inside("ps").alias("positive_score"), inside("ns").alias("negative_score")
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
