"""Merkle dataset manifest by concatenated-level strings.

Rows are leaves; each source has a tree over its leaves in order of id, and the sources' roots have one above them. Nodes have
three children. An aligned block of 3^6 neighbouring nodes is one row, which keeps each of its levels as one string of hex
digests: fixed-width substrings of a level are hashed to the next one, and the substrings on either side of
a node are its siblings. Blocks' roots are the nodes of the next round, until every tree has one; siblings then go down again,
once per block.

A tree's places come from a range sort and counts per range, and blocks are aligned stretches of places, so a source with a third
of all rows is spread like any other. No task holds more than a block and a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenure.llm.common import cut, table

#: Children of a node, levels of a block, and hex digits of a digest.
FAN, LEVELS, WIDTH = 3, 6, 64
#: Rows that one task sorts.
RANGE_ROWS = 200_000
_POWERS = [FAN ** i for i in range(40)]  # FAN^39 is the last that a long holds
_SIBLINGS = "array<struct<left:string,right:string>>"


def digest(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, or a dash: no two rows have the same fields in a row."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(F.concat(*(field(x) for x in (doc_id, source, lang, n_chars, text))))


# --- places -----------------------------------------------------------------------------


def placed(nodes: DataFrame, order: list[str], name: str) -> DataFrame:
    """``nodes`` with place (from 0, in each tree by ``order``) and n (nodes of the tree).

    ``order`` must be unique within a tree. Rows are range-sorted over trees and order; each range counts its rows of each tree, and
    running sums over ranges (few per tree) tell where a range begins.
    """
    n_ranges = max(1, -(-nodes.count() // RANGE_ROWS))
    inside = F.monotonically_increasing_id()  # range << 33 | row in it
    ranged = cut(
        nodes.repartitionByRange(n_ranges, "tree", *order).sortWithinPartitions("tree", *order).withColumn("row", inside), f"{name}-ranged"
    ).withColumn("range", F.shiftright("row", 33))
    sizes = ranged.groupBy("range", "tree").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("here"))
    own = Window.partitionBy("tree")
    begins = F.coalesce(F.sum("here").over(own.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("range", "tree", "first", begins.alias("begins"), F.sum("here").over(own).alias("n"))
    return ranged.join(sizes, ["range", "tree"]).withColumn("place", F.col("begins") + F.col("row") - F.col("first")).drop("range", "row", "first", "begins")


# --- blocks -----------------------------------------------------------------------------


def height(n: Column) -> Column:
    """Levels above n nodes until one is left."""
    return F.size(F.filter(F.array(*(F.lit(p) for p in _POWERS)), lambda p: p < n))


def _parents(level: Column) -> Column:
    """The level above, as one string: each run of three digests, the last one maybe shorter, hashed."""
    runs = F.ceil(F.octet_length(level) / (FAN * WIDTH)).cast("int")
    return F.array_join(F.transform(
        F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(F.substring(level, i * (FAN * WIDTH) + 1, F.lit(FAN * WIDTH)), 256)
    ), "").cast("binary")


def blocks(nodes: DataFrame, payload: list[str]) -> DataFrame:
    """One row per aligned block of nodes (tree, place, n, node): tree, block, n, members, levels, top.

    members are the nodes' payload in order; levels the strings of hex digits (as bytes, so that a substring is found at once) from
    the nodes up; top the digest that is left, or that the next round takes for a node.
    """
    size = FAN ** LEVELS
    grouped = nodes.groupBy("tree", F.floor(F.col("place") / size).cast("long").alias("block"), "n").agg(
        F.array_sort(F.collect_list(F.struct("place", "node", *payload))).alias("members")
    )
    first = F.array_join(F.transform("members", lambda x: x["node"]), "").cast("binary")
    up = F.least(height(F.col("n")), F.lit(LEVELS))
    steps = F.filter(F.sequence(F.lit(1), F.lit(LEVELS)), lambda i: i <= up)
    levels = F.aggregate(steps, F.array(first), lambda done, _: F.array_append(done, _parents(F.element_at(done, -1))))
    return grouped.withColumn("levels", levels).withColumn("top", F.element_at("levels", -1).cast("string"))


def _own_siblings(levels: Column, i: Column) -> Column:
    """What stands left and right of node i in its run, level by level, below the top of the block."""
    def pair(level: Column, up: Column) -> Column:
        at = F.floor(i / F.element_at(F.array(*(F.lit(p) for p in _POWERS[:LEVELS])), up + 1)).cast("int")
        here = at % FAN
        left = F.substring(level, (at - here) * WIDTH + 1, here * WIDTH)
        right = F.substring(level, (at + 1) * WIDTH + 1, (FAN - 1 - here) * WIDTH)
        return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), pair)


def climb(nodes: DataFrame, payload: list[str], name: str) -> list[DataFrame]:
    """The blocks of every round, from the nodes (tree, place, n, node) up; in the last one each tree left is one block."""
    rounds = [cut(blocks(nodes, payload), f"{name}-blocks")]
    while True:
        last = rounds[-1]
        more = last.where(F.col("n") > FAN ** LEVELS)
        if more.isEmpty():
            return rounds
        above = more.select("tree", F.col("block").alias("place"), F.ceil(F.col("n") / FAN ** LEVELS).cast("long").alias("n"), F.col("top").alias("node"))
        rounds.append(cut(blocks(above, []), f"{name}-blocks"))


def tops(rounds: list[DataFrame]) -> DataFrame:
    """tree and top: the root of each tree."""
    found = [r.where(F.col("n") <= FAN ** LEVELS).select("tree", "top") for r in rounds]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def descend(rounds: list[DataFrame], above: DataFrame, carried: list[str], name: str) -> DataFrame:
    """The first round's blocks with ``carried`` columns of their tree and siblings: those of the block's top, up to the root.

    ``above`` has one row per tree: tree, siblings (of the tree's root), carried columns.
    """
    reached = None
    for at in range(len(rounds) - 1, -1, -1):
        own = rounds[at]
        ended = own.where(F.col("n") <= FAN ** LEVELS).join(above, "tree")
        lower = ended if reached is None else ended.unionByName(own.where(F.col("n") > FAN ** LEVELS).join(reached, ["tree", "block"]))
        if at == 0:
            return lower
        inside = F.transform("members", lambda x, i: F.struct(x["place"].alias("block"), F.concat(_own_siblings(F.col("levels"), i), "siblings").alias("siblings")))
        reached = cut(lower.select("tree", F.explode(inside).alias("x"), *carried).select("tree", "x.block", "x.siblings", *carried), f"{name}-siblings")
    raise AssertionError("no rounds")


# --- the manifest -----------------------------------------------------------------------


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The documents have doc_id, source, lang, n_chars and text; extra columns are not read. ``tampered`` is the text as someone
    else has it (default: as it is); folded_root is what its leaf and the original siblings give, verified whether that is
    the root. Null and repeated ids: nulls come first, rows of one id by their leaf; rows equal in all five columns
    are leaves beside each other, in any order. Nulls and empty texts have leaves that differ. No rows give no rows.
    """
    spark = docs.sparkSession
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = F.col("text") if tampered is None else tampered
    own, other = leaf(*columns), leaf(*columns[:4], changed)
    # Null sources come before all others: a dash sorts before an equals sign.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    leaves = docs.select(
        tree.alias("tree"), "doc_id", own.alias("node"), F.when(F.col("text").eqNullSafe(changed), F.lit(None)).otherwise(other).alias("held"),
    ).withColumn("row_id", F.monotonically_increasing_id())
    leaves = cut(leaves, "leaves")
    if leaves.isEmpty():
        return spark.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")

    sources = climb(placed(leaves, ["doc_id", "node", "row_id"], "leaves").drop("row_id"), ["doc_id", "held"], "sources")
    subroots = tops(sources).select(F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("top").alias("node"))
    whole = climb(placed(cut(subroots, "subroots"), ["source"], "subroots"), ["source"], "whole")
    root = tops(whole).select("tree", F.col("top").alias("root"), F.lit([]).cast(_SIBLINGS).alias("siblings"))
    paths = F.transform("members", lambda x, i: F.struct(
        x["source"].alias("tree"), x["node"].alias("subroot"), F.concat(_own_siblings(F.col("levels"), i), "siblings").alias("siblings")
    ))
    above = cut(descend(whole, root, ["root"], "whole").select("root", F.explode(paths).alias("x")).select("x.*", "root"), "above")

    # Everything about a leaf is worked out in its block's row, so that only short rows leave it.
    inside = F.transform("members", lambda x, i: F.struct(
        x["doc_id"].alias("doc_id"), x["node"].alias("leaf"), F.coalesce(x["held"], x["node"]).alias("held"),
        F.concat(_own_siblings(F.col("levels"), i), "siblings").alias("siblings"),
    ))
    judged = F.transform(inside, lambda x: F.struct(
        x["doc_id"].alias("doc_id"), x["leaf"].alias("leaf"),
        digest(F.array_join(F.transform(x["siblings"], lambda s: F.concat(s["left"], s["right"])), "")).alias("proof_sha256"),
        F.aggregate(x["siblings"], x["held"], lambda node, s: digest(F.concat(s["left"], node, s["right"]))).alias("folded_root"),
    ))
    found = descend(sources, above, ["subroot", "root"], "sources").select("subroot", "root", F.explode(judged).alias("x"))
    return found.select(
        "x.doc_id", "x.leaf", "subroot", "root", "x.proof_sha256", "x.folded_root", (F.col("x.folded_root") == F.col("root")).alias("verified")
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the documents, by a checksum of their id, are held without their line breaks."""
    text = F.col("text")
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(table(spark, sf_dir, "documents"), F.when(odd, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text))


OP11_SQL = r"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, coalesce('=' || source, '-') AS tree,
    [coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
     coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')] AS fields, text,
    list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
      lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END) AS crc
  FROM documents
), hashed AS (
  SELECT row_number() OVER (ORDER BY tree, doc_id NULLS FIRST) AS doc, doc_id, tree,
    sha256(array_to_string(fields, '') || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 2 = 0
      THEN sha256(array_to_string(fields, '') || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
      ELSE sha256(array_to_string(fields, '') || coalesce(strlen(text) || ':' || text, '-')) END AS held
  FROM leaves
), spot AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM hashed
), low AS (
  SELECT tree, 0 AS level, place, leaf AS node, n FROM spot
  UNION ALL
  SELECT tree, level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3 FROM low WHERE n > 1 GROUP BY tree, level, place // 3, n
), sub AS (
  SELECT tree, level, node AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1
), high AS (
  SELECT 0 AS level, place, subroot AS node, n FROM sub
  UNION ALL
  SELECT level + 1, place // 3, sha256(string_agg(node, '' ORDER BY place)), (n + 2) // 3 FROM high WHERE n > 1 GROUP BY level, place // 3, n
), runs AS (
  SELECT tree, level, place // 3 AS run, list(node ORDER BY place) AS nodes FROM low WHERE n > 1 GROUP BY ALL
), upper_runs AS (
  SELECT level, place // 3 AS run, list(node ORDER BY place) AS nodes FROM high WHERE n > 1 GROUP BY ALL
), fold AS (
  SELECT doc, spot.tree, 0 AS level, spot.place, false AS in_upper, held AS node, '' AS proof FROM spot
  UNION ALL
  SELECT doc, tree, CASE WHEN up THEN 0 ELSE level + 1 END, CASE WHEN up THEN place ELSE place // 3 END, in_upper OR up,
    CASE WHEN up THEN node ELSE sha256(array_to_string(nodes[:place % 3], '') || node || array_to_string(nodes[place % 3 + 2:], '')) END,
    CASE WHEN up THEN proof ELSE proof || array_to_string(nodes[:place % 3], '') || array_to_string(nodes[place % 3 + 2:], '') END
  FROM (
    SELECT f.doc, f.tree, f.level, NOT f.in_upper AND r.nodes IS NULL AS up, f.in_upper, f.node, f.proof,
      CASE WHEN NOT f.in_upper AND r.nodes IS NULL THEN s.place ELSE f.place END AS place, coalesce(r.nodes, u.nodes) AS nodes
    FROM fold f JOIN sub s ON f.tree = s.tree
    LEFT JOIN runs r ON NOT f.in_upper AND r.tree = f.tree AND r.level = f.level AND r.run = f.place // 3
    LEFT JOIN upper_runs u ON f.in_upper AND u.level = f.level AND u.run = f.place // 3
  ) WHERE up OR nodes IS NOT NULL
), ended AS (
  SELECT doc, node AS folded_root, proof FROM fold WHERE in_upper QUALIFY row_number() OVER (PARTITION BY doc ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM spot JOIN sub USING (tree) JOIN ended USING (doc) CROSS JOIN (SELECT node AS root FROM high WHERE n = 1)
"""
