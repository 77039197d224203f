"""Merkle manifest of a dataset: subtrees by language, proofs on demand.

Checkpoint-and-recompute: of each binary tree only every ``STRIDE``-th level is
written (leaves, their ancestors 8 levels up, and so on: 1/256 more nodes than
leaves). A proof needs siblings of every level; extraction groups a stored
level by aligned subtrees of 2 ** STRIDE nodes, regenerates the interior nodes
of each from its stored nodes, emits each node's siblings and forgets them.
Proofs go from the root down: a stored node's siblings end with those of its
stored ancestor.

Nodes are numbered by sorting them into ranges (no language need fit a task)
and adding up the ranges' sizes; subtrees are groups of at most 2 ** STRIDE
rows, so no group grows with the data and no key is hot. Only the largest
tree's size is brought to the driver.

Digests are sha256; a node is the digest of its children's, as lowercase hex
text. A run of one child is hashed like any other; a tree of one leaf is that
leaf.

Defined results: a null value counts as ``-`` and differs from every text; a
null language is a subtree of its own, the first; rows without an id come first
in theirs; rows of equal ids go by their leaf, and equal rows are leaves of
their own, whose places are dealt among them; tampering adds 1 to a length
unless it is null or the largest long. Extra columns are ignored. An empty
table has no rows, and so no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from .common import materialize

#: Levels between two that are written.
STRIDE = 8
#: Columns of a document that its leaf covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A row is tampered with where this divides crc32 of its id.
TAMPERED = 7
PATH = StructType().add("sides", StringType()).add("siblings", StringType())


def canonical(value: Column) -> Column:
    """``-`` for null, else the value's text after its length in bytes."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: Sequence[Column]) -> Column:
    """sha256 of a row's values, in 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(canonical, values)), 256))


def hex_of(digest) -> Column:
    return F.lower(F.hex(digest))


def _join(nodes: Sequence[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def subtree(nodes: list[str], steps: int) -> list[list[str]]:
    """``nodes`` and the ``steps`` levels above them."""
    levels = [nodes]
    for _ in range(steps):
        below = levels[-1]
        levels.append([_join(below[i:i + 2]) for i in range(0, len(below), 2)])
    return levels


def sibling_paths(nodes: list[str], steps: int) -> list[tuple[str, str]]:
    """For every node: where its sibling stands on each of ``steps`` levels
    (L, R, or - for none) and the siblings, one after the other."""
    levels = subtree(nodes, max(steps - 1, 0))
    out = []
    for i in range(len(nodes)):
        sides, found = [], []
        for level in levels[:steps]:
            other = i ^ 1
            if other < len(level):
                sides.append("L" if other < i else "R")
                found.append(level[other])
            else:
                sides.append("-")
            i >>= 1
        out.append(("".join(sides), "".join(found)))
    return out


@F.pandas_udf(BinaryType())
def _ancestor(nodes: pd.Series, steps: pd.Series) -> pd.Series:
    return pd.Series([bytes.fromhex(subtree([x.hex() for x in n], s)[-1][0]) for n, s in zip(nodes, steps)], dtype=object)


@F.pandas_udf(ArrayType(PATH))
def _paths(nodes: pd.Series, steps: pd.Series, sides: pd.Series, siblings: pd.Series) -> pd.Series:
    return pd.Series([[{"sides": a + s, "siblings": b + t} for a, b in sibling_paths([x.hex() for x in n], k)]
                      for n, k, s, t in zip(nodes, steps, sides, siblings)], dtype=object)


def _steps(n: Column, stride: int) -> Column:
    """Levels that a tree of ``n`` nodes goes up within one stride."""
    height = F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)
    return F.least(height, F.lit(stride))


@dataclass(frozen=True)
class Forest:
    """Trees by the column ``tree``. ``levels``: the written ones, from the
    leaves (with their own columns) to the roots; each has ``tree``, ``idx``
    (place in the tree), ``n`` (nodes of the tree on that level), ``digest``."""

    levels: tuple[DataFrame, ...]
    stride: int

    @property
    def roots(self) -> DataFrame:
        return self.levels[-1].select("tree", "digest")


def numbered(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """``leaves`` with ``idx``, their place in their ``tree`` by ``order``, and
    ``n``, the tree's size. Ranges are sorted and written; a place is one
    within its range, plus the sizes of the ranges before it."""
    by = ["tree", *order]
    ranged = materialize(leaves.repartitionByRange(*by).sortWithinPartitions(*by)
                         .withColumn("seq", F.monotonically_increasing_id()), "op13-leaves")
    at = F.shiftright("seq", 33)
    runs = ranged.groupBy("tree", at.alias("range")).agg(F.count(F.lit(1)).alias("size"), F.min("seq").alias("first"))
    one = Window.partitionBy("tree")
    before = F.sum("size").over(one.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    runs = materialize(runs.select("tree", "range", "first", F.coalesce(before, F.lit(0)).cast("long").alias("before"),
                                   F.sum("size").over(one).cast("long").alias("n")), "op13-runs")
    return (ranged.withColumn("range", at).join(runs, ["tree", "range"])
            .withColumn("idx", F.col("seq") - F.col("first") + F.col("before")).drop("seq", "range", "first", "before"))


def _groups(level: DataFrame, stride: int) -> DataFrame:
    """Aligned subtrees of a level: its nodes in order, and what they hold."""
    own = [c for c in level.columns if c not in ("tree", "idx", "n")]
    return (level.groupBy("tree", F.shiftright("idx", stride).alias("g"), "n")
            .agg(F.array_sort(F.collect_list(F.struct("idx", *own))).alias("members"))
            .withColumn("nodes", F.transform("members", lambda m: m["digest"]))
            .withColumn("steps", _steps(F.col("n"), stride)))


def build(leaves: DataFrame, order: Sequence[str], stride: int = STRIDE) -> Forest:
    """The trees of ``leaves`` (``tree``, ``digest`` and other columns), every
    ``stride``-th level written under the shared folder."""
    level = numbered(leaves, order)
    levels = [level]
    largest = level.agg(F.max("n")).first()[0] or 1
    while largest > 1:
        up = _groups(level.select("tree", "idx", "n", "digest"), stride).select(
            "tree", F.col("g").alias("idx"),
            F.expr("shiftright(n + shiftleft(1L, steps) - 1, steps)").alias("n"), _ancestor("nodes", "steps").alias("digest"))
        level = materialize(up, "op13-level")
        levels.append(level)
        largest = -(-largest >> stride)
    return Forest(tuple(levels), stride)


def proofs(forest: Forest, tops: DataFrame) -> DataFrame:
    """The leaves with ``sides`` and ``siblings`` up to their root and on, and
    with the columns of ``tops``: per ``tree``, the path above its root."""
    more = [c for c in tops.columns if c not in ("tree", "sides", "siblings")]
    up = forest.levels[-1].join(tops, "tree")
    for level in reversed(forest.levels[:-1]):
        above = up.select("tree", F.col("idx").alias("g"), "sides", "siblings", *more)
        paths = _paths("nodes", "steps", "sides", "siblings")
        own = [c for c in level.columns if c not in ("tree", "idx", "n")]
        up = (_groups(level, forest.stride).join(above, ["tree", "g"])
              .select("tree", *more, F.explode(F.arrays_zip("members", paths.alias("p"))).alias("x"))
              .select("tree", *more, "x.members.idx", *(F.col(f"x.members.{c}") for c in own), "x.p.sides", "x.p.siblings"))
    return up


def proof_digest(siblings) -> Column:
    """sha256 of a proof's siblings in order."""
    return F.sha2(siblings, 256)


def folded(leaf: Column, sides, siblings) -> Column:
    """The root that ``leaf`` (hex text) and its proof lead to."""
    sides, siblings = (F.col(c) if isinstance(c, str) else c for c in (sides, siblings))
    start = F.struct(leaf.alias("node"), F.lit(1).alias("at"))

    def step(acc, side):
        other = F.substring(siblings, acc["at"], F.lit(64))
        text = (F.when(side == "L", F.concat(other, acc["node"])).when(side == "R", F.concat(acc["node"], other))
                .otherwise(acc["node"]))
        return F.struct(F.sha2(text, 256).alias("node"),
                        (acc["at"] + F.when(side == "-", 0).otherwise(64)).cast("int").alias("at"))

    each = F.filter(F.split(sides, ""), lambda s: s != "")
    return F.aggregate(each, start, step, lambda acc: acc["node"])


def manifest(docs: DataFrame, stride: int = STRIDE) -> tuple[Forest, Forest]:
    """The trees of ``docs`` by language and the tree of their roots. Leaves
    carry ``doc_id`` and ``tampered``, another leaf where a row is tampered with."""
    values = [F.col(c) for c in FIELDS]
    longer = F.coalesce(F.try_add(F.col("n_chars"), F.lit(1)), F.col("n_chars"))
    other = leaf_digest([longer if c == "n_chars" else F.col(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    # A text key: null first, then the languages' bytes in order.
    tree = F.when(F.col("lang").isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.col("lang")))
    leaves = materialize(docs.select(tree.alias("tree"), "doc_id", leaf_digest(values).alias("digest"),
                                     F.when(hit, other).alias("tampered"),
                                     F.monotonically_increasing_id().alias("tie")), "op13-rows")
    by_lang = build(leaves, ("doc_id", "digest", "tie"), stride)
    roots = by_lang.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    return by_lang, build(roots, ("name",), stride)


def verified(docs: DataFrame, stride: int = STRIDE) -> DataFrame:
    """Every row's leaf, subroot, root, proof, and the root that its leaf as it
    is found (tampered or not) folds to."""
    by_lang, top = manifest(docs, stride)
    root = top.roots.select("tree", F.lit("").alias("sides"), F.lit("").alias("siblings"), hex_of("digest").alias("root"))
    tops = proofs(top, root).select(F.col("name").alias("tree"), "sides", "siblings", hex_of("digest").alias("subroot"), "root")
    found = proofs(by_lang, tops).withColumn("leaf", hex_of("digest"))
    now = F.coalesce(hex_of("tampered"), F.col("leaf"))
    return (found.withColumn("folded_root", folded(now, "sides", "siblings"))
            .select("doc_id", "leaf", "subroot", "root", proof_digest("siblings").alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))


def oracle_sql() -> str:
    """The query as DuckDB SQL: levels, then proofs, by recursion."""
    part = lambda c: (f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)) END")
    leaf = lambda n: "sha256(concat(" + ", ".join(part(n if c == "n_chars" else c) for c in FIELDS) + "))"

    # DuckDB has no crc32: the table of its 256 remainders, and bytes one by one.
    bit = lambda x: f"CASE WHEN {x} % 2 = 1 THEN xor({x} // 2, 3988292384) ELSE {x} // 2 END"
    return f"""
WITH RECURSIVE bits AS (SELECT b, 0 AS i, CAST(b AS BIGINT) AS x FROM range(256) r(b)
  UNION ALL SELECT b, i + 1, {bit('x')} FROM bits WHERE i < 8),
crc_table AS (SELECT list(x ORDER BY b) AS t FROM bits WHERE i = 8),
crcs AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s, 0 AS i, CAST(4294967295 AS BIGINT) AS c FROM documents
    WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, s, i + 1, xor(c // 256, t[1 + xor(c % 256, ascii(s[i + 1]))]) FROM crcs, crc_table
    WHERE i < length(s)),
crc AS (SELECT doc_id AS id, xor(c, 4294967295) % {TAMPERED} = 0 AS hit FROM crcs WHERE i = length(s)),
leaves AS (SELECT coalesce('v' || lang, 'n') AS tree, doc_id, {leaf('n_chars')} AS leaf,
    CASE WHEN hit THEN {leaf('(n_chars + 1)')} END AS other, row_number() OVER () AS r
  FROM documents LEFT JOIN crc ON doc_id = crc.id),
placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx,
    count(*) OVER (PARTITION BY tree) AS n FROM leaves),
low AS (SELECT tree, 0 AS level, idx, n, leaf AS node FROM placed
  UNION ALL SELECT tree, level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY idx)) FROM low WHERE n > 1
  GROUP BY tree, level, idx // 2, n),
subroots AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS m FROM low WHERE n = 1),
high AS (SELECT 0 AS level, place AS idx, m AS n, node FROM subroots
  UNION ALL SELECT level + 1, idx // 2, (n + 1) // 2, sha256(string_agg(node, '' ORDER BY idx)) FROM high WHERE n > 1
  GROUP BY level, idx // 2, n),
root AS (SELECT node FROM high WHERE n = 1),
one AS (SELECT r, tree, 0 AS level, idx, n, coalesce(other, leaf) AS node, '' AS siblings FROM placed
  UNION ALL SELECT o.r, o.tree, o.level + 1, o.idx // 2, (o.n + 1) // 2,
    sha256(CASE WHEN o.idx % 2 = 0 THEN concat(o.node, coalesce(l.node, '')) ELSE concat(l.node, o.node) END),
    concat(o.siblings, coalesce(l.node, ''))
  FROM one o LEFT JOIN low l ON l.tree = o.tree AND l.level = o.level AND l.idx = xor(o.idx, 1) WHERE o.n > 1),
two AS (SELECT r, 0 AS level, s.place AS idx, s.m AS n, o.node, o.siblings FROM one o JOIN subroots s USING (tree) WHERE o.n = 1
  UNION ALL SELECT o.r, o.level + 1, o.idx // 2, (o.n + 1) // 2,
    sha256(CASE WHEN o.idx % 2 = 0 THEN concat(o.node, coalesce(h.node, '')) ELSE concat(h.node, o.node) END),
    concat(o.siblings, coalesce(h.node, ''))
  FROM two o LEFT JOIN high h ON h.level = o.level AND h.idx = xor(o.idx, 1) WHERE o.n > 1)
SELECT p.doc_id, p.leaf, s.node AS subroot, root.node AS root, sha256(t.siblings) AS proof_sha256,
  t.node AS folded_root, t.node = root.node AS verified
FROM placed p JOIN subroots s USING (tree) JOIN two t ON t.r = p.r AND t.n = 1, root"""
