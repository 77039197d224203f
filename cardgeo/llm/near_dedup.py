"""Near-duplicate classes by an LSH forest of MinHash signatures.

Documents are sets of distinct 5-word shingles; two documents are linked if
``100 * |A n B| >= 75 * |A u B|``, and a class is a connected component.

1. One pass hashes each text into its shingle set, a digest of the set and a
   MinHash signature. Equal sets collapse into one *node*, so a group of exact
   copies of any size costs one node.
2. The forest: ``TREES`` sorted orders, each by its own sequence of ``DEPTH``
   MinHash values. Each order is range-partitioned by the whole sequence, so
   no prefix, however common, gathers in one task. In a sorted run, nodes with
   a longest common prefix of at least one value form a region; a region over
   ``REGION`` nodes goes one value deeper, region by region, until it is small
   or the sequence ends (then overlapping blocks of the run). Neighbours on
   both sides of a split stay candidates.
3. Within a region, all pairs are estimated on the signatures in numpy; only a
   spanning forest of the plausible pairs leaves the task -- a group of near
   copies costs its size, not its square.
4. The edges are confirmed on full shingle sets, components are found, and
   regions whose forest had a refuted edge are searched again, on full sets,
   for links between different components.

With one shared value enough in a sparse region, a pair at the threshold is
missed with probability 0.25 ** 12 = 6e-8; deeper regions rely on the other
orders and on transitive links.

Defined results: a null or blank text has no shingles, is linked with nothing
and is kept; a row with a null id takes no part (component null, kept);
repeated rows share their class.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HashedWords, U64, materialize, mix64, text_batches, text_chunks, window_hashes
from .components import connected_components

SHINGLE = 5
TREES, DEPTH = 12, 8
N_HASH = TREES * DEPTH
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Nodes in a region that are compared with each other.
REGION = 512
#: Signature matches of N_HASH below which a pair cannot be a link: 5.2
#: standard deviations under the 72 expected at the threshold.
PLAUSIBLE = 50
#: Matches that make an edge of the first pass of a region's forest.
LIKELY = 82
#: Shingles of a region up to which its sets are gathered in one task.
REGION_SHINGLES = 1 << 22
_CHUNK = 4096
_KEY = 1 + 4 + 2 * (DEPTH - 1)


#: The hash family: odd multipliers and offsets, modulo 2 ** 32.
_MULTIPLY, _ADD = (mix64(np.arange(1, 2 * N_HASH + 1, dtype=U64)) >> U64(32)).astype(np.uint32).reshape(2, -1)
_MULTIPLY = _MULTIPLY | np.uint32(1)


def shingle_sets(texts):
    """Sorted distinct hashes of each text's shingles."""
    for _, run in text_chunks(texts):
        words = HashedWords(run)
        for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
            h = words.hash[a:b]
            yield np.sort(pd.unique(window_hashes(h, min(SHINGLE, b - a)))) if b > a else np.empty(0, U64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """``N_HASH`` MinHash values (32 bits each)."""
    x = (shingles >> U64(32)).astype(np.uint32)
    low = np.full(N_HASH, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(x), _CHUNK):
        low = np.minimum(low, (x[i:i + _CHUNK, None] * _MULTIPLY + _ADD).min(axis=0))
    return low


def digest_of(shingles: np.ndarray) -> int:
    """Signed 64-bit name of a shingle set: the node of its documents."""
    d = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(d, "little", signed=True)


#: Ids pass through pandas as text: a null beside them would make them floats.
SIGNED = "doc_id string, node long, n_shingles long, sig binary"


def _sign(batches):
    for pdf in batches:
        sets = list(shingle_sets(pdf["text"]))
        yield pd.DataFrame({
            "doc_id": pdf["doc_id"], "node": pd.array([digest_of(s) if len(s) else None for s in sets], "Int64"),
            "n_shingles": [len(s) for s in sets], "sig": [signature(s).tobytes() if len(s) else None for s in sets]})


def _forest_rows(batches):
    """One row per tree: tree and MinHash sequence as a sortable key."""
    for pdf in batches:
        if not len(pdf):
            continue
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), TREES, DEPTH)
        est = (sig.reshape(len(pdf), N_HASH) & 0xFF).astype(np.uint8)
        est = [e.tobytes() for e in est]
        for t in range(TREES):
            key = np.empty((len(pdf), _KEY), np.uint8)
            key[:, 0] = t
            key[:, 1:5] = sig[:, t, 0].astype(">u4").view(np.uint8).reshape(-1, 4)
            key[:, 5:] = (sig[:, t, 1:] >> 16).astype(">u2").view(np.uint8).reshape(len(pdf), -1)
            yield pd.DataFrame({"key": [k.tobytes() for k in key], "est": est, "node": pdf["node"].to_numpy()})


def _common_prefix(key: np.ndarray) -> np.ndarray:
    """Shared leading MinHash values of each row and the next."""
    same = key[1:] == key[:-1]
    levels = np.empty((len(same), DEPTH), bool)
    levels[:, 0] = same[:, :5].all(axis=1)
    for d in range(1, DEPTH):
        levels[:, d] = levels[:, d - 1] & same[:, 3 + 2 * d] & same[:, 4 + 2 * d]
    return levels.sum(axis=1)


def _regions(lcp: np.ndarray, n: int):
    """Index ranges (lo, hi) to compare: runs of a shared prefix, deeper where
    a run is long; pairs of neighbours where a run was split."""
    cuts = np.flatnonzero(lcp < 1) + 1
    lo = np.concatenate(([0], cuts))
    hi = np.concatenate((cuts, [n]))
    many = hi - lo >= 2
    todo = [(int(a), int(b), 1) for a, b in zip(lo[many], hi[many])]
    while todo:
        a, b, depth = todo.pop()
        if b - a <= REGION:
            yield a, b
        elif depth == DEPTH:
            for start in range(a, b - 1, REGION - max(1, REGION // 8)):
                yield start, min(start + REGION, b)
        else:
            cuts = (np.flatnonzero(lcp[a:b - 1] < depth + 1) + a + 1).tolist()
            for c in cuts:
                yield c - 1, c + 1
            todo += [(x, y, depth + 1) for x, y in zip([a, *cuts], [*cuts, b]) if y - x >= 2]


def _matches(est: np.ndarray) -> np.ndarray:
    """Pairwise counts of equal signature values."""
    out = np.zeros((len(est), len(est)), np.uint8)
    for column in np.ascontiguousarray(est.T):
        out += column[:, None] == column[None, :]
    return out


def _find(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _spanning(match: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with at least ``PLAUSIBLE`` matches,
    through likely links first."""
    m = len(match)
    edges: list[tuple[int, int]] = []
    near = match >= LIKELY
    group = np.full(m, -1)
    for root in range(m):
        if group[root] >= 0:
            continue
        group[root], queue = root, [root]
        while queue:
            u = queue.pop()
            new = np.flatnonzero(near[u] & (group < 0))
            group[new] = root
            new = new.tolist()
            edges += [(u, v) for v in new]
            queue += new
    i, j = np.nonzero(np.triu((match >= PLAUSIBLE) & (group[:, None] != group[None, :]), 1))
    if len(i):
        parent = list(range(m))
        for k in np.argsort(-match[i, j].astype(int), kind="stable").tolist():
            u, v = int(i[k]), int(j[k])
            a, b = _find(parent, int(group[u])), _find(parent, int(group[v]))
            if a != b:
                parent[a] = b
                edges.append((u, v))
    return edges


EDGES = "region long, u long, v long"


def _candidates(batches):
    """Spanning edges of the regions of one sorted partition (its size is
    bounded by the number of range partitions)."""
    parts = [pdf for pdf in batches if len(pdf)]
    if not parts:
        return
    n = sum(map(len, parts))
    key = np.frombuffer(b"".join(k for p in parts for k in p["key"]), np.uint8).reshape(n, _KEY)
    est = np.frombuffer(b"".join(e for p in parts for e in p["est"]), np.uint8).reshape(n, N_HASH)
    node = np.concatenate([p["node"].to_numpy() for p in parts])
    region, us, vs = [], [], []
    for a, b in _regions(_common_prefix(key), n):
        if b - a == 2:
            edges = [(0, 1)] if (est[a] == est[a + 1]).sum() >= PLAUSIBLE else []
        else:
            edges = _spanning(_matches(est[a:b]))
        if edges:
            # A region of one edge needs no second search: 0.
            name = xxhash.xxh3_64_intdigest(key[a].tobytes() + node[a:b].tobytes()) >> 1 if len(edges) > 1 else 0
            for u, v in edges:
                region.append(name)
                us.append(node[a + u])
                vs.append(node[a + v])
    yield pd.DataFrame({"region": region, "u": us, "v": vs}).astype("int64")


def _cross_pairs(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Plausible pairs of one region between different components, the most
    alike first."""
    est = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), N_HASH)
    match, root = _matches((est & 0xFF).astype(np.uint8)), pdf["root"].to_numpy()
    i, j = np.nonzero(np.triu((match >= PLAUSIBLE) & (root[:, None] != root[None, :]), 1))
    by = np.argsort(-match[i, j].astype(int), kind="stable")
    return i[by], j[by]


def _pairs_of_region(pdf: pd.DataFrame) -> pd.DataFrame:
    (i, j), node = _cross_pairs(pdf), pdf["node"].to_numpy()
    return pd.DataFrame({"u": np.minimum(node[i], node[j]), "v": np.maximum(node[i], node[j])})


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _links_of_region(pdf: pd.DataFrame) -> pd.DataFrame:
    """Links between components of one region, confirmed on the full sets
    that its rows carry; none that a link found before makes needless."""
    node = pdf["node"].to_numpy()
    place = {r: k for k, r in enumerate(pd.unique(pdf["root"]))}
    group, parent = [place[r] for r in pdf["root"]], list(range(len(place)))
    sets = [np.frombuffer(x, U64) for x in pdf["shingles"]]
    out = []
    for i, j in zip(*(x.tolist() for x in _cross_pairs(pdf))):
        a, b = _find(parent, group[i]), _find(parent, group[j])
        if a != b and _linked(sets[i], sets[j]):
            parent[a] = b
            out.append((node[i], node[j]))
    return pd.DataFrame(out, columns=["u", "v"])


def _sets(batches):
    for pdf in batches:
        out = []
        for want, s in zip(pdf["node"], shingle_sets(pdf["text"])):
            if len(s) and digest_of(s) == want:  # a repeated id may have another text
                out.append((want, s.tobytes()))
        yield pd.DataFrame(out, columns=["node", "shingles"])


def _confirm(batches):
    for pdf in batches:
        ok = [_linked(np.frombuffer(a, U64), np.frombuffer(b, U64)) for a, b in zip(pdf["a"], pdf["b"])]
        yield pd.DataFrame({"u": pdf["u"], "v": pdf["v"], "linked": ok})


def _sets_of(nodes: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """Shingle sets of distinct ``nodes``, computed again from one text each."""
    wanted = first.join(nodes, "node", "left_semi")
    sets = (docs.join(wanted, "doc_id").select("node", "text")
            .mapInPandas(_sets, "node long, shingles binary").dropDuplicates(["node"]))
    return materialize(sets, "op1-sets")


def _confirmed(pairs: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with ``linked``: the contract's test on whole sets."""
    sets = _sets_of(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct(), first, docs)
    return (pairs.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
            .mapInPandas(_confirm, "u long, v long, linked boolean"))


def near_duplicates(docs: DataFrame, id_col: str | Column = "doc_id",
                    text_col: str | Column = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    spark = docs.sparkSession
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    docs = docs.select(as_col(id_col).cast("long").alias("doc_id"), as_col(text_col).cast("binary").alias("text"))
    named = text_batches(docs).withColumn("doc_id", F.col("doc_id").cast("string"))
    signed = materialize(named.mapInPandas(_sign, SIGNED).withColumn("doc_id", F.col("doc_id").cast("long")),
                         "op1-signed")
    live = signed.where("doc_id is not null and node is not null")
    first = live.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    sigs = materialize(live.select("node", "sig").dropDuplicates(["node"]), "op1-nodes")

    rows = sigs.count() * TREES
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // 100_000 + 1)
    forest = (sigs.mapInPandas(_forest_rows, "key binary, est binary, node long")
              .repartitionByRange(parts, "key", "node").sortWithinPartitions("key", "node"))
    edges = materialize(forest.mapInPandas(_candidates, EDGES), "op1-edges")
    pairs = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    checked = materialize(_confirmed(pairs, first, docs), "op1-checked")
    links = checked.where("linked").select("u", "v")
    comp = materialize(connected_components(links), "op1-components")

    # Regions whose forest lost an edge between components: all their pairs.
    lost = (checked.where("not linked").select("u", "v")
            .join(comp.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u", "left")
            .join(comp.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v", "left")
            .where(F.coalesce("ru", "u") != F.coalesce("rv", "v")).select("u", "v"))
    again = materialize(edges.where("region != 0").withColumn("x", F.least("u", "v")).withColumn("y", F.greatest("u", "v"))
                        .join(lost.toDF("x", "y"), ["x", "y"], "left_semi").select("region").distinct(),
                        "op1-again")
    if not again.isEmpty():
        members = materialize(edges.join(again, "region", "left_semi")
                              .select("region", F.explode(F.array("u", "v")).alias("node")).distinct()
                              .join(comp, "node", "left").withColumn("root", F.coalesce("root", "node"))
                              .join(live.select("node", "n_shingles").distinct(), "node"), "op1-members")
        # A region's sets meet in one task if they are small; the pairs of the
        # few others are confirmed one by one.
        large = members.groupBy("region").agg(F.sum("n_shingles").alias("n")).where(F.col("n") > REGION_SHINGLES)
        small = members.join(large, "region", "left_anti")
        sets = _sets_of(small.select("node").distinct(), first, docs)
        more = (small.join(sigs, "node").join(sets, "node").select("region", "node", "root", "sig", "shingles")
                .groupBy("region").applyInPandas(_links_of_region, "u long, v long"))
        rest = materialize(members.join(large, "region", "left_semi").join(sigs, "node")
                           .select("region", "node", "root", "sig").groupBy("region")
                           .applyInPandas(_pairs_of_region, "u long, v long").distinct()
                           .join(checked, ["u", "v"], "left_anti"), "op1-rest")
        if not rest.isEmpty():
            more = more.unionByName(_confirmed(rest, first, docs).where("linked").select("u", "v"))
        star = comp.where("node != root").select(F.col("root").alias("u"), F.col("node").alias("v"))
        comp = connected_components(star.unionByName(more))

    roots = comp.join(first, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = (first.join(comp, "node", "left").join(roots, "root", "left")
             .select("node", F.coalesce("component_id", "doc_id").alias("component_id")))
    return (signed.select("doc_id", "node", "n_shingles").join(named, "node", "left")
            .withColumn("component_id", F.when(F.col("doc_id").isNotNull(),
                                               F.coalesce("component_id", "doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    (F.col("doc_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("kept")))
