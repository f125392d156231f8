"""SimHash near-duplicates by a self-join of a binary trie.

The trie of the distinct fingerprints is walked over pairs of nodes from the root
down. A pair carries the number of bits in which its two paths differ and is
dropped as soon as that exceeds the budget. The upper levels are walked with
DataFrames: nodes of the first bits become groups, and every pair of nodes within
the budget is one task, which walks the rest of the trie. Tasks return the links
that join their fingerprints, not all pairs, and connected components follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from paddock.llm.common import Names, materialize, prepared, row_keys

SHINGLE = 3
MAX_BITS = 3
NODE = 1 << 20
LEAST_DEPTH = 4
LEAF_PAIRS = 64
FRONTIER = 32_768
CHUNK_BITS = 24
STEP = 8192
LANES = np.uint64(0x0101010101010101)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash; 0 for a text without words."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    ws = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not ws:
        return 0
    width = min(shingle, len(ws))
    count = len(ws) - width + 1
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for at in range(0, count, STEP):
        part = ws[at : at + STEP + width - 1]
        grams = zip(*[part[i:] for i in range(width)])
        h = np.fromiter((digest(b" ".join(g), 42) for g in grams), np.uint64)
        # Eight bits are counted at once in the eight bytes of a word.
        for low in range(8):
            lanes = ((h >> np.uint64(low)) & LANES).view(np.uint8).reshape(-1, 8)
            set_bits[low::8] += lanes.sum(0, dtype=np.int64)
    over = (2 * set_bits > count).astype(np.uint64)
    return int((over << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64))


@F.pandas_udf(LongType())
def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        values = np.array([fingerprint(t) for t in part], np.uint64)
        yield pd.Series(values.view(np.int64))


class Links:
    """Union-find over positions 0 to n-1, by arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if np.array_equal(up, self.parent):
                return up
            self.parent = up

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        while i.size:
            roots = self.roots()
            i, j = roots[i], roots[j]
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(self.parent, np.maximum(i, j), np.minimum(i, j))


def trie_join(a: np.ndarray, b: np.ndarray, budget: int, same: bool) -> np.ndarray:
    """Root of each fingerprint among the links within ``budget`` bits.

    ``a`` and ``b`` are sorted distinct uint64; positions in ``b`` come after
    those in ``a``. With ``same`` the trie is joined with itself and b is a.
    """
    links = Links(len(a) if same else len(a) + len(b))
    shift = 0 if same else len(a)
    stack = [(0, *(np.array([x], np.int64) for x in (0, len(a), 0, len(b), 0)))]
    while stack:
        depth, a0, a1, b0, b1, err = stack.pop()
        if a0.size > FRONTIER:
            half = a0.size // 2
            stack.append((depth, *(x[half:] for x in (a0, a1, b0, b1, err))))
            stack.append((depth, *(x[:half] for x in (a0, a1, b0, b1, err))))
            continue
        pairs = (a1 - a0) * (b1 - b0)
        leaf = (pairs <= LEAF_PAIRS) | (depth == 64)
        if leaf.any():
            p, width = pairs[leaf], (b1 - b0)[leaf]
            at = np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)
            i = np.repeat(a0[leaf], p) + at // np.repeat(width, p)
            j = np.repeat(b0[leaf], p) + at % np.repeat(width, p)
            near = np.bitwise_count(a[i] ^ b[j]) <= budget
            if same:
                near &= i < j
            links.join(i[near], j[near] + shift)
        go = ~leaf
        if not go.any():
            continue
        a0, a1, b0, b1, err = (x[go] for x in (a0, a1, b0, b1, err))
        bit = np.uint64(1 << (63 - depth))
        above = ~np.uint64((1 << (64 - depth)) - 1)
        am = np.clip(np.searchsorted(a, (a[a0] & above) | bit), a0, a1)
        bm = np.clip(np.searchsorted(b, (b[b0] & above) | bit), b0, b1)
        children = [(a0, am, b0, bm, err), (am, a1, bm, b1, err), (a0, am, bm, b1, err + 1), (am, a1, b0, bm, err + 1)]
        if same:  # of a node with itself, the two mixed pairs are one
            other = a0 != b0
            children[3] = tuple(x[other] for x in children[3])
        merged = [np.concatenate(x) for x in zip(*children)]
        alive = (merged[0] < merged[1]) & (merged[2] < merged[3]) & (merged[4] <= budget)
        if alive.any():
            stack.append((depth + 1, *(x[alive] for x in merged)))
    return links.roots()


def bit_order(distinct: DataFrame) -> list[int]:
    """Bits, the most evenly set first: the order of the levels of the trie."""
    sums = [F.sum(F.shiftrightunsigned("fp", k).bitwiseAND(F.lit(1))).alias(f"b{k}") for k in range(64)]
    row = distinct.agg(F.count("*").alias("n"), *sums).first()
    return sorted(range(64), key=lambda k: (abs(2 * (row[f"b{k}"] or 0) - row["n"]), k))


def linked(distinct: DataFrame, budget: int = MAX_BITS, node: int = NODE) -> DataFrame:
    """Links (u, v) that connect all fingerprints ``fp`` within ``budget`` bits."""
    total = distinct.count()
    depth = max(LEAST_DEPTH, (total // node).bit_length())
    order = bit_order(distinct)
    prefix = sum((F.shiftrightunsigned("fp", k).bitwiseAND(F.lit(1)) * (1 << (depth - 1 - i)) for i, k in enumerate(order[:depth])), F.lit(0))
    nodes = distinct.withColumn("prefix", prefix)
    # A node of more fingerprints than planned for is dealt out to several parts.
    sizes = nodes.groupBy("prefix").agg(F.count("*").alias("size"))
    sizes = materialize(sizes.select("prefix", F.ceil(F.col("size") / node).alias("parts")), "nodes")
    near = [m for m in range(1 << depth) if m.bit_count() <= budget]
    other = sizes.select(F.col("prefix").alias("to"), F.col("parts").alias("to_parts"))
    pairs = sizes.withColumn("apart", F.explode(F.array(*[F.lit(m).cast("long") for m in near])))
    pairs = pairs.withColumn("to", F.col("prefix").bitwiseXOR(F.col("apart")))
    pairs = pairs.join(other, "to")
    part = lambda prefix, i: F.shiftleft(prefix, CHUNK_BITS) + i
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("to_parts") - 1), lambda i: part(F.col("to"), i))
    met = pairs.groupBy("prefix").agg(F.first("parts").alias("parts"), F.flatten(F.collect_list(met)).alias("met"))
    own = part(F.col("prefix"), F.pmod(F.xxhash64("fp"), F.col("parts")))
    dealt = nodes.join(met, "prefix").withColumn("own", own)
    dealt = dealt.select("fp", "own", F.explode("met").alias("other"))
    dealt = dealt.select("fp", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), (F.col("own") > F.col("other")).alias("right"))

    def walk(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        fps, right = rows["fp"].to_numpy(), rows["right"].to_numpy()
        bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        paths = np.ascontiguousarray(np.packbits(bits[:, order], axis=1)).view(">u8").ravel().astype(np.uint64)
        same = key[0] == key[1]
        sides = [np.flatnonzero(~right)] + ([] if same else [np.flatnonzero(right)])
        if any(not s.size for s in sides):
            return pd.DataFrame({"u": fps[:0], "v": fps[:0]})
        sides = [s[np.argsort(paths[s])] for s in sides]
        roots = trie_join(paths[sides[0]], paths[sides[-1]], budget, same)
        mine = fps[np.concatenate(sides)]
        child = np.flatnonzero(roots != np.arange(roots.size))
        return pd.DataFrame({"u": mine[child], "v": mine[roots[child]]})

    return dealt.groupBy("lo", "hi").applyInPandas(walk, "u long, v long")


def star(edges: DataFrame) -> DataFrame:
    """Links (u, v) of any graph, turned into (u, smallest node of its component).

    Large and small stars by turns: every node links its larger neighbours, then
    its smaller ones, to the smallest it knows. The rounds grow with the logarithm
    of the longest path; each is written to shared storage.
    """
    def both(e: DataFrame) -> DataFrame:
        return e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())

    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = materialize(edges, "links")
    before, now = None, state(edges)
    while now != before and now[0]:
        sides = both(edges)
        least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # All of these point down, as the small stars ask for.
        large = materialize(large.where("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "links")
        before, now = now, state(edges)
    return edges


def signed_components(signed: DataFrame, id_col: str = "doc_id", budget: int = MAX_BITS) -> DataFrame:
    """For every distinct fp of ``signed`` (id, fp) its component over links of at
    most ``budget`` differing bits: component_id, the smallest id in it (null if
    it has none), and root, its smallest fingerprint."""
    distinct = materialize(signed.groupBy("fp").agg(F.min(id_col).alias("least")), "distinct")
    stars = star(linked(distinct, budget))
    members = stars.unionByName(stars.select(F.col("v").alias("u"), "v")).distinct().withColumnRenamed("u", "fp")
    rows = members.join(distinct, "fp")
    roots = rows.groupBy("v").agg(F.min("least").alias("component"))
    joined = members.join(roots, "v")
    alone = F.col("v").isNull()
    component = F.when(alone, F.col("least")).otherwise(F.col("component")).alias("component_id")
    return distinct.join(joined, "fp", "left").select("fp", component, F.coalesce("v", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", budget: int = MAX_BITS) -> DataFrame:
    """One row per document: id, fp (signed) and component_id.

    Null and empty texts, and those of white space, have fingerprint zero and link
    like any other. Documents with the same fingerprint are in one component and
    count once in the join. An empty table gives an empty result.
    """
    prepared(docs.sparkSession)
    signed = materialize(docs.select(id_col, fingerprints("text").alias("fp")), "signed")
    # Written first, so that Spark can split the rows of a hot fingerprint in the join.
    found = materialize(signed_components(signed, id_col, budget), "components")
    return signed.join(found, "fp").select(id_col, "fp", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", budget: int = MAX_BITS) -> DataFrame:
    """Documents with one of each component: the one with the smallest id (null
    ids last; the row hash decides between rows of one id). Of equal rows one
    stays. Columns are kept as they are."""
    prepared(docs.sparkSession)
    k1, k2 = row_keys(docs)
    signed = docs.select(F.col(id_col).alias("id"), fingerprints("text").alias("fp"), k1.alias("_k1"), k2.alias("_k2"))
    signed = materialize(signed, "signed")
    joined = signed.join(materialize(signed_components(signed, "id", budget), "components"), "fp")
    first = F.min(F.struct(F.col("id").isNull(), "id", "_k1", "_k2")).alias("kept")
    one, two = Names(docs).new("k1", "k2")
    kept = joined.groupBy("root").agg(first).select(F.col("kept._k1").alias(one), F.col("kept._k2").alias(two))
    kept = materialize(kept, "kept")
    keyed = docs.withColumns({one: k1, two: k2})
    return keyed.join(kept, [one, two], "left_semi").dropDuplicates([one, two]).drop(one, two)
