"""The prefix trie of conversations, by the Euler-tour technique.

Every distinct beginning of conversations is a node. Each node gives an enter and an
exit arc; the arcs form one list, the tour. The list is ranked by contraction: arcs of
one path are joined within tasks, then neighbours drawn by coins are merged round by
round until the rest fits one task, and the ranks are handed back in reverse. Sums
over a subtree are differences of prefix sums at the positions of its two arcs.

Rows travel as hashes; texts are read once and never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paddock.llm.common import materialize, prepared
from paddock.operators.ordered import join_same

# A rebuilt conversation begins with up to MOST_BORROWED turns of its group's first.
GROUP, MOST_BORROWED = 5, 8
# Rows of one conversation, and of the tour, whose running values one task computes.
RUN = 4096
POSITIONS = 65_536
# Arcs that one task contracts, and of the list that the last task ranks.
ARCS = 20_000
END = -1


def hashes(*parts: Column) -> tuple[Column, Column]:
    """Two hashes of 64 bits of the same parts."""
    return F.xxhash64(F.lit("a"), *parts), F.xxhash64(F.lit("b"), *parts)


def placed(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows (key, pos, role, digest, cost): each turn's exact place (from 0) in its
    conversation, by turn (null first), then role and the MD5 of its text.

    Rows are dealt out by (key, turn), so that a long conversation lies in many
    partitions; they are numbered in each, and earlier ones are counted.
    """
    text = F.coalesce("text", F.lit(""))
    rows = conversations.select(
        F.col(key).alias("key"), F.col("turn").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.md5(text.cast("binary")).alias("digest"),
        F.octet_length(text).cast("long").alias("cost"),
    )
    order = ["key", "turn", "role", "digest"]
    rows = materialize(rows.repartitionByRange(*order).withColumn("piece", F.spark_partition_id()), "turns")
    before = W.partitionBy("key").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("key", "piece").agg(F.count("*").alias("rows"))
    starts = starts.withColumn("start", F.sum("rows").over(before)).where("start > 0").drop("rows")
    number = F.row_number().over(W.partitionBy("key", "piece").orderBy("turn", "role", "digest"))
    found = join_same(rows.withColumn("number", number - 1), starts, ["key", "piece"], "left")
    return found.select("key", (F.coalesce("start", F.lit(0)) + F.col("number")).alias("pos"), "role", "digest", "cost")


def rebuilt(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows (key, pos, role, digest, cost, length) of rebuilt conversations: c takes the
    first h turns of conversation c - c % 5, as far as there are, then its own after
    its first h; h is the CRC-32 of the decimal c, modulo 9. A conversation without
    turns is one row with a null pos. A null key borrows nothing."""
    turns = materialize(placed(conversations, key), "placed")
    counts = turns.groupBy("key").agg(F.count("*").alias("own"))
    h = F.coalesce(F.crc32(F.col("key").cast("string").cast("binary")) % (MOST_BORROWED + 1), F.lit(0))
    convs = counts.withColumns({"h": h, "base": F.col("key") - F.col("key") % GROUP})
    bases = counts.select(F.col("key").alias("base"), F.col("own").alias("there"))
    convs = convs.join(bases, "base", "left").withColumn("borrowed", F.least("h", F.coalesce("there", F.lit(0))))
    convs = convs.withColumn("length", F.col("borrowed") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("key", "base", "h", "borrowed", "length"), "conversations")
    made = ["key", "pos", "role", "digest", "cost", "length"]
    own = join_same(turns, convs.drop("base"), ["key"], "inner").where("pos >= h")
    own = own.withColumn("pos", F.col("pos") - F.col("h") + F.col("borrowed")).select(*made)
    first = turns.where((F.col("pos") < MOST_BORROWED) & (F.col("key") % GROUP == 0)).withColumnRenamed("key", "base")
    taken = first.join(convs, "base").where("pos < h").select(*made)
    none = convs.where("length = 0").select("key", *[F.lit(None).cast(turns.schema[c].dataType).alias(c) for c in made[1:-1]], "length")
    return own.unionByName(taken).unionByName(none)


def with_prefixes(turns: DataFrame) -> DataFrame:
    """Add the hashes (k1, k2) of all turns up to each row and (p1, p2) of those before
    it. A turn's hash knows its place, so the exclusive or of the hashes stands for
    the sequence, and runs of one conversation are summed up apart."""
    a, b = hashes("pos", "role", "digest")
    rows = turns.withColumns({"a": a, "b": b, "run": F.floor(F.col("pos") / RUN)})
    within = W.partitionBy("key", "run").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("key").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy("key", "run").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    totals = totals.select("key", "run", F.bit_xor("a").over(before).alias("a0"), F.bit_xor("b").over(before).alias("b0")).where("run > 0")
    rows = rows.withColumns({"k1": F.bit_xor("a").over(within), "k2": F.bit_xor("b").over(within)})
    rows = join_same(rows, totals, ["key", "run"], "left")
    rows = rows.withColumns({k: F.col(k).bitwiseXOR(F.coalesce(o, F.lit(0))) for k, o in (("k1", "a0"), ("k2", "b0"))})
    return rows.withColumns({"p1": F.col("k1").bitwiseXOR(F.col("a")), "p2": F.col("k2").bitwiseXOR(F.col("b"))}).drop("a", "b", "a0", "b0", "run")


def contracted(arcs: np.ndarray, after: np.ndarray, length: np.ndarray) -> tuple:
    """Of list elements in one task: each one's head (the first element that leads
    to it here), its distance from it, and for heads the total length and what
    follows; other elements have length 0."""
    order = np.argsort(arcs)
    at = np.searchsorted(arcs, after, sorter=order).clip(max=max(len(arcs) - 1, 0))
    to = order[at]
    known = arcs[to] == after
    up = np.arange(len(arcs))
    up[to[known]] = np.flatnonzero(known)
    far = np.where(up == np.arange(len(arcs)), 0, length[up])
    while True:
        above = up[up]
        if np.array_equal(above, up):
            break
        far, up = far + far[up], above
    total, follows = np.zeros_like(length), np.full_like(after, END)
    tails = np.flatnonzero(~known)
    total[up[tails]] = far[tails] + length[tails]
    follows[up[tails]] = after[tails]
    return arcs[up], far, total, follows


def _contract(rows: pd.DataFrame) -> pd.DataFrame:
    values = contracted(*(rows[c].to_numpy() for c in ("arc", "after", "length")))
    return rows.assign(**dict(zip(("head", "far", "length", "after"), values)))[[c for c in rows if c != "bucket"] + ["head", "far"]]


def in_tasks(links: DataFrame, bucket: Column) -> DataFrame:
    """Links (arc, after, length, ...) contracted within the buckets; adds head, far."""
    schema = StructType(list(links.schema.fields)).add("head", "long").add("far", "long")
    return links.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(_contract, schema)


def ranks(links: DataFrame, limit: int = ARCS) -> DataFrame:
    """(arc, rank) of the elements (arc, after, length) of one list, ``after`` of its
    last one being END: how much length lies before each.

    Until at most ``limit`` elements are left, every round an element takes in the
    next one if their coins fall so: about a quarter of them go. One task ranks the
    rest, and the elements taken in get their ranks in reverse.
    """
    links, taken = materialize(links.select("arc", "after", "length"), "links"), []
    while links.count() > limit:
        coin = F.xxhash64("arc", F.lit(len(taken))).bitwiseAND(1)
        told = links.withColumn("coin", coin)
        next_one = told.where("coin = 1").select(F.col("arc").alias("next"), F.col("after").alias("next_after"), F.col("length").alias("next_length"))
        met = told.join(next_one, (F.col("after") == F.col("next")) & (F.col("coin") == 0), "left")
        met = materialize(met.drop("coin"), "met")
        gone = met.where("next IS NOT NULL").select(F.col("next").alias("arc"), F.col("arc").alias("head"), F.col("length").alias("far"))
        taken.append(gone)
        rest = met.join(gone.select("arc"), "arc", "left_anti")
        after, length = F.when(F.col("next").isNull(), F.col("after")).otherwise(F.col("next_after")), F.col("length") + F.coalesce("next_length", F.lit(0))
        links = materialize(rest.select("arc", after.alias("after"), length.alias("length")), "links")
    done = materialize(in_tasks(links, F.lit(0)).select("arc", F.col("far").alias("rank")), "ranks")
    for gone in reversed(taken):
        heads = done.select(F.col("arc").alias("head"), "rank")
        more = gone.join(heads, "head").select("arc", (F.col("rank") + F.col("far")).alias("rank"))
        done = done.unionByName(materialize(more, "ranks"))
    return done


def nodes_of(members: DataFrame, ids: DataFrame) -> DataFrame:
    """Nodes with numbers, parents, first children and next siblings. They are sorted
    by (parent, key) over all partitions, so the children of one parent may be many."""
    found = members.where("pos IS NOT NULL").groupBy("k1", "k2").agg(
        F.min("key").alias("conv_id"), F.count("*").alias("n_convs"), F.max(F.col("pos") + 1).alias("depth"), F.max("cost").alias("cost"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    )
    root = ids.agg(F.min("key").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = root.select(zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("depth"), zero.alias("cost"), null.alias("p1"), null.alias("p2"))
    order = ["p1", "p2", "k1", "k2"]
    nodes = found.unionByName(root).repartitionByRange(*order).sortWithinPartitions(*order)
    nodes = materialize(nodes.withColumns({"piece": F.spark_partition_id(), "node": F.monotonically_increasing_id()}), "nodes")
    below = nodes.where("p1 IS NOT NULL")
    children = below.groupBy("p1", "p2").agg(F.min("node").alias("child"), F.count("*").alias("n_children"))
    children = children.withColumnsRenamed({"p1": "k1", "p2": "k2"})
    heads = below.groupBy("p1", "p2", "piece").agg(F.min("node").alias("head"))
    heads = heads.withColumn("later", F.lead("head").over(W.partitionBy("p1", "p2").orderBy("piece"))).where("later IS NOT NULL").drop("head")
    sibling = F.lead("node").over(W.partitionBy("p1", "p2", "piece").orderBy("node"))
    linked = nodes.withColumn("sibling", sibling).join(heads, ["p1", "p2", "piece"], "left").withColumn("sibling", F.coalesce("sibling", "later"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    linked = linked.join(children, ["k1", "k2"], "left").join(parents, ["p1", "p2"], "left")
    return materialize(linked.drop("p1", "p2", "piece", "later").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "linked")


def subtree_sums(nodes: DataFrame, limit: int = ARCS) -> DataFrame:
    """(node, n_leaves, saved_tokens) by the tour of the nodes.

    The enter arc of a node weighs a leaf if it has no child, and what is saved by
    holding its turn once."""
    enter, leave = F.col("node") * 2, F.col("node") * 2 + 1
    is_leaf = F.when(F.col("child").isNull(), 1).otherwise(0).cast("long")
    saved = ((F.col("n_convs") - 1) * F.col("cost")).cast("long")
    zero = F.lit(0).cast("long")
    after_leave = F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1, F.lit(END).cast("long"))
    arcs = F.array(
        F.struct(enter.alias("arc"), F.coalesce(F.col("child") * 2, leave).alias("after"), is_leaf.alias("leaves"), saved.alias("saved")),
        F.struct(leave.alias("arc"), after_leave.alias("after"), zero.alias("leaves"), zero.alias("saved")),
    )
    # Nodes whose smallest member is the same lie on one path; long ones are cut.
    path = F.xxhash64("conv_id", F.floor(F.col("depth") / RUN))
    links = nodes.select(path.alias("path"), F.inline(arcs)).withColumn("length", F.lit(1).cast("long"))
    buckets = -(-2 * nodes.count() // limit) + 1
    first = materialize(in_tasks(links, F.pmod("path", F.lit(buckets))).drop("path"), "contracted")
    ranked = ranks(first.where("arc = head"), limit).withColumnRenamed("arc", "head")
    at = first.join(ranked, "head").select("arc", (F.col("rank") + F.col("far")).alias("at"), "leaves", "saved")
    at = materialize(at.withColumn("run", F.floor(F.col("at") / POSITIONS)), "tour")
    totals = at.groupBy("run").agg(F.sum("leaves").alias("l0"), F.sum("saved").alias("s0"))
    before = W.orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select("run", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("l0", "s0")])
    within = W.partitionBy("run").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    sums = at.withColumns({"l": F.sum("leaves").over(within), "s": F.sum("saved").over(within)}).join(totals, "run")
    leaving = F.col("arc") % 2 == 1

    def between(prefix: str, start: str, own: str) -> Column:
        upto = F.col(prefix) + F.col(start)
        return F.sum(F.when(leaving, upto).otherwise(F.col(own) - upto)).cast("long")

    node = F.shiftright("arc", 1).alias("node")
    return sums.groupBy(node).agg(between("l", "l0", "leaves").alias("n_leaves"), between("s", "s0", "saved").alias("saved_tokens"))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (k1, k2, key) to one digest of the keys for each (k1, k2)."""
    node, state, done = None, None, []

    def batch_of(rows):
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=["k1", "k2", "ends_sha256"])

    for batch in batches:
        for k1, k2, key in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "key")]):
            if (k1, k2) == node:
                state.update(f",{key}".encode())
                continue
            if node:
                done.append((*node, state.hexdigest()))
            node, state = (k1, k2), hashlib.sha256(str(key).encode())
        if len(done) >= 512:
            yield batch_of(done)
            done = []
    if node:
        yield batch_of([*done, (*node, state.hexdigest())])


def prefix_trie(turns: DataFrame, limit: int = ARCS) -> DataFrame:
    """One row for each node of the trie of ``turns``: rows (key, pos, role, digest,
    cost, length), a conversation without turns being one row with a null pos.

    Columns: conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256 (of the members that end
    here). Repeated conversations are members of the same nodes. A null key is one
    conversation: it counts, but is never the smallest and has no decimal, so a node
    that it alone belongs to has a null conv_id. No turns give no nodes.
    """
    members = materialize(with_prefixes(turns), "members")
    last = F.when(F.col("pos").isNull(), F.lit(True)).otherwise(F.col("pos") + 1 == F.col("length"))
    ended = members.where(last)
    nodes = nodes_of(members, ended.select("key"))
    sums = subtree_sums(nodes, limit)
    root = F.col("pos").isNull()
    ends = ended.where("key IS NOT NULL").select(*[F.when(root, 0).otherwise(F.col(c)).cast("long").alias(c) for c in ("k1", "k2")], "key")
    # Sorted by Spark and read row by row: no task holds the members of a node.
    ends = ends.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "key").mapInArrow(_ends, "k1 long, k2 long, ends_sha256 string")
    found = nodes.join(sums, "node").join(ends, ["k1", "k2"], "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return found.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, key: str = "conv_id", limit: int = ARCS) -> DataFrame:
    """The trie of a table of conversations as they are: key, turn, role, text. A null
    role or text is empty; rows of one turn are taken by role and text's MD5."""
    prepared(conversations.sparkSession)
    turns = placed(conversations, key)
    lengths = turns.groupBy("key").agg(F.count("*").alias("length"))
    return prefix_trie(join_same(turns, lengths, ["key"], "inner"), limit)
