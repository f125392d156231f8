"""MinHash near-duplicates by tensored banding.

Two small collections of tuples of minhashes are computed for each document; the key of
table (i, j) joins the i-th tuple of the one with the j-th of the other. So TUPLES squared
tables need only 2 * TUPLES tuples of minhashes, about the square root of what independent
tables would. Two texts of likeness s meet in some table with the probability
(1 - (1 - s^WIDTH)^TUPLES)^2: 0.99993 at 0.8 and 0.999995 at 0.85. Every link is confirmed
on the full sets.

A table's bucket is first compared with one of its members, its center, and never all
with all. What that links is one component. Then members of different components that
have a center in common are compared, in blocks and within tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import materialize, prepared
from paddock.llm.simhash import star

SHINGLE = 4
TUPLES, WIDTH = 10, 2
# Likeness in hundredths from which two sets are linked.
LEAST = 80
STEP = 4096
# Shingles and members of a block, and shingles compared at once.
BLOCK, MEMBERS = 200_000, 500
COLUMNS = 4096
SEED = 12


class WordHashes(dict):
    """64-bit hash of a word, kept while a batch is worked on."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word, SEED)
        return value


def shingles(text: str | None, known: dict, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word sequences of a text: of ``width`` words, or
    the whole of a shorter one; empty for a text without words."""
    # bytes.lower and bytes.split know ASCII letters and ASCII white space only.
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for at in range(width):
        mixed = (mixed ^ hashes[at : at + mixed.size]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * np.uint64(0xBF58476D1CE4E5B9) ^ mixed >> np.uint64(32))


def multipliers() -> np.ndarray:
    """Odd numbers of 64 bits, one for each minhash."""
    return np.random.default_rng(SEED).integers(0, 1 << 63, 2 * TUPLES * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The tuples of both collections, each as one number."""
    least = np.full(by.size, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, hashes.size, STEP):
        np.minimum(least, (hashes[at : at + STEP, None] * by).min(0), out=least)
    tuples = np.zeros(2 * TUPLES, np.uint64)
    for place in range(WIDTH):
        tuples = (tuples ^ least[place::WIDTH]) * np.uint64(0x9E3779B97F4A7C15)
        tuples ^= tuples >> np.uint64(31)
    return tuples


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by = multipliers()
    for batch in batches:
        known, out = WordHashes(), []
        for text in batch.column("text"):
            found = shingles(text.as_py(), known)
            digest = np.frombuffer(hashlib.md5(found.tobytes()).digest(), np.int64).tolist() if found.size else [None, None]
            out.append((found.size, *digest, signature(found, by).view(np.int64) if found.size else None))
        names, types = ("n", "s1", "s2", "tuples"), (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        made = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("hash"), *made], names=["id", "hash", *names])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        known = WordHashes()
        made = [shingles(text.as_py(), known).tobytes() for text in batch.column("text")]
        yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(made, pa.binary())], names=["class", "set"])


def linked_pairs(left: list, right: list | None) -> Iterator[tuple]:
    """Links between members (class, root, n, tuples, set) of two blocks, or within one
    (``right`` is None), that join different roots; each pair must share a tuple of
    both collections. What is joined here already is not told twice.

    The sets are compared all at once, as products of 0/1 matrices over the shingles
    that occur on both sides, some columns at a time.
    """
    sides = [left, left if right is None else right]
    sizes = [np.array([m[2] for m in side], np.int64) for side in sides]
    roots = [np.array([m[1] for m in side], np.int64) for side in sides]
    tuples = [np.array([m[3] for m in side], np.int64) for side in sides]
    may = roots[0][:, None] != roots[1]
    if right is None:
        may &= np.arange(len(left))[:, None] < np.arange(len(left))
    may &= 100 * np.minimum(sizes[0][:, None], sizes[1]) >= LEAST * np.maximum(sizes[0][:, None], sizes[1])
    for collection in range(2):
        share = np.zeros_like(may)
        for t in range(collection * TUPLES, (collection + 1) * TUPLES):
            share |= tuples[0][:, None, t] == tuples[1][:, t]
        may &= share
    if not may.any():
        return
    flat = [np.concatenate([m[4] for m in side]) for side in sides]
    rows = [np.repeat(np.arange(len(side)), size) for side, size in zip(sides, sizes)]
    common = np.intersect1d(*[np.unique(f) for f in flat], assume_unique=True)
    shared = np.zeros(may.shape, np.int64)
    for at in range(0, common.size, COLUMNS):
        columns = common[at : at + COLUMNS]
        held = []
        for f, r, side in zip(flat, rows, sides):
            place = np.searchsorted(columns, f).clip(max=columns.size - 1)
            here = columns[place] == f
            matrix = np.zeros((len(side), columns.size), np.float32)
            matrix[r[here], place[here]] = 1
            held.append(matrix)
        shared += (held[0] @ held[1].T).astype(np.int64)
    union = sizes[0][:, None] + sizes[1] - shared
    up = {}

    def top(root):
        while root in up:
            root = up[root]
        return root

    for i, j in zip(*np.nonzero(may & (100 * shared >= LEAST * union))):
        a, b = top(left[i][1]), top(sides[1][j][1])
        if a != b:
            up[max(a, b)] = min(a, b)
            yield left[i][0], sides[1][j][0]


TASK = ["center", "a_root", "a_part", "b_root", "b_part"]


def _between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted members of pairs of blocks to the links between them."""

    def links(task, sides):
        return list(linked_pairs(sides[0], None if task[1:3] == task[3:] else sides[1])) if task else []

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(2)], names=["u", "v"])

    now, sides = None, None
    for batch in batches:
        found = []
        lists = [batch.column(c).to_pylist() for c in (*TASK, "right", "class", "root", "n", "tuples")]
        for *task, right, number, root, n, tuples, values in zip(*lists, batch.column("set")):
            if task != now:
                found += links(now, sides)
                now, sides = task, ([], [])
            sides[right].append((number, root, n, tuples, np.frombuffer(values.as_buffer(), np.uint64)))
        if found:
            yield batch_of(found)
    if found := links(now, sides):
        yield batch_of(found)


def alike(a: np.ndarray, b: np.ndarray, least: int = LEAST) -> bool:
    """Whether two sorted distinct arrays share ``least`` hundredths of their union."""
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= least * (both.size - shared)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = ([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(c)] for c in ("a", "b"))
        keep = pa.array([alike(x, y) for x, y in zip(a, b)], pa.bool_())
        yield batch.select(["u", "v"]).filter(keep)


def fits(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be alike at all."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * LEAST


def sets_of(wanted: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, set) of the wanted classes, from their texts: eight bytes a shingle."""
    rows = classes.select("class", "id", "hash").join(wanted.distinct(), "class", "left_semi").withColumnsRenamed({"id": "the_id", "hash": "the_hash"})
    same = F.col("id").eqNullSafe(F.col("the_id")) & F.col("hash").eqNullSafe(F.col("the_hash"))
    texts = docs.join(rows, same).groupBy("class").agg(F.first("text").alias("text"))
    return materialize(texts.mapInArrow(_sets, "class long, set binary"), "sets")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (u, v) of classes whose full sets are alike."""
    sets = sets_of(pairs.select(F.col("u").alias("class")).union(pairs.select("v")), docs, classes)
    a = sets.select(F.col("class").alias("u"), F.col("set").alias("a"))
    b = sets.select(F.col("class").alias("v"), F.col("set").alias("b"))
    return materialize(pairs.join(a, "u").join(b, "v").mapInArrow(_confirmed, "u long, v long"), "confirmed")


def compared(families: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (u, v) between members (center, class, root) of a family that have
    different roots.

    A family is cut into blocks of bounded size and a task compares two of them, so no
    pair is a row and no task holds a family. A root that fills blocks of its own is
    not compared with itself."""
    members = materialize(families.join(classes.select("class", "n", "tuples"), "class"), "members")
    weight = F.greatest(F.col("n"), F.lit(BLOCK // MEMBERS))
    roots = members.groupBy("center", "root").agg(F.sum(weight).alias("weight"))
    roots = materialize(roots.withColumns({"big": F.col("weight") > BLOCK, "parts": F.ceil(F.col("weight") / BLOCK)}), "roots")
    small = roots.where("NOT big").groupBy("center").agg(F.ceil(F.sum("weight") / BLOCK).alias("small_parts"))
    cut = members.join(roots.drop("weight"), ["center", "root"]).join(small, "center", "left")
    part = F.when(F.col("big"), F.pmod(F.xxhash64("class"), "parts")).otherwise(F.pmod(F.xxhash64("root"), "small_parts"))
    cut = cut.withColumns({"in_root": F.when(F.col("big"), F.col("root")).otherwise(-1), "in_part": part})
    cut = materialize(cut.select("center", "class", "root", "n", "tuples", "in_root", "in_part"), "blocks")
    blocks = cut.select("center", "in_root", "in_part").distinct()
    a, b = (blocks.withColumnsRenamed({"in_root": f"{x}_root", "in_part": f"{x}_part"}) for x in "ab")
    ordered = F.struct("a_root", "a_part") <= F.struct("b_root", "b_part")
    tasks = materialize(a.join(b, "center").where(ordered & ((F.col("a_root") != F.col("b_root")) | (F.col("a_root") == -1))), "tasks")
    sides = []
    for right, x in enumerate("ab"):
        mine = cut.withColumnsRenamed({"in_root": f"{x}_root", "in_part": f"{x}_part"}).join(tasks, ["center", f"{x}_root", f"{x}_part"])
        if right:
            mine = mine.where((F.col("a_root") != F.col("b_root")) | (F.col("a_part") != F.col("b_part")))
        sides.append(mine.select(*TASK, F.lit(right).alias("right"), "class", "root", "n", "tuples"))
    sets = sets_of(members.select("class"), docs, classes)
    dealt = sides[0].unionByName(sides[1]).join(sets, "class").repartition(*TASK).sortWithinPartitions(*TASK)
    return materialize(dealt.mapInArrow(_between, "u long, v long"), "between")


def rooted(near: DataFrame) -> DataFrame:
    """(class, root) of all classes that ``star`` has linked."""
    return near.unionByName(near.select(F.col("v").alias("u"), "v")).distinct().withColumnsRenamed({"u": "class", "v": "root"})


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, class, n): a row for each class and table."""
    first, second = F.slice("tuples", 1, TUPLES), F.slice("tuples", TUPLES + 1, TUPLES)
    keys = F.flatten(F.transform(first, lambda x, i: F.transform(second, lambda y, j: F.xxhash64(i, j, x, y))))
    return classes.select("class", "n", F.explode(keys).alias("key"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, n_shingles and component_id, the smallest id that can
    be reached by links of likeness LEAST / 100 or more between sets of shingles.

    Null and empty texts, and those of white space, have no shingle and are linked with
    nothing, not even each other; their component is their own id. Texts with equal
    sets are one class and count once; repeated rows and ids are kept. A null id
    is never the smallest. An empty table gives an empty result.
    """
    prepared(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), "text", F.xxhash64("text").alias("hash"))
    kind = docs.schema["id"].dataType.simpleString()
    signed = materialize(docs.mapInArrow(_signed, f"id {kind}, hash long, n long, s1 long, s2 long, tuples array<long>"), "signed")
    first = F.min(F.struct(F.col("id").isNull(), "id", "hash")).alias("f")
    classes = signed.where("n > 0").groupBy("s1", "s2").agg(first, F.first("n").alias("n"), F.first("tuples").alias("tuples"))
    classes = materialize(classes.select("s1", "s2", "f.id", "f.hash", "n", "tuples", F.monotonically_increasing_id().alias("class")), "classes")
    keys = table_keys(classes)
    # The bucket of one class has nothing to compare, and most are such.
    buckets = materialize(keys.groupBy("key").agg(F.min("class").alias("center"), F.count("*").alias("m")).where("m > 1").drop("m"), "buckets")
    sizes = classes.select(F.col("class").alias("center"), F.col("n").alias("center_n"))
    met = materialize(keys.join(buckets, "key"), "met")
    stars = met.where("class <> center").select(F.col("class").alias("u"), F.col("center").alias("v"), "n").distinct()
    stars = stars.join(sizes.withColumnRenamed("center", "v"), "v").where(fits(F.col("n"), F.col("center_n"))).select("u", "v")
    stars = materialize(stars, "stars")
    links = confirmed(stars, docs, classes)
    # Whoever meets in a bucket has its center in common. Families whose members are
    # still in different components are compared in blocks.
    family = met.where("class <> center").select("center", "class").distinct().join(rooted(star(links)), "class", "left")
    family = materialize(family.withColumn("root", F.coalesce("root", "class")), "families")
    apart = family.groupBy("center").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1")
    more = compared(family.join(apart.select("center"), "center", "left_semi"), docs, classes)
    return _components(signed, classes, star(links.unionByName(more)))


def _components(signed: DataFrame, classes: DataFrame, near: DataFrame) -> DataFrame:
    rows = classes.select("class", "s1", "s2", "id").join(rooted(near), "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = rows.groupBy("root").agg(F.min("id").alias("component_id"))
    found = materialize(rows.join(least, "root").select("s1", "s2", "component_id"), "components")
    joined = signed.join(found, ["s1", "s2"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return joined.select("id", F.col("n").alias("n_shingles"), component.alias("component_id"))
