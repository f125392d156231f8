"""The prefix trie against plain dictionaries, and its list ranking."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import trie
from paddock.llm.common import materialize, prepared

ROWS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def in_order(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, (role or "").encode(), hashlib.md5((text or "").encode()).hexdigest(), role or "", text or ""))
    return {conv: [r[4:] for r in sorted(own)] for conv, own in held.items()}


def plain_rebuilt(rows):
    own = in_order(rows)
    made = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        made[c] = (own.get(c - c % 5, [])[:h] if c is not None else []) + turns[h:]
    return made


def plain_trie(convs):
    """Every node by its whole sequence of turns."""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    least = {p: min((c for c in cs if c is not None), default=None) for p, cs in members.items()}
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1].encode()) if p else 0
    ends = defaultdict(list)
    for c, turns in convs.items():
        if c is not None:
            ends[tuple(turns)].append(c)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted(
        ((least[p], len(p), least[p[:-1]] if p else None, len(cs), children.get(p, 0), leaves[p], saved[p], digest(p)) for p, cs in members.items()), key=repr
    )


def collected(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    prepared(spark)
    df = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in ("key", "pos", "cost", "length", "piece", "k1", "node", "run")})
    return materialize(df.repartition(6), "rows")


@pytest.fixture(scope="module")
def mixed():
    """Shared beginnings, ties, repeated rows, nulls everywhere, gaps between groups."""
    rng = random.Random(8)
    texts = ["Hi.", "Yes.", "", None, "é ü", "Tell me more."]
    rows = []
    for conv in [*range(90), *range(201, 240, 3), None]:
        for turn in range(rng.randrange(1, 13)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(texts) if turn else texts[0]))
    return rows + rows[:25]


def test_rebuilt(spark, mixed):
    got = defaultdict(list)
    for r in trie.rebuilt(frame(spark, mixed)).collect():
        got[r["key"]].append((r["pos"], r["role"], r["digest"], r["cost"], r["length"]))
    want = {}
    for c, turns in plain_rebuilt(mixed).items():
        want[c] = [(i, r, hashlib.md5(t.encode()).hexdigest(), len(t.encode()), len(turns)) for i, (r, t) in enumerate(turns)] or [(None, None, None, None, 0)]
    assert {c: sorted(v, key=repr) for c, v in got.items()} == {c: sorted(v, key=repr) for c, v in want.items()}
    assert any(v[0][0] is None for v in got.values())


def test_query_rows(spark, mixed):
    assert collected(trie.prefix_trie(trie.rebuilt(frame(spark, mixed)))) == plain_trie(plain_rebuilt(mixed))


def test_distributed_ranks(spark, mixed, monkeypatch):
    """The same when runs are short and no task may hold more than a few arcs."""
    monkeypatch.setattr(trie, "RUN", 3)
    monkeypatch.setattr(trie, "POSITIONS", 16)
    assert collected(trie.prefix_trie(trie.rebuilt(frame(spark, mixed)), limit=700)) == plain_trie(plain_rebuilt(mixed))


def test_long_and_hot(spark, monkeypatch):
    """One conversation of many turns, a very long text, a root with many children and
    thousands of equal conversations."""
    monkeypatch.setattr(trie, "RUN", 64)
    rng = random.Random(4)
    rows = [(1, i, "user", f"t{rng.randrange(50)}") for i in range(300)] + [(2, 0, "user", "long " * 200_000)]
    rows += [(c, t, "user", f"same {t}") for c in range(10, 700) for t in range(2)] + [(c, 0, "user", f"own {c}") for c in range(1000, 1500)]
    got = collected(trie.conversation_trie(frame(spark, rows)))
    assert got == plain_trie(in_order(rows))


def test_ranks(spark):
    rng = random.Random(1)
    order = rng.sample(range(10**12), 400)
    rows = [(a, b, rng.randrange(1, 9)) for a, b in zip(order, [*order[1:], trie.END])]
    want, total = {}, 0
    for a, _, n in rows:
        want[a], total = total, total + n
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "arc long, after long, length long")
    for limit in (1000, 150):
        assert {r["arc"]: r["rank"] for r in trie.ranks(df, limit).collect()} == want


def test_contracted():
    arcs, after, length = np.array([7, 3, 9, 5]), np.array([3, 11, 5, 7]), np.array([1, 2, 3, 4])
    head, far, total, follows = trie.contracted(arcs, after, length)
    assert head.tolist() == [9, 9, 9, 9] and far.tolist() == [7, 8, 0, 3] and total.tolist() == [0, 0, 10, 0] and follows[2] == 11
    empty = np.array([], np.int64)
    assert all(x.size == 0 for x in trie.contracted(empty, empty, empty))


def test_empty_table(spark):
    none = frame(spark, [(1, 1, "user", "x")]).limit(0)
    assert trie.prefix_trie(trie.rebuilt(none)).count() == 0 == trie.conversation_trie(none).count()
