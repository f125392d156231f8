"""MinHash near-duplicates against all pairs of sets of words."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from paddock.llm import minhash
from paddock.llm.common import materialize, prepared

ROWS = "doc_id long, text string"


def plain_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(tuple(w[i : i + 4]) for i in range(max(len(w) - 3, 1))) if w else frozenset()


def plainly(rows):
    """(doc_id, n_shingles, component_id) of every row, by comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and min(len(a), len(b)) * 100 >= 80 * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= 80 * (len(a) + len(b) - shared):
                    up[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return Counter((doc, len(s), least.get(top(i))) for i, ((doc, _), s) in enumerate(zip(rows, sets)))


def found(spark, rows):
    prepared(spark)
    names = ("id", "hash", "class", "n", "s1", "key", "center", "root", "u", "component_id")
    df = materialize(spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("clash") for c in names}).repartition(5), "rows")
    return Counter(tuple(r) for r in minhash.near_duplicates(df).collect())


def edited(rng, words, share):
    """Some words replaced by new ones."""
    return [f"x{rng.randrange(10**9)}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def documents():
    """Copies, chains of near copies on both sides of the threshold, a large group of
    texts that are nearly but not quite alike, a passage that many share, odd rows."""
    rng = random.Random(6)
    passage = [f"p{i}" for i in range(60)]
    rows, texts = [], []
    for g in range(25):
        text = [f"g{g}w{i}" for i in range(rng.randrange(30, 200))]
        for _ in range(rng.randrange(1, 7)):
            texts.append(" ".join(text))
            text = edited(rng, text, rng.choice([0.01, 0.02, 0.05, 0.08]))
    base = [f"b{i}" for i in range(150)]
    texts += [" ".join(edited(rng, base, 0.02 + 0.04 * rng.random())) for _ in range(250)]
    texts += [" ".join([f"d{d}w{i}" for i in range(rng.randrange(20, 80))] + passage) for d in range(120)]
    texts += ["one two three", "One TWO three", "one two", "three two one", "É a b c", "é a b c", None, "", " \t\n", "a b c d a b c d a b c d", "a b c d a b c d"]
    texts += ["long " + " ".join(f"l{i % 4999}x{i}" for i in range(30_000))] * 2 + [texts[0].upper()] * 30
    rows = list(zip(rng.sample(range(5000), len(texts)), texts))
    return rows + [(None, texts[0]), (None, "alone without an id"), (None, None)] + rows[:9] + [(rows[3][0], "another text of the same id")]


def test_documents(spark, documents):
    want = plainly(documents)
    assert found(spark, documents) == want
    components = Counter(c for (_, _, c), n in want.items() for _ in range(n))
    assert components.most_common(1)[0][1] > 30


def test_small_blocks(spark, documents, monkeypatch):
    """The same when the families are cut into many blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 3000)
    monkeypatch.setattr(minhash, "MEMBERS", 20)
    monkeypatch.setattr(minhash, "COLUMNS", 64)
    assert found(spark, documents) == plainly(documents)


def test_pair_at_the_threshold(spark):
    """Sets of 40 and 50 shingles, the smaller within the larger: just alike."""
    words = [f"w{i}" for i in range(53)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:43])), (3, " ".join(words[:42]))]
    assert found(spark, rows) == plainly(rows) == Counter({(1, 50, 1): 1, (2, 40, 1): 1, (3, 39, 1): 1})


def test_linked_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    by = minhash.multipliers()
    members = []
    for number in range(40):
        own = np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.integers(0, 1 << 62, 4).astype(np.uint64)]))
        members.append((number, number, own.size, minhash.signature(own, by).view(np.int64).tolist(), own))
    want = {(a[0], b[0]) for a in members for b in members if a[0] < b[0] and minhash.alike(a[4], b[4])}

    def joined(pairs):
        up = list(range(40))
        for a, b in pairs:
            x, y = up[a], up[b]
            up = [x if u == y else u for u in up]
        return {frozenset(i for i in range(40) if up[i] == u) for u in up}

    whole = list(minhash.linked_pairs(members, None))
    assert set(whole) <= want and joined(whole) == joined(want)
    halves = [*minhash.linked_pairs(members[:15], None), *minhash.linked_pairs(members[15:], None), *minhash.linked_pairs(members[:15], members[15:])]
    assert joined(halves) == joined(want)


def test_meeting_probability():
    """Pairs of likeness 0.8 meet in a table nearly always, unlike ones seldom."""
    rng = np.random.default_rng(9)
    by = minhash.multipliers()

    def meet(shared, own):
        a, b, c = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (shared, own, own))
        x, y = (minhash.signature(np.concatenate([a, z]), by) for z in (b, c))
        return all((x[t] == y[t]).any() for t in (slice(0, minhash.TUPLES), slice(minhash.TUPLES, None)))

    assert sum(meet(80, 10) for _ in range(2000)) >= 1997
    assert sum(meet(10, 90) for _ in range(2000)) < 60


def test_long_text_in_steps():
    text = " ".join(f"w{i}" for i in range(20_000))
    hashes = minhash.shingles(text, minhash.WordHashes())
    by = minhash.multipliers()
    least = (hashes[:, None] * by[:1]).min()
    assert hashes.size == 19_997 and (hashes * by[0]).min() == least


def test_empty_table(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], ROWS)).count() == 0
    assert found(spark, [(1, None), (2, "")]) == Counter({(1, 0, 1): 1, (2, 0, 2): 1})
