"""Structure repair against plain edit-distance search, and on odd tables."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from paddock.llm import repair
from paddock.llm.common import materialize

ROLES = ["system", "user", "assistant", "tool"]
ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
GOAL = re.compile("(s?(ua)+)?")


def brute(symbols, lead=True):
    """Least (cost, edits) over all edits, by going through the rows with the best
    of each state of the sequence made so far; no vectors, no tables."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = {"": (0, "")}

    def put_in(best):
        for _ in range(4):
            for state, (cost, edits) in list(best.items()):
                for role in "ua":
                    to = after[state].get(role)
                    way = (cost + 3, edits + "I")
                    if to and (to not in best or way < best[to]):
                        best[to] = way
        return best

    best = put_in(best)
    for kind, fault in symbols:
        new = {}
        for state, (cost, edits) in best.items():
            ways = [(state, cost + 4, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "cut")
                ways += [(after[state].get(kind), cost + extra, "K")]
                ways += [(after[state].get(role), cost + 3 + extra, "R") for role in "ua"]
            for to, c, e in ways:
                if to is not None and (to not in new or (c, edits + e) < new[to]):
                    new[to] = (c, edits + e)
        best = put_in(new)
    return min(best[s] for s in ("", "a") if s in best)


def exhaustive(symbols):
    """All sequences of at most two inserts between rows: for very short ones."""
    best = None
    choices = [["D", "K", "Ru", "Ra"] if f not in ("blank", "duplicate") else ["D"] for _, f in symbols]
    fills = ["", "u", "a", "ua", "au"]
    for edits in itertools.product(*choices):
        for puts in itertools.product(fills, repeat=len(symbols) + 1):
            made, audit, cost = puts[0], "I" * len(puts[0]), 3 * len(puts[0])
            for (kind, fault), edit, put in zip(symbols, edits, puts[1:]):
                audit += edit[0] + "I" * len(put)
                cost += 3 * len(put) + (4 if edit == "D" else 3 * (edit[0] == "R") + 3 * (fault == "cut"))
                made += ("" if edit == "D" else kind if edit == "K" else edit[1]) + put
            if GOAL.fullmatch(made):
                best = min(best, (cost, audit)) if best else (cost, audit)
    return best


FAULT = {"fine": repair.FINE, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "cut": repair.CUT}


def coded(symbols):
    return bytes(4 * "sua.".index(k) + FAULT[f] for k, f in symbols)


def test_tables():
    vectors, to, cost = repair.tables()
    assert to.shape == cost.shape == (len(vectors), repair.SYMBOLS**repair.BLOCK) and to.max() < len(vectors) < 1000


def test_cheapest_edits():
    assert repair.cheapest(b"") == (0, "")
    rng = random.Random(5)
    for n in range(3):
        for symbols in itertools.product(itertools.product("sua.", FAULT), repeat=n):
            assert brute(symbols) == exhaustive(symbols) == repair.cheapest(coded(symbols))
    for _ in range(20):
        symbols = [(rng.choice("sua."), rng.choice(list(FAULT))) for _ in range(3)]
        assert brute(symbols) == exhaustive(symbols)
    for _ in range(800):
        symbols = [(rng.choice("suauaua."), rng.choice(["fine"] * 3 + list(FAULT))) for _ in range(rng.randrange(60))]
        assert repair.cheapest(coded(symbols)) == brute(symbols)


def plainly(rows):
    """All columns of the query, row by row."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        own = held[conv]
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    out = {}
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, symbols, faults = set(), [], Counter()
        for _, role, text in own:
            bare = text.strip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else "fine"
            seen.add((role, text))
            faults[fault] += 1
            symbols.append((role[:1] if role[:1] in tuple("sua") else ".", fault))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for (_, a, _), (_, b, _) in zip(own, own[1:]))
        cost, audit = brute(symbols)
        made, left = [], list(own)
        total = len(audit) - audit.count("D")
        for edit in audit:
            expected = ("user", "assistant")[(len(made) - total % 2) % 2]
            if edit == "I":
                made.append((expected, ""))
                continue
            _, role, text = left.pop(0)
            if edit != "D":
                made.append((role if edit == "K" else expected, text))
        assert not left and GOAL.fullmatch("".join(r[:1] for r, _ in made))
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["cut"], illegal, cost, audit, made)
    return out


def both(spark, rows):
    df = materialize(spark.createDataFrame(rows, ROWS).repartition(5), "rows")
    harmed = repair.damaged(df)
    audits = materialize(repair.audited(harmed, df), "audits")
    got = {r[0]: tuple(r)[1:] for r in repair.digested(harmed, audits).collect()}
    want = {
        conv: (*values, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()) for conv, (*values, made) in plainly(rows).items()
    }
    return got, want


def test_query_rows(spark, sf):
    rng = random.Random(2)
    texts = ["Yes.", "No!", "Why? ", "open end", "", " \t", None, "x. \n", "a. ", "é!"]
    rows = []
    for conv in range(120):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "User", "sys", "a"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None]), role, rng.choice(texts)))
    rows += [(None, t, r, "Yes.") for t, r in enumerate(["user", "assistant"])] + [(7_000_000_000_000_000_001, 2, "user", "long id.")]
    rows += rows[:40]  # repeated rows
    got, want = both(spark, rows)
    assert got == want and None in got


def test_one_long_conversation(spark):
    """A conversation that many tasks share, with a very long text and a hot turn."""
    rng = random.Random(3)
    rows = [(1, i // 2, rng.choice(["user", "assistant"]), f"Turn {rng.randrange(900)}.") for i in range(6000)]
    rows += [(1, 17, "user", "Same.")] * 500 + [(1, 18, "assistant", "long text " * 100_000), (2, 0, "user", "Hi.")]
    got, want = both(spark, rows)
    assert got == want


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be short."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Bye."), (2, 0, "user", ""), (3, 0, "tool", "Result."), (3, 1, "tool", "More.")]
    df = spark.createDataFrame(rows, ROWS).withColumns({"key": F.lit(1), "audit": F.lit("x"), "copies": F.lit(9)})
    got = sorted(tuple(r) for r in repair.repaired(df).collect())
    assert got == [
        (1, 0, "system", "Be short."), (1, 1, "user", ""), (1, 2, "assistant", "Hello."), (1, 3, "user", "Bye."), (1, 4, "assistant", ""),
        (3, 0, "user", "Result."), (3, 1, "assistant", "More."),
    ]


def test_empty_table(spark):
    df = spark.createDataFrame([], ROWS)
    assert repair.digested(repair.damaged(df), repair.audited(repair.damaged(df), df)).count() == 0 == repair.repaired(df).count()


@pytest.mark.parametrize("rows", [[(1, t, "user", "x") for t in range(200)]])
def test_dropped_whole(spark, rows):
    """A conversation of which no row is left still has a row of zeros."""
    gone = next(r for r in rows if zlib.crc32(f"{r[0]}:{r[1]}".encode()) % 20 == 0)
    got, _ = both(spark, [gone])
    assert got == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
