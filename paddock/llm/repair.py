"""Repair of conversation structure: the cheapest edits that give each conversation
turns in the order ``(s?(ua)+)?`` of role initials.

Costs are those of an edit distance to a grammar of four states, so what is known
at a place of a conversation is a vector of four costs: of the cheapest way from
each state to the end. Up to a common offset only a few vectors occur (``VECTORS``).
By the method of the Four Russians the transition of every vector under every block
of BLOCK symbols is computed once; conversations are read from their end, block by
block, by lookups in that table. Blocks are then expanded in turn, each backward
from the vector at its end, and the first cheapest edit in ASCII order is taken.

Fixed values (costs, states, symbols) are below. A row is one symbol: what its role
begins with (s, u, a, other) and its first fault.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paddock.llm.common import Names, materialize, prepared

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INITIALS = "sua"
FINE, BLANK, DUPLICATE, CUT = range(4)

# States: nothing yet, after s, after u, after a. The first and the last may end.
KEEP_TO = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEW_TO = (2, 2, 3, 2)
END = (0, 2 * INSERT, INSERT, 0)

# Symbols of the tables: 0 must go; then, for each kind of role, kept as it is or
# truncated; the last fills up the last block.
PAD = 1 + 2 * (len(INITIALS) + 1)
SYMBOLS = PAD + 1
BLOCK = 4
SYMBOL_OF = np.array([0 if fault in (BLANK, DUPLICATE) else 1 + 2 * kind + (fault == CUT) for kind in range(4) for fault in range(4)])
LEGAL = {"su", "ua", "au"}

BLANKS = r"\x20\x09-\x0D"


def before(symbol: int, after: tuple) -> tuple:
    """Costs to the end from in front of a symbol, given those behind it."""
    if symbol == PAD:
        return after
    costs = [DELETE + c for c in after]
    if symbol:
        kind, extra = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
        for state in range(4):
            kept = KEEP_TO[state].get(INITIALS[kind]) if kind < len(INITIALS) else None
            ways = [costs[state], REROLE + extra + after[NEW_TO[state]]]
            costs[state] = min(ways if kept is None else [*ways, extra + after[kept]])
    for _ in range(3):  # two turns may be put in on the way
        costs = [min(c, INSERT + costs[NEW_TO[state]]) for state, c in enumerate(costs)]
    return tuple(costs)


def normalised(costs: tuple) -> tuple[tuple, int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


@lru_cache(1)
def tables() -> tuple[list, np.ndarray, np.ndarray]:
    """All vectors, and for each vector and block the vector before it and the cost."""
    vectors, number = [normalised(END)[0]], {normalised(END)[0]: 0}
    to, cost = [], []
    for vector in vectors:  # grows until no new one is found
        reached = [normalised(before(s, vector)) for s in range(SYMBOLS)]
        for v, _ in reached:
            if v not in number:
                number[v] = len(vectors)
                vectors.append(v)
        to.append([number[v] for v, _ in reached])
        cost.append([c for _, c in reached])
    to, cost = np.array(to), np.array(cost)
    blocks = np.arange(SYMBOLS**BLOCK)
    at = np.repeat(np.arange(len(vectors))[:, None], blocks.size, axis=1)
    total = np.zeros_like(at)
    for place in range(BLOCK):  # the last digit is the last symbol
        symbol = blocks // SYMBOLS**place % SYMBOLS
        total += cost[at, symbol]
        at = to[at, symbol]
    return vectors, at, total


@lru_cache(1 << 18)
def expanded(end: int, block: int, state: int) -> tuple[str, int]:
    """Edits of a block, from a state, before the vector ``end``; the state after it."""
    symbols = [block // SYMBOLS**place % SYMBOLS for place in range(BLOCK - 1, -1, -1)]
    costs = [tables()[0][end]]
    for symbol in reversed(symbols):
        costs.append(before(symbol, costs[-1]))
    costs.reverse()
    edits = []
    for place, symbol in enumerate(symbols):
        if symbol == PAD:
            continue
        here, after = costs[place], costs[place + 1]
        while True:
            if here[state] == DELETE + after[state]:
                edits.append("D")
            elif here[state] == INSERT + here[NEW_TO[state]]:
                edits.append("I")
                state = NEW_TO[state]
                continue
            else:
                kind, extra = (symbol - 1) // 2, TRUNCATED * ((symbol - 1) % 2)
                kept = KEEP_TO[state].get(INITIALS[kind]) if kind < len(INITIALS) else None
                if kept is not None and here[state] == extra + after[kept]:
                    edits.append("K")
                    state = kept
                else:
                    edits.append("R")
                    state = NEW_TO[state]
            break
    return "".join(edits), state


def cheapest(rows: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least of the cheapest edits; a byte for each row is
    4 * kind + fault."""
    vectors, to, cost = tables()
    symbols = np.full(-(-len(rows) // BLOCK) * BLOCK, PAD)
    symbols[: len(rows)] = SYMBOL_OF[np.frombuffer(rows, np.uint8)]
    blocks = symbols.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
    ends, at, total = [], 0, 0
    for block in blocks[::-1]:
        ends.append(at)
        total += cost[at, block]
        at = to[at, block]
    edits, state = [], 0
    for block, end in zip(blocks.tolist(), reversed(ends)):
        done, state = expanded(int(end), block, state)
        edits.append(done)
    edits.append("I" * (END[state] // INSERT))
    return int(total) + vectors[at][0], "".join(edits)


def damaged(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Rows (key, turn, role, text, copies) with faults put in by the CRC-32 of
    ``key:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes out its
    ``[.!?]``, 3 repeats it, 4 gives it to the user. Nulls count as one space, in
    that text as well as in role and text."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(key).cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    k = F.crc32(name.cast("binary")) % 20
    rows = conversations.select(
        F.col(key).alias("key"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"), k.alias("k"),
    ).where("k <> 0")
    text = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("k") == 4, "user").otherwise(F.col("role"))
    return rows.select(F.col("key").alias(key), "turn", role.alias("role"), text.alias("text"), F.when(F.col("k") == 3, 2).otherwise(1).alias("copies"))


def _coded(rows: DataFrame) -> DataFrame:
    """Distinct rows (key, turn, role, digest) with ``n``, how many they are, and the
    codes of the first and of the others. Repeated rows are counted, and the first
    turn of each role and text is found by a grouping, so no key is held anywhere."""
    text = F.col("text")
    narrow = rows.select(
        "key", "turn", "role", "copies", F.md5(text.cast("binary")).alias("digest"), (~text.rlike(f"[^{BLANKS}]")).alias("blank"),
        (~text.rlike(rf"[.!?][{BLANKS}]*\z")).alias("cut"),
    )
    grouped = narrow.groupBy("key", "turn", "role", "digest", "blank", "cut").agg(F.sum("copies").alias("n"))
    grouped = materialize(grouped, "turns")
    firsts = grouped.groupBy(F.col("key").alias("k"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(
        F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("first")
    )
    same = F.col("key").eqNullSafe(F.col("k")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    repeated = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    kind = F.lit(len(INITIALS))
    for i, initial in reversed(list(enumerate(INITIALS))):
        kind = F.when(F.col("role").startswith(initial), i).otherwise(kind)
    later = F.when(F.col("blank"), BLANK).otherwise(DUPLICATE)
    fault = F.when(F.col("blank") | repeated, later).when(F.col("cut"), CUT).otherwise(FINE)
    return grouped.join(firsts, same).select("key", "turn", "role", "digest", "n", (kind * 4 + fault).alias("code"), (kind * 4 + later).alias("rest"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a partition to one row for each key in it."""
    held = None

    def row(piece):
        columns = zip(*[piece])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    for batch in batches:
        schema = pa.schema(
            [batch.schema.field("key"), ("piece", pa.int32()), ("rows", pa.binary()), ("first", pa.int64()), ("last", pa.int64()), ("turns", pa.int64())]
        )
        for key, turn, n, code, rest, piece in zip(*[batch.column(c).to_pylist() for c in ("key", "turn", "n", "code", "rest", "piece")]):
            if held is None or held[0] != key:
                if held:
                    yield row([held[0], held[1], bytes(held[2]), *held[3:]])
                held = [key, piece, bytearray(), turn, turn, 0]
            held[2] += bytes([code]) + bytes([rest]) * (n - 1)
            if turn is not None and (turn != held[4] or not held[5]):
                held[3] = turn if held[3] is None else held[3]
                held[4] = turn
                held[5] += 1
    if held:
        yield row([held[0], held[1], bytes(held[2]), *held[3:]])


AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of each conversation, in order, to its counts and cheapest edits."""
    kinds = INITIALS + "."
    for batch in batches:
        out = []
        for pieces in batch.column("pieces").to_pylist():
            rows = b"".join(p["rows"] for p in pieces)
            turns = [p for p in pieces if p["turns"]]
            distinct = sum(p["turns"] for p in turns) - sum(a["last"] == b["first"] for a, b in zip(turns, turns[1:]))
            gaps = turns[-1]["last"] - turns[0]["first"] + 1 - distinct if turns else 0
            codes = np.frombuffer(rows, np.uint8)
            faults = np.bincount(codes % 4, minlength=4).tolist()
            pairs = np.bincount(codes[:-1] // 4 * 4 + codes[1:] // 4, minlength=16) if len(rows) > 1 else np.zeros(16, int)
            illegal = sum(int(n) for i, n in enumerate(pairs) if kinds[i // 4] + kinds[i % 4] not in LEGAL)
            out.append((gaps, faults[BLANK], faults[DUPLICATE], faults[CUT], illegal, *cheapest(rows)))
        names = [f.split()[0] for f in AUDIT.split(", ")]
        types = [pa.int64()] * 6 + [pa.string()]
        columns = [pa.array([o[i] for o in out], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), *columns], names=["key", *names])


def audited(rows: DataFrame, ids: DataFrame, key: str = "conv_id") -> DataFrame:
    """What is wrong with each conversation of ``ids`` and the cheapest edits to it.

    ``rows`` holds key, turn, role, text and ``copies`` (how often a row is there).
    Rows of a conversation are taken by turn, nulls first; rows of one turn by role
    and by the MD5 of their text, equal ones together. A null role or text is one
    space, so its turn is blank. A null key is one conversation. Conversations
    without rows have zeros and no edits; no conversations give no rows.

    Rows travel as digests and are dealt out by (key, turn), so a long conversation
    is coded by many tasks; one task then holds a byte of each of its rows, as the
    column ``audit`` does.
    """
    prepared(rows.sparkSession)
    space = F.lit(" ")
    rows = rows.select(F.col(key).alias("key"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), "copies")
    order = ["key", "turn", "role", "digest"]
    dealt = _coded(rows).repartitionByRange(*order).withColumn("piece", F.spark_partition_id()).sortWithinPartitions(*order)
    kind = rows.schema["key"].dataType.simpleString()
    pieces = dealt.mapInArrow(_pieces, f"key {kind}, piece int, rows binary, first long, last long, turns long")
    none = ids.select(F.col(key).alias("key"), F.lit(-1).alias("piece"), F.lit(b"").alias("rows"), *[F.lit(None).cast("long").alias(c) for c in ("first", "last")], F.lit(0).cast("long").alias("turns"))
    listed = pieces.unionByName(none.distinct()).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("piece", "rows", "first", "last", "turns"))).alias("pieces"))
    return listed.mapInArrow(_audits, f"key {kind}, {AUDIT}").withColumnRenamed("key", key)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """From the audit of each conversation and then its rows: (audit row, None), and
    (audit row, (role, text)) for each repaired turn."""
    head = None

    def fill(upto_row: bool):
        nonlocal at, made
        while at < len(audit) and audit[at] == "I":
            at, made = at + 1, made + 1
            yield head, (ROLES[(made - 1 - odd) % 2], "")
        if upto_row:
            at += 1

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        names = batch.schema.names
        role_at, text_at, copies_at, audit_at = (names.index(c) for c in ("role", "text", "copies", "audit"))
        for row in zip(*columns):
            if row[audit_at] is not None:
                if head:
                    yield from fill(False)
                head, audit, at, made = dict(zip(names, row)), row[audit_at], 0, 0
                odd = (len(audit) - audit.count("D")) % 2
                yield head, None
                continue
            for _ in range(row[copies_at]):
                yield from fill(True)
                if audit[at - 1] != "D":
                    made += 1
                    kept = audit[at - 1] == "K"
                    yield head, (row[role_at] if kept else ROLES[(made - 1 - odd) % 2], row[text_at])
    if head:
        yield from fill(False)


ROLES = ("user", "assistant")


def _digests(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    done, now, state, count, types = [], None, None, 0, None

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[*names, "repaired_sha256"])

    def seen(batches):
        nonlocal types
        for batch in batches:
            types = [batch.schema.field(n).type for n in names] + [pa.string()]
            yield batch

    for head, turn in _edited(seen(batches)):
        if turn is None:
            if now is not None:
                done.append((*[now[n] for n in names], state.hexdigest()))
            now, state, count = head, hashlib.sha256(), 0
            if len(done) == 512:
                yield batch_of(done)
                done = []
        else:
            state.update((("\n" if count else "") + turn[0] + ":" + turn[1]).encode())
            count += 1
    if now is not None:
        yield batch_of([*done, (*[now[n] for n in names], state.hexdigest())])


def _turns(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    done, place, kind = [], 0, None

    def seen(batches):
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(key).type
            yield batch

    def batch_of(rows):
        types = [kind, pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[key, "turn", "role", "text"])

    for head, turn in _edited(seen(batches)):
        if turn is None:
            place = 0
            continue
        done.append((head[key], place, *turn))
        place += 1
        if len(done) == 512:
            yield batch_of(done)
            done = []
    if done:
        yield batch_of(done)


def _together(rows: DataFrame, audits: DataFrame, key: str) -> DataFrame:
    """Each conversation's audit and then its rows in order, in one partition, sorted
    by Spark: texts pass by one at a time however many there are."""
    digest = F.md5(F.coalesce("text", F.lit(" ")).cast("binary")).alias("digest")
    texts = rows.select(key, F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "copies", digest)
    both = audits.unionByName(texts, allowMissingColumns=True)
    return both.repartition(key).sortWithinPartitions(key, F.col("audit").isNull(), "turn", "role", "digest")


def digested(rows: DataFrame, audits: DataFrame, key: str = "conv_id") -> DataFrame:
    """The audits with ``repaired_sha256`` of the repaired ``role:text`` lines."""
    names = [key, *[f.split()[0] for f in AUDIT.split(", ")]]
    schema = StructType([audits.schema[c] for c in names]).add("repaired_sha256", "string")
    return _together(rows, audits.select(*names), key).mapInArrow(lambda batches: _digests(batches, names), schema)


def repaired(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Conversations after their cheapest repair: key, turn (from 0), role and text.
    Nulls, ties and repeated rows as in ``audited``; other columns are not kept."""
    rows = conversations.select(key, "turn", "role", "text", F.lit(1).alias("copies"))
    audits = audited(rows, conversations.select(key), key).select(key, "audit")
    schema = StructType([audits.schema[key]]).add("turn", "long").add("role", "string").add("text", "string")
    return _together(rows, audits, key).mapInArrow(lambda batches: _turns(batches, key), schema)
