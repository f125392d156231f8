"""FarmHash Fingerprint64 of texts, the hash behind ``FARM_FINGERPRINT``.

Spark's arithmetic reports an overflow where the hash wants to wrap around. A SQL
function keeps the settings it was created with, so the pieces below are functions
created without that check. They are inlined: each argument becomes a column that is
computed once, and the whole runs in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The constants of FarmHash, as signed numbers of 64 bits.
K0 = -4348849565147123417
K1 = -5435081209227447693
K2 = -7286425919675154353
SEED = 81

NAME = "farm_fingerprint"
STATE = "STRUCT<x: BIGINT, y: BIGINT, z: BIGINT, v1: BIGINT, v2: BIGINT, w1: BIGINT, w2: BIGINT>"


def rotated(value: str, bits: int) -> str:
    return f"(shiftrightunsigned({value}, {bits}) | shiftleft({value}, {64 - bits}))"


def let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def bytes_at(place: str, width: int = 8) -> str:
    """Bytes from a place on as a little-endian number. ``r`` holds them in reverse,
    so this is a plain hexadecimal number there."""
    return f"CAST(conv(hex(substring(r, n - ({place}) - {width - 1}, {width})), 16, -10) AS BIGINT)"


def weak(words: list[str], a: str, b: str, name: str) -> str:
    """Two numbers from four words and two seeds, as an array."""
    w, x, y, z = words
    p, q = f"{name}p", f"{name}q"
    second = f"{rotated(f'({b} + {p} + {z})', 21)} + {rotated(q, 44)} + {p}"
    return let(p, f"{a} + {w}", let(q, f"{p} + {x} + {y}", f"array({q} + {z}, {second})"))


def block(state: str, start: str, factor: str, last: bool) -> str:
    """The state after 64 bytes from ``start``; the last block counts some parts ninefold."""
    words = f"transform(sequence(0, 7), k -> {bytes_at(f'{start} + 8 * k')})"
    word = [f"t[{i}]" for i in range(8)]
    nine = " * 9" if last else ""
    x = f"({rotated(f'({state}.x + {state}.y + {state}.v1 + {word[1]})', 37)} * {factor}) ^ ({state}.w2{nine})"
    y = f"{rotated(f'({state}.y + {state}.v2 + {word[6]})', 42)} * {factor} + {state}.v1{nine} + {word[5]}"
    z = f"{rotated(f'({state}.z + {state}.w1)', 33)} * {factor}"
    v = weak(word[:4], f"{state}.v2 * {factor}", f"(x1 + {state}.w1)", "a")
    w = weak(word[4:], f"z1 + {state}.w2", f"(y1 + {word[2]})", "b")
    made = "named_struct('x', z1, 'y', y1, 'z', x1, 'v1', v3[0], 'v2', v3[1], 'w1', w3[0], 'w2', w3[1])"
    return let("t", words, let("x1", x, let("y1", y, let("z1", z, let("v3", v, let("w3", w, made))))))


def statements() -> list[tuple[str, str, str]]:
    """Name, parameters and body of each function, in the order of their use."""
    mix = "value ^ shiftrightunsigned(value, 47)"
    start_y = f"(CAST({SEED} AS BIGINT) * {K1}L + 113)"
    first = f"CAST({SEED} AS BIGINT) * {K2}L + {bytes_at('0')}"
    zero = "CAST(0 AS BIGINT)"
    begin = f"named_struct('x', {first}, 'y', {start_y}, 'z', farm_mix({start_y} * {K2}L + 113) * {K2}L, 'v1', {zero}, 'v2', {zero}, 'w1', {zero}, 'w2', {zero})"
    blocks = "CASE WHEN n > 64 THEN sequence(0, (n - 1) DIV 64 - 1) ELSE array() END"
    step = "named_struct({})".format(", ".join(f"'{c}', s.{c}" + {"w1": " + ((n - 1) & 63)"}.get(c, "") for c in ("x", "y", "z", "v1", "v2", "w1", "w2")))
    summed = "named_struct('x', t.x, 'y', t.y, 'z', t.z, 'v1', t.v1 + t.w1, 'v2', t.v2, 'w1', t.w1 + t.v1 + t.w1, 'w2', t.w2)"
    return [
        ("farm_mix", "value BIGINT", mix),
        ("farm_two", "u BIGINT, v BIGINT, mul BIGINT", "farm_mix((v ^ farm_mix((u ^ v) * mul)) * mul) * mul"),
        ("farm_3", "a BIGINT, b BIGINT, c BIGINT, n INT", f"farm_mix(((a + shiftleft(b, 8)) * {K2}L) ^ ((n + shiftleft(c, 2)) * {K0}L)) * {K2}L"),
        ("farm_16", "a BIGINT, b BIGINT, mul BIGINT", f"farm_two({rotated('b', 37)} * mul + a, ({rotated('a', 25)} + b) * mul, mul)"),
        ("farm_left", "a BIGINT, b BIGINT, c BIGINT, d BIGINT", f"{rotated('(a + b)', 43)} + {rotated('c', 30)} + d"),
        ("farm_right", "a BIGINT, b BIGINT, c BIGINT", f"a + {rotated('(b)', 18)} + c"),
        ("farm_32", "a BIGINT, b BIGINT, c BIGINT, d BIGINT, mul BIGINT", f"farm_two(farm_left(a, b, c, d), farm_right(a, b + {K2}L, c), mul)"),
        (
            "farm_64_end",
            "a BIGINT, e BIGINT, f BIGINT, g BIGINT, h BIGINT, mul BIGINT",
            "farm_two(farm_left(e, f, g, h), farm_right(e, f + a, g), mul)",
        ),
        (
            "farm_64_middle",
            "a BIGINT, e BIGINT, f BIGINT, y BIGINT, z BIGINT, p BIGINT, q BIGINT, mul BIGINT",
            "farm_64_end(a, e, f, (y + p) * mul, (z + q) * mul, mul)",
        ),
        (
            "farm_64",
            "a BIGINT, b BIGINT, c BIGINT, d BIGINT, e BIGINT, f BIGINT, p BIGINT, q BIGINT, mul BIGINT",
            "farm_64_middle(a, e, f, farm_left(a, b, c, d), farm_32(a, b, c, d, mul), p, q, mul)",
        ),
        ("farm_begin", "r BINARY, n INT", f"CASE WHEN r IS NOT NULL THEN {begin} END"),
        ("farm_blocks", f"r BINARY, n INT, begin {STATE}", f"CASE WHEN r IS NOT NULL THEN aggregate({blocks}, begin, (s, i) -> {block('s', 'i * 64', f'{K1}L', False)}) END"),
        ("farm_summed", f"n INT, s {STATE}", f"CASE WHEN s IS NOT NULL THEN {let('t', step, summed)} END"),
        ("farm_last", f"r BINARY, n INT, s {STATE}, mul BIGINT", f"CASE WHEN r IS NOT NULL THEN {block('s', 'n - 64', 'mul', True)} END"),
        (
            "farm_long_end",
            f"s {STATE}, mul BIGINT",
            f"farm_two(farm_two(s.v1, s.w1, mul) + farm_mix(s.y) * {K0}L + s.z, farm_two(s.v2, s.w2, mul) + s.x, mul)",
        ),
        ("farm_long_last", f"r BINARY, n INT, s {STATE}, mul BIGINT", "farm_long_end(farm_last(r, n, farm_summed(n, s), mul), mul)"),
        ("farm_long_blocks", f"r BINARY, n INT, s {STATE}", f"farm_long_last(r, n, s, {K1}L + shiftleft(s.z & 255, 1))"),
        ("farm_long", "r BINARY, n INT", "farm_long_blocks(r, n, farm_blocks(r, n, farm_begin(r, n)))"),
        ("farm_of_3", "r BINARY, n INT", f"farm_3({bytes_at('0', 1)}, {bytes_at('n DIV 2', 1)}, {bytes_at('n - 1', 1)}, n)"),
        ("farm_of_7", "r BINARY, n INT, mul BIGINT", f"farm_two(n + shiftleft({bytes_at('0', 4)}, 3), {bytes_at('n - 4', 4)}, mul)"),
        ("farm_of_16", "r BINARY, n INT, mul BIGINT", f"farm_16({bytes_at('0')} + {K2}L, {bytes_at('n - 8')}, mul)"),
        (
            "farm_of_32",
            "r BINARY, n INT, mul BIGINT",
            f"farm_32({bytes_at('0')} * {K1}L, {bytes_at('8')}, {bytes_at('n - 8')} * mul, {bytes_at('n - 16')} * {K2}L, mul)",
        ),
        (
            "farm_of_64",
            "r BINARY, n INT, mul BIGINT",
            f"""farm_64({bytes_at('0')} * {K2}L, {bytes_at('8')}, {bytes_at('n - 8')} * mul, {bytes_at('n - 16')} * {K2}L,
            {bytes_at('16')} * mul, {bytes_at('24')}, {bytes_at('n - 32')}, {bytes_at('n - 24')}, mul)""",
        ),
        (
            # Arguments are computed before the class is known: those of others are null,
            # of which nothing is computed further.
            "farm_reversed",
            "r BINARY, n INT, mul BIGINT",
            f"""CASE WHEN n = 0 THEN {K2}L ELSE coalesce(farm_of_3(CASE WHEN n < 4 THEN r END, n), farm_of_7(CASE WHEN n BETWEEN 4 AND 7 THEN r END, n, mul),
            farm_of_16(CASE WHEN n BETWEEN 8 AND 16 THEN r END, n, mul), farm_of_32(CASE WHEN n BETWEEN 17 AND 32 THEN r END, n, mul),
            farm_of_64(CASE WHEN n BETWEEN 33 AND 64 THEN r END, n, mul), farm_long(CASE WHEN n > 64 THEN r END, n)) END""",
        ),
        (
            NAME,
            "text STRING",
            f"farm_reversed(encode(reverse(decode(CAST(text AS BINARY), 'ISO-8859-1')), 'ISO-8859-1'), octet_length(text), {K2}L + octet_length(text) * 2)",
        ),
    ]


RETURNS = {"farm_begin": STATE, "farm_blocks": STATE, "farm_summed": STATE, "farm_last": STATE}


def register(spark: SparkSession) -> None:
    """Create ``farm_fingerprint(text)`` in the session, for SQL users as well."""
    if spark.catalog.functionExists(NAME):
        return
    checked = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        for name, parameters, body in statements():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {RETURNS.get(name, 'BIGINT')} RETURN {body}")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", checked)


def fingerprint(text: Column) -> Column:
    """FARM_FINGERPRINT of a text's UTF-8 bytes, null for null."""
    register(SparkSession.active())
    return F.call_function(NAME, text)
