"""FarmHash fingerprints: published values, a plain version of all length classes."""

import random

import pytest
from pyspark.sql import functions as F

from paddock.functions import farm
from paddock.functions import scalars as S

MASK = (1 << 64) - 1
K0, K1, K2 = (k & MASK for k in (farm.K0, farm.K1, farm.K2))


def number(data, at, width=8):
    return int.from_bytes(data[at : at + width], "little")


def turn(value, bits):
    value &= MASK
    return (value >> bits | value << 64 - bits) & MASK


def mixed(value):
    value &= MASK
    return value ^ value >> 47


def two(u, v, factor):
    a = mixed(((u ^ v) & MASK) * factor)
    return mixed(((v ^ a) & MASK) * factor) * factor & MASK


def four(data, at, a, b):
    w, x, y, z = (number(data, at + 8 * i) for i in range(4))
    a += w
    b = turn(b + a + z, 21)
    first = a
    a += x + y
    return (a + z) & MASK, (b + turn(a, 44) + first) & MASK


def plain(data):
    n = len(data)
    factor = (K2 + 2 * n) & MASK
    if n == 0:
        return K2
    if n < 4:
        y, z = data[0] + (data[n >> 1] << 8), n + (data[-1] << 2)
        return mixed(y * K2 ^ z * K0) * K2 & MASK
    if n < 8:
        return two(n + (number(data, 0, 4) << 3), number(data, n - 4, 4), factor)
    if n <= 16:
        a, b = number(data, 0) + K2, number(data, n - 8)
        return two((turn(b, 37) * factor + a) & MASK, (turn(a, 25) + b) * factor & MASK, factor)
    if n <= 64:
        a, b, d = number(data, 0) * (K1 if n <= 32 else K2) & MASK, number(data, 8), number(data, n - 16) * K2
        c = number(data, n - 8) * factor & MASK
        y = (turn(a + b, 43) + turn(c, 30) + d) & MASK
        z = two(y, (a + turn(b + K2, 18) + c) & MASK, factor)
        if n <= 32:
            return z
        e, f = number(data, 16) * factor & MASK, number(data, 24)
        g, h = (y + number(data, n - 32)) * factor & MASK, (z + number(data, n - 24)) * factor & MASK
        return two((turn(e + f, 43) + turn(g, 30) + h) & MASK, (e + turn(f + a, 18) + g) & MASK, factor)
    x, y = farm.SEED * K2 + number(data, 0), farm.SEED * K1 + 113
    z, v, w = mixed(y * K2 + 113) * K2, (0, 0), (0, 0)

    def step(at, x, y, z, v, w, factor, weight):
        x = turn(x + y + v[0] + number(data, at + 8), 37) * factor ^ w[1] * weight
        y = turn(y + v[1] + number(data, at + 48), 42) * factor + v[0] * weight + number(data, at + 40)
        z = turn(z + w[0], 33) * factor
        v, w = four(data, at, v[1] * factor, x + w[0]), four(data, at + 32, z + w[1], y + number(data, at + 16))
        return z & MASK, y & MASK, x & MASK, v, w

    for at in range(0, (n - 1) // 64 * 64, 64):
        x, y, z, v, w = step(at, x, y, z, v, w, K1, 1)
    factor = K1 + ((z & 255) << 1)
    first = w[0] + ((n - 1) & 63)
    v = (v[0] + first, v[1])
    w = (first + v[0], w[1])
    x, y, z, v, w = step(n - 64, x, y, z, v, w, factor, 9)
    return two((two(v[0], w[0], factor) + mixed(y) * K0 + z) & MASK, (two(v[1], w[1], factor) + x) & MASK, factor)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


# The examples in the documentation of the SQL function of that name.
PUBLISHED = {"1footrue": -1541654101129638711, "2applefalse": 2794438866806483259, "3true": -4880158226897771312}


def test_published_values(spark):
    rows = spark.createDataFrame([(t,) for t in PUBLISHED], "t string").select("t", farm.fingerprint(F.col("t")).alias("f")).collect()
    assert {r["t"]: r["f"] for r in rows} == PUBLISHED == {t: signed(plain(t.encode())) for t in PUBLISHED}


def test_all_lengths(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("abcXYZ019_ é€😀") for _ in range(n)) for n in [*range(140), 255, 256, 257, 1000, 5003]] + ["x" * n for n in range(130)]
    lengths = {len(t.encode()) for t in texts}
    assert {*range(1, 65)} <= lengths
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string").repartition(4)
    got = df.select("t", farm.fingerprint(F.col("t")).alias("f")).collect()
    assert [r["t"] for r in got if r["f"] != (None if r["t"] is None else signed(plain(r["t"].encode())))] == []


def test_checked_arithmetic_is_left_on(spark):
    farm.register(spark)
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        spark.sql("SELECT id + 9223372036854775807 FROM range(3)").collect()


def test_compiled(spark):
    """No row leaves the JVM, and a plan over many rows is generated code."""
    df = spark.range(10).select(farm.fingerprint(F.col("id").cast("string")).alias("f"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "*(1) Project" in text


def test_record_key(spark):
    df = spark.createDataFrame([(12, 5408, 3)], "h long, r long, s long")
    assert df.select(S.record_key(F.col("h"), F.col("r"), F.col("s"))).first()[0] == signed(plain(b"12_5408_3"))
