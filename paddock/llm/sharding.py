"""Proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; the rank over
the number of rows of the source is a fraction in [0, 1). Sorted by it, the rows
of every source are spread evenly over the whole order, so equal cuts of that
order all have the sources in the shares of the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import HASH_BITS, bucket_bits, packed, ranked, seeded, source_key, unpacked

OFFSET_BITS = 20


def interleave(rows: DataFrame, shards: int, source: str = "source", key: str = "doc_id", seed: int = 1, salt: tuple[str, ...] = ()) -> DataFrame:
    """Add ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 in each shard).

    Row counts of the shards differ by one at most, and in each shard the rows of
    a source differ from its share by two at most. Each source starts at a random
    offset, so many small sources don't meet in one place.

    The order depends on ``key`` and the ``salt`` columns. A null source is a
    source of its own; null keys are told apart by the salt; equal rows take
    neighbouring places of their source, in any order. An empty table gives an
    empty result. Columns named ``shard`` or ``slot`` are replaced, all others are
    kept. ``rows`` is read several times: pass a table or a cheap plan.
    """
    total = rows.count()
    bits = bucket_bits(total)
    salts = {f"salt{i}": F.col(c) for i, c in enumerate(salt)}
    base = packed(rows, _src=source_key(F.col(source)), _h=seeded(seed, F.col(key), *salts.values()), key=F.col(key), **salts)
    key, salt = "key", tuple(salts)
    base = base.withColumn("_b", F.shiftright("_h", HASH_BITS - bits))
    order = ["_h", key, *salt]
    in_source = ranked(base, ["_src"], "_b", order, "_r", "_n")
    offset = F.shiftright(seeded(seed, F.col("_src")), HASH_BITS - OFFSET_BITS) / F.lit(float(1 << OFFSET_BITS))
    spread = in_source.withColumn("_f", (F.col("_r") + offset) / F.col("_n"))
    spread = spread.withColumn("_fb", F.floor(F.col("_f") * (1 << bits)))
    placed = ranked(spread.withColumn("_all", F.lit(0)), ["_all"], "_fb", ["_f", "_src", *order], "_pos")
    # In whole numbers: of position p the shard is floor(p * shards / total).
    shard = F.expr(f"CAST((_pos * {shards}) div {max(total, 1)} AS INT)")
    first = F.expr(f"(CAST(shard AS BIGINT) * {total} + {shards - 1}) div {shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("_pos") - first)
    return unpacked(placed, rows.columns, "shard", "slot")
