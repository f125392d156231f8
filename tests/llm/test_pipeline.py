"""Each stage of the pipeline against another way to do it, on its own input."""

from collections import Counter

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F
from test_operators import brute_components, brute_fingerprint

from paddock.llm import langid, oracles
from paddock.llm.common import materialize, table


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, materialize(stage(spark, docs, sf), name)
        out.append((name, given, docs))
    return out


def keys(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_columns(stages, spark, sf):
    columns = table(spark, sf, "documents").columns
    assert all(out.columns == columns for _, _, out in stages[:-1]) and stages[-1][2].columns == [*columns, "shard", "slot"]


def test_language(stages):
    _, given, out = stages[0]
    assert keys(out) <= keys(given)
    gone = keys(given) - keys(out)
    lettered = [text for _, text in gone.elements() if langid.has_letter(text)]
    assert len(lettered) <= given.count() // 100 and all(langid.has_letter(text) for _, text in keys(out))


def test_dedup(stages):
    _, given, out = stages[1]
    rows = sorted(keys(given))
    roots = brute_components([brute_fingerprint(t) for _, t in rows])
    assert keys(out) == Counter(rows[i] for i in set(roots))


def sql(given, sf, text):
    con = duckdb.connect()
    con.register("given", given.select("doc_id", "text", "source").toPandas())
    con.execute("CREATE VIEW documents AS SELECT * FROM given")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{sf}/benchmark.parquet')")
    return con.execute(text).fetchall()


def test_decontamination(stages, sf):
    _, given, out = stages[2]
    clean = sql(given, sf, f"WITH {oracles.contaminated_words()} SELECT doc_id FROM verdict WHERE NOT contaminated")
    assert sorted(i for i, _ in keys(out)) == sorted(x[0] for x in clean) and len(clean) < given.count()


def test_mix(stages, sf):
    _, given, out = stages[3]
    copies = sql(given, sf, f"SELECT doc_id, copies FROM ({oracles.SQL['op6_mixing']}) WHERE copies > 0")
    assert {i: n for (i, _), n in keys(out).items()} == dict(copies)


def test_shards(stages):
    _, given, out = stages[4]
    rows = out.collect()
    assert keys(out) == keys(given)
    counts, sources = Counter(r["shard"] for r in rows), Counter(r["source"] for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    assert {(r["shard"], r["slot"]) for r in rows} == {(s, i) for s, n in counts.items() for i in range(n)}
    per = Counter((r["shard"], r["source"]) for r in rows)
    assert all(abs(per[(s, x)] - n / 8) <= 2 for x, n in sources.items() for s in range(8))


def test_run(spark, sf, stages):
    assert keys(corpus_pipeline.run(spark, sf)) == keys(stages[-1][2])


def test_odd_rows(spark, sf):
    """Null in every column, empty, white and very long texts, repeated rows and ids, and
    columns with names that operators use, through all stages; then no rows at all."""
    docs = table(spark, sf, "documents")
    rows = [(None, "Words without an id and without a source, but long enough.", "en", None, 1), (10**9, None, None, None, None), (10**9 + 1, "", "en", "b", 0),
            (10**9 + 2, " \t\n", "en", "b", 3), (10**9 + 3, " ".join(f"the{i % 97} and of" for i in range(60_000)), "en", "c", 1)]
    wide = docs.unionByName(spark.createDataFrame(rows, docs.schema)).unionByName(docs.limit(5))
    clash = ("shard", "slot", "size", "copies", "target", "lang_pred", "score", "_src", "_rate", "_size", "_k1", "_k2", "_lid", "_text_hash", "row", "fp", "root", "_found")
    wide = materialize(wide.withColumns({c: F.concat(F.lit("kept "), "doc_id") for c in clash}), "wide")
    for odd in (wide, wide.limit(0)):
        out = odd
        for name, stage in corpus_pipeline.STAGES:
            given, out = out, materialize(stage(spark, out, sf), name)
            replaced = {"shard", "slot"} if name == "shard" else set()
            assert set(out.columns) == set(given.columns)
            same = [c for c in clash if c not in replaced]
            assert all(r[c] == (None if r["doc_id"] is None else f"kept {r['doc_id']}") for r in out.select("doc_id", *same).collect() for c in same)
        assert out.count() > 150 if odd is wide else out.count() == 0
