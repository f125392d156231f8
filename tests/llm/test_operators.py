"""The operators on small tables with nulls, ties, long texts and clashing names."""

import gzip
import hashlib
import html
import html.entities
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from compare import duck
from pyspark.sql import functions as F

from paddock.llm import decontamination, langid, licensing, mixing, oracles, preferences, sharding, simhash, spotsigs, tokens, warc
from paddock.llm.common import ascii_lower, materialize, prepared, ranked

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i}" for i in range(40_000))


@pytest.fixture(scope="module")
def odd(spark):
    """Null in every column, empty and white texts, a very long one, repeated rows
    and repeated ids, and columns with the names that operators add."""
    prepared(spark)
    rows = [
        (1, "The quick brown fox jumps over the lazy dog and runs", "en", "a", 5),
        (1, "The quick brown fox jumps over the lazy dog and runs", "en", "a", 5),
        (1, "another text with the same id", "en", "a", 5),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \t\n", "en", "b", 3),
        (None, "no id here at all", "en", None, 1),
        (5, LONG, "en", "c", 1),
        (6, "ÉCOLE École école", "fr", "c", 1),
        (7, "12 345 !!", "fr", "c", 1),
    ]
    clash = ["shard", "slot", "size", "target", "copies", "source_size", "lang_pred", "score", "licenses", "status", "fp", "component_id", "n_hit",
             "_src", "_h", "_b", "_r", "_n", "_f", "_fb", "_all", "_pos", "_rate", "_u", "_size", "_time", "_k1", "_k2", "_spans", "_lid", "_found", "_ids", "_left0",
             "_left1", "_rows", "_start", "_number", "_text_hash", "row", "key", "salt0", "copies2", "text_hash", "words", "doc", "_row"]
    df = spark.createDataFrame(rows, DOCS)
    return materialize(df.withColumns({c: F.lit("clash") for c in clash}), "odd")


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_ascii_lower(spark):
    texts = ["ABC xyz", "ÉA", "İI", "ǅA", None, "", "ßẞ", "ΑΣ A"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(ascii_lower(F.col("t"))).collect()]
    assert got == [t if t is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in texts]


def test_ranked(spark):
    df = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id % 7 AS b")
    got = ranked(df, ["k"], "b", ["id"], "r", "n").collect()
    hot = sorted((r["b"], r["id"], r["r"]) for r in got if r["k"] == "hot")
    assert [x[2] for x in hot] == list(range(334)) and {r["n"] for r in got if r["k"] == "hot"} == {334}


# Sharding


def test_interleave(spark, odd, none):
    rows = spark.range(1000).selectExpr("id AS doc_id", "IF(id < 700, 'hot', IF(id < 990, 'b', CAST(id AS STRING))) AS source")
    got = sharding.interleave(rows, 8).collect()
    by_shard = Counter(r["shard"] for r in got)
    assert sorted(by_shard) == list(range(8)) and set(by_shard.values()) == {125}
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(125))
    for source, n in (("hot", 700), ("b", 290)):
        assert all(abs(v - n / 8) <= 2 for v in Counter(r["shard"] for r in got if r["source"] == source).values())
    small = sharding.interleave(odd, 3, salt=("n_chars",)).collect()
    assert len(small) == 10 and max(Counter(r["shard"] for r in small).values()) == 4
    assert sharding.interleave(none, 3).count() == 0


# Mixing


def water_level(sizes, weights, share=1.5, most=2.0):
    """Targets by the rule: share by weight, stop, share the excess, until none is above."""
    stopped, total = {}, share * sum(sizes.values())
    while True:
        open_ = [s for s in sizes if s not in stopped]
        rest, weight = total - sum(stopped.values()), sum(weights[s] for s in open_)
        over = [s for s in open_ if rest * weights[s] / weight > most * sizes[s] + 1e-9]
        if not over:
            return {**stopped, **{s: rest * weights[s] / weight for s in open_}}
        stopped.update({s: most * sizes[s] for s in over})


def test_mixing_targets_and_copies(spark, odd, none):
    rng = random.Random(1)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c", "é", None]), int(rng.paretovariate(1) * 5)) for i in range(3000)]
    got = mixing.sampled(spark.createDataFrame(docs, "doc_id long, source string, size long"), "size").collect()
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    order = sorted((s for s in sizes if s), key=lambda s: s) + [None]
    want = water_level(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    taken = Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
    for s in sizes:
        longest = max(n for _, x, n in docs if x == s)  # taken whole or not at all
        assert abs(taken[s] - want[s]) < 0.02 * want[s] + longest
    again = mixing.sampled(spark.createDataFrame(docs[::-1], "doc_id long, source string, size long").repartition(7), "size").collect()
    assert {(r["doc_id"], r["copies"]) for r in got} == {(r["doc_id"], r["copies"]) for r in again}


def test_mixed_odd(odd, none):
    assert mixing.mixed(none).count() == 0
    got = mixing.mixed(odd)
    assert got.columns == odd.columns
    sizes = {r["doc_id"]: r["n"] for r in odd.select("doc_id", mixing.n_words(F.col("text")).alias("n")).collect()}
    assert sizes[2] == 0 and sizes[4] == 0 and sizes[5] == 40_000
    assert max(Counter(r["doc_id"] for r in got.where("doc_id <> 1").collect()).values()) <= 2


# Decontamination


def brute_contamination(texts, items, n=13):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    out = []
    for text in texts:
        w, hit, ids = re.findall(pattern, low(text)), set(), set()
        for item, body in items:
            b = re.findall(pattern, low(body))
            k = min(n, len(b))
            for i in range(len(b) - k + 1) if b else ():
                for at in range(len(w) - k + 1):
                    if w[at : at + k] == b[i : i + k]:
                        hit |= set(range(at, at + k))
                        ids.add("null" if item is None else str(item))
        out.append((len(w), len(hit), sorted(ids)))
    return out


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [
        (10, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
        (9, "One, two three four five six seven eight nine ten eleven twelve; thirteen!"),
        (8, "Lazy DOG"), (7, "école"), (6, ""), (None, "same id here"), (5, None), (4, "a b a b a b a b a b a b a b a b"),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_contamination_brute(spark, odd, none, benchmark, monkeypatch):
    rng = random.Random(3)
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split()
    texts = [r["text"] for r in odd.where("doc_id is null or doc_id <> 5").select("text").collect()]
    texts += ["a b " * 12, "x " + " ".join(base) + " y " + " ".join(base[1:]), "the lazy-dog école", "a with the same id here"]
    texts += [" ".join(rng.choice(base + ["lazy", "dog"]) for _ in range(30)) for _ in range(10)] * 2
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = brute_contamination(texts, [tuple(r) for r in benchmark.collect()])
    for limit in (decontamination.BROADCAST_BYTES, 500):  # one block and several
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", limit)
        got = decontamination.contamination(docs, benchmark, keep=("doc_id",)).collect()
        assert [(r["n_words"], r["n_hit"], r["items"]) for r in sorted(got, key=lambda r: r["doc_id"])] == want
    assert decontamination.contamination(none, benchmark).count() == 0
    clean = decontamination.contamination(docs, benchmark.limit(0)).agg(F.sum("n_hit")).first()[0]
    assert clean == 0


def test_decontaminated(spark, odd, benchmark):
    got = decontamination.decontaminated(odd, benchmark)
    assert got.columns == odd.columns
    # doc 1 says "lazy dog", doc 6 "école"; the others, repeated rows included, stay.
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 2, 3, 4, 5, 7]
    cut = {r["doc_id"]: r["text"] for r in decontamination.decontaminated(odd, benchmark, cut=True).where("doc_id in (1, 3, 6, 7)").collect()}
    assert cut[6] == "ÉCOLE École " and cut[3] == "" and cut[7] == "12 345 !!"
    texts = {r["text"] for r in decontamination.decontaminated(odd, benchmark, cut=True).where("doc_id = 1").collect()}
    assert texts == {"The quick brown fox jumps over the and runs", "another text with the same id"}


# SimHash


def brute_fingerprint(text):
    ws = plain_words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, budget=3):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def test_fingerprints():
    for text in (None, "", " \t", "One", "A b", "a B c d", "É é x y z", LONG):
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def clustered(rng, n):
    """Fingerprints in chains: each differs in a few bits from an earlier one."""
    fps = [rng.getrandbits(64) for _ in range(max(1, n // 4))] + [0]
    while len(fps) < n:
        fp = rng.choice(fps)
        for _ in range(rng.randint(0, 5)):
            fp ^= 1 << rng.randrange(64)
        fps.append(fp)
    return fps


@pytest.mark.parametrize("seed", range(4))
def test_trie_join(seed, monkeypatch):
    monkeypatch.setattr(simhash, "FRONTIER", 50)
    monkeypatch.setattr(simhash, "LEAF_PAIRS", 4)
    fps = np.array(sorted(set(clustered(random.Random(seed), 300))), np.uint64)
    want = brute_components([int(x) for x in fps])
    assert simhash.trie_join(fps, fps, 3, True).tolist() == want
    a, b = fps[::2], fps[1::2]
    both = [int(x) for x in [*a, *b]]
    roots = simhash.trie_join(a, b, 3, False)
    pairs = {(i, j) for i in range(len(a)) for j in range(len(a), len(both)) if (both[i] ^ both[j]).bit_count() <= 3}
    assert all(roots[i] == roots[j] for i, j in pairs)


@pytest.mark.parametrize("node", [simhash.NODE, 16])
def test_components(spark, node):
    fps = clustered(random.Random(9), 400)
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in enumerate(fps)]
    df = materialize(spark.createDataFrame(signed, "doc_id long, fp long"), "signed")
    distinct = df.groupBy("fp").agg(F.min("doc_id").alias("least"))
    stars = {r["u"]: r["v"] for r in simhash.star(simhash.linked(materialize(distinct, "distinct"), node=node)).collect()}
    want = brute_components(fps)
    got = [stars.get(fp, fp) for _, fp in signed]
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))
    ids = {r["fp"]: r["component_id"] for r in simhash.signed_components(df).collect()}
    assert [ids[fp] for _, fp in signed] == want


def test_near_duplicates_odd(spark, odd, none):
    got = [(r["doc_id"], r["fp"], r["component_id"]) for r in simhash.near_duplicates(odd).collect()]
    assert len(got) == 10
    assert all(c == 2 for i, fp, c in got if i in (2, 3, 4)) and all(fp == 0 for i, fp, _ in got if i in (2, 3, 4))
    assert (None, None) in {(i, c) for i, _, c in got}
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 1, 2, 5, 6, 7]
    assert simhash.near_duplicates(none).count() == 0 and simhash.deduplicated(none).count() == 0


# Licences


def test_licences(spark, odd, none):
    texts = [
        "Some text.\nReleased under the MIT License.", "x\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT License.",
        'Licensed under the Apache License, Version 2.0 (the "License");\n you may not use this file except in compliance with the License.\n'
        "You may obtain a copy of the License at\n\n http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in "
        'writing, software\ndistributed under the License is distributed on an "AS IS" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either '
        "express or implied.\nSee the License for the specific language governing permissions and\nlimitations under the License.",
        "All rights need a licence and permission from me.", "Copyright 2020 me. Nothing else.", "plain", "SPDX-License-Identifier: MIT", None, "",
    ]
    got = licensing.scanned(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["licenses"] for r in got] == ["MIT", "Apache-2.0,MIT", "Apache-2.0", "", "", "", "MIT", "", ""]
    assert [r["status"] for r in got] == ["licensed"] * 3 + ["unknown", "none", "none", "licensed", "none", "none"]
    assert licensing.scanned(odd).count() == 10 and licensing.scanned(none).count() == 0
    assert {r["status"] for r in licensing.scanned(odd).collect()} == {"none"}


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD2 = """Copyright (c) 2020, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
ENDORSE = """3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

"""
BSD3 = BSD2.replace("THIS SOFTWARE IS", ENDORSE + "THIS SOFTWARE IS")
GPL2 = """    This program is free software; you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation; either version 2 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License along
    with this program; if not, write to the Free Software Foundation, Inc.,
    51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA.
"""
GPL3 = GPL2.replace("software;", "software:").replace("Foundation; either version 2", "Foundation, either version 3")
APACHE = """Copyright 2020 Some One

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def test_wrapped_licences(spark):
    whole = {"MIT": (MIT, 2), "BSD-2-Clause": (BSD2, 1), "BSD-3-Clause": (BSD3, 1), "GPL-2.0-or-later": (GPL2, 2),
             "GPL-3.0-or-later": (GPL3, 2), "Apache-2.0": (APACHE, 0)}
    forms = [
        lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: "Read this:\n" + t.replace("\n\n", "\n"),
        *[lambda t, c=c: "".join(f"{c} {line}".rstrip() + "\n" for line in t.split("\n")) for c in ("#", " *", "//", "--", ";;")],
        lambda t: "\n\n".join(" ".join(x.split()) for x in t.split("\n\n")), lambda t: "x = 1\n" + t.replace("1. ", "(a) ").replace("2. ", "b) ") + "\nRest.",
    ]
    texts = [(name, f(text)) for name, (text, _) in whole.items() for f in forms]
    got = licensing.scanned(spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, name string, text string")).collect()
    assert [(r["name"], r["text"]) for r in got if (r["licenses"], r["status"]) != (r["name"], "licensed")] == []
    # Titles, liability and address sentences are not among the known ones.
    assert {(r["name"], r["n_unknown"]) for r in got if (r["name"], r["text"]) in {(n, t) for n, (t, _) in whole.items()}} == {(n, u) for n, (_, u) in whole.items()}
    part = licensing.scanned(spark.createDataFrame([(MIT.replace("hereby", "never"),), ("A title\nReleased under the MIT License.",)], "text string"))
    assert [r["licenses"] for r in part.collect()] == ["", "MIT"]


# Language identification


def test_language_id(spark, sf, odd, none):
    docs = prepared(spark).read.parquet(f"{sf}/documents.parquet")
    found = langid.identified(docs).withColumn("held_out", langid.held_out(F.col("doc_id"))).collect()
    unseen = [r for r in found if r["held_out"]]
    assert {r["doc_id"] % 1 for r in found} == {0} and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in found)
    assert sum(r["lang"] == r["lang_pred"] for r in unseen) / len(unseen) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identified(odd).collect()}
    assert all(got[i] == ("und", 0.0) for i in (2, 3, 4, 7)) and got[5][0] in ("en", "fr")
    assert langid.identified(none).count() == 0
    assert {r["lang_pred"] for r in langid.identified(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.accepted(odd)
    assert kept.columns == odd.columns and not {2, 3, 4, 7} & {r["doc_id"] for r in kept.collect()}


def test_probabilities_against_loops():
    """The lookups of byte pairs, the plain network, and loops over places agree."""
    rng = np.random.default_rng(3)
    model = langid.ByteConv.fresh(["a", "b", "c"])
    for bias in model.bias:
        bias += rng.normal(0, 0.2, bias.shape).astype(np.float32)
    x = np.concatenate([langid.windows_of(t) for t in ("short", "ÄÖ ü " * 90, "é", "x" * 1000)])
    fast = model.probabilities(x, model.tables())
    features = np.zeros((len(x), len(langid.WIDTHS) * langid.FILTERS))
    for row, window in enumerate(x):
        for w, (k, kernel, bias) in enumerate(zip(langid.WIDTHS, model.kernels, model.bias)):
            for f in range(langid.FILTERS):
                best = max(sum(float(kernel[i, window[at + i], f]) for i in range(k)) for at in range(len(window) - k + 1))
                features[row, w * langid.FILTERS + f] = max(best + float(bias[f]), 0)
    z = np.exp(features @ model.out.astype(float) + model.out_bias)
    assert np.allclose(fast, z / z.sum(1, keepdims=True), atol=1e-4)
    assert np.allclose(fast, model.softmax(model.pooled(x)[0]), atol=1e-5) and np.allclose(fast.sum(1), 1, atol=1e-5)


def test_sample_takes_whole_texts(spark, monkeypatch):
    """Pieces come from all over a text, and languages are learned from any of it."""
    docs = spark.createDataFrame([(i, "head " * 400 + f"tail{i} " * 400, "x") for i in range(40)], "doc_id long, text string, lang string")
    sample = langid.labelled_sample(prepared(spark).createDataFrame(docs.toPandas()), F.lit(True))
    assert len(sample) == 40 and all(0 < len(p) <= langid.WINDOWS_PER_DOC and all(len(x) == langid.WINDOW for x in p) for p in sample["pieces"])
    seen = [("head" in x, "tail" in x) for p in sample["pieces"] for x in p]
    assert sum(a for a, _ in seen) > 20 and sum(b for _, b in seen) > 20
    again = langid.labelled_sample(docs.repartition(3), F.lit(True)).sort_values("doc_id")
    assert [list(p) for p in again["pieces"]] == [list(p) for p in sample.sort_values("doc_id")["pieces"]]


def test_rejected_texts(spark, sf):
    """Clean documents stay; shuffled, foreign and random text with letters goes."""
    docs = prepared(spark).read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(4)
    long = [r["text"] for r in docs.where("length(text) > 200").limit(40).collect()]
    bad = ["".join(rng.sample(t, len(t))) for t in long] + ["Это предложение написано на русском языке. " * 9, "这是一个用中文写的句子。" * 20]
    bad += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789{};", k=400)) for _ in range(20)]
    more = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(bad)], docs.schema)
    kept = {r["doc_id"] for r in langid.accepted(docs.unionByName(more)).collect()}
    clean = {r["doc_id"] for r in docs.collect() if langid.has_letter(r["text"])}
    assert len(clean - kept) <= len(clean) // 100 and sum(i >= 10**9 for i in kept) <= 2


def test_windows_cover_the_text():
    for n in (1, 3, 255, 256, 257, 509, 510, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        rows = langid.windows_of(text)
        step = langid.WINDOW - max(langid.WIDTHS) + 1
        joined = b"".join(bytes(r[:step]) for r in rows[:-1]) + bytes(rows[-1])
        assert joined.rstrip(b"\0") == text.encode()


# Token blocks


@pytest.fixture(scope="module")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_coder_round_trip():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 50_257, n).astype(np.uint16) for n in (0, 1, 2, 1024, 500)]
    blocks += [np.zeros(1024, np.uint16), np.tile(np.arange(7, dtype=np.uint16), 100), np.array([65534, 0, 1, 2, 65534], np.uint16)]
    blocks += [rng.zipf(1.3, 300).clip(0, 50_000).astype(np.uint16) for _ in range(50)]
    coded = [tokens.framed(p, b) for p, b in zip(tokens.encode(blocks), blocks)]
    assert all((x == y).all() for x, y in zip(tokens.unframed(coded), blocks))
    assert len(coded[5]) < 400  # repeats cost next to nothing
    for at in (0, 5, 20):
        bad = bytearray(coded[3])
        bad[at] ^= 1
        with pytest.raises(ValueError):
            tokens.unframed([bytes(bad)])


def test_pieces_code_like_whole_texts(vocabulary):
    from tokenizers import Tokenizer

    whole, cut = Tokenizer.from_file(vocabulary), tokens.Encoder(vocabulary)
    rng = random.Random(2)
    texts = ["", " ", "a ", " a", "a  b", "a\n b", "a \nb", "x 　y", "it's 'll 12 3\t4", "<|endoftext|> a <|endoftext|>", "é É\nö", LONG[:3000]]
    texts += ["".join(rng.choice("ab1 .\n'éß\t ") for _ in range(40)) for _ in range(500)]
    assert [x.tolist() for x in cut(texts)] == [[*whole.encode(t, add_special_tokens=False).ids, tokens.END_ID] for t in texts]


def test_known_pieces_need_no_tokenizer(vocabulary):
    from tokenizers import Tokenizer

    whole, cut = Tokenizer.from_file(vocabulary), tokens.Encoder(vocabulary)
    cut(["Foo bar, baz.\nQux one.", "Foo  baz.\nbar"])
    cut.tokenizer = cut.letters = None
    texts = ["Foo  baz.\nbar", "Foo baz, bar.", "Foo one,", "Foo bar.\nQux"]
    assert [x.tolist() for x in cut(texts)] == [[*whole.encode(t, add_special_tokens=False).ids, tokens.END_ID] for t in texts]


def test_forgotten_pieces_code_alike(vocabulary, monkeypatch):
    from tokenizers import Tokenizer

    whole, cut = Tokenizer.from_file(vocabulary), tokens.Encoder(vocabulary)
    rng = random.Random(3)
    made = ["".join(rng.choice("abéß.,'\n1_\u00a0\u0301²<|") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    for cache in (40, 5, 0):
        monkeypatch.setattr(tokens, "CACHE", cache)
        for _ in range(6):
            texts = [rng.choice([" ", " ", "  "]).join(rng.choices([*made, "", "<|endoftext|>", "x<|endoftext|>.y"], k=8)) for _ in range(12)]
            assert [x.tolist() for x in cut(texts)] == [[*whole.encode(t, add_special_tokens=False).ids, tokens.END_ID] for t in texts]


def test_blocks_of_all_shapes(monkeypatch):
    rng = np.random.default_rng(7)
    blocks = [rng.integers(0, 65_535, n).astype(np.uint16) for n in rng.integers(0, 1025, 50)]
    blocks += [np.repeat(rng.integers(0, 65_535, 30), rng.integers(1, 40, 30)).astype(np.uint16) for _ in range(30)]
    blocks += [np.full(n, i, np.uint16) for n, i in ((1, 0), (2, 65_534), (1024, 65_534), (1500, 7))]
    whole = tokens.encode(blocks)
    monkeypatch.setattr(tokens, "LANES", 8)
    assert tokens.encode(blocks) == whole
    assert all((x == y).all() and len(x) == len(y) for x, y in zip(tokens.decode(whole, [len(b) for b in blocks]), blocks))
    assert tokens.encode([]) == [] and tokens.decode([], []) == []


def test_crc_of_joined_texts():
    data = random.Random(4).randbytes(5000)
    for n in (0, 1, 4, 4096, 5000):
        assert tokens.combined(zlib.crc32(data[:n]), zlib.crc32(data[n:]), 5000 - n) == zlib.crc32(data)


def test_token_files(spark, odd, none, vocabulary, tmp_path):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary)
    tokens.write_ids(odd, vocabulary, str(tmp_path / "blocks"))
    blocks = spark.read.parquet(str(tmp_path / "blocks"))
    rows = sorted(odd.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or ""))
    want, start = [], 0
    for r in rows:
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted(tokens.read_summary(blocks).collect(), key=lambda r: r["start"])
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == want
    full = {r["doc_id"]: r["ids"] for r in tokens.read_ids(blocks).collect()}
    assert zlib.crc32(full[5]) == next(w[3] for w in want if w[0] == 5)
    tokens.write_ids(none, vocabulary, str(tmp_path / "none"))
    assert tokens.read_summary(spark.read.schema(blocks.schema).parquet(str(tmp_path / "none"))).count() == 0


# Preferences


def test_preferences(spark):
    schema = "pair_id long, turn long, role string, text string, extra string"
    turns = lambda p, *t: [(p, i, r, x, "e") for i, (r, x) in enumerate(t)]
    chosen = turns(1, ("user", "hi"), ("assistant", "good <|end|>")) + turns(2, ("user", "a")) + turns(3, (None, None)) + turns(None, ("user", "n"))
    rejected = turns(1, ("user", "hi"), ("assistant", "bad"), ("user", "x")) + turns(2, ("user", "a")) + turns(4, ("assistant", "only"))
    both = [spark.createDataFrame(x, schema) for x in (chosen, rejected)]
    got = {r["pair_id"]: r for r in preferences.preference_pairs(*both).collect()}
    one = got[1]
    assert (one["n_prompt_turns"], one["prompt"]) == (1, "<|user|>\nhi<|end|>\n")
    assert one["chosen_text"] == "<|assistant|>\ngood < |end|><|end|>\n"
    a, b = map(int, one["chosen_mask"].split("-"))
    assert one["chosen_text"][a:b] == "good < |end|><|end|>"
    a, b = map(int, one["rejected_mask"].split("-"))
    assert one["rejected_text"][a:b] == "bad<|end|>" and one["rejected_text"].endswith("<|user|>\nx<|end|>\n")
    assert not got[2]["differs"] and got[2]["chosen_text"] == "" and got[3]["rejected_text"] == "" and got[4]["chosen_text"] == ""
    assert set(got) == {1, 2, 3, 4, None}
    assert preferences.preference_pairs(*[x.limit(0) for x in both]).count() == 0


def plain_pairs(rows):
    """Prompt and completions of each conversation, turn by turn."""
    held = {}
    for conv, turn, role, text in rows:
        held.setdefault(conv, []).append((turn is not None, turn or 0, role or "user", text or ""))
    turns = {c: [t[2:] for t in sorted(own)] for c, own in held.items()}
    clean = lambda x: x.replace("<|", "< |")
    out = {}

    def last_reply(c):
        return max((i for i, (role, _) in enumerate(turns.get(c, [])) if role == "assistant"), default=None)

    def drawn(part):
        text, spans = "", []
        for role, said in part:
            text += f"<|{clean(role)}|>\n"
            if role == "assistant":
                spans.append(f"{len(text)}-{len(text) + len(clean(said)) + 7}")
            text += f"{clean(said)}<|end|>\n"
        return text, " ".join(spans)

    for c, own in turns.items():
        at, other = last_reply(c), None if c is None else c ^ 1
        rejected = list(own)
        if at is not None:
            there = None if other is None else last_reply(other)
            rejected[at] = ("assistant", turns[other][there][1] if there is not None else "")
        n = next((i for i, (a, b) in enumerate(zip(own, rejected)) if a != b), len(own))
        (chosen, mask), (worse, other_mask) = drawn(own[n:]), drawn(rejected[n:])
        out[c] = (n, drawn(own[:n])[0], chosen, worse, mask, other_mask, len(own) > n)
    return out


FORMATTED = ["n_prompt_turns", "prompt", "chosen_text", "rejected_text", "chosen_mask", "rejected_mask", "differs"]


def test_borrowed_replies(spark):
    """Against plain loops: turns after the last reply, nulls everywhere, ties, repeated
    rows, marks of the template, a very long text, clashing columns, an empty table."""
    rng = random.Random(12)
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a0"), (0, 2, "user", "thanks"), (1, 0, "user", "r"), (1, 1, "assistant", "a1"),
            (2, 0, "assistant", "lone"), (3, 0, "user", "no reply"), (None, 0, "user", "x"), (None, 1, "assistant", "y"),
            (4, 0, "user", "<|end|>"), (4, 1, "assistant", "long " * 200_000), (4, 2, "user", None), (5, None, None, "first")]
    for c in range(6, 60):
        rows += [(c, rng.choice([t, t, None]), rng.choice(["user", "assistant", "system", None]), rng.choice(["a", "b", "", None, "é<|"])) for t in range(rng.randrange(1, 7))]
    rows += rows[:5]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    wide = conv.withColumns({c: F.lit("clash") for c in ("turns", "chosen", "rejected", "prompt", "_last", "_for", "_reply", "differs")})
    pairs = materialize(preferences.formatted(preferences.with_borrowed_replies(wide.repartition(4))), "pairs")
    assert {r["conv_id"]: tuple(r[c] for c in FORMATTED) for r in pairs.collect()} == plain_pairs(rows)
    got = {r["conv_id"]: r for r in pairs.collect()}
    assert "thanks" in got[0]["chosen_text"] and "thanks" in got[0]["rejected_text"] and "a1" in got[0]["rejected_text"]
    assert preferences.formatted(preferences.with_borrowed_replies(wide.limit(0))).count() == 0


def test_all_turns_are_rendered(spark, sf):
    """Prompt and completion of the given conversations hold all their characters."""
    conv = spark.read.parquet(f"{sf}/conversations.parquet")
    pairs = preferences.formatted(preferences.with_borrowed_replies(conv))
    rendered = pairs.agg(F.sum(F.length("prompt") + F.length("chosen_text"))).first()[0]
    plain = conv.select(F.sum(F.length(F.replace("text", F.lit("<|"), F.lit("< |"))) + F.length("role") + len("<||>\n<|end|>\n"))).first()[0]
    assert rendered == plain


# SpotSigs


def test_spotsigs(spark, odd, none):
    got = {r["text"]: r["s"] for r in spotsigs.with_signatures(odd.select("text"), "text", "s").collect()}
    sig = lambda t: hashlib.md5(t.encode()).hexdigest()[:8]
    first = "The quick brown fox jumps over the lazy dog and runs"
    assert got[first] == sorted({sig("the quick brown"), sig("the lazy dog")})
    assert got[None] == got[""] == got[" \t\n"] == [sig("")] and got["12 345 !!"] == [sig("12 345")]
    rows = {(r["doc_id"], r["text"]): r for r in spotsigs.edited(odd).collect()}
    # Equal rows follow each other; the last, without an id, is followed by the first.
    assert rows[(None, "no id here at all")]["next_text"] == "12 345 !!" and rows[(7, "12 345 !!")]["next_text"] == "ÉCOLE École école"
    assert rows[(7, "12 345 !!")]["edited_text"] == "12 34" + "ÉCOL" and spotsigs.edited(odd).count() == 10
    assert spotsigs.edited(none).count() == 0 and spotsigs.edited(odd.where("doc_id = 3")).first()["edited_text"] == ""


def test_similar_pairs(spark):
    rng = random.Random(6)
    words = [f"c{i}" for i in range(60)]
    texts = [" ".join(f"the {rng.choice(words)} {rng.choice(words)}" for _ in range(rng.randint(1, 60))) for _ in range(25)]
    for t in list(texts):
        for _ in range(3):
            w = t.split()
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
    docs = spark.createDataFrame([(t,) for t in texts + texts[:5]], "text string")
    sets = {frozenset(r["s"]) for r in spotsigs.with_signatures(docs, "text", "s").collect()}
    name = {s: hashlib.sha256("".join(sorted(s)).encode()).hexdigest() for s in sets}
    want = {tuple(sorted((name[a], name[b]))) for a in sets for b in sets if a != b and len(a & b) >= 0.8 * len(a | b)}
    assert want and {(r["a"], r["b"]) for r in spotsigs.similar_pairs(docs).collect()} == want


# WARC


def test_warc(spark, tmp_path):
    html = (
        "<html><head><title>A &amp; B</title><style>p{}</style></head><body><script>var t='</p>';</script><!-- x --><p>One&nbsp;two &#233;&#0;</p>"
        '<a href="/x#f">l</a><a class=k href="y?a=1&amp;b=2">m</a><a href="//h/z">n</a><a href="#top">o</a><a href="mailto:a@b">p</a><br>&lt;end&gt;</body>'
    )
    pages = [(1, "http://e.org/d/p", html), (1, "http://e.org/d/p", html), (2, None, None), (None, "http://e.org\nX", "")]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, block string")
    records = warc.derived(warc.page_responses(df))
    rows = records.collect()
    assert len(rows) == 8 and warc.derived(warc.page_responses(df.limit(0))).count() == 0
    meta = next(r for r in rows if r["page_id"] == 1 and r["warc_type"] == "metadata")
    text = next(r for r in rows if r["page_id"] == 1 and r["warc_type"] == "conversion")
    assert text["block"] == "One two é&#0;\nlmnop\n<end>" and text["refers_to"] == meta["refers_to"] != text["record_id"]
    assert [x for x in meta["block"].split("\r\n") if x.startswith("outlink")] == [
        f"outlink: {u} L a/@href" for u in ("http://e.org/x", "http://e.org/d/y?a=1&b=2", "http://h/z")
    ]
    assert "title: A & B\r\n" in meta["block"] and meta["source_digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    assert all(r["content_length"] == len(r["block"].encode()) and "\n" not in r["target_uri"] for r in rows)
    warc.write_warc(records.coalesce(1), str(tmp_path / "out"))
    (path,) = (tmp_path / "out").glob("*.gz")
    data, parsed = gzip.decompress(path.read_bytes()), []
    while data:
        header, data = data.split(b"\r\n\r\n", 1)
        fields = dict(x.split(": ", 1) for x in header.decode().split("\r\n")[1:])
        n = int(fields["Content-Length"])
        assert data[n : n + 4] == b"\r\n\r\n"
        parsed.append((fields["WARC-Record-ID"], data[:n].decode()))
        data = data[n + 4 :]
    assert sorted(parsed) == sorted((r["record_id"], r["block"]) for r in rows)


def test_references(spark):
    texts = [f"a&{name}b" for name in html.entities.html5] + [f"a&{name[:-1]} b" for name in html.entities.html5 if name.endswith(";")]
    texts += [f"&#{i};&#x{i:x};&#X{i:X} &#00{i}z" for i in (9, 38, 233, 8212, 65533, 128512)]
    texts += [f"&#{i};&#x{i:x};" for i in range(128, 160)]
    texts += ["caf&#xE9; &eacute;&mdash;&hellip;", "&amp;eacute; &amp;#233; &#38;amp; &&amp;&", "&copy2020 &notit; &notin; &", "?a=1&copy=2", "&nosuch; &; &# &#; &#x;", "", "x", None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string").transform(lambda df: warc.with_unescaped(df, "t", "u")).collect()
    want = [t if t is None else html.unescape(t) for t in texts]
    assert [(texts[r["i"]], r["u"]) for r in got if r["u"] != want[r["i"]]] == []
    invalid = "&#0; &#xD800; &#1114112; &#x110000; &#12345678901;"
    assert warc.with_unescaped(spark.createDataFrame([(invalid,)], "t string"), "t", "u").first()["u"] == invalid


def test_references_of_given_pages(spark, sf):
    """The references of the given pages are those that the SQL lists."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    given = {"&amp;": "&", "&copy;": "©", "&middot;": "·"}
    assert set(re.findall(r"&#?\w*;?", " ".join(r["html"] for r in pages.collect()))) == set(given)
    assert dict(oracles.PAGE_REFERENCES) | {"&amp;": "&"} == dict(oracles.PAGE_REFERENCES) | given
    got = {(r["page_id"], r["warc_type"]): r["block"] for r in warc.derived(warc.page_responses(pages)).collect()}
    sql = duck(sf).execute(oracles.SQL["op10_warc"])
    names = [d[0] for d in sql.description]
    want = {(r["page_id"], r["warc_type"]): r["block"] for r in (dict(zip(names, x)) for x in sql.fetchall())}
    assert got == want and sum("©" in b and "·" in b for b in got.values()) == len(got) // 2


def test_very_long_page(spark):
    """A page of some megabytes: all its text, references and links are there."""
    rows = 20_000
    html_text = "<html><head><title>T &amp; t</title></head><body>" + "".join(f"<p>row {i} &copy; <a href='/x{i}'>l</a></p>" for i in range(rows)) + "</body></html>"
    pages = spark.createDataFrame([(1, "http://h.example/a", html_text)], "page_id long, url string, html string")
    got = {r["warc_type"]: r for r in warc.derived(warc.page_responses(pages)).collect()}
    lines = got["conversion"]["block"].split("\n")
    assert lines == [f"row {i} © l" for i in range(rows)] and "title: T & t" in got["metadata"]["block"]
    assert got["metadata"]["block"].count("outlink: ") == rows and got["conversion"]["content_length"] == len(got["conversion"]["block"].encode())


def test_similar_pairs_odd(spark, odd, none):
    """Null, empty and white texts share one fingerprint and are no pair; repeated rows
    count once; no rows give no pairs."""
    assert spotsigs.similar_pairs(none).count() == 0 == spotsigs.similar_pairs(odd).count()
    near = [(i, "the quick fox the lazy dog the red cat the blue cow the old man " + ("" if i % 2 else "the new car")) for i in range(6)]
    more = odd.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    assert [round(r["likeness"], 6) for r in spotsigs.similar_pairs(more).collect()] == [round(5 / 6, 6)]


def test_level_of_equal_sources():
    assert math.isclose(sum(water_level({"a": 10, "b": 10, "c": 10}, {"a": 5, "b": 2, "c": 1}).values()), 45)
