"""Language identification by a byte convolutional network.

Filters of several widths slide over the bytes of fixed-length windows, the
strongest response of each filter in a window is kept, and a softmax layer turns
these into probabilities of languages. A text's probabilities are the means of
its windows'. Trained with numpy on a bounded sample, applied in batches.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import HASH_BITS, Names, materialize, prepared, seeded

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
BATCH = 512
PAD = 0  # byte 0 fills the last window of a text
# Bounds of the training sample.
DOCS_PER_LANGUAGE = 500
DOCS = 20_000
WINDOWS_PER_DOC = 3
EPOCHS = 6
# Held-out documents of the 0.1 scale score 0.50 at least, nine in ten of them with their
# characters shuffled below 0.03. The score is a probability beside that of no language,
# so it does not depend on how many languages there are.
MIN_SCORE = 0.3
UNDETERMINED = "und"


def windows_of(text: str, most: int = None) -> np.ndarray:
    """The bytes of the lower-cased text as rows of WINDOW bytes, the last one
    padded; each row but the first repeats the last bytes of the one before."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    step = WINDOW - max(WIDTHS) + 1
    rows = max(1, -(-(len(data) - max(WIDTHS) + 1) // step))
    if most:
        rows = min(rows, most)
    out = np.full((rows - 1) * step + WINDOW, PAD, np.uint8)
    out[: min(len(data), out.size)] = data[: out.size]
    return np.lib.stride_tricks.sliding_window_view(out, WINDOW)[::step]


@dataclass
class ByteConv:
    """langs, per width k an array (k, 256, FILTERS), biases, and the output layer."""

    langs: list[str]
    kernels: list[np.ndarray]
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, langs: list[str], seed: int = 5) -> ByteConv:
        rng = np.random.default_rng(seed)
        kernels = [rng.normal(0, 0.3 / k**0.5, (k, 256, FILTERS)).astype(np.float32) for k in WIDTHS]
        out = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(langs) + 1)).astype(np.float32)
        return cls(langs, kernels, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, np.zeros(len(langs) + 1, np.float32))

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Features (rows, filters) and where each filter responds most."""
        values, places = [], []
        for k, kernel, bias in zip(WIDTHS, self.kernels, self.bias):
            n = x.shape[1] - k + 1
            response = kernel[0][x[:, :n]]
            for i in range(1, k):
                response += kernel[i][x[:, i : i + n]]
            at = response.argmax(1)
            places.append(at)
            values.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0] + bias)
        return np.maximum(np.concatenate(values, 1), 0), places

    def softmax(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.out + self.out_bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, batch: int = 64, seed: int = 5) -> ByteConv:
        """Adam on the cross entropy. Only the strongest place of a filter has a
        gradient, so a step touches k bytes per filter and window."""
        rng, state, step = np.random.default_rng(seed), {}, 0
        params = [*self.kernels, *self.bias, self.out, self.out_bias]
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
                xb, step = x[rows], step + 1
                features, places = self.pooled(xb)
                error = self.softmax(features)
                error[np.arange(len(rows)), y[rows]] -= 1
                error /= len(rows)
                back = (error @ self.out.T) * (features > 0)
                grads_k, grads_b = [], []
                for w, (k, at) in enumerate(zip(WIDTHS, places)):
                    part = back[:, w * FILTERS : (w + 1) * FILTERS]
                    grad = np.zeros_like(self.kernels[w])
                    for i in range(k):
                        np.add.at(grad[i], (np.take_along_axis(xb, at + i, 1), np.arange(FILTERS)[None]), part)
                    grads_k.append(grad)
                    grads_b.append(part.sum(0))
                for i, (p, g) in enumerate(zip(params, [*grads_k, *grads_b, features.T @ error, error.sum(0)])):
                    m, v = state.get(i, (0.0, 0.0))
                    m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                    state[i] = m, v
                    p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def tables(self) -> list[list[tuple[int, np.ndarray]]]:
        """For each width, lookups (offset, table) that sum up to its response. Two
        neighbouring bytes are looked up at once, in a table of byte pairs."""
        out = []
        for k, kernel in zip(WIDTHS, self.kernels):
            steps = [(i, (kernel[i][:, None] + kernel[i + 1][None]).reshape(65536, FILTERS)) for i in range(0, k - 1, 2)]
            out.append(steps + ([(k - 1, kernel[k - 1])] if k % 2 else []))
        return out

    def probabilities(self, x: np.ndarray, tables: list) -> np.ndarray:
        pairs = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        values = []
        for k, steps, bias in zip(WIDTHS, tables, self.bias):
            n, response = x.shape[1] - k + 1, None
            for i, lookup in steps:
                got = lookup.take((pairs if len(lookup) > 256 else x)[:, i : i + n], axis=0)
                response = got if response is None else np.add(response, got, out=response)
            values.append(response.max(1) + bias)
        return self.softmax(np.maximum(np.concatenate(values, 1), 0))


def labelled_sample(docs: DataFrame, allowed: Column, seed: int = 5, per_language: int = DOCS_PER_LANGUAGE, most: int = DOCS) -> pd.DataFrame:
    """At most ``per_language`` documents of each language and ``most`` in all,
    by seeded hash, as rows of lang and ``pieces``: at most WINDOWS_PER_DOC pieces of
    WINDOW characters from seeded places of the whole text."""
    rows = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull())
    hashed = rows.select("doc_id", "lang", seeded(seed, F.col("doc_id")).alias("_h"))
    # Of a language with many rows only hashes below a bound go on, four times as
    # many as asked for, so its ranks are no work for one task.
    counts = materialize(rows.groupBy("lang").agg(F.count("*").alias("_rows")), "languages")
    bound = F.lit(float(4 * per_language << HASH_BITS)) / F.col("_rows")
    hashed = hashed.join(counts, "lang").where(F.col("_h") < bound)
    ranks = hashed.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id")))
    chosen = ranks.where(F.col("_r") <= per_language).orderBy("_r", "_h", "lang").limit(most).select("doc_id", "lang")
    places = F.greatest(F.length("text") - WINDOW + 1, F.lit(1))
    start = lambda i: (F.pmod(F.xxhash64("doc_id", i, F.lit(seed)), places) + 1).cast("int")
    pieces = F.transform(F.sequence(F.lit(1), F.lit(WINDOWS_PER_DOC)), lambda i: F.substring("text", start(i), F.lit(WINDOW)))
    texts = rows.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").dropDuplicates(["doc_id", "lang"])
    return texts.select("doc_id", "lang", F.array_distinct(pieces).alias("pieces")).toPandas()


def trained(sample: pd.DataFrame) -> ByteConv | None:
    """A network for the languages of the sample; None if it has no text."""
    sample = sample.assign(pieces=[[p for p in ps if has_letter(p)] for ps in sample["pieces"]])
    sample = sample[sample["pieces"].map(len) > 0].sort_values(["lang", "doc_id"])
    langs = sorted(sample["lang"].unique())
    if not langs:
        return None
    windows, labels, rng = [], [], random.Random(5)
    for pieces, lang in zip(sample["pieces"], sample["lang"]):
        # Also some words alone, so that short texts are known.
        some = pieces[0][: 12 + sum(map(len, pieces)) % 40]
        rows = np.concatenate([windows_of(p, 1) for p in [*pieces, some]])
        windows.append(rows)
        labels += [langs.index(lang)] * len(rows)
        windows.append(np.concatenate([windows_of(t, 1) for t in unlike(pieces[0], rng)]))
        labels += [len(langs)] * len(windows[-1])
    return ByteConv.fresh(langs).fit(np.concatenate(windows), np.array(labels))


def unlike(piece: str, rng: random.Random) -> list[str]:
    """Texts of no language, to learn from: the characters of a piece shuffled, and its
    shape (words and spaces) in letters drawn from some 40 that lie together."""
    mixed = rng.sample(piece, len(piece))
    low = rng.choice((0x61, 0xC0, 0x100, 0x370, 0x400, 0x5D0, 0x620, 0x900, 0x3041, 0x4E00, 0xAC00)) + rng.randrange(24)
    drawn = rng.choices([chr(low + i) for i in range(40)], [1 / (i + 1) for i in range(40)], k=len(piece))
    return ["".join(mixed), "".join(c if c.isspace() else d for c, d in zip(piece, drawn))]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def predictor(model: ByteConv | None):
    """A Pandas UDF from text to (lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = model.tables() if model else None
        for texts in parts:
            known = np.array([model is not None and has_letter(t) for t in texts], bool)
            sums, counts = np.zeros((len(texts), len(model.langs) + 1 if model else 1)), np.zeros(len(texts), np.int64)
            held, owners = [], []

            def flush():
                x, who = np.concatenate(held), np.concatenate(owners)
                for at in range(0, len(x), BATCH):
                    np.add.at(sums, who[at : at + BATCH], model.probabilities(x[at : at + BATCH], tables))
                held.clear(), owners.clear()

            for i in np.flatnonzero(known):
                rows = windows_of(texts.iloc[i])
                counts[i] = len(rows)
                held.append(rows)
                owners.append(np.full(len(rows), i))
                if sum(map(len, held)) >= 4 * BATCH:
                    flush()
            if held:
                flush()
            means = sums / np.maximum(counts, 1)[:, None]
            means = means[:, : max(len(model.langs), 1)] if model else means
            best = means.argmax(1)
            names = np.where(known, np.array(model.langs if model else [UNDETERMINED], object)[best], UNDETERMINED)
            yield pd.DataFrame({"lang_pred": names, "score": np.where(known, np.clip(means.max(1), 0, 1), 0.0)})

    return predict


def held_out(doc_id: Column) -> Column:
    """One document in three is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identified(docs: DataFrame, allowed: Column = None) -> DataFrame:
    """Documents with ``lang_pred`` and ``score`` added (columns of these names are
    replaced). Learned from a bounded sample of rows that are ``allowed`` and have
    a lang; a prediction reads the whole text and nothing else.

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text if there is nothing to learn from. Equal texts get equal results.
    """
    prepared(docs.sparkSession)
    model = trained(labelled_sample(docs, allowed if allowed is not None else ~held_out(F.col("doc_id"))))
    rows = docs.drop("lang_pred", "score")
    found = Names(rows).new("found")
    rows = rows.withColumn(found, predictor(model)("text"))
    return rows.select("*", f"{found}.lang_pred", f"{found}.score").drop(found)


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents whose language is known with a score of ``min_score`` or more.

    Null and empty texts and those without a letter go, as does text that is like
    shuffled characters or foreign letters (see ``unlike``); without anything to learn
    from all go. Rows and columns are kept as they are, repeated rows included.
    """
    made = Names(docs).new("found")
    prepared(docs.sparkSession)
    model = trained(labelled_sample(docs, ~held_out(F.col("doc_id"))))
    found = F.col(made)
    rows = docs.withColumn(made, predictor(model)("text"))
    return rows.where((found["lang_pred"] != UNDETERMINED) & (found["score"] >= min_score)).drop(made)
