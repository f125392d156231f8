"""Token ids in compressed binary blocks.

A document's ids are cut into blocks of at most BLOCK ids. Each block is coded on
its own by an adaptive range coder that mixes three predictions of the next id: the
id that followed the last two before (order 2), the one that followed the last
(order 1), and a law over all ids (order 0). The weights of the mix adapt to how
often each was right in the same state. The law of order 0 counts the block's ids in
classes, four to an octave, and is renewed at growing distances; within a class all
ids are alike, so the bits below an id's class are kept as they are.

Numpy codes many blocks in step, one id of each at a time.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from paddock.llm.common import materialize, prepared

BLOCK = 1024
LANES = 3072
TOTAL_BITS = 14
RATE = 5
# Bounds of a weight. Both weights together stay below the total by a 64th.
LEAST, MOST = 32, (1 << TOTAL_BITS) - (1 << TOTAL_BITS) // 64 - 32
STATES = 8
TABLE_BITS = 10
LAW_BITS = 10
# Steps at which the laws of order 0 are renewed, besides every 512th.
RENEWED = (12, 32, 80, 200)
# A span is kept from LOW up to SPAN; 32 bits are put out at a time.
SPAN_BITS, LOW_BITS = 62, 30
MAGIC = b"RCB2"
END_ID = 2
CACHE = 1_500_000
CACHE_CHARS = 24_000_000
BATCH_BYTES = 4_000_000
NONE = 65535


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """The class of each id, and how many low bits its class leaves open."""
    ids = np.arange(1 << 16)
    low = np.maximum(np.frexp(ids.astype(np.float64))[1] - 3, 0)
    return (low << 2) + (ids >> low), low


CLASS, OPEN = _classes()
CLASSES = int(CLASS[-1]) + 1
BASE = np.searchsorted(CLASS, np.arange(CLASSES))
CLASS, OPEN = CLASS.astype(np.uint8), OPEN[BASE]


class Model:
    """Predictions and weights of many blocks."""

    def __init__(self, lanes: int):
        # What followed the last id, and the last two, side by side for each block.
        self.tables = np.arange(lanes) << TABLE_BITS + 1
        self.after = np.full(lanes << TABLE_BITS + 1, NONE, np.uint16)
        self.weights1 = np.full(lanes * STATES, 1 << TOTAL_BITS - 3, np.int64)
        self.weights2 = self.weights1.copy()
        self.hit_states = np.arange(lanes) * STATES + 4
        self.states = self.hit_states - 4
        self.hash1, self.hash2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.counts = np.ones(lanes * CLASSES, np.int32)
        self.first = np.arange(lanes) * CLASSES

    def predict(self, n: int) -> None:
        """Ids guessed by orders 1 and 2, and their weights, for the first n blocks."""
        self.at1, self.at2 = self.hash1[:n] >> 3, self.hash2[:n] >> 3
        for at in (self.at1, self.at2):
            at &= (1 << TABLE_BITS) - 1
            at += self.tables[:n]
        self.at2 += 1 << TABLE_BITS
        self.guess1, self.guess2 = self.after.take(self.at1), self.after.take(self.at2)
        row = (self.guess2 != NONE).view(np.int8) + 2 * (self.guess1 == self.guess2).view(np.int8)
        self.row = self.states[:n] + row
        self.weight1, self.weight2 = self.weights1.take(self.row), self.weights2.take(self.row)

    def update(self, n: int, ids: np.ndarray, at: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        """Learn the ids that came, their classes' places in the counts, and who was right."""
        self.after[self.at1] = ids
        self.after[self.at2] = ids
        for weights, weight, hit in ((self.weights1, self.weight1, hit1), (self.weights2, self.weight2, hit2)):
            step = hit.astype(np.int64)
            step *= MOST - LEAST
            step += LEAST
            step -= weight
            step >>= RATE
            step += weight
            weights[self.row] = step
        miss = (~(hit1 | hit2)).astype(np.int64)
        miss <<= 2
        self.counts[at] = self.counts.take(at) + miss.astype(np.int32)
        self.states[:n] = self.hit_states[:n] - miss
        self.hash2[:n] = self.hash1[:n] * 25717
        np.multiply(ids, 40503, out=self.hash1[:n], dtype=np.int64)
        self.hash2[:n] += self.hash1[:n]

    def laws(self) -> np.ndarray:
        """Where the range of each class begins in each block, and its width, in one number."""
        counts = self.counts.reshape(-1, CLASSES)
        ends = np.cumsum(counts, axis=1, dtype=np.int64)
        ends *= (1 << LAW_BITS) - CLASSES
        ends //= counts.sum(axis=1, keepdims=True)
        ends += np.arange(1, CLASSES + 1)
        widths = np.diff(ends, axis=1, prepend=0)
        return (ends - widths << 16 | widths).ravel().astype(np.int32)


def _groups(sizes: np.ndarray) -> list[np.ndarray]:
    """Blocks to code in step, about LANES at a time and as many in each group. Longest
    blocks come first, so that those still running are a prefix."""
    order = np.argsort(-sizes, kind="stable")
    return np.array_split(order, max(1, round(len(order) / LANES))) if len(order) else []


def _running(sizes: np.ndarray) -> list[int]:
    """How many blocks have an id at each step."""
    return np.searchsorted(-sizes, -np.arange(sizes[0]), side="left").tolist()


def encode(blocks: list[np.ndarray]) -> list[bytes]:
    """Code each array of ids (below 65535) into bytes."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    out: list[bytes] = [b""] * len(blocks)
    for part in _groups(sizes):
        for i, data in zip(part, _encode([blocks[i] for i in part], sizes[part])):
            out[i] = data
    return out


def _encode(blocks: list[np.ndarray], sizes: np.ndarray) -> list[bytes]:
    lanes, steps = len(blocks), int(sizes[0])
    ids = np.zeros((lanes, steps), np.uint16)
    ids[np.arange(steps) < sizes[:, None]] = np.concatenate(blocks)
    ids = np.ascontiguousarray(ids.T)
    model = Model(lanes)
    low, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << SPAN_BITS, np.int64)
    # Words of 32 bits, and a 33rd one that is carried to the word before, with their blocks.
    words, of = [], []
    for t, n in enumerate(_running(sizes)):
        if t in RENEWED or t & 511 == 0:
            law = model.laws()
        now = ids[t, :n]
        model.predict(n)
        hit2 = model.guess2 == now
        hit1 = (model.guess1 == now) > hit2
        unit = span[:n] >> TOTAL_BITS
        by2, by1 = unit * model.weight2, unit * model.weight1
        add = by2 + by1
        unit <<= TOTAL_BITS
        unit -= add
        unit >>= LAW_BITS
        kind = CLASS.take(now).astype(np.int64)
        at = model.first[:n] + kind
        share = law.take(at).astype(np.int64)
        add += unit * (share >> 16)
        share &= 65535
        unit *= share
        unit >>= OPEN.take(kind)
        add += unit * (now - BASE.take(kind))
        np.copyto(add, by2, where=hit1)
        np.copyto(unit, by1, where=hit1)
        np.copyto(add, 0, where=hit2)
        np.copyto(unit, by2, where=hit2)
        add += low[:n]
        go = np.flatnonzero(unit < 1 << LOW_BITS)
        put = add.take(go)
        words.append(put >> LOW_BITS)
        of.append(go.astype(np.uint16))
        add[go] = (put & (1 << LOW_BITS) - 1) << 32
        unit[go] <<= 32
        low[:n], span[:n] = add, unit
        model.update(n, now, at, hit1, hit2)
    words.append(low + (1 << LOW_BITS) - 1 >> LOW_BITS)
    of = np.concatenate([*of, np.arange(lanes, dtype=np.uint16)])
    coded, sizes = np.concatenate(words)[np.argsort(of, kind="stable")], np.bincount(of, minlength=lanes)
    while (carry := coded >> 32).any():
        coded &= (1 << 32) - 1
        coded[:-1] += carry[1:]
    data, ends = coded.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def decode(payloads: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    sizes = np.array(sizes, np.int64)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(payloads)
    for part in _groups(sizes):
        for i, ids in zip(part, _decode([payloads[i] for i in part], sizes[part])):
            out[i] = ids
    return out


def _decode(payloads: list[bytes], sizes: np.ndarray) -> list[np.ndarray]:
    lanes, steps = len(payloads), int(sizes[0])
    # Behind each payload's words come two of zeros.
    words = np.frombuffer(bytes(8).join([*payloads, bytes(8)]), "<u4").astype(np.int64)
    begins = np.cumsum([0, *[len(p) // 4 + 2 for p in payloads[:-1]]])
    code = words[begins] << 30 | words[begins + 1] >> 2
    # The span has 62 bits, so that words are read two bits late.
    late, read = (words[:-1] & 3) << 30 | words[1:] >> 2, begins + 1
    span = np.full(lanes, 1 << SPAN_BITS, np.int64)
    model = Model(lanes)
    ids = np.zeros((steps, lanes), np.uint16)
    slots, numbers = np.arange(lanes) << LAW_BITS, np.tile(np.arange(CLASSES, dtype=np.uint8), lanes)
    for t, n in enumerate(_running(sizes)):
        if t in RENEWED or t & 511 == 0:
            law = model.laws()
            slot = np.repeat(numbers, law & 65535)
        model.predict(n)
        now, unit = code[:n], span[:n] >> TOTAL_BITS
        by2, by1 = unit * model.weight2, unit * model.weight1
        both = by2 + by1
        hit2 = now < by2
        hit1 = (now < both) > hit2
        unit <<= TOTAL_BITS
        unit -= both
        unit >>= LAW_BITS
        left = now - both
        place = left // unit
        place += slots[:n]
        kind = slot.take(place, mode="clip")
        at = model.first[:n] + kind
        share = law.take(at).astype(np.int64)
        left -= unit * (share >> 16)
        share &= 65535
        unit *= share
        unit >>= OPEN.take(kind)
        rest = left // unit
        left -= unit * rest
        rest += BASE.take(kind)
        found = rest.astype(np.uint16)
        np.copyto(found, model.guess1, where=hit1)
        np.copyto(found, model.guess2, where=hit2)
        np.copyto(left, now - by2, where=hit1)
        np.copyto(left, now, where=hit2)
        np.copyto(unit, by1, where=hit1)
        np.copyto(unit, by2, where=hit2)
        go = np.flatnonzero(unit < 1 << LOW_BITS)
        here = read.take(go)
        left[go] = left.take(go) << 32 | late.take(here, mode="clip")
        read[go] = here + 1
        unit[go] <<= 32
        ids[t, :n], code[:n], span[:n] = found, left, unit
        model.update(n, found, at, hit1, hit2)
    ids = np.ascontiguousarray(ids.T)
    return [row[:n].astype("<u4") for row, n in zip(ids, sizes.tolist())]


def framed(payload: bytes, ids: np.ndarray) -> bytes:
    """magic, number of ids, CRC-32 of the ids, CRC-32 of the payload, payload."""
    head = np.array([len(ids), zlib.crc32(ids.astype("<u4")), zlib.crc32(payload)], "<u4")
    return MAGIC + head.tobytes() + payload


def unframed(blocks: list[bytes]) -> list[np.ndarray]:
    """Ids of framed blocks. Raises if one is damaged."""
    heads = [np.frombuffer(b, "<u4", 3, 4).tolist() for b in blocks]
    payloads = [b[16:] for b in blocks]
    for b, head, payload in zip(blocks, heads, payloads):
        if b[:4] != MAGIC or zlib.crc32(payload) != head[2]:
            raise ValueError("damaged block")
    arrays = decode(payloads, [h[0] for h in heads])
    for ids, head in zip(arrays, heads):
        if zlib.crc32(ids) != head[1]:
            raise ValueError("block does not decode to its ids")
    return arrays


class Encoder:
    """The tokenizer, with the ids of pieces of texts kept.

    The vocabulary is byte-level BPE; its pre-tokenizer always cuts before a space
    that follows anything but white space, so a text may be cut there and each piece
    coded alone. Arrow cuts texts at every space and finds the distinct words; texts
    with spaces that follow white space are cut one by one.

    Words are cut further where the pre-tokenizer cuts whatever stands around: behind
    letters that ASCII marks follow, and behind a line end that stands alone.
    """

    CUTS = re.compile(r"(?<=\S)(?= )")
    SPACE = re.compile(r"\s")
    # For Arrow, whose own class of white space is that of ASCII.
    SOLID = r"([^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])"
    AFTER_LETTERS = (r"([A-Za-zÀ-ÖØ-öø-ÿ])([!-@\[-`{-~\n])", r"\1 \2")
    AFTER_LINE_END = (SOLID + r"\n" + SOLID, "\\1\n \\2")
    JOINED = 2000

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        # Tasks share the cores already.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        # The same model for words of ASCII letters, which need no pattern to be told apart.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = WhitespaceSplit()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        [self.line_end] = self.tokenizer.encode("\n", add_special_tokens=False).ids
        # Tokens that begin with the byte of a space, which the vocabulary writes as this letter.
        self.spaced = np.zeros(NONE + 1, bool)
        self.spaced[[i for token, i in self.tokenizer.get_vocab().items() if token[0] == "\u0120"]] = True
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        # Ids of all known pieces behind each other, and in how many batches a piece came, up to 2.
        self.ids, self.starts = np.zeros(0, np.uint16), np.zeros(1, np.int64)
        self.seen, self.chars = np.zeros(0, np.int8), 0

    def _bound(self) -> None:
        """Forget pieces that came in one batch only when too many are known, or all."""
        if len(self.number) <= CACHE and self.chars <= CACHE_CHARS:
            return
        kept = [(p, i) for p, i in self.number.items() if self.seen[i] > 1]
        if len(kept) > CACHE * 3 // 4 or sum(len(p) for p, _ in kept) > CACHE_CHARS * 3 // 4:
            kept = []
        numbers = np.array([i for _, i in kept], np.int64)
        ids, sizes = self._ids(numbers)
        self._forget()
        self._add([p for p, _ in kept], ids, sizes)

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        self._bound()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy()
        begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        coded = cut.flatten().dictionary_encode()
        index, words = coded.indices.to_numpy(), coded.dictionary
        # A word that is empty or ends in white space must not be the one before a cut.
        size = pc.binary_length(words)
        closed = pc.and_(pc.equal(pc.binary_length(pc.utf8_rtrim_whitespace(words)), size), pc.greater(size, 0))
        open_end = ~closed.to_numpy(zero_copy_only=False)[index]
        open_end[ends - 1] = False
        loose = np.flatnonzero(np.logical_or.reduceat(open_end, begins)).tolist()
        plain = np.ones(len(index), bool)
        plain[begins] = False
        for i in loose:
            plain[begins[i] : ends[i]] = False
        used = np.flatnonzero(np.bincount(index[plain], minlength=len(words)))
        # Words behind a space, and then the first of each text.
        rows = {i: [p for p in self.CUTS.split(texts[i].as_py()) if p] for i in loose}
        chosen = np.concatenate([used, index[begins]])
        parts = self._parts(words.take(pa.array(chosen)), len(used))
        n_parts = np.diff(parts.offsets.to_numpy())
        pieces = parts.values.dictionary_encode()
        found = self._numbers([*pieces.dictionary.to_numpy(zero_copy_only=False).tolist(), *(p for row in rows.values() for p in row)])
        ids, sizes = self._ids(found[pieces.indices.to_numpy()])
        word_ends = np.cumsum(sizes)[np.cumsum(n_parts) - 1]
        word_sizes = np.append(np.diff(word_ends, prepend=0), 1)
        ids, word_starts = np.append(ids, np.uint16(END_ID)), np.append(word_ends, len(ids) + 1) - word_sizes
        place = np.zeros(len(words), np.int64)
        place[used] = np.arange(len(used))
        sequence = place[index]
        sequence[begins] = np.arange(len(used), len(chosen))
        sequence = np.insert(sequence, ends, len(chosen))
        sizes = word_sizes[sequence]
        row_ends = np.cumsum(sizes)[ends + np.arange(len(ends))]
        out = np.split(_gathered(ids, word_starts[sequence], sizes), row_ends[:-1])
        at = len(pieces.dictionary)
        for i, row in rows.items():
            out[i] = np.append(self._ids(found[at : at + len(row)])[0], np.uint16(END_ID))
            at += len(row)
        return out

    def _parts(self, words: pa.Array, n: int) -> pa.ListArray:
        """Words, which hold no space, in parts. The first n have a space before them."""
        whole = pc.utf8_is_alpha(words)
        for content in self.added:
            whole = pc.or_(whole, pc.match_substring(words, content))
        mixed = pc.invert(whole)
        cut = words.filter(mixed)
        lines = pc.match_substring(cut, "\n")
        cut = pc.replace_with_mask(cut, lines, pc.replace_substring_regex(cut.filter(lines), *self.AFTER_LINE_END))
        cut = pc.replace_substring_regex(cut, *self.AFTER_LETTERS)
        parts = pc.split_pattern(pc.replace_with_mask(words, mixed, cut), " ")
        spaced = np.zeros(len(parts.values), bool)
        spaced[parts.offsets.to_numpy()[:n]] = True
        prefix = pc.if_else(pa.array(spaced), pa.scalar(" ", words.type), pa.scalar("", words.type))
        return type(parts).from_arrays(parts.offsets, pc.binary_join_element_wise(prefix, parts.values, pa.scalar("", words.type)))

    def _numbers(self, pieces: list[str]) -> np.ndarray:
        """Numbers of pieces; those that are new are learned."""
        found = list(map(self.number.get, pieces))
        if None in found:
            new = [i for i, n in enumerate(found) if n is None]
            self._learn({pieces[i] for i in new})
            for i in new:
                found[i] = self.number[pieces[i]]
        found = np.array(found, np.int64)
        self.seen[found] = np.minimum(self.seen[found], 1) + 1
        return found

    def _ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered pieces behind each other, and how many each piece has."""
        starts = self.starts[numbers]
        sizes = self.starts[numbers + 1] - starts
        return _gathered(self.ids, starts, sizes), sizes

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        known = len(self.seen)
        self.number.update(zip(pieces, range(known, known + len(pieces))))
        self.ids = np.concatenate([self.ids, ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.seen = np.concatenate([self.seen, np.zeros(len(pieces), np.int8)])
        self.chars += sum(map(len, pieces))

    def _learn(self, fresh: set[str]) -> None:
        """Code pieces with the tokenizer. Many that begin with their only space, and many
        without white space, are coded as one text."""
        letters, spaced, solid, others = [], [], [], []
        for p in fresh:
            if p.isascii() and p[0:1] == " " and p[1:].isalpha():
                letters.append(p)
            elif p.rfind(" ") == 0 and not p[-1].isspace():
                spaced.append(p)
            elif p and not self.SPACE.search(p):
                solid.append(p)
            else:
                others.append(p)
        ids, sizes = [], []
        for kind, mark in ((letters, ""), (spaced, ""), (solid, "\n")):
            for at in range(0, len(kind), self.JOINED):
                part = kind[at : at + self.JOINED]
                if kind is letters:
                    coded = self._coded("".join(part).replace(" ", " \u0120"), self.letters)
                else:
                    coded = self._coded(mark.join(part), self.tokenizer)
                if mark:
                    marks = coded == self.line_end
                    begins = np.append(0, np.flatnonzero(marks) - np.arange(len(part) - 1))
                    coded = coded[~marks]
                else:
                    begins = np.flatnonzero(self.spaced[coded])
                ids.append(coded)
                sizes.append(np.diff(begins, append=len(coded)))
        for p in others:
            ids.append(self._coded(p, self.tokenizer))
            sizes.append([len(ids[-1])])
        self._add([*letters, *spaced, *solid, *others], np.concatenate(ids), np.concatenate(sizes))

    @staticmethod
    def _coded(text: str, tokenizer) -> np.ndarray:
        # A batch of one: this call leaves out the offsets, which are not needed.
        [coded] = tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(coded.ids, np.uint16)


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranges of values behind each other."""
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    at += np.arange(len(at))
    return values[at]


def _batches(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, pa.Array]]:
    """Ids and texts of some batches at a time, BATCH_BYTES or what goes beyond with one more."""
    doc_ids, texts, size = [], [], 0
    for rows in parts:
        doc_ids += rows["doc_id"].to_pylist()
        texts.append(rows["text"].cast(pa.large_string()))
        size += rows["text"].nbytes
        if size >= BATCH_BYTES:
            yield doc_ids, pa.concat_arrays(texts)
            doc_ids, texts, size = [], [], 0
    if texts:
        yield doc_ids, pa.concat_arrays(texts)


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """One encoder for each Python worker, whose pieces later tasks know too."""
    return Encoder(path)


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Blocks of all documents in ascending order of doc_id (null ids last, equal
    ids ordered by text): file part, doc_id, doc (number of the document in its
    part), piece, n_tokens of the piece, and the framed block.

    A null text is empty; every document ends with the end id, so it has a block.
    ``tokenizer`` is the path of a byte-level BPE of the tokenizers library with
    fewer than 65,535 ids, the same on all executors.
    """

    columns = pa.schema([("doc_id", pa.int64()), ("doc", pa.int64()), ("piece", pa.int32()), ("n_tokens", pa.int64()), ("block", pa.binary())])

    def code(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, doc, held, ids = encoder_of(tokenizer), 0, [], []

        def flush() -> pa.RecordBatch:
            blocks = [framed(p, x) for p, x in zip(encode(ids), ids)]
            made = [*zip(*held), [len(x) for x in ids], blocks]
            held.clear()
            ids.clear()
            return pa.record_batch([pa.array(v, f.type) for v, f in zip(made, columns)], columns)

        for doc_ids, texts in _batches(parts):
            for doc_id, coded in zip(doc_ids, encoder(texts)):
                for piece, at in enumerate(range(0, len(coded), BLOCK)):
                    held.append((doc_id, doc, piece))
                    ids.append(coded[at : at + BLOCK])
                doc += 1
            if len(ids) >= LANES:
                yield flush()
        if ids:
            yield flush()

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sorted_rows = rows.repartitionByRange(F.col("doc_id").asc_nulls_last()).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "text")
    blocks = sorted_rows.mapInArrow(code, "doc_id long, doc long, piece int, n_tokens long, block binary")
    return blocks.withColumn("part", F.spark_partition_id())


def write_ids(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Write the blocks as files, in the order of doc_id from part to part."""
    prepared(docs.sparkSession)
    encoded(docs, tokenizer).write.parquet(path)


def read_pieces(blocks: DataFrame, ids: bool = True) -> DataFrame:
    """Decode written blocks and check their sums: doc_id, part, doc, piece,
    n_tokens, crc (CRC-32 of the ids as little-endian unsigned 32-bit integers) and,
    if asked for, these bytes as ``ids``."""

    def load(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            held.clear()
            arrays = unframed(list(rows.pop("block")))
            rows["doc_id"] = rows["doc_id"].astype("Int64")
            rows["crc"] = [zlib.crc32(x) for x in arrays]
            return rows.assign(ids=[x.tobytes() for x in arrays]) if ids else rows

        for rows in parts:
            held.append(rows)
            if sum(map(len, held)) >= LANES:
                yield flush()
        if held:
            yield flush()

    columns = "part int, doc long, doc_id long, piece int, n_tokens long, crc long" + ", ids binary" * ids
    return blocks.select("part", "doc", "doc_id", "piece", "n_tokens", "block").mapInPandas(load, columns)


def read_ids(blocks: DataFrame) -> DataFrame:
    """Documents from written blocks: doc_id, part, doc, n_tokens and all ids as
    little-endian unsigned 32-bit integers."""
    parts = F.sort_array(F.collect_list(F.struct("piece", "ids")))
    rows = read_pieces(blocks).groupBy("part", "doc", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"), parts.alias("parts"))
    return rows.withColumn("ids", F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))).drop("parts")


def _times(matrix: list[int], vector: int) -> int:
    out = 0
    for row in matrix:
        if vector & 1:
            out ^= row
        vector >>= 1
    return out


def _zero_bytes() -> list[list[int]]:
    """What 1, 2, 4, ... zero bytes do to a CRC-32, as matrices over bits."""
    bit = [0xEDB88320] + [1 << k for k in range(31)]
    powers = [bit]
    for _ in range(3 + 40):
        powers.append([_times(powers[-1], row) for row in powers[-1]])
    return powers[3:]


ZERO_BYTES = _zero_bytes()


def combined(first: int, second: int, length: int) -> int:
    """CRC-32 of two joined texts from theirs and the second's length."""
    for matrix in ZERO_BYTES:
        if not length:
            break
        if length & 1:
            first = _times(matrix, first)
        length >>= 1
    return first ^ second


@F.pandas_udf(LongType())
def combined_crc(n_tokens: pd.Series, crcs: pd.Series) -> pd.Series:
    def one(sizes, sums):
        crc = int(sums[0])
        for n, c in zip(sizes[1:], sums[1:]):
            crc = combined(crc, int(c), 4 * int(n))
        return crc

    return pd.Series([one(n, c) for n, c in zip(n_tokens, crcs)])


def read_summary(blocks: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it),
    n_tokens and ids_crc32, from the decoded blocks."""
    pieces = materialize(read_pieces(blocks, ids=False), "pieces")
    per_part = pieces.groupBy("part").agg(F.sum("n_tokens").alias("_ids"))
    # One row per file.
    before = F.coalesce(F.sum("_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_part = per_part.withColumn("_before", before)
    by_piece = F.sort_array(F.collect_list(F.struct("piece", "n_tokens", "crc")))
    docs = pieces.groupBy("part", "doc", "doc_id").agg(F.sum("n_tokens").alias("n_tokens"), by_piece.alias("_pieces"))
    whole = F.when(F.size("_pieces") == 1, F.get("_pieces", F.lit(0))["crc"])
    docs = docs.withColumn("ids_crc32", whole.otherwise(combined_crc("_pieces.n_tokens", "_pieces.crc"))).drop("_pieces")
    earlier = Window.partitionBy("part").orderBy("doc").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("_in_part", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))
    docs = docs.join(per_part, "part").withColumn("start", F.col("_before") + F.col("_in_part"))
    return docs.select("doc_id", "start", "n_tokens", "ids_crc32")
