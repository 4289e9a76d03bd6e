"""Language-model scoring with a weighted backoff automaton.

The model is an n-gram model with hierarchical Dirichlet smoothing: after a
context h a token has probability ``(c(h w) + strength * p(w | h')) / (c(h) + strength)``,
h' being h without its first word; at the bottom stands the add-one unigram
model with one place for unknown tokens. As an automaton each known context is a
state, each seen n-gram an arc with its log-probability, and a failure arc with
weight ``strength / (c(h) + strength)`` leads to the state of h'.

The automaton of a corpus grows with the corpus, so it is never held in one
place. Texts are packed into blocks of a bounded size. A block sends its distinct
n-grams, sorted and packed by key range, to where they are counted over all
training texts, and gets back the counts of those that other blocks have as
well; from these it builds exactly the part of the automaton that its texts can
reach, and traverses each text once from left to right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .arrays import mix
from .frames import Scratch, text_columns

END = b""  # no word is empty
_START = np.uint64(0x9AE16A3B2F90404F)
_BLOCKS = "block long, ids array<{id}>, train binary, ends binary, vocabulary binary, tokens binary, n_tokens long, n_words long, train_tokens long, train_texts long"
_CHUNKS = "part long, block long, at binary, key binary, n binary"
_COUNTED = "block long, at binary, c binary, types long"


def pack(x: np.ndarray) -> bytes:
    """Numbers as compressed planes of bytes: what is small or alike takes little room."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes(), "zstd", asbytes=True) if len(x) else b""


def unpack(raw: bytes, kind: type, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, kind)
    size = np.dtype(kind).itemsize
    flat = pa.decompress(raw, n * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(size, n).T).reshape(-1).view(kind)


class _Words(dict):
    """Word -> number in order of first occurrence."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


@dataclass
class Grams:
    """The distinct n-grams of one length in a block, sorted by (prefix, last word).

    ``prefix`` and ``suffix`` number n-grams one shorter (of length 1: words, the start of a text after the
    last word): the n-gram without its last and without its first word. ``train`` counts training texts alone.
    """

    prefix: np.ndarray
    last: np.ndarray
    suffix: np.ndarray
    train: np.ndarray


@dataclass
class Block:
    """Some texts as word numbers: text i is ``tokens[ends[i]:ends[i + 1]]``, its last token is the end."""

    train: np.ndarray
    ends: np.ndarray
    vocabulary: list[bytes]
    tokens: np.ndarray

    def grams(self, order: int) -> list[Grams]:
        """The n-grams of each length from 1 to ``order``; a text is taken to begin with a start that is no token."""
        size, lengths = len(self.vocabulary), np.diff(self.ends)
        seq = np.insert(self.tokens.astype(np.int64), self.ends[:-1], size)
        own = np.repeat(self.train, lengths + 1)
        ending = seq.copy()  # the n-gram that ends at each place
        words = np.arange(size)
        out = [Grams(np.zeros(size, np.int64), words, np.zeros(size, np.int64), np.bincount(seq, own & (seq < size), size + 1)[:size].astype(np.int64))]
        for _ in range(2, order + 1):
            at = np.flatnonzero((seq[1:] < size) & (ending[:-1] >= 0)) + 1
            code, first, kind = np.unique(ending[at - 1] * size + seq[at], return_index=True, return_inverse=True)
            out.append(Grams(code // size, code % size, ending[at[first]], np.bincount(kind, own[at], len(code)).astype(np.int64)))
            ending = np.full(len(seq), -1, np.int64)
            ending[at] = kind
        return out


def _pack_batches(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, train) as blocks of about ``block_bytes`` of text; a longer text is a block alone."""
    words, tokens, ends, ids, train, size, made = _Words(), [], [0], [], [], 0, 0
    first = TaskContext.get().partitionId() << 32

    def block() -> pa.RecordBatch:
        flat, own = np.concatenate(tokens).astype(np.int32), np.array(train, bool)
        vocabulary = b" ".join(words)  # the end is the empty one
        cols = [
            pa.array([first + made], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays(ids)),
            pa.array([own.astype(np.int8).tobytes()]),
            pa.array([np.array(ends, np.int64).tobytes()]),
            pa.array([len(vocabulary).to_bytes(8, "little") + pa.compress(vocabulary, "zstd", asbytes=True)], pa.binary()),
            pa.array([pack(flat)], pa.binary()),
            *[pa.array([int(x)], pa.int64()) for x in (len(flat), len(words), np.diff(ends)[own].sum(), own.sum())],
        ]
        return pa.RecordBatch.from_arrays(cols, names=[c.split()[0] for c in _BLOCKS.split(", ")])

    for batch in batches:
        for i in range(batch.num_rows):
            raw = (batch.column(1)[i].as_py() or "").encode()
            if size and size + len(raw) > block_bytes:
                yield block()
                words, tokens, ends, ids, train, size, made = _Words(), [], [0], [], [], 0, made + 1
            own = list(map(words.__getitem__, raw.lower().split()))  # bytes: A-Z and ASCII white space alone
            own.append(words[END])
            tokens.append(np.array(own, np.int32))
            ends.append(ends[-1] + len(own))
            ids.append(batch.column(0).slice(i, 1))
            train.append(batch.column(2)[i].as_py())
            size += len(raw) + 1
    if ids:
        yield block()


def _block(row: dict) -> Block:
    size, raw = int.from_bytes(row["vocabulary"][:8], "little"), row["vocabulary"][8:]
    words = pa.decompress(raw, size, "zstd", asbytes=True).split(b" ") if size else [END]
    return Block(
        np.frombuffer(row["train"], np.int8).astype(bool), np.frombuffer(row["ends"], np.int64), words, unpack(row["tokens"], np.int32, row["n_tokens"])
    )


def _chunks(block: int, parts: int, key: np.ndarray, at: np.ndarray, n: np.ndarray, content) -> Iterator[tuple]:
    """Rows for the ranges of keys that are counted together; ``content`` packs the entries of one row."""
    order = np.argsort(key, kind="stable")
    part = ((key[order] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    cut = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    for a, b in zip(cut, cut[1:]):
        if b > a:
            own = order[a:b]
            yield int(part[a]), block, pack(at[own]), content(own), pack(n[own])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=["part", "block", "at", "key", "n"])


def word_keys(vocabulary: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(w, digest_size=8).digest() for w in vocabulary), np.uint64)


def _word_batches(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """The words themselves, without the end, whose count is that of the texts."""
    for batch in batches:
        for row in batch.to_pylist():
            b = _block(row)
            at = np.array([i for i, w in enumerate(b.vocabulary) if w], np.int32)
            words = [w for w in b.vocabulary if w]

            def joined(own: np.ndarray, words=words) -> bytes:
                raw = b" ".join(map(words.__getitem__, own.tolist()))
                return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)

            if words:
                yield _rows(list(_chunks(row["block"], parts, word_keys(words), at, b.grams(1)[0].train[at], joined)))


def _count_words(table: pa.Table) -> pa.Table:
    words, chunks = _Words(), []
    for row in table.to_pylist():
        raw = pa.decompress(row["key"][8:], int.from_bytes(row["key"][:8], "little"), "zstd", asbytes=True).split(b" ")
        chunks.append((row["block"], row["at"], np.array(list(map(words.__getitem__, raw)), np.int64), unpack(row["n"], np.int64, len(raw))))
    total = np.zeros(len(words), np.int64)
    for _, _, kind, n in chunks:
        total[kind] += n  # a chunk holds a word once
    return _counted([(block, at, n, total[kind]) for block, at, kind, n in chunks], int((total > 0).sum()))


def _counted(chunks: list[tuple], types: int) -> pa.Table:
    """For each block the places of its entries that occur elsewhere as well, with their counts, and a row of totals."""
    rows = [(-1, b"", b"", types)]
    for block, at, n, c in chunks:
        shared = np.flatnonzero(c != n)
        if len(shared):
            rows.append((block, pack(unpack(at, np.int32, len(n))[shared]), pack(c[shared]), len(shared)))
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64()]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["block", "at", "c", "types"])


def _count_grams(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    sizes = [int.from_bytes(r["key"][:8], "little") for r in rows]
    keys = np.concatenate([np.cumsum(unpack(r["key"][8:], np.uint64, k), dtype=np.uint64) for r, k in zip(rows, sizes)])
    counts = [unpack(r["n"], np.int64, k) for r, k in zip(rows, sizes)]
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.r_[True, keys[1:] != keys[:-1]]
    total = np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(new))
    c = np.empty(len(keys), np.int64)
    c[order] = total[np.cumsum(new) - 1]
    cut = np.cumsum([0, *sizes])
    return _counted([(r["block"], r["at"], n, c[a:b]) for r, n, a, b in zip(rows, counts, cut, cut[1:])], 0)


def gram_keys(b: Block, grams: list[Grams]) -> list[np.ndarray]:
    """64-bit keys of the n-grams of each length, made from the words alone."""
    word = word_keys(b.vocabulary)
    keys, prefix = [word], np.append(word, _START)
    for g in grams[1:]:
        prefix = mix(mix(prefix[g.prefix]) * np.uint64(3) + word[g.last])
        keys.append(prefix)
    return keys


def _gram_batches(batches: Iterator[pa.RecordBatch], order: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The n-grams of two words and more, numbered on through the lengths after the words; keys as differences."""
    for batch in batches:
        for row in batch.to_pylist():
            b = _block(row)
            grams = b.grams(order)
            key = np.concatenate(gram_keys(b, grams)[1:])
            at = np.arange(len(b.vocabulary), len(b.vocabulary) + len(key), dtype=np.int32)

            def steps(own: np.ndarray, key=key) -> bytes:
                return len(own).to_bytes(8, "little") + pack(np.diff(key[own], prepend=np.uint64(0)))

            yield _rows(list(_chunks(row["block"], parts, key, at, np.concatenate([g.train for g in grams[1:]]), steps)))


@dataclass
class Totals:
    """Figures of all training texts: tokens, distinct tokens, texts."""

    tokens: int
    types: int
    texts: int


class Automaton:
    """The part of the backoff automaton that a block's texts can reach.

    State 0 is the empty context; the start of a text and every shorter n-gram with a training count are states.
    An arc (state, word) has the log10 of the smoothed probability as weight; ``fail`` and ``back`` are the
    failure arc of each state and its weight. Arcs of state 0 are arrays by word: any word has one, unknown ones too.
    """

    def __init__(self, size: int, grams: list[Grams], counts: np.ndarray, totals: Totals, strength: float) -> None:
        order = len(grams)
        cut = np.cumsum([0, *(len(g.last) for g in grams)])
        c = [counts[a:b] for a, b in zip(cut, cut[1:])]
        p = (c[0] + 1.0) / (totals.tokens + totals.types + 1)
        known = np.append(c[0] > 0, totals.texts > 0)
        state = np.where(known & (order > 1), np.cumsum(known), 0)  # of each word and of the start
        self.size, self.known, self.start = size, known[:size], int(state[size])
        self.base = np.log10(p)
        self.root_target = state[:size]
        held = np.append(c[0], totals.texts).astype(float)
        fail, back = [0], [0.0]
        if order > 1:
            fail += [0] * int(known.sum())
            back += np.log10(strength / (held[known] + strength)).tolist()
        keys, weights, targets = [], [], []
        for n in range(2, order + 1):
            g, own = grams[n - 1], c[n - 1]
            h = held[g.prefix]
            p = (own + strength * p[g.suffix]) / (h + strength)
            seen = own > 0
            shorter = state[g.suffix]
            if n < order:
                new = np.where(seen, len(fail) - 1 + np.cumsum(seen), 0)
                fail += shorter[seen].tolist()
                back += np.log10(strength / (own[seen] + strength)).tolist()
            else:
                new = shorter
            keys.append(state[g.prefix][seen] * size + g.last[seen])
            weights.append(np.log10(p[seen]))
            targets.append(new[seen])
            state, held = new, own.astype(float)
        key = np.concatenate([*keys, [np.iinfo(np.int64).max]]).astype(np.int64)
        by = np.argsort(key)
        self.key = key[by]
        self.weight = np.concatenate([*weights, [0.0]])[by]
        self.target = np.concatenate([*targets, [0]]).astype(np.int64)[by]
        self.fail, self.back = np.array(fail), np.array(back)

    def traverse(self, tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Log10 probabilities of the texts: all are read in step from left to right, each with its state."""
        lengths = np.diff(ends)
        order = np.argsort(-lengths, kind="stable")
        lengths, starts = lengths[order], ends[:-1][order]
        state = np.full(len(order), self.start)
        score = np.zeros(len(order))
        live = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), "right")  # texts with so many tokens
        for i, k in enumerate(live.tolist()):
            word = tokens[starts[:k] + i].astype(np.int64)
            at = state[:k]
            todo = np.flatnonzero(at)
            while len(todo):  # an arc, or on along the failure arcs to the empty context
                key = at[todo] * self.size + word[todo]
                arc = np.searchsorted(self.key, key)
                hit = self.key[arc] == key
                done, arc = todo[hit], arc[hit]
                score[done] += self.weight[arc]
                at[done] = self.target[arc]
                word[done] = -1
                todo = todo[~hit]
                score[todo] += self.back[at[todo]]
                at[todo] = self.fail[at[todo]]
                todo = todo[at[todo] > 0]
            left = np.flatnonzero(word >= 0)
            score[left] += self.base[word[left]]
            at[left] = self.root_target[word[left]]
        out = np.empty(len(order))
        out[order] = score
        return out


def _score(left: pa.Table, right: pa.Table, id_name: str, id_type: pa.DataType, order: int, totals: Totals, strength: float) -> pa.Table:
    """One block's texts with the counts that other blocks add to its own."""
    out = []
    for row in left.to_pylist():
        b = _block(row)
        grams = b.grams(order)
        counts = np.concatenate([g.train for g in grams])
        for found in right.to_pylist():
            counts[unpack(found["at"], np.int32, found["types"])] = unpack(found["c"], np.int64, found["types"])
        counts[b.vocabulary.index(END)] = totals.texts
        model = Automaton(len(b.vocabulary), grams, counts, totals, strength)
        add = lambda x, of=b: np.add.reduceat(x[of.tokens], of.ends[:-1])
        out.append(pa.table({
            id_name: pa.array(row["ids"], id_type),
            "held_out": pa.array(~b.train),
            "n_tokens": pa.array(np.diff(b.ends)),
            "n_known": pa.array(add(model.known.astype(np.int64))),
            "train_tokens": pa.array(np.full(len(b.train), totals.tokens)),
            "base_score": pa.array(add(model.base)),
            "score": pa.array(model.traverse(b.tokens, b.ends)),
        }))
    return pa.concat_tables(out)


def score_texts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", modulus: int = 7, held_out: int = 2,
    order: int = 2, strength: float = 200.0, block_bytes: int = 16 << 20, part_entries: int = 1 << 20,
) -> DataFrame:
    """A row for each row of ``docs``: id, whether it was held out of training, and its scores.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z in lower case, and one end. Rows whose
    ``crc32(id as text) mod modulus`` is not ``held_out`` are the training texts; a null id counts as an empty
    text. ``n_known`` counts tokens that occur in training, ``train_tokens`` all training tokens, ``base_score``
    is the add-one unigram log10 probability, ``score`` that of the n-gram model of the given ``order``.
    A null text is an empty one: it has its end alone. Rows that share an id are texts of their own, in training
    as well; equal texts get equal scores. Without training texts both scores are 0. An empty table gives an
    empty result. Words are counted exactly; longer n-grams by 64-bit keys made from cryptographic
    word hashes, so two share a count only by chance (about n^2 / 2^65 for n distinct ones). ``block_bytes``
    bounds what a task holds of texts (a longer text is a block alone), ``part_entries`` what it counts at once;
    neither changes a result.
    """
    scratch = Scratch(docs.sparkSession)
    crc = F.crc32(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary"))
    rows = text_columns(docs, *dict.fromkeys((key, text))).select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").alias("text"), (crc % modulus != held_out).alias("train"))
    id_type = rows.schema["id"].dataType
    packed = rows.mapInArrow(partial(_pack_batches, block_bytes=block_bytes), _BLOCKS.format(id=id_type.simpleString()))
    # a row is a whole block: row groups are closed by size, not after a number of rows
    blocks = scratch.store(packed, "zstd", **{"parquet.block.size": 64 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1})
    sums = {c: F.sum(c).alias(c) for c in ("n_tokens", "n_words", "train_tokens", "train_texts")}
    got = blocks.agg(*sums.values()).first()
    found = blocks.select("block", "train", "ends", "vocabulary", "tokens", "n_tokens")
    parts = 1 + (got["n_words"] or 0) // part_entries
    words = found.mapInArrow(partial(_word_batches, parts=parts), _CHUNKS).groupBy("part").applyInArrow(_count_words, _COUNTED)
    words = scratch.store(words, "zstd")
    types = words.where("block = -1").agg(F.sum("types")).first()[0] or 0
    texts = got["train_texts"] or 0
    totals = Totals(got["train_tokens"] or 0, types + (texts > 0), texts)
    shared = words.where("block >= 0")
    if order > 1:
        parts = 1 + (order - 1) * (got["n_tokens"] or 0) // part_entries
        grams = found.mapInArrow(partial(_gram_batches, order=order, parts=parts), _CHUNKS)
        shared = shared.unionAll(grams.groupBy("part").applyInArrow(_count_grams, _COUNTED).where("block >= 0"))
    results = "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    judge = partial(_score, id_name=key, id_type=to_arrow_type(id_type), order=order, totals=totals, strength=strength)
    schema = T.StructType([T.StructField(key, id_type), *T.StructType.fromDDL(results).fields])
    return blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(lambda left, right: judge(left, right), schema)
