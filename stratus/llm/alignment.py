"""Alignment of two tokenizers over a corpus.

Both segmentations of a text cover the same bytes; where tokens of both end
together the text is cut into groups, and the two tokens that end there are
linked. An array from each id of the first tokenizer to the id of the second
with the same bytes settles most groups: an exact one-to-one group is counted
in a vector as long as the vocabulary. Only other links are counted by a shuffle
of pairs, which are few kinds: of two tokens that end together one is a suffix
of the other, so the vocabularies bound the number of pairs.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import Scratch, down_to_one, free_name, task_cache, with_results

#: Fixed value: how byte-level BPE cuts a text into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SLICE_CHARS = 1 << 19
_GAP_CHARS = 20_000
_GAP = re.compile(r"\s{%d}" % _GAP_CHARS)


def byte_letters() -> dict[str, int]:
    """Letter -> byte of a byte-level vocabulary: visible Latin-1 characters stand for themselves, the others follow from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """The first tokenizer: byte-level BPE from the JSON description of its vocabulary."""

    def __init__(self, description: bytes) -> None:
        import tiktoken

        self.description = description
        read = json.loads(description)
        letters = byte_letters()
        special = {t["content"] for t in read["added_tokens"]}
        ranks = {bytes(map(letters.__getitem__, k)): i for k, i in read["model"]["vocab"].items() if k not in special}
        size = 1 + max([*ranks.values(), *(t["id"] for t in read["added_tokens"])])
        self.pieces = [b""] * size
        for piece, i in ranks.items():
            self.pieces[i] = piece
        self.own = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.other = None

    def encode(self, text: str) -> list[int]:
        if len(text) >= _GAP_CHARS and _GAP.search(text):  # too long a gap for that library's matcher
            if self.other is None:
                from tokenizers import Tokenizer

                self.other = Tokenizer.from_str(self.description.decode())
                self.other.encode_special_tokens = True
            return self.other.encode(text, add_special_tokens=False).ids
        return self.own.encode_ordinary(text)


class Pieces:
    """The second tokenizer: a piece model that puts a space before the text."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.own.id_to_piece(i) for i in range(self.own.get_piece_size())]
        self.pieces = [bytes([int(s[3:5], 16)]) if self.own.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(names)]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1)


class Aligner:
    """Both vocabularies with the tables that the alignment of a slice of texts needs."""

    def __init__(self, a: bytes, b: bytes) -> None:
        self.a, self.b = ByteLevel(a), Pieces(b)
        self.size = len(self.b.pieces)
        self.len_a = np.array([len(x) for x in self.a.pieces], np.int64)
        self.len_b = np.array([len(x) for x in self.b.pieces], np.int64)
        # of several ids with the same bytes the one that is not for falling back to bytes
        ids = dict(sorted(((x, i) for i, x in enumerate(self.b.pieces)), key=lambda e: (not self.b.own.is_byte(e[1]), -e[1])))
        #: The identity map: the second tokenizer's id with the same bytes, or -1.
        self.same = np.array([ids.get(x, -1) if x else -1 for x in self.a.pieces], np.int64)
        most = max(len(self.a.pieces), self.size)
        width = len(str(most))
        text = np.array([str(i).ljust(width + 1, "\0") for i in range(most)], f"S{width + 1}")
        self.digits = np.zeros((most, width + 1), np.uint8)
        raw = text.view(np.uint8).reshape(most, -1)
        self.digits[:, : raw.shape[1]] = raw
        self.n_digits = (self.digits > 0).sum(1)

    def pair_bound(self) -> int:
        """How many pairs of ids can end together: one of the two is a suffix of the other."""
        from collections import Counter

        in_a, in_b = Counter(self.a.pieces), Counter(self.b.pieces)
        longer = lambda own, other: sum(other[x[i:]] for x in own if x for i in range(1, len(x)))
        return longer(self.a.pieces, in_b) + longer(self.b.pieces, in_a) + sum(in_b[x] for x in self.a.pieces if x)

    def align(self, texts: list[str]) -> dict[str, list]:
        """Figures of each text, its groups written out, and its links: ids of identity links, codes of the others."""
        n = len(texts)
        spaced = [" " + t for t in texts]
        ids_a = [self.a.encode(s) if t else [] for s, t in zip(spaced, texts)]
        ids_b = [x if t else [] for x, t in zip(self.b.encode_all(texts), texts)]
        part_a, part_b = self.a.pieces.__getitem__, self.b.pieces.__getitem__
        for i, s in enumerate(spaced):
            raw = s.encode()
            if b"".join(map(part_a, ids_a[i])) != raw or b"".join(map(part_b, ids_b[i])) != raw:
                ids_a[i], ids_b[i] = [], []
        n_a, n_b = (np.fromiter(map(len, x), np.int64, n) for x in (ids_a, ids_b))
        a, b = (np.fromiter((i for x in ids for i in x), np.int64, int(k.sum())) for ids, k in ((ids_a, n_a), (ids_b, n_b)))
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at = np.searchsorted(end_a, end_b)
        cut_b = np.flatnonzero(end_a[np.minimum(at, len(end_a) - 1)] == end_b) if len(b) else at
        cut_a = at[cut_b]
        doc = np.searchsorted(np.cumsum(n_a), cut_a, "right")
        groups = np.bincount(doc, minlength=n)
        x, y = a[cut_a], b[cut_b]
        alone = self.same[x] == y
        code = x * self.size + y
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": groups, "written": self._written(a, b, cut_a, cut_b, groups),
            "same": _split(x[alone].astype(np.int32), np.bincount(doc[alone], minlength=n)),
            "pairs": _split(code[~alone], np.bincount(doc[~alone], minlength=n)),
        }

    def _written(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, groups: np.ndarray) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of each text: every id's digits and one mark, in one flat array."""
        if not len(a):
            return [b""] * len(groups)
        before_b = np.r_[0, cut_b + 1]  # ids of the second tokenizer before each group
        through_a = cut_a + 1
        of_a = np.searchsorted(cut_a, np.arange(len(a)))
        of_b = np.searchsorted(cut_b, np.arange(len(b)))
        place_a = np.arange(len(a)) + before_b[of_a]
        place_b = np.arange(len(b)) + through_a[of_b]
        ids = np.empty(len(a) + len(b), np.int64)
        ids[place_a], ids[place_b] = a, b
        mark = np.full(len(ids), ord(","), np.uint8)
        mark[place_a[cut_a]], mark[place_b[cut_b]] = ord("|"), ord(";")
        rows = self.digits[ids]
        size = self.n_digits[ids]
        rows[np.arange(len(ids)), size] = mark
        flat = rows[rows > 0].tobytes()
        ends = np.cumsum(size + 1)
        last = place_b[cut_b[np.cumsum(groups)[groups > 0] - 1]]
        stops = np.zeros(len(groups), np.int64)
        stops[groups > 0] = ends[last]
        out, start = [], 0
        for stop in stops.tolist():
            out.append(flat[start : stop - 1] if stop else b"")
            start = max(start, stop)
        return out


def _split(values: np.ndarray, counts: np.ndarray) -> list[bytes]:
    ends = np.cumsum(counts) * values.itemsize
    raw = values.tobytes()
    return [raw[s:e] for s, e in zip([0, *ends[:-1].tolist()], ends.tolist())]


_aligners: dict[tuple, Aligner] = task_cache()


def _aligner(a, b) -> Aligner:
    key = (zlib.crc32(a.value), zlib.crc32(b.value))
    if key not in _aligners:  # once for each Python worker
        _aligners.clear()
        _aligners[key] = Aligner(a.value, b.value)
    return _aligners[key]


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _align_batch(a, b, text: str, links: tuple[str, str], written: bool, batch: pa.RecordBatch) -> dict[str, object]:
    aligner = _aligner(a, b)
    texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
    got: dict[str, list] = {k: [] for k in ("n_a", "n_b", "n_groups", "written", "same", "pairs")}
    at = 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars + len(texts[to]) <= _SLICE_CHARS):
            chars += len(texts[to])
            to += 1
        for k, v in aligner.align(texts[at:to]).items():
            got[k].extend(v.tolist() if isinstance(v, np.ndarray) else v)
        at = to
    out: dict[str, object] = {k: pa.array(got[k], pa.int64()) for k in ("n_a", "n_b", "n_groups")}
    out["n_links"] = out["n_groups"]  # no token is empty, so exactly one token of each kind ends at a cut
    out["groups_sha256"] = pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in got["written"]])
    if written:
        out["groups"] = pa.array([x.decode() for x in got["written"]], pa.string())
    return out | {links[0]: pa.array(got["same"], pa.binary()), links[1]: pa.array(got["pairs"], pa.binary())}


def _count_same(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """One vector for the partition: how often each id of the first tokenizer is an identity link."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int32), minlength=size)
    yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([zlib.compress(total.tobytes(), 1)])], names=["part", "counts"])


def _add_vectors(key: tuple, table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(x), np.int64) for x in table.column("counts").to_pylist())
    return pa.table({"part": [key[0].as_py()], "counts": [zlib.compress(total.tobytes(), 1)]})


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of the other links with their numbers, added up before they are shuffled."""
    codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        new, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.int64), return_counts=True)
        codes, at = np.unique(np.r_[codes, new], return_inverse=True)
        counts = np.bincount(at, np.r_[counts, n], len(codes)).astype(np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])


class Counts:
    """Corpus-wide counts of all linked pairs, and the highest of each id of the second tokenizer."""

    def __init__(self, same: np.ndarray, by_a: np.ndarray, codes: np.ndarray, counts: np.ndarray, size: int) -> None:
        order = np.argsort(codes)
        self.same, self.by_a, self.codes, self.counts, self.size = same, by_a, codes[order], counts[order], size
        self.best = np.zeros(size + 1, np.int64)
        np.maximum.at(self.best, same, np.where(same >= 0, by_a, 0))
        np.maximum.at(self.best, codes % size, counts)

    def of(self, same: bytes, pairs: bytes) -> tuple[int, int]:
        """(links whose count is the highest of their second id, sum of the counts) of one text."""
        x, code = np.frombuffer(same, np.int32), np.frombuffer(pairs, np.int64)
        one, two = self.by_a[x], self.counts[np.searchsorted(self.codes, code)]
        best = (one == self.best[self.same[x]]).sum() + (two == self.best[code % self.size]).sum()
        return int(best), int(one.sum() + two.sum())


def _judge_batch(shared, links: tuple[str, str], batch: pa.RecordBatch) -> dict[str, object]:
    counts = shared.value
    cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in links]
    got = [counts.of(s, p) for s, p in zip(*cols)]
    return {k: pa.array([g[i] for g in got], pa.int64()) for i, k in enumerate(("n_best", "count_sum"))}


def align_tokenizers(docs: DataFrame, a: bytes, b: bytes, text: str = "text", written: bool = False) -> tuple[DataFrame, DataFrame]:
    """(the rows of ``docs`` without ``text`` but with their figures, the linked id pairs with their counts).

    ``a`` is the JSON description of a byte-level BPE vocabulary, which encodes a
    space and the text, ``b`` the content of a piece model, which adds that space
    itself; neither makes special tokens. Figures: tokens of both kinds, groups,
    links, ``n_best`` (links whose corpus-wide count is the highest of their
    second id, ties included), ``count_sum`` (over the links), ``groups_sha256``,
    and with ``written`` the ``groups`` themselves (``a1,a2|b1;a3|b2``). A text
    that is null, empty, or not covered byte by byte by both kinds of tokens (as
    one that holds a literal U+2581) has no tokens: zeros and ''. Each row counts
    for itself, whatever its other columns hold. Input columns named like an
    added one are replaced. An empty table gives empty results.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    shared = spark.sparkContext.broadcast(a), spark.sparkContext.broadcast(b)
    aligner = Aligner(a, b)
    links = free_name(docs, "_same"), free_name(docs, "_pairs")
    added = [(k, T.StringType() if k == "groups_sha256" else T.LongType()) for k in FIGURES]
    added += ([("groups", T.StringType())] if written else []) + [(k, T.BinaryType()) for k in links]
    run = partial(_align_batch, *shared, text, links, written)
    kept = docs.drop("n_best", "count_sum")
    stored = scratch.store(with_results(kept, added, run).drop(text), compression="zstd")
    by_a = down_to_one(
        stored.select(links[0]).mapInArrow(partial(_count_same, size=len(aligner.same)), "part long, counts binary").unionAll(
            spark.createDataFrame([(0, zlib.compress(np.zeros(len(aligner.same), np.int64).tobytes()))], "part long, counts binary")
        ),
        scratch, _add_vectors, "part long, counts binary",
    )
    by_a = np.frombuffer(zlib.decompress(by_a["counts"]), np.int64)
    # at most pair_bound() rows, whatever the corpus: about half a million for vocabularies of 50,000 and 32,000
    found = stored.select(links[1]).mapInArrow(_count_pairs, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    codes, counts = found.column("code").to_numpy(), found.column("n").to_numpy()
    totals = Counts(aligner.same, by_a, codes, counts, aligner.size)
    results = [("n_best", T.LongType()), ("count_sum", T.LongType())]
    out = with_results(stored, results, partial(_judge_batch, spark.sparkContext.broadcast(totals), links)).drop(*links)
    ids = np.flatnonzero((by_a > 0) & (aligner.same >= 0))
    every = pa.table({
        "a": np.r_[ids, codes // aligner.size], "b": np.r_[aligner.same[ids], codes % aligner.size], "n": np.r_[by_a[ids], counts],
    })
    return out, spark.createDataFrame(every)
