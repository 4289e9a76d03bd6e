"""Removal of repeated byte strings with per-shard suffix arrays.

A byte goes if it lies in a string of ``length`` bytes (a window) that also
starts elsewhere in the corpus. Equal windows have the same anchor: the start of
their smallest ``gram``-byte hash. Neighbouring windows with one anchor make a
segment, and only segments whose anchor gram occurs twice can hold repeats.

Those segments go to shards by their gram, equal ones as one with a count. In a
shard a suffix array of the texts before and after the anchors is built by
Larsson-Sadakane refinement over 8-byte words, with common prefixes by Kasai's
rule; windows are equal exactly if both sides agree far enough. A gram with very
many different segments is spread over several shards, whose sorted windows are
merged by binary search afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrays import Texts, prefix_hash, span_hash, text_slices
from .frames import Scratch, begin_task, free_name, small_side, with_results

_POSITION = np.uint64(26)  # bits of a position in a slice, kept below the hash in one number


def segments(t: Texts, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Text, start, number of windows, anchor offset and gram hash of the segments of the texts."""
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    n = len(t.data)
    if n < length:
        return none
    m, width, windows = n - gram + 1, length - gram + 1, n - length + 1
    at = np.arange(m)
    h = span_hash(prefix_hash(t.data), at, at + gram)
    bits = _POSITION if n <= 1 << 26 else np.uint64(n.bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = np.full(-(-m // width) * width, np.iinfo(np.uint64).max, np.uint64)
    key[:m] = (h & ~low) | at.astype(np.uint64)
    block = key.reshape(-1, width)  # sliding minimum from running minima of blocks, both ways
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows]) & low).astype(np.int64)
    start = np.arange(windows)
    own = np.searchsorted(t.ends, start, "right") - 1
    inside = np.flatnonzero(start + length <= t.ends[own + 1])
    if not len(inside):
        return none
    anchor, own = anchor[inside], own[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.r_[first, len(inside)])
    own, start, anchor = own[first], inside[first], anchor[first]
    return own, start, count, anchor - start, h[anchor]


def _gram_batches(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    begin_task("repeats grams")
    for batch in batches:
        for t in text_slices(batch, "text", overlap=length - 1):
            yield pa.RecordBatch.from_arrays([pa.array(segments(t, length, gram)[4].view(np.int64))], names=["gram"])


def _held(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    bit = values & np.uint64(len(table) * 64 - 1)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0


def _segment_batches(batches: Iterator[pa.RecordBatch], length: int, gram: int, table) -> Iterator[pa.RecordBatch]:
    """Segments whose gram may occur twice, with their bytes."""
    begin_task("repeats segments")
    for batch in batches:
        for t in text_slices(batch, "text", overlap=length - 1):
            own, start, count, offset, h = segments(t, length, gram)
            keep = _held(h, table.value)
            own, start, count, offset, h = own[keep], start[keep], count[keep], offset[keep], h[keep]
            size = count + length - 1
            cut = np.r_[0, np.cumsum(size)]
            flat = t.data[np.arange(cut[-1]) + np.repeat(start - cut[:-1], size)] if len(own) else t.data[:0]
            raw = flat.tobytes()
            digest = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(cut, cut[1:])]
            texts = batch.column(0).slice(t.rows.start, len(t)).take(pa.array(own))
            body = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(raw)])
            cols = [texts, pa.array(start - t.ends[own] + t.base), pa.array(h.view(np.int64)), pa.array(offset.astype(np.int32)), pa.array(digest, pa.binary()), body]
            yield pa.RecordBatch.from_arrays(cols, names=["key", "start", "gram", "off", "digest", "body"])


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, ranks) of a sequence of integers, by Larsson-Sadakane refinement.

    Each round sorts only what is still tied, by the rank of the suffix ``h`` further on, and doubles ``h``.
    """
    n = len(text)
    sa = np.argsort(text, kind="stable")
    first = np.r_[True, text[sa][1:] != text[sa][:-1]]
    rank = np.empty(n + 1, np.int64)  # a group's rank is the place of its first member
    rank[n] = -1
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    h = 1
    tied = np.flatnonzero(~(first & np.r_[first[1:], True]))
    while len(tied) and h < n:
        s = sa[tied]
        own = rank[s]
        key = own * (n + 1) + rank[np.minimum(s + h, n)] + 1
        order = np.argsort(key, kind="stable")
        s, key = s[order], key[order]
        first = np.r_[True, key[1:] != key[:-1]]
        sa[tied] = s
        rank[s] = tied[np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))]
        alone = first & np.r_[first[1:], True]
        tied = tied[~alone]
        h *= 2
    return sa, rank[:n]


def common_prefixes(text: np.ndarray, sa: np.ndarray, rank: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """LCP of each suffix with the one before it, by Kasai's rule.

    The text is rows of ``width`` symbols from ``starts`` on, each ended by a symbol of its own.
    Within a row the LCP falls by at most one from a suffix to the next; all rows advance together.
    """
    n = len(text)
    before = np.where(rank > 0, sa[np.maximum(rank - 1, 0)], n)
    padded = np.r_[text, -1]
    lcp = np.zeros(n, np.int64)
    reach = np.zeros(len(starts), np.int64)
    for k in range(width):
        i = starts + k
        j = before[i]
        reach = np.where(j < n, np.maximum(reach - 1, 0), 0)
        live = np.flatnonzero(j < n)
        while len(live):
            same = padded[i[live] + reach[live]] == padded[j[live] + reach[live]]
            live = live[same]
            reach[live] += 1
        lcp[i] = reach
    out = np.zeros(n, np.int64)
    out[rank] = lcp
    return out


def sorted_contexts(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of equally wide byte rows and the bytes that each shares with its predecessor in the order."""
    m, size = rows.shape
    width = size // 8
    words = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    _, symbol = np.unique(words, return_inverse=True)
    text = np.empty((m, width + 1), np.int64)
    text[:, :width] = symbol.reshape(m, width) + m
    text[:, width] = np.arange(m)  # ends of rows: all different, below every word
    text, starts = text.ravel(), np.arange(m) * (width + 1)
    sa, rank = suffix_array(text)
    lcp = common_prefixes(text, sa, rank, starts, width)
    place = np.sort(rank[starts])
    order = sa[place] // (width + 1)
    shared = np.zeros(m, np.int64)
    if m > 1:
        shared[1:] = np.minimum.reduceat(lcp, place + 1 if place[-1] + 1 < len(lcp) else np.r_[place[:-1] + 1, len(lcp) - 1])[: m - 1]
        a, b, w = order[:-1], order[1:], shared[1:]
        part = np.minimum(w, width - 1)[:, None] * 8 + np.arange(8)
        differ = rows[a[:, None], part] != rows[b[:, None], part]
        shared[1:] = np.where(w < width, w * 8 + np.where(differ.any(1), differ.argmax(1), 8), size)
    of = np.empty(m, np.int64)
    of[order] = np.arange(m)
    return of, shared


def repeated_windows(bodies: list[bytes], offset: np.ndarray, weight: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each segment and window whether the window occurs twice among the segments, by weight."""
    m = len(bodies)
    size = np.array([len(b) for b in bodies])
    windows = size - length + 1
    left, right = -(-(length - gram + 8) // 8) * 8, -(-length // 8) * 8
    before, after = np.zeros((m, left), np.uint8), np.zeros((m, right), np.uint8)
    for i, (b, o) in enumerate(zip(bodies, offset)):
        x = np.frombuffer(b, np.uint8)
        before[i, :o] = x[:o][::-1]
        after[i, : len(b) - o] = x[o:]
    rank_l, shared_l = sorted_contexts(before)
    rank_r, shared_r = sorted_contexts(after)
    out = np.zeros((m, int(windows.max())), bool)
    for o in range(int((offset - windows).min()) + 1, int(offset.max()) + 1):
        # windows that start o bytes before their anchor: equal if o bytes before and length - o from it on are equal
        if o < 0:
            continue
        at = offset - o
        v = np.flatnonzero((at >= 0) & (at < windows))
        if not len(v):
            continue
        code = np.cumsum(shared_l < o)[rank_l[v]] * (m + 1) + np.cumsum(shared_r < length - o)[rank_r[v]]
        _, same = np.unique(code, return_inverse=True)
        out[v, at[v]] = np.bincount(same, weight[v])[same] > 1
    return out


def _spans(flags: np.ndarray) -> list[int]:
    """Alternating starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    return edge.tolist()


_SHARD = "digest binary, spans array<int>, gram long, shard long, prints array<long>"


def _shard(table: pa.Table, length: int, gram: int) -> pa.Table:
    bodies = [b.as_py() for b in table.column("body")]
    offset = table.column("off").to_numpy().astype(np.int64)
    weight = table.column("n").to_numpy().astype(np.float64)
    hot = table.column("spread").to_numpy(zero_copy_only=False)
    flags = repeated_windows(bodies, offset, weight, length, gram)
    spans, prints = [], []
    for b, row, h in zip(bodies, flags, hot):
        n = len(b) - length + 1
        spans.append(_spans(row[:n]))
        if h:  # its windows are compared with those of other shards afterwards
            digests = [hashlib.blake2b(b[i : i + length], digest_size=8).digest() for i in range(n)]
            prints.append(np.frombuffer(b"".join(digests), np.int64).tolist())
        else:
            prints.append(None)
    return pa.table({
        "digest": pa.array([hashlib.blake2b(b, digest_size=16).digest() for b in bodies], pa.binary()),
        "spans": pa.array(spans, pa.list_(pa.int32())),
        "gram": table.column("gram"),
        "shard": table.column("shard"),
        "prints": pa.array(prints, pa.list_(pa.int64())),
    })


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    """Prints that several shards hold: each shard's sorted list is searched in the merged lists before it."""
    merged, twice = np.zeros(0, np.int64), []
    for _, own in group.groupby("shard")["print"]:
        own = np.unique(own.to_numpy())
        at = np.searchsorted(merged, own)
        found = np.zeros(len(own), bool)
        inside = at < len(merged)
        found[inside] = merged[at[inside]] == own[inside]
        twice.append(own[found])
        merged = np.insert(merged, at[~found], own[~found])
    return pd.DataFrame({"gram": group["gram"].iloc[0], "print": np.unique(np.concatenate(twice))})


def _repeated_spans(docs: DataFrame, length: int, gram: int, filter_bits: int, shard_segments: int, scratch: Scratch) -> DataFrame:
    """(key, spans): for each text with repeats, the byte ranges [start, end) to remove, unmerged."""
    spark = docs.sparkSession
    grams = docs.mapInArrow(partial(_gram_batches, length=length, gram=gram), "gram long").groupBy("gram").count().where("count > 1")
    # the grams found twice as a bit table of fixed size: a false hit only lets a segment through that then has no partner
    bit = F.col("gram").bitwiseAND(F.lit((1 << filter_bits) - 1))
    words = grams.groupBy(F.shiftrightunsigned(bit, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast((gram & {(1 << filter_bits) - 1}) & 63 as int))")).alias("b")
    )
    got = words.toArrow()
    table = np.zeros(1 << (filter_bits - 6), np.uint64)
    table[got.column("w").to_numpy()] = got.column("b").to_numpy().view(np.uint64)

    schema = "key binary, start long, gram long, off int, digest binary, body binary"
    run = partial(_segment_batches, length=length, gram=gram, table=spark.sparkContext.broadcast(table))
    found = scratch.store(docs.mapInArrow(run, schema), compression="zstd")
    once = scratch.store(found.groupBy("gram", "off", "body").agg(F.count("*").alias("n")), compression="zstd")

    per_gram = once.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum("n").alias("total"))
    sizes = scratch.store(per_gram.where("total > 1"))
    wide = sizes.where(F.col("kinds") > shard_segments).select("gram", (F.col("kinds") / shard_segments + 1).cast("long").alias("parts"))
    total = sizes.agg(F.sum("kinds")).first()[0] or 0
    shards = max(1, -(-total // shard_segments))
    dealt = (
        once.join(wide, "gram", "left")
        .withColumn("spread", F.col("parts").isNotNull())
        .withColumn("salt", F.when(F.col("spread"), F.pmod(F.xxhash64("body"), F.col("parts"))).otherwise(F.lit(0)))
        .withColumn("shard", F.pmod(F.xxhash64("gram", "salt"), F.lit(shards)))
    )

    def judge(group: pa.Table) -> pa.Table:
        begin_task("repeats shards")
        return _shard(group, length, gram)

    judged = scratch.store(dealt.select("shard", "gram", "off", "body", "n", "spread").groupBy("shard").applyInArrow(judge, _SHARD), compression="zstd")

    runs = F.expr("transform(sequence(0, size(spans) div 2 - 1), i -> struct(spans[2*i] AS a, spans[2*i+1] AS b))")
    spans = judged.where("size(spans) > 0").select("digest", F.explode(runs).alias("s")).select("digest", "s.a", "s.b")
    if wide.limit(1).count():
        open_ = judged.where("prints IS NOT NULL").select("gram", "shard", "digest", F.posexplode("prints").alias("a", "print"))
        lists = open_.select("gram", "shard", "print").distinct().join(wide, "gram").withColumn("part", F.pmod(F.xxhash64("print"), F.col("parts")))
        twice = lists.select("gram", "part", "shard", "print").groupBy("gram", "part").applyInPandas(_merge, "gram long, print long")
        met = open_.join(twice, ["gram", "print"]).select("digest", "a", (F.col("a") + 1).alias("b"))
        spans = spans.unionAll(met)
    at = found.select("key", "start", "digest").distinct().join(spans, "digest")
    ranges = at.select("key", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b") + (length - 1)).alias("b"))
    return ranges.distinct().groupBy("key").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


RESULTS: list[tuple[str, T.DataType]] = [
    ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()),
]


def _cut(batch: pa.RecordBatch, text: str, spans_name: str, cleaned: bool) -> dict[str, object]:
    names = batch.schema.get_field_index
    out: dict[str, list] = {n: [] for n, _ in RESULTS} | {"cleaned_text": []}
    for t, spans in zip(batch.column(names(text)), batch.column(names(spans_name))):
        data = (t.as_py() or "").encode()
        runs: list[list[int]] = []
        for a, b in sorted((s["a"], s["b"]) for s in spans.as_py() or ()):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(b, runs[-1][1])
            else:
                runs.append([a, b])
        cuts = [0, *(x for r in runs for x in r), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2])) if runs else data
        out["n_bytes"].append(len(data))
        out["n_removed"].append(len(data) - len(kept))
        out["n_spans"].append(len(runs))
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        if cleaned:
            out["cleaned_text"].append(kept.decode(errors="ignore"))
    return out


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    length: int = 200,
    gram: int = 40,
    filter_bits: int = 26,
    shard_segments: int = 6000,
    cleaned: bool = True,
) -> DataFrame:
    """``docs`` with sizes, digest and, if asked, ``cleaned_text`` of what is left after removal.

    Removed is every byte of the UTF-8 text that lies in a ``length``-byte string
    which also starts anywhere else, in the same text or another; strings are
    judged on the input. Matches never cross texts. Equal texts repeat each
    other, so repeated rows lose everything but texts shorter than ``length``.
    A null text counts as empty. ``cleaned_text`` drops the bytes of characters
    that a cut has split. ``filter_bits`` bounds a broadcast bit table (8 MB),
    ``shard_segments`` what one task sorts; neither changes a result.
    Input columns named like an added one are replaced.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    key = F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))
    plain = docs.select(key.alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).where("length(text) * 4 >= %d" % length)
    ranges = scratch.store(_repeated_spans(plain, length, gram, filter_bits, shard_segments, scratch))
    scratch.drop_all(but=[ranges])
    at, runs = free_name(docs, "_key"), free_name(docs, "_spans")
    keyed = docs.withColumn(at, key)
    hit = small_side(scratch.store(ranges.select(F.col("key").alias(at))), 250_000)  # 32 bytes a row
    found = ranges.select(F.col("key").alias(at), F.col("spans").alias(runs))
    added = [*RESULTS, *([("cleaned_text", T.StringType())] if cleaned else [])]
    cut = partial(_cut, text=text, spans_name=runs, cleaned=cleaned)
    touched = keyed.join(hit, at, "left_semi").join(found, at)
    whole = keyed.join(hit, at, "left_anti").withColumn(runs, F.lit(None).cast(ranges.schema["spans"].dataType))
    return with_results(touched, added, cut).unionByName(with_results(whole, added, cut)).drop(at, runs)
