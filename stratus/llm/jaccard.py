"""Exact n-gram Jaccard join with set-relation skipping.

Prefix filtering on a global token order (rare before frequent by powers of two, else by hash):
two sets that link share a token in their prefixes. Relations between sets keep
the work near linear:

* equal sets are joined as one;
* each set is first compared with one leader that resembles it. Sets of one
  leader form a family, and the answers of a member derive from the leader's:
  the overlap of two members is the leader's size less what each lacks of it,
  plus what their differences share. So within a family only the short lists of
  differences are joined, by a prefix filter of their own;
* between families, the lists of the index are cut into blocks by set size and
  token position; pairs of blocks that no linking pair can come from, or whose
  sets are all in one component or family, are skipped unopened.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import mix, shingles, text_slices
from .components import components
from .frames import Scratch, begin_task, small_side

#: Rows up to which a table of ids goes out as a broadcast (8 bytes a row).
BROADCAST_ROWS = 1_000_000


_TOKEN_BITS = np.uint64(48)


def _sets(t, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text (48-bit hashes, ascending), their texts, and the set sizes by text."""
    h, own = shingles(t, words)
    key = (own.astype(np.uint64) << _TOKEN_BITS) | (h >> (np.uint64(64) - _TOKEN_BITS))
    key.sort()  # by text, then token; a slice has fewer than 2**16 texts
    if len(key):
        key = key[np.r_[True, key[1:] != key[:-1]]]
    own = (key >> _TOKEN_BITS).astype(np.int64)
    token = (key & ((np.uint64(1) << _TOKEN_BITS) - np.uint64(1))).astype(np.int64)
    return token, own, np.bincount(own, minlength=len(t))


def _set_keys(h: np.ndarray, n: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each set, as two columns."""
    u = mix(h.view(np.uint64))
    k1, k2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        k1[full] = np.add.reduceat(u, start[full])
        k2[full] = np.add.reduceat(mix(u ^ np.uint64(0x5851F42D4C957F2D)), start[full])
    return k1.view(np.int64), k2.view(np.int64)


def _found(values: np.ndarray, ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each value would stand, and whether it is there."""
    if not len(ascending):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return at, ascending[at] == values


def _prefix_batches(batches: Iterator[pa.RecordBatch], words: int, pct: int, frequent, last) -> Iterator[pa.RecordBatch]:
    """Size, 128-bit key and prefix of each text's set.

    ``frequent``: (tokens, levels), which come behind other tokens in the order of their levels. With
    ``last`` (the newest of them) only texts are returned whose prefix holds one if those have no level,
    and with their whole sets if half of that prefix does: then most of the text is frequent.
    """
    begin_task("jaccard prefixes")
    hot, levels = frequent.value if frequent is not None else (np.zeros(0, np.int64),) * 2
    newest = last.value if last is not None else None
    for batch in batches:
        for t in text_slices(batch, "text"):
            h, own, n = _sets(t, words)
            start = np.r_[0, np.cumsum(n)]
            take = n + (-pct * n // 100) + (n > 0)
            k1, k2 = _set_keys(h, n, start)
            at, is_hot = _found(h, hot)
            level = np.where(is_hot, levels[at], 0) if is_hot.any() else is_hot
            chosen = np.ones(len(t), bool)
            if newest is not None:
                _, new = _found(h, newest)
                order = _by_level(own, np.where(new, 0, level))
                held = new[order] & (np.arange(len(h)) - start[own] < take[own])
                held = np.bincount(own[held], minlength=len(t))
                chosen = held > 0
                take = np.where(chosen, np.where(2 * held >= take, n, take), 0)
            h = h[_by_level(own, level)]
            rows = batch.slice(t.rows.start, t.rows.stop - t.rows.start)
            prefix = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(take)].astype(np.int32)), pa.array(h[np.arange(len(h)) - start[own] < take[own]])
            )
            out = pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(n), pa.array(k1), pa.array(k2), prefix],
                names=["id", "n", "k1", "k2", "prefix"],
            )
            yield out.filter(pa.array(chosen)) if newest is not None else out


def _by_level(own: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Order of the tokens of each text by level, then as they are."""
    return np.argsort(own * 64 + level, kind="stable") if level.any() else np.arange(len(own))


def _prefixes(docs: DataFrame, words: int, pct: int, frequent=None, last=None) -> DataFrame:
    run = partial(_prefix_batches, words=words, pct=pct, frequent=frequent, last=last)
    return docs.mapInArrow(run, "id long, n long, k1 long, k2 long, prefix array<long>")


def frequent_tokens(docs: DataFrame, words: int, pct: int, long_list: int, most: int, rounds: int, scratch: Scratch):
    """Broadcast of the tokens (ascending) whose prefix lists are longer than ``long_list``, and their levels.

    Counted over all documents. They come last in the token order, the more
    frequent the later, which takes them out of most prefixes; the next round
    counts what moved up instead. At most ``most`` tokens (9 bytes each) are
    kept, by doubling ``long_list``; any choice gives the same links, only with
    more or less work.
    """
    sc = docs.sparkSession.sparkContext
    known, levels, last = np.zeros(0, np.int64), np.zeros(0, np.int64), None
    for _ in range(rounds):
        rows = _prefixes(docs, words, pct, sc.broadcast((known, levels)), None if last is None else sc.broadcast(last))
        lists = scratch.store(rows.select(F.explode("prefix").alias("t")).groupBy("t").count().where(F.col("count") > long_list))
        limit = long_list
        while lists.where(F.col("count") > limit).count() > most - len(known):
            limit *= 2
        found = lists.where(F.col("count") > limit).toArrow()
        scratch.drop(lists)
        tokens, counts = found.column("t").to_numpy(), found.column("count").to_numpy()
        fresh = ~np.isin(tokens, known)
        if not fresh.any():
            break
        last, level = tokens[fresh], 1 + np.log2(counts[fresh] / long_list).astype(np.int64)
        order = np.argsort(all_ := np.r_[known, last])
        known, levels = all_[order], np.r_[levels, np.minimum(level, 60)][order]
        last = np.sort(last)
    return sc.broadcast((known, levels))


def _set_batches(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    begin_task("jaccard sets")
    for batch in batches:
        for t in text_slices(batch, "text"):
            h, _, n = _sets(t, words)
            raw = h.tobytes()
            start = np.r_[0, np.cumsum(n)]
            cut = (start * 8).astype(np.int32)
            keys = [pa.array(k) for k in _set_keys(h, n, start)]
            tokens = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(cut.tobytes()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.rows.start, len(n)), *keys, tokens], names=["id", "k1", "k2", "tokens"])


def _difference_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes and intersection of two sets, and what each lacks of the other as one list.

    The tokens that only the first has are marked by their sign.
    """
    begin_task("jaccard differences")
    for batch in batches:
        na, nb, both, differ = [], [], [], []
        for p, q in zip(batch.column(2), batch.column(3)):
            p, q = np.frombuffer(p.as_buffer(), np.int64), np.frombuffer(q.as_buffer(), np.int64)
            held = _found(p, q)[1]
            na.append(len(p))
            nb.append(len(q))
            both.append(int(held.sum()))
            near = 3 * both[-1] >= len(p) + len(q) - both[-1]
            differ.append(np.r_[~p[~held], q[~_found(q, p)[1]]] if near else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in (na, nb, both)), pa.array(differ, pa.list_(pa.int64()))],
            names=["a", "b", "na", "nb", "both", "differ"],
        )


def _once(rows: DataFrame) -> DataFrame:
    """One of the equal rows of each set; only rows that have ``copies`` are shuffled."""
    again = rows.where("copies > 1").dropDuplicates(["doc"])
    return rows.where("copies = 1").unionAll(again).drop("copies")


def _numbered(firsts: DataFrame, scratch: Scratch) -> DataFrame:
    """``firsts`` with a ``doc`` of its own for each set, its smallest ``id``; further sets of one id get numbers above all ids."""
    several = firsts.groupBy("id").agg(F.min(F.struct("k1", "k2")).alias("main"), F.count("*").alias("sets")).where("sets > 1")
    several = scratch.store(several.select("id", "main"))
    extra = firsts.join(small_side(several, BROADCAST_ROWS), "id").where(F.struct("k1", "k2") != F.col("main"))
    extra = scratch.store(extra.select("k1", "k2", F.monotonically_increasing_id().alias("place")))
    part = F.shiftright("place", 33).cast("int")
    counts = sorted(extra.groupBy(part.alias("part")).count().collect())
    if not counts:
        return firsts.withColumn("doc", F.col("id"))
    start = firsts.agg(F.max("id")).first()[0] + 1
    starts = []
    for p, n in counts:
        starts.append((p, start))
        start += n
    starts = F.broadcast(firsts.sparkSession.createDataFrame(starts, "part int, start long"))
    own = extra.withColumn("part", part).join(starts, "part").select("k1", "k2", (F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("doc"))
    return scratch.store(firsts.join(own, ["k1", "k2"], "left").withColumn("doc", F.coalesce("doc", "id")))


def _id_links(rows: DataFrame, firsts: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between the sets of each id that has several."""
    owned = rows.join(small_side(firsts.select("k1", "k2", "doc"), BROADCAST_ROWS), ["k1", "k2"]).select("id", "doc")
    several = scratch.store(owned.groupBy("id").agg(F.min("doc").alias("b"), F.max("doc").alias("hi")).where("b < hi").select("id", "b"))
    return owned.join(small_side(several, BROADCAST_ROWS), "id").where("doc <> b").select(F.col("doc").alias("a"), "b")


def overlaps(pairs: DataFrame, sized: DataFrame, firsts: DataFrame, docs: DataFrame, words: int, pct: int, scratch: Scratch) -> DataFrame:
    """(a, b, na, nb, both, differ) of the stored pairs that can link, compared set by set.

    Pairs whose prefixes share too little go first: what is not in both prefixes
    can only be shared behind one of them.
    """
    ids = scratch.store(pairs.select(F.col("a").alias("doc")).unionAll(pairs.select(F.col("b").alias("doc"))).distinct())
    heads = sized.select("doc", "n", "prefix").join(small_side(ids, BROADCAST_ROWS), "doc", "left_semi")

    def of(side: str) -> DataFrame:
        return heads.select(F.col("doc").alias(side), F.col("n").alias(f"n_{side}"), F.col("prefix").alias(f"p_{side}"))

    rest = [F.col(f"n_{x}") - F.size(f"p_{x}") for x in "ab"]
    shared = F.size(F.array_intersect("p_a", "p_b"))
    likely = (
        pairs.join(of("a"), "a").join(of("b"), "b")
        .where((100 + pct) * (shared + F.greatest(*rest)) >= pct * (F.col("n_a") + F.col("n_b")))
        .select("a", "b").distinct()
    )
    likely = scratch.store(likely)
    few = scratch.store(likely.select(F.col("a").alias("doc")).unionAll(likely.select(F.col("b").alias("doc"))).distinct())
    few_firsts = scratch.store(firsts.join(small_side(few, BROADCAST_ROWS), "doc", "left_semi"))
    needed = docs.join(small_side(few_firsts.select("id").distinct(), BROADCAST_ROWS), "id", "left_semi")
    made = needed.mapInArrow(partial(_set_batches, words=words), "id long, k1 long, k2 long, tokens binary")
    made = made.join(small_side(few_firsts, BROADCAST_ROWS), ["id", "k1", "k2"])
    sets = scratch.store(_once(made.select("doc", "tokens", "copies")))
    left = likely.join(sets.select(F.col("doc").alias("a"), F.col("tokens").alias("x")), "a")
    both = left.join(sets.select(F.col("doc").alias("b"), F.col("tokens").alias("y")), "b")
    made = both.select("a", "b", "x", "y").mapInArrow(_difference_batches, "a long, b long, na long, nb long, both long, differ array<long>")
    out = scratch.store(made)
    scratch.drop(ids, likely, few, few_firsts, sets)
    return out


def _linked(pct: int):
    return F.col("both") * (100 + pct) >= pct * (F.col("na") + F.col("nb"))


def _possible(pct: int, rest_a, rest_b, na, nb):
    """Whether sets of these sizes that first meet with so many tokens left can reach the threshold."""
    return (100 + pct) * F.least(rest_a, rest_b) >= pct * (na + nb)


def jaccard_groups(
    docs: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    words: int = 5,
    pct: int = 80,
    long_list: int = 64,
    max_frequent: int = 1_000_000,
    rounds: int = 2,
) -> DataFrame:
    """(doc, n_shingles, component_id) for each row: the smallest id reachable by links.

    Two rows link when their shingle sets have a Jaccard similarity of at least
    ``pct`` per cent, compared exactly. A text without words, or null, has an
    empty set and links with nothing; a shorter text than ``words`` is one
    shingle. Equal texts share a component. Rows that share an id are one
    document. A null id links with nothing and has a null component. The id
    must be an integer column; other columns are ignored. An empty table gives
    an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select(F.col(f"`{doc}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    frequent = frequent_tokens(docs, words, pct, long_list, max_frequent, rounds, scratch)
    rows = scratch.store(_prefixes(docs, words, pct, frequent))
    plain = scratch.store(rows.select("id", "n", "k1", "k2"))

    # from here on each distinct set is one ``doc``, whatever the number of rows that hold it
    counted = scratch.store(plain.where("id IS NOT NULL AND n > 0").groupBy("id", "k1", "k2").agg(F.count("*").alias("copies")))
    firsts = counted.groupBy("k1", "k2").agg(F.min(F.struct("id", "copies")).alias("f")).select("k1", "k2", "f.id", "f.copies")
    firsts = _numbered(scratch.store(firsts), scratch)
    sized = scratch.store(_once(rows.join(small_side(firsts, BROADCAST_ROWS), ["id", "k1", "k2"]).select("doc", "n", "prefix", "copies")))
    scratch.drop(rows)
    postings = sized.select("doc", "n", F.posexplode("prefix").alias("pos", "token")).withColumn(
        "size_block", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / pct))).cast("int")
    )
    shared = postings.groupBy("token").count().where("count > 1").select("token")
    entries = scratch.store(postings.join(shared, "token", "left_semi"))

    compared = _compare_leaders(entries, sized, firsts, docs, words, pct, scratch)
    links = compared.where(_linked(pct)).select("a", "b")
    links = links.unionAll(_family_links(compared, pct, scratch)).unionAll(_id_links(counted, firsts, scratch))
    known = scratch.store(components(links, scratch, "a", "b"))
    more = _block_links(entries, known, compared, sized, firsts, docs, words, pct, scratch)
    same = components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(more), scratch, "a", "b")

    of_key = firsts.join(same.withColumnRenamed("node", "doc"), "doc", "left").select(
        "k1", "k2", F.coalesce("component", "doc").alias("component")
    )
    out = plain.join(of_key, ["k1", "k2"], "left").select(
        F.col("id").alias(doc),
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))).alias("component_id"),
    )
    result = scratch.store(out)
    scratch.drop_all(but=[result])
    return result


def _compare_leaders(entries, sized, firsts, docs, words, pct, scratch):
    """Each set (a) with one leader (b) or two, compared.

    The head of a list block is the set that holds the token earliest: it has the fewest
    tokens of its own before the shared ones. Of the heads that a set meets at least half
    as often as any, it takes the one that most sets meet.
    """
    heads = entries.groupBy("token", "size_block").agg(F.min(F.struct("pos", "doc", "n")).alias("h"))
    near = entries.withColumn("size_block", F.explode(F.array("size_block", F.col("size_block") - 1)))
    met = near.join(heads, ["token", "size_block"]).where(
        (F.col("h.doc") != F.col("doc"))
        & _possible(pct, F.col("n") - F.col("pos"), F.col("h.n") - F.col("h.pos"), F.col("n"), F.col("h.n"))
    )
    often = scratch.store(met.groupBy("doc", F.col("h.doc").alias("head")).count())
    popular = often.groupBy("head").agg(F.count("*").alias("sets"))
    top = often.groupBy("doc").agg(F.max("count").alias("top"))
    best = (
        often.join(top, "doc").where("2 * count >= top").join(popular, "head")
        .groupBy("doc").agg(F.max(F.struct("sets", "count", (-F.col("head")).alias("head"))).alias("m"))
    )
    pairs = scratch.store(best.select(F.col("doc").alias("a"), (-F.col("m.head")).alias("b")))
    first = overlaps(pairs, sized, firsts, docs, words, pct, scratch)

    # a second try gathers what was split: each list offers its largest family, each set takes the largest it is often offered
    family = _families(first)
    offer = entries.join(family, "doc").groupBy("token").agg(F.max(F.struct("members", "family")).alias("f"))
    offered = entries.join(offer.where("f.members > 1"), "token").where("f.family <> doc")
    often2 = scratch.store(offered.groupBy("doc", "f.family").agg(F.count("*").alias("count"), F.max("f.members").alias("members")))
    top2 = often2.groupBy("doc").agg(F.max("count").alias("top"))
    best2 = often2.join(top2, "doc").where("2 * count >= top").groupBy("doc").agg(F.max(F.struct("members", "count", "family")).alias("m"))
    again = best2.select(F.col("doc").alias("a"), F.col("m.family").alias("b")).join(pairs, ["a", "b"], "left_anti")
    second = overlaps(scratch.store(again), sized, firsts, docs, words, pct, scratch)
    out = scratch.store(first.unionAll(second))
    scratch.drop(often, often2, pairs, first, second)
    return out


def _families(compared: DataFrame) -> DataFrame:
    """(doc, family, members): the largest family that a set belongs to; a leader belongs to its own."""
    of = compared.where("differ IS NOT NULL").select(F.col("a").alias("doc"), F.col("b").alias("family"))
    of = of.unionAll(of.select(F.col("family").alias("doc"), "family").distinct())
    size = of.groupBy("family").agg(F.count("*").alias("members"))
    largest = of.join(size, "family").groupBy("doc").agg(F.max(F.struct("members", "family")).alias("f"))
    return largest.select("doc", "f.family", "f.members")


def _family_links(compared, pct, scratch):
    """Links between members of one leader's family, of which not both are linked with the leader.

    With X the leader's size, and l and o what a member lacks of it and has beyond it, two members
    link exactly if their differences share at least g + g' tokens, where
    g = ((100 l + pct o) - (100 - pct) / 2 * X) / (100 + pct). Every such pair has a member that is
    not linked with the leader, for which g is above (100 - pct) / 2 * X / (100 + pct), so it shares
    at least one difference: the lists of differences are all the index it takes.
    """
    part = compared.where("differ IS NOT NULL").select(
        F.col("b").alias("leader"), F.col("a").alias("doc"), "differ", _linked(pct).alias("near"),
        # twice (100 + pct) g, an integer
        (200 * (F.col("nb") - F.col("both")) + 2 * pct * (F.col("na") - F.col("both")) - (100 - pct) * F.col("nb")).alias("g"),
        ((100 - pct) * F.col("nb")).alias("edge"),
    )
    some = part.groupBy("leader").agg(F.count("*").alias("members"), F.min("near").alias("near")).where("members > 1 AND NOT near").select("leader")
    part = scratch.store(part.join(some, "leader", "left_semi"))
    unit = 2 * (100 + pct)
    tokens = part.select("leader", "doc", "g", "edge", "near", F.size("differ").alias("n"), F.explode("differ").alias("token"))
    often = tokens.groupBy("leader", "token").agg(F.count("*").alias("sets"))
    order = Window.partitionBy("leader", "doc").orderBy("sets", "token")
    ranked = tokens.join(often, ["leader", "token"]).withColumn("pos", F.row_number().over(order) - 1)
    # the fewest shared differences of a link with this member: with a far member, or (if it is far itself) with any
    least = F.greatest(F.ceil((F.col("g") + F.when(F.col("near"), F.col("edge")).otherwise(-F.col("edge"))) / unit), F.lit(1))
    index = scratch.store(
        ranked.where((F.col("sets") > 1) & (F.col("pos") <= F.col("n") - least)).select(
            "leader", "token", "doc", "g", "near", (F.col("n") - F.col("pos")).alias("rest")
        )
    )
    x, y = index.where("NOT near").alias("x"), index.alias("y")
    met = x.join(
        y,
        (F.col("x.leader") == F.col("y.leader"))
        & (F.col("x.token") == F.col("y.token"))
        & (F.col("y.near") | (F.col("x.doc") < F.col("y.doc")))
        & (unit * F.least("x.rest", "y.rest") >= F.col("x.g") + F.col("y.g")),
    )
    pairs = met.select(F.col("x.leader").alias("leader"), F.col("x.doc").alias("a"), F.col("y.doc").alias("b")).distinct()
    one = part.select("leader", F.col("doc").alias("a"), F.col("differ").alias("da"), F.col("g").alias("ga"))
    two = part.select("leader", F.col("doc").alias("b"), F.col("differ").alias("db"), F.col("g").alias("gb"))
    both = pairs.join(one, ["leader", "a"]).join(two, ["leader", "b"])
    out = scratch.store(both.where(unit * F.size(F.array_intersect("da", "db")) >= F.col("ga") + F.col("gb")).select("a", "b"))
    scratch.drop(part, index)
    return out


def _block_links(entries, known, compared, sized, firsts, docs, words, pct, scratch):
    """Links between sets of different components and families, from the blocks of the lists that can hold any."""
    family = scratch.store(_families(compared))
    own = (
        entries.join(known.withColumnRenamed("node", "doc"), "doc", "left").join(family.select("doc", "family"), "doc", "left")
        .withColumns({"component": F.coalesce("component", "doc"), "family": F.coalesce("family", "doc")})
    )
    ends = [f(c).alias(f"{n}_{c}") for c in ("component", "family") for n, f in (("lo", F.min), ("hi", F.max))]
    mixed = own.groupBy("token").agg(*ends).where("lo_component <> hi_component AND lo_family <> hi_family").select("token")
    open_ = scratch.store(own.join(mixed, "token", "left_semi").withColumn("pos_block", F.floor(F.lit(50) * F.col("pos") / F.col("n")).cast("int")))
    key = ["token", "size_block", "pos_block"]
    blocks = open_.groupBy(*key).agg(*ends, F.min("n").alias("n"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    x, y = blocks.alias("x"), blocks.alias("y")

    def all_one(c: str):
        return (F.col(f"x.lo_{c}") == F.col(f"x.hi_{c}")) & (F.col(f"y.lo_{c}") == F.col(f"y.hi_{c}")) & (F.col(f"x.lo_{c}") == F.col(f"y.lo_{c}"))

    joined = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("y.size_block") - F.col("x.size_block")).isin(0, 1)
        & ((F.col("x.size_block") < F.col("y.size_block")) | (F.col("x.pos_block") <= F.col("y.pos_block")))
        & _possible(pct, F.col("x.rest"), F.col("y.rest"), F.col("x.n"), F.col("y.n"))
        & ~all_one("component") & ~all_one("family"),
    ).select(
        F.col("x.token").alias("token"), F.col("x.size_block").alias("size_block"), F.col("x.pos_block").alias("pos_block"),
        F.col("y.size_block").alias("size_block2"), F.col("y.pos_block").alias("pos_block2"),
    )

    def side(s: str, *blocks: str) -> DataFrame:
        return open_.select(
            "token", *[F.col(k).alias(b) for k, b in zip(key[1:], blocks)], F.col("doc").alias(s), F.col("n").alias(f"n{s}"),
            (F.col("n") - F.col("pos")).alias(f"rest_{s}"), F.col("component").alias(f"c{s}"), F.col("family").alias(f"f{s}"),
        )

    one, two = joined.join(side("a", "size_block", "pos_block"), key), side("b", "size_block2", "pos_block2")
    on = [one[c] == two[c] for c in ("token", "size_block2", "pos_block2")]
    apart = (F.col("ca") != F.col("cb")) & (F.col("fa") != F.col("fb"))
    opened = one.join(two, [*on, apart, _possible(pct, F.col("rest_a"), F.col("rest_b"), F.col("na"), F.col("nb"))])
    pairs = scratch.store(opened.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    out = scratch.store(overlaps(pairs, sized, firsts, docs, words, pct, scratch).where(_linked(pct)).select("a", "b"))
    scratch.drop(open_, pairs, family)
    return out
