"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratus.llm import jaccard, pieces, quality, sharding, suffixdedup
from stratus.llm.decontaminate import SuffixAutomaton, decontaminate, normalise
from stratus.llm.tokencounts import CountTrie, count_tokens, unigram_scores

from . import brute


def test_quality(hard_docs, hard_rows, no_docs):
    docs = hard_docs.withColumn("kept", F.lit("old"))
    out = quality.quality_rules(docs).collect()
    assert len(out) == len(hard_rows)
    for r in out:
        words = brute.SPACE_WORD.findall(r.text or "")
        grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeat = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(repeat))
        assert r.base_failed == (len(words) < 10 or 100 * len(repeat) > 20 * len(words))
        assert isinstance(r.kept, bool) and not (r.kept and r.base_failed)
    by = {r.doc_id: r for r in out}
    assert by[92].cleaned_text.startswith("\n") is False and "cookies" not in by[92].cleaned_text and "FOO" not in by[92].cleaned_text
    assert by[93].n_failed_lines == 1 and by[94].n_failed_lines == 1 and by[10].n_failed_lines == 0 and by[10].kept
    assert quality.quality_rules(no_docs).count() == 0


@pytest.mark.parametrize(
    "line,why",
    [
        ("%%% ### a b.", "symbols"), ("a very long line of words | with | bars and more words here.", "navigation"), ("Home Contact", "navigation"),
        ("Please accept cookies today.", "boilerplate"), ("BUY NOW CHEAP!!", "shouting"), ("no. no. no. no.", "echo"), ("no end here", "punctuation"),
        ("यह एक साफ़ वाक्य है।", None), ("هل هذه جملة نظيفة؟", None), ("یہ ایک صاف جملہ ہے۔", None), ("ይህ ንጹህ ዓረፍተ ነገር ነው።", None), ("这是一个句子。", None),
        ("นี่คือประโยคที่สะอาด", None), ("यह बिना चिह्न की पंक्ति", "punctuation"),
        ("A clean line, with a mark.", None), ("Two words.", None), ("Call 555 today! 12345", None),
    ],
)
def test_line_rules(line, why):
    assert quality.line_failure(line, line.split(), quality.Rules()) == why


def test_jaccard(hard_docs, hard_rows, no_docs):
    want = Counter(brute.jaccard_groups(hard_rows))
    for long_list in (64, 2):  # 2: nearly every shared token counts as frequent
        got = jaccard.jaccard_groups(hard_docs, long_list=long_list).collect()
        assert Counter(tuple(r) for r in got) == want
    assert jaccard.jaccard_groups(no_docs).count() == 0


def test_suffix_dedup(hard_docs, hard_rows, no_docs):
    want = Counter((i, *brute.dedup_row(*r)) for (i, _), r in zip(hard_rows, brute.removed([t for _, t in hard_rows])))
    cols = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "cleaned_text"]
    for shard_segments in (6000, 3):  # 3: many grams are spread over shards and merged
        got = suffixdedup.remove_repeats(hard_docs, shard_segments=shard_segments).select(cols).collect()
        assert Counter(tuple(r) for r in got) == want
    assert suffixdedup.remove_repeats(no_docs).count() == 0


def test_decontamination(spark, hard_docs, hard_rows, no_docs):
    long = next(t for i, t in hard_rows if i == 60)
    items = [(1, long[:400]), (2, "One"), (3, None), (4, ""), (5, "one. Two three"), (6, long[:400]), (7, long[50:200])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_chars in (10**6, 100):  # 100: several blocks, one automaton each
        got = decontaminate(hard_docs, bench, block_chars=block_chars).collect()
        assert len(got) == len(hard_rows)
        for r in got:
            n, hit, found = brute.contamination(r.text, items)
            assert (r.n_words, r.n_hit, r.n_items) == (n, hit, len(found))
            assert r.contaminated == (hit > 0 and 20 * hit >= n)
            if r.contaminated:
                assert brute.contamination(r.cleaned_text, items[:1])[1] == 0
            else:
                assert r.cleaned_text == (r.text or "")
    assert decontaminate(no_docs, bench).count() == 0
    assert not decontaminate(hard_docs, bench.where("item_id < 0")).where("contaminated").count()


def test_automaton_longest_matches():
    a = SuffixAutomaton.of([("x", list("abcbc")), ("y", list("bcbcab")), ("z", list("ca"))], 3)
    for text in ("abcbcab", "xbcbcx", "cab", "ca", "zzcaz", "bcbcbcabcbcab"):
        items = [("x", " ".join("abcbc")), ("y", " ".join("bcbcab")), ("z", "c a")]
        n, hit, found = brute.contamination(" ".join(text), items, 3)
        spans, items_found = a.scan(list(text))
        assert (sum(e - s for s, e in spans), items_found) == (hit, found)
    assert normalise("Éa É-1 A_b") == ["Éa", "É", "1", "a", "b"]


def test_sharding(hard_docs, hard_rows, no_docs):
    out = sharding.shard_documents(hard_docs).collect()
    assert len(out) == len(hard_rows)
    slots = {}
    for r in out:
        assert r.law == "key" and 0 <= r.shard < 8 and r.grown_shard in (r.shard, 8)
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert len({r.shard for r in out if r.doc_id == 11}) == 1
    assert sharding.shard_documents(no_docs).count() == 0


def test_sharding_moves_stay_in_changed_subtrees(spark):
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    tree = sharding.even_tree(8)
    heavier = [sharding.Leaf(x.region, x.rack, x.shard, 2.0 if x.shard == 0 else 1.0) for x in tree]
    rows = keys.select(sharding.placed(F.col("k"), tree).alias("a"), sharding.placed(F.col("k"), heavier).alias("b")).collect()
    counts = Counter(r.a for r in rows)
    assert len(counts) == 8 and min(counts.values()) > 350
    for r in rows:  # shards 0-3 are region 0, 0-1 its first rack: what moves goes towards the heavier subtree
        if r.a != r.b:
            assert r.b < 4 and (r.a >= 4 or r.b < 2) and (r.a not in (0, 1) or r.b == 0)
    double = Counter(r.b for r in rows)
    assert 1.5 < double[0] / (sum(double[i] for i in range(4, 8)) / 4) < 2.6


def test_pieces(hard_docs, hard_rows, no_docs, model):
    out = pieces.encode_pieces(hard_docs, model, seed=3, rate=0.15).select("doc_id", "text", "piece_ids", "decoded_text").collect()
    assert len(out) == len(hard_rows) and all(r.decoded_text == (r.text or "") for r in out)
    assert len({tuple(r.piece_ids) for r in out if r.doc_id == 11}) == 1
    own = pieces.PieceModel(model)
    for r in out:
        if len(r.text or "") < 2000:
            assert list(r.piece_ids) == brute.encode_with_draws(r.text or "", r.doc_id, own, 3, 0.15)
    assert pieces.encode_pieces(no_docs, model).count() == 0


def test_pieces_against_library_and_brute_force(hard_rows, model):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    plain, varied = pieces.Encoder(model, 1, 0.0), pieces.Encoder(model, 1, 0.2)
    texts = [t for _, t in hard_rows if t and "\x00" not in t]
    changed = 0
    for t in texts:
        assert plain.encode(t, 0).tolist() == lib.encode(t)
        changed += varied.encode(t, 0).tolist() != varied.encode(t, 1).tolist()
        for doc in (0, 1):
            assert varied.model.decode(varied.encode(t, doc)) == t
    assert changed > len(texts) / 2
    m = varied.model
    for chunk in [" hello", " internationalisation", "x" * 200, " ▁a▁", "日本語", " the", "  a", "x" * 48, " " + "tion" * 12]:
        for skips in ((), (0,), (1, 2), (0, 3, 4, 9), tuple(range(500))):
            assert m.segment(chunk, skips) == brute.merge_dropout(chunk, m, set(skips))
    for t in ("a▁b  c \n\n x", "\x00▁\x00▁▁", "\U0001f600 ½ﬁ\t", " ", "\n", "▁"):
        assert m.decode(varied.encode(t, 0)) == t
    small = pieces.Encoder(model, 1, 0.2)
    pieces._CACHE, before = 3, pieces._CACHE  # what is kept changes no result
    try:
        assert all((small.encode(t, 5) == varied.encode(t, 5)).all() for t in texts[:12])
    finally:
        pieces._CACHE = before


def test_pieces_side_by_side(model, monkeypatch):
    """Many texts at once get what each gets alone, at any rate and with parts that rows cannot hold."""
    rng = random.Random(5)
    words = ["the", "internationalisation,", "über", "▁x", "日本語。", "a" * 30, "q" * 60, "3.14", "x.", ",", "\n", "  ", "Donaudampfschiffahrt.", "\U0010ffff"]
    texts = [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(90)] + ["", "x", " ".join(words * 40)]
    for rate in (0.1, 0.5, 1.0):
        together = pieces.Encoder(model, 3, rate).encode_all(texts, list(range(len(texts))))
        alone = pieces.Encoder(model, 3, rate)
        for i, ids in enumerate(together):
            assert ids.tolist() == alone.encode(texts[i], i).tolist() and alone.model.decode(ids) == texts[i]
            if len(texts[i]) < 600:
                assert ids.tolist() == brute.encode_with_draws(texts[i], i, alone.model, 3, rate)
    once = []
    one_by_one = pieces.PieceModel.segment
    monkeypatch.setattr(pieces.PieceModel, "segment", lambda *a: once.append(a) or one_by_one(*a))
    fresh = ["".join(rng.choices("aeiorstnl", k=9)) for _ in range(4000)]
    pieces.Encoder(model, 3, 0.1).encode_all([" ".join(fresh[i : i + 20]) for i in range(0, 4000, 20)], list(range(200)))
    assert len(once) < 400  # new words and their skips are merged many at a time


def test_draws_vary_by_place_and_document(model):
    """A frequent word is segmented in many ways, in one text and over documents; the rate is kept."""
    e = pieces.Encoder(model, 7, 0.1)
    word = " internationalisation"
    plain = tuple(e.model.segment(word)[0])
    seen, texts = Counter(), set()
    for doc in range(200):
        ids = e.encode(word[1:] + word * 9, doc).tolist()
        texts.add(tuple(ids))
        first, n = e.model.segment(word)
        at = 0
        while at < len(ids):  # cut back into words by their bytes
            to, raw = at, b""
            while len(raw) < len(word):
                raw += e.model.raw[ids[to]]
                to += 1
            seen[tuple(ids[at:to])] += 1
            at = to
    assert len(texts) == 200 and len(seen) > 30 and sum(seen.values()) == 2000
    assert 0.9**n < seen[plain] / 2000 < 0.7  # without a skip, or with skips that other merges make up for
    hits = pieces.Draws("k", 0.1)
    found = [x for _ in range(40) for x in hits.block()]
    assert found == sorted(set(found)) and abs(len(found) / found[-1] - 0.1) < 0.01
    assert pieces.Draws("k", 1.0).block(5) == [0, 1, 2, 3, 4]


def test_token_counts(hard_docs, hard_rows, no_docs, model):
    scores = unigram_scores(model)
    longest = max(map(len, scores))
    out = count_tokens(hard_docs, model, max_known=50).collect()
    assert len(out) == len(hard_rows)
    known = {}
    for r in out:
        words = brute.SPACE_WORD.findall(r.text or "")
        for w in words:
            if w not in known:
                known[w] = brute.unigram_count(w, scores, longest)
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(known[w] for w in words))
    assert count_tokens(no_docs, model).count() == 0


def test_trie_scores_a_shared_prefix_once():
    trie = CountTrie({"▁": -1.0, "a": -1.0, "ab": -1.5, "▁ab": -2.0})
    trie.insert(["abab", "aba", "ab", "b"])
    assert trie.nodes == len({"▁", "▁a", "▁ab", "▁aba", "▁abab", "▁b"}) and trie["abab"] == 2


def test_jaccard_repeated_rows(spark):
    def text(replaced, new):
        w = [f"w{i}" for i in range(1004)]
        w[: len(replaced)] = replaced
        w[500 : 500 + len(new)] = new
        return " ".join(w)

    # two far members of one leader, linked with each other only; rows of the leader and of the members repeat
    far = [f"x{i}" for i in range(146)]
    rows = [(1, text([], []))] * 4 + [(10 + k, text([], [f"c{k}"])) for k in range(12)]
    rows += [(30, text(far, []))] * 3 + [(31, text([*far[:95], *(f"y{i}" for i in range(51))], []))] * 3
    # one id with several texts, that are linked with others
    rows += [(50, "only here " + " ".join(f"s{i}" for i in range(60))), (51, "only here " + " ".join(f"s{i}" for i in range(60)))]
    rows += [(51, " ".join(f"t{i}" for i in range(60))), (51, " ".join(f"u{i}" for i in range(60))), (52, " ".join(f"u{i}" for i in range(61)))]
    rows += [(51, " ".join(f"t{i}" for i in range(60))), (53, " ".join(f"t{i}" for i in range(62)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = Counter(brute.jaccard_groups(rows))
    assert {c for i, _, c in want if i > 49} == {50} and {c for i, _, c in want if i in (30, 31)} == {30}
    for long_list in (64, 2):
        assert Counter(tuple(r) for r in jaccard.jaccard_groups(docs, long_list=long_list).collect()) == want


def test_jaccard_repeated_rows_of_a_family(spark):
    words = [f"w{i}" for i in range(1000)]
    p = [*words[150:], *(f"x{i}" for i in range(150))]
    q = [*words[150:], *(f"x{i}" for i in range(60)), *(f"y{i}" for i in range(90))]
    rows = [(1, " ".join(words))] * 6 + [(10 + k, " ".join([*words, f"c{k}"])) for k in range(12)]
    rows += [(30, " ".join(p))] * 6 + [(31, " ".join(q))] * 6
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.component_id) for r in jaccard.jaccard_groups(docs, words=1).collect()}
    assert got == {(i, 1 if i < 30 else 30) for i, _ in rows}


def test_words_do_not_collide_by_structure(spark):
    """A long word and its complement, on which polynomial hashes modulo 2**64 agree, in otherwise different texts."""
    bits = [0]
    for _ in range(11):
        bits += [1 - b for b in bits]
    rows = []
    for k, n in enumerate((512, 1024, 2048)):
        one = "".join("ab"[b] for b in bits[:n])
        other = one.translate(str.maketrans("ab", "ba"))
        rows += [(10 * k, f"{one} p q r s"), (10 * k + 1, f"{other} p q r s"), (10 * k + 2, f"{one}  p\nq r S")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(docs).collect()}
    assert got == {i: (1, i - 2 if i % 10 == 2 else i) for i, _ in rows}


def test_columns_with_dots_pass_the_near_duplicates(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (2, "a b c d e f", "z")], ["doc_id", "text", "a.b"])
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(1, "a b c d e f", "x")]


def test_texts_longer_than_a_slice(spark):
    """Repeats are found across the pieces of a long text, also where a piece ends within one."""
    import random

    from stratus.llm.arrays import SLICE_BYTES

    rng = random.Random(8)
    noise = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    passage = noise(700)
    long = noise(SLICE_BYTES - 300) + passage + noise(2 * SLICE_BYTES - 950) + passage + noise(SLICE_BYTES)
    docs = spark.createDataFrame([(1, long), (2, passage[:199]), (3, passage[100:300] + "é"), (4, noise(50))], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixdedup.remove_repeats(docs, cleaned=False).collect()}
    assert got == {1: (len(long), 1400, 2), 2: (199, 0, 0), 3: (202, 200, 1), 4: (50, 0, 0)}
