"""The backoff automaton against a direct evaluation of the smoothed model, and held-out quality."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stratus.llm.lmscore import Automaton, Block, Totals, pack, score_texts, unpack


def _brute(rows, order, strength):
    texts = []
    for i, t in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        texts.append((i, zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2, [*words, b""]))
    c = Counter()
    for _, train, words in texts:
        if train:
            seq = [None, *words]
            c[(None,)] += 1
            c.update(tuple(seq[i - n + 1 : i + 1]) for n in range(1, order + 1) for i in range(1, len(seq)) if i - n + 1 >= 0)
    single = {k: n for k, n in c.items() if len(k) == 1 and k != (None,)}
    total = sum(single.values()) + len(single) + 1

    def p(h, w):
        if not h:
            return (c[(w,)] + 1) / total
        return (c[(*h, w)] + strength * p(h[1:], w)) / (c[h] + strength)

    for i, train, words in texts:
        seq = [None, *words]
        base = sum(math.log10((c[(w,)] + 1) / total) for w in words)
        score = sum(math.log10(p(tuple(seq[max(0, k - order + 1) : k]), seq[k])) for k in range(1, len(seq)))
        yield i, not train, len(words), sum((w,) in c for w in words), sum(single.values()), round(base, 6), round(score, 6)


def _rows(df):
    return Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0, round(r.score, 6) + 0.0) for r in df.collect())


@pytest.mark.parametrize(
    ("order", "block_bytes", "part_entries"),
    [(2, 16 << 20, 1 << 20), (1, 4000, 50), (2, 2000, 300), (3, 9000, 1 << 20)],  # small blocks: counts come from many of them
)
def test_scores(spark, hard_docs, hard_rows, no_docs, order, block_bytes, part_entries):
    docs = hard_docs.withColumnRenamed("note", "score").withColumnRenamed("lang", "block")
    got = _rows(score_texts(docs, order=order, strength=7.0, block_bytes=block_bytes, part_entries=part_entries))
    want = Counter(tuple(x + 0.0 if isinstance(x, float) else x for x in r) for r in _brute(hard_rows, order, 7.0))
    assert got == want
    assert score_texts(no_docs, order=order).count() == 0


def test_no_training_text(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    out = score_texts(spark.createDataFrame([(i, "some words here") for i in held], "doc_id int, text string")).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in out] == [(True, 4, 0, 0, 0.0, 0.0)] * 3


def test_text_ids(spark):
    out = score_texts(spark.createDataFrame([("x", "a b"), ("x", "a b"), (None, None)], "doc_id string, text string")).collect()
    assert len(out) == 3 and {r.score for r in out if r.doc_id == "x"} == {next(r.score for r in out if r.doc_id == "x")}


def test_probabilities_of_a_state_sum_to_one():
    rng = np.random.default_rng(4)
    texts = [rng.integers(1, 9, rng.integers(0, 12)) for _ in range(40)]
    tokens = np.concatenate([np.r_[t, 0] for t in texts]).astype(np.int32)
    ends = np.cumsum([0, *(len(t) + 1 for t in texts)])
    b = Block(np.ones(40, bool), ends, [b""] + [bytes([64 + i]) for i in range(1, 9)], tokens)
    for order in (1, 2, 3):
        grams = b.grams(order)
        counts = np.concatenate([g.train for g in grams])
        types = int((grams[0].train > 0).sum())
        model = Automaton(9, grams, counts, Totals(len(tokens), types, 40), 3.0)
        unknown = 1 / (len(tokens) + types + 1)
        root = 10**model.base
        assert np.isclose(root[model.known].sum() + unknown, 1)

        def spread(state, model=model, root=root, unknown=unknown):
            if state == 0:
                return np.r_[root, unknown]
            low = spread(model.fail[state]) * 10 ** model.back[state]
            own = (model.key >= state * 9) & (model.key < (state + 1) * 9)
            low[model.key[own] - state * 9] = 10 ** model.weight[own]
            return low

        followed = {0, *(model.key[:-1] // 9).tolist()}  # nothing follows an end
        assert len(followed) >= (1 if order == 1 else 9)
        for state in followed:
            assert np.isclose(spread(state).sum(), 1)


def test_held_out_texts_score_better_than_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    got = score_texts(docs).where("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    assert got["sum(score)"] > got["sum(base_score)"] + 0.2 * got["sum(n_tokens)"]


def test_packing():
    for x in (np.zeros(0, np.int64), np.arange(1000, dtype=np.int32), np.array([2**63 - 1, 0, -5])):
        assert (unpack(pack(x), x.dtype.type, len(x)) == x).all()
