"""Tokenizer alignment against the installed libraries and a direct count of all links."""

import hashlib
import json
import os
import re
from collections import Counter

import numpy as np
import pytest

from stratus.llm.alignment import Aligner, ByteLevel, align_tokenizers, byte_letters

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def vocabulary():
    with open(BYTE_LEVEL, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def other(vocabulary):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(vocabulary.decode())
    t.encode_special_tokens = True
    return t


def _brute(texts, vocabulary, model, other):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    letters = byte_letters()
    piece_a = {i: bytes(letters[c] for c in k) for k, i in json.loads(vocabulary)["model"]["vocab"].items()}

    def piece_b(i):
        s = sp.id_to_piece(i)
        return bytes([int(s[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", s) else s.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for t in texts:
        raw = (" " + (t or "")).encode()
        a = other.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        if not t or b"".join(piece_a[i] for i in a) != raw or b"".join(map(piece_b, b)) != raw:
            a, b = [], []
        ends = []
        for ids, piece in ((a, piece_a.__getitem__), (b, piece_b)):
            at, own = 0, []
            for i in ids:
                at += len(piece(i))
                own.append(at)
            ends.append(own)
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            links.append((a[k - 1], b[m - 1]))
            i, j = k, m
        counts.update(links)
        docs.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    rows = [
        (n_a, n_b, n, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), text)
        for n_a, n_b, n, links, text in docs
    ]
    return rows, counts


def test_alignment(spark, hard_docs, hard_rows, no_docs, vocabulary, model, other):
    more = [(200, "a▁b"), (201, "<|endoftext|> <s> </s>"), (202, "\x00é𐍈 ﬁ​\n\n tail  "), (203, " "), (204, "We'll see; I'd 12,345.67 é"), (205, "x" + " " * 30000 + "y")]
    cols = "doc_id long, text string, lang string, source string, n_chars long, note string, _spans string"
    docs = hard_docs.unionByName(spark.createDataFrame([(i, t, "", "", 0, "", "") for i, t in more], cols)).repartition(7)
    docs = docs.withColumnRenamed("note", "n_links").withColumnRenamed("lang", "_same")
    out, pairs = align_tokenizers(docs, vocabulary, model, written=True)
    got = Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in out.collect())
    rows = hard_rows + more
    want, counts = _brute([t for _, t in rows], vocabulary, model, other)
    assert got == Counter((i, *w) for (i, _), w in zip(rows, want))
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(counts)
    assert "text" not in out.columns and {"_same", "source", "_spans"} <= set(out.columns)
    digests = {r.groups: r.groups_sha256 for r in out.collect()}
    assert all(d == (hashlib.sha256(g.encode()).hexdigest() if g else "") for g, d in digests.items())
    nothing, none = align_tokenizers(no_docs, vocabulary, model)
    assert nothing.count() == 0 and none.count() == 0


def test_links_are_suffix_pairs(vocabulary, model):
    """The table of counts has a bound that the vocabularies alone decide."""
    aligner = Aligner(vocabulary, model)
    got = aligner.align(["Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich; 1,2,3 über über"])
    for code in np.frombuffer(got["pairs"][0], np.int64):
        x, y = aligner.a.pieces[code // aligner.size], aligner.b.pieces[code % aligner.size]
        assert aligner.same[code // aligner.size] != code % aligner.size
        assert x.endswith(y) or y.endswith(x)
    assert all(not aligner.b.own.is_byte(int(i)) for i in aligner.same[aligner.same >= 0] if len(aligner.b.pieces[i]) == 1 and aligner.b.pieces[i].isalpha())
    assert 100_000 < aligner.pair_bound() < 1_000_000


def test_byte_level_library_agrees(vocabulary, other):
    """Every character, beside letters, digits, marks and spaces."""
    own = ByteLevel(vocabulary)
    for start in range(0, 0x30000, 61):
        chars = [chr(c) for c in range(start, start + 61) if not 0xD800 <= c < 0xE000]
        text = " ".join(f"a{c}b {c}1{c}{c} 's\n{c}" for c in chars)
        assert own.encode(text) == other.encode(text, add_special_tokens=False).ids
