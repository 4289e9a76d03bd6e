"""Plain versions of the operators, written for few short texts."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_set(text, n=5):
    w = SPACE_WORD.findall(ascii_lower(text))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def jaccard_groups(rows, pct=80):
    """[(id, text)] -> {position: (set size, component)}; equal ids are one node, a null id none."""
    sets = [shingle_set(t) for _, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i, j = rows[a][0], rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                x, y = top(i), top(j)
                up[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else top(i) if s else i) for (i, _), s in zip(rows, sets)]


def removed(texts, length=200):
    """Flags of the bytes to remove, by text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        flags = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                flags[i : i + length] = True
        out.append((d, flags))
    return out


def dedup_row(d, flags):
    kept = bytes(b for b, f in zip(d, flags) if not f)
    runs = sum(1 for i, f in enumerate(flags) if f and (i == 0 or not flags[i - 1]))
    return len(d), int(flags.sum()), runs, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")


def contamination(text, items, n=13):
    """(words, hit words, item ids) of one text."""
    w = BENCH_WORD.findall(ascii_lower(text))
    hit, found = set(), set()
    for item, t in items:
        v = BENCH_WORD.findall(ascii_lower(t))
        size = min(n, len(v))
        windows = {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if v else set()
        for i in range(len(w) - size + 1):
            if tuple(w[i : i + size]) in windows:
                hit |= set(range(i, i + size))
                found.add(item)
    return len(w), len(hit), found


def unigram_count(word, scores, longest, penalty=10.0):
    """Tokens of the best segmentation by a table over all cuts."""
    s = "▁" + word
    floor = min(scores.values()) - penalty
    best = [(0.0, 0)] + [(-math.inf, 0)] * len(s)
    for end in range(1, len(s) + 1):
        n = len(s[end - 1].encode())
        options = [(best[end - 1][0] + n * floor, best[end - 1][1] - n)]
        options += [(best[a][0] + scores[s[a:end]], best[a][1] - 1) for a in range(max(0, end - longest), end) if s[a:end] in scores]
        best[end] = max(options)
    return -best[-1][1]


class _Symbol:
    def __init__(self, number, at):
        self.number, self.at = number, at


def merge_dropout(chunk, model, skipped, number=0):
    """(ids, number of the next candidate): all pairs are looked through for each merge; candidates are numbered
    as they come up, and one whose number is skipped stays away until one of its two symbols is replaced."""
    syms = [_Symbol(model.char.get(c, model.base - 1), i) for i, c in enumerate(chunk)]
    away = set()
    while True:
        options = []
        for j, (a, b) in enumerate(zip(syms, syms[1:])):
            k = model.merge.get(a.number * model.base + b.number)
            if k is not None and (a, b) not in away:
                options.append((k, j))
        if not options:
            break
        k, j = min(options)
        if number in skipped:
            away.add((syms[j], syms[j + 1]))
        else:
            syms[j : j + 2] = [_Symbol(k, syms[j].at)]
        number += 1
    ids = []
    for s in syms:
        ids += [model.ids[s.number]] if s.number < model.base - 1 else [model.byte[x] for x in chunk[s.at].encode()]
    return ids, number


def encode_with_draws(text, doc, model, seed, rate):
    """A text's pieces with its own stream of draws, nothing kept between chunks."""
    from stratus.llm import pieces

    draws, hits = pieces.Draws(f"{seed}/{doc}", rate), set()
    while not hits or max(hits) < 3 * len(text) + 10:
        hits |= set(draws.block(64))
    ids, number = [], 0
    for chunk in pieces._CHUNK.findall(" " + text) if text else ():
        cut = len(chunk) - 1 if re.search(r"[A-Za-zÀ-ÿ][.,!?;:]\Z", chunk) else len(chunk)
        for part in filter(None, (chunk[:cut], chunk[cut:])):
            own, number = merge_dropout(part, model, hits, number)
            ids += own
    return ids
