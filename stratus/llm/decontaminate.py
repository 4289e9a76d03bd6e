"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds the normalised word sequences of all benchmark items. Each
document's words stream through it; the state gives the longest suffix of what
was read that occurs in an item, so every window of ``n`` consecutive item words
is found in one pass. The items go to the executors as blocks of a bounded
number of words; each block has its own automaton.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import with_results

#: After A-Z are lower-cased; every byte of other scripts is a word character.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    """A-Z in lower case (as bytes, so other letters stay)."""
    return (text or "").encode().lower().decode()


def normalise(text: str | None) -> list[str]:
    return WORD.findall(lower(text))


@dataclass
class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the items of each n-word window."""

    n: int
    step: list[dict[str, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    windows: dict[int, set] = field(default_factory=dict)
    short: dict[int, dict[int, set]] = field(default_factory=dict)

    def _extend(self, last: int, w: str) -> int:
        """The state of the sequence at ``last`` with ``w`` added."""
        step, link, size = self.step, self.link, self.size
        if w in step[last]:
            q = step[last][w]
            return q if size[q] == size[last] + 1 else self._clone(last, q, w)
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if size[q] == size[p] + 1 else self._clone(p, q, w)
        return new

    def _clone(self, p: int, q: int, w: str) -> int:
        """Splits state ``q`` so that the sequences up to ``p`` plus ``w`` have a state of their own."""
        step, link, size = self.step, self.link, self.size
        copy = len(step)
        step.append(dict(step[q]))
        link.append(link[q])
        size.append(size[p] + 1)
        link[q] = copy
        while p >= 0 and step[p].get(w) == q:
            step[p][w] = copy
            p = link[p]
        return copy

    def ancestor(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of the sequences in ``state``."""
        link, size = self.link, self.size
        while state > 0 and size[link[state]] >= length:
            state = link[state]
        return state

    @classmethod
    def of(cls, items: list[tuple[object, list[str]]], n: int) -> SuffixAutomaton:
        a = cls(n)
        items = [(i, w) for i, w in items if w]
        for _, words in items:
            last = 0
            for w in words:
                last = a._extend(last, w)
        for item, words in items:  # states are final now: note whose windows end where
            state = 0
            for i, w in enumerate(words):
                state = a.step[state][w]
                if i + 1 >= n:
                    a.windows.setdefault(a.ancestor(state, n), set()).add(item)
            if len(words) < n:
                at = a.short.setdefault(a.ancestor(state, len(words)), {})
                at.setdefault(len(words), set()).add(item)
        # whole short items that end where a state's sequences end: those of the states on its link path
        a.ends = [()] * len(a.step)
        for s in sorted(range(1, len(a.step)), key=a.size.__getitem__):
            own = tuple(a.short.get(s, {}).items())
            a.ends[s] = a.ends[a.link[s]] + own
        return a

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], set]:
        """Word spans [a, b) hit by item windows, merged and ascending, and the items."""
        n, step, link, size, ends = self.n, self.step, self.link, self.size, self.ends
        root = step[0]
        state = length = 0
        spans: list[list[int]] = []
        found: set = set()
        for i, w in enumerate(words):
            at = step[state]
            if w in at:
                state = at[w]
                length += 1
            elif state == 0:
                continue
            else:
                while state and w not in step[state]:
                    state = link[state]
                if w in step[state]:
                    length = size[state] + 1
                    state = step[state][w]
                else:
                    state = length = 0
                    continue
            # a state may stand for several lengths; one match per state is enough for windows
            back = 0
            if length >= n:
                s = state
                if size[link[s]] >= n:
                    s = self.ancestor(s, n)
                found |= self.windows.get(s, set())
                back = length
            for k, items in ends[state]:
                if k <= length:
                    found |= items
                    back = max(back, k)
            if back:
                a = i + 1 - back
                while spans and spans[-1][1] >= a:
                    a = min(a, spans.pop()[0])
                spans.append([a, i + 1])
        return [(a, b) for a, b in spans], found


def item_blocks(benchmark: DataFrame, item: str, text: str, block_chars: int) -> list[list[tuple[object, list[str]]]]:
    """The items' words in blocks of about ``block_chars`` characters, each fetched by itself.

    The benchmark is the stated, small side; its size is measured first and a
    larger one is cut into hash blocks rather than sent as one.
    """
    b = benchmark.select(F.col(item).alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull())
    total = b.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-total // block_chars))
    return [
        [(r.i, normalise(r.t)) for r in b.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).toLocalIterator()]
        for k in range(n)
    ]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_words(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the characters from the first to the last word of each span."""
    at = [m.span() for m in WORD.finditer(lower(text))]
    out, done = [], 0
    for a, b in spans:
        out.append(text[done : at[a][0]])
        done = at[b - 1][1]
    return "".join(out) + text[done:]


#: Bytes of text that a block's automaton reads before the next block's is built.
GATHERED = 64 << 20
RESULTS: list[tuple[str, T.DataType]] = [
    ("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()),
    ("items_sha256", T.StringType()), ("contaminated", T.BooleanType()), ("longest_hit", T.LongType()),
]
CLEANED = ("cleaned_text", T.StringType())


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    n: int = 13,
    coverage_pct: int = 5,
    span_words: int | None = None,
    block_chars: int = 4_000_000,
    cleaned: bool = True,
) -> DataFrame:
    """``docs`` with hit counts, the items hit, the verdict and the text without the spans to remove.

    A document is contaminated if hit words make at least ``coverage_pct`` per
    cent of its words. Removed are all hit spans of contaminated documents and,
    if ``span_words`` is given, hit spans of at least that many words anywhere.
    Null and empty texts have no words and are clean; an empty benchmark leaves
    every document clean; a null item text holds no window; items of equal text
    are all listed. Input columns named like an added one are replaced.
    """
    spark = docs.sparkSession
    added = [*RESULTS, *([CLEANED] if cleaned else [])]
    blocks = [
        spark.sparkContext.broadcast(b) for b in item_blocks(benchmark, item, item_text, block_chars)
    ]  # the words alone; each Python worker builds its automaton once
    built: dict[int, SuffixAutomaton] = {}

    def per_batch(batch: pa.RecordBatch) -> dict[str, object]:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        counts: list[int] = []
        for k, block in enumerate(blocks):
            if k not in built:
                if len(blocks) > 1:
                    built.clear()  # one block's automaton in memory at a time
                built[k] = SuffixAutomaton.of(block.value, n)
            counts = []
            for i, t in enumerate(texts):
                words = normalise(t)
                counts.append(len(words))
                s, found = built[k].scan(words)
                if found:
                    spans[i] += s
                    items[i] |= found
        out: dict[str, list] = {c: [] for c, _ in added}
        for t, n_words, s, found in zip(texts, counts, spans, items):
            s = merge_spans(s)
            hit = sum(b - a for a, b in s)
            bad = hit > 0 and 100 * hit >= coverage_pct * n_words
            out["n_words"].append(n_words)
            out["n_hit"].append(hit)
            out["n_items"].append(len(found))
            out["items_sha256"].append(hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest())
            out["contaminated"].append(bad)
            out["longest_hit"].append(max((b - a for a, b in s), default=0))
            if cleaned:
                go = [x for x in s if bad or (span_words is not None and x[1] - x[0] >= span_words)]
                out["cleaned_text"].append(cut_words(t, go) if go else t or "")
        types = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.StringType(): pa.string()}
        return {c: pa.array(out[c], types[t]) for c, t in added}

    # the automata of several blocks take turns: then so much text is read by each
    return with_results(docs, added, per_batch, gather=GATHERED if len(blocks) > 1 else 0)
