"""Token counts under a unigram model by dynamic programming over a shared trie.

The distinct pre-tokens of a task go into one trie. The forward score of a
prefix (best segmentation up to there) depends on the prefix alone, so it is
computed once for each trie node, whichever pre-tokens share it; the count at
a pre-token's last node is its number of tokens.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import task_cache, with_results

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = "▁"
_GROUP_CHARS = 2_000_000


def unigram_scores(model: bytes) -> dict[str, float]:
    """Log scores of the pieces of a rank-ordered model: Zipf's law over the rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    normal = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
    normal.sort(key=lambda i: (-sp.get_score(i), i))
    return {sp.id_to_piece(i): -math.log(rank + 2) for rank, i in enumerate(normal)}


class CountTrie(dict):
    """Pre-token -> number of tokens.

    ``insert`` takes pre-tokens in sorted order, which walks their trie depth
    first: only the path to the current node is held, and each node's forward
    score is computed when the walk first reaches it. A character that no piece
    covers counts as its UTF-8 bytes, each scored ``penalty`` below the worst
    piece. Among equal scores the fewer tokens win.
    """

    def __init__(self, scores: dict[str, float], penalty: float = 10.0) -> None:
        super().__init__()
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - penalty
        self.nodes = 0

    def insert(self, words: Iterable[str]) -> None:
        get, longest = self.scores.get, self.longest
        before, score, count = "", [0.0], [0]
        for word in sorted(words):
            s = SPACE + word
            shared = 0
            for a, b in zip(before, s):
                if a != b:
                    break
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(s) + 1):
                n = len(s[end - 1].encode())
                best, fewest = score[end - 1] + n * self.byte, count[end - 1] + n
                for a in range(end - longest if end > longest else 0, end):
                    x = get(s[a:end])
                    if x is not None:
                        x += score[a]
                        if x > best or (x == best and count[a] + 1 < fewest):
                            best, fewest = x, count[a] + 1
                score.append(best)
                count.append(fewest)
            self.nodes += len(s) - shared
            self[word] = count[-1]
            before = s


RESULTS: list[tuple[str, T.DataType]] = [("n_pretokens", T.LongType()), ("n_tokens", T.LongType())]
_tries: dict[tuple, CountTrie] = task_cache()


def count_tokens(docs: DataFrame, model: bytes, text: str = "text", max_known: int = 1 << 19) -> DataFrame:
    """``docs`` with ``n_pretokens`` (words) and ``n_tokens`` of each whole text.

    Narrow: counts live in the Python worker and are forgotten when there are
    ``max_known`` of them, which never changes a result. Null and empty texts
    have no tokens; input columns named like an added one are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return with_results(docs, RESULTS, partial(_count_batch, shared, text, max_known))


def _count_batch(model, text: str, max_known: int, batch: pa.RecordBatch) -> dict[str, object]:
    key = zlib.crc32(model.value)
    if key not in _tries:  # once for each Python worker
        _tries.clear()
        _tries[key] = CountTrie(unigram_scores(model.value))
    trie = _tries[key]
    words, tokens, waiting, chars = [], [], [], 0
    col = batch.column(batch.schema.get_field_index(text))
    for i, t in enumerate(col):
        t = t.as_py() or ""
        waiting.append(WORD.findall(t))
        chars += len(t)
        if chars >= _GROUP_CHARS or i + 1 == len(col):  # the pre-tokens of many texts go in together
            if len(trie) > max_known:
                trie.clear()
            new = set().union(*waiting).difference(trie)
            trie.insert(new)
            words += map(len, waiting)
            tokens += [sum(map(trie.__getitem__, own)) for own in waiting]
            waiting, chars = [], 0
    return {"n_pretokens": pa.array(words, pa.int64()), "n_tokens": pa.array(tokens, pa.int64())}
