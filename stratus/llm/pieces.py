"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Merges are taken from an agenda in the order of their scores, as the model's own
encoder takes them, but each candidate is skipped when its keyed draw says so.
The draws of a text are a stream keyed by the seed and the document: one for
each candidate that the agenda brings up, chunk after chunk, so a word's
segmentation differs from place to place and from document to document, and a
run repeats exactly. Nothing is normalised: decoding gives back every text
unchanged.

A part's segmentation depends on nothing but which of its candidates were
skipped, so forms are kept by part and skipped candidates. What is not known
yet is merged many parts at a time: first the parts of a batch without skips,
then, as each text's place in its stream depends on what came before, one part
of each of many texts at a time.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from bisect import bisect_right
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrays import mix
from .frames import task_cache, with_results

SPACE = "▁"
_CHUNK = re.compile(r" *[^ \n]+| +|\n")
_MARKS = ".,!?;:"
# the same cut again before a mark that ends a chunk after a letter
_PART = re.compile(rf" *[^ \n]+(?<![A-Za-zÀ-ÿ][{_MARKS}])| +|\n|[{_MARKS}]")
_CACHE = 1 << 20  # forms that are kept
_SHORT = 48
_NEVER = 1 << 30
_ROW = 24  # parts of at most so many characters are merged many at a time
_ROWS = 1 << 12
_TEXTS = 1 << 10  # texts that are worked on side by side
_FEW = 24  # fewer texts, or parts, are worked on one by one
_BITS = 62  # skips of a row are bits of one number
_PAD = -1
_PLACE = 5  # bits of a place in a row
_NO_PIECE = _NEVER >> _PLACE
_FORM = 32  # bits of a form's number
_GATHERED = 8 << 20  # bytes of texts that are worked on at once


_NO_DRAW = 1 << 62


class Draws:
    """The keyed stream of a text: the numbers of the candidates that are skipped, rising.

    The gaps between them are geometric, made from hashes of (key, count), which gives each candidate the same
    chance ``rate`` on its own.
    """

    def __init__(self, key: str, rate: float) -> None:
        self.key = np.uint64(int.from_bytes(blake2b(key.encode(), digest_size=8).digest(), "little"))
        self.rate, self.made, self.last = rate, 0, -1

    def block(self, n: int = 256) -> list[int]:
        """The next ``n`` numbers."""
        return self._next(n).tolist() if self.rate > 0 else [_NO_DRAW]

    def below(self, end: int) -> np.ndarray:
        """The numbers from here on, at least all below ``end``, then one that is never reached."""
        found = [np.zeros(0, np.int64)]
        while self.rate > 0 and self.last < end:
            found.append(self._next(int((end - self.last) * self.rate * 1.1) + 16))
        return np.append(np.concatenate(found), _NO_DRAW)

    def _next(self, n: int) -> np.ndarray:
        at = np.arange(self.made, self.made + n, dtype=np.uint64)
        u = (mix(self.key + at * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        gaps = np.zeros(n) if self.rate >= 1 else np.floor(np.log1p(-u) / np.log1p(-self.rate))
        found = self.last + np.cumsum(gaps.astype(np.int64) + 1)
        self.made, self.last = self.made + n, int(found[-1])
        return found


class PieceModel:
    """Pieces and merges of a BPE model with byte fallback.

    Pieces are numbered by falling score, so that a piece's number is its place
    in the order of merges.
    """

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.raw: list[bytes] = [b""] * n
        self.byte = [0] * 256
        normal = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte[b], self.raw[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append((-sp.get_score(i), i, piece))
                self.raw[i] = piece.replace(SPACE, " ").encode()
        normal.sort()
        self.ids = [i for _, i, _ in normal]
        number = {piece: k for k, (_, _, piece) in enumerate(normal)}
        # chunks are cut where no piece can reach across: before a run of spaces and around line ends
        # and, where that spares segmentations, between a letter and a mark
        if any("\n" in p or re.search(f"[^{SPACE}]{SPACE}|[A-Za-zÀ-ÿ][{_MARKS}]", p) for p in number):
            raise ValueError("a piece of the model reaches across the cuts of the text")
        self.char = {c: k for c, k in number.items() if len(c) == 1}
        # a literal U+2581 would decode as a space, so it has no number and goes to bytes
        self.base = len(number) + 1  # pairs of numbers as one; the last number is that of all other characters
        self.char[" "] = self.char.pop(SPACE, len(number))
        self.merge = {
            number[p[:i]] * self.base + number[p[i:]]: k
            for p, k in number.items()
            for i in range(1, len(p))
            if p[:i] in number and p[i:] in number
        }
        self._place_pairs()
        # in rows a character without a number is base + its code point
        self.number = np.arange(self.base, self.base + 0x110000, dtype=np.int32)
        for c, k in self.char.items():
            if k < self.base - 1:
                self.number[ord(c)] = k
        self.id = np.array([*self.ids, 0], np.int32)

    def segment(self, chunk: str, skips: tuple[int, ...] = ()) -> tuple[list[int], int]:
        """Ids of one chunk when the candidates numbered ``skips`` (rising, as the agenda brings them up) are
        skipped, and how many candidates the agenda has brought up."""
        other = self.base - 1
        char = self.char.get
        sym = [char(c, other) for c in chunk]
        at = list(range(len(sym)))
        n = (self._merge_short if len(sym) <= _SHORT else self._merge_long)(sym, at, skips)
        ids: list[int] = []
        for k, i in zip(sym, at):
            if k < other:
                ids.append(self.ids[k])
            else:
                ids += [self.byte[x] for x in chunk[i].encode()]
        return ids, n

    def segment_rows(self, parts: list[str], skips: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:meth:`segment` of many parts, none longer than ``_ROW``: all ids, how many each part has, and the
        numbers of candidates. ``skips`` has the skipped candidates of a part as bits."""
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        sym = np.full((len(parts), size.max() + 2), _PAD, np.int32)
        sym[:, 1:-1][np.arange(size.max()) < size[:, None]] = self.number[np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32)]
        sym = np.ascontiguousarray(sym.T)
        n = self._merge_rows(sym, None if skips is None else np.array(skips, np.int64))
        real = sym.T != _PAD
        flat, count = sym.T[real], real.sum(axis=1)
        if not (flat >= self.base).any():
            return self.id[flat], count, n
        odd, at = np.unique(flat[flat >= self.base], return_inverse=True)  # characters that need bytes
        raw = [chr(c - self.base).encode() for c in odd.tolist()]
        size = np.array([len(r) for r in raw])
        start, length = flat.astype(np.int64), np.ones(len(flat), np.int64)
        start[flat >= self.base] = (self.base + np.cumsum(size) - size)[at]
        length[flat >= self.base] = size[at]
        ids = np.append(self.id, np.array([self.byte[x] for r in raw for x in r], np.int32))
        ends = np.append(0, np.cumsum(length))[np.append(0, np.cumsum(count))]
        return _ranges(ids, start, length), np.diff(ends), n

    def _place_pairs(self) -> None:
        """Puts ``merge`` into one table for many look-ups at once: a pair lies at the left symbol's offset plus the
        right symbol, where ``owner`` is the left symbol. Offsets are the first at which all pairs of it find room."""
        rights: dict[int, list[int]] = {}
        for key in self.merge:
            rights.setdefault(key // self.base, []).append(key % self.base)
        self.offset = np.zeros(self.base, np.int64)
        used = np.zeros(2 * self.base + _ROWS, bool)
        size = at = 0
        for left, right in sorted(rights.items(), key=lambda x: -len(x[1])):
            if len(right) != size:
                size, at = len(right), 0  # what was full for as many is not tried again
            while True:
                if at + 64 + self.base > len(used):
                    used = np.append(used, np.zeros(len(used), bool))
                free = ~used[at + np.arange(64)[:, None] + np.array(right)].any(axis=1)
                if free.any():
                    break
                at += 64
            at += int(free.argmax())
            self.offset[left] = at
            used[at + np.array(right)] = True
        self.owner, self.made = np.full(len(used), -2, np.int32), np.zeros(len(used), np.int32)
        for key, k in self.merge.items():
            slot = self.offset[key // self.base] + key % self.base
            self.owner[slot], self.made[slot] = key // self.base, k

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the piece that two symbols make, or ``_NO_PIECE``."""
        left, right = np.minimum(left, self.base - 1), np.minimum(right, self.base - 1)
        slot = self.offset[left] + right
        return np.where(self.owner[slot] == left, self.made[slot], np.int32(_NO_PIECE))

    def _merge_rows(self, sym: np.ndarray, skips: np.ndarray | None) -> np.ndarray:
        """Merges in all rows at once, one candidate of each at a time, and returns how many each has brought up.

        A row is a column of ``sym`` that begins and ends with padding; a symbol that is gone becomes padding.
        An entry of the agenda has its place in the low bits, so the least is the leftmost of equal pieces.
        """
        w = sym.shape[1]
        place = np.arange(len(sym), dtype=np.int32)[:, None]
        agenda = np.full(sym.shape, _NEVER, np.int32)
        agenda[:-1] = self._pair(sym[:-1], sym[1:]) << _PLACE | place[:-1]
        left, right = np.repeat(place - 1, w, axis=1).ravel(), np.repeat(place + 1, w, axis=1).ravel()
        symbols, offers, brought, step = sym.ravel(), agenda.ravel(), np.zeros(w, np.int64), 0
        while True:
            best = agenda.min(axis=0)
            at = np.flatnonzero(best < _NEVER)
            if not len(at):
                return brought
            brought[at] += 1
            best = best[at]
            a = (best & (1 << _PLACE) - 1) * w + at
            if skips is not None:
                skip = (skips[at] >> min(step, _BITS)) & 1 > 0
                offers[a[skip]] = _NEVER  # until a neighbour changes, which makes it another candidate
                merged = ~skip
                at, best, a = at[merged], best[merged], a[merged]
            step += 1
            made = best >> _PLACE
            b = right[a] * w + at
            after = right[b]
            symbols[a], symbols[b], offers[b] = made, _PAD, _NEVER
            right[a] = after
            c = after * w + at
            left[c] = a // w
            d = left[a] * w + at
            near = self._pair(np.concatenate([symbols[d], made]), np.concatenate([made, symbols[c]]))
            both = np.concatenate([d, a])
            offers[both] = near << _PLACE | both // w

    def _merge_short(self, sym: list[int], at: list[int], skips: tuple[int, ...]) -> int:
        """Merges in place; the agenda is a plain list, one entry for each pair of neighbours."""
        merge, base, never, n = self.merge.get, self.base, _NEVER, 0
        agenda = [merge(a * base + b, never) for a, b in zip(sym, sym[1:])]
        while agenda:
            best = min(agenda)
            if best == never:
                break
            i = agenda.index(best)  # the leftmost of equal pieces
            n += 1
            if skips and n - 1 in skips:
                agenda[i] = never  # until a neighbour changes, which makes it another candidate
                continue
            sym[i] = best
            del sym[i + 1], at[i + 1], agenda[i]
            if i:
                agenda[i - 1] = merge(sym[i - 1] * base + best, never)
            if i < len(agenda):
                agenda[i] = merge(best * base + sym[i + 1], never)
        return n

    def _merge_long(self, sym: list[int], at: list[int], skips: tuple[int, ...]) -> int:
        """The same with a heap, for chunks of any length."""
        n = len(sym)
        left, right, gone = list(range(-1, n - 1)), [*range(1, n), -1], [False] * n
        agenda: list[tuple[int, int, int, int, int]] = []
        skip, brought = set(skips), 0

        def offer(a: int, b: int) -> None:
            if a >= 0 and b >= 0:
                k = self.merge.get(sym[a] * self.base + sym[b])
                if k is not None:
                    heapq.heappush(agenda, (k, a, b, sym[a], sym[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            k, a, b, x, y = heapq.heappop(agenda)
            if gone[a] or gone[b] or sym[a] != x or sym[b] != y or right[a] != b:
                continue  # one side has been merged meanwhile
            brought += 1
            if brought - 1 in skip:
                continue
            sym[a], gone[b], right[a] = k, True, right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        keep = [i for i in range(n) if not gone[i]]
        sym[:], at[:] = [sym[i] for i in keep], keep
        return brought

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.raw.__getitem__, ids.tolist())).decode()[1:]


def _ranges(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``values`` from each start on, so many as its length says, one after the other."""
    ends = np.cumsum(length)
    return values[np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]


class _Numbers(dict):
    """Numbers of parts; a new part gets the next one and is noted in ``fresh``."""

    def __init__(self) -> None:
        self.first, self.fresh = 0, []

    def __missing__(self, part: str) -> int:
        number = self[part] = self.first + len(self.fresh)
        self.fresh.append(part)
        return number


class Encoder:
    """Encodes texts; segmentations of parts are kept, up to a bounded number.

    A form is a part's segmentation with some candidates skipped. Forms are numbered: ``n`` has their numbers of
    candidates, ``start`` and ``length`` say where their ids lie in ``ids``. ``known`` has a part's undropped form,
    ``varied`` the one for a form and skips. Before texts are encoded all are emptied when more than ``_CACHE`` forms
    are held, so the forms of one call are the bound's only excess.
    """

    def __init__(self, model: bytes, seed: int, rate: float) -> None:
        self.model = PieceModel(model)
        self.seed, self.rate = seed, rate
        self._empty()

    def _empty(self) -> None:
        self.known, self.varied = _Numbers(), {}
        self.parts: list[str] = []
        self.size, self.n, self.start, self.length, self.ids = array("q"), array("q"), array("q"), array("q"), array("i")

    def encode(self, text: str, doc: object) -> np.ndarray:
        return self.encode_all([text], [doc])[0]

    def encode_all(self, texts: list[str], docs: list) -> list[np.ndarray]:
        """Ids of each text; no text's ids depend on the others."""
        if len(self.n) >= _CACHE:
            self._empty()
        self.known.first, self.known.fresh = len(self.n), []
        number, forms, cuts = self.known.__getitem__, array("q"), [0]
        for text in texts:
            if text:
                forms.extend(map(number, _PART.findall(" " + text)))
            cuts.append(len(forms))
        self._learn(self.known.fresh)
        forms = np.array(forms, np.int64)
        if self.rate > 0 and len(forms):
            self._skip(forms, np.array(cuts), docs)
        ids, start, length = (np.array(x) for x in (self.ids, self.start, self.length))
        return [_ranges(ids, start[f], length[f]) for f in (forms[a:b] for a, b in zip(cuts, cuts[1:]))]

    def _add(self, parts: list[str], ids: np.ndarray, count: np.ndarray, n: np.ndarray, order: list[int] | None = None) -> int:
        """Appends forms, each at its place in ``order``, and returns the number of the first."""
        first, start = len(self.n), len(self.ids) + np.cumsum(count) - count
        for to, values in (self.start, start), (self.length, count), (self.n, n):
            placed = np.array(values, np.int64)
            if order is not None:
                placed[order] = values
            to.frombytes(placed.tobytes())
        self.ids.frombytes(np.asarray(ids, np.int32).tobytes())
        self.parts += parts
        self.size.extend(map(len, parts))
        return first

    def _learn(self, fresh: list[str]) -> None:
        """The undropped forms of new parts."""
        if not fresh:
            return
        order = sorted(range(len(fresh)), key=lambda k: len(fresh[k]))
        parts = [fresh[k] for k in order]
        short = bisect_right(parts, _ROW, key=len)
        made = [self.model.segment_rows(parts[at : min(at + _ROWS, short)]) for at in range(0, short, _ROWS)]
        made += [(ids, [len(ids)], [n]) for ids, n in map(self.model.segment, parts[short:])]
        self._add(fresh, *map(np.concatenate, zip(*made)), order)

    def _skip(self, forms: np.ndarray, cuts: np.ndarray, docs: list) -> None:
        """Puts the form with its skips in the place of each form that the draws of its text hit.

        Where a part begins in its text's stream depends on the skips before it, so many texts are worked on side by
        side, each at its next part that is hit.
        """
        size = np.array(self.size)[forms]
        ends = np.append(0, np.cumsum(np.array(self.n)[forms]))  # of all texts in a row, without skips
        first, last = ends[cuts[:-1]], ends[cuts[1:]]
        # each candidate is another pair: of size - 1 at first, and each of at most size - 1 merges makes two
        reach = np.diff(np.append(0, np.cumsum(3 * size - 3))[cuts])
        found = [Draws(f"{self.seed}/{doc}", self.rate).below(end) for doc, end in zip(docs, reach.tolist())]
        draws_end = np.cumsum([len(x) for x in found])
        draws, draws_at = np.concatenate(found), np.append(0, draws_end[:-1])
        queue = np.argsort(first - last, kind="stable")  # the longest first, so that none is left alone
        queue = queue[last[queue] > first[queue]]
        text = hit = moved = np.zeros(0, np.int64)  # moved: what skips have brought up so far, less what they have spared
        while len(text) or len(queue):
            if len(text) <= _TEXTS // 2:
                new, queue = np.split(queue, [_TEXTS - len(text)])
                text, hit = np.append(text, new), np.append(hit, draws_at[new])
                moved = np.append(moved, np.zeros_like(new))
            if len(text) < _FEW:
                for i, k, m in zip(text.tolist(), hit.tolist(), moved.tolist()):
                    a, b = cuts[i : i + 2]
                    self._skip_alone(forms[a:b], (ends[a + 1 : b + 1] - first[i]).tolist(), draws[k : draws_end[i]].tolist(), m)
                return
            at = draws[hit] - moved
            on = at < (last - first)[text]
            text, hit, moved = text[on], hit[on], moved[on]
            part = np.searchsorted(ends, at[on] + first[text], side="right") - 1
            begin = ends[part] - first[text] + moved
            made = self._skipped(forms[part], size[part], begin, draws, hit, draws_end[text])
            forms[part] = made
            end = begin + np.array([self.n[form] for form in made], np.int64)
            moved = end - (ends[part + 1] - first[text])
            hit = hit + 1
            while (behind := draws[hit] < end).any():
                hit = hit + behind

    def _skip_alone(self, forms: np.ndarray, ends: list[int], draws: list[int], moved: int) -> None:
        """:meth:`_skip` for what is left of one text."""
        k = j = 0
        while draws[k] - moved < ends[-1]:
            j = bisect_right(ends, draws[k] - moved, j)
            form = int(forms[j])
            size = self.size[form]
            begin = ends[j] + moved - self.n[form]
            at, top, most = k, begin + size - 1, begin + 3 * size - 3
            while draws[at] < top and draws[at] < most:
                at, top = at + 1, top + 1
            skips = [x - begin for x in draws[k:at]]
            if size > _ROW or skips[-1] >= _BITS:
                new = self._vary_one(form, skips)
            else:
                key = sum(1 << x for x in skips) << _FORM | form
                new = self.varied.get(key)
                if new is None:
                    new = self.varied[key] = self._vary_one(form, skips)
            forms[j] = new
            end = begin + self.n[new]
            moved = end - ends[j]
            while draws[k] < end:
                k += 1

    def _skipped(
        self, form: np.ndarray, size: np.ndarray, begin: np.ndarray, draws: np.ndarray, hit: np.ndarray, end: np.ndarray
    ) -> list[int]:
        """Numbers of the forms with the skips that the draws from ``hit`` on ask for when a part begins at ``begin``."""
        bits, short = np.zeros(len(form), np.int64), size <= _ROW
        at, top = hit, begin + size - 1  # size - 1 merges at most, and one candidate more for each skip
        while (inside := short & (draws[at] < np.minimum(top, begin + 3 * size - 3))).any():
            skip = draws[at] - begin
            short &= ~inside | (skip < _BITS)
            bits |= np.where(inside, 1 << np.minimum(skip, _BITS - 1), 0)
            at, top = at + inside, top + inside
        keys = [b << _FORM | f for f, b in zip(form.tolist(), bits.tolist())]
        made = [self.varied.get(key, -1) for key in keys]
        for i in np.flatnonzero(~short).tolist():
            skips = draws[hit[i] : end[i]] - begin[i]
            made[i] = self._vary_one(form[i], skips[: np.searchsorted(skips, 3 * size[i])].tolist())
        if -1 in made:
            self._vary(list({key for key, known in zip(keys, made) if known < 0}))
            made = [self.varied[key] if known < 0 else known for key, known in zip(keys, made)]
        return made

    def _vary(self, keys: list[int]) -> None:
        """The forms of keys (bits of skips above the number of the undropped form), many at a time."""
        parts, bits = [self.parts[key & (1 << _FORM) - 1] for key in keys], [key >> _FORM for key in keys]
        if len(keys) < _FEW:
            self.varied.update(
                (key, self._vary_one(key & (1 << _FORM) - 1, [x for x in range(b.bit_length()) if b >> x & 1]))
                for key, b in zip(keys, bits)
            )
        else:
            first = self._add(parts, *self.model.segment_rows(parts, bits))
            self.varied.update(zip(keys, range(first, first + len(keys))))

    def _vary_one(self, form: int, skips: list[int]) -> int:
        part = self.parts[form]
        ids, n = self.model.segment(part, tuple(skips))
        self.parts.append(part)
        for to, value in (self.size, len(part)), (self.n, n), (self.start, len(self.ids)), (self.length, len(ids)):
            to.append(value)
        self.ids.extend(ids)
        return len(self.n) - 1


RESULTS: list[tuple[str, T.DataType]] = [("piece_ids", T.ArrayType(T.IntegerType())), ("decoded_text", T.StringType())]


def encode_pieces(
    docs: DataFrame,
    model: bytes,
    doc: str = "doc_id",
    text: str = "text",
    seed: int = 17,
    rate: float = 0.1,
    decode: bool = True,
) -> DataFrame:
    """``docs`` with ``piece_ids`` and, if asked, ``decoded_text`` (the ids decoded again).

    ``model`` is the content of the model file: it is of a fixed size and goes
    out with the tasks, so no executor needs the file. A text's draws come from
    the document's id and the seed; rows of equal id and text get equal ids. A
    null text gives no ids and decodes to ""; rate 0 is the model's own encoding.
    Input columns named like an added one are replaced.
    """
    added = RESULTS if decode else RESULTS[:1]
    return with_results(docs, added, partial(_encode_batch, docs.sparkSession.sparkContext.broadcast(model), (seed, rate), doc, text, decode), _GATHERED)


_encoders: dict[tuple, Encoder] = task_cache()


def _encode_batch(model, setting: tuple, doc: str, text: str, decode: bool, batch: pa.RecordBatch) -> dict[str, object]:
    key = (zlib.crc32(model.value), *setting)
    if key not in _encoders:  # once for each Python worker
        _encoders.clear()
        _encoders[key] = Encoder(model.value, *setting)
    encoder = _encoders[key]
    names = batch.schema.get_field_index
    ids = encoder.encode_all([t or "" for t in batch.column(names(text)).to_pylist()], batch.column(names(doc)).to_pylist())
    ends = np.append(0, np.cumsum([len(x) for x in ids]))
    texts = [encoder.model.decode(x) for x in ids] if decode else []
    flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
    out = {"piece_ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)}
    return out | ({"decoded_text": pa.array(texts, pa.string())} if decode else {})
