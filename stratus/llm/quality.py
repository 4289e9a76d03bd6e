"""Line-first quality rules.

Each line with a word is judged on its own; failing lines are removed, and a
document that loses too large a share of its words is rejected. Document-level
measures (repeated word windows, symbols, repeated lines) are taken from the
whole original text. All work is per row: no shuffle, any text length.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .frames import with_results

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
#: Characters that end sentences, by script (Unicode's Sentence_Terminal, the ellipsis, and the Tibetan and Khmer
#: marks), and the letters of Thai and Lao, which are written without any.
SENTENCE_MARKS = (
    ".!?…‼‽⁇⁈⁉⸮⸼" "。！？．｡﹒﹖﹗" "։" "؝؞؟۔" "܀܁܂" "߹" "।॥" "།༎" "၊။" "።፧፨" "᙮" "។៕" "᠃᠉" "᥄᥅" "᭚᭛᭞᭟" "᰻᰼᱾᱿" "꓿꘎꘏꛳꛷꡶꡷꣎꣏꤯꧈꧉꩝꩞꩟꫰꫱꯫"
    "\u0e00-\u0eff"
)
_SENTENCE_MARK = re.compile(f"[{SENTENCE_MARKS}]")
_LOWER = re.compile(r"[a-zß-öø-ÿ]")
_UPPER = re.compile(r"[A-Z]")
#: Fixed phrases of page furniture; a line that holds one is boilerplate.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "click here to", "cookie policy", "enable javascript", "lorem ipsum",
    "privacy policy", "read more...", "sign up for our newsletter", "terms of service", "terms of use",
)
#: Fixed words of menus; a line of at most ``nav_words`` words, all of them here, is navigation.
NAVIGATION = frozenset("about back contact cookies faq help home imprint login logout menu next previous register search sitemap".split())
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)), re.ASCII | re.IGNORECASE)


@dataclass(frozen=True)
class Rules:
    """Limits. Shares are in per cent, compared as integers."""

    window: int = 5
    min_words: int = 10
    max_repeat_pct: int = 20
    max_line_symbol_pct: int = 20
    max_line_echo_pct: int = 50
    nav_separators: int = 2
    nav_words: int = 3
    shout_words: int = 3
    max_lost_pct: int = 30


def line_failure(line: str, words: list[str], rules: Rules) -> str | None:
    """The first rule that a line with words breaks, else None.

    symbols: symbol characters per word above the limit; navigation: several
    separators or only menu words; boilerplate: a fixed phrase; shouting:
    several words in capitals alone; echo: words that repeat the one before;
    punctuation: no sentence mark of any script in the line at all (lines with
    Thai or Lao letters need none).
    """
    n = len(words)
    symbols = sum(map(line.count, SYMBOLS))
    if 100 * symbols > rules.max_line_symbol_pct * n:
        return "symbols"
    if line.count("|") + line.count("»") + line.count("›") >= rules.nav_separators:
        return "navigation"
    if n <= rules.nav_words and all(w.lower() in NAVIGATION for w in words):
        return "navigation"
    if _BOILERPLATE.search(line):
        return "boilerplate"
    if n >= rules.shout_words and _UPPER.search(line) and not _LOWER.search(line):
        return "shouting"
    if n > 1 and 100 * sum(a == b for a, b in zip(words, words[1:])) > rules.max_line_echo_pct * n:
        return "echo"
    if not _SENTENCE_MARK.search(line):
        return "punctuation"
    return None


def repeated_words(words: list[str], window: int) -> int:
    """Words covered by windows that occur at least twice in ``words``."""
    grams = list(zip(*(words[i:] for i in range(window))))
    if len(set(grams)) == len(grams):
        return 0
    often = {g for g, c in Counter(grams).items() if c > 1}
    total = reach = 0
    for i, g in enumerate(grams):
        if g in often:
            total += i + window - max(reach, i)
            reach = i + window
    return total


def judge(text: str | None, rules: Rules) -> tuple:
    """(measures..., kept, lost words, failed lines by rule, cleaned text) of one text; null counts as empty."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    kept_lines, failed, dup, lost = [], Counter(), 0, 0
    for line in text.split("\n"):
        own = WORD.findall(line)
        if not own:
            kept_lines.append(line)
            continue
        dup += line in seen
        seen.add(line)
        why = line_failure(line, own, rules)
        if why:
            failed[why] += 1
            lost += len(own)
        else:
            kept_lines.append(line)
    repeat = repeated_words(words, rules.window)
    base_failed = n < rules.min_words or 100 * repeat > rules.max_repeat_pct * n
    kept = not base_failed and 100 * lost <= rules.max_lost_pct * n
    return (
        n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeat,
        base_failed, kept, lost, sum(failed.values()), "\n".join(kept_lines) if failed else text,
    )


MEASURES: list[tuple[str, T.DataType]] = [
    ("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
    ("kept", T.BooleanType()), ("n_lost_words", T.LongType()), ("n_failed_lines", T.LongType()),
]
CLEANED = ("cleaned_text", T.StringType())


def quality_rules(docs: DataFrame, text: str = "text", rules: Rules = Rules(), cleaned: bool = True) -> DataFrame:
    """``docs`` with the measures, the verdict ``kept`` and, if asked, ``cleaned_text``.

    A null or empty text has no words, fails the base rule and cleans to "".
    Rows are judged one by one, so repeated rows get equal results and an empty
    table gives an empty result; input columns named like an added one are replaced.
    """
    added = [*MEASURES, *([CLEANED] if cleaned else [])]
    types = {T.LongType(): pa.int64(), T.BooleanType(): pa.bool_(), T.StringType(): pa.string()}

    def per_batch(batch: pa.RecordBatch) -> dict[str, object]:
        col = batch.column(batch.schema.get_field_index(text))
        rows = [judge(t.as_py(), rules)[: len(added)] for t in col]
        return {n: pa.array([r[i] for r in rows], types[t]) for i, (n, t) in enumerate(added)}

    return with_results(docs, added, per_batch)
