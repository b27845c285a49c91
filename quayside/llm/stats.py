"""Statistics of a text for quality rules and classifiers: exact counts over the whole text, and shares of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

from quayside.llm.common import words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares; none is tied to a language, a source or the mere length of a text.
SHARES = ("symbols_per_word", "dup_line_share", "repeat_share", "upper_share", "shout_share", "distinct_share",
          "word_length", "digit_share", "bar_share", "top_word_share", "adjacent_share")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words in windows of consecutive words that the text has twice or more, the first included."""
    grams = list(zip(*[words[i:] for i in range(window)]))
    seen: set = set()
    twice: set = set()
    if len(set(grams)) == len(grams):
        return 0
    for g in grams:
        if g in seen:
            twice.add(g)
        else:
            seen.add(g)
    total, end = 0, 0
    for i, g in enumerate(grams):
        if g in twice:
            total += i + window - max(i, end)
            end = i + window
    return total


def count_row(text: str | None) -> tuple[int, ...]:
    """Values of COUNTS. Words are ``[^\\x20\\x09-\\x0D]+``; a line counts if it has a word."""
    words = words_of(text)
    if not words:
        return (0, 0, sum(map((text or "").count, SYMBOLS)), 0, 0)
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    return (len(words), len(b"".join(words).decode()), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words))


def share_row(text: str | None, counts: tuple[int, ...]) -> tuple[float, ...]:
    """Values of SHARES; all zero for a text without words."""
    n, chars, symbols, dup_lines, repeats = counts
    if not n:
        return (0.0,) * len(SHARES)
    raw = text.encode()
    words = raw.split()
    at = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, small = int(at[65:91].sum()), int(at[97:123].sum())
    kinds: dict = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    lines = max(1, sum(1 for x in raw.split(b"\n") if x.strip()))
    return (symbols / n, dup_lines / lines, repeats / n, upper / max(1, upper + small), int(at[33]) / n,
            len(kinds) / n, chars / n, int(at[48:58].sum()) / max(1, chars), int(at[124]) / n,
            max(kinds.values()) / n, sum(map(bytes.__eq__, words, words[1:])) / n)


STATS_TYPE = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]
                          + [T.StructField(c, T.DoubleType()) for c in SHARES])


def frame(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        counts = count_row(t)
        rows.append(counts + share_row(t, counts))
    out = pd.DataFrame(rows, columns=[*COUNTS, *SHARES])
    return out.astype({c: "int64" for c in COUNTS} | {c: "float64" for c in SHARES})


@F.pandas_udf(STATS_TYPE)
def text_stats(texts: pd.Series) -> pd.DataFrame:
    """All statistics of a text as one struct column."""
    return frame(texts)
