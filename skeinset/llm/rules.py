"""Quality rules of a text, with repetition found by a suffix array over its words.

The longest common prefixes of neighbouring suffixes give the maximal repeated word sequences of
the text itself. The spans of those of at least ``min_words`` are united; a text fails where they
cover too much of it, or where one repeat alone is too long.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinset.llm.common import as_bytes, hold

_NOT_SYMBOLS = bytes(set(range(256)) - set(b"#*$%&|<>"))
_BLANKS = b" \t\n\r\x0b\x0c"
_INNER_BYTES = bytes(range(0x80, 0xC0))  # UTF-8 bytes after the first of a code point


@dataclass(frozen=True)
class Limits:
    """Base rules, and those of the suffix array."""

    min_words: int = 50
    base_gram: int = 3
    base_repeat: float = 0.5
    min_repeat: int = 8
    max_covered: float = 0.4
    max_longest: int = 100


def ranks_by_doubling(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... words, up to where all differ."""
    _, rank = np.unique(ids, return_inverse=True)
    levels, n, width = [rank], len(ids), 1
    while rank.max(initial=0) < n - 1 and width < n:
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:] + 1
        _, rank = np.unique(rank * np.int64(n + 1) + after, return_inverse=True)
        levels.append(rank)
        width *= 2
    return levels


def common_prefixes(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array and, for each neighbouring pair in it, the length of their common prefix."""
    n = len(levels[0])
    order = np.argsort(levels[-1], kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    lengths = np.zeros(max(n - 1, 0), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        width, rank = 1 << k, np.append(levels[k], -1)
        inside = (left + width <= n) & (right + width <= n)
        same = inside & (rank[np.minimum(left, n)] == rank[np.minimum(right, n)])
        left[same] += width
        right[same] += width
        lengths[same] += width
    return order, lengths


def repeats(ids: np.ndarray, min_words: int) -> tuple[int, int]:
    """Words covered by repeated sequences of ``min_words`` or more, and the longest repeat."""
    n = len(ids)
    if n <= min_words:
        return 0, 0
    order, lengths = common_prefixes(ranks_by_doubling(ids))
    longest = int(lengths.max(initial=0))
    if longest < min_words:
        return 0, longest
    reach = np.zeros(n, dtype=np.int64)  # the longest repeat that starts at each word
    np.maximum.at(reach, order[:-1], lengths)
    np.maximum.at(reach, order[1:], lengths)
    starts = np.flatnonzero(reach >= min_words)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + reach[starts], -1)
    return int((np.cumsum(edge[:n]) > 0).sum()), longest


def gram_cover(ids: np.ndarray, size: int) -> int:
    """Words in windows of ``size`` words that are found twice or more."""
    n = len(ids) - size + 1
    if n < 2:
        return 0
    base = np.int64(ids.max() + 1)
    key = ids[:n].astype(np.int64)
    for j in range(1, size):
        if float(base) ** (j + 1) > 2**62:
            _, key = np.unique(key, return_inverse=True)
        key = key * base + ids[j : n + j]
    _, back, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = np.zeros(len(ids), dtype=bool)
    twice = np.flatnonzero(count[back] > 1)
    for j in range(size):
        hit[twice + j] = True
    return int(hit.sum())


def measure(text: bytes, limits: Limits) -> tuple:
    words = text.split()
    n = len(words)
    stripped = text.translate(None, _BLANKS + _INNER_BYTES)
    symbols = len(text.translate(None, _NOT_SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    covered, longest = repeats(ids, limits.min_repeat)
    return n, len(stripped), symbols, len(lines) - len(set(lines)), gram_cover(ids, limits.base_gram), covered, longest


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]


def quality_rules(text: str | Column, limits: Limits = Limits()) -> Column:
    """A struct of ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered,
    longest_repeat, base_failed, kept``.

    Words are what ASCII white space separates. Null and empty texts have no words and fail the base
    rules, as does every text below ``min_words``. ``kept`` needs the base rules met, at most
    ``max_covered`` of the words inside repeats of ``min_repeat`` words or more, and no repeat longer
    than ``max_longest`` words. Each text is judged by itself, so order, ties and repeated rows
    change nothing.
    """

    kind = ", ".join(f"{name}: bigint" for name in _NAMES) + ", base_failed: boolean, kept: boolean"

    @F.arrow_udf(f"struct<{kind}>")
    def judge(texts: pa.Array) -> pa.Array:
        hold("rules", int)
        rows = np.array([measure(t, limits) for t in as_bytes(texts)], dtype=np.int64).reshape(-1, len(_NAMES))
        n, again, covered, longest = rows[:, 0], rows[:, 4], rows[:, 5], rows[:, 6]
        failed = (n < limits.min_words) | (again > limits.base_repeat * n)
        kept = ~failed & (covered <= limits.max_covered * n) & (longest <= limits.max_longest)
        columns = [pa.array(rows[:, i]) for i in range(len(_NAMES))]
        return pa.StructArray.from_arrays([*columns, pa.array(failed), pa.array(kept)], names=[*_NAMES, "base_failed", "kept"])

    return judge(text)
