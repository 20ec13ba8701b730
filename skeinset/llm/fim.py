"""Fill-in-middle order of texts: two cuts between lines, and the parts in another order with marks before them.

Where a line ends and how many characters come before is not looked up in the whole text. A rolling hash of
the last 32 bytes cuts a text into chunks wherever its leading bits are zero, so equal passages mostly become
equal chunks, wherever they stand. A chunk is summarised once: its characters, the places of its line ends and
the characters before each, whether it holds a mark, and its two outer bytes on either side, as a mark may lie
across an edge. The summaries are kept by content, which a look-up compares. Adding up those of a text's chunks
tells the chunk with the wanted line, and the place in it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from skeinset.llm.common import as_bytes, hold

MARKS = ("<P>", "<S>", "<M>")
LEAST, MOST, BITS = 256, 16 << 10, 11  # bytes of a chunk, and leading zero bits at an end
BLOCK = 1 << 20
CACHE_BYTES = 32 << 20
_GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(29)).astype(np.uint32)


class Summary(NamedTuple):
    chars: int
    ends: np.ndarray  # places after each line feed
    before: np.ndarray  # characters before those
    marked: bool


def ends_of_chunks(data: bytes) -> list[int]:
    """Where chunks end; the last is the end of the text."""
    if len(data) <= LEAST:
        return [len(data)] if data else []
    raw = np.frombuffer(data, np.uint8)
    out, last = [], 0

    def cut(at: int) -> None:
        nonlocal last
        while at - last > MOST:
            last += MOST
            out.append(last)
        if at - last >= LEAST:
            last = at
            out.append(at)

    for start in range(0, len(raw), BLOCK):
        lead = min(start, 31)
        h = _GEAR[raw[start - lead : start + BLOCK]]
        for step in (1, 2, 4, 8, 16):
            wider = h.copy()
            wider[step:] += h[:-step] << np.uint32(step)
            h = wider
        for at in np.flatnonzero(h[lead:] >> np.uint32(32 - BITS) == 0).tolist():
            cut(start + at + 1)
    cut(len(raw))
    if last < len(raw):
        out.append(len(raw))
    return out


class Chunks:
    """Summaries by content, of at most about ``CACHE_BYTES`` of chunks."""

    def __init__(self, marks: Sequence[bytes]):
        self.marks = marks
        self.known: dict[bytes, Summary] = {}
        self.held = 0

    def clear(self) -> None:
        self.known.clear()
        self.held = 0

    def of(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            raw = np.frombuffer(chunk, np.uint8)
            counted = np.cumsum((raw & 0xC0) != 0x80)
            feeds = np.flatnonzero(raw == 10)
            found = Summary(int(counted[-1]), feeds + 1, counted[feeds], any(m in chunk for m in self.marks))
            if self.held > CACHE_BYTES:
                self.clear()
            self.held += len(chunk) + 16 * len(feeds) + 200
            self.known[chunk] = found
        return found

    def text(self, data: bytes) -> Summed:
        ends = ends_of_chunks(data)
        starts = [0, *ends[:-1]]
        parts = [self.of(data[a:b]) for a, b in zip(starts, ends)]
        longest = max(map(len, self.marks), default=1) - 1
        across = any(m in data[max(a - longest, 0) : a + longest] for a in starts[1:] for m in self.marks)
        return Summed(data, starts, parts, across)


class Summed:
    """A text by the summaries of its chunks."""

    def __init__(self, data: bytes, starts: list[int], parts: list[Summary], across: bool):
        self.starts, self.parts, self.size = starts, parts, len(data)
        self.marked = across or any(p.marked for p in parts)
        self.feeds = list(accumulate(len(p.ends) for p in parts))
        self.chars = [0, *accumulate(p.chars for p in parts)]
        self.lines = (self.feeds[-1] if parts else 0) + (self.size > 0 and not data.endswith(b"\n"))

    def after(self, lines: int) -> tuple[int, int]:
        """Bytes and characters of the first ``lines`` lines."""
        if lines == 0:
            return 0, 0
        if lines > self.feeds[-1]:
            return self.size, self.chars[-1]
        i = bisect_left(self.feeds, lines)
        at = lines - 1 - (self.feeds[i - 1] if i else 0)
        part = self.parts[i]
        return self.starts[i] + int(part.ends[at]), self.chars[i] + int(part.before[at])


def transformed(data: bytes, key: bytes, chunks: Chunks, rate: int, spm_rate: int):
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    p, s, m = chunks.marks
    text = chunks.text(data)
    digest = hashlib.sha256(key).digest()
    h = [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]
    n = text.lines
    if not data or text.marked or h[2] % 100 >= rate:
        return n, "plain", None, None, data
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (a, chars_a), (b, chars_b) = text.after(low), text.after(high)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    if h[3] % 100 < spm_rate:
        return n, "spm", chars_a, chars_b - chars_a, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", chars_a, chars_b - chars_a, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(
    key: str | Column, text: str | Column, seed: int = 7, rate: int = 100, spm_rate: int = 50, marks: Sequence[str] = MARKS
) -> Column:
    """``n, form, prefix_chars, middle_chars, output`` of each text, as a struct.

    ``n`` counts its lines. SHA-256 of ``seed:key`` draws two cuts between lines; of 100 texts ``rate`` are cut,
    of those ``spm_rate`` put the suffix first. A null or empty text, and one that holds a mark, stays ``plain``;
    its counts of characters are null. A null key counts as an empty one. Equal keys draw alike.
    """
    plain = [m.encode() for m in marks]
    kept: list[Chunks] = []

    @F.arrow_udf("struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>")
    def fim(keys: pa.Array, texts: pa.Array) -> pa.Array:
        if not kept:
            kept.append(Chunks(plain))
        hold("fim", kept[0].clear)
        lead = str(seed).encode() + b":"
        rows = [transformed(t, lead + k, kept[0], rate, spm_rate) for k, t in zip(as_bytes(keys), as_bytes(texts))]
        n, form, before, inside, out = zip(*rows) if rows else ([],) * 5
        arrays = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(inside, pa.int64())]
        # cast from bytes, as the parts of a text that is valid UTF-8 are put together again
        arrays.append(pa.array(out, pa.binary()).cast(pa.string()))
        return pa.StructArray.from_arrays(arrays, names=["n", "form", "prefix_chars", "middle_chars", "output"])

    name = F.col(key) if isinstance(key, str) else key
    return fim(name.cast("string"), F.col(text) if isinstance(text, str) else text)


def restored(output: str | Column, form: str | Column, marks: Sequence[str] = MARKS) -> Column:
    """The text from ``output`` and ``form``. A text that is cut holds no mark, so each occurs once."""
    part = F.split(output, "|".join("\\Q" + m + "\\E" for m in marks))
    kind = F.col(form) if isinstance(form, str) else form
    return (
        F.when(kind == "psm", F.concat(part[1], part[3], part[2]))
        .when(kind == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(F.col(output) if isinstance(output, str) else output)
    )
