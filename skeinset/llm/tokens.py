"""Token counts of whole texts.

Texts are cut at safe boundaries, the pieces of an Arrow batch are gathered, equal pieces are
encoded once, in calls of about the same number of bytes, and only lengths come back.

A cut is safe where a character that is no white space is followed by an ASCII blank: no match of a
byte-level pre-tokenizer runs over that place, a run of white space is never divided, and the
library's special strings hold no blank. Texts with white space outside ASCII are cut at fewer
places: only between an ASCII letter or digit and one single blank before another.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

CALL_BYTES = 1 << 20
CACHED_PIECES = 250_000

_PIECES = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_FEWER = re.compile(r"(?<=[A-Za-z0-9])(?= [A-Za-z0-9])")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def pieces(text: str) -> list[str]:
    """``text`` cut at safe boundaries; joined they are the text again."""
    return (_FEWER.split if _OTHER_SPACE.search(text) else _PIECES.findall)(text)


def encode_balanced(path: str, texts: list[str]):
    """Encodings of ``texts``, in order, by calls of about ``CALL_BYTES``."""
    call, size = [], 0
    for text in texts:
        call.append(text)
        size += len(text)
        if size >= CALL_BYTES:
            yield from tokenizer(path).encode_batch_fast(call, add_special_tokens=False)
            call, size = [], 0
    if call:
        yield from tokenizer(path).encode_batch_fast(call, add_special_tokens=False)


class Lengths:
    """Token counts of pieces, with a bounded memory of earlier ones."""

    def __init__(self, path: str):
        self.path, self.known = path, {}

    def of(self, texts: list[str]) -> list[int]:
        known = self.known
        if len(known) > CACHED_PIECES:
            known.clear()
        cut = [pieces(t) for t in texts]
        new = list({p for ps in cut for p in ps if p not in known})
        for piece, found in zip(new, encode_balanced(self.path, new)):
            known[piece] = len(found)
        return [sum(map(known.__getitem__, ps)) for ps in cut]


@lru_cache(maxsize=2)
def _lengths(path: str) -> Lengths:
    return Lengths(path)


def count_tokens(text: str | Column, path: str) -> Column:
    """Tokens of each text as the tokenizer file at ``path`` gives them, a bigint.

    No begin, end or other added token, no truncation; special strings inside a text count as the
    library's default has it. Null and empty texts have none. ``path`` must exist on all machines.
    """

    @F.arrow_udf("bigint")
    def lengths(texts: pa.Array) -> pa.Array:
        counter, out, group, size = _lengths(path), [], [], 0
        for t in texts.to_pylist():
            group.append(t or "")
            size += len(group[-1])
            if size >= 4 * CALL_BYTES:
                out += counter.of(group)
                group, size = [], 0
        return pa.array(out + counter.of(group), pa.int64())

    return lengths(text)
