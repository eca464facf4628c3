"""Stretches of long texts that can be encoded one by one.

A text may be cut before a single space that stands between two characters which are no white space:
every split pattern of the byte-level vocabularies starts a new match there.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex

#: White space in some reading of Unicode, at which no segment may start or end.
ODD = r"\s\x1c-\x1f\x85᠎​﻿"
SAFE = regex.compile(rf"(?<=[^{ODD}])(?=\x20[^{ODD}])")
#: Characters encoded in one call, about; bytes of texts that are encoded together.
CALL_CHARS = 1 << 16
BATCH_BYTES = 2 << 20


def cut(text: str, chars: int = CALL_CHARS) -> Iterator[str]:
    """The text in stretches of about ``chars`` characters, longer if no safe place comes earlier."""
    start = 0
    while len(text) - start > chars and (place := SAFE.search(text, start + chars)):
        yield text[start : place.start()]
        start = place.start()
    yield text[start:]


def balanced(batch: pa.RecordBatch, text: str, limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text each; a longer text is a slice of its own."""
    start = held = 0
    for row, size in enumerate(pc.binary_length(batch.column(text)).to_pylist()):
        if held and held + (size or 0) > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size or 0
    yield batch.slice(start)
