"""Ids of a tokenizer file of the ``tokenizers`` library, computed in tasks by the faster ``tiktoken``."""

from __future__ import annotations

import json
import os
from functools import cache

import numpy as np
import tiktoken

#: Each task is one of many, so the library must not start threads of its own.
os.environ["TOKENIZERS_PARALLELISM"] = "false"

from tokenizers import Tokenizer  # noqa: E402

from .segments import CALL_CHARS, cut  # noqa: E402

#: Fixed: how byte-level files split a text.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in seen]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(file: dict) -> dict[bytes, int] | None:
    """The vocabulary as ranks, if ids go up in the order of the merges and nothing else changes a text."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    plain = plain and not file.get("normalizer") and (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True)) == ("ByteLevel", False, True)
    bytes_of, added = _byte_of(), {t["content"] for t in file.get("added_tokens", [])}
    if not plain or any(t[k] for t in file.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
        return None
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    numbers = [model["vocab"].get(token, -1) for token in merged]
    if numbers != sorted(set(numbers)) or len(numbers) + 256 != len(model["vocab"].keys() - added):
        return None
    return {bytes(map(bytes_of.__getitem__, token)): number for token, number in model["vocab"].items() if token not in added}


class ByteLevel:
    """Ids of whole texts by a byte-level file, without special tokens around; special strings in a text count as the file says.

    Long texts are encoded in stretches that end at safe places. A stretch without such places (``tiktoken`` fails on
    very long white space), and a file of which ``tiktoken`` would not give the same ids, are left to the slower library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            file = json.load(lines)
        self.special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        self.tokenizer, self.encoding = Tokenizer.from_file(path), None
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        ranks = _ranks(file)
        if ranks and not any(a != b and b.startswith(a) for a in self.special for b in self.special):
            self.encoding = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=self.special)

    def _stretch(self, text: str) -> list[int]:
        if self.encoding is None or len(text) > 2 * CALL_CHARS:
            return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if any(s in text for s in self.special):
            return self.encoding.encode(text, allowed_special="all")
        return self.encoding.encode_ordinary(text)

    def count(self, text: str) -> int:
        return sum(len(self._stretch(stretch)) for stretch in cut(text))

    def ids(self, text: str) -> bytes:
        """As little-endian unsigned 32-bit integers."""
        return b"".join(np.array(self._stretch(stretch), "<u4").tobytes() for stretch in cut(text))


@cache
def byte_level(path: str) -> ByteLevel:
    """Loaded once for each Python worker."""
    return ByteLevel(path)
