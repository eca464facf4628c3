"""Similarity of two short texts from their longest common subsequence (LCS).

``levenshtein`` is no substitute: here a replaced character counts as one deletion plus one
insertion. The built-in higher-order functions can express the LCS, but they are interpreted.
Measured on 25-character names, a pair took about 270 microseconds of core time that way, against
27 as Arrow batches with one integer step per character (9 for the comparison itself); 100
characters took 84, where the interpreted form did not get through 80,000 pairs in five minutes.
So this is the one place with Python in the tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

def _masks(text: str) -> dict[str, int]:
    """For each character the bits of its positions."""
    masks: dict[str, int] = {}
    for i, char in enumerate(text):
        masks[char] = masks.get(char, 0) | 1 << i
    return masks


def _lcs(masks: dict[str, int], length: int, other: str) -> int:
    """Length of the LCS, a row of its table per step as the bits of one integer."""
    full = (1 << length) - 1
    row = full
    for char in other:
        hit = row & masks.get(char, 0)
        row = (row + hit | row - hit) & full
    return length - row.bit_count()


def _ratio(common: int, total: int) -> int:
    # The division comes first and halves go to even: scores on the border depend on both.
    return round(100 * (2.0 * common / total))


def ratio(text: str | None, other: str | None) -> int:
    if not text or not other:
        return 0
    if text == other:
        return 100
    return _ratio(_lcs(_masks(text), len(text), other), len(text) + len(other))


#: Characters are counted in so many classes; two that share one only loosen the bound.
CLASSES = 64


def letter_counts(texts: Sequence[str]) -> np.ndarray:
    """For each text how often it has characters of each class."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return np.bincount(rows * CLASSES + codes % CLASSES, minlength=len(texts) * CLASSES).reshape(-1, CLASSES)


def score_bounds(counts: np.ndarray, lengths: np.ndarray, others: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """What each text's score with each of the others can be at most, a row for each text: ``others`` are counts that
    the others do not exceed, ``least`` and ``most`` their lengths.

    A common subsequence has of each character no more than either text, and the score is highest
    if the other text is no longer than what they share. The scores' own arithmetic is used, which is monotone.
    """
    # What is shared is no longer than the text, so short texts need one byte.
    small = np.uint8 if max(lengths.max(initial=0), others.max(initial=0)) < 256 else np.int32
    ours, theirs = counts.astype(small).T, others.astype(small).T
    shared = np.zeros((len(counts), len(others)), small)
    for c in np.flatnonzero(counts.any(axis=0) & others.any(axis=0)).tolist():
        shared += np.minimum(ours[c][:, None], theirs[c][None, :])
    shared = shared.astype(np.int64)
    length = lengths.astype(np.int64)[:, None]
    total = length + np.clip(shared, least, most)
    common = np.minimum(shared, np.minimum(length, most))
    return np.rint(100 * (2.0 * common / np.maximum(total, 1))).astype(np.int64)


#: Names of more characters than a machine word has bits are compared one pair at a time.
WORD = 64
#: Pairs that are compared in one step, about.
PAIRS = 1 << 16


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters in a row, and the lengths."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    return codes, np.fromiter(map(len, texts), np.int64, len(texts))


def _places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each character of texts in a row, which text it is of, and its place there."""
    texts = np.repeat(np.arange(len(lengths)), lengths)
    return texts, np.arange(len(texts)) - np.repeat(np.cumsum(lengths) - lengths, lengths)


class Entries:
    """``ids`` and ``titles`` that names are compared with, many pairs in a step."""

    def __init__(self, ids: Sequence[int], titles: Sequence[str]):
        # By falling id, so that of equal scores the last one wins and a maximum finds it.
        order = np.argsort(np.asarray(ids, np.int64), kind="stable")[::-1]
        self.ids, self.titles = np.asarray(ids, np.int64)[order], [titles[i] for i in order.tolist()]
        self.counts = letter_counts(self.titles)
        codes, self.lengths = _codes(self.titles)
        self.alphabet, letters = np.unique(codes, return_inverse=True)
        # The letter after the last one is no letter: it fills up shorter titles.
        self.letters = np.full((self.lengths.max(initial=0), len(self.titles)), len(self.alphabet), np.int64)
        of, at = _places(self.lengths)
        self.letters[at, of] = letters

    def best(self, names: Sequence[str], known: tuple[Sequence[int], Sequence[int]] | None = None) -> list[tuple[tuple[int, int, int, str] | None, int]]:
        """For each name what ``best_entry`` gives; ``known`` are the scores and the negative ids met elsewhere."""
        if not len(self.titles):
            return [(None, 0)] * len(names)
        found: list = [None] * len(names)
        short = [i for i, n in enumerate(names) if len(n) <= WORD]
        for i in set(range(len(names))) - set(short):
            bar = (int(known[0][i]), int(known[1][i])) if known else None
            found[i] = best_entry(names[i], self.ids, self.titles, self.counts, bar)
        step = max(1, PAIRS // len(self.titles))
        for start in range(0, len(short), step):
            some = short[start : start + step]
            bars = [np.asarray([int(k[i]) for i in some], np.int64) for k in known] if known else None
            for i, winner in zip(some, self._best([names[i] for i in some], bars)):
                found[i] = winner
        return found

    def _best(self, names: list[str], known: list[np.ndarray] | None) -> list[tuple[tuple[int, int, int, str] | None, int]]:
        codes, lengths = _codes(names)
        bounds = score_bounds(letter_counts(names), lengths, self.counts, self.lengths, self.lengths)
        # For each name and letter the bits of its places.
        masks = np.zeros((len(names), len(self.alphabet) + 1), np.uint64)
        at = np.minimum(np.searchsorted(self.alphabet, codes), max(len(self.alphabet) - 1, 0))
        held = self.alphabet[at] == codes if len(self.alphabet) else np.zeros(len(codes), bool)
        of, place = _places(lengths)
        np.bitwise_or.at(masks, (of[held], at[held]), np.uint64(1) << place[held].astype(np.uint64))
        n = len(self.titles)
        # A score and an entry in one number; the bar is the greatest that does not win.
        lost = np.full(len(names), -1, np.int64)
        if known:
            lost = known[0] * n + np.searchsorted(-self.ids, known[1], side="right") - 1
        ranks, compared = lost.copy(), np.zeros(len(names), np.int64)

        def compare(of: np.ndarray, entry: np.ndarray) -> None:
            for start in range(0, len(of), PAIRS):
                name, title = of[start : start + PAIRS], entry[start : start + PAIRS]
                full = np.where(lengths[name] > 0, ~np.uint64(0) >> (WORD - np.maximum(lengths[name], 1)).astype(np.uint64), np.uint64(0))
                row = full.copy()
                for letter in self.letters[: self.lengths[title].max(initial=0)]:
                    hit = row & masks[name, letter[title]]
                    # Carries leave the name's bits upwards and do not come back.
                    row = (row + hit) | (row - hit)
                common = lengths[name] - np.bitwise_count(row & full).astype(np.int64)
                total = np.maximum(lengths[name] + self.lengths[title], 1)
                np.maximum.at(ranks, name, np.rint(100 * (2.0 * common / total)).astype(np.int64) * n + title)
                np.add.at(compared, name, 1)

        most = bounds * n + np.arange(n)
        # Those of the highest bounds first, which raise the bar for the others.
        for _ in range(2):
            first = most.argmax(axis=1)
            of = np.flatnonzero(most[np.arange(len(names)), first] > ranks)
            compare(of, first[of])
            most[of, first[of]] = -1
        compare(*np.nonzero(most > ranks[:, None]))
        return [
            ((int(r // n), -int(self.ids[r % n]), int(self.ids[r % n]), self.titles[r % n]) if r > bar else None, int(c))
            for r, bar, c in zip(ranks.tolist(), lost.tolist(), compared.tolist())
        ]


def best_entry(
    text: str, ids: Sequence[int], titles: Sequence[str], counts: np.ndarray | None = None, known: tuple[int, int] | None = None
) -> tuple[tuple[int, int, int, str] | None, int]:
    """``(score, -id, id, title)`` of the most similar title, on a tie the lowest id, and how many were compared.

    Titles are taken by falling bounds of their scores, until no other can win over the best, or over
    ``known``, a score and a negative id met elsewhere; None if none does.
    """
    if not len(ids):
        return None, 0
    counts = letter_counts(titles) if counts is None else counts
    lengths = np.fromiter(map(len, titles), np.int64, len(titles))
    bounds = score_bounds(letter_counts([text]), np.asarray([len(text)]), counts, lengths, lengths)[0]
    keys = np.asarray(ids, np.int64)
    masks, length, best, compared = _masks(text), len(text), None, 0
    for i in np.lexsort((keys, -bounds)).tolist():
        bar = best[:2] if best else known
        if bar and (int(bounds[i]), -int(keys[i])) <= bar:
            break
        compared += 1
        title = titles[i]
        if not text or not title:
            score = 0
        elif text == title:
            score = 100
        else:
            score = _ratio(_lcs(masks, length, title), length + len(title))
        if not bar or (score, -int(keys[i])) > bar:
            best = (score, -int(keys[i]), int(keys[i]), title)
    return best, compared


def fuzz_ratio(text: Column, other: Column) -> Column:
    """Similarity from 0 to 100, ``2 * LCS / (len + len)``, halves rounded to even.

    Equal texts score 100; an empty or missing text scores 0.
    """

    @F.pandas_udf("int")
    def scores(texts: pd.Series, others: pd.Series) -> pd.Series:
        return pd.Series([ratio(a, b) for a, b in zip(texts, others)], dtype="int32")

    return scores(text, other)
