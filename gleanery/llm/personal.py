"""Personal data in texts: what rules find, and what a tagger trained on these finds beyond them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .char_tagger import LENGTH, STRIDE, Tagger, symbols
from .segments import balanced

#: In the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
PLUS = re.compile(r"\+[0-9][\x20().0-9-]+")
TRIGGER = re.compile(r"[0-9@]")
#: Digits without which, and without an @, no kind is possible.
FEWEST = 4

#: Windows of each kind, and of none, that the tagger learns from at most; those with the smallest hashes.
SAMPLE = 240
STEPS, BATCH = 300, 48
#: Probability from which a span that no rule gives is added.
SURE = 0.9
#: Windows tagged together.
TOGETHER = 256


def _digits(text: str) -> str:
    return "".join(filter("0123456789".__contains__, text))


def luhn(digits: str) -> bool:
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(doubled[int(d)] if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def _holds(kind: int, text: str) -> bool:
    """What a match must fulfil beyond its pattern."""
    if kind == EMAIL:
        return True
    if kind == IP:
        return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in text.split("."))
    digits = _digits(text)
    if kind == CARD:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15


def matches(text: str) -> Iterator[tuple[int, int, int]]:
    """Leftmost non-overlapping matches of each kind's pattern: start, stop, kind. Time grows with the text's length only.

    A run of characters that begins a pattern is met once: an address is looked for from its ``@``,
    numbers by whole runs of their characters.
    """
    last = before = 0
    for m in AT_DOMAIN.finditer(text):
        # No name holds an @, so the part since the last one is all that can belong to it.
        before = max(last, text.rfind("@", before, m.start()) + 1, before)
        start = before + len(text[before : m.start()].rstrip(LOCAL))
        if start < m.start():
            yield start, m.end(), EMAIL
            last = m.end()
        before = max(last, m.start() + 1)
    for m in DOTTED.finditer(text):
        parts, start = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            size = len(".".join(parts[i : i + 4]))
            yield start, start + size, IP
            start += size + 1
    for m in DIGITS.finditer(text):
        if m.end() - m.start() > 1:
            yield m.start(), m.end(), CARD
    for m in PLUS.finditer(text):
        stop = m.start() + len(m[0].rstrip(" ().-"))
        if stop - m.start() > 3:
            yield m.start(), stop, PHONE


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Matches that hold, by start and kind, and those that fail."""
    found, failed = [], []
    if TRIGGER.search(text):
        for start, stop, kind in matches(text):
            (found if _holds(kind, text[start:stop]) else failed).append((start, stop, kind))
    return sorted(found, key=lambda s: (s[0], s[2])), failed


def _window(codes: np.ndarray, start: int) -> np.ndarray:
    part = codes[start : start + LENGTH]
    return np.pad(part, (0, LENGTH - len(part)))


def _tags(spans: list[tuple[int, int, int]], start: int) -> np.ndarray:
    tags = np.zeros(LENGTH, np.uint8)
    for a, b, kind in spans:
        if b > start and a < start + LENGTH:
            tags[max(0, a - start) : max(0, b - start)] = 2 + 2 * kind
            if a >= start:
                tags[a - start] = 1 + 2 * kind
    return tags


def _lessons(text: str) -> Iterator[tuple[int, bytes, bytes]]:
    """Windows to learn from, with their tags: around each span, and around other numbers (kind -1).

    Windows with a long match that failed are no lessons: it may be two spans that touch.
    """
    spans, failed = base_spans(text)
    doubtful = [f for f in failed if f[2] != CARD or f[1] - f[0] >= 10]
    codes = symbols(text) if spans or failed else None
    for a, b, kind in [*spans, *((f[0], f[1], -1) for f in failed)]:
        start = max(0, a - (a * 7 + b) % (LENGTH - min(LENGTH - 8, b - a)))
        if any(x < start + LENGTH and y > start for x, y, _ in doubtful):
            continue
        tags = _tags(spans, start)
        if kind >= 0 or not tags.any():
            yield kind, _window(codes, start).tobytes(), tags.tobytes()


def lessons(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> list[tuple[int, bytes, bytes]]:
    """At most ``sample`` different windows of each kind and of none, from all texts: those with the smallest hashes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in balanced(batch, "text") if batch.num_rows else ():
                some = {lesson for t in rows.column("text").to_pylist() for lesson in _lessons(t or "")}
                if some:
                    columns = [pa.array(c, k) for c, k in zip(zip(*some), (pa.int32(), pa.binary(), pa.binary()))]
                    yield pa.RecordBatch.from_arrays(columns, ["kind", "codes", "tags"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(found, "kind int, codes binary, tags binary")
    rows = rows.withColumn("hash", F.xxhash64("codes", "tags"))
    order = [F.col("hash"), F.col("codes"), F.col("tags")]
    rows = rows.withColumn("place", F.dense_rank().over(Window.partitionBy("kind", F.pmod("hash", F.lit(32))).orderBy(*order)))
    rows = rows.where(F.col("place") <= sample).distinct()
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(*order))).where(F.col("place") <= sample)
    return [(r["kind"], bytes(r["codes"]), bytes(r["tags"])) for r in rows.orderBy("kind", "place").collect()]


def _varied(codes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The same window with other digits and, half of the time, other letters of the same case."""
    out = codes.copy()
    for first, number, often in ((48, 10, 1.0), (65, 26, 0.5), (97, 26, 0.5)):
        at = (out >= first) & (out < first + number)
        if rng.random() < often:
            out[at] = first + rng.integers(0, number, int(at.sum()))
    return out


def _joined(one: tuple, other: tuple, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The first window with a span of the second put behind one of its own, after a space."""
    (codes, tags), (codes2, tags2) = one, other
    starts, ends = np.flatnonzero(tags2 % 2 == 1), np.flatnonzero((tags > 0) & (np.append(tags[1:], 0) % 2 == 1) | (tags > 0) & (np.append(tags[1:], 0) == 0))
    if not len(starts) or not len(ends):
        return codes, tags
    a = int(rng.choice(starts))
    b = a + 1
    while b < LENGTH and tags2[b] == tags2[a] + 1:
        b += 1
    at = int(rng.choice(ends)) + 1
    put = lambda x, space, y: np.concatenate([x[:at], [space], y[a:b], x[at:]])[:LENGTH].astype(np.uint8)
    return put(codes, 32, codes2), put(tags, 0, tags2)


def train(taught: list[tuple[int, bytes, bytes]], steps: int = STEPS, seed: int = 0) -> Tagger | None:
    """A tagger of the lessons' spans, or None if there is no span among them.

    Each batch has lessons of all kinds in equal parts, with other digits and letters, so that shapes are
    learned and not the values, and spans of two lessons next to each other.
    """
    by_kind: dict[int, list] = {}
    for kind, codes, tags in taught:
        by_kind.setdefault(kind, []).append((np.frombuffer(codes, np.uint8), np.frombuffer(tags, np.uint8)))
    if not any(kind >= 0 for kind in by_kind):
        return None
    rng, kinds, spans = np.random.default_rng(seed), sorted(by_kind), [x for k in by_kind if k >= 0 for x in by_kind[k]]

    def batches() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _ in range(steps):
            rows = []
            for i in range(BATCH):
                own = by_kind[kinds[i % len(kinds)]]
                codes, tags = own[rng.integers(len(own))]
                if tags.any() and rng.random() < 0.3:
                    codes, tags = _joined((codes, tags), spans[rng.integers(len(spans))], rng)
                rows.append((_varied(codes, rng), tags))
            yield np.stack([r[0] for r in rows]), np.stack([r[1] for r in rows])

    tagger = Tagger(len(KINDS), seed)
    tagger.train(batches())
    return tagger


def _places(text: str, codes: np.ndarray) -> list[int]:
    """Starts of overlapping windows over the whole text, without those that can hold no kind's characters."""
    digit, at = (codes >= 48) & (codes <= 57), codes == 64
    starts = np.arange(0, max(1, len(codes) - LENGTH + STRIDE), STRIDE)
    stops = np.minimum(starts + LENGTH, len(codes))
    inside = lambda x: (total := np.concatenate([[0], np.cumsum(x)]))[stops] - total[starts]
    return starts[(inside(digit) >= FEWEST) | (inside(at) > 0)].tolist()


def reconciled(proposals: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Of the spans that overlapping windows propose, those without overlaps whose log odds add up to most."""
    best: dict[tuple[int, int, int], float] = {}
    for start, stop, kind, share in proposals:
        best[start, stop, kind] = max(share, best.get((start, stop, kind), 0.0))
    spans = sorted((stop, start, kind, share) for (start, stop, kind), share in best.items() if share > 0.5)
    stops, gains, ways = [s[0] for s in spans], [0.0], [None]
    for stop, start, kind, share in spans:
        before = int(np.searchsorted(stops, start, side="right"))
        before = min(before, len(gains) - 1)
        gain = gains[before] + float(np.log(share / max(1 - share, 1e-6)))
        take = gain > gains[-1]
        gains.append(gain if take else gains[-1])
        ways.append((before, (start, stop, kind, share)) if take else None)
    found, i = [], len(spans)
    while i:
        if ways[i]:
            i, span = ways[i]
            found.append(span)
        else:
            i -= 1
    return found[::-1]


def _whole(text: str, start: int, stop: int, kind: int) -> bool:
    """Whether a proposed span has what its kind must have, and does not begin or end inside a word or number."""
    part = text[start:stop]
    if start and text[start - 1].isalnum() and part[0].isalnum() or stop < len(text) and text[stop].isalnum() and part[-1].isalnum():
        return False
    if kind == EMAIL:
        return bool(re.fullmatch(rf"[{re.escape(LOCAL)}]+{AT_DOMAIN.pattern}", part))
    if kind == IP:
        return bool(re.fullmatch(r"[0-9]+(?:\.[0-9]+){3}", part)) and _holds(kind, part)
    return bool(re.fullmatch(r"\+?[\x20().0-9-]+", part)) and part[-1] in "0123456789" and _holds(kind, part)


def _added(texts: list[str], bases: list[list], tagger: Tagger, sure: float) -> list[list[tuple[int, int, int]]]:
    """Per text the tagger's spans that overlap none of its base spans."""
    wanted: list[tuple[int, int]] = []
    codes: dict[int, np.ndarray] = {}
    for i, text in enumerate(texts):
        if TRIGGER.search(text):
            codes[i] = symbols(text)
            wanted += [(i, start) for start in _places(text, codes[i])]
    proposals: list[list] = [[] for _ in texts]
    for at in range(0, len(wanted), TOGETHER):
        some = wanted[at : at + TOGETHER]
        windows = [_window(codes[i], start) for i, start in some]
        for (i, start), spans in zip(some, tagger.spans(np.stack(windows))):
            size = len(codes[i])
            for a, b, kind, share in spans:
                # A span at a window's edge may go on; the next window has it whole.
                if (a or not start) and (b < LENGTH or start + b == size) and start + b <= size:
                    proposals[i].append((start + a, start + b, kind, share))
    found = []
    for text, base, own in zip(texts, bases, proposals):
        free = [p for p in own if p[3] >= sure and not any(a < p[1] and b > p[0] for a, b, _ in base) and _whole(text, *p[:3])]
        found.append([p[:3] for p in reconciled(free)])
    return found


SPANS = "array<struct<kind:string,start:int,stop:int>>"


def find(docs: DataFrame, tagger: Tagger | None, id: str = "doc_id", text: str = "text", sure: float = SURE) -> DataFrame:
    """Per row of ``docs``: its id, ``base`` and ``spans``, arrays of ``kind, start, stop`` by start, then kind.

    ``base`` has the matches of the rules that hold; ``spans`` has them all and what the tagger adds. It reads
    windows of 96 characters that overlap by half, over the whole text; those with fewer than four
    digits and no @ can hold no kind and are not tagged. Spans at a window's edge are left to the next window,
    and of overlapping ones those with the greatest sum of log odds stay. A span is added if its
    probability is ``sure`` or more, it overlaps no base span, and it passes its kind's checks (parts, digits, Luhn).

    Offsets count code points, ends are exclusive. NULL and empty texts have no spans; repeated rows are
    each returned; other columns are left out; without a tagger (no labelled span to learn from) the base spans are all.
    """
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))
    listed = lambda spans: [{"kind": KINDS[k], "start": a, "stop": b} for a, b, k in sorted(spans, key=lambda s: (s[0], s[2]))]

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in balanced(batch, "text") if batch.num_rows else ():
                texts = [t or "" for t in rows.column("text").to_pylist()]
                bases = [base_spans(t)[0] for t in texts]
                added = _added(texts, bases, tagger, sure) if tagger else [[] for _ in texts]
                columns = [pa.array([listed(b) for b in bases], kind), pa.array([listed(b + a) for b, a in zip(bases, added)], kind)]
                yield pa.RecordBatch.from_arrays([rows.column("id"), *columns], ["id", "base", "spans"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {docs.schema[id].dataType.simpleString()}, base {SPANS}, spans {SPANS}"
    return rows.mapInArrow(found, schema).withColumnRenamed("id", id)


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")
