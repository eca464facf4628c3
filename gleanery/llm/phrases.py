"""Collocations: frequent phrases by dynamic itemset counting over cyclic scans of the corpus' shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import remove_path, scratch_path
from .common import written

#: Shards of the corpus; one is read in a step.
SHARDS = 3
#: Longest phrases, in words.
WORDS = 4
#: Occurrences that make a phrase frequent.
LEAST = 30
#: Cells of the filter that tells tasks which phrases to count. A phrase sharing a cell is counted needlessly at worst.
CELLS = 1 << 24
#: Bytes of text of one language that are counted together, and that are split into words at a time.
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 18

BREAK = b"\xff"  # no byte of UTF-8
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
FOLDED = bytes.maketrans(
    bytes(range(ord("A"), ord("Z") + 1)) + b"\x09" + PIECE_ENDS,
    bytes(range(ord("a"), ord("z") + 1)) + b"\x20" + BREAK * len(PIECE_ENDS),
)
KEY = [f"w{i}" for i in range(1, WORDS + 1)]
MIX, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _chunks(text: bytes, size: int = CHUNK_BYTES) -> Iterator[bytes]:
    """The text in chunks of about ``size`` bytes that end before white space."""
    start = 0
    while len(text) - start > size:
        ends = [place for c in (b" ", b"\t", b"\n") if (place := text.find(c, start + size)) >= 0]
        if not ends:
            break
        yield text[start : min(ends)]
        start = min(ends)
    yield text[start:]


class Splitter:
    """Splits texts of a language into words and hashes these, all at once: 0 stands where a piece ends.

    A word's hash is a sum over its bytes, each a random number times a power of an odd base. Powers go
    by the place in the text; one product makes up for the place where a word starts.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.numbers = rng.integers(0, 1 << 64, (2, 256), np.uint64)
        self.numbers[:, [32, 255]] = 0
        base = int(rng.integers(0, 1 << 63)) * 2 + 1
        self.bases, self.powers = (base, pow(base, -1, 1 << 64)), np.ones((2, 1), np.uint64)

    def _up_to(self, size: int) -> None:
        if size > self.powers.shape[1]:
            steps = np.ones((2, 1 << size.bit_length()), np.uint64)
            steps[0, 1:], steps[1, 1:] = np.uint64(self.bases[0]), np.uint64(self.bases[1])
            self.powers = np.multiply.accumulate(steps, axis=1)

    def words(self, lang: str, text: bytes, other: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and starts of words and breaks; with ``other``, hashes of a second, independent kind."""
        codes = np.frombuffer(text.translate(FOLDED), np.uint8)
        self._up_to(len(codes))
        breaks = codes == 255
        apart = breaks | (codes == 32)
        first = ~apart
        first[1:] &= apart[:-1]
        at = np.flatnonzero(first | breaks)
        if not len(at):
            return np.zeros(0, np.uint64), at
        found = np.add.reduceat(self.numbers[int(other)][codes] * self.powers[0, : len(codes)], at) * self.powers[1, at]
        found ^= np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))
        found = (found ^ (found >> np.uint64(32))) * SPREAD
        found = np.maximum(found ^ (found >> np.uint64(29)), np.uint64(1))
        found[breaks[at]] = 0
        return found, at


def _blocks(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[str, bytes]]:
    """Texts of one language put together, each followed by a break; long ones are cut before white space."""
    open_: dict[str, list[bytes]] = {}
    held: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            for part in _chunks(text + BREAK, block):
                open_.setdefault(lang, []).append(part)
                held[lang] = held.get(lang, 0) + len(part)
                if held[lang] >= block:
                    held[lang] = 0
                    yield lang, b"".join(open_.pop(lang))
    yield from ((lang, b"".join(parts)) for lang, parts in open_.items())


def _coded(docs: DataFrame, shards: int, seed: int, block: int, splitter: type[Splitter]) -> DataFrame:
    """The corpus as blocks of word hashes, dealt over the shards.

    ``words`` are 64-bit hashes, 0 where a piece ends; ``lead`` is how many of them the task's block before ended
    with, and ``n`` the number of words behind these.
    """
    schema = "shard int, lang string, words binary, lead int, n bigint"
    kinds = [pa.int32(), pa.string(), pa.binary(), pa.int32(), pa.int64()]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, tails, turn = splitter(seed), {}, 0
        for lang, text in _blocks(batches, block):
            tail, turn = tails.get(lang, np.zeros(0, np.uint64)), turn + 1
            words = np.concatenate([tail, *(split.words(lang, part)[0] for part in _chunks(text))])
            tails[lang] = words[1 - WORDS :]
            row = (turn % shards, lang, words.astype("<u8").tobytes(), len(tail), int(np.count_nonzero(words[len(tail) :])))
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], ["shard", "lang", "words", "lead", "n"])

    path = scratch_path(docs.sparkSession, "shards")
    blocks = docs.mapInArrow(coded, schema).write.partitionBy("shard").option("compression", "zstd")
    blocks.option("parquet.compression.codec.zstd.level", "1").parquet(path)
    return docs.sparkSession.read.schema(schema).parquet(path)


def _lexicon(docs: DataFrame, frequent: DataFrame, seed: int, block: int, size: int, splitter: type[Splitter]) -> DataFrame:
    """``lang, word, hash`` of all words that share a cell of the filter with a frequent word: these words, and a few more.

    Words of one hash are told apart by the second one.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_filter(frequent.where(F.col(KEY[1]) == 0), 0, size))

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, cells, met = splitter(seed), sent.value, np.zeros(1 << 18, np.uint64)
        for lang, text in _blocks(batches, block):
            for part in _chunks(text):
                hashes, starts = split.words(lang, part)
                both = hashes * MIX ^ split.words(lang, part, other=True)[0]
                place = both & np.uint64(len(met) - 1)
                at = np.flatnonzero((hashes > 0) & (met[place] != both) & (_flags(cells, hashes * MIX) > 0))
                met[place[at]] = both[at]
                at, folded = at[np.unique(both[at], return_index=True)[1]], part.translate(FOLDED)
                apart = np.flatnonzero(np.isin(np.frombuffer(folded + b" ", np.uint8), (32, 255)))
                ends = apart[np.searchsorted(apart, starts[at])]
                words = [folded[a:b].decode("utf-8", "replace") for a, b in zip(starts[at].tolist(), ends.tolist())]
                columns = [pa.array([lang] * len(at), pa.string()), pa.array(words, pa.string()), pa.array(hashes[at].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "hash"])

    return docs.mapInArrow(spelt, "lang string, word string, hash bigint").distinct()


def _cells(key: np.ndarray, size: int) -> np.ndarray:
    """Places in a filter of ``size`` cells, a power of two."""
    return (key * SPREAD) >> np.uint64(65 - size.bit_length())


def _flags(cells: np.ndarray, key: np.ndarray) -> np.ndarray:
    cell = _cells(key, 32 * len(cells))
    return (cells[cell >> np.uint64(5)] >> (np.uint64(2) * (cell & np.uint64(31)))).astype(np.uint8) & 3


def _follow(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The filter's key of a phrase: its first words' key, followed by a word."""
    return (first + word) * MIX ^ (first >> np.uint64(29))


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    columns = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in KEY]
    key = columns[0] * MIX
    for word in columns[1:]:
        key = np.where(word == 0, key, _follow(key, word))
    return key


def _filter(phrases: DataFrame, since: int, size: int) -> np.ndarray:
    """A cell's flags: 1 if it has a phrase, 3 if it has one of step ``since`` or later; 32 cells in a number.

    What comes to the driver has at most one row for 32 cells, however many phrases there are.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = _cells(_keys(batch), size).astype(np.int64)
            flags = 1 + 2 * (batch.column("step").to_numpy(zero_copy_only=False) >= since).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell >> 5), pa.array(flags << (2 * (cell & 31)))], ["place", "flags"])

    flags = phrases.select(*KEY, "step").mapInArrow(keyed, "place bigint, flags bigint").groupBy("place").agg(F.bit_or("flags").alias("flags")).toArrow()
    packed = np.zeros(size >> 5, np.uint64)
    packed[flags["place"].to_numpy()] = flags["flags"].to_numpy().view(np.uint64)
    return packed


def _flagged(counts: DataFrame, cells: np.ndarray) -> DataFrame:
    """The rows of phrases that share a cell of the filter with one of its phrases."""
    sent = counts.sparkSession.sparkContext.broadcast(cells)

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_flags(sent.value, _keys(batch)) > 0))

    return counts.mapInArrow(flagged, counts.schema)


def _counted(words: np.ndarray, lead: int, cells: np.ndarray | None, single: bool) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """Phrases that end behind the ``lead`` and are to be counted: columns of words, and their numbers.

    ``cells`` are the filter's flags. A phrase is counted if its first and its last words, all but one,
    have reached the threshold, and one of them did within the last cycle.
    """
    if single:
        found, counts = np.unique(words[lead:], return_counts=True)
        yield [found[found > 0]], counts[found > 0]
    if cells is None:
        return
    key, real = words * MIX, words > 0
    for length in range(2, WORDS + 1):
        if len(key) < 2:
            return
        flags = _flags(cells, key)
        wanted = flags[:-1] & flags[1:] & ((flags[:-1] | flags[1:]) >> 1) & 1
        real = real[:-1] & (words[length - 1 :] > 0)
        wanted &= real
        wanted[: max(0, lead - length + 1)] = 0
        at = np.flatnonzero(wanted)
        if len(at):
            # Numbers of words, then of pairs of them, so that phrases are told apart exactly.
            numbers = np.unique(words[at], return_inverse=True)[1]
            for i in range(1, length):
                later = np.unique(words[at + i], return_inverse=True)[1]
                _, first, numbers, counts = np.unique(numbers << 32 | later, return_index=True, return_inverse=True, return_counts=True)
            yield [words[at[first] + i] for i in range(length)], counts
        key = _follow(key[:-1], words[length - 1 :])


def _scan(blocks: DataFrame, cells: np.ndarray | None, single: bool) -> DataFrame:
    """Numbers of the phrases to be counted, in the blocks of one shard."""
    spark = blocks.sparkSession
    sent = None if cells is None else spark.sparkContext.broadcast(cells)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = None if sent is None else sent.value
        for batch in batches:
            for data, lead in zip(batch.column("words"), batch.column("lead").to_pylist()):
                words = np.frombuffer(data.as_buffer(), "<u8")
                for columns, counts in _counted(words, lead, flags, single):
                    columns = columns + [np.zeros(len(counts), np.uint64)] * (WORDS - len(columns))
                    arrays = [pa.array(c.view(np.int64)) for c in columns]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(counts.astype(np.int64))], [*KEY, "f"])

    schema = ", ".join(f"{c} bigint" for c in [*KEY, "f"])
    # Blocks are added up already, so tasks would gain little from adding up theirs before the shuffle.
    return blocks.select("words", "lead").mapInArrow(counted, schema).repartition(*KEY).groupBy(*KEY).agg(F.sum("f").alias("f"))


def _frequent(blocks: DataFrame, least: int, shards: int, size: int) -> DataFrame:
    """All frequent phrases: word hashes, the step in which the threshold was reached, and the occurrences ``f``.

    Step ``t`` reads shard ``t`` modulo their number. Words are counted from the first step on; a longer phrase
    from the step after both its subphrases, all words but the last and all but the first, have reached the
    threshold, until its cycle is full. A cycle is ``shards`` steps, so the counts of any such run of steps add up
    to no more than a phrase's occurrences, and over its own cycle to just these. A phrase that reaches the
    threshold has its share of it in one step at least, so only such phrases are added up. Every step's
    counts are a table in the shared folder; the last cycle's are kept.
    """
    cycle: list[tuple[str, DataFrame, np.ndarray]] = []
    reached, cells, step = None, None, 0
    share = -(-least // shards)
    extended = np.uint64(0xAAAAAAAAAAAAAAAA)
    while step < shards or (cells & extended).any():
        shard = blocks.where(F.col("shard") == step % shards)
        path = scratch_path(blocks.sparkSession, "counted")
        counts = written(_scan(shard, cells, step < shards), "counted", path)
        cycle.append((path, counts, _filter(counts.where(F.col("f") >= share).withColumn("step", F.lit(0)), 0, size)))
        if len(cycle) > shards:
            remove_path(blocks.sparkSession, cycle.pop(0)[0])
        found = cycle[0][1]
        for _, counts, _ in cycle[1:]:
            found = found.unionByName(counts)
        found = _flagged(found, np.bitwise_or.reduce([some for _, _, some in cycle]))
        found = found.groupBy(*KEY).agg(F.sum("f").alias("f")).where(F.col("f") >= least).withColumn("step", F.lit(step))
        if reached is not None:
            found = found.unionByName(reached).groupBy(*KEY).agg(F.max("f").alias("f"), F.min("step").alias("step"))
        reached, step = written(found, "reached"), step + 1
        # Of phrases that can grow: all, and those that reached the threshold within the last cycle.
        cells = _filter(reached.where(F.col(KEY[-1]) == 0), step - shards, size)
    return reached


def _cut(words: list[Column]) -> list[Column]:
    """Key columns of a phrase of these words."""
    return [c.alias(k) for c, k in zip(words + [F.lit(0).cast("bigint")] * (WORDS - len(words)), KEY)]


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = 2000, shards: int = SHARDS, contained: int = 80,
    cells: int = CELLS, block: int = BLOCK_BYTES, splitter: type[Splitter] = Splitter,
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to 4 words: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and split at ``. , ; : ! ?`` and line ends into pieces, these at spaces and tabs
    into words. ``a`` is a phrase's number of occurrences, at least ``least``; ``l`` and ``r`` are those of its
    parts at the cut where ``floor(2000000 * a / (l + r))`` is lowest, the first such cut; ``n`` is the number of
    words of the language. A phrase goes if a longer frequent one contains it and has ``contained``
    hundredths of its occurrences. Order: score and ``a`` falling, then the phrase's bytes.

    NULL and empty texts have no words, a NULL language is ``und``, repeated rows count each, other columns are
    left out, and an empty table gives no rows. Words are told apart by 64-bit hashes; if another word
    of the corpus has the hash of a frequent one, all is counted anew with other hashes. Fewer ``cells`` of the
    filter, a power of two from 64 on, only make tasks count more in vain.
    """
    rows, seed = docs.select(F.coalesce(lang, F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text")), 0
    while True:
        blocks = _coded(rows, shards, seed, block, splitter)
        frequent = _frequent(blocks, least, shards, cells)
        words = written(_lexicon(rows, frequent, seed, block, cells, splitter), "lexicon")
        if words.groupBy("hash").count().where("count > 1").isEmpty():
            return _best(frequent, words, blocks.groupBy("lang").agg(F.sum("n").alias("n")), top, contained)
        seed += 1


def _best(frequent: DataFrame, words: DataFrame, totals: DataFrame, top: int, contained: int) -> DataFrame:
    length = sum((F.col(k) != 0).cast("int") for k in KEY)
    phrases = frequent.select(*KEY, F.col("f").alias("a"), length.alias("length"))
    longer = phrases.where("length > 1")

    # What a phrase loses at one end is frequent as well; one word longer is enough, since all between are frequent too.
    ends = None
    for size in range(3, WORDS + 1):
        for first in (0, 1):
            keys = _cut([F.col(k) for k in KEY[first : first + size - 1]])
            part = longer.where(F.col("length") == size).select(*keys, F.col("a").alias("around"))
            ends = part if ends is None else ends.unionByName(part)
    around = ends.groupBy(*KEY).agg(F.max("around").alias("around"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    held = longer.join(around, KEY, "left")
    held = written(held.where(F.col("around").isNull() | (exact("around") * 100 < exact("a") * contained)).select(*KEY, "a", "length"), "candidates")

    cuts = None
    for size in range(2, WORDS + 1):
        for k in range(1, size):
            some = held.where(F.col("length") == size)
            left = F.struct(*_cut([F.col(c) for c in KEY[:k]]))
            right = F.struct(*_cut([F.col(c) for c in KEY[k:size]]))
            part = some.select(*KEY, "a", F.lit(k).alias("k"), left.alias("left"), right.alias("right"))
            cuts = part if cuts is None else cuts.unionByName(part)
    part = phrases.select(F.struct(*KEY).alias("part"), F.col("a").alias("f"))
    cuts = cuts.join(part.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(part.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr("(CAST(2000000 AS DECIMAL(18,0)) * CAST(a AS DECIMAL(20,0))) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    lowest = cuts.withColumn("score", score).groupBy(*KEY).agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("least")).select(*KEY, "least.*")

    place = F.posexplode(F.array(*[F.col(k) for k in KEY])).alias("i", "hash")
    spelt = lowest.select(*KEY, place).where("hash <> 0").join(words, "hash")
    spelt = spelt.groupBy(*KEY).agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("i", "word"))).alias("words"))
    named = lowest.join(spelt, KEY).select("lang", F.array_join("words.word", " ").alias("phrase"), "a", "l", "r", "score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # First in parts of a language, so that no task meets all phrases of a large one.
    of_part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = named.withColumn("rank", F.row_number().over(of_part)).where(F.col("rank") <= top)
    of_lang = Window.partitionBy("lang").orderBy(*order)
    ranked = some.withColumn("rank", F.row_number().over(of_lang).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
