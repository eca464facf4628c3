"""Language identification by compression: the language whose text shortens a document most."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN = "und"
#: Raw content that a language's dictionary holds, at most.
DICTIONARY_BYTES = 1 << 15
#: Texts of a language that its dictionary is made of, by a hash of their ids.
SAMPLED_DOCS = 24
#: Languages that can be learned: their dictionaries, 64 MB at most, are on the driver and in each task.
LANGUAGES = 2048
#: Bytes compressed at a time: more, and a text's own beginning takes the dictionary's place.
BLOCK_BYTES = 4096
LEVEL = 6
#: A document whose best size is less than this part below the next one is rejected.
MARGIN = 0.004

NO_LETTERS = re.compile(r"[\W\d_]+")
SCHEMA = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType())]
)


def letters(text: str) -> bytes:
    """The text's words in lower case with one space between them; empty if it has no letter."""
    words = NO_LETTERS.sub(" ", text.lower()).strip()
    return words.encode() if any(map(str.isalpha, words)) else b""


@dataclass
class Model:
    """Dictionaries by language, the most frequent language first, which ties go to."""

    dictionaries: dict[str, bytes]

    def __getstate__(self):
        return {"dictionaries": self.dictionaries}  # compressors are made anew in each worker

    @cached_property
    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        made = {}
        for lang, content in self.dictionaries.items():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            options = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=BLOCK_BYTES, dict_size=len(content), write_content_size=False, write_checksum=False, write_dict_id=False
            )
            dictionary.precompute_compress(compression_params=options)
            made[lang] = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=options)
        return made

    def sizes(self, words: bytes) -> dict[str, int]:
        blocks = [words[i : i + BLOCK_BYTES] for i in range(0, len(words), BLOCK_BYTES)]
        return {lang: sum(len(c.compress(b)) for b in blocks) for lang, c in self.compressors.items()}

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: by what part the best size is below the second best (1 if there is no second)."""
        words = letters(text or "")
        if not words or not self.dictionaries:
            return UNKNOWN, 0.0
        ranked = sorted(self.sizes(words).items(), key=lambda item: item[1])
        if len(ranked) == 1:
            return ranked[0][0], 1.0
        return ranked[0][0], 1 - ranked[0][1] / ranked[1][1]


def held_out(id: Column) -> Column:
    """A third of all documents, from which nothing is learned; a NULL id is not held out."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _content(texts: list[bytes]) -> bytes:
    """A dictionary of the texts, in their order, all cut at the same length, the greatest that fits: short ones leave room to others."""
    left, share = DICTIONARY_BYTES - len(texts), 0
    for n, length in enumerate(sorted(map(len, texts))):
        share = left // (len(texts) - n)
        if length > share:
            break
        left -= length
    else:
        share = DICTIONARY_BYTES
    return b" ".join(t[:share] for t in texts)


def train(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A dictionary for each language of the documents that are not held out.

    Each language gives ``SAMPLED_DOCS`` different texts that have letters (all, if fewer), the first by a hash of the smallest id
    that has the text, and each of them an equal share of ``DICTIONARY_BYTES``: neither copies nor empty texts nor
    one very long text take the place of others. A dictionary and a count for each language come to the driver; more than
    ``LANGUAGES`` values of ``lang`` are refused with an error. Documents without id, text or language teach nothing.
    """
    usable = docs.where(~held_out(F.col(id)) & F.col(id).isNotNull() & F.col(lang).isNotNull())
    usable = usable.select(F.col(id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages: {sorted(counts)[:5]}, ...")
    content = F.xxhash64("text")
    texts = usable.where(F.col("text").rlike(r"\p{L}")).groupBy("lang", content.alias("content")).agg(F.min("id").alias("id"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", "content")
    chosen = texts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= SAMPLED_DOCS)
    # At most SAMPLED_DOCS rows for each language; the same row may stand in the table more than once.
    wanted = usable.withColumn("content", content).join(F.broadcast(chosen), ["lang", "content", "id"]).select("lang", "rank", "text")

    def in_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [letters(t.as_py())[:DICTIONARY_BYTES] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(words, pa.binary())], ["lang", "rank", "words"])

    def joined(rows: pa.Table) -> pa.Table:
        words = dict(zip(rows.column("rank").to_pylist(), rows.column("words").to_pylist()))
        made = _content([w for _, w in sorted(words.items()) if w])
        return pa.table({"lang": rows.column("lang").slice(0, 1), "content": pa.array([made], pa.binary())})

    words = wanted.mapInArrow(in_words, "lang string, rank int, words binary").groupBy("lang", "rank").agg(F.min("words").alias("words"))
    made = words.groupBy("lang").applyInArrow(joined, "lang string, content binary").collect()
    # The compressor takes no shorter dictionary; eight bytes hardly teach a language anyway.
    contents = {r["lang"]: bytes(r["content"]) for r in made if len(r["content"]) >= 8}
    return Model({x: contents[x] for x in sorted(contents, key=lambda x: (-counts[x], x))})


def with_language(docs: DataFrame, model: Model, into: str, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with a struct ``into`` of ``lang_pred, score, accepted``.

    Every whole text is compressed, in blocks, with the dictionary of each language, and the smallest
    total wins. ``und`` stands for NULL, empty and letterless texts, and for all if nothing was learned;
    it is never accepted, and neither is a margin under ``margin``. Rows stay as they are, repeated ones
    included. A column called ``into`` is replaced.
    """
    rest = docs.drop(into)
    place = [c.lower() for c in rest.columns].index(text.lower())

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(place)]
            langs, scores = [f[0] for f in found], [f[1] for f in found]
            accepted = [f != UNKNOWN and s >= margin for f, s in found]
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            struct = pa.StructArray.from_arrays(columns, names=SCHEMA.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, into])

    return rest.mapInArrow(predicted, T.StructType([*rest.schema.fields, T.StructField(into, SCHEMA)]))
