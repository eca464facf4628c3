"""The operators' queries on the supplied tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from public_tokenizers import PATTERN
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F

from ..checks.base import Registry, table
from . import bpe, langid, neighbours, packing, personal, phrases, quality, reshard, rotated_codes, secrets, simhash, token_counts, whitening

operators = Registry()
QUERIES, ORACLES = operators.queries, operators.oracles


@operators.add()
def op4_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def _of_kind(kind, spans="spans"):
    return F.coalesce(F.size(F.filter(spans, lambda span: span["kind"] == kind)), F.lit(0)).cast("bigint").alias(f"n_{kind}")


#: Positions as running sums of the lengths of matches and of what stands between them.
SQL_SECRETS = """
    WITH rules(kind, place, pattern, part, least) AS (VALUES
        ('assign', 1, '(?i)(password|passwd|secret|token|api_?key)["'']?\\x20*[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
        ('access', 2, 'AKIA[A-Z0-9]+', 0, 16),
        ('hex', 3, '[0-9a-f]+', 0, 32)),
    texts AS (SELECT DISTINCT coalesce(text, '') AS text FROM documents),
    matched AS (
        SELECT text, kind, place, least, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern) AS whole,
            CASE WHEN part = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern) END AS parts
        FROM texts, rules),
    numbered AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM matched),
    lengths AS (SELECT text, kind, place, least, i, length(gaps[i]) AS gap, length(whole[i]) AS size, length(parts[i]) AS part FROM numbered),
    placed AS (SELECT *, sum(gap + size) OVER (PARTITION BY text, kind ORDER BY i) AS stop FROM lengths),
    spans AS (SELECT text, kind, place, stop - size AS start, stop FROM placed WHERE part >= least),
    listed AS (
        SELECT text, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
            count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
        FROM spans GROUP BY text)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
    FROM documents LEFT JOIN listed ON listed.text = coalesce(documents.text, '')
"""


@operators.add(SQL_SECRETS)
def op10_secret_scan(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    spans = F.when(F.col("spans").isNull(), "").otherwise(secrets.span_list(F.col("spans"))).alias("spans")
    found = found.select("doc_id", *[_of_kind(rule.kind) for rule in secrets.RULES], spans)
    return found.withColumn("base_sha256", F.sha2("spans", 256))


SHARDS = 24


@operators.add()
def op8_min_cost_reshard(spark, sf_dir):
    """From a layout by source, with its one very large shard, to shards of equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "_metadata.file_name", "_metadata.row_index")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 8
    old = F.pmod(F.crc32(F.coalesce("source", F.lit("")).cast("binary")), F.lit(SHARDS))
    place = [F.col(c) for c in ("doc_id", "row_index", "file_name")]
    sharded, _ = reshard.reshard(docs, old, SHARDS, SHARDS, size, place)
    digest = sharded.select("shard", "shard_key", "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    return reshard.with_slot(digest).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint"), F.lit(None).cast("int").alias("grown_shard")
    )


@operators.add()
def op2_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@operators.add()
def op6_bounded_space_packing(spark, sf_dir):
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    crc = F.crc32("ids").alias("ids_crc32")
    return pieces.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


@operators.add()
def op1_bpe_round_trip(spark, sf_dir):
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, PATTERN)
    return bpe.decode(encoded, path, with_text=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@operators.add()
def op3_compression_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.with_language(docs.select("doc_id", "text"), langid.train(docs), "language")
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "language.*")


@operators.add()
def op7_cotraining_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.with_quality(docs, model, "quality").select("doc_id", "quality.*")


#: All pairs. On tables of up to 2,000 rows a query looks at every row; on larger ones a few neighbours may differ.
SQL_NEIGHBOURS = """
    WITH vectors AS (
        SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, o.vec_id, max(list_inner_product(q.v, o.v)) AS score
        FROM vectors q JOIN vectors o ON len(q.v) = len(o.v) AND q.vec_id <> o.vec_id
        WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, o.vec_id)
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
    FROM scored QUALIFY rank <= 20
"""


@operators.add(SQL_NEIGHBOURS)
def op5_forest_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


#: All pairs of a label; fine for the small tables of a comparison.
SQL_ROTATED = """
    WITH RECURSIVE vectors AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
    reached AS (SELECT vec_id, vec_id AS other FROM embeddings UNION SELECT vec_id, b FROM reached JOIN pairs ON other = a),
    least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
    counts AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN least USING (vec_id) LEFT JOIN counts ON a = vec_id
"""


@operators.add(SQL_ROTATED)
def op9_rotated_code_dedup(spark, sf_dir):
    return rotated_codes.near_duplicates(table(spark, sf_dir, "embeddings"))


@operators.add()
def op11_spectrum_whitening(spark, sf_dir):
    embeddings = table(spark, sf_dir, "embeddings")
    return whitening.whiten(embeddings, whitening.fit(embeddings))


#: Parts of frequent phrases are frequent as well, so all but the counting looks at these few.
SQL_PHRASES = """
    WITH texts AS (
        SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents),
    pieces AS (SELECT lang, unnest(string_split_regex(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
    split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM pieces),
    placed AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split),
    grams AS (
        SELECT lang, 1 AS size, words[i] AS phrase FROM placed
        UNION ALL SELECT lang, 2, words[i] || ' ' || words[i + 1] FROM placed WHERE i + 1 <= len(words)
        UNION ALL SELECT lang, 3, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] FROM placed WHERE i + 2 <= len(words)
        UNION ALL SELECT lang, 4, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] || ' ' || words[i + 3] FROM placed WHERE i + 3 <= len(words)),
    totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM split GROUP BY lang),
    frequent AS MATERIALIZED (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
    candidates AS MATERIALIZED (SELECT lang, size, phrase, string_split(phrase, ' ') AS words, f AS a FROM frequent WHERE size > 1),
    inside AS (
        SELECT lang, array_to_string(words[i:i + part - 1], ' ') AS phrase, max(a) AS longer
        FROM candidates, (SELECT unnest([2, 3]) AS part), (SELECT unnest([1, 2, 3]) AS i)
        WHERE part < size AND i + part - 1 <= size GROUP BY ALL),
    cuts AS (
        SELECT lang, size, phrase, a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS tail
        FROM candidates, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size),
    scored AS (
        SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r, (2000000 * a::HUGEINT) // (l.f::HUGEINT + r.f) AS score
        FROM cuts c JOIN frequent l ON l.lang = c.lang AND l.size = k AND l.phrase = head
        JOIN frequent r ON r.lang = c.lang AND r.size = c.size - k AND r.phrase = tail),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    kept AS (
        SELECT l.* FROM lowest l LEFT JOIN inside i ON i.lang = l.lang AND i.phrase = l.phrase
        WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@operators.add(SQL_PHRASES)
def op12_itemset_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@operators.add()
def op13_lstm_crf_pii(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = personal.find(docs, personal.train(personal.lessons(docs)))
    base = F.sha2(personal.span_list(F.col("base")), 256).alias("base_sha256")
    spans = personal.span_list(F.col("spans")).alias("spans")
    return found.select("doc_id", *[_of_kind(kind, "base") for kind in personal.KINDS], base, spans)
