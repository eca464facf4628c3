import hashlib
import json
import random
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
import regex
import tiktoken
from public_tokenizers import PATTERN, path
from tokenizers import Tokenizer

from gleanery.checks.base import table
from gleanery.llm import bpe, packing, token_counts
from gleanery.llm.library import byte_level
from gleanery.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
BYTE_LEVEL = path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(BYTE_LEVEL)
TEXTS = [
    "", " ", "  a", "a ", "a  b", " a b", "a\n b", "\n\n a", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>z", "a​ b", "\x1c a \x85b",
    "é" * 3000, "w " * 600_000, "tab\t x  \t y", "don't we're I'll 's", "᠎ x ﻿ y", "日本語 テキスト ", "a　 b", "word " * 9 + "🙂🙂" * 40_000,
]
RNG = random.Random(1)
TEXTS += ["".join(RNG.choice(" ab\n\t.,'s1é　\x1f ") for _ in range(RNG.randrange(40))) for _ in range(300)]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def given(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


def checked(rows, texts, length=packing.LENGTH):
    """Every id once, in order, without gaps in documents and sequences; returns the sequences' lengths."""
    documents, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        documents[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    for doc, text in texts:
        ids, at = np.array([*library_ids(text), 0], "<u4"), 0
        for row in sorted(documents.pop(doc), key=lambda r: r.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            part = ids[at : at + row.length].tobytes()
            assert (zlib.crc32(part) == row.ids_crc32) if "ids_crc32" in row else part == row.ids
            at += row.length
        assert at == len(ids)
    assert not documents
    filled = []
    for pieces in sequences.values():
        at = 0
        for row in sorted(pieces, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        filled.append(at)
    assert max(filled, default=0) <= length
    return filled


def test_counts(spark, odd_docs, no_docs):
    rows = {r.doc_id: r for r in token_counts.token_counts(given(spark), BYTE_LEVEL).collect()}
    for i, text in enumerate(TEXTS):
        n = len(library_ids(text))
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len(text.encode()), n, n > 1024), repr(text[:40])
    found = token_counts.token_counts(odd_docs, BYTE_LEVEL)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and found.count() == odd_docs.count()
    assert {r.n_tokens for r in found.where("doc_id IN (4, 5)").collect()} == {0}
    assert token_counts.token_counts(no_docs, BYTE_LEVEL).count() == 0


def test_count_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op2_token_counts"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(library_ids(t)) for i, t in texts.items()}


def test_library_agrees_with_the_file():
    """The faster library gives every token of the vocabulary, and texts around its limits, the same ids."""
    own = byte_level(BYTE_LEVEL)
    tokens = [own.encoding.decode_single_token_bytes(i) for i in range(50256)]
    texts = [t.decode() for t in tokens if t.decode("utf-8", "ignore").encode() == t]
    texts += [" " * 140_000, "x" * 140_000, " " * 131_072, "a<|endoftext|>" * 9, "<|endoftext", " \n" * 70_000]
    for text in texts:
        assert own.ids(text) == np.array(library_ids(text), "<u4").tobytes() and own.count(text) == len(library_ids(text)), repr(text[:40])


def test_a_file_that_needs_its_own_library(tmp_path):
    """Another split or another order of ids: left to the library of the file."""
    file = json.loads(open(BYTE_LEVEL, encoding="utf-8").read())
    file["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "spaced.json").write_text(json.dumps(file), encoding="utf-8")
    own = byte_level(str(tmp_path / "spaced.json"))
    assert own.encoding is None and own.count("hello there") == 2 and own.ids("there") != byte_level(BYTE_LEVEL).ids("there")


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 10)
    monkeypatch.setattr(bpe, "STATES", 50)
    ranks = bpe.read_ranks(path("byte_bpe_50k.tiktoken"))
    few, library = bpe.Pieces(ranks, PATTERN), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i in range(200):
        text = " ".join(f"w{i + j} abc{i}d" for j in range(5))
        assert few.encode(text) == np.array(library.encode_ordinary(text), "<u4").tobytes()
    assert len(few.now) + len(few.old) < 60 and len(few.transducer.ways) < 150


def test_windows_take_time_in_proportion():
    """Pieces of a very long document are cut from one buffer."""

    def seconds(n):
        windows, ids, start = packing.Windows(), bytes(4 * n), time.process_time()
        assert sum(1 for _ in windows.place((1, 0, ids, n))) == n // packing.LENGTH
        return time.process_time() - start

    seconds(1 << 20)
    assert min(seconds(1 << 23) for _ in range(3)) < 3 * max(min(seconds(1 << 22) for _ in range(3)), 0.01)


@pytest.mark.parametrize("fan_in", [2, 256])
def test_packing(spark, monkeypatch, fan_in):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    docs = given(spark).repartition(7)
    filled = checked(packing.pack(docs, BYTE_LEVEL, n_open=3).collect(), list(enumerate(TEXTS)))
    assert sum(n < packing.LENGTH for n in filled) <= 1


def test_packing_odd_rows(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, BYTE_LEVEL).collect()
    want = sum(len(library_ids(r.text)) + 1 for r in odd_docs.select("text").collect())
    assert sum(r.length for r in rows) == want and {r.doc_tokens for r in rows if r.doc_id in (4, 5)} == {1}
    assert packing.pack(no_docs, BYTE_LEVEL).count() == 0


def test_packing_query(spark):
    texts = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    filled = checked(QUERIES["op6_bounded_space_packing"](spark, SF).collect(), texts)
    assert sum(n < packing.LENGTH for n in filled) <= 1


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_transducer(name, monkeypatch):
    ranks = bpe.read_ranks(path(name))
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    transducer, matches = bpe.Transducer(ranks), regex.compile(PATTERN)
    monkeypatch.setattr(bpe, "STATES", 2000)  # dropped and made anew on the way
    tokens, rng = list(ranks), random.Random(2)
    texts = ["".join(rng.choice("aeionst") for _ in range(rng.randrange(80))) for _ in range(500)]
    texts += [b"".join(rng.choice(tokens) for _ in range(rng.randrange(6))).decode("utf-8", "replace") for _ in range(5000)]
    texts += ["a" * 5000, " " * 700, "ab" * 1000 + "\n" * 50, "aaaaaaab" * 300]
    for text in texts:
        assert [i for m in matches.findall(text) for i in transducer.encode(m.encode())] == library.encode_ordinary(text), repr(text[:60])


def test_tokens_that_no_merge_forms():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"xyz": 257}
    transducer = bpe.Transducer(ranks)
    assert transducer.encode(b"xyz") == [257] and transducer.encode(b"xyzab") == [120, 121, 122, 256]


def test_streaming_decode():
    data = ("aé日😀퟿".encode() + b"\xff\xe0\x80\xf4\x90x\xed\xa0\x80\xc3") * 3
    rng = random.Random(3)
    for _ in range(200):
        machine, text, at = bpe.Utf8(), "", 0
        while at < len(data):
            step = rng.randrange(1, 4)
            text += machine.feed(data[at : at + step])
            at += step
        assert text + machine.feed(b"", end=True) == data.decode("utf-8", "replace")
    ranks = bpe.read_ranks(path("byte_bpe_multi_50k.tiktoken"))
    ids = np.array(bpe.Transducer(ranks).encode("日本語🙂".encode()))
    assert "".join(bpe.Decoder(ranks).stream(iter(np.split(ids, len(ids))))) == "日本語🙂"


def test_round_trip(spark, odd_docs, no_docs):
    name = path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(name), special_tokens={})
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(given(spark), name, PATTERN), name).collect()}
    for i, text in enumerate(TEXTS):
        ids = np.array(library.encode_ordinary(text), "<u4")
        want = (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), text)
        assert (rows[i].n_tokens, rows[i].ids_sha256, rows[i].decoded_sha256, rows[i].text) == want
    found = bpe.decode(bpe.encode(odd_docs, name, PATTERN), name)
    assert sorted((r.text for r in found.collect())) == sorted(r.text or "" for r in odd_docs.collect())
    assert bpe.decode(bpe.encode(no_docs, name, PATTERN), name).count() == 0


def test_round_trip_query(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op1_bpe_round_trip"](spark, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in texts.items()}
