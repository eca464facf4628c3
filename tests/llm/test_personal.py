import hashlib
import random
import re
import time

import numpy as np
import pytest

from gleanery.checks.base import table
from gleanery.llm import personal
from gleanery.llm.char_tagger import LENGTH, Tagger, _total
from gleanery.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def brute(text):
    """All matches by the patterns as they stand, and those that hold."""
    found, held = [], []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            holds = [
                True, all(int(p[-9:]) <= 255 and len(p.lstrip("0")) < 4 for p in m[0].split(".")) if kind == 1 else True,
                14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0, 10 <= len(digits) <= 15,
            ]
            found.append((m.start(), m.end(), kind))
            if holds[kind]:
                held.append((m.start(), m.end(), kind))
    return sorted(found), sorted(held, key=lambda s: (s[0], s[2]))


def test_rules_against_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choice("a1@.+- (5") for _ in range(rng.randrange(40))) for _ in range(30_000)]
    texts += ["é日 a@b.c,x@y", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999 x", "😀 +12 3", "a@b.c@d.e", "5500-0000-0000-0004"]
    for text in texts:
        found, held = brute(text)
        assert sorted(personal.matches(text)) == found and personal.base_spans(text)[0] == held, text


@pytest.mark.parametrize("text", ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@b.c" * 60_000, "@" * 300_000 + "a@b.c", "1 " * 150_000])
def test_rules_take_time_in_proportion(text):
    start = time.process_time()
    personal.base_spans(text)
    assert time.process_time() - start < 3


def test_gradients():
    rng, tagger = np.random.default_rng(0), Tagger(2, 1)
    tagger.weights = {k: v.astype(np.float64) for k, v in tagger.weights.items()}
    windows, tags = rng.integers(1, 129, (3, 10)).astype(np.uint8), rng.integers(0, 5, (3, 10))

    def loss():
        emitted = tagger._emissions(tagger._states(windows)).astype(float)
        steps, total = tagger.weights["steps"], _total(tagger._forward(emitted)[-1], 1)
        paths = [tagger.weights["start"][g[0]] + emitted[np.arange(10), i, g].sum() + steps[g[:-1], g[1:]].sum() for i, g in enumerate(tags)]
        return (total - np.array(paths)).mean()

    for name, gradient in tagger._gradients(windows, tags).items():
        at = (int(windows[0, 0]), 3) if name == "embedding" else tuple(rng.integers(0, d) for d in gradient.shape)
        weight, kept = tagger.weights[name], tagger.weights[name][at]
        weight[at] = kept + 1e-3
        more = loss()
        weight[at] = kept - 1e-3
        less = loss()
        weight[at] = kept
        assert abs((more - less) / 2e-3 - gradient[at]) < 1e-3 + 1e-2 * abs(gradient[at]), name


def test_best_tagging_and_probabilities():
    """Against all taggings of a short window."""
    from itertools import product

    tagger, windows = Tagger(1, 3), np.array([[65, 49, 50, 64, 65]], np.uint8)
    tagger.weights = {k: v * 3 for k, v in tagger.weights.items()}
    emitted = tagger._emissions(tagger._states(windows))[:, 0]
    ways = list(product(range(3), repeat=5))
    weight = [tagger.weights["start"][w[0]] + sum(emitted[t, w[t]] for t in range(5)) + sum(tagger.weights["steps"][a, b] for a, b in zip(w, w[1:])) for w in ways]
    share = np.exp(np.array(weight) - max(weight))
    share /= share.sum()

    def spans(way):
        starts = [t for t in range(5) if way[t] == 1]
        return [(t, next((u for u in range(t + 1, 5) if way[u] != 2), 5), 0) for t in starts]

    got = tagger.spans(windows)[0]
    assert [s[:3] for s in got] == spans(ways[int(np.argmax(weight))])
    for *span, p in got:
        assert abs(p - sum(s for s, w in zip(share, ways) if tuple(span) in spans(w))) < 1e-4


def test_reconciled_is_the_best_choice():
    from itertools import combinations

    rng = random.Random(2)
    for _ in range(150):
        spans = []
        for _ in range(rng.randrange(7)):
            a = rng.randrange(20)
            spans.append((a, a + rng.randrange(1, 9), rng.randrange(2), rng.choice([0.3, 0.6, 0.9, 0.99])))
        worth = lambda chosen: sum(np.log(s[3] / (1 - s[3])) for s in chosen)
        apart = lambda chosen: all(a[1] <= b[0] or b[1] <= a[0] for a, b in combinations(chosen, 2))
        good = [s for s in spans if s[3] > 0.5]
        best = max((worth(c) for k in range(len(good) + 1) for c in combinations(good, k) if apart(c)), default=0)
        got = personal.reconciled(spans)
        assert apart(got) and abs(worth(got) - best) < 1e-9


@pytest.fixture(scope="module")
def tagger(spark):
    return personal.train(personal.lessons(table(spark, SF, "documents")))


def test_spans_beyond_the_rules(spark, tagger):
    """Spans that touch, so that a rule takes both for one that fails, and a very long text."""
    texts = [
        "call me at +1 (988) 555-2485 4041894974608795 or not, please do",
        "no data here, 42 of 17 things and 2024 was a year",
        "Be then andreannd, anhe in +1 (314) 555-6532 4663622617512349 ingeser. neehr " * 900,
        "write to hsr.29@mail5.example.com then",
        "order 12345678901234567890123 was late and 1234567890123456 too",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = {r.doc_id: r for r in personal.find(rows, tagger).collect()}
    cut = lambda i, kind: [texts[i][s.start : s.stop] for s in found[i].spans if s.kind == kind]
    assert cut(0, "phone") == ["+1 (988) 555-2485"] and cut(0, "card") == ["4041894974608795"] and not found[0].base
    assert not found[1].spans and not found[4].spans
    assert set(cut(2, "phone")) == {"+1 (314) 555-6532"} and len(found[2].spans) >= 1700
    assert cut(3, "email") == ["hsr.29@mail5.example.com"]


def test_held_out_windows(spark, tagger):
    """Spans of windows that were no lessons."""
    taught = {codes for _, codes, _ in personal.lessons(table(spark, SF, "documents"))}
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()]
    rest = sorted({x for t in texts for x in personal._lessons(t) if x[1] not in taught})[::3]
    hits = all_ = extra = 0
    for (_, _, tags), spans in zip(rest, tagger.spans(np.stack([np.frombuffer(x[1], np.uint8) for x in rest]))):
        tags, gold = np.frombuffer(tags, np.uint8), set()
        for a in np.flatnonzero(tags % 2 == 1).tolist():
            b = a + 1
            while b < LENGTH and tags[b] == tags[a] + 1:
                b += 1
            gold.add((a, b, (int(tags[a]) - 1) // 2))
        got = {s[:3] for s in spans}
        hits, all_, extra = hits + len(gold & got), all_ + len(gold), extra + len(got - gold)
    assert all_ > 100 and hits / all_ > 0.95 and extra / all_ < 0.05


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op13_lstm_crf_pii"](spark, SF).collect()}
    texts = {r.doc_id: r.text or "" for r in table(spark, SF, "documents").collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        base = [f"{personal.KINDS[k]}:{a}:{b}" for a, b, k in brute(text)[1]]
        r, kinds = rows[i], [b.split(":")[0] for b in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in personal.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",")) and (r.spans or not base)


def test_odd_rows(spark, tagger, odd_docs, no_docs):
    found = personal.find(odd_docs, tagger)
    assert found.columns == ["doc_id", "base", "spans"] and found.count() == odd_docs.count()
    assert found.where("size(spans) > 0 OR spans IS NULL").count() == 0
    assert personal.find(no_docs, tagger).count() == 0
    # Nothing to learn from: the rules alone.
    assert personal.train(personal.lessons(no_docs)) is None and personal.train(personal.lessons(odd_docs)) is None
    assert personal.find(odd_docs, None).count() == odd_docs.count()
