import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, FP string, root int, ids binary, _content string"
PROSE = "the quick brown fox jumps over the lazy dog near the old river bank while seven small boats drift slowly home"


@pytest.fixture
def odd_docs(spark):
    """NULLs in every column, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    texts = [
        (1, PROSE), (2, PROSE), (3, PROSE + " again"), (4, None), (5, ""), (6, " \n\t "), (7, "42 % 17 !!"),
        (8, "long words and more " * 60_000), (8, "long words and more " * 60_000), (9, "x" * 300_000), (10, "ÀÉ日本 ſtraße "),
        (None, "no id"), (None, None), (11, "same id"), (11, "another text"), (11, "another text"),
    ]
    rows = [(i, t, "en" if i and i % 2 else None, "src0" if i else None, len(t) if t else None, "a", 1, b"b", None) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(rows):
    return sorted(map(tuple, rows), key=repr)


class Sets:
    """Union-find, for brute force."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, node):
        while self.up[node] != node:
            self.up[node] = self.up[self.up[node]]
            node = self.up[node]
        return node

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a
