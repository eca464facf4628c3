"""Quality of documents by co-training: one classifier sees the text, the other the page's metadata."""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import spread
from .common import written
from .vectors import matrix

#: Bound on the labelled documents that are learned from.
LABELLED = 8000
ROUNDS = 3
#: Pseudo-labels that a classifier hands over in a round, at most, and how sure it must be of each.
HANDED, SURE = 400, 0.97
PSEUDO_WEIGHT = 0.5
#: Every fifth labelled document is kept for calibration.
CALIBRATION = 5
FEWEST = 20
SOURCES = 64
THRESHOLD = 0.5

SCHEMA = T.StructType(
    [T.StructField(n, T.DoubleType()) for n in ("score", "text_score", "page_score")] + [T.StructField("accepted", T.BooleanType())]
)

UPPER, LOWER, DIGITS = slice(65, 91), slice(97, 123), slice(48, 58)
MARKS = [b for b in range(33, 127) if not (48 <= b < 58 or 65 <= b < 91 or 97 <= b < 123)]


def text_features(text: str | None) -> np.ndarray:
    """Shares of kinds of bytes, of single marks, and of different words, over the whole text."""
    text = text or ""
    data = np.frombuffer(text.encode(), np.uint8)
    counts, size = np.bincount(data, minlength=256), max(1, len(data))
    words = text.split()
    marks = counts[MARKS]
    kinds = [counts[UPPER].sum(), counts[LOWER].sum(), counts[DIGITS].sum(), counts[32], counts[10], counts[128:].sum(), marks.sum()]
    n = max(1, len(words))
    extent = [math.log1p(size) / 10, math.log1p(n) / 10, size / n / 20, len(set(words)) / n, len(set(words)) / math.sqrt(n) / 10, float(not words)]
    # Square roots spread out small shares, where the differences are.
    return np.concatenate([np.sqrt(np.array(kinds) / size), np.sqrt(marks / size), extent])


def page_places(source: object, lang: object, n_chars: object) -> list[int]:
    """One of ``SOURCES`` places for the source and for the language, and the order of the stated length."""
    known = isinstance(n_chars, (int, float)) and not math.isnan(n_chars) and n_chars >= 1
    length = min(22, int(math.log2(n_chars))) if known else 23
    places = [zlib.crc32(str(value).encode()) % SOURCES for value in (source, lang)]
    return [places[0], SOURCES + places[1], 2 * SOURCES + length]


def page_features(places: np.ndarray) -> np.ndarray:
    """Rows with a one at each of their places."""
    found = np.zeros((len(places), 2 * SOURCES + 24), np.float32)
    np.put_along_axis(found, places, 1, axis=1)
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, steps: int = 25) -> np.ndarray:
    """Weights of a logistic regression with an intercept last, by Newton's method."""
    x = np.column_stack([x, np.ones(len(x), x.dtype)])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ beta)
        slope = x.T @ (weight * (p - y)) + penalty * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(curve, slope)
        beta -= np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-6:
            break
    return beta


def logit(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return x @ beta[:-1] + beta[-1]


@dataclass
class Model:
    """Weights and calibration (slope and intercept of the logit) of either view and of both together."""

    views: list[np.ndarray] = field(default_factory=list)
    calibrations: list[np.ndarray] = field(default_factory=list)
    prior: float = 0.0
    together: np.ndarray | None = None

    def scores(self, text: np.ndarray, page: np.ndarray) -> list[np.ndarray]:
        logits = [logit(logit(x, b)[:, None], c) for x, b, c in zip((text, page), self.views, self.calibrations)]
        both = logit((logits[0] + logits[1] - self.prior)[:, None], self.together)
        return [_sigmoid(v) for v in (both, *logits)]


#: A row that is handed to a view: the view, the label, how sure the other view is, the row's id and its two views.
Handed = tuple[int, int, float, object, np.ndarray, np.ndarray]


def surest(ids: list, views: list[np.ndarray], model: Model, taken: list[set], counts: tuple[int, int]) -> list[Handed]:
    """For either view and label 0 and 1 the ``counts`` rows of which the other view is surest; of equal ones the first rows.

    A view is handed no id twice, and none of its ``taken``.
    """
    handed = []
    for view in (0, 1):
        p = _sigmoid(logit(logit(views[view], model.views[view])[:, None], model.calibrations[view]))
        for label, sure in ((1, p), (0, 1 - p)):
            # Products of matrices round differently from batch to batch.
            sure, other = np.round(sure, 9), set(taken[1 - view])
            for row in np.argsort(-sure, kind="stable"):
                if sure[row] < SURE or len(other) - len(taken[1 - view]) == counts[label]:
                    break
                if ids[row] not in other:
                    other.add(ids[row])
                    handed.append((1 - view, label, float(sure[row]), ids[row], views[0][row], views[1][row]))
    return handed


def cotrain(
    views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray] | Callable[[Model, list[set], tuple[int, int]], list[Handed]], rounds: int = ROUNDS
) -> Model | None:
    """Two classifiers that teach each other on ``pool``: the two views of unlabelled rows, or what gives the surest of them.

    In each round either one is trained, calibrated on held-back labels, and hands the rows of which it is
    surest to the other's training rows, of each class in its share. None if there are too few labels.
    """
    back = np.arange(len(y)) % CALIBRATION == 0
    if min((y == 1).sum(), (y == 0).sum()) < FEWEST or len(set(y[back])) < 2 or len(set(y[~back])) < 2:
        return None
    if not callable(pool):
        pool = partial(surest, list(range(len(pool[0]))), pool)
    prior = float(y.mean())
    counts = tuple(max(1, round(HANDED * share)) for share in (1 - prior, prior))
    given: list[dict[object, tuple[int, np.ndarray]]] = [{}, {}]
    model = Model(prior=math.log(prior / (1 - prior)))
    for turn in range(rounds + 1):
        model.views, model.calibrations = [], []
        for view in (0, 1):
            rows = [given[view][r] for r in sorted(given[view])]
            x = np.concatenate([views[view][~back], *(x[None, :] for _, x in rows)])
            target = np.concatenate([y[~back], [label for label, _ in rows]])
            weight = np.concatenate([np.ones((~back).sum()), np.full(len(rows), PSEUDO_WEIGHT)])
            beta = fit(x, target, weight)
            held = logit(views[view][back], beta)[:, None]
            model.views.append(beta)
            model.calibrations.append(fit(held, y[back], np.ones(back.sum()), ridge=0.1))
        if turn == rounds:
            break
        handed = pool(model, [set(g) for g in given], counts)
        for view, label, _, id, *both in handed:
            given[view].setdefault(id, (label, both[view]))
        if not handed:
            break
    logits = [logit(logit(v[back], b)[:, None], c) for v, b, c in zip(views, model.views, model.calibrations)]
    model.together = fit((logits[0] + logits[1] - model.prior)[:, None], y[back], np.ones(back.sum()), ridge=0.1)
    return model


def _surest_of_all(pool: DataFrame, model: Model, taken: list[set], counts: tuple[int, int]) -> list[Handed]:
    """``surest`` of all rows of ``pool`` (``id, place, text, page``): of each task's surest rows the surest, equal ones by ``place``."""
    kind = pool.schema["id"].dataType.simpleString()
    names = ["view", "label", "sure", "id", "place", "text", "page"]

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.sort_by([("place", "ascending"), ("id", "ascending")])
            ids = batch.column("id").to_pylist()
            places = dict(zip(ids, batch.column("place").to_pylist()))
            text, page = matrix(batch.column("text"), len(batch.column("text")[0])), matrix(batch.column("page"), 3)
            for view, label, sure, id, x, page_x in surest(ids, [text, page_features(page)], model, taken, counts):
                if sure > held.get((view, label, id), (0.0,))[0]:
                    held[view, label, id] = (sure, places[id], x, np.flatnonzero(page_x).tolist())
            for group in {key[:2] for key in held}:
                keys = sorted((k for k in held if k[:2] == group), key=lambda k: (-held[k][0], held[k][1], k[2]))
                for key in keys[counts[group[1]] :]:
                    del held[key]
        rows = [(*key[:2], sure, key[2], place, x.tolist(), page) for key, (sure, place, x, page) in held.items()]
        columns = list(zip(*rows)) or [[]] * len(names)
        types = [pa.int32(), pa.int32(), pa.float64(), pool_id, pa.int64(), pa.list_(pa.float32()), pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    pool_id = pool.select("id").limit(0).toArrow().schema.field("id").type
    found = pool.mapInArrow(of_task, f"view int, label int, sure double, id {kind}, place bigint, text array<float>, page array<int>")
    order = [F.desc("sure"), "place", "id", "text", "page"]
    found = found.withColumn("again", F.row_number().over(Window.partitionBy("view", "label", "id").orderBy(*order))).where("again = 1")
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("view", "label").orderBy(*order)))
    found = found.where((F.col("rank") <= max(counts)) & (F.col("rank") <= F.when(F.col("label") == 1, counts[1]).otherwise(counts[0])))
    rows = found.orderBy("view", F.desc("label"), "rank").collect()
    return [(r["view"], r["label"], r["sure"], r["id"], np.array(r["text"], np.float32), page_features(np.array([r["page"]]))[0]) for r in rows]


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", label: str = "quality", **columns: str) -> Model | None:
    """Train on at most ``LABELLED`` labelled documents, the first by a hash of the id, and on all unlabelled ones.

    The unlabelled documents' features are written once and scored in each round where they lie. Features of the
    labelled documents and of those handed over come to the driver. Labels other than 0 and 1 and contradictory
    ones teach nothing. None if a class has fewer than ``FEWEST`` labels.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull()).groupBy(F.col(id).alias("id"))
    known = known.agg(F.min(label).alias("y"), F.max(label).alias("most")).where("y = most").select("id", "y")
    ids = docs.select(F.col(id).alias("id")).where("id IS NOT NULL")
    order = [F.xxhash64("id"), F.col("id")]
    # A hash of the id sorts them; the list has a fixed bound, so it may be broadcast.
    first = known.join(ids.distinct(), "id", "left_semi").orderBy(*order).limit(LABELLED)
    chosen = F.broadcast(first.select(F.col("id").alias("_chosen"), F.col("y").cast("int").alias("y")))
    rows = _viewed(docs, columns, [F.col(id).alias("id")]).where("id IS NOT NULL")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            kept = [c for c in ("id", "y") if c in batch.schema.names]
            text, places = _features(batch)
            lists = [pa.array(list(text), pa.list_(pa.float32())), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *lists], [*kept, "text", "page"])

    kind = docs.schema[id].dataType.simpleString()
    lists = "text array<float>, page array<int>"
    # In an order that does not depend on the tasks; calibration takes every fifth row.
    place = F.xxhash64("id", F.lit(1))
    labelled = rows.join(chosen, F.col("id") == F.col("_chosen")).mapInArrow(features, f"id {kind}, y int, {lists}")
    found = labelled.dropDuplicates(["id"]).orderBy(place, "id").drop("id").toArrow()
    if not len(found):
        return None
    text = matrix(found["text"].combine_chunks(), len(found["text"][0]))
    page = page_features(matrix(found["page"].combine_chunks(), 3))
    y = found["y"].combine_chunks().to_numpy().astype(float)
    made: list[DataFrame] = []

    def pool(*round) -> list[Handed]:
        if not made:
            others = rows.mapInArrow(features, f"id {kind}, {lists}")
            others = others.join(spread(known.select("id"), "id"), "id", "left_anti")
            made.append(written(others.withColumn("place", place), "unlabelled"))
        return _surest_of_all(made[0], *round)

    return cotrain([text, page], y, pool)


def _viewed(docs: DataFrame, columns: dict[str, str], more: list) -> DataFrame:
    names = {"text": "text", "source": "source", "lang": "lang", "n_chars": "n_chars"} | columns
    return docs.select(*more, *[F.col(c).alias(f"_{n}") for n, c in names.items()])


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, list[list[int]]]:
    text = [text_features(t.as_py()) for t in batch.column("_text")]
    places = [page_places(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("_source", "_lang", "_n_chars")))]
    return np.array(text, np.float32), places


def with_quality(docs: DataFrame, model: Model | None, into: str, threshold: float = THRESHOLD, **columns: str) -> DataFrame:
    """``docs`` with a struct ``into`` of ``score, text_score, page_score, accepted``.

    Scores are calibrated probabilities of good quality, of both views together and of either. NULL and empty
    texts and unknown metadata have features of their own and are scored like others. Without a model
    the scores are NULL and every document is accepted. Rows stay as they are, repeated ones included. A
    column called ``into`` is replaced.
    """
    rest = docs.drop(into)
    if model is None:
        nothing = [F.lit(None).cast("double").alias(n) for n in SCHEMA.names[:3]]
        return rest.withColumn(into, F.struct(*nothing, F.lit(True).alias("accepted")))
    names = {"text": "text", "source": "source", "lang": "lang", "n_chars": "n_chars"} | columns
    lower = [c.lower() for c in rest.columns]
    places = {f"_{n}": lower.index(c.lower()) for n, c in names.items()}

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text, page = _features(pa.RecordBatch.from_arrays([batch.column(i) for i in places.values()], list(places)))
            scores = model.scores(text, page_features(np.array(page)))
            columns = [*(pa.array(s) for s in scores), pa.array(scores[0] >= threshold)]
            struct = pa.StructArray.from_arrays(columns, names=SCHEMA.names)
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], [*batch.schema.names, into])

    return rest.mapInArrow(scored, T.StructType([*rest.schema.fields, T.StructField(into, SCHEMA)]))
