"""Quality of a text by a sparse ensemble of rules.

Small trees are grown on statistics of labelled texts; every path from a root is a conjunction of
comparisons, and a logistic model with an absolute-value penalty keeps few of these rules. The rules
become Spark column expressions over the statistics, so scoring is a sum of CASE terms.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.llm.common import as_bytes, aside, restored
from sievework.llm.shingles import shingle_hashes, word_hashes

# Labelled documents the rules are learned from, those with the smallest hashes.
SAMPLE_DOCUMENTS = 6000
_TREES, _DEPTH, _LEAF = 40, 3, 20
_CUTS = 32
_PENALTY = 0.002

STATISTICS = (
    "bytes", "words", "lines", "word_bytes", "upper", "digits", "punctuation", "symbols", "bars",
    "marks", "spaces", "wide", "vowels", "same_word", "word_kinds", "shingle_kinds", "top_word",
    "line_kinds",
)


def _classes() -> np.ndarray:
    of = np.zeros((256, 9), np.float32)
    for column, characters in enumerate(
        (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:'\"-()", b"#$%&*@^~<>{}[]\\=+_/", b"|", b"!?", b" \t")
    ):
        of[list(characters), column] = 1
    of[128:, 7] = 1
    of[list(b"aeiouAEIOU"), 8] = 1
    return of


_CLASSES = _classes()


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """A row of :data:`STATISTICS` per text: sizes, shares of kinds of bytes, and how varied words,
    runs of five words and lines are. All 0 for a missing or empty text."""
    out = np.zeros((len(texts), len(STATISTICS)))
    for row, text, words in zip(out, texts, word_hashes(texts)):
        if not text:
            continue
        n = len(text)
        counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        row[:4] = n, len(words), text.count(b"\n") + 1, n / (len(words) + 1)
        row[4:13] = counts @ _CLASSES / n
        if len(words):
            kinds, often = np.unique(words, return_counts=True)
            row[13] = np.count_nonzero(words[1:] == words[:-1]) / len(words)
            row[14] = len(kinds) / len(words)
            shingles = shingle_hashes(words)
            row[15] = len(np.unique(shingles)) / len(shingles)
            row[16] = often.max() / len(words)
        lines = text.split(b"\n")
        row[17] = len(set(lines)) / len(lines)
    return out


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "q_", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the statistics of the whole texts."""
    names = [prefix + s for s in STATISTICS]
    docs, moved = aside(docs, ["_text"])
    text, keep = moved.get(text, text), [moved.get(c, c) for c in keep] if keep is not None else None
    columns = [c for c in (docs.columns if keep is None else keep) if c not in names]
    base = docs.select(*columns, F.col(text).alias("_text"))
    schema = base.drop("_text").schema
    for name in names:
        schema = schema.add(name, "double")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = statistics(as_bytes(batch, "_text"))
            arrays = [batch.column(c) for c in columns] + [pa.array(v) for v in values.T]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *names])

    return restored(base.mapInArrow(compute, schema), moved)


# --- learning, on the bounded sample ---------------------------------------------------------------

Condition = tuple[int, bool, float]  # statistic, above, value


@dataclass(frozen=True)
class Rules:
    conditions: list[tuple[Condition, ...]]
    weights: list[float]
    base: float

    def expression(self, column) -> Column:
        """Score between 0 and 1 over the columns of the statistics."""
        total = F.lit(self.base)
        for conditions, weight in zip(self.conditions, self.weights):
            holds = [column(s) > v if above else column(s) <= v for s, above, v in conditions]
            total = total + F.when(reduce(and_, holds), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _applies(conditions: tuple[Condition, ...], x: np.ndarray) -> np.ndarray:
    return reduce(and_, (x[:, s] > v if above else x[:, s] <= v for s, above, v in conditions))


def _paths(x, target, curvature, rng, path=(), depth=_DEPTH) -> list[tuple[tuple[Condition, ...], float]]:
    """Every path of one tree fitted to gradients, with its step; leaves and inner nodes alike."""
    if depth == 0 or len(x) < 2 * _LEAF:
        return []
    best = (0.0, None)
    whole = target.sum() ** 2 / (curvature.sum() + 1)
    for s in rng.choice(x.shape[1], max(6, x.shape[1] // 2), replace=False):
        order = np.argsort(x[:, s], kind="stable")
        values, sums, weights = x[order, s], target[order].cumsum(), curvature[order].cumsum()
        cuts = np.unique(np.linspace(_LEAF, len(x) - _LEAF, _CUTS).astype(int)) - 1
        cuts = cuts[values[cuts] < values[cuts + 1]]
        if len(cuts) == 0:
            continue
        left, right = sums[cuts], sums[-1] - sums[cuts]
        gain = left**2 / (weights[cuts] + 1) + right**2 / (weights[-1] - weights[cuts] + 1) - whole
        at = int(gain.argmax())
        if gain[at] > best[0] + 1e-9:
            middle = (values[cuts[at]] + values[cuts[at] + 1]) / 2
            best = (float(gain[at]), (int(s), float(middle)))
    if best[1] is None:
        return []
    s, value = best[1]
    out = []
    for above in (False, True):
        side = x[:, s] > value if above else x[:, s] <= value
        longer = (*path, (s, above, value))
        step = target[side].sum() / (curvature[side].sum() + 1)
        out.append((longer, float(step)))
        out += _paths(x[side], target[side], curvature[side], rng, longer, depth - 1)
    return out


def learn(x: np.ndarray, y: np.ndarray) -> Rules:
    """Rules from boosted trees, weighted by penalised logistic regression. With one label only, or no
    rows, the score is the share of label 1 (one half without rows)."""
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(y) < 4 * _LEAF or y.min() == y.max():
        return Rules([], [], base)
    rng = np.random.default_rng(7)
    margin = np.full(len(y), base)
    found: dict[tuple[Condition, ...], None] = {}
    for _ in range(_TREES):
        p = 1 / (1 + np.exp(-margin))
        some = rng.random(len(y)) < 0.7
        paths = _paths(x[some], (y - p)[some], (p * (1 - p))[some], rng)
        for conditions, step in paths:
            found.setdefault(conditions)
            if len(conditions) == _DEPTH:
                margin += 0.3 * step * _applies(conditions, x)
    rules = list(found)
    if not rules:
        return Rules([], [], base)
    r = np.stack([_applies(c, x) for c in rules], axis=1).astype(np.float64)
    r, kept = np.unique(r, axis=1, return_index=True)  # rules that always agree count once
    weights, base = _lasso(r, y, base)
    used = np.flatnonzero(np.abs(weights) > 1e-6)
    return Rules([rules[kept[i]] for i in used], [float(weights[i]) for i in used], float(base))


def _lasso(r: np.ndarray, y: np.ndarray, base: float) -> tuple[np.ndarray, float]:
    """Accelerated proximal gradient on the mean logistic loss plus the absolute weights."""
    n = len(y)
    full = np.hstack([r, np.ones((n, 1))])
    step = 4 / np.linalg.norm(full, 2) ** 2 * n
    w = np.zeros(full.shape[1])
    w[-1] = base
    ahead, t = w, 1.0
    for _ in range(600):
        gradient = full.T @ (1 / (1 + np.exp(-full @ ahead)) - y) / n
        new = ahead - step * gradient
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * _PENALTY, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1], w[-1]


def training_sample(
    docs: DataFrame, labels: DataFrame, chosen: Column, limit: int = SAMPLE_DOCUMENTS,
    doc_id: str = "doc_id", label: str = "quality", text: str = "text",
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``limit`` labelled documents, those with the smallest hashes.

    A document with several labels counts by the larger. Ids are chosen before texts are read.
    """
    known = (
        labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull() & chosen)
        .groupBy(F.col(doc_id).alias("_id"))
        .agg((F.max(label) > 0).cast("double").alias("_y"))
        .orderBy(F.xxhash64(F.lit("quality"), "_id"), "_id")
        .limit(limit)
    )
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(known), "_id")
    # repeated ids would exceed the bound on what the driver receives
    rows = with_statistics(texts, "_text", keep=["_id", "_y"]).orderBy("_id").limit(2 * limit).collect()
    data = np.array([[r[2 + i] for i in range(len(STATISTICS))] for r in rows]).reshape(-1, len(STATISTICS))
    return data, np.array([r["_y"] for r in rows])


def score_quality(docs: DataFrame, rules: Rules, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 from 0.5 on). Only the text counts; a NULL or empty text has statistics of 0 and
    is scored by them. Columns of these names are replaced."""
    columns = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    measured = with_statistics(docs, text, keep=columns)
    score = rules.expression(lambda s: F.col("q_" + STATISTICS[s]))
    scored = measured.select(*columns, score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
