"""Language of a text by prediction by partial matching.

Each language has a tree of byte contexts up to ``ORDER`` long. A byte costs what the longest known
context says; a byte new to a context costs its escape and then what the next shorter
context says, down to a uniform choice among 256. Statistics are frozen after training, so the cost of
a byte depends only on it and the bytes before it, and all costs are worked out once into a table
of (context, byte, language). A text's code length under each language is then a sum of table rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievework.llm.common import as_bytes, release_memory

ORDER = 3
# Documents per language that the trees are learned from, chosen by a hash of id and text.
SAMPLE_DOCUMENTS = 400
UNDETERMINED = "und"
MOST_LANGUAGES = 1000
_DRAWS = 1 << 40
# A context met less often in training stays out of the trees.
MET = 4
_PIECE = 1 << 19
_LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    """``symbols`` maps a byte to its symbol (0 stands before a text, 1 for bytes never seen),
    ``contexts`` the last three symbols to a context, ``costs`` (context, symbol) to bits."""

    languages: list[str]
    symbols: np.ndarray
    contexts: np.ndarray
    costs: np.ndarray
    size: int


def _symbols_of(text: bytes, symbols: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(ORDER, np.int32), symbols[np.frombuffer(text, np.uint8)]))


def train(texts: dict[str, list[bytes]]) -> Model:
    """Model of the given texts. Costs of the languages are worked out alike over all contexts, so
    that they can be compared."""
    languages = sorted(texts)
    seen = np.zeros(256, bool)
    for some in texts.values():
        for text in some:
            seen[np.frombuffer(text, np.uint8)] = True
    symbols = np.where(seen, np.cumsum(seen) + 1, 1).astype(np.int32)
    size = int(seen.sum()) + 2
    # counts per language of runs of 1 to ORDER + 1 symbols
    grams: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for language in languages:
        parts: list[list[np.ndarray]] = [[] for _ in range(ORDER + 1)]
        for text in texts[language]:
            s = _symbols_of(text, symbols).astype(np.int64)
            code = np.zeros(len(s) - ORDER, np.int64)
            for k in range(ORDER + 1):
                code = code + s[ORDER - k : len(s) - k] * size**k
                parts[k].append(code)
        grams.append([np.unique(np.concatenate(p or [np.zeros(0, np.int64)]), return_counts=True) for p in parts])
    # code = context * size + byte; a context of k symbols is the code of those symbols
    tree, rows, levels = [], [0], []
    for k in range(ORDER + 1):
        codes = np.concatenate([g[k][0] for g in grams] or [np.zeros(0, np.int64)])
        counts = np.concatenate([g[k][1] for g in grams] or [np.zeros(0, np.int64)])
        known, owner = np.unique(codes // size, return_inverse=True)
        # a context met less often stays out of the tree; so do all longer ones that end in it
        known = known[np.bincount(owner, counts, len(known)) >= MET] if k else np.zeros(1, np.int64)
        tree.append(known)
        levels.append(_costs(grams, tree, levels, size))
        rows.append(rows[-1] + len(known))
    # the longest known context of any three symbols
    contexts = np.zeros(size**ORDER, np.int32)
    every = np.arange(size**ORDER, dtype=np.int64)
    for k in range(1, ORDER + 1):
        suffix = every % size**k
        at = np.minimum(np.searchsorted(tree[k], suffix), max(len(tree[k]) - 1, 0))
        if len(tree[k]):
            found = tree[k][at] == suffix
            contexts[found] = rows[k] + at[found]
    costs = np.concatenate(levels)
    return Model(languages, symbols, contexts, costs.reshape(costs.shape[0] * size, len(languages)), size)


def _costs(grams: list, tree: list[np.ndarray], levels: list[np.ndarray], size: int) -> np.ndarray:
    """Bits of (context, symbol, language) for the contexts of the longest level so far."""
    k = len(levels)
    known = tree[k]
    out = np.empty((len(known), size, len(grams)), np.float32)
    for i, gram in enumerate(grams):
        codes, counts = gram[k]
        owner = np.minimum(np.searchsorted(known, codes // size), max(len(known) - 1, 0))
        kept = known[owner] == codes // size if len(known) else np.zeros(len(codes), bool)
        owner, byte, counts = owner[kept], codes[kept] % size, counts[kept]
        total = np.bincount(owner, counts, len(known))
        kinds = np.bincount(owner, minlength=len(known))
        if k:
            shorter = levels[-1][np.searchsorted(tree[k - 1], known % size ** (k - 1))][:, :, i]
        else:
            shorter = np.full((1, size), 8.0)  # any of 256 bytes
        # the escape counts as often as there are different bytes; a context that this language
        # never had is skipped at no cost
        escape = np.where(total > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0.0)
        mine = shorter + escape[:, None]
        mine[owner, byte] = -np.log2(counts / (total + kinds)[owner])
        out[:, :, i] = mine
    return out


def code_lengths(model: Model, texts: list[bytes]) -> np.ndarray:
    """Bits of each text under each language."""
    size = model.size
    out = np.zeros((len(texts), len(model.languages)))
    lead = np.zeros(ORDER, np.int32)
    held: list[np.ndarray] = []
    owners: list[tuple[int, int]] = []
    length = 0

    def settle() -> None:
        if not owners:
            return
        s = np.concatenate(held)
        context = (s[:-3] * size + s[1:-2]) * size + s[2:-1]
        row = model.contexts[context].astype(np.int64) * size + s[3:]
        starts = np.cumsum([0] + [n for _, n in owners[:-1]])
        bits = model.costs[row]
        if len(owners) > 1:
            # rows that only lead into the next text cost nothing
            bits[(starts[1:, None] - np.arange(1, ORDER + 1)).ravel()] = 0
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.float64)
        np.add.at(out, [i for i, _ in owners], sums)

    for i, text in enumerate(texts):
        s = model.symbols[np.frombuffer(text, np.uint8)]
        before = lead
        for at in range(0, len(s), _PIECE):
            piece = s[at : at + _PIECE]
            held += [before, piece]
            owners.append((i, len(piece) + ORDER))
            before = s[max(at + _PIECE - ORDER, 0) : at + _PIECE]
            length += len(piece)
            if length >= _PIECE:
                settle()
                held, owners, length = [], [], 0
    settle()
    return out


def training_rows(
    docs: DataFrame, chosen: Column, limit: int, label: str = "lang", text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """At most ``limit`` documents of each language, those with the smallest hashes.

    Counts narrow the rows down to about three times as many where they are read, so no other text
    is shuffled and a hot language does not meet in one task.
    """
    known = docs.filter(chosen & F.col(label).isNotNull() & (F.length(text) > 0)).select(
        F.col(label).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit("lang"), doc_id, text).alias("h")
    )
    counts = docs.filter(chosen & F.col(label).isNotNull()).groupBy(F.col(label).alias("l")).agg(F.count(F.lit(1)).alias("n"))
    found = counts.limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not found:
        return known.select("lang", "text").limit(0)
    below = F.create_map(*[F.lit(v) for r in found for v in (r["l"], int(min(1.0, 3.0 * limit / r["n"]) * _DRAWS))])
    few = known.filter(F.pmod("h", F.lit(_DRAWS)) < F.element_at(below, F.col("lang")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    return few.withColumn("_r", rank).filter(F.col("_r") <= limit).select("lang", "text")


def fit(docs: DataFrame, chosen: Column, limit: int = SAMPLE_DOCUMENTS, **names: str) -> Model:
    """Learn the languages of the documents for which ``chosen`` is true."""
    texts: dict[str, list[bytes]] = {}
    # bounded: ``limit`` documents per language
    for row in training_rows(docs, chosen, limit, **names).orderBy("lang", "text").collect():
        texts.setdefault(row["lang"], []).append(row["text"].encode())
    return train(texts)


def predict_language(docs: DataFrame, model: Model, text: str = "text", margin: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``bits_per_byte``, and on demand ``margin``.

    The language with the shortest code, ties by name; ``score`` is its share of 2^-bits over all
    languages, bits taken per byte and times ten so that long texts don't all score 1. A text that
    is NULL or has no letter is ``und`` with score 0 and NULL bits, and so is any text under a
    model without languages. Nothing but the text decides. Columns of these names are replaced.

    ``margin`` is by how many bits in total the best language's code is shorter than the second's
    (infinite if there is no other, 0 for ``und``). Bytes that cost all languages the same, as those of
    numbers, tables or hex, lower the score but not the margin, and neither do further languages.
    """
    names = ("lang_pred", "score", "bits_per_byte", "margin")[: 4 if margin else 3]
    base = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(tuple(model))
    schema = StructType(list(base.schema.fields))
    schema = schema.add("lang_pred", "string").add("score", "double").add("bits_per_byte", "double")
    if margin:
        schema = schema.add("margin", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        for batch in batches:
            codes, *numbers = verdicts(Model(*shared.value), as_bytes(batch, text))
            arrays = [pa.array(codes, pa.string()), *[pa.array(n, pa.float64()) for n in numbers]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays[: len(names)]], names=[*batch.schema.names, *names])

    return base.mapInArrow(predict, schema)


def verdicts(model: Model, texts: list[bytes | None]) -> tuple[list[str], list[float], list[float | None], list[float]]:
    plain = [t if t and _LETTER.search(t.decode("utf-8", "replace")) else b"" for t in texts]
    if not model.languages:
        plain = [b""] * len(texts)
    bits = code_lengths(model, plain) if model.languages else np.zeros((len(texts), 1))
    sizes = np.maximum([len(t) for t in plain], 1)
    rates = bits / sizes[:, None]
    best = rates.argmin(axis=1)
    least = rates.min(axis=1)
    scores = 1 / np.exp2(10 * (least[:, None] - rates)).sum(axis=1)
    second = np.partition(bits, 1, axis=1)[:, 1] if bits.shape[1] > 1 else np.full(len(texts), np.inf)
    margins = second - bits.min(axis=1)
    empty = [not t for t in plain]
    return (
        [UNDETERMINED if e else model.languages[b] for e, b in zip(empty, best)],
        [0.0 if e else float(s) for e, s in zip(empty, scores)],
        [None if e else float(r) for e, r in zip(empty, least)],
        [0.0 if e else float(m) for e, m in zip(empty, margins)],
    )
