"""Stages of the pipeline against brute force, and the queries' registration."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from test_operators import best_window, components_by_force, sentence, words_of
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
import corpus_pipeline
from sievework.llm import queries

EN = "the of and with there these others which where when while every under over".split()
FR = "les des été où très quand chaque entre avant après depuis leurs notre votre".split()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = {"en": EN + [w + "ing" for w in EN], "fr": FR + [w + "ique" for w in FR]}
    rows = []
    for i in range(120):
        lang = ("en", "fr")[i % 2]
        rows.append((i, sentence(rng, rng.randint(20, 90), vocabulary[lang]), lang, f"s{i % 4}"))
    rows += [(200 + i, rows[i][1], rows[i][2], "s0") for i in range(5)]  # exact copies
    near = rows[7][1].split(" ")
    rows += [(300 + i, " ".join([*near[:i], "other", *near[i + 1 :]]), "fr", "s1") for i in (0, len(near) - 1)]
    rows += [(400, None, "en", "s1"), (401, "", None, None), (402, "123 !!!", "fr", "s2"), (None, sentence(rng, 40, vocabulary["en"]), "en", None)]
    rows += [rows[3], (500, f"{rows[9][1]} {rows[20][1]}", "en", "s3")]
    folder = tmp_path_factory.mktemp("corpus")
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    full = [(*r, len(r[1] or ""), "x") for r in rows]
    spark.createDataFrame(full, schema).repartition(3).write.parquet(str(folder / "documents.parquet"))
    items = [(1, rows[20][1]), (2, sentence(rng, 30, vocabulary["en"])), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), full, items


def ids(frame):
    return Counter(r["doc_id"] for r in frame.collect())


def test_each_stage_does_its_work(spark, tables):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    identified = corpus_pipeline.identify(spark, docs, folder)
    assert identified.columns == docs.columns
    assert ids(identified) == Counter(r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1]))

    left = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    found = corpus_pipeline.keep_one(spark, identified, folder)
    want = {d for d, _, component in components_by_force(left) if d is None or d == component}
    assert found.columns == docs.columns and ids(found) == Counter(dict.fromkeys(want, 1))

    left = [r for r in rows if r[0] in want and r[1] and any(c.isalpha() for c in r[1])]
    clean = corpus_pipeline.decontaminated(spark, found, folder)
    wanted = {r[0] for r in left if not any(t and best_window(r[1], t) >= 0.8 for _, t in items)}
    assert clean.columns == docs.columns and set(ids(clean)) == wanted and 20 not in wanted and 500 not in wanted

    drawn = corpus_pipeline.mixed(spark, clean, folder)
    assert drawn.columns == docs.columns
    copies = ids(drawn)
    assert set(copies) <= wanted and max(copies.values()) <= 3
    sizes = {r[0]: len(words_of(r[1])) for r in left}
    total = sum(sizes[d] for d in wanted)
    assert abs(sum(sizes[d] * n for d, n in copies.items()) - total) <= 0.03 * total

    kept = drawn.collect()
    plain = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    encoded = Counter()
    for r in kept:
        tokens = plain.encode(r["text"], add_special_tokens=False).ids + [2]
        encoded[r["doc_id"], len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())] += 1
    records = corpus_pipeline.token_files(spark, drawn, folder).collect()
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in records) == encoded
    at = 0
    for r in sorted(records, key=lambda r: (r["start"])):
        assert r["start"] == at
        at += r["n_tokens"]


def test_clean_texts_with_long_tables_are_kept(spark, tables):
    rng = random.Random(12)

    def table(n):
        return "\n".join(" ".join(f"{rng.randrange(10**6):06d}" for _ in range(8)) for _ in range(n))

    words = {lang: ["".join(rng.choices(letters, k=5)) for _ in range(30)] for lang, letters in
             (("l1", "abcdef"), ("l2", "ghijkl"), ("l3", "mnopqr"), ("l4", "stuvwx"))}
    rows = [(i, f"{sentence(rng, 50, w)}\n{table(4)}", lang) for lang, w in words.items() for i in range(50)]
    # without a label, so nothing is learned from them
    rows += [(900 + i, f"{sentence(rng, 20, w)}\n{table(800)}", None) for i, w in enumerate(words.values())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert ids(corpus_pipeline.identify(spark, docs, tables[0])) == Counter(r[0] for r in rows)


def test_run_joins_the_stages(spark, tables):
    folder, _, _ = tables
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    assert corpus_pipeline.run(spark, folder).count() > 50


def test_stages_of_an_empty_table(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).isEmpty()


def test_all_queries_are_registered():
    names = entry_module.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(queries.ORACLES) <= set(entry_module.oracle_sql())
