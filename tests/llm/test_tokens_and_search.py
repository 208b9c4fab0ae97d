"""Token alignment, piece encoding and ranked search against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sievework.llm import binary_records, common, lexical_search, piece_codec, queries, token_alignment
from sievework.llm.memo import Made, Memo

TOKENIZER = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
# columns with names that the operators use themselves
DOCS = "doc_id long, text string, row string, pairs int, n int, terms string, ids int, score double, item_id int, rank int"
SIGNS = ["a", "b", "e", " ", " ", "\n", "\t", "é", "漢", "\U0001f600", "字", "　", " ", "the", "ing", "<s>",
         "<|endoftext|>", "0", "12", "-", "--", "'s", "한", "ก", "‍", "́", "\x1c", "\x85", "X", "▁"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 7))) for _ in range(60)]
    prose = [" ".join(rng.choices(words, k=rng.randint(1, 80))) for _ in range(40)]
    signs = ["".join(rng.choices(SIGNS, k=rng.randint(1, 16))) for _ in range(400)]
    odd = [None, "", " ", "  ", "\n\t", "a ", " a", "a  ", "▁", "a▁b", "x" * 3000, "ab " * 2000, "é" * 300, "漢" * 300,
           "-" * 999, " " * 301 + "x", "x" + "-" * 999 + " " + "=" * 500, "\U0001f600" * 99, prose[0], prose[0], "<0x0A>",
           " ".join(rng.choices(words, k=9000))]
    return prose + signs + odd


@pytest.fixture(scope="module")
def rows(texts):
    out = [(i, t, "x", 1, 2, "y", 3, 0.5, 4, 5) for i, t in enumerate(texts)]
    # rows repeated in full, and without an id
    return out + [out[3], out[3], (None, "the id is missing", *out[0][2:]), (None, None, *out[0][2:])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def counted(df):
    return Counter(tuple(r) for r in df.collect())


# --- pieces --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_proto=MODEL)


def test_pieces_equal_the_library(docs, rows, empty, library):
    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = Counter()
    for key, text, *_ in rows:
        ids = library.encode(text or "", add_eos=True)
        want[(key, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids)))] += 1
    # without the check, so the agenda alone is what is compared
    assert counted(piece_codec.digest_pieces(docs, MODEL, check=False)) == want
    assert counted(piece_codec.digest_pieces(docs, MODEL)) == want
    assert piece_codec.digest_pieces(empty, MODEL).collect() == []
    full = piece_codec.encode_pieces(docs, MODEL, end=False).collect()
    assert all(r["ids"] == library.encode(dict(zip([k for k, *_ in rows], [t for _, t, *_ in rows]))[r["doc_id"]] or "")
               for r in full if r["doc_id"] is not None)


def test_any_ids_decode_like_the_library(library):
    model = piece_codec.PieceModel(MODEL)
    rng = random.Random(2)
    for _ in range(20000):
        ids = [rng.choice([0, 1, 2, rng.randrange(3, 259), rng.randrange(3, 259), 28705, 2287, rng.randrange(32000)])
               for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == library.decode(ids), ids


def test_very_long_words_are_encoded(library):
    model = piece_codec.PieceModel(MODEL)
    rng = random.Random(4)
    for text in ("x" * 200_000, "".join(rng.choices("abcdefgh", k=200_000)), "\n".join(rng.choices("abc", k=100_000))):
        assert model.encode(text) == library.encode(text)


def test_a_difference_from_the_library_is_raised():
    model = piece_codec.PieceModel(MODEL)
    ids = model.encode("some words")
    assert piece_codec.checked(model, [1], ["some words"], [ids]) == ["some words"]
    with pytest.raises(piece_codec.LibraryDiffers, match="document 2"):
        piece_codec.checked(model, [1, 2], ["some words"] * 2, [ids, ids[1:]])


def test_other_operators_caches_leave_the_worker():
    """Only the tasks that fill a cache keep it when they give memory back."""
    held = common.worker_cache()
    before = dict(held)
    common.of_worker("test", ("x",), lambda: [1])
    common.release_memory(keep=True)
    assert common.of_worker("test", ("x",), lambda: [2]) == [1]
    common.release_memory()
    assert not held
    held.update(before)


def test_words_get_the_larger_cache_and_small_ones_change_nothing(monkeypatch):
    tokenizer = binary_records.tokenizer_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert binary_records.Encoder(tokenizer, 2).rest.most_bytes > 40 << 20
    texts = [" ".join(f"word{i % 7}, other{i}." for i in range(n, n + 40)) for n in range(9)]
    expected = [binary_records.Encoder(tokenizer, 2)(t) for t in texts]
    monkeypatch.setattr(binary_records, "_FIRST_BYTES", 300)
    monkeypatch.setattr(binary_records, "_REST_BYTES", 2000)
    small = binary_records.Encoder(tokenizer, 2)
    assert [small(t) for t in texts] == expected and small.rest.older


def test_library_sees_every_cut_once_and_other_ids_stop_the_job():
    model = piece_codec.PieceModel(MODEL)
    model.fresh = []
    texts = ["some words, and some", " two  spaces  ", "", " ", "a\n\nline\n b", "▁x ▁ y", "é中😀 some words,", "x" * 99, "tail "]
    for _ in range(2):  # the second time only what is too long to be held
        ids = [model.encode(t) for t in texts]
        assert ids == model.library.encode(texts)
        seen = [cut for cut, _ in model.fresh]
        assert len(seen) == len(set(seen)) and model.fresh
        assert piece_codec.checked_by_cuts(model, list(range(9)), texts, ids) == model.library.decode(ids)
        assert model.fresh == []
    assert seen == [piece_codec.SPACE + "x" * 99]
    text = "quite new words"
    for wrong in (piece_codec.SPACE + "new", piece_codec.SPACE):
        model = piece_codec.PieceModel(MODEL)
        model.fresh, parts = [], model._parts
        model._parts = lambda cut, wrong=wrong, parts=parts: parts(cut)[:-1] if cut == wrong else parts(cut)
        texts = [text, text + " "]
        ids = [model.encode(t) for t in texts]
        with pytest.raises(piece_codec.LibraryDiffers, match="document [78]"):
            piece_codec.checked_by_cuts(model, [7, 8], texts, ids)
        assert not model.cuts and not model.cuts.older  # a task that is tried again finds it again


def test_other_models_are_refused():
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(MODEL)
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    with pytest.raises(ValueError):
        piece_codec.PieceModel(model.SerializeToString())


def test_memo_stays_within_its_bytes():
    memo = Memo(most_bytes=100_000, longest=8)
    for i in range(10_000):
        memo.put(f"{i:06d}", i, 0)
        assert memo.get(f"{i:06d}") == i
    memo.put("longer than eight", 1, 0)
    assert memo.get("longer than eight") is None
    assert len(memo.newer) + len(memo.older) < 1000
    made = Made(lambda key: (len(key),), most_bytes=100_000, longest=8)
    assert [made[f"{i % 3000:06d}"] for i in range(10_000)] == [(6,)] * 10_000
    assert made["longer than eight"] == (17,) and "longer than eight" not in made
    assert len(made) + len(made.older) < 1000


# --- alignment -----------------------------------------------------------------------------------


def brute_alignments(rows):
    """Whole texts encoded at once, groups from the byte ends of all tokens."""
    a_lib = Tokenizer.from_str(TOKENIZER)
    a_lib.encode_special_tokens = True
    b_lib = SentencePieceProcessor(model_proto=MODEL)
    signs = token_alignment.byte_of_sign

    def said(i):
        piece = b_lib.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_lib.is_byte(i) else piece.replace("▁", " ").encode()

    def one(text):
        data = (" " + text).encode()
        a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        ours, theirs = [bytes(signs(c) for c in a_lib.id_to_token(i)) for i in a], [said(i) for i in b]
        if b"".join(ours) != data or b"".join(theirs) != data:
            return None
        ends_a, ends_b = list(accumulate(map(len, ours))), list(accumulate(map(len, theirs)))
        at_a, at_b = {e: i for i, e in enumerate(ends_a, 1)}, {e: i for i, e in enumerate(ends_b, 1)}
        groups, links, i, j = [], Counter(), 0, 0
        for e in sorted(at_a.keys() & at_b.keys()):
            x, y = a[i : at_a[e]], b[j : at_b[e]]
            i, j = at_a[e], at_b[e]
            groups.append(f"{','.join(map(str, x))}|{','.join(map(str, y))}")
            links.update((p, q) for p in x for q in y)
        return len(a), len(b), groups, links

    done = [(key, one(text) if text else None) for key, text, *_ in rows]
    held = Counter(pair for _, d in done if d for pair in d[3])
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = Counter()
    for key, d in done:
        if d is None:
            out[(key, 0, 0, 0, 0, "", 0, 0)] += 1
            continue
        n_a, n_b, groups, links = d
        best = sum(n for pair, n in links.items() if held[pair] == most[pair[0]])
        total = sum(n * held[pair] for pair, n in links.items())
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out[(key, n_a, n_b, len(groups), sum(links.values()), digest, best, total)] += 1
    return out


def test_alignment_equals_brute_force(docs, rows, empty):
    width = token_alignment.pair_width(MODEL)
    want = brute_alignments(rows)
    aligned = token_alignment.align_documents(docs, TOKENIZER, MODEL)
    assert counted(token_alignment.link_statistics(aligned, width)) == want
    # only some pairs, or none, in the broadcast
    for few in (40, 0):
        assert counted(token_alignment.link_statistics(aligned, width, hot_pairs=few)) == want
    none = token_alignment.align_documents(empty, TOKENIZER, MODEL)
    assert token_alignment.link_statistics(none, width).collect() == []


def test_translations_are_the_best_links(docs, rows):
    aligned = token_alignment.align_documents(docs, TOKENIZER, MODEL)
    found = token_alignment.token_translations(aligned, token_alignment.pair_width(MODEL)).collect()
    the = Tokenizer.from_str(TOKENIZER).token_to_id("the")
    ours = SentencePieceProcessor(model_proto=MODEL).piece_to_id("the")
    assert [r["b_id"] for r in found if r["a_id"] == the] == [ours]


def test_groups_are_the_same_however_little_is_encoded_at_once(texts, monkeypatch):
    whole = token_alignment.Aligner(TOKENIZER, MODEL)
    spaced = [" " + t for t in texts if t]
    want = whole.chunks(spaced)
    monkeypatch.setattr(token_alignment, "ENCODE_CHARS", 5)
    assert token_alignment.Aligner(TOKENIZER, MODEL).chunks(spaced) == want


def test_words_and_signs_that_recur_are_not_encoded_again(monkeypatch):
    aligner = token_alignment.Aligner(TOKENIZER, MODEL)
    aligner.chunks([" Words, été!\nlines"])
    want = token_alignment.Aligner(TOKENIZER, MODEL).chunks([" été, Words!\nlines, Words!"])
    monkeypatch.setattr(aligner, "a", None)
    assert aligner.chunks([" été, Words!\nlines, Words!"]) == want


def test_parts_of_chunks_do_not_depend_on_what_stands_beside_them(texts):
    aligner = token_alignment.Aligner(TOKENIZER, MODEL)
    rng = random.Random(6)
    signs = [*SIGNS, "I'll", "d'", "re", "'", "…", "²", "_", "(", "\r", ".\n"]
    spaced = [" " + t for t in texts if t] + [" " + "".join(rng.choices(signs, k=40)) for _ in range(200)]
    aligner.chunks(spaced)
    found = aligner.chunks([" ".join(rng.sample(spaced, 2)) for _ in range(200)])
    assert sum(len(aligner.parts(chunk)) > 1 for chunk in found) > 200
    assert found == {chunk: aligner._align_one(chunk) for chunk in found}


# --- ranked search -------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_search(rows, items, k):
    docs = [(key, TERM.findall((text or "").translate(LOWER))) for key, text, *_ in rows]
    docs = [(key, len(t), Counter(t)) for key, t in docs if t]
    n, total = len(docs), sum(size for _, size, _ in docs)
    df = Counter(t for _, _, c in docs for t in c)
    out = Counter()
    for item, text, *_ in items:
        wanted = TERM.findall((text or "").translate(LOWER))
        found = []
        for key, size, terms in docs:
            m = 100 - 75 + (75 * size * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * terms[t] // (1000 * terms[t] + 8 * m))
                for t in wanted if terms[t]
            )
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(found)[:k], 1):
            out[(item, rank, key, -score)] += 1
    return out


ITEMS = "item_id long, text string, doc_id int, rank int, score string"


@pytest.fixture(scope="module")
def items(texts):
    rng = random.Random(9)
    said = [t for t in texts if t]
    out = [" ".join(rng.choice(said).split(" ")[:20]) for _ in range(50)]
    out += [None, "", "...", "absent words only", "the the THE The", texts[0], "ab ab ab", "é 漢字", said[-1]]
    return [(i, t, 1, 2, "x") for i, t in enumerate(out)] + [(0, texts[1], 1, 2, "x"), (None, texts[2], 1, 2, "x")]


@pytest.mark.parametrize(("k", "piece", "tree", "block"), [(10, 8192, 256, 1 << 21), (3, 7, 5, 200), (1, 50, 3, 1)])
def test_search_equals_brute_force(spark, docs, rows, items, empty, monkeypatch, k, piece, tree, block):
    monkeypatch.setattr(lexical_search, "PIECE_DOCS", piece)
    monkeypatch.setattr(lexical_search, "TREE_ITEMS", tree)
    monkeypatch.setattr(lexical_search, "PART", 3)
    asked = items if block > 1 else items[:6]
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", block)
    bench = spark.createDataFrame(asked, ITEMS)
    assert counted(lexical_search.best_documents(docs, bench, k)) == brute_search(rows, asked, k)
    if block == 1:
        return
    assert lexical_search.best_documents(empty, bench, k).collect() == []
    assert lexical_search.best_documents(docs, bench.limit(0), k).collect() == []


def test_bounds_prune_batches():
    rng = np.random.default_rng(3)
    # documents of 20 topics with terms of their own; items ask for one topic
    n, topics, width = 4000, 20, 30
    topic = rng.integers(0, topics, n)
    terms = np.sort(np.array([rng.choice(width, 6, replace=False) + t * width for t in topic]), axis=1)
    rows = lexical_search.Rows(np.arange(n + 1) * 6, terms.ravel(), rng.integers(1, 1000, n * 6))
    weight = rng.integers(1, 9000, topics * width)
    asked = np.sort(np.array([rng.choice(width, 5, replace=False) + t * width for t in range(topics)]), axis=1)
    tree = lexical_search.ItemTree(
        np.arange(topics), lexical_search.Rows(np.arange(topics + 1) * 5, asked.ravel(), np.ones(topics * 5, np.int64)), weight
    )
    search = lexical_search.Search(tree, 10, np.ones(topics, np.int64))
    order = rows.by_weightiest(weight)
    taken = rows.taken(order)
    spot = np.minimum(np.searchsorted(tree.terms, taken.terms), len(tree.terms) - 1)
    ours = tree.terms[spot] == taken.terms
    owner = np.repeat(np.arange(n), 6)
    starts = np.concatenate(([0], np.bincount(owner[ours], minlength=n).cumsum()))
    search.add_documents(lexical_search.Rows(starts, spot[ours], taken.values[ours]), order)
    dense = np.zeros((n, topics * width), np.int64)
    dense[np.repeat(np.arange(n), 6), terms.ravel()] = rows.values
    for key in range(topics):
        scores = dense[:, asked[key]] @ weight[asked[key]]
        best = np.lexsort((np.arange(n), -scores))[:10]
        mine = search.best.item == np.flatnonzero(tree.keys == key)[0]
        assert search.best.doc[mine].tolist() == best.tolist()
        assert search.best.score[mine].tolist() == scores[best].tolist()
    # bounds at all levels together are a small part of all pairs of an item and a document
    assert search.bounded < n * topics / 4


def test_queries_are_registered():
    assert {"op11_alignment", "op12_pieces", "op13_lexical"} <= queries.QUERIES.keys()
    assert "op13_lexical" in queries.ORACLES
