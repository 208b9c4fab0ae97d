"""Each operator against brute force on a small table with every awkward case."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievework.llm import (
    binary_records,
    chat,
    decontaminate,
    language,
    mixing,
    ngram_join,
    quality,
    suffix_dedup,
    topk,
    url_filter,
)
from sievework.llm.shingles import shingle_hashes, word_hashes

LETTERS = "abcdefghijklmnopqrstuvwxyz"
# columns with names that operators use themselves
DOCS = "doc_id long, text string, lang string, source string, score string, size int, key string, n int, a int, token int, copies string"


def sentence(rng, n, words=None):
    words = words or ["".join(rng.choices(LETTERS, k=rng.randint(2, 8))) for _ in range(200)]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [sentence(rng, rng.randint(6, 120)) for _ in range(30)]
    near = []
    for t in base[:8]:
        for _ in range(4):
            w = t.split(" ")
            w[rng.randrange(len(w))] = "changed"
            near.append(" ".join(w))
    passage = sentence(rng, 60)
    mixed = [f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}" for _ in range(12)]
    odd = [None, "", " ", "\n\t", "one", "one two three", "ONE two  three", "!!! ??? 123", "a" * 700, "ab " * 400,
           "é" * 300, "word " * 3000, "no\u00a0break  two  spaces \n x", passage, base[0], base[0], sentence(rng, 9000)]
    return base + near + mixed + odd


@pytest.fixture(scope="module")
def rows(texts):
    out = [(i, t, ["en", "fr", None][i % 3], ["s1", "S2", "é", None][i % 4]) for i, t in enumerate(texts)]
    out += [(None, texts[1], "en", "s1"), out[2], out[2]]
    return [(*r, "x", 1, "k", 2, 3, 4, "c") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words_of(text):
    lower = (text or "").translate(str.maketrans(LETTERS.upper(), LETTERS))
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles_of(text):
    w = words_of(text)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def key(row):
    return tuple((x is None, x) for x in row)


# --- shingles --------------------------------------------------------------------------------------


def test_word_hashes_depend_on_the_word_alone():
    long = b"x " * 400_000 + b"tail"
    [a, b, c, d] = word_hashes([b"One two", b"two\tONE", None, long])
    assert a.tolist() == b[::-1].tolist() and len(c) == 0 and len(d) == 400_001
    assert len(set(d.tolist())) == 2
    assert len(shingle_hashes(a)) == 1


# --- 1 ---------------------------------------------------------------------------------------------


def best_window(text, item):
    def weights(w):
        n = min(5, len(w))
        return Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))

    words, wanted = words_of(text), words_of(item)
    if not words or not wanted:
        return 0.0
    theirs, width = weights(wanted), min(len(wanted), len(words))
    found = 0.0
    for i in range(len(words) - width + 1):
        mine = weights(words[i : i + width])
        shared = sum((mine & theirs).values())
        found = max(found, shared / (mine.total() + theirs.total() - shared))
    return found


def test_leaks_equal_brute_force(spark, docs, rows, empty, monkeypatch):
    texts = [r[1] for r in rows]
    items = [(1, " ".join(texts[0].split(" ")[3:40])), (2, texts[5].upper()), (3, None), (4, ""), (5, "one two three"),
             (6, sentence(random.Random(9), 30)), (7, " ".join(texts[3].split(" ")[:20] + ["other", "words"]))]
    bench = spark.createDataFrame([(*i, "extra") for i in items], "item_id long, text string, similarity string")
    want = Counter(
        (r[0], i) for r in rows for i, t in items if t and best_window(r[1], t) >= 0.8
    )
    found = decontaminate.find_leaks(docs, bench)
    assert Counter((r["doc_id"], r["item_id"]) for r in found.collect()) == want
    kept = decontaminate.without_leaks(docs, bench)
    leaking = {d for d, _ in want}
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in rows if r[0] not in leaking)
    monkeypatch.setattr(decontaminate, "ITEM_BLOCK", 2)  # several blocks
    assert Counter((r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()) == want
    assert decontaminate.find_leaks(empty, bench).isEmpty()
    assert decontaminate.find_leaks(docs, bench.limit(0)).isEmpty()
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == len(rows)


def test_index_finds_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(1)
    bench = decontaminate.Benchmark([(i, sentence(random.Random(i), 20).encode()) for i in range(20)])
    far = []
    for item, print_ in enumerate(bench.prints):
        for n in range(0, decontaminate.RADIUS + 1, 3):
            bits = rng.choice(64, n, replace=False)
            flipped = np.uint64(int(print_) ^ sum(1 << int(b) for b in bits))
            _, found = bench.candidates(np.array([flipped]), 20)
            far.append(item in found)
    assert all(far)


def test_repeated_filler_stays_within_the_radius():
    rng = random.Random(5)
    for trial in range(40):
        words, level = (100, 120, 200, 270, 400)[trial % 5], (0.80, 0.85)[trial % 2]
        item = sentence(rng, words).split(" ")
        # the copy's tail is one repeated word, as long as the similarity allows
        tail = words - 4 - math.ceil(2 * (words - 4) * level / (1 + level))
        copy = " ".join(item[:-tail] + ["x"] * tail)
        for text, wanted in ((copy, " ".join(item)), (" ".join(item), copy)):
            assert level <= best_window(text, wanted) < level + 0.02
            [text_words] = word_hashes([f"{sentence(rng, 9)} {text} {sentence(rng, 9)}".encode()])
            assert decontaminate.Benchmark([(trial, wanted.encode())]).matches(text_words), (words, level)


def test_short_items_are_found_inside_long_texts():
    rng = random.Random(6)
    texts = [sentence(rng, 300), "One two three FOUR", "two", "three four", f"{sentence(rng, 40)} two three {sentence(rng, 40)} two three"]
    words = texts[0].split(" ")
    items = [(n, " ".join(words[150 : 150 + n])) for n in (1, 2, 3, 4, 5, 30)]
    items += [(41, "two"), (42, "two  Three"), (43, "two three"), (44, "one two three four"), (45, "four three")]
    bench = decontaminate.Benchmark([(i, t.encode()) for i, t in items])
    for text, hashes in zip(texts, word_hashes([t.encode() for t in texts])):
        found = bench.matches(hashes)
        assert sorted(m[0] for m in found) == sorted(i for i, t in items if best_window(text, t) >= 0.8)
        for i, start, n, similarity in found:
            item = dict(items)[i]
            assert n == len(words_of(item)) and similarity == best_window(" ".join(words_of(text)[start : start + n]), item) == 1
    [far] = word_hashes([texts[4].encode()])
    assert {m[0]: m[1] for m in bench.matches(far)} == {41: 40, 42: 40, 43: 40}


def test_fingerprints_are_those_of_sets_of_occurrences():
    rng = np.random.default_rng(2)
    shingles = rng.integers(0, 2**63, 12, dtype=np.uint64)[rng.integers(0, 12, 300)]
    for width in (1, 2, 7, 40, 300):
        starts = np.arange(len(shingles) - width + 1)
        alone = [decontaminate.fingerprints(shingles[s : s + width], width, np.zeros(1, np.int64))[0] for s in starts]
        assert decontaminate.fingerprints(shingles, width, starts).tolist() == alone
    gained, lost = decontaminate.occurrences(shingles, len(shingles))
    assert sorted(gained) == sorted(lost) and len(set(gained.tolist())) == len(shingles)


# --- 2 ---------------------------------------------------------------------------------------------


def test_languages_are_told_apart(spark, docs, empty):
    rng = random.Random(1)
    en, fr = ("the and of with there".split(), "les des été où très".split())
    made = [(i, sentence(rng, 60, (en, fr)[i % 2]), ("en", "fr")[i % 2]) for i in range(80)]
    frame = spark.createDataFrame(made, "doc_id long, text string, lang string")
    model = language.fit(frame, F.col("doc_id") < 40)
    assert model.languages == ["en", "fr"]
    found = {r["doc_id"]: r for r in language.predict_language(frame.drop("lang"), model).collect()}
    assert all(found[i]["lang_pred"] == lang and 0.5 < found[i]["score"] <= 1 for i, _, lang in made)
    judged = language.predict_language(docs, model)
    assert [c for c in docs.columns if c != "score"] == [c for c in judged.columns if c in docs.columns and c != "score"]
    for r in judged.collect():
        lettered = bool(r["text"]) and any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == (not lettered) and 0 <= r["score"] <= 1
    assert language.predict_language(empty, model).isEmpty()
    none = language.fit(empty, F.lit(True))
    assert {r["lang_pred"] for r in language.predict_language(docs, none).collect()} == {"und"}


def test_code_lengths_are_those_of_the_tree():
    """One byte at a time, with escapes, against the table."""
    texts = {"x": [b"abracadabra" * 5, b"abba"], "y": [b"banana bandana" * 4]}
    model = language.train(texts)
    size = model.size
    for name in texts:
        counts = defaultdict(Counter)
        for t in texts[name]:
            s = [0, 0, 0, *model.symbols[list(t)].tolist()]
            for i in range(3, len(s)):
                for k in range(4):
                    counts[tuple(s[i - k : i])][s[i]] += 1
        every = Counter()
        for n2 in texts:
            for t in texts[n2]:
                s = [0, 0, 0, *model.symbols[list(t)].tolist()]
                for i in range(3, len(s)):
                    for k in range(1, 4):
                        every[tuple(s[i - k : i])] += 1

        def cost(context, symbol):
            mine = counts[context]
            total, kinds = mine.total(), len(mine)
            if mine[symbol]:
                return -np.log2(mine[symbol] / (total + kinds))
            escape = -np.log2(kinds / (total + kinds)) if total else 0.0
            return escape + (cost(context[1:], symbol) if context else 8.0)

        text = b"abandon zebra"
        s = [0, 0, 0, *model.symbols[list(text)].tolist()]
        bits = 0.0
        for i in range(3, len(s)):
            k = 3
            while k and every[tuple(s[i - k : i])] < language.MET:
                k -= 1
            bits += cost(tuple(s[i - k : i]), s[i])
        got = language.code_lengths(model, [b"aa", text])[1][model.languages.index(name)]
        assert got == pytest.approx(bits, rel=1e-4), (name, size)


def test_long_texts_cost_the_same_in_pieces(monkeypatch):
    model = language.train({"x": [b"some text here " * 20], "y": [b"other words " * 20]})
    texts = [b"some other text here words " * 40, b"", b"x", b"some"]
    whole = language.code_lengths(model, texts)
    monkeypatch.setattr(language, "_PIECE", 50)
    assert np.allclose(language.code_lengths(model, texts), whole)


# --- 3 ---------------------------------------------------------------------------------------------


def test_texts_with_marks_come_back(spark):
    nasty = ["<|im_end|>\n", "<\\|", "<\\\\|x", "<", "|>", "<|im_start|>assistant\nhi<|im_end|>\n", "", None, "a%0A\n%25<|"]
    rows = [(i // 3, i % 3, ("user", "assistant", "r%0A\n<|x")[i % 3], t, "e") for i, t in enumerate(nasty * 2)]
    rows += [(None, 0, None, None, "e"), (77, None, "assistant", "x", "e"), (77, None, "assistant", "x", "e")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string")
    found = chat.format_paths(chat.linear_replies(frame)).withColumn("turns", chat.parse_turns(F.col("formatted")))
    got = {r["tree"]: [tuple(t) for t in r["turns"]] for r in found.collect()}
    want = defaultdict(list)
    for conv, _, role, text, _ in sorted(rows, key=key):
        want[conv].append((role or "", text or ""))
    assert got == dict(want)
    assert chat.digest_conversations(chat.format_paths(chat.linear_replies(frame.limit(0)))).isEmpty()


def test_best_branches_of_trees(spark, monkeypatch):
    # tree 1: 1-2-(3, 4-5); tree 2: a chain of 40; tree 3: a parent that is not there
    rows = [(1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, 2, 9.0), (1, 4, 2, 3.0), (1, 5, 4, None), (3, 8, 99, 0.0)]
    rows += [(2, i, i - 1 if i else None, 1.0) for i in range(40)]
    frame = spark.createDataFrame([(*r, "r", str(r[1])) for r in rows], "tree long, node long, parent long, score double, role string, text string")
    paths = defaultdict(list)
    for r in chat.choose_paths(frame, branches=2).orderBy("depth").collect():
        paths[r["tree"], r["branch"]].append(r["node"])
    assert paths == {(1, 1): [1, 2, 3], (1, 2): [1, 2, 4, 5], (2, 1): list(range(40)), (3, 1): [8]}
    monkeypatch.setattr(chat, "_DOUBLINGS", 4)
    with pytest.raises(ValueError, match="cycle"):
        chat.choose_paths(spark.createDataFrame([(1, 1, 2, 1.0), (1, 2, 1, 1.0)], "tree long, node long, parent long, score double"))


# --- 4 ---------------------------------------------------------------------------------------------


def repeats_by_force(texts):
    counts = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if counts[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate(([0], gone.astype(int)))) == 1))
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("common", ["few", "all"])
def test_repeats_equal_brute_force(spark, docs, rows, empty, monkeypatch, common):
    if common == "all":  # every anchor that two texts share counts as very common
        monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 2)
        monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 0.0)
        monkeypatch.setattr(suffix_dedup, "BROADCAST_KEYS", 0)
    want = Counter((r[0], *w) for r, w in zip(rows, repeats_by_force([(r[1] or "").encode() for r in rows])))
    assert Counter(tuple(r) for r in suffix_dedup.remove_repeats(docs).collect()) == want
    if common == "few":
        assert suffix_dedup.remove_repeats(empty).isEmpty()


def test_large_groups_of_contexts_equal_brute_force(spark):
    rng = random.Random(5)
    core = "".join(rng.choices(LETTERS, k=150))
    left, right = ["".join(rng.choices("xy", k=60)) for _ in range(3)], ["".join(rng.choices("zw", k=60)) for _ in range(4)]
    texts = [f"{rng.choice(left)[-rng.randint(0, 60):]}{core}{rng.choice(right)[:rng.randint(0, 60)]}" for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = {i: w for i, w in enumerate(repeats_by_force([t.encode() for t in texts]))}
    assert {r[0]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(frame).collect()} == want


def test_pieces_of_a_long_text_have_all_windows(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    text = sentence(random.Random(2), 900).encode()
    starts = []
    for pair in suffix_dedup._entries([(5, text), (6, text[:199]), (7, text[:450])], np.zeros(0, np.uint64)):
        starts += [(int(e["key"]), p) for e in pair[0] for p in range(int(e["start"]), int(e["start"]) + int(e["n"]))]
    assert sorted(starts) == [(5, i) for i in range(len(text) - 199)] + [(7, i) for i in range(251)]


def test_merge_of_front_coded_runs():
    rng = random.Random(4)
    runs = []
    for _ in range(7):
        zs = sorted("".join(rng.choices("ab", k=rng.randint(0, 12))).encode() for _ in range(rng.randint(1, 40)))
        runs.append([(z, len(z), 1, 2, i, 0) for i, z in enumerate(zs)])
    merged = list(suffix_dedup.merge_runs([suffix_dedup.Run(suffix_dedup.encode_run(r)) for r in runs]))
    assert [z for z, _, _ in merged] == sorted(z for r in runs for z, *_ in r)
    for (x, _, _), (y, _, shared) in zip(merged, merged[1:]):
        assert shared == suffix_dedup._shared_prefix(x, y)


# --- 5 ---------------------------------------------------------------------------------------------


def test_records_equal_plain_encoding(spark, docs, rows, empty, tmp_path):
    content = binary_records.tokenizer_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain = Tokenizer.from_str(content)
    manifest = binary_records.write_records(docs, str(tmp_path / "r"), content, parts=3, file_bytes=4000)
    assert manifest.count() > 3
    got = sorted((tuple(r) for r in binary_records.read_records(manifest).collect()), key=lambda r: r[1])
    want, at = [], 0
    # rows of one id lie by the hash of their text
    hashes = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    for r in sorted(rows, key=lambda r: (r[0] if r[0] is not None else -(2**63), hashes[r[1]], r[1] or "")):
        ids = plain.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.append((r[0], at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    uri = manifest.filter("records > 1").first()["file"]
    every = list(binary_records.read_frames(uri))
    back = list(binary_records.read_frames(uri, np.arange(len(every))[::-1]))
    assert [(k, v.tolist()) for k, v in back] == [(k, v.tolist()) for k, v in every[::-1]]
    none = binary_records.write_records(empty, str(tmp_path / "e"), content)
    assert binary_records.read_records(none).isEmpty()


def test_parts_keep_every_boundary():
    content = binary_records.tokenizer_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain, mine = Tokenizer.from_str(content), binary_records.Encoder(content, None)
    rng = random.Random(8)
    signs = [" ", "  ", "\n", "\t", "a", "B1", "'s", "é", "\u00a0", "\u3000", "\u2028", "\x1c", "\x85", "漢字", "!?", "<|endoftext|>",
             "\r\n", "endoftext", "|>", "<|", "ing,", "can't", "_", "²", "\u0301"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 12))) for _ in range(6000)]
    for text in texts:
        ids = np.frombuffer(mine(text), mine.dtype).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_long_lines_and_many_lines_are_encoded():
    content = binary_records.tokenizer_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain, mine = Tokenizer.from_str(content), binary_records.Encoder(content, None)
    rng = random.Random(9)
    lines = ["".join(rng.choices(LETTERS, k=rng.randint(1, 6))) for _ in range(100_000)]
    texts = ["\n".join(lines), "".join(rng.choices("abcdé", k=1_000_000)), "\n" * 5000, "a,\n" * 5000]
    for text in texts:
        assert np.frombuffer(mine(text), mine.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_record_folders_carry_the_scheme_of_the_session(spark, tmp_path):
    assert binary_records.qualified(spark, str(tmp_path)).startswith("file:/")
    assert binary_records.qualified(spark, "file:///some/where") == "file:/some/where"


def test_damaged_frames_are_noticed():
    data = binary_records.frame(b"payload") + binary_records.frame(b"")
    first, at = binary_records.payload_of(data)
    assert first == b"payload" and binary_records.payload_of(data, at) == (b"", len(data))
    for i in range(len(data) - 16):
        broken = bytearray(data)
        broken[i] ^= 1
        with pytest.raises(ValueError):
            binary_records.payload_of(bytes(broken))
    with pytest.raises(ValueError):
        binary_records.payload_of(data[: at - 1])


# --- 6 ---------------------------------------------------------------------------------------------


def shares_by_force(sizes, most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: most * sizes[s] for s in above}


def test_mix_meets_its_targets(spark, docs, rows, empty):
    found = mixing.mix(docs)
    assert set(docs.columns) | {"source_size", "target"} == set(found.columns)
    got = found.collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=key) == sorted(map(tuple, mixing.mix(docs).collect()), key=key)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words_of(r[1]))
    want, taken = shares_by_force(dict(sizes)), Counter()
    for r in got:
        assert r["size"] == len(words_of(r["text"])) and 0 <= r["copies"] <= 3
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["size"] * r["copies"]
    for s, t in want.items():
        largest = max(len(words_of(r[1])) for r in rows if r[3] == s)
        assert abs(taken[s] - t) <= max(0.02 * t, largest / 2), (s, taken[s], t)
    assert mixing.mix(empty).isEmpty()


def test_targets_and_copies_of_uneven_sources(spark):
    rng = random.Random(6)
    made = [(i, " ".join(["w"] * rng.choice([3, 50, 400])), rng.choice("aaaaaaaaabcd")) for i in range(1500)]
    made += [(5000 + i, " ".join(["w"] * 50), "a") for i in range(2000)]  # one class of very many
    frame = spark.createDataFrame(made, "doc_id long, text string, source string")
    sizes, taken = Counter(), Counter()
    for r in mixing.mix(frame).collect():
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
    for s, t in shares_by_force(dict(sizes)).items():
        assert abs(taken[s] - t) <= 0.005 * t + 3, (s, taken[s], t)


# --- 7 ---------------------------------------------------------------------------------------------


def test_targets_of_many_sources_need_no_single_task(spark, monkeypatch):
    rng = random.Random(8)
    sizes = {f"s{i}": rng.choice([0, 1, 5, 5, 70, 900]) for i in range(3000)} | {None: 40, "é": 3}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    plain, most_rows = mixing.written, []

    def watched(df, name):
        table = plain(df, name)
        if name == "mix-ranges":
            most_rows.append(max([r["count"] for r in table.groupBy("_range").count().collect()] or [0]))
        return table

    monkeypatch.setattr(mixing, "written", watched)
    found = mixing.source_targets(frame)
    want = shares_by_force(sizes)
    got = {r["source"]: r for r in found.collect()}
    assert len(got) == len(want) == found.count()
    assert all(got[s]["source_size"] == n and got[s]["target"] == pytest.approx(want[s]) for s, n in sizes.items())
    assert len(most_rows) == 2 and max(most_rows) < len(sizes) / 2
    assert mixing.source_targets(frame.limit(0)).isEmpty()


def test_rules_tell_quality(spark, docs, empty):
    rng = random.Random(2)
    made, marks = [], []
    for i in range(600):
        text = sentence(rng, 40)
        if i % 3 == 0:
            text = text.upper() + " !!" if i % 2 else " | ".join(text.split(" "))
        made.append((i, text))
        marks.append((i, int(i % 3 != 0), 0))
    frame = spark.createDataFrame(made, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    x, y = quality.training_sample(frame, labels, F.col("doc_id") < 300)
    assert x.shape == (300, len(quality.STATISTICS))
    rules = quality.learn(x, y)
    assert 0 < len(rules.weights) < 60
    scored = quality.score_quality(frame, rules).collect()
    right = [r["predicted"] == int(r["doc_id"] % 3 != 0) for r in scored if r["doc_id"] >= 300]
    assert np.mean(right) > 0.97
    # the column expression says what the rules say
    measured = quality.statistics([t.encode() for _, t in made])
    margin = rules.base + sum(w * quality._applies(c, measured) for c, w in zip(rules.conditions, rules.weights))
    want = 1 / (1 + np.exp(-margin))
    assert np.allclose([r["score"] for r in sorted(scored, key=lambda r: r["doc_id"])], want)
    odd = quality.score_quality(docs, rules)
    assert set(odd.columns) == {*docs.columns, "predicted"}
    assert all(0 <= r["score"] <= 1 for r in odd.collect())
    assert quality.score_quality(empty, rules).isEmpty()
    x, y = quality.training_sample(empty, labels, F.lit(True))
    assert {r["score"] for r in quality.score_quality(docs, quality.learn(x, y)).collect()} == {0.5}


# --- 8 ---------------------------------------------------------------------------------------------


def judged_by_force(url, rules):
    at = (url or "").find("://")
    rest = url[at + 3 :] if at >= 0 else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(str.maketrans(LETTERS.upper(), LETTERS))
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.verdict if best else "allow"


def test_urls_equal_brute_force(spark):
    rng = random.Random(3)
    rules = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
             url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/")]
    rules += [url_filter.Rule("block", f"h{i}.org", "/") for i in range(0, 60, 2)]
    hosts = ["example.com", "WWW.Example.com", "a.b.example.com", "com", "xcom", "x.net", "net", ".com", "a..com", ""]
    hosts += [f"{p}h{i}.org" for i in range(60) for p in ("", "w.")]
    urls = [f"{rng.choice(['http', 'https', ''])}://{h}{rng.choice(['', '/', '/en/', '/en', '/es/x?y#z', '#/en/', '?q', '/en/a b'])}" for h in hosts for _ in range(3)]
    urls += [None, "", "no scheme", "http:/x.com/", "a://b://c.com/", "://x.com/en/"] + urls[:5]
    frame = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: tuple(r)[-4:] for r in url_filter.judge_urls(frame, rules).select("page_id", "host", "path", "rule", "verdict").collect()}
    assert got == {i: judged_by_force(u, rules) for i, u in enumerate(urls)}
    assert url_filter.judge_urls(frame.limit(0), rules).isEmpty()
    assert {r["verdict"] for r in url_filter.judge_urls(frame, [], default="block").collect()} == {"block"}


# --- 9 ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize(("k", "slices", "block"), [(5, 2, 8192), (3, 4, 7)])
def test_top_k_equals_brute_force(spark, k, slices, block):
    rng = random.Random(1)
    made = [(i, [rng.randint(-4, 4) / 4 for _ in range(6)]) for i in range(120)]
    made += [(200 + i, [0.5] * 6) for i in range(30)] + [(300, None), (301, [None] * 6), (302, [float("nan")] * 6),
             (303, [float("inf"), 0.0]), (304, [0.25]), (305, []), (None, [1.0] * 6), made[0], made[0], (400, [1e14] * 6)]
    frame = spark.createDataFrame([(*m, 1) for m in made], "vec_id long, embedding array<double>, score int")
    scaled = frame.withColumn("embedding", topk.scaled(F.col("embedding")))
    found = topk.exact_top_k(scaled, scaled.filter("vec_id % 20 = 0"), k, slices, block=block)
    ints = {i: [int(np.floor(x * 64)) for x in v] for i, v in made if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in ints if i % 20 == 0):
        scores = sorted((-max(min(sum(a * b for a, b in zip(ints[q], v)), 2**63 - 1), 1 - 2**63), i) for i, v in ints.items() if i != q)
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect()]
    assert len(got) == len(want) and set(got) == want
    assert topk.exact_top_k(scaled.limit(0), scaled.limit(0)).isEmpty()


# --- 10 --------------------------------------------------------------------------------------------


def components_by_force(rows):
    sets = [shingles_of(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and 100 * shared >= 80 * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)].append(r[0])
    return Counter((r[0], len(sets[i]), min(least[root(i)], default=None)) for i, r in enumerate(rows))


@pytest.mark.parametrize("group", [2000, 2])
def test_components_equal_brute_force(spark, docs, rows, empty, monkeypatch, group):
    monkeypatch.setattr(ngram_join, "GROUP", group)
    monkeypatch.setattr(ngram_join, "PIVOTS", 64 if group > 2 else 2)
    if group == 2:
        monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
        monkeypatch.setattr(ngram_join, "HOT_LEAST", 3)
    got = Counter(tuple(r) for r in ngram_join.similar_documents(docs).collect())
    assert got == components_by_force(rows)
    if group > 2:
        assert ngram_join.similar_documents(empty).isEmpty()


def test_trie_finds_every_partner():
    rng = random.Random(7)
    base = [rng.sample(range(60), rng.randint(1, 30)) for _ in range(12)]
    sets = []
    for b in base:
        for _ in range(6):
            sets.append(np.array(sorted({*rng.sample(b, max(1, len(b) - rng.randint(0, 3))), *rng.sample(range(60), rng.randint(0, 2))}), np.uint64))
    ranks = ngram_join._Ranks(sets)
    trie = ngram_join.Trie([ranks.of(s) for s in sets])
    for s in sets:
        near = set(trie.partners(ranks.flags(ranks.of(s)), len(s)))
        linked = lambda t: 100 * len({*s.tolist()} & {*t.tolist()}) >= 80 * len({*s.tolist()} | {*t.tolist()})  # noqa: E731,B023
        assert near == {j for j, t in enumerate(sets) if linked(t)}


def test_large_groups_are_connected_alike(monkeypatch):
    monkeypatch.setattr(ngram_join, "PIVOTS", 3)
    rng = random.Random(2)
    for _ in range(30):
        base = [rng.sample(range(90), 30) for _ in range(3)]
        sets = []
        for _ in range(40):
            b = rng.choice(base)
            sets.append(np.array(sorted({*rng.sample(b, len(b) - rng.randint(0, 7)), *rng.sample(range(90), rng.randint(0, 2))}), np.uint64))

        def parts(links):
            parent: dict[int, int] = {}
            for i, j in links:
                parent[ngram_join._root(parent, i)] = ngram_join._root(parent, j)
            least: dict[int, int] = {}
            for i in range(len(sets)):
                least.setdefault(ngram_join._root(parent, i), i)
            return [least[ngram_join._root(parent, i)] for i in range(len(sets))]  # noqa: B023

        assert parts(ngram_join.joined_group(sets)) == parts(ngram_join.joined(sets))


def test_rounds_of_a_large_group_do_not_follow_its_size(spark, monkeypatch):
    # unlike texts chained by a common passage are one group; only a bounded number of tables is written for it
    monkeypatch.setattr(ngram_join, "GROUP", 20)
    monkeypatch.setattr(ngram_join, "PIVOTS", 4)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 500)
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(40)])) for i in range(90)]
    for i in range(60):  # near copies, some of them beyond the limit
        words = rows[i % 6][1].split()
        for at in rng.sample(range(len(words)), rng.randrange(4)):
            words[at] = "other"
        rows.append((100 + i, " ".join(words)))
    counted = Counter()
    plain = ngram_join.written

    def counting(df, name, **options):
        counted[name] += 1
        return plain(df, name, **options)

    monkeypatch.setattr(ngram_join, "written", counting)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in ngram_join.similar_documents(docs).collect()) == components_by_force(rows)
    assert counted["large-groups"] == counted["pivots"] == counted["open-links"] == 1


def test_rarest_shingles_leave_every_partner_and_few_others():
    rng = random.Random(13)
    base = rng.sample(range(1000), 200)
    sets = []
    for i in range(300):
        own = {*rng.sample(base, len(base) - rng.randint(0, 60)), *range(1000 + 60 * i, 1000 + 60 * i + rng.randint(0, 60))}
        sets.append(np.array(sorted(own), np.uint64))
    ranks = ngram_join._Ranks(sets)
    own = [ranks.of(s) for s in sets]
    trie, lists = ngram_join.Trie(own), ngram_join._Lists(own, len(ranks.kinds))
    kept = linked = 0
    for known, s in zip(own, sets):
        possible = lists.possible(known, len(s))
        near = set(trie.partners(ranks.flags(known), len(s)))
        assert near <= set(possible.tolist())
        assert set(trie.partners(ranks.flags(known), len(s), possible)) == near
        kept, linked = kept + len(possible), linked + len(near)
    assert 0 < linked < len(sets) ** 2 / 4
    assert kept - linked < (len(sets) ** 2 - linked) / 4


def test_prefixes_of_linked_sets_share_what_is_promised():
    rng = np.random.default_rng(3)
    hot = np.sort(rng.choice(400, 30, replace=False).astype(np.uint64))
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        x = set(rng.choice(400, n, replace=False).tolist())
        y = set(list(x)[rng.integers(0, n // 5 + 1) :]) | set(rng.choice(400, int(rng.integers(0, n // 8 + 1))).tolist())
        if 100 * len(x & y) < 80 * len(x | y):
            continue
        px, py = (set(ngram_join.prefix(np.array(sorted(s), np.uint64), hot).tolist()) for s in (x, y))
        assert len(px & py) >= max(ngram_join.promised(len(x)), ngram_join.promised(len(y)))


# --- columns of any name ---------------------------------------------------------------------------


def test_working_names_may_be_columns(spark):
    rows = [(i, f"some words number {i} " * 3, f"http://a{i % 3}.com/x", "s", 7, 8, 9, "k", 10, "t") for i in range(6)]
    schema = "doc_id long, text string, url string, source string, _source int, _size int, _draw int, _keys string, _at int, _text string"
    docs = spark.createDataFrame(rows, schema)
    given = Counter(tuple(r) for r in docs.collect())
    mixed = mixing.mix(docs)
    judged = url_filter.judge_urls(docs, [url_filter.Rule("block", "a1.com", "/")])
    measured = quality.with_statistics(docs)
    for out in (mixed, judged, measured):
        assert Counter(tuple(r) for r in out.select(*docs.columns).collect()) == given
    # and they may be the columns that count
    assert {r["size"] for r in mixing.mix(docs.drop("source").withColumnRenamed("_text", "x"), source="_source").collect()} == {12}
    assert quality.with_statistics(docs.drop("text"), text="_text").count() == 6
    assert judged.filter("verdict = 'block'").count() == 2


def test_a_dual_that_is_not_solved_is_noticed(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "_STEPS", 0)
    with pytest.raises(mixing.NotConverged):
        mixing.mix(docs)
