"""Periodic runs, exact top-k search and cross-tokenizer alignment against brute force."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from murmuration.llm import alignment, periodic_runs, queries, tokens, topk_search

SF = "/root/testdata/sf0.001"


def runs_by_hand(words, least=12):
    best = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q) and j > i:
                best.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in best.items())


@given(st.lists(st.lists(st.integers(0, 2), max_size=40), max_size=3), st.integers(2, 14))
@settings(max_examples=200, deadline=None)
def test_runs_equal_brute_force(documents, least):
    flat = np.array([w + 10 * i for i, d in enumerate(documents) for w in d], np.int64)
    ends = np.repeat(np.cumsum([len(d) for d in documents], dtype=np.int64), [len(d) for d in documents]).astype(np.int64)
    want, at = [], 0
    for d in documents:
        want += [(a + at, n, q) for a, n, q in runs_by_hand(d, least)]
        at += len(d)
    assert list(map(tuple, periodic_runs.runs_of(flat, ends, least).tolist())) == want


def test_runs_of_periodic_texts():
    rnd = random.Random(5)
    for _ in range(300):
        p, n = rnd.randint(1, 9), rnd.randint(0, 80)
        words = [i % p if rnd.random() < 0.97 else 50 for i in range(n)]
        found = periodic_runs.runs_of(np.array(words, np.int64), np.full(n, n))
        assert list(map(tuple, found.tolist())) == runs_by_hand(words)


@pytest.mark.parametrize("words", [[0] * 50_000, [0] * 25_000 + [1] + [0] * 25_000, ([0] * 100 + [5]) * 500])
def test_very_periodic_texts_take_no_quadratic_work(words):
    found = periodic_runs.runs_of(np.array(words, np.int64), np.full(len(words), len(words)))
    assert len(found) < 2000


def test_awkward_runs(awkward, documents):
    assert periodic_runs.periodic_runs(awkward.where("false")).count() == 0
    found = periodic_runs.periodic_runs(awkward).collect()
    assert len(found) == 12 and all(r.n_words == 0 and r.collapsed == "" and r.runs == [] for r in found if r.doc_id in (1, 2, 3))
    one = periodic_runs.periodic_runs(documents([(3, "x " + "a b c d " * 5 + "y", "s")])).first()
    assert [tuple(r) for r in one.runs] == [(1, 20, 4)] and one.collapsed == "x a b c d y"
    row = periodic_runs.digests(periodic_runs.periodic_runs(documents([(3, "x " + "a b c d " * 5 + "y", "s")]))).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 1, 20, 4, 5000)
    assert row.runs_sha256 == hashlib.sha256(b"1,20,4\n").hexdigest()


def top_by_hand(rows, every, k=5):
    usable = [(n, i, [math.floor(256 * x) for x in v]) for n, (i, v) in enumerate(rows) if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, i, v in usable:
        if i is not None and i % every == 0:
            scored = [(-sum(a * b for a, b in zip(v, w, strict=False)), j is None, j or 0) for m, j, w in usable if m != n]
            out += [(i, r + 1, None if gone else j, min(max(-s, -(2**63)), 2**63 - 1)) for r, (s, gone, j) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def vectors(spark, rows, partitions=4):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(partitions)


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e17])
def test_search_equals_brute_force(spark, scale):
    rnd = random.Random(int(scale))
    rows = [(i, [rnd.choice([0.0, 0.0, rnd.gauss(0, 0.2)]) * scale for _ in range(8)]) for i in range(150)]
    rows += [(200 + i, rows[3][1]) for i in range(20)]  # ties
    rows += [(10, rows[7][1]), (10, rows[10][1]), (10, rows[10][1]), (None, rows[4][1]), (None, [1.0] * 8), (300, None), (310, []), (320, [0.5, None]), (330, [math.nan] * 8), (340, [math.inf]), (350, [9.0]), (360, [0.1] * 12)]
    found = topk_search.top_k(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect()), key=str) == top_by_hand(rows, 10)


def test_search_in_many_cells(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(6)]) for i in range(900)]
    for name, value in (("BLOCK", 50), ("GROUP", 30), ("ABREAST", 7), ("STRIPES", 5)):
        monkeypatch.setattr(topk_search, name, value)
    found = topk_search.top_k(vectors(spark, rows, 6), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect()), key=str) == top_by_hand(rows, 10)


def test_search_in_small_tables(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [2.0])], [(1, [1.0])], [(0, None)]):
        assert sorted(map(tuple, topk_search.top_k(vectors(spark, rows), F.col("vec_id") % 50 == 0).collect()), key=str) == top_by_hand(rows, 50)


def aligned_by_hand(rows):
    """Token by token, byte by byte."""
    first = Tokenizer.from_file(queries.BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=queries.PIECES)
    letters = {c: b for b, c in tokens.byte_letters().items()}
    seen, counts, out = {}, collections.Counter(), []
    for doc_id, text in rows:
        held = []
        if text:
            a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
            pieces = [(i, second.id_to_piece(i)) for i in second.encode(text)]
            b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]
            want = (" " + text).encode()
            if b"".join(x for _, x in a) == want == b"".join(x for _, x in b):
                held = [a, b]
        places = []
        for side in held:
            at = 0
            places.append([])
            for i, raw in side:
                places[-1].append((i, at, at + len(raw)))
                at += len(raw)
        links = [(i, j) for i, s, e in places[0] for j, t, u in places[1] if s < u and t < e] if held else []
        counts.update(set(links))
        seen[len(out)] = links
        groups = ""
        ends = sorted({e for _, _, e in places[0]} & {e for _, _, e in places[1]}) if held else []
        if held:
            cut = [[[i for i, _, e in side if x < e <= y] for side in places] for x, y in zip([0, *ends], ends, strict=False)]
            groups = ";".join("|".join(",".join(map(str, ids)) for ids in pair) for pair in cut)
        sizes = [len(x) for x in places] or [0, 0]
        out.append([doc_id, *sizes, len(ends), len(links), hashlib.sha256(groups.encode()).hexdigest() if held else ""])
    most = collections.defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    for k, row in enumerate(out):
        row[5:5] = [sum(counts[p] == most[p[0]] for p in seen[k]), sum(counts[p] for p in seen[k])]
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("part_pairs", [10, 1_000_000])
def test_alignment_equals_brute_force(documents, part_pairs):
    texts = [None, "", " ", "a", "same text twice", "same text twice", "trailing blank ", "  two  blanks", "▁ sign", "漢字かな 交じり文", "naïve café <|endoftext|> </s> <s> <0x41>", "x\ny\tz\r\n", "😀😀 ok", "the the the cat", "\x00odd\x7f", "ﬁ ™ Ⅷ"]
    rnd = random.Random(4)
    texts += ["".join(rnd.choice(["a", " ", "the ", "é", "漢", "\n", "word", ".", "1", "'s", "  "]) for _ in range(rnd.randint(1, 40))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (4, "same text twice")]
    found = alignment.alignment(documents([(i, t, "s") for i, t in rows]), queries.BPE, queries.PIECES, part_pairs)
    assert sorted(map(tuple, found.collect()), key=str) == aligned_by_hand(rows)


def test_alignment_of_small_and_long_texts(awkward, documents):
    assert alignment.alignment(awkward.where("false"), queries.BPE, queries.PIECES).count() == 0
    found = alignment.alignment(awkward, queries.BPE, queries.PIECES).collect()
    assert len(found) == 12 and {(r.n_a, r.groups_sha256) for r in found if r.doc_id in (1, 2)} == {(0, "")}


def test_parts_of_a_long_text_are_encoded_alike(monkeypatch):
    whole = alignment.PieceEncoder(queries.PIECES)
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(["a", " ", "  ", "the", "▁", "é", "\n", "漢字", " word"]) for _ in range(rnd.randint(0, 300))) for _ in range(300)]
    want = [whole.model.encode(t) for t in texts]
    monkeypatch.setattr(alignment, "PART_CHARS", 20)
    ids, counts = whole.encode(texts)
    assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))


def test_alignment_of_given_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' WHERE length(text) < 3000 ORDER BY doc_id LIMIT 60").fetchall()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = alignment.alignment(docs, queries.BPE, queries.PIECES, with_groups=True).drop("groups").collect()
    assert sorted(map(tuple, found), key=str) == aligned_by_hand(rows)


@given(st.lists(st.text(alphabet=st.sampled_from(" \t\n\r ab'sZé漢1.,!\x1c"), max_size=20) | st.lists(st.sampled_from(["<|endoftext|>", " ", "Word", "b,", "x.\n", "It", "\n\n", "..", "  ", "▁", "　"])).map("".join), max_size=5))
@settings(max_examples=300, deadline=None)
def test_cached_pieces_give_the_library_s_ids(texts):
    for special in (True, False):
        own, library = _encoders(special)
        ids, counts = own.encode(texts)
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))


def _encoders(special, made={}):  # noqa: B006
    if special not in made:
        library = Tokenizer.from_file(queries.BPE)
        if not special:
            library.encode_special_tokens = True
        made[special] = tokens.Encoder(queries.BPE, special), library
    return made[special]


def test_pieces_that_share_a_hash_are_noticed(monkeypatch):
    own = tokens.Encoder(queries.BPE)
    monkeypatch.setattr(tokens, "mixed", lambda x: x & np.uint64(6))
    texts = ["some words of one text", "and of another text", "漢字"]
    ids, counts = own.encode(texts)
    want = [Tokenizer.from_file(queries.BPE).encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 2000)
    own, library = tokens.Encoder(queries.BPE), Tokenizer.from_file(queries.BPE)
    for k in range(20):
        texts = [f"word{k * 7 + i} other{i}, and {'long' * 40}{i}" for i in range(20)]
        assert own.encode(texts)[0].tolist() == sum((library.encode(t, add_special_tokens=False).ids for t in texts), [])
