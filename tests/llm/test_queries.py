"""Registered queries against SQL or brute force on the smallest given tables."""

import collections
import hashlib
import math
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from murmuration.llm import queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name):
    return {r["doc_id"]: r for r in queries.REGISTRY[name](spark, SF).collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    shown = lambda v: f"{v:.6f}" if isinstance(v, float) else str(v)
    want = sorted(tuple(map(shown, r)) for r in cursor.fetchall())
    got = queries.REGISTRY[name](spark, SF).select(*names).collect()
    assert sorted(tuple(map(shown, r)) for r in got) == want and want


def test_packing_covers_every_id_once(spark, docs, bpe):
    tokenizer = Tokenizer.from_file(bpe)
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in queries.op2_packing(spark, SF).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text, *_ in docs:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        own = sorted(pieces[doc_id], key=lambda r: r.start)
        assert [r.start for r in own] == np.cumsum([0] + [r.length for r in own])[:-1].tolist()
        assert sum(r.length for r in own) == len(ids) == own[0].doc_tokens
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) <= 1024
    assert sum(n for p in sequences.values() for _, n in p) > 0.97 * 1024 * len(sequences)


def test_substrings_equal_brute_force(spark, docs):
    words = {d[0]: d[1].encode().split() for d in docs}
    times = collections.Counter(tuple(w[i : i + 35]) for w in words.values() for i in range(len(w) - 34))
    found = rows(spark, "op3_substring_dedup")
    for doc_id, w in words.items():
        gone = {j for i in range(len(w) - 34) if times[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        want = (len(w), len(gone), hashlib.sha256(kept).hexdigest())
        assert (found[doc_id].n_words, found[doc_id].n_removed, found[doc_id].kept_sha256) == want


def test_fingerprints_estimate_similarity(spark, docs):
    found = rows(spark, "op4_fingerprints")
    off = []
    for (doc_id, text, *_), (_, after, *_) in zip(docs, [*docs[1:], docs[0]], strict=True):
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = (collections.Counter(t.encode().lower().split()) for t in (text, edited))
        off.append(r.near_edited - sum((a & b).values()) / max(1, sum((a | b).values())))
    assert abs(np.mean(off)) < 0.02 and np.abs(off).mean() < 0.08


def test_simhash_components_equal_brute_force(spark, docs):
    prints = {d[0]: simhash.fingerprint_of(d[1]) for d in docs}
    group = {i: i for i in prints}
    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = {k: low if g == high else g for k, g in group.items()}
    for doc_id, r in rows(spark, "op5_simhash").items():
        assert (int(r.fingerprint, 16), r.component_id) == (prints[doc_id], group[doc_id]) and len(r.fingerprint) == 16


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{sf}/labels.parquet'").fetchall())
    found = queries.op6_toxicity(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in found)
    held = [(r.predicted, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert sum(p for p, y in held if y == 0) <= 2 and sum(p for p, y in held if y == 1) >= 0.5 * sum(y for _, y in held)


def test_token_files_are_in_order(spark, docs, bpe):
    tokenizer, at = Tokenizer.from_file(bpe), 0
    found = rows(spark, "op7_token_output")
    for doc_id, text, *_ in docs:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert tuple(found[doc_id]) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_shards_are_even_and_slots_gapless(spark, docs):
    found = rows(spark, "op8_sharding")
    shards = collections.defaultdict(list)
    for doc_id, text, *_ in docs:
        r = found[doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text.encode()) + 1, zlib.crc32(text.encode()), "bytes", None)
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(8))
    for some in shards.values():
        assert sorted(r.slot for r in some) == list(range(len(some)))
    sizes = [sum(r.size for r in some) for some in shards.values()]
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in found.values())


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns and clean.count() < docs.count()
    single = stages["simhash_near_dedup"](spark, docs, SF)
    leaders = [r for r in rows(spark, "op5_simhash").values() if r.component_id == r.doc_id]
    assert single.columns == docs.columns and {r.doc_id for r in single.collect()} == {r.doc_id for r in leaders}
    bare = stages["substring_dedup"](spark, docs, SF).collect()
    found = rows(spark, "op3_substring_dedup")
    assert len(bare) == docs.count() and bare[0].__fields__ == docs.columns
    for r in bare:
        assert hashlib.sha256(b" ".join(r.text.encode().split())).hexdigest() == found[r.doc_id].kept_sha256
        assert r.n_chars == len(r.text) or not found[r.doc_id].n_removed
    mixed = collections.Counter(r.doc_id for r in stages["mixing"](spark, docs, SF).collect())
    taken = rows(spark, "op10_mixing")
    assert all(mixed[i] == (r.taken // r.size if r.size else 0) for i, r in taken.items() if r.size)
    packed = corpus_pipeline.run(spark, SF).collect()
    assert packed and all(r.length <= 1024 for r in packed) and not math.isnan(packed[0].offset)
