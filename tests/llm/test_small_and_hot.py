"""Small tables, hot groups, and rules written out by hand."""

import collections
import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

import corpus_pipeline
from murmuration.llm import fingerprints, mixing, quality_rules, sharding, simhash, substring_dedup, toxicity


def fingerprint_by_hand(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def components_by_hand(rows):
    prints = [fingerprint_by_hand(t) for _, t, *_ in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and group[i] != group[j]:
                low, high = sorted((group[i], group[j]))
                group = [low if g == high else g for g in group]
    least = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group}
    return sorted(((rows[k][0], prints[k], least[group[k]]) for k in range(len(rows))), key=str)


DIFFERENT = [(i, f"a text of its own {i * i} about number {i} and {7 * i}", "a") for i in range(20)]


MIXED = DIFFERENT + [(30, "Same Words here", "a"), (31, "same words here", "b"), (32, "", "c"), (None, "same words here", "a")]


@pytest.mark.parametrize(("rows", "partitions"), [(DIFFERENT[:1], 1), (DIFFERENT[:2], 1), (DIFFERENT, 40), ([(i, "equal texts", "a") for i in range(6)], 3), ([(0, None, None)], 1), (MIXED, 40)])
def test_simhash_of_few_documents(documents, rows, partitions):
    docs = documents(rows, partitions)
    found = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(found, key=str) == components_by_hand(rows)
    kept = simhash.one_per_component(docs.selectExpr("*", "1 AS _b_fp", "2 AS _b_id", "3 AS _fp", "4 AS _nth")).collect()
    assert len(kept) == len({c for *_, c in components_by_hand(rows)})


def test_fingerprints_within_the_radius_share_a_shard():
    rng = np.random.default_rng(3)
    for radius in (0, 1, 3):
        masks = [m & (1 << 64) - 1 for m in simhash.choices(radius)]
        for _ in range(300):
            a = int(rng.integers(0, 1 << 63))
            b = a
            for bit in rng.choice(64, radius, replace=False).tolist():
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)
    assert len(masks) == 20 and all(m.bit_count() >= 30 for m in masks)


def thue_morse(n, flip):
    return "".join("ab"[(i.bit_count() + flip) % 2] for i in range(n))


def test_words_of_one_pattern_are_told_apart(documents):
    common = " ".join(f"w{i}" for i in range(34))
    rows = [(i, f"{common} {thue_morse(1024, i)}", "a") for i in range(2)]
    assert [r.n_removed for r in substring_dedup.remove_repeats(documents(rows)).collect()] == [0, 0]
    prints = fingerprints.Sampler(fingerprints.SAMPLES).fingerprints([thue_morse(1024, 0), thue_morse(1024, 1)])
    assert (prints[0] != prints[1]).mean() > 0.5


def test_a_hot_header_is_counted_in_many_groups(documents):
    """A run of 20 words in every document is in windows of any tail; none of these repeats."""
    header = " ".join(f"h{i}" for i in range(20))
    rows = [(i, header + " " + " ".join(f"d{i}x{j}" for j in range(60)), "a") for i in range(300)]
    rows += [(1000 + i, header + " " + " ".join(f"same{j}" for j in range(15)) + f" end{i}", "a") for i in range(2)]
    found = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(documents(rows, 5)).collect()}
    assert {found[i] for i in range(300)} == {0} and found[1000] == found[1001] == 35


@pytest.mark.parametrize("size", [60, 1500])
def test_a_verdict_does_not_get_better_as_its_host_grows(documents, size):
    own = [" ".join(f"{'abcdefgh'[i % 8]}{'xyzuvw'[i // 8 % 6]}{chr(97 + j % 26)}{'q' * (1 + j // 26)}{chr(97 + i // 48 % 26)}" for j in range(60)) for i in range(size)]
    common = " ".join(f"menu{chr(97 + j % 26)}{'k' * (1 + j // 26)}" for j in range(70))
    rows = [(i, f"{own[i]}{i}\n{common}" if i < 30 else f"{own[i]}{i}", "host") for i in range(size)]
    found = {r.doc_id: r.kept for r in quality_rules.judge(documents(rows)).collect()}
    assert not any(found[i] for i in range(30)) and all(found[i] for i in range(30, size))


def test_a_copied_document_is_no_boilerplate(documents):
    text = " ".join(f"word{chr(97 + j % 26)}{'m' * (j // 26)}" for j in range(70))
    assert all(r.kept for r in quality_rules.judge(documents([(i, text, "host") for i in range(50)])).collect())


def test_equal_rows_without_id_are_divided(documents):
    rows = [(i, f"text number {i} " * 10, "a") for i in range(800)] + [(None, "the same text " * 13, "a")] * 400
    found = sharding.shard(documents(rows, 6)).collect()
    sizes = [sum(r.size for r in found if r.shard == s) for s in range(8)]
    assert max(sizes) < 1.05 * sum(sizes) / 8
    for s in range(8):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_shards_behind_a_heavy_range_get_their_share():
    owner = sharding.owners([5] * 10 + [1000] + [5] * 70, 8)
    sizes = [sum(b for b, s in zip([5] * 10 + [1000] + [5] * 70, owner, strict=True) if s == k) for k in range(8)]
    assert owner == sorted(owner) and min(sizes) >= 45 and max(sizes) <= 1050


def test_placement_follows_from_the_borders(documents):
    """Order rows by their key, cut at equal shares: with a range per key the operator does the same."""
    rows = [(i, f"text {i} " * (1 + i % 9), "a") for i in range(400)]
    docs = documents(rows)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("h"), (F.octet_length("text") + 1).cast("long").alias("size")).collect()
    order = sorted(keyed, key=lambda r: r.h)
    owner = sharding.owners([r["size"] for r in order], 8)
    found = {r.doc_id: r.shard for r in sharding.shard(docs).collect()}
    assert sum(found[r.doc_id] == s for r, s in zip(order, owner, strict=True)) >= 392


def inclusion_by_hand(sizes, rest):
    merit = {n: n.bit_length() for n in sizes}
    certain = set()
    while True:
        left = rest - sum(n for n in sizes if merit[n] in certain)
        factor = left / sum(n * merit[n] for n in sizes if merit[n] not in certain)
        over = {merit[n] for n in sizes if merit[n] not in certain and factor * merit[n] > 1}
        if not over:
            return {n: 1.0 if merit[n] in certain else factor * merit[n] for n in sizes}
        certain.add(max(over))


def test_longer_documents_are_drawn_more_often(documents):
    sizes = [1 + (37 * i) % 100 for i in range(300)]
    docs = documents([(i, "w " * n, "a" if i < 250 else "b") for i, n in enumerate(sizes)]).cache()
    times, runs = collections.Counter(), 10
    for seed in range(runs):
        found = mixing.mix(docs, weights=(1, 1), seed=f"s{seed}").collect()
        whole = min(r.copies for r in found if r.source == "a")
        for r in found:
            times[r["size"]] += r.copies - whole if r.source == "a" else 0
        drawn = {r.source: (sum(x.taken for x in found if x.source == r.source), r.target) for r in found}
        assert all(abs(got - want) <= 50 for got, want in drawn.values())
    own = [n for i, n in enumerate(sizes) if i < 250]
    many = collections.Counter(own)
    total = sum(sizes)
    target = min(3 * sum(own), max(total / 2, total - 3 * (total - sum(own))))
    want = inclusion_by_hand(own, target % sum(own))
    by_class = lambda f: {k: sum(f(n) for n in many if n.bit_length() == k) / sum(many[n] for n in many if n.bit_length() == k) for k in {n.bit_length() for n in many}}
    expected, seen = by_class(lambda n: want[n] * many[n]), by_class(lambda n: _drawn(found, times, n, runs))
    for k in expected:
        n = sum(many[x] for x in many if x.bit_length() == k) * runs
        assert abs(seen[k] - expected[k]) < 0.03 + 4 * math.sqrt(expected[k] * (1 - expected[k]) / n)
    assert seen[7] > seen[4] > seen[2]


def _drawn(found, times, size, runs):
    return times[size] / runs


def test_copies_keep_every_text(documents):
    rows = [(1, "one two three", "a"), (1, "four five six", "a"), (1, "four five six", "a"), (2, "seven", "b"), (None, "eight nine", None)]
    docs = documents(rows).selectExpr("*", "1 AS _t_key", "2 AS _t_rows", "3 AS _key", "4 AS _copy", "5 AS _digest")
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    copies = collections.Counter(r.text for r in found.collect())
    assert sum(len(t.split()) * n for t, n in copies.items()) == sum(r.taken for r in mixing.mix(docs).collect())
    assert sorted(found.collect(), key=str) == sorted(mixing.mixed_documents(docs.repartition(7)).collect(), key=str)


def test_located_sentences_in_the_result(documents, spark):
    rows = [(i, f"The lamp number {i} is on. You are a vileword{i % 2} person!\nBye.", "a") for i in range(60)]
    rows += [(100 + i, f"The lamp number {i} is on. You are a kind person.", "a") for i in range(60)]
    docs = documents([*rows, (900, None, "a"), (901, "", "a"), (902, "All is well. " * 20_000 + "You are a vileword1 person.", "a")])
    known = spark.createDataFrame([(i, int(i < 100)) for i, *_ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    found = {r.doc_id: r for r in toxicity.score_documents(docs, model).collect()}
    for i, text, _ in rows:
        told = [text[s.start : s.end].strip() for s in found[i].offending]
        assert told == ([f"You are a vileword{i % 2} person"] if i < 100 else [])
    assert found[900].offending == found[901].offending == [] and [s.start for s in found[902].offending] == [260_000 - 1]
    # noisy-or by hand, sentence by sentence, against the bias
    weights = dict(zip(model.places.tolist(), model.values.tolist(), strict=True))
    for i, text, _ in rows[::7]:
        none = 1.0
        for a, b in toxicity.sentences(text):
            z = sum(weights.get(f, 0.0) for w in text[a:b].lower().split() for f in toxicity.word_features(w))
            none *= (1 - 1 / (1 + math.exp(-(model.bias + z)))) / (1 - 1 / (1 + math.exp(-model.bias)))
        assert found[i].score == pytest.approx(1 - none, abs=1e-6)


def test_stages_on_awkward_empty_and_single_rows(awkward, spark, tmp_path):
    plain = awkward.select("doc_id", "text", "lang", "source", "n_chars")
    spark.createDataFrame([(4, 1), (7, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for k, docs in enumerate((plain, plain.where("false"), plain.where("doc_id = 7"), plain.where("doc_id = 1"))):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, str(tmp_path))
            assert name == "packing" or found.columns == docs.columns
            assert found.count() == 0 if k == 1 else found.count() >= 0
        docs.write.parquet(f"{tmp_path}/{k}/documents.parquet")
        spark.createDataFrame([(4, 1), (7, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/{k}/labels.parquet")
        packed = corpus_pipeline.run(spark, f"{tmp_path}/{k}")
        assert packed.count() >= (0 if k == 1 else 1)


def order_of(doc_id, h):
    return (doc_id is not None, doc_id or 0, h)


@pytest.mark.parametrize("shape", ["clusters", "hot id", "no ids", "wide", "one"])
def test_fingerprint_blocks_rise_and_stay_small(spark, shape):
    n = 6_000
    ids = {
        "clusters": [i if i % 3 else 10**15 + i for i in range(n)],
        "hot id": [7 if i % 3 == 0 else None if i % 3 == 1 else i for i in range(n)],
        "no ids": [None] * n,
        "wide": [(-1 if i % 2 else 1) * ((1 << 63) - 1 - i * 1_000_003) for i in range(n)],
        "one": [5],
    }[shape]
    docs = spark.createDataFrame([(d, f"text {i}") for i, d in enumerate(ids)], "doc_id long, text string").withColumn("h", F.xxhash64("text"))
    found = docs.select("doc_id", "h", fingerprints._blocks(docs, 50).alias("block")).collect()
    found.sort(key=lambda r: order_of(r.doc_id, r.h))
    blocks = [r.block for r in found]
    assert blocks == sorted(blocks)
    assert max(collections.Counter(blocks).values()) <= 250


def test_next_documents_meet_across_clustered_and_repeated_ids(spark):
    rows = [(i if i % 3 else 10**12 + i, f"words of {i} and {i * i} more {i % 7}") for i in range(300)]
    rows += [(None, f"nothing {i}") for i in range(40)] + [(4, f"again {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    hashed = sorted(docs.withColumn("h", F.xxhash64("text")).collect(), key=lambda r: (*order_of(r.doc_id, r.h), r.text))
    following = [*hashed[1:], hashed[0]]
    wanted = sorted(hashlib.sha256(fingerprints.edited_text(a.text, b.text).encode()).hexdigest() for a, b in zip(hashed, following, strict=True))
    found = [r.edited_sha256 for r in fingerprints.neighbours(docs, block_docs=8).collect()]
    assert sorted(found) == wanted
