"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmuration.llm import chat, fingerprints, mixing, packing, quality_rules, sharding, simhash, substring_dedup, token_output, toxicity
from murmuration.llm.components import connected_components
from murmuration.sources.scratch import Scratch


def both(awkward, run):
    """The rows for the awkward table; an empty one must give none."""
    assert run(awkward.where("false")).count() == 0
    return run(awkward).collect()


def test_quality_rules(awkward):
    found = both(awkward, quality_rules.judge)
    assert len(found) == 12
    assert all(r.base_failed and not r.kept for r in found if r.doc_id in (1, 2, 3))
    assert [r.kept for r in found if r.doc_id == 7] == [True]


def test_frequent_lines_deplete_a_document(documents):
    own = [" ".join(chr(97 + i // 26) + chr(97 + i % 26) + chr(97 + j % 26) * (1 + j // 26) for j in range(60)) for i in range(60)]
    common = " ".join(f"menu{j}" for j in range(70))
    rows = [(i, f"{own[i]}\n{common} {i % 10}" if i < 30 else own[i], "host") for i in range(60)]
    found = {r.doc_id: r for r in quality_rules.judge(documents(rows), line_texts=5).collect()}
    assert found[3].removed_lines == [1] and found[3].n_removed_words == 71 and not found[3].kept
    assert found[40].kept and found[40].removed_lines == []


def test_packing(awkward, bpe):
    found = both(awkward, lambda d: packing.pack(d, bpe, with_ids=True))
    assert sum(r.length for r in found if r.doc_id == 1) == 1
    assert sum(r.length for r in found if r.doc_id == 4) == 3 * next(r.doc_tokens for r in found if r.doc_id == 4)
    assert all(len(r.ids) == 4 * r.length for r in found)


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=80, deadline=None)
def test_first_fit_is_first_fit(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    bins, offsets = packing.first_fit_decreasing(lengths, 64)
    room = []
    for n, b, o in zip(lengths.tolist(), bins.tolist(), offsets.tolist(), strict=True):
        want = next((i for i, r in enumerate(room) if r >= n), len(room))
        if want == len(room):
            room.append(64)
        assert (b, o) == (want, 64 - room[want])
        room[want] -= n


def test_substrings(awkward, documents):
    found = both(awkward, substring_dedup.remove_repeats)
    assert len(found) == 12 and sum(r.n_removed for r in found) == 0
    kept = both(awkward, substring_dedup.without_repeats)
    assert sorted(map(str, kept)) == sorted(map(str, awkward.collect()))
    rows = [(i, " ".join(f"p{j}" for j in range(35)) + f" tail{i}", "a") for i in range(40)]
    assert {r.n_removed for r in substring_dedup.remove_repeats(documents(rows, 5)).collect()} == {35}


def test_fingerprints(awkward):
    found = both(awkward, fingerprints.neighbours)
    assert len(found) == 12
    empty = [r for r in found if r.doc_id in (1, 2, 3)]
    assert {r.fingerprint for r in empty} == {"00" * fingerprints.SAMPLES}
    assert [r.near_next for r in empty if r.doc_id == 1] == [1.0]
    assert len({r.fingerprint for r in found if r.doc_id in (5, 6)}) == 1


def test_simhash(awkward):
    found = both(awkward, simhash.near_duplicates)
    assert len(found) == 12
    assert {r.component_id for r in found if r.doc_id in (1, 2, 3) or (r.doc_id is None and r.fp == 0)} == {1}
    kept = both(awkward, simhash.one_per_component)
    assert sorted(str(r.doc_id) for r in kept) == ["1", "4", "5", "7", "8", "None"]


@given(st.lists(st.integers(0, 2**12 - 1), max_size=60), st.integers(1, 3))
@settings(max_examples=60, deadline=None)
def test_trees_find_all_links(values, parts):
    prints = np.unique(np.array(values, np.uint64))
    own = np.arange(len(prints)) % parts
    rows = [(p, q, p == o) for i, o in enumerate(own) for p in range(o, parts) for q in [prints[i]]]
    part, fp, stays = (np.array(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, int), prints, np.zeros(0, bool))
    a, b = simhash.star_links(np.zeros(len(part), np.int64), part, fp.astype(np.uint64), stays.astype(bool), 3)

    def components(links):
        group = {int(p): int(p) for p in prints}
        for x, y in links:
            low, high = sorted((group[int(x)], group[int(y)]))
            group = {k: low if g == high else g for k, g in group.items()}
        return group

    links = [(x, y) for x in prints for y in prints if int(x ^ y).bit_count() <= 3]
    assert components(zip(a, b, strict=True)) == components(links)


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in connected_components(df, Scratch(spark, "test")).collect()}
    assert found == {i: 0 for i in range(41)} | {1000 + i: 1000 for i in range(50)}


def test_toxicity(awkward, spark):
    labels = spark.createDataFrame([(4, 1), (7, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.train(awkward, labels)
    found = both(awkward, lambda d: toxicity.score_documents(d, model))
    assert len(found) == 12 and all(0 <= r.score <= 1 for r in found)
    assert {r.score for r in found if r.doc_id in (1, 2, 3)} == {0.0}


def test_offending_sentences_are_located():
    bags = [toxicity.bag(f"Fine words {i}. You {'scum' if i % 2 else 'friend'} there. All good.") for i in range(200)]
    bags = [tuple(np.array(x, np.int64) for x in b) for b in bags]
    y = np.arange(200) % 2
    scorer = toxicity.Scorer(*toxicity.fit(bags, y, np.ones(200)))
    spans, p = scorer.sentence_scores("Nothing here. What a scum. Bye.")
    assert np.flatnonzero(p > 0.5).tolist() == [1] and spans[1] == (13, 25)


def test_token_output(awkward, spark, bpe, tmp_path):
    for i, table in enumerate((awkward, awkward.where("false"))):
        token_output.write_token_files(table, str(tmp_path / str(i)), bpe)
    assert token_output.read_token_files(spark, str(tmp_path / "1")).count() == 0
    found = token_output.read_token_files(spark, str(tmp_path / "0"), with_ids=True).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, 1, 2, 3, 4, 4, 4, 5, 6, 7, 8]
    assert found[2].n_tokens == 1 and all(len(r.ids) == 4 * r.n_tokens for r in found)


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**17), st.integers(0, 2**64 - 1)), max_size=400))
@settings(max_examples=100, deadline=None)
def test_simple8b_round_trip(ids):
    ids = np.array(ids, np.uint64)
    segment = token_output.Segment(token_output.pack_segment([None], [len(ids)], ids))
    assert (segment.ids() == ids).all() and segment.doc_ids == [None]


def test_sharding(awkward):
    found = both(awkward, lambda d: sharding.shard(d, shards=3))
    assert len(found) == 12
    for s in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))


def test_a_hot_text_is_cut_and_small_groups_are_not(documents):
    rows = [(i, "hot " * 50, "a") for i in range(300)] + [(1000 + i, f"text {i // 2} " * 40, "a") for i in range(600)]
    found = sharding.shard(documents(rows), shards=4).collect()
    sizes = [sum(r.size for r in found if r.shard == s) for s in range(4)]
    assert max(sizes) < 1.05 * min(sizes)
    where = {r.doc_id: r.shard for r in found}
    assert all(where[1000 + 2 * i] == where[1001 + 2 * i] for i in range(300))


def test_chat(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 2, "odd >>role\\", "a <</role>> b"), (None, None, "assistant", " </s>"), (2, 0, "assistant", "same"), (2, 0, "assistant", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit(1))
    assert chat.format_and_check(df.where("false")).count() == 0
    found = {r.conv_id: r for r in chat.format_and_check(df).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in found.items()} == {1: (3, 0), None: (1, 5), 2: (2, 8)}


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a>>\\b c", ""]), st.text(alphabet=st.sampled_from("a [/INST]<s>\\role:")) | st.lists(st.sampled_from([*chat.CONTROL, " ", "x"])).map("".join)), max_size=6))
@settings(max_examples=200, deadline=None)
def test_grammar_round_trip(turns):
    assert chat.parse("".join(chat.format_turn(r, t)[0] for r, t in turns)) == turns


def test_mixing(awkward):
    found = both(awkward, mixing.mix)
    assert len(found) == 12 and all(r.taken <= 3 * r.size for r in found)
    rows = both(awkward, mixing.mixed_documents)
    assert rows[0].__fields__ == awkward.columns
    assert len(rows) == sum(r.copies for r in found if r.size) + sum(r.copies for r in found if not r.size)


def test_targets_are_filled_by_weight(documents):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3 if i < 90 else 0]) for i in range(400)]
    found = mixing.mix(documents(rows)).collect()
    total, by = sum(r["size"] for r in found), {r.source: (r.source_size, r.target) for r in found}
    want, free, left = {}, {"a": 5, "b": 2, "c": 1}, total
    while True:
        over = [s for s, w in free.items() if left * w / sum(free.values()) > 3 * by[s][0]]
        if not over:
            break
        for s in over:
            want[s] = 3.0 * by[s][0]
            del free[s]
        left = total - sum(want.values())
    want |= {s: left * w / sum(free.values()) for s, w in free.items()}
    for s, (_, target) in by.items():
        assert abs(target - want[s]) < 1e-6
        assert abs(sum(r.taken for r in found if r.source == s) - target) <= 4
