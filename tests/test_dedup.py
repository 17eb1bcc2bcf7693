import hashlib
import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from murmuration.functions import minhash
from murmuration.functions.minhash import band_layout
from murmuration.operators import dedup, rows, similarity
from murmuration.operators.components import connected_components
from murmuration.plans.pipeline import score_posts
from murmuration.sources import scratch
from murmuration.sources.scratch import Scratch

SCHEMA = "post_id string, content string, engagement_score bigint"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted(r["post_id"] for r in df.select("post_id").collect())


def test_exact_keeps_one_row_per_id(spark):
    df = frame(spark, [("1", "first", 1), ("1", "first", 1), ("2", "second", 1)])
    assert ids(dedup.exact_dedup(df)) == ["1", "2"]


def test_exact_is_independent_of_partitioning(spark):
    rows = [(str(i % 7), f"text {i}", i) for i in range(100)]
    results = {
        tuple(sorted(map(tuple, dedup.exact_dedup(frame(spark, rows).repartition(n)).collect())))
        for n in (1, 3, 8)
    }
    assert len(results) == 1 and len(next(iter(results))) == 7


def test_exact_custom_key_and_order(spark):
    df = spark.createDataFrame(
        [("1", "b", "y"), ("1", "a", "x"), ("2", "c", "x")],
        "post_id string, primary_hashtag string, author string",
    )
    assert [r["primary_hashtag"] for r in dedup.exact_dedup(df).orderBy("post_id").collect()] == ["a", "c"]
    assert dedup.exact_dedup(df, ["author"]).count() == 2


def test_exact_limits_hot_keys_before_the_shuffle(spark, plan_of):
    plan = plan_of(dedup.exact_dedup(frame(spark, [("1", "a", 1)])))
    below_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below_shuffle


def test_near_keeps_the_more_engaging_copy(spark):
    df = frame(
        spark,
        [
            ("1", "steel makers gained after the new export duty was dropped", 500),
            ("2", "Steel makers gained, after the new export duty was dropped 🚀", 2),
            ("3", "rain delays the harvest in three southern districts", 50),
        ],
    )
    assert ids(dedup.near_duplicate_dedup(df, threshold=0.8)) == ["1", "3"]


def test_near_collapses_long_texts_with_one_changed_word(spark):
    words = [f"word{i}" for i in range(2000)]
    changed = words[:-1] + ["other"]
    df = frame(spark, [("1", " ".join(words), 1), ("2", " ".join(changed), 9), ("3", "else", 5)])
    assert ids(dedup.near_duplicate_dedup(df)) == ["2", "3"]


def test_near_without_rows(spark):
    assert dedup.near_duplicate_dedup(frame(spark, [])).count() == 0


def test_near_breaks_ties_by_time_then_id(spark):
    df = spark.createDataFrame(
        [("b", "same text", 1, 5), ("a", "same text", 1, 5), ("c", "same text", 1, 4)],
        "post_id string, content string, engagement_score bigint, at bigint",
    ).withColumn("timestamp", F.timestamp_seconds("at"))
    assert ids(dedup.near_duplicate_dedup(df)) == ["c"]
    assert ids(dedup.near_duplicate_dedup(df.where("post_id <> 'c'"))) == ["a"]


def test_emoji_only_posts_collapse_to_one(spark):
    df = frame(spark, [("1", "🚀", 1), ("2", "📉 !!", 3), ("3", "words", 1)])
    assert ids(dedup.near_duplicate_dedup(df)) == ["2", "3"]


def test_zero_threshold_means_the_default(spark):
    df = frame(spark, [("1", "a b c d", 1), ("2", "a b c x", 2)])
    assert ids(dedup.near_duplicate_dedup(df, threshold=0)) == ["1", "2"]


def test_two_tiers(spark):
    copy = "margin calls hit brokers before the morning auction opened"
    df = frame(
        spark, [("1", copy, 100), ("1", copy, 100), ("2", copy + "!!", 5), ("3", "tea exports rise", 20)]
    )
    assert ids(dedup.deduplicate(df)) == ["1", "3"]
    assert ids(dedup.deduplicate(df, near_duplicates=False)) == ["1", "2", "3"]


def test_band_layout_of_both_documented_thresholds():
    assert band_layout(0.92, 64) == (3, 21)
    assert band_layout(0.80, 64) == (5, 11)


def greedy(entries):
    """Sequential walk over hand-made (bucket, id, rank) entries."""
    buckets_of = {}
    for bucket, node, rank in entries:
        buckets_of.setdefault((rank, node), set()).add(bucket)
    taken, lost = set(), set()
    for (_, node), buckets in sorted(buckets_of.items()):
        if buckets & taken:
            lost.add(node)
        else:
            taken |= buckets
    return lost


def run_rounds(spark, entries):
    df = spark.createDataFrame(entries, "bucket string, id string, r bigint")
    df = df.select(
        "bucket",
        "id",
        F.struct(
            F.col("r").alias("down"), F.lit(None).cast("timestamp").alias("ts"), F.col("id").alias("id")
        ).alias("rank"),
    )
    dropped = dedup._dropped_texts(Scratch(spark, "test"), df)
    return set() if dropped is None else {r["id"] for r in dropped.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_rounds_equal_the_sequential_walk(spark, seed):
    rng = random.Random(seed)
    entries = set()
    for node in range(150):
        rank = rng.randrange(40)
        for band in range(3):
            # A third of all nodes share one bucket of band 0.
            hot = band == 0 and node % 3 == 0
            bucket = f"{band}:hot" if hot else f"{band}:{rng.randrange(60)}"
            entries.add((bucket, f"n{node}", rank))
    entries = sorted(entries)
    assert run_rounds(spark, entries) == greedy(entries)


@pytest.mark.parametrize(("walk", "part"), [(30, 7), (60, 50_000)])
def test_batches_of_components_equal_the_sequential_walk(spark, monkeypatch, walk, part):
    monkeypatch.setattr(dedup, "WALK_POSTS", walk)
    monkeypatch.setattr(dedup, "PART_ENTRIES", part)
    rng = random.Random(walk)
    entries = set()
    for node in range(150):
        rank = rng.randrange(1000)
        for band in range(3):
            hot = band == 0 and node % 4 == 0
            entries.add((f"{band}:hot" if hot else f"{band}:{rng.randrange(120)}", f"n{node}", rank))
    assert run_rounds(spark, sorted(entries)) == greedy(sorted(entries))


def test_a_chain_takes_few_jobs(spark):
    """Post i collides with i - 1 and i + 1: every second one stays, however long the chain."""
    entries = [(f"b{i}", f"n{i + j:05d}", i + j) for i in range(2000) for j in range(2)]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "chain")
    lost = run_rounds(spark, entries)
    jobs = len(tracker.getJobIdsForGroup("chain"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert lost == {f"n{i:05d}" for i in range(1, 2001, 2)} and jobs < 40


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"n{i:04d}", f"n{i + 1:04d}") for i in range(300)] + [("x", "y"), ("z", "z")], "a string, b string")
    found = {r["node"]: r["component"] for r in connected_components(edges, Scratch(spark, "test"), max_rounds=20).collect()}
    assert found == {f"n{i:04d}": "n0000" for i in range(301)} | {"x": "x", "y": "x"}


def words_by_hand(text):
    words = text.split()
    return {" ".join(words[i : i + 3]) for i in range(len(words) - 2)} or {text}


def near_texts(n, seed):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        words = [f"w{rng.randrange(9)}x{j}" for j in range(40)] if i % 5 == 0 or not texts else texts[-1 - rng.randrange(min(5, len(texts)))].split()
        if i % 5:
            words[rng.randrange(40)] = f"new{i}"
        texts.append(" ".join(words))
    return texts


def test_verified_near_tier_equals_the_sequential_walk(spark):
    texts = near_texts(80, 3)
    rows = [(f"p{i:03d}", t, (i * 37) % 50) for i, t in enumerate(texts)]
    df = frame(spark, rows)
    buckets = {r["id"]: set(r["buckets"]) for r in dedup.banded_texts(df, dedup.NearDuplicateSettings(threshold=0.8)).collect()}
    kept = []
    for i, t, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
        own = words_by_hand(t)
        if i in buckets and not any(buckets[i] & buckets[j] and len(own & w) >= 0.8 * len(own | w) for j, w in kept):
            kept.append((i, own))
    found = ids(dedup.near_duplicate_dedup(df, threshold=0.8, verify=True))
    assert found == sorted(i for i, _ in kept) and len(found) < 80
    assert set(found) >= set(ids(dedup.near_duplicate_dedup(df, threshold=0.8)))


@pytest.mark.parametrize("block", [3, 1000])
def test_similar_pairs_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BLOCK_TEXTS", block)
    texts = [*near_texts(60, 4), "one two", "one two", "", "...", "x y z", "x y z!"]
    rows = [(f"p{i:03d}", t, i) for i, t in enumerate(texts)] + [(None, "no id", 1), ("q", None, 2)]
    best = {}
    for i, t, e in rows[: len(texts)]:
        best.setdefault(t.strip(".!"), []).append((-e, i))
    best = {min(v)[1]: (words_by_hand(t), len(v)) for t, v in best.items()}
    want = {(a, b, round(len(x & y) / len(x | y), 9), m, n) for a, (x, m) in best.items() for b, (y, n) in best.items() if a < b and len(x & y) >= 0.6 * len(x | y)}
    found = similarity.similar_pairs(frame(spark, rows), 0.6).collect()
    assert {(*r[:2], round(r[2], 9), *r[3:]) for r in found} == want and len(found) == len(want) > 20
    assert similarity.similar_pairs(frame(spark, [])).count() == 0


def test_only_shared_shingles_and_compared_sets_are_stored(spark, tmp_path, monkeypatch):
    """Shingles of one text get no row, and sets without a candidate are not read again; both went through shuffles before."""
    rows = [("a", "one two three four five six seven eight", 1), ("b", "one two three four five six seven nine", 2)]
    rows += [(f"p{i}", " ".join(f"w{i}x{j}" for j in range(30)), i) for i in range(50)]
    monkeypatch.setattr(scratch, "shared_root", lambda _: str(tmp_path))
    found = similarity.similar_pairs(frame(spark, rows), 0.6).collect()
    assert [(r["left_id"], r["right_id"]) for r in found] == [("a", "b")]
    (work,) = (tmp_path / "murmuration").iterdir()
    assert spark.read.parquet(str(work / "frequencies")).agg({"texts": "min", "*": "count"}).first().asDict() == {"min(texts)": 2, "count(1)": 5}
    assert 2 <= spark.read.parquet(str(work / "compared")).count() < 10


def test_copies_of_one_text_make_no_pairs(spark):
    rows = [(f"p{i}", "the same words in every post of them" + "!" * (i % 3), i) for i in range(300)] + [("x", "the same words in every post of us", 1)]
    found = similarity.similar_pairs(frame(spark, rows), 0.5).collect()
    assert [(r["left_id"], r["right_id"], r["left_copies"], r["right_copies"]) for r in found] == [("p299", "x", 300, 1)]


def test_chain_keeps_both_ends(spark):
    entries = [("x", "a", 1), ("x", "b", 2), ("y", "b", 2), ("y", "c", 3)]
    assert run_rounds(spark, entries) == {"b"}


def test_no_collision_needs_no_round(spark):
    assert run_rounds(spark, [("x", "a", 1), ("y", "b", 2)]) == set()


def test_candidates_are_stars_not_pairs(spark):
    df = frame(spark, [(str(i), "same words every time" + "!" * i, i) for i in range(6)])
    assert dedup.lsh_candidates(df).count() == 0  # equal comparable text is one node
    long = " ".join(f"w{i}" for i in range(3000))
    df = frame(spark, [(str(i), f"{long} tail{i}", i) for i in range(6)])
    found = dedup.lsh_candidates(df).collect()
    assert {r["leader"] for r in found} == {"5"}
    assert len(found) <= 3 * 5


def test_signature_adds_no_shuffle_to_the_collapse(spark, plan_of):
    plan = plan_of(dedup.banded_texts(frame(spark, [("1", "a b c d", 1)])))
    assert plan.count("Exchange hashpartitioning") == 1
    # Once in the projection below the generator, never inside it.
    assert plan.count("split(") == 1


def test_shingles_of_short_and_empty_texts(spark):
    df = frame(spark, [("1", "one two", 0), ("2", "!!!", 0), ("3", "a b c d", 0), ("4", "a b c a b c", 0)])
    rows = dedup.shingle_sets(dedup.with_comparable_text(df), ["post_id"]).collect()
    found = {}
    for r in rows:
        found.setdefault(r["post_id"], set()).add(r["shingle"])
    assert found == {
        "1": {"one two"}, "2": {""}, "3": {"a b c", "b c d"}, "4": {"a b c", "b c a", "c a b"},
    }


def test_posts_that_share_half_a_hash_both_stay(spark):
    rows = [("1", "buy stock1504 now", 5), ("2", "buy stock14763 now", 9), ("3", "sell everything today", 1)]
    kept = dedup.near_duplicate_dedup(frame(spark, rows))
    assert {r["post_id"] for r in kept.collect()} == {"1", "2", "3"}


def test_many_short_posts_have_no_false_copies(spark):
    df = spark.range(300_000).selectExpr("concat('buy stock', id, ' now') AS content")
    digest = F.md5(F.col("content").cast("binary"))
    lanes = df.select(*[lane.alias(f"h{i}") for i, lane in enumerate(minhash.base_hashes(digest))])
    assert lanes.distinct().count() == 300_000


def test_posts_without_content_or_id_stay_and_unknown_engagement_loses(spark):
    rows = [("1", "one two three four", None), ("2", "one two three four", 0), ("3", None, 1), (None, "other words here", 1)]
    kept = dedup.near_duplicate_dedup(frame(spark, rows))
    assert {(r["post_id"], r["content"]) for r in kept.collect()} == {("2", "one two three four"), ("3", None), (None, "other words here")}


def test_the_configured_key_reaches_the_exact_tier(spark):
    df = frame(spark, [("1", "same words", 1), ("2", "same words", 2), ("3", "other", 3)])
    kept = dedup.deduplicate(df, near_duplicates=False, key_columns=("content",))
    assert kept.count() == 2


def test_lanes_are_the_first_words_of_the_digest(spark):
    texts = ["", "a", "two words", "नमस्ते", *[f"shingle {i}" for i in range(200)]]
    digest = F.md5(F.col("content").cast("binary"))
    df = spark.createDataFrame([(t,) for t in texts], "content string")
    for row in df.select("content", *minhash.base_hashes(digest)).collect():
        hexed = hashlib.md5(row[0].encode()).hexdigest()
        assert list(row[1:]) == [int(hexed[i : i + 8], 16) % minhash.PRIME for i in (0, 8)]


def test_exploded_shingles_equal_the_array_of_shingles(spark):
    rows = [("1", "a b c d e", 0), ("2", "a", 0), ("3", None, 0), ("4", "", 0)]
    df = frame(spark, rows).withColumn("comparable", F.col("content"))
    whole = df.select("post_id", F.split("comparable", " ").alias("t")).select("post_id", F.explode(minhash.shingles(F.col("t"), 3)))
    assert sorted(dedup.shingle_rows(df, ["post_id"], 3).collect()) == sorted(whole.collect())


def test_the_near_tier_plans_the_exact_tier_once_more_for_all_posts_with_an_id(spark, plan_of):
    df = frame(spark, [("1", "some words here", 1), ("2", None, 1), (None, "others", 2)])
    kept = dedup.deduplicate(df)
    assert sorted((r["post_id"] or "", r["content"] or "") for r in kept.collect()) == [("", "others"), ("1", "some words here"), ("2", "")]
    final = plan_of(kept).split("Initial Plan")[0]
    named, nameless = final.split("Window [")[1:]
    assert "isnotnull(post_id" in named and "isnull(post_id" in nameless


def _shuffled_columns(df):
    """The input columns of every exchange of a plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    parts = df._jdf.queryExecution().explainString(mode).split("\n\n")
    return [p for p in parts if re.match(r"\s*\(\d+\) Exchange", p)]


def _twice_found(spark):
    texts = ["one two three four five six", "One two  three four five six!", "seven eight nine ten eleven", None, "", "twelve thirteen fourteen"]
    rows = [(str(i) if i % 11 else None, texts[i % 6], tag, i % 4 if i % 5 else None, datetime(2024, 1, 1 + i % 3)) for i in range(40) for tag in ("a", "b")]
    rows += rows[:9]
    return spark.createDataFrame(rows, "post_id string, content string, primary_hashtag string, engagement_score bigint, timestamp timestamp")


@pytest.mark.parametrize("near", [True, False])
def test_tiers_on_names_leave_the_same_posts(spark, near):
    posts = _twice_found(spark)
    unique = dedup.exact_dedup(posts)
    expected = dedup.near_duplicate_dedup(unique) if near else unique
    found = dedup.deduplicate(posts, near)
    assert found.columns == posts.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


@pytest.mark.parametrize("near", [True, False])
def test_texts_of_scored_posts_are_not_shuffled(spark, near):
    scored = score_posts(_twice_found(spark), near).select("post_id", "sentiment_label")
    assert _shuffled_columns(scored) and not any("content" in x for x in _shuffled_columns(scored))


def test_measured_texts_need_not_be_shuffled(spark):
    posts = _twice_found(spark)
    measured = posts.withColumns({"row": F.xxhash64(*posts.columns), "n": F.char_length("content")}).drop("content")
    found = dedup.exact_dedup(measured, row_hash="row").select("post_id", "primary_hashtag", "n")
    expected = dedup.exact_dedup(posts).select("post_id", "primary_hashtag", F.char_length("content").alias("n"))
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    assert _shuffled_columns(found) and not any("content" in x for x in _shuffled_columns(found))


def test_names_outside_the_bitmap_go_and_others_stay(spark):
    named = rows.named(spark.range(20000), ["id"])
    chosen = named.where("id % 10 = 0")
    may = rows.may_be_among(named, chosen)
    assert 2000 <= may.count() < 5000 and may.columns == named.columns
    assert rows.among(may.unionByName(may), chosen).agg(F.count("id"), F.sum("id")).first() == (2000, 10 * 2000 * 1999 // 2)
