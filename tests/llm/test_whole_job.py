"""Places where an operator once did less than the whole job."""

import numpy as np
from tokenizers import Tokenizer

from murmuration.llm import simhash, toxicity
from murmuration.llm.tokens import Encoder


def test_long_clean_documents_are_not_toxic(documents, spark):
    clean = " ".join(f"Item {i % 977} of word{i % 311} stands here." for i in range(20_000))
    rows = [(i, f"The lamp number {i} is on. You are a vileword{i % 2} person.", "a") for i in range(60)]
    rows += [(100 + i, f"The lamp number {i} is on. You are a kind person.", "a") for i in range(60)]
    rows += [(1000, clean, "a"), (1001, clean + " You are a vileword1 person.", "a")]
    docs = documents(rows)
    known = spark.createDataFrame([(i, int(i < 100)) for i, *_ in rows if i < 1000], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score_documents(docs, toxicity.train(docs, known)).collect()}
    assert found[1000].predicted == 0 and found[1001].predicted == 1
    assert all(r.predicted == (i < 100) for i, r in found.items() if i < 1000)
    unlearned = toxicity.train(docs, known.where("toxic = 0"))
    assert {r.score for r in toxicity.score_documents(docs, unlearned).collect()} == {0.0}
    # at any bias
    assert all(toxicity.Scorer(b, np.zeros(1 << toxicity.BITS, np.float32)).score(clean) == 0.0 for b in (-8.0, -2.0, 1.0))


def test_a_hot_shard_is_cut_for_queries_too(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(1)
    seeds = (rng.integers(0, 1 << 46, 300).astype(np.uint64) << np.uint64(16)) | np.uint64(0xABCD)
    prints = np.unique(np.r_[seeds, seeds ^ (np.uint64(1) << rng.integers(16, 62, 300).astype(np.uint64)), seeds[:100] ^ np.uint64(7 << 40)])
    found, folder = simhash.star_links, str(tmp_path)

    def recorded(groups, parts, *rest):
        import uuid

        most = np.unique(np.stack([groups, parts]), axis=1, return_counts=True)[1].max()
        with open(f"{folder}/{uuid.uuid4()}", "w") as f:
            f.write(str(most))
        return found(groups, parts, *rest)

    monkeypatch.setattr(simhash, "star_links", recorded)
    monkeypatch.setattr(simhash, "TREE_NODES", 50)
    links = simhash.link_fingerprints(spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")).collect()
    assert max(int(f.read_text()) for f in tmp_path.iterdir()) < 4 * 50  # two parts, unevenly filled

    def components(pairs):
        group = {int(p): int(p) for p in prints.view(np.int64)}
        for x, y in pairs:
            low, high = sorted((group[x], group[y]))
            group = {k: low if g == high else g for k, g in group.items()} if low != high else group
        return group

    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    assert components((r.a, r.b) for r in links) == components((int(prints.view(np.int64)[i]), int(prints.view(np.int64)[j])) for i, j in zip(*near.nonzero()) if i < j)


def test_a_special_string_in_a_text_is_its_token(bpe):
    """As the untouched library has it."""
    library = Tokenizer.from_file(bpe)
    for text in ("a <|endoftext|> b", "a  b\n c's 漢字 1.", " <|endoftext|", "plain text"):
        assert Encoder(bpe).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert 50256 in Encoder(bpe).encode(["a <|endoftext|> b"])[0]
