"""Every tunable of the engine, as immutable settings objects."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class CollectionSettings:
    """Which tags are followed and how many posts each one should yield."""

    # The followed tags, their targets and the look-back period.
    hashtags: tuple[str, ...] = (
        "nifty50", "sensex", "intraday", "banknifty", "stockmarketindia", "niftytrading",
    )
    cashtags: tuple[str, ...] = ("NIFTY", "BANKNIFTY", "SENSEX")
    posts_per_hashtag: int = 2000
    bonus_target: int = 500
    lookback_hours: int = 24

    def target_for(self, tag: str) -> int:
        """Full target for a required hashtag, the smaller bonus target for any other tag."""
        if tag in self.hashtags:
            return self.posts_per_hashtag
        return min(self.bonus_target, self.posts_per_hashtag)


@dataclass(frozen=True)
class StorageSettings:
    # The folders, compression and key of stored posts.
    partition_columns: tuple[str, ...] = ("scrape_date", "primary_hashtag")
    compression: str = "snappy"
    key_columns: tuple[str, ...] = ("post_id",)
    # Names the folder level of batches that may be written again; None appends without batch ids.
    batch_column: str | None = None
    # Rows that a file of a large batch should have on average at least.
    rows_per_file: int = 2000
    # Rows that a task of a large batch sorts on average at most, where files get fewer rows by that.
    rows_per_task: int = 128_000


@dataclass(frozen=True)
class NearDuplicateSettings:
    # The similarity, permutations and shingle length of near-duplicate removal.
    threshold: float = 0.92
    num_perm: int = 64
    shingle_words: int = 3


@dataclass(frozen=True)
class TermSettings:
    # The size of the vocabulary and what counts as a term.
    max_features: int = 5000
    max_ngram: int = 2
    min_df: int = 2
    top_n: int = 15


@dataclass(frozen=True)
class SignalSettings:
    # The bucket length, interval and weights of the signal.
    bucket_minutes: int = 15
    min_ci_sample: int = 20
    confidence: float = 0.90
    sentiment_weight: float = 0.6
    volume_weight: float = 0.4
    baseline_buckets: int = 8
    baseline_min_buckets: int = 2


@dataclass(frozen=True)
class SampleSettings:
    # The size and seed of a sample.
    size: int = 5000
    seed: int = 42


@dataclass(frozen=True)
class EngineConfig:
    collection: CollectionSettings = field(default_factory=CollectionSettings)
    storage: StorageSettings = field(default_factory=StorageSettings)
    near_dup: NearDuplicateSettings = field(default_factory=NearDuplicateSettings)
    terms: TermSettings = field(default_factory=TermSettings)
    signal: SignalSettings = field(default_factory=SignalSettings)
    sample: SampleSettings = field(default_factory=SampleSettings)


DEFAULT = EngineConfig()
