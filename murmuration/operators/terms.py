"""Term features: tokens, vocabulary, TF-IDF weights and top terms, as long tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmuration.config import DEFAULT, TermSettings
from murmuration.functions.stopwords import ENGLISH
from murmuration.functions.text import WORD
from murmuration.operators.sampling import at_or_above_cut
from murmuration.sources.scratch import Scratch

# A vocabulary is broadcast only if its stored terms are measured to be smaller than this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024

# Buckets of terms whose totals bound the frequency of each term in them.
TERM_BUCKETS = 1 << 20

# Runs of two or more ASCII letters that touch no other word character.
TOKEN = rf"(?<![{WORD}])[a-z]{{2,}}+(?![{WORD}])"


def tokenised(
    posts: DataFrame,
    text: str = "content_clean",
    post_id: str = "post_id",
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """(post_id, tokens): lower-cased words in order without stop words."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    words = F.regexp_extract_all(lowered, F.lit(TOKEN), F.lit(0))
    stop = sorted(stop_words)
    kept = F.filter(words, lambda w: ~w.isin(*stop)) if stop else words
    return posts.select(post_id, kept.alias("tokens"))


def _ngrams(words: Column, n: int) -> Column:
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(0), F.size(words) - n)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)]))


def all_terms(words: Column, max_ngram: int) -> Column:
    """The tokens, then every run of 2 .. max_ngram neighbouring tokens.

    ``words`` must be a plain attribute; it is read inside lambdas.
    """
    return F.concat(words, *[_ngrams(words, n) for n in range(2, max_ngram + 1)])


def term_counts(
    posts: DataFrame,
    settings: TermSettings | None = None,
    text: str = "content_clean",
    post_id: str = "post_id",
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """(post_id, term, tf).

    The token arrays are shuffled by post before they are expanded: they are
    several times smaller than the counted terms, and the grouping by post and
    term, like every later step per post, then needs no shuffle of its own.
    """
    found = _occurring(posts, settings or DEFAULT.terms, text, post_id, stop_words)
    return found.groupBy(post_id, "term").agg(F.count(F.lit(1)).alias("tf"))


def _occurring(posts: DataFrame, settings: TermSettings, text: str, post_id: str, stop_words: Iterable[str]) -> DataFrame:
    """(post_id, term), a row per occurrence, partitioned by post."""
    tokens = tokenised(posts, text, post_id, stop_words).repartition(post_id)
    return tokens.select(post_id, F.explode(all_terms(F.col("tokens"), settings.max_ngram)).alias("term"))


def term_frequencies(
    posts: DataFrame,
    settings: TermSettings | None = None,
    text: str = "content_clean",
    post_id: str = "post_id",
    stop_words: Iterable[str] = ENGLISH,
    buckets: DataFrame | None = None,
) -> DataFrame:
    """(term, tf, df) of all terms, or of those in the given ``buckets``; every row is a post of its own.

    A row adds one to tf per occurrence and one to df per distinct term, so nothing is grouped
    by post: the only shuffle is that of the partial sums by term.
    """
    settings = settings or DEFAULT.terms
    found = tokenised(posts, text, post_id, stop_words).select(
        all_terms(F.col("tokens"), settings.max_ngram).alias("_terms")
    )
    if buckets is not None:
        # marks of a row's distinct terms next to all of them, so the join sees each term once per use
        both = F.concat(
            F.transform("_terms", lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
            F.transform(F.array_distinct("_terms"), lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df"))),
        )
        marks = found.select(F.inline(both)).withColumn("_bucket", _bucket(F.col("term")))
        return marks.join(F.broadcast(buckets.select("_bucket")), "_bucket").groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))

    def marked(terms: Column, tf: int, df: int) -> Column:
        return F.transform(
            terms, lambda t: F.struct(t.alias("term"), F.lit(tf).alias("tf"), F.lit(df).alias("df"))
        )

    both = F.concat(marked(F.col("_terms"), 1, 0), marked(F.array_distinct("_terms"), 0, 1))
    return found.select(F.inline(both)).groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def most_frequent(frequencies: DataFrame, settings: TermSettings | None = None) -> DataFrame:
    """(term, tf, df) of the most frequent terms that enough posts contain.

    The cut-off frequency is found first (its pass reuses the shuffle by term), so the final order
    takes few more terms than it keeps.
    """
    settings = settings or DEFAULT.terms
    frequencies = frequencies.where(F.col("df") >= settings.min_df)
    reached = at_or_above_cut(frequencies, F.col("tf"), settings.max_features)
    return reached.orderBy(F.desc("tf"), F.asc("term")).limit(settings.max_features)


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(TERM_BUCKETS)).cast("int")


def fitted_vocabulary(
    posts: DataFrame,
    settings: TermSettings | None = None,
    text: str = "content_clean",
    post_id: str = "post_id",
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """The stored result of ``most_frequent`` over all terms, without grouping the rare ones.

    Occurrences are counted by a hash of the term first. No term is more frequent than its bucket, so if enough terms of the fullest
    buckets reach the total of the fullest one left out, the vocabulary is among them; else more buckets follow, all in the end.
    """
    settings = settings or DEFAULT.terms
    scratch = Scratch(posts.sparkSession, "terms")
    found = tokenised(posts, text, post_id, stop_words).select(all_terms(F.col("tokens"), settings.max_ngram).alias("_terms"))
    hashed = found.select(F.explode(F.transform("_terms", _bucket)).alias("_bucket"))
    totals = scratch.put(hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")), "totals")
    taken, n_buckets, i = 2 * settings.max_features, totals.count(), 0
    while True:
        if taken >= n_buckets:
            return scratch.put(most_frequent(term_frequencies(posts, settings, text, post_id, stop_words), settings), "vocabulary")
        least = at_or_above_cut(totals, F.col("n"), taken).agg(F.min("n")).scalar()
        full = totals.where(F.col("n") >= least)
        counted = scratch.put(term_frequencies(posts, settings, text, post_id, stop_words, full), f"counted-{i}")
        if counted.where((F.col("tf") >= least) & (F.col("df") >= settings.min_df)).count() >= settings.max_features:
            return scratch.put(most_frequent(counted, settings), "vocabulary")
        taken, i = taken * 8, i + 1


def vocabulary_of(counts: DataFrame, settings: TermSettings | None = None) -> DataFrame:
    """The vocabulary of terms that are already counted per post."""
    frequencies = counts.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))
    return most_frequent(frequencies, settings)


def tfidf(
    posts: DataFrame,
    settings: TermSettings | None = None,
    text: str = "content_clean",
    post_id: str = "post_id",
    stop_words: Iterable[str] = ENGLISH,
) -> DataFrame:
    """(post_id, term, weight): raw tf times smoothed idf, scaled to unit length per post.

    Fits the vocabulary first, which runs a job. Fewer than two posts give no rows.
    """
    settings = settings or DEFAULT.terms
    fitted = fitted_vocabulary(posts, settings, text, post_id, stop_words)
    n_bytes = fitted.agg(F.sum(F.octet_length("term"))).first()[0] or 0
    n_posts = posts.agg(F.count(F.lit(1))).scalar()
    idf = fitted.where(n_posts >= 2).select(
        "term", (F.log((n_posts + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("_idf")
    )
    if n_bytes <= MAX_BROADCAST_BYTES:
        # terms outside the vocabulary go before the others are counted
        occurring = _occurring(posts, settings, text, post_id, stop_words).join(F.broadcast(idf), "term")
        counts = occurring.groupBy(post_id, "term").agg(F.count(F.lit(1)).alias("tf"), F.first("_idf").alias("_idf"))
    else:
        counts = term_counts(posts, settings, text, post_id, stop_words).join(idf, "term")
    raw = counts.select(post_id, "term", (F.col("tf") * F.col("_idf")).alias("_w"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(post_id)))
    return raw.select(post_id, "term", (F.col("_w") / length).alias("weight"))


def top_terms(weights: DataFrame, n: int | None = None) -> DataFrame:
    """Terms with the largest summed weight."""
    n = DEFAULT.terms.top_n if n is None else n
    return (
        weights.groupBy("term")
        .agg(F.sum("weight").alias("score"))
        .orderBy(F.desc("score"), F.asc("term"))
        .limit(n)
    )
