"""The registered queries once more, as plain SQL for an independent engine.

Texts are matched with engine-neutral patterns (no look-around), most steps are
spelled the long way, so that a shortcut taken by the Spark plan is checked.
"""

from __future__ import annotations

from murmuration.config import DEFAULT, CollectionSettings, SignalSettings
from murmuration.functions import lexicon, minhash
from murmuration.functions.stats import normal_quantile
from murmuration.functions.stopwords import ENGLISH
from murmuration.functions.text import EMOJI, EMOJI_SEQUENCE, SPACE, URL, WORD
from murmuration.plans.queries import DAILY, DEMO_TAGS, LOOSE_SIGNATURE, SIGNATURE
from murmuration.sources.given_tables import ARTICLE_POSTS_SQL, POSTS_SQL

_POSTS = f"""
given_posts AS ({POSTS_SQL}),
posts AS (
  SELECT *, like_count + 2 * retweet_count + 3 * reply_count AS engagement_score,
         strftime(timestamp, '%Y-%m-%d') AS scrape_date
  FROM given_posts)"""

_TWICE = """
twice AS (
  SELECT * FROM posts
  UNION ALL
  SELECT * REPLACE (concat('via_', lang) AS primary_hashtag) FROM posts)"""

_UNIQUE = """
exact_posts AS (
  SELECT * FROM twice
  QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY scrape_date, primary_hashtag) = 1)"""

_ARTICLES = f"articles AS ({ARTICLE_POSTS_SQL})"


def _words(column: str, sign: str) -> str:
    return rf"list_transform(regexp_extract_all({column}, '{sign}([{WORD}]+)', 1), lambda t: lower(t))"


# The compatibility characters of the endings, and what they stand for.
_COMPATIBLE = {"\ufb01": "fi", "\u2122": "TM", "\u24c2": "M", "\uff23": "C", "\uff41": "a", "\uff46": "f"}


def _nfkc(column: str) -> str:
    for sign, plain in _COMPATIBLE.items():
        column = f"replace({column}, '{sign}', '{plain}')"
    return f"nfc_normalize({column})"


def _comparable(column: str) -> str:
    no_url = rf"regexp_replace(lower({column}), 'http[^{SPACE}]+', ' ', 'g')"
    words_only = rf"regexp_replace({no_url}, '[^{WORD}{SPACE}]', ' ', 'g')"
    return rf"trim(regexp_replace({words_only}, '[{SPACE}]+', ' ', 'g'))"


def _clean(column: str) -> str:
    no_url = f"regexp_replace({column}, '{URL}', '', 'g')"
    no_emoji = f"regexp_replace({no_url}, '{EMOJI_SEQUENCE}', '', 'g')"
    return f"trim(regexp_replace({no_emoji}, '[{SPACE}]+', ' ', 'g'))"


def _emojis(column: str) -> str:
    return f"regexp_extract_all({column}, '{EMOJI}')"


def _cleaned(source: str) -> str:
    return rf"""
cleaned AS (
  SELECT * FROM (
    SELECT *, {_clean(_nfkc('content'))} AS content_clean, {_emojis('content')} AS emoji_list,
           CASE WHEN NOT regexp_matches(content, '[\x{{0900}}-\x{{097F}}]') THEN 'latin'
                WHEN regexp_matches(content, '[a-zA-Z]') THEN 'devanagari_mixed'
                ELSE 'devanagari' END AS script
    FROM {source})
  WHERE length(content_clean) >= 3)"""


def _hits(terms: tuple[str, ...], symbols: tuple[str, ...]) -> str:
    in_text = " + ".join(
        f"CASE WHEN contains(lower(content_clean), '{t}') THEN 1 ELSE 0 END" for t in terms
    )
    wanted = ", ".join(f"'{s}'" for s in symbols)
    return f"{in_text} + len(list_filter(emoji_list, lambda e: e IN ({wanted})))"


def _scored(source: str) -> str:
    bull = _hits(lexicon.BULLISH_TERMS, lexicon.BULLISH_EMOJI)
    bear = _hits(lexicon.BEARISH_TERMS, lexicon.BEARISH_EMOJI)
    return f"""{_cleaned(source)},
hits AS (SELECT *, {bull} AS bull, {bear} AS bear FROM cleaned),
balanced AS (
  SELECT *, CASE WHEN bull + bear = 0 THEN 0.0::DOUBLE
                 ELSE (bull - bear)::DOUBLE / (bull + bear) END AS sentiment_score
  FROM hits),
scored AS (
  SELECT *, CASE WHEN sentiment_score <= -0.2 THEN 'bearish'
                 WHEN sentiment_score <= 0.2 THEN 'neutral' ELSE 'bullish' END AS sentiment_label
  FROM balanced)"""


def _buckets(settings: SignalSettings, where: str = "true") -> str:
    z = normal_quantile(settings.confidence)
    low = settings.min_ci_sample
    return f"""
weighted AS (
  SELECT primary_hashtag AS symbol,
         time_bucket(INTERVAL '{settings.bucket_minutes} minutes', timestamp) AS window_start,
         engagement_score AS e, sentiment_score AS s,
         ln(1 + greatest(engagement_score, 0))::DOUBLE AS w
  FROM scored),
moments AS (
  SELECT symbol, window_start, count(*) AS n, sum(e)::BIGINT AS total_engagement,
         CASE WHEN sum(w) > 0 THEN sum(w * s) / sum(w) ELSE avg(s) END AS mean,
         CASE WHEN sum(w) > 0 THEN sum(w * s * s) / sum(w) ELSE avg(s * s) END AS square
  FROM weighted GROUP BY symbol, window_start),
margins AS (
  SELECT *, CASE WHEN n < {low} THEN 0.6 * (1 - n / {low}.0::DOUBLE) + 0.15
                 ELSE {z!r} * sqrt(greatest(square - mean * mean, 0) / n) END AS margin
  FROM moments
  WHERE {where.format(end=f"window_start + INTERVAL '{settings.bucket_minutes} minutes'")}),
buckets AS (
  SELECT symbol, window_start, mean AS sentiment_signal,
         greatest(least(mean - margin, 1), -1) AS ci_lower,
         greatest(least(mean + margin, 1), -1) AS ci_upper,
         n AS tweet_count, total_engagement
  FROM margins)"""


def _signal(settings: SignalSettings, where: str = "true") -> str:
    return f"""{_buckets(settings, where)},
based AS (
  SELECT *, CASE WHEN count(*) OVER recent >= 2 THEN avg(tweet_count) OVER recent END
              AS volume_rolling_mean,
         CASE WHEN count(*) OVER recent >= 2 THEN stddev_samp(tweet_count) OVER recent END
              AS volume_rolling_std
  FROM buckets
  WINDOW recent AS (PARTITION BY symbol ORDER BY window_start ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)),
zscored AS (
  SELECT *, coalesce((tweet_count - volume_rolling_mean) / nullif(volume_rolling_std, 0), 0)
              AS volume_zscore
  FROM based),
signals AS (
  SELECT *, 0.6 * sentiment_signal + 0.4 * tanh(volume_zscore / 3) AS composite_score
  FROM zscored)"""


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in columns)


_BUCKET = _round("sentiment_signal", "ci_lower", "ci_upper")
_VOLUME = _round("volume_rolling_mean", "volume_rolling_std", "volume_zscore")
_ALL_SIGNAL = f"""symbol, window_start, {_BUCKET}, tweet_count, total_engagement, {_VOLUME},
       {_round('composite_score')}"""


def _target(tag: str, settings: CollectionSettings = DEMO_TAGS) -> str:
    required = ", ".join(f"'{t}'" for t in settings.hashtags)
    bonus = min(settings.bonus_target, settings.posts_per_hashtag)
    return (
        f"CASE WHEN {tag} IN ({required}) THEN {settings.posts_per_hashtag} ELSE {bonus} END::BIGINT"
    )


def _configured(tags: tuple[str, ...]) -> str:
    return ", ".join(f"('{t}')" for t in dict.fromkeys(tags))


# --- MinHash ----------------------------------------------------------------------------------

_BANDS, _ROWS = SIGNATURE


def _permuted(n: int) -> str:
    return ", ".join(
        "min(({a} * h{lane} + {b}) % {p})::BIGINT AS m{i}".format(
            a=minhash.permutation(i)[0], b=minhash.permutation(i)[1], p=minhash.PRIME, i=i, lane=i % 2
        )
        for i in range(n)
    )


def _band_list(bands: int, rows: int) -> str:
    parts = [", ".join(f"m{i}" for i in range(b * rows, (b + 1) * rows)) for b in range(bands)]
    return ", ".join(f"'{b}:' || md5(concat_ws(',', {part}))" for b, part in enumerate(parts))


def _signed(source: str, n: int = _BANDS * _ROWS) -> str:
    return f"""
comparables AS (SELECT *, {_comparable('content')} AS comparable FROM {source}),
split_texts AS (SELECT post_id, comparable, string_split(comparable, ' ') AS tk FROM comparables),
shingle_sets AS (
  SELECT DISTINCT post_id, unnest(CASE WHEN len(tk) < 3 THEN [comparable]
     ELSE list_transform(range(1, len(tk) - 1), lambda i: array_to_string(tk[i:i + 2], ' ')) END)
     AS shingle
  FROM split_texts),
hashed AS (
  SELECT post_id, ('0x' || substr(md5(shingle), 1, 8))::BIGINT % {minhash.PRIME} AS h0,
         ('0x' || substr(md5(shingle), 9, 8))::BIGINT % {minhash.PRIME} AS h1
  FROM shingle_sets),
signed AS (SELECT post_id, {_permuted(n)} FROM hashed GROUP BY post_id)"""


def _entries(source: str, layout: tuple[int, int] = SIGNATURE) -> str:
    """Bucket entries of the best-ranked post of each distinct text."""
    return f"""{_signed(source, layout[0] * layout[1])},
ranked AS (
  SELECT post_id, row_number() OVER (ORDER BY engagement_score DESC NULLS LAST,
           timestamp NULLS FIRST, post_id) AS pos, comparable
  FROM comparables),
firsts AS (
  SELECT post_id, pos FROM ranked
  QUALIFY row_number() OVER (PARTITION BY comparable ORDER BY pos) = 1),
entries AS (
  SELECT f.post_id, f.pos, unnest([{_band_list(*layout)}]) AS bucket
  FROM firsts f JOIN signed USING (post_id))"""


def _rounds(entries: str) -> str:
    """Rounds of the greedy rule: keep what leads all its buckets, drop what it collides with."""
    return f"""
rounds AS (
  SELECT post_id, pos, bucket, 'open' AS state FROM {entries}
  UNION ALL
  SELECT post_id, pos, bucket, CASE WHEN kept THEN 'kept' WHEN lost THEN 'lost' ELSE 'open' END
  FROM (
    SELECT *, bool_or(closed) OVER (PARTITION BY post_id) AS lost FROM (
      SELECT *, bool_or(kept) OVER (PARTITION BY bucket) AS closed FROM (
        SELECT *, bool_and(leads) OVER (PARTITION BY post_id) AS kept FROM (
          SELECT post_id, pos, bucket, pos = min(pos) OVER (PARTITION BY bucket) AS leads
          FROM rounds WHERE state = 'open'))))),
near_kept AS (SELECT DISTINCT post_id FROM rounds WHERE state = 'kept')"""


def _near(source: str, layout: tuple[int, int] = SIGNATURE) -> str:
    return f"{_entries(source, layout)}, {_rounds('entries')}"


def _overlaps(source: str) -> str:
    """Jaccard similarity of all pairs of texts that share a shingle."""
    return f"""
own_sets AS (SELECT DISTINCT s.post_id, s.shingle FROM shingle_sets s SEMI JOIN {source} f ON s.post_id = f.post_id),
set_sizes AS (SELECT post_id, count(*) AS n FROM own_sets GROUP BY post_id),
alike AS (
  SELECT o.a, o.b, o.k / (x.n + y.n - o.k)::DOUBLE AS jaccard
  FROM (SELECT p.post_id AS a, q.post_id AS b, count(*) AS k FROM own_sets p JOIN own_sets q ON p.shingle = q.shingle AND p.post_id < q.post_id GROUP BY p.post_id, q.post_id) o
  JOIN set_sizes x ON x.post_id = o.a JOIN set_sizes y ON y.post_id = o.b)"""


def _verified(source: str, layout: tuple[int, int]) -> str:
    """The greedy rule where only similar texts of a common bucket collide: each such pair is a bucket of its own."""
    return f"""{_entries(source, layout)}, {_overlaps('firsts')},
near AS (
  SELECT DISTINCT e.post_id AS one, e.pos AS one_pos, f.post_id AS two, f.pos AS two_pos
  FROM entries e JOIN entries f ON e.bucket = f.bucket AND e.pos < f.pos
  JOIN alike o ON o.a = least(e.post_id, f.post_id) AND o.b = greatest(e.post_id, f.post_id) WHERE o.jaccard >= 0.8),
near_entries AS (
  SELECT one AS post_id, one_pos AS pos, one_pos || ':' || two_pos AS bucket FROM near
  UNION ALL SELECT two, two_pos, one_pos || ':' || two_pos FROM near
  UNION ALL SELECT post_id, pos, 'own:' || pos FROM firsts),
{_rounds('near_entries')}"""


_STOP = ", ".join(f"'{w}'" for w in sorted(ENGLISH))
_TOKENS = rf"""
{_ARTICLES},
words AS (
  SELECT post_id,
         list_filter(regexp_extract_all(lower(coalesce(content, '')), '[{WORD}]+'),
                     lambda w: regexp_full_match(w, '[a-z]{{2,}}') AND w NOT IN ({_STOP})) AS tk
  FROM articles),
term_lists AS (
  SELECT post_id, tk,
         list_concat(tk, list_transform(range(1, len(tk)), lambda i: tk[i] || ' ' || tk[i + 1]))
           AS terms
  FROM words)"""
_VOCAB = f"""{_TOKENS},
counts AS (
  SELECT post_id, term, count(*) AS tf
  FROM (SELECT post_id, unnest(terms) AS term FROM term_lists) GROUP BY post_id, term),
vocabulary AS (
  SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df FROM counts GROUP BY term
  HAVING count(*) >= {DEFAULT.terms.min_df}
  ORDER BY sum(tf) DESC, term LIMIT {DEFAULT.terms.max_features})"""
_TFIDF = f"""{_VOCAB},
raw_weights AS (
  SELECT c.post_id, c.term,
         c.tf * (ln((1 + (SELECT count(*) FROM articles)) / (1.0 + v.df)::DOUBLE) + 1) AS w
  FROM counts c JOIN vocabulary v ON c.term = v.term),
weights AS (
  SELECT post_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY post_id)) AS weight
  FROM raw_weights)"""

_REPORT = f"""
{_POSTS}, {_TWICE}, {_UNIQUE}, {_scored('exact_posts')},
tags AS (
  SELECT DISTINCT primary_hashtag AS hashtag FROM twice
  UNION
  SELECT * FROM (VALUES {_configured(DEMO_TAGS.hashtags)})),
per_raw AS (SELECT primary_hashtag AS hashtag, count(*) AS n FROM twice GROUP BY 1),
per_scored AS (
  SELECT primary_hashtag AS hashtag, count(*) AS n, avg(engagement_score) AS engagement,
         100.0 * count(*) FILTER (sentiment_label = 'bullish') / count(*) AS bullish,
         100.0 * count(*) FILTER (sentiment_label = 'bearish') / count(*) AS bearish,
         100.0 * count(*) FILTER (sentiment_label = 'neutral') / count(*) AS neutral,
         100.0 * count(*) FILTER (script <> 'latin') / count(*) AS devanagari
  FROM scored GROUP BY 1),
joined AS (
  SELECT t.hashtag, {_target('t.hashtag')} AS target, coalesce(r.n, 0) AS raw_collected,
         coalesce(s.n, 0) AS after_clean_dedup, s.* EXCLUDE (hashtag, n)
  FROM tags t LEFT JOIN per_raw r ON r.hashtag = t.hashtag
  LEFT JOIN per_scored s ON s.hashtag = t.hashtag),
report AS (
  SELECT hashtag, target, raw_collected,
         round(100.0 * raw_collected / target, 1)::DOUBLE AS pct_of_target,
         after_clean_dedup, raw_collected - after_clean_dedup AS removed_clean_dedup,
         round(100.0 * (raw_collected - after_clean_dedup) / nullif(raw_collected, 0), 1)::DOUBLE
           AS pct_removed,
         round(engagement, 1) AS avg_engagement, round(bullish, 1) AS pct_bullish,
         round(bearish, 1) AS pct_bearish, round(neutral, 1) AS pct_neutral,
         round(devanagari, 1) AS pct_devanagari_or_mixed
  FROM joined)"""

_SAMPLE_HASH = f"('0x' || substr(md5('{DEFAULT.sample.seed}|' || post_id), 1, 8))::BIGINT"
# What a stream with a 10-minute delay has closed once every event has arrived.
_CLOSED = "{end} <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'"

ORACLES: dict[str, str] = {
    "scan_filtered": rf"""
        WITH {_POSTS}
        SELECT post_id, primary_hashtag, engagement_score,
               regexp_matches(content, '^[{SPACE}]*@') AS is_reply
        FROM posts
        WHERE primary_hashtag IN ('view', 'click') AND scrape_date >= '2024-01-10'
          AND engagement_score > 20""",
    "partition_roundtrip": f"""
        WITH {_POSTS}
        SELECT scrape_date, primary_hashtag, count(*) AS posts,
               sum(engagement_score)::BIGINT AS engagement,
               sum(length(content))::BIGINT AS characters
        FROM posts GROUP BY scrape_date, primary_hashtag""",
    "repeated_batches": f"WITH {_POSTS} SELECT post_id, primary_hashtag, engagement_score FROM posts",
    "key_lookup": f"""
        WITH {_POSTS}
        SELECT post_id, primary_hashtag, engagement_score, content FROM posts
        ORDER BY engagement_score DESC, post_id LIMIT 10""",
    "engagement": f"WITH {_POSTS} SELECT post_id, engagement_score, scrape_date FROM posts",
    "entities": rf"""
        WITH {_POSTS}
        SELECT post_id, array_to_string({_words('content', '#')}, ' ') AS hashtags,
               array_to_string({_words('content', '@')}, ' ') AS mentions,
               regexp_matches(content, '^[{SPACE}]*@') AS is_reply
        FROM posts""",
    "count_labels": """
        SELECT CAST(event_id AS VARCHAR) AS post_id,
               CAST(floor(value * 100) AS BIGINT) AS like_count,
               user_id AS retweet_count, 0::BIGINT AS reply_count
        FROM events""",
    "cards": rf"""
        WITH {_POSTS}
        SELECT post_id, trim(username) AS username, timestamp, like_count, engagement_score, scrape_date,
               array_to_string({_words('content', '#')}, ' ') AS hashtags,
               regexp_matches(content, '^[{SPACE}]*@') AS is_reply
        FROM posts""",
    "lookback": f"""
        WITH {_POSTS}
        SELECT post_id, timestamp FROM posts
        WHERE timestamp >= (SELECT max(ts) FROM events) - INTERVAL '24 hours'""",
    "tag_cap": f"""
        WITH {_POSTS}
        SELECT post_id, primary_hashtag, timestamp FROM posts
        QUALIFY row_number() OVER (PARTITION BY primary_hashtag ORDER BY timestamp DESC, post_id)
                <= {_target('primary_hashtag')}""",
    "collected": f"""
        WITH {_POSTS},
        tags AS (
          SELECT DISTINCT primary_hashtag AS tag FROM posts
          UNION
          SELECT * FROM (VALUES {_configured(DEMO_TAGS.hashtags + DEMO_TAGS.cashtags)})),
        counted AS (
          SELECT t.tag, (SELECT count(*) FROM posts p WHERE p.primary_hashtag = t.tag) AS collected,
                 {_target('t.tag')} AS target
          FROM tags t)
        SELECT *, collected < target AS short_of_target FROM counted""",
    "exact_dedup": f"""
        WITH {_POSTS}, {_TWICE}, {_UNIQUE}
        SELECT post_id, primary_hashtag, engagement_score, length(content)::INTEGER AS n_chars
        FROM exact_posts""",
    "norm_text": f"""
        WITH {_POSTS} SELECT post_id, {_comparable('content')} AS comparable FROM posts""",
    "shingles": f"""
        WITH {_ARTICLES}, {_signed('articles')} SELECT post_id, shingle FROM shingle_sets""",
    "minhash": f"""
        WITH {_ARTICLES}, {_signed('articles')}
        SELECT post_id,
               concat_ws(',', {', '.join(f'm{i}' for i in range(_BANDS * _ROWS))}) AS signature,
               concat_ws(' ', {_band_list(_BANDS, _ROWS)}) AS buckets
        FROM signed""",
    "lsh_buckets": f"""
        WITH {_ARTICLES}, {_entries('articles')}
        SELECT bucket, arg_min(post_id, pos) AS leader, count(*) AS members
        FROM entries GROUP BY bucket""",
    "lsh_candidates": f"""
        WITH {_ARTICLES}, {_entries('articles')}
        SELECT bucket, post_id AS member,
               first_value(post_id) OVER (PARTITION BY bucket ORDER BY pos) AS leader,
               count(*) OVER (PARTITION BY bucket) AS members
        FROM entries
        QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY pos) > 1""",
    "lsh_candidates_080": f"""
        WITH {_ARTICLES}, {_entries('articles', LOOSE_SIGNATURE)}
        SELECT bucket, post_id AS member,
               first_value(post_id) OVER (PARTITION BY bucket ORDER BY pos) AS leader,
               count(*) OVER (PARTITION BY bucket) AS members
        FROM entries
        QUALIFY row_number() OVER (PARTITION BY bucket ORDER BY pos) > 1""",
    "near_dedup_080": f"""
        WITH RECURSIVE {_ARTICLES}, {_near('articles', LOOSE_SIGNATURE)}
        SELECT post_id, engagement_score FROM articles SEMI JOIN near_kept USING (post_id)""",
    "near_dedup_verified": f"""
        WITH RECURSIVE {_ARTICLES}, {_verified('articles', LOOSE_SIGNATURE)}
        SELECT post_id, engagement_score FROM articles
        WHERE post_id IN (SELECT post_id FROM near_kept)""",
    "jaccard_pairs": f"""
        WITH {_ARTICLES}, {_entries('articles', LOOSE_SIGNATURE)}, {_overlaps('firsts')},
        copied AS (SELECT f.post_id, count(*) AS copies FROM ranked r JOIN ranked f USING (comparable) SEMI JOIN firsts ON f.post_id = firsts.post_id GROUP BY f.post_id)
        SELECT a AS left_id, b AS right_id, round(jaccard, 6) AS jaccard, x.copies AS left_copies, y.copies AS right_copies
        FROM alike JOIN copied x ON x.post_id = a JOIN copied y ON y.post_id = b WHERE jaccard >= 0.8""",
    "near_dedup": f"""
        WITH RECURSIVE {_ARTICLES}, {_near('articles')}
        SELECT post_id, engagement_score FROM articles SEMI JOIN near_kept USING (post_id)""",
    "two_tier_dedup": f"""
        WITH RECURSIVE {_POSTS}, {_TWICE}, {_UNIQUE}, {_near('exact_posts')}
        SELECT post_id, primary_hashtag, engagement_score
        FROM exact_posts SEMI JOIN near_kept USING (post_id)""",
    "nfkc": f"""
        WITH {_POSTS} SELECT post_id, {_nfkc('content')} AS normalised FROM posts""",
    "emojis": f"""
        WITH {_POSTS}
        SELECT post_id, array_to_string({_emojis('content')}, ' ') AS emojis FROM posts""",
    "script_mix": f"""
        WITH {_POSTS}, {_cleaned('posts')}
        SELECT script, count(*) AS posts FROM cleaned GROUP BY script""",
    "cashtags": rf"""
        WITH {_POSTS}
        SELECT post_id, array_to_string(list_transform(
                 list_filter(regexp_extract_all(content, '\$([{WORD}]+)', 1),
                             lambda t: regexp_full_match(t, '[A-Za-z]{{2,10}}')),
                 lambda t: lower(t)), ' ') AS cashtags
        FROM posts""",
    "clean_text": f"""
        WITH {_POSTS}, {_cleaned('posts')} SELECT post_id, content_clean, script FROM cleaned""",
    "tag_norm": f"""
        WITH {_POSTS}, {_cleaned('posts')}
        SELECT post_id, lower(trim(username)) AS username,
               array_to_string(list_sort(list_distinct({_words('content', '#')})), ' ') AS hashtags
        FROM cleaned""",
    "sentiment": f"""
        WITH {_POSTS}, {_scored('posts')}
        SELECT post_id, {_round('sentiment_score')}, sentiment_label FROM scored""",
    "sentiment_split": f"""
        WITH {_POSTS}, {_scored('posts')}
        SELECT sentiment_label, count(*) AS posts FROM scored GROUP BY sentiment_label""",
    "tokens": f"""
        WITH {_TOKENS}
        SELECT post_id, array_to_string(tk, ' ') AS words, array_to_string(terms, ',') AS terms
        FROM term_lists""",
    "vocab": f"WITH {_VOCAB} SELECT term, tf, df FROM vocabulary",
    "tfidf": f"WITH {_TFIDF} SELECT post_id, term, {_round('weight')} FROM weights",
    "top_terms": f"""
        WITH {_TFIDF}, summed AS (SELECT term, sum(weight) AS score FROM weights GROUP BY term)
        SELECT term, {_round('score')} FROM summed
        ORDER BY summed.score DESC, term LIMIT {DEFAULT.terms.top_n}""",
    "signal_15m": f"""
        WITH {_POSTS}, {_scored('posts')}, {_buckets(DEFAULT.signal)}
        SELECT symbol, window_start, {_BUCKET}, tweet_count, total_engagement FROM buckets""",
    "signal_1d": f"""
        WITH {_POSTS}, {_scored('posts')}, {_buckets(DAILY)}
        SELECT symbol, window_start, {_BUCKET}, tweet_count, total_engagement FROM buckets""",
    "volume_z": f"""
        WITH {_POSTS}, {_scored('posts')}, {_signal(DAILY)}
        SELECT symbol, window_start, tweet_count, {_VOLUME} FROM signals""",
    "composite": f"""
        WITH {_POSTS}, {_scored('posts')}, {_signal(DEFAULT.signal)}
        SELECT {_ALL_SIGNAL} FROM signals""",
    "latest_signal": f"""
        WITH {_POSTS}, {_scored('posts')}, {_signal(DEFAULT.signal)}
        SELECT symbol, window_start, {_round('composite_score', 'ci_lower', 'ci_upper')}, tweet_count
        FROM signals
        QUALIFY signals.window_start = max(signals.window_start) OVER (PARTITION BY symbol)""",
    "signal_frame": f"""
        WITH {_POSTS}, {_scored('posts')}, {_signal(DAILY)}
        SELECT symbol, window_start, {_round('composite_score', 'ci_lower', 'ci_upper')}
        FROM signals WHERE symbol = 'view'""",
    "tag_report": f"WITH {_REPORT} SELECT * FROM report",
    "report_total": f"""
        WITH {_REPORT}
        SELECT sum(raw_collected)::BIGINT AS collected, sum(target)::BIGINT AS target,
               round(100.0 * sum(raw_collected) / sum(target), 1)::DOUBLE AS pct_of_target
        FROM report""",
    "shortfalls": f"""
        WITH {_REPORT}
        SELECT hashtag, target, raw_collected, target - raw_collected AS missing, pct_of_target
        FROM report WHERE raw_collected < target""",
    "report_markdown": f"""
        WITH {_REPORT},
        fixed(position, hashtag, line) AS (VALUES
          (0, '', '# Collection quality by tag'), (1, '', ''),
          (2, '', 'Goal: {DEMO_TAGS.posts_per_hashtag} posts for each of '
                  || '{', '.join(DEMO_TAGS.hashtags)} within {DEMO_TAGS.lookback_hours} hours.'),
          (3, '', ''), (20, '', ''),
          (21, '', '| Tag | Target | Collected | Of target | Kept | Bullish | Bearish | Neutral '
                   || '| Mean engagement |'),
          (22, '', '|---|---|---|---|---|---|---|---|---|'),
          (40, '', ''), (41, '', '## Tags below their target'), (42, '', ''))
        SELECT * FROM fixed
        UNION ALL
        SELECT 10, '', concat('All tags: ', sum(raw_collected)::BIGINT, ' of ', sum(target)::BIGINT,
                 ' posts (', round(100.0 * sum(raw_collected) / sum(target), 1)::DOUBLE, '%).')
        FROM report
        UNION ALL
        SELECT 30, hashtag, '| ' || concat_ws(' | ', '#' || hashtag, target, raw_collected,
                 coalesce(pct_of_target || '%', '-'), after_clean_dedup,
                 coalesce(pct_bullish || '%', '-'), coalesce(pct_bearish || '%', '-'),
                 coalesce(pct_neutral || '%', '-'), coalesce(avg_engagement::VARCHAR, '-')) || ' |'
        FROM report
        UNION ALL
        SELECT 50, hashtag, concat('- #', hashtag, ': ', target - raw_collected, ' of ', target,
                 ' posts missing.')
        FROM report WHERE raw_collected < target""",
    "top_posts": f"""
        WITH {_POSTS}
        SELECT post_id, primary_hashtag, engagement_score, content FROM posts
        ORDER BY engagement_score DESC, post_id LIMIT 50""",
    "reservoir": f"""
        WITH {_POSTS}
        SELECT post_id, engagement_score FROM posts
        ORDER BY {_SAMPLE_HASH}, post_id LIMIT {DEFAULT.sample.size}""",
    "scatter_frame": f"""
        WITH {_POSTS}, {_scored('posts')},
        sampled AS (
          SELECT * FROM scored ORDER BY {_SAMPLE_HASH}, post_id LIMIT {DEFAULT.sample.size})
        SELECT post_id, timestamp AS ts, {_round('sentiment_score')},
               least(engagement_score, 200) / 8.0::DOUBLE + 4 AS size,
               CASE WHEN sampled.sentiment_score > 0.2 THEN '#2e7d32'
                    WHEN sampled.sentiment_score < -0.2 THEN '#c62828' ELSE '#9e9e9e' END AS colour
        FROM sampled""",
    "full_run_signal": f"""
        WITH RECURSIVE {_POSTS}, {_TWICE}, {_UNIQUE}, {_near('exact_posts')},
        unique_posts AS (SELECT * FROM exact_posts SEMI JOIN near_kept USING (post_id)),
        {_scored('unique_posts')}, {_signal(DAILY)}
        SELECT {_ALL_SIGNAL} FROM signals""",
    "stream_ingest": f"""
        WITH {_POSTS}
        SELECT scrape_date, primary_hashtag, count(*) AS posts,
               sum(engagement_score)::BIGINT AS engagement,
               sum(len({_words('content', '#')}))::BIGINT AS tags
        FROM posts GROUP BY scrape_date, primary_hashtag""",
    "stream_dedup": f"""
        WITH {_POSTS}
        SELECT post_id, timestamp, length(content)::INTEGER AS n_chars, md5(content) AS content_md5 FROM posts""",
    "stream_signal": f"""
        WITH {_POSTS}, {_scored('posts')}, {_buckets(DEFAULT.signal, _CLOSED)}
        SELECT symbol, window_start, {_BUCKET}, tweet_count, total_engagement FROM buckets""",
    "stream_states": f"""
        WITH {_POSTS}, {_scored('posts')}, {_buckets(DEFAULT.signal)}
        SELECT symbol, window_start, {_BUCKET}, tweet_count, total_engagement FROM buckets""",
    "stream_volume": f"""
        WITH {_POSTS}, {_scored('posts')}, {_signal(DAILY, _CLOSED)}
        SELECT symbol, window_start, tweet_count, {_VOLUME}, {_round('composite_score')}
        FROM signals""",
}
