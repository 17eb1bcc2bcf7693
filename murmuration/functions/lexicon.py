"""Market-slang sentiment from a small fixed lexicon, as plain column arithmetic."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms and emoji that decide the sentiment score.
BULLISH_TERMS = (
    "bullish", "buy", "long", "breakout", "rally", "surge", "upside", "target hit",
    "support held", "accumulate", "uptrend", "gap up", "all time high", "ath",
)
BEARISH_TERMS = (
    "bearish", "sell", "short", "breakdown", "crash", "correction", "downside",
    "resistance", "distribute", "downtrend", "gap down", "stop loss hit", "sl hit", "dump",
)
BULLISH_EMOJI = ("🚀", "📈", "🟢", "💚", "🔥")
# The third entry is a joined sequence; extracted emoji are single code points,
# so it never matches and its fire part counts as bullish.
BEARISH_EMOJI = ("📉", "🔴", "❤️‍🔥", "😰", "💀")
# Label bounds, right-closed.
BEARISH_UP_TO = -0.2
NEUTRAL_UP_TO = 0.2


def term_hits(text: Column) -> Column:
    """(bull, bear): how many terms of each kind the lower-cased text has.

    A term counts once however often it occurs, and also inside longer words. Python's substring search is
    several times faster than ``contains`` in the JVM, which tries every byte for every term. The function is local, see ``text.nfkc``.
    """
    bull, bear = BULLISH_TERMS, BEARISH_TERMS
    kind = pa.struct([("bull", pa.int32()), ("bear", pa.int32())])

    @F.arrow_udf("bull int, bear int")
    def counted(values: pa.Array) -> pa.Array:
        def hits(t: str | None) -> tuple[int, int] | None:
            if t is None:
                return None
            t = t.lower()
            return sum([term in t for term in bull]), sum([term in t for term in bear])

        some = (t for i in range(0, len(values), 256) for t in values.slice(i, 256).to_pylist())
        return pa.array(map(hits, some), kind)

    return counted(text)


def _emoji_hits(emojis: Column, wanted: tuple[str, ...]) -> Column:
    return F.size(F.filter(emojis, lambda e: e.isin(*wanted)))


def bull_hits(terms: Column, emojis: Column) -> Column:
    return terms["bull"] + _emoji_hits(emojis, BULLISH_EMOJI)


def bear_hits(terms: Column, emojis: Column) -> Column:
    return terms["bear"] + _emoji_hits(emojis, BEARISH_EMOJI)


def score_from_hits(bull: Column, bear: Column) -> Column:
    """Balance of hits in [-1, 1]; 0 without any hit."""
    total = bull + bear
    return F.when(total == 0, F.lit(0.0)).otherwise((bull - bear).cast("double") / total)


def label_of(score: Column) -> Column:
    return (
        F.when(score <= BEARISH_UP_TO, F.lit("bearish"))
        .when(score <= NEUTRAL_UP_TO, F.lit("neutral"))
        .when(score.isNotNull(), F.lit("bullish"))
    )
