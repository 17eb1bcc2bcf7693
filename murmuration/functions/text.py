"""Unicode-aware text expressions.

Character classes are spelled out because the usual shorthands differ between
regex engines: a word character is a letter, a number or "_" (combining marks
break words), and white space is the Unicode set.
"""

from __future__ import annotations

import re
from unicodedata import is_normalized, normalize

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"\p{L}\p{N}_"
ODD_SPACE = r"\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SPACE = " " + ODD_SPACE
# The same class for Java: Latin-1 members are one table look-up and the rest is
# only tried from U+1680 on.
_JAVA_SPACE = (
    r"[\t\n\x0B\f\r\x1C\x1D\x1E\x1F \x85\xA0"
    r"[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]]"
)
DEVANAGARI = r"\x{0900}-\x{097F}"

# Single code points that count as emoji (Unicode emoji 15.1
# without ASCII and without regional indicators), as hexadecimal ranges.
EMOJI_RANGES = """
00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2
25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A
262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697
2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1
26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721
2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935
2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E
1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397
1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570
1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC 1F5C2-1F5C4
1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 1F6CB-1F6D2
1F6D5-1F6D7 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A
1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FA88 1FA90-1FABD 1FABF-1FAC5 1FACE-1FADB 1FAE0-1FAE8
1FAF0-1FAF8
"""


def _as_class(ranges: str) -> str:
    parts = []
    for item in ranges.split():
        parts.append("-".join(rf"\x{{{end}}}" for end in item.split("-")))
    return "[" + "".join(parts) + "]"


EMOJI = _as_class(EMOJI_RANGES)
# Every emoji, keycap, flag and selector has a character of this short class; the
# long patterns only run on texts, and try only characters, that pass it.
_NEAR_EMOJI = r"[\xA9\xAE\x{203C}-\x{1FAF8}]"
_NEAR_SEQUENCE = r"[0-9#*\xA9\xAE\x{203C}-\x{1FAF8}]"
_SELECTORS = r"[\x{FE0E}\x{FE0F}]"
_TAGS = r"[\x{E0020}-\x{E007F}]"
# Keycaps, flags, then any emoji with selectors, tag characters and joined parts.
EMOJI_SEQUENCE = (
    rf"[0-9#*]\x{{FE0F}}?\x{{20E3}}"
    r"|[\x{1F1E6}-\x{1F1FF}]{2}"
    rf"|{EMOJI}{_SELECTORS}*{_TAGS}*(?:\x{{200D}}{EMOJI}{_SELECTORS}*)*"
    rf"|{_SELECTORS}"
)
URL = rf"http[^{SPACE}]+|www\.[^{SPACE}]+"
LOOSE_URL = rf"http[^{SPACE}]+"
# Runs that are not already a single blank, so ordinary blanks are not rewritten.
# Each starts with one class, which is all that most characters are tested for.
_SPACE_RUN = rf"{_JAVA_SPACE}(?:(?<! ){_JAVA_SPACE}*|{_JAVA_SPACE}+)"
_NON_WORD_RUN = rf"[^{WORD}](?:(?<! )[^{WORD}]*|[^{WORD}]+)"
EDGE_SPACE = rf"^[{SPACE}]+|[{SPACE}]+$"


def _python(pattern: str) -> re.Pattern:
    """A pattern of this module for Python, which spells code points otherwise."""
    return re.compile(re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: rf"\U{int(m[1], 16):08x}", pattern))


# EMOJI_SEQUENCE without keycaps, led by one class so that Python skips other characters fast.
_UNKEYED_SEQUENCE = (
    rf"{_NEAR_EMOJI}(?:(?<=[\x{{1F1E6}}-\x{{1F1FF}}])[\x{{1F1E6}}-\x{{1F1FF}}]"
    rf"|(?<={EMOJI}){_SELECTORS}*{_TAGS}*(?:\x{{200D}}{EMOJI}{_SELECTORS}*)*"
    rf"|(?<={_SELECTORS}))"
)


def has_non_ascii(text: Column) -> Column:
    """True when some character needs more than one byte; much cheaper than a regex."""
    return F.octet_length(text) != F.char_length(text)


def nfkc(text: Column) -> Column:
    """NFKC form. Spark has no built-in for it, so non-ASCII values alone go to Arrow.

    The function is local so that it is shipped by value: executors do not need
    this package. It takes the texts of a batch one by one and returns only those that change, so a worker holds little more
    than the batch itself.
    """

    @F.arrow_udf(T.StringType())
    def normalised(values: pa.Array) -> pa.Array:
        def changed(t: str | None) -> str | None:
            return None if t is None or is_normalized("NFKC", t) else normalize("NFKC", t)

        return pa.array((changed(v.as_py()) for v in values), pa.string())

    return F.coalesce(normalised(F.when(has_non_ascii(text), text)), text)


def cleaned(text: Column) -> Column:
    """(clean, near_emoji): ``nfkc``, ``strip_urls``, ``strip_emoji`` and ``squeeze_space`` in one Arrow step, and ``may_have_emoji`` of the raw text.

    As one step the text is decoded once; regular expressions of the JVM took most of the time of a post. As in ``nfkc``, the function is
    local and a worker holds a batch, its result and some texts in between.
    """
    url, near, unkeyed = _python(URL), _python(_NEAR_EMOJI), _python(_UNKEYED_SEQUENCE)
    keyed = _python(f"(?={_NEAR_SEQUENCE})(?:{EMOJI_SEQUENCE})")
    odd_space = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
    kind = pa.struct([("clean", pa.string()), ("near_emoji", pa.bool_())])

    @F.arrow_udf("clean string, near_emoji boolean")
    def one_pass(values: pa.Array) -> pa.Array:
        def clean(t: str | None) -> tuple[str, bool] | None:
            if t is None:
                return None
            may = False
            if not t.isascii():
                may = near.search(t) is not None
                t = normalize("NFKC", t)
            if "http" in t or "www." in t:
                t = url.sub("", t)
            if may:
                t = (keyed if "\u20e3" in t else unkeyed).sub("", t)
            for c in odd_space:  # a third of the time of a split and join
                if c in t:
                    t = t.replace(c, " ")
            while "  " in t:
                t = t.replace("  ", " ")
            return t.strip(" "), may

        some = (t for i in range(0, len(values), 256) for t in values.slice(i, 256).to_pylist())
        return pa.array(map(clean, some), kind)

    return one_pass(text)


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_SPACE, "")


def may_have_emoji(text: Column) -> Column:
    """False only for texts without any emoji, keycap, flag or selector, before and after NFKC."""
    return has_non_ascii(text) & text.rlike(_NEAR_EMOJI)


def _found(text: Column, guard: Column, pattern: str, group: int) -> Column:
    """All matches, without starting the regex engine where the guard rules them out."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return F.when(guard, matches).otherwise(F.array().cast("array<string>"))


def extract_emojis(text: Column, guard: Column | None = None) -> Column:
    """Each emoji code point of the text in order, repeats kept."""
    guard = may_have_emoji(text) if guard is None else guard
    return _found(text, guard, f"(?={_NEAR_EMOJI}){EMOJI}", 0)


def script_of(text: Column) -> Column:
    return (
        F.when(~has_non_ascii(text), F.lit("latin"))
        .when(~text.rlike(f"[{DEVANAGARI}]"), F.lit("latin"))
        .when(text.rlike("[a-zA-Z]"), F.lit("devanagari_mixed"))
        .otherwise(F.lit("devanagari"))
    )


def cashtags(text: Column) -> Column:
    pattern = rf"\$([A-Za-z]{{2,10}})(?![{WORD}])"
    return F.transform(_found(text, text.contains("$"), pattern, 1), F.lower)


def hashtags(text: Column) -> Column:
    return F.transform(_found(text, text.contains("#"), rf"#([{WORD}]+)", 1), F.lower)


def mentions(text: Column) -> Column:
    return F.transform(_found(text, text.contains("@"), rf"@([{WORD}]+)", 1), F.lower)


def is_reply(text: Column) -> Column:
    return text.rlike(rf"^[{SPACE}]*@")


def strip_urls(text: Column) -> Column:
    maybe = text.contains("http") | text.contains("www.")
    return F.when(maybe, F.regexp_replace(text, URL, "")).otherwise(text)


def strip_emoji(text: Column, guard: Column | None = None) -> Column:
    guard = may_have_emoji(text) if guard is None else guard
    without = F.regexp_replace(text, f"(?={_NEAR_SEQUENCE})(?:{EMOJI_SEQUENCE})", "")
    return F.when(guard, without).otherwise(text)


def squeeze_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def comparable_text(text: Column) -> Column:
    """Lower-cased words joined by single blanks: what near-duplicate matching compares."""
    lowered = F.lower(text)
    no_urls = F.when(
        lowered.contains("http"), F.regexp_replace(lowered, LOOSE_URL, " ")
    ).otherwise(lowered)
    return F.trim(F.regexp_replace(no_urls, _NON_WORD_RUN, " "))


def sorted_tag_set(tags: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(tags, F.lower)))


def count_from_label(label: Column) -> Column:
    """First number of a label such as "1,234 Likes"; 0 when there is none."""
    run = F.regexp_extract(label, r"([0-9\x{0966}-\x{096F},]+)", 1)
    digits = F.translate(F.replace(run, F.lit(","), F.lit("")), "०१२३४५६७८९", "0123456789")
    return F.coalesce(digits.try_cast("bigint"), F.lit(0).cast("bigint"))


def post_id_from_link(link: Column) -> Column:
    """Digits after "/status/"; null when the link has none."""
    return F.nullif(F.regexp_extract(link, "/status/([0-9]+)", 1), F.lit(""))
