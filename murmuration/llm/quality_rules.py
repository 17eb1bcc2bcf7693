"""Quality rules: cross-document line frequency, after rules on single texts.

The lines of every text are normalised (lower case, single blanks, digits as 0) and hashed.
Per host (the column ``source``), a line's frequency is the number of documents with different texts that contain it:
exact copies of a document count once. Each of a document's own lines stands in all of its copies, so counted one by one they would
reject every text that was copied often, whatever its quality; copies are the business of dedup. A line above the
limit is removed, and a document that loses more than half of its words is
rejected. The limit is a number of documents, the same for every host: a verdict never gets better because a host grows.

Only hashes travel, never texts. Frequencies are combined per task before the shuffle, so a
line that a third of all documents share is no hot key; the join back is between narrow rows
that the adaptive join can split.

Edge cases: a null text has no words and fails the base rules; documents without source
share a host of their own; documents without id and repeated rows are judged row by row, very long texts whole; an empty
table gives no rows. Other columns are not read by ``judge``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from murmuration.llm.common import bounded_batches, sliced, texts_of
from murmuration.sources.scratch import Scratch

MIN_WORDS = 50
#: Largest share, in percent, of words within 3-word windows found twice or more.
MAX_REPEATED = 50
#: A line is boilerplate on a host that has it in more different texts.
LINE_TEXTS = 20
#: A document may lose this share of its words.
MAX_LOST = 0.5
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\v\f\r"
_DIGITS = {ord(c): "0" for c in "123456789"}
_MEASURED = (
    "row long, doc_id long, source string, text_hash long, n_words long, word_chars long, n_symbols long, "
    "n_dup_lines long, n_repeat_words long, lines array<struct<at:int,hash:long,words:int>>"
)


def normal_line(line: str) -> bytes:
    return b" ".join(line.lower().translate(_DIGITS).encode("utf-8", "replace").split())


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, of, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[of] > 1)
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[starts + k] = True
    return int(covered.sum())


def measure_text(text: str) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines)."""
    words = text.encode("utf-8", "replace").split()
    raw = text.split("\n")
    seen, lines = [], []
    for at, line in enumerate(raw):
        n = len(line.encode("utf-8", "replace").split())
        if n:
            seen.append(line)
            h = xxh3_64_intdigest(normal_line(line))
            lines.append({"at": at, "hash": h - (1 << 64) if h >> 63 else h, "words": n})
    chars = len(text) - sum(map(text.count, _SPACES))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(seen) - len(set(seen)), repeated_words(words), lines


def measured(docs: DataFrame) -> DataFrame:
    names = ["row", "doc_id", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines"]
    line = pa.list_(pa.struct([("at", pa.int32()), ("hash", pa.int64()), ("words", pa.int32())]))
    kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 6, line]

    def measure(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in sliced(batches):
            texts = texts_of(batch)
            found = [measure_text(t) for t in texts]
            hashes = np.array([xxh3_64_intdigest(t.encode("utf-8", "replace")) for t in texts], np.uint64).view(np.int64)
            columns = [np.arange(row, row + len(texts)), batch.column("doc_id"), batch.column("source"), hashes, *(zip(*found, strict=True) if found else [[]] * 6)]
            row += len(texts)
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    bounded_batches(docs.sparkSession)
    cast = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")]
    return docs.select(*cast).mapInArrow(measure, _MEASURED)


def judge(docs: DataFrame, line_texts: int = LINE_TEXTS, max_lost: float = MAX_LOST) -> DataFrame:
    """One row per document: doc_id, source, the base figures, base_failed, removed_lines (their
    places, from 0), n_removed_words and kept."""
    scratch = Scratch(docs.sparkSession, "quality")
    base = scratch.put(measured(docs), "measured")
    entries = base.select("row", "source", "text_hash", F.inline("lines"))
    texts_with = entries.groupBy("source", "hash", "text_hash").agg(F.lit(1).alias("one")).groupBy("source", "hash").agg(F.count(F.lit(1)).alias("texts"))
    common = texts_with.where(F.col("texts") > line_texts).select(F.col("source").alias("host"), F.col("hash").alias("common"))
    common = scratch.put(common, "common")
    hit = entries.join(common, (F.col("hash") == F.col("common")) & F.col("source").eqNullSafe(F.col("host")))
    lost = hit.groupBy(F.col("row").alias("_row")).agg(F.sum("words").alias("_lost"), F.sort_array(F.collect_list("at")).alias("_at"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    gone = F.coalesce(F.col("_lost"), F.lit(0))
    return (
        base.drop("lines")
        .join(lost, F.col("row") == F.col("_row"), "left")
        .select(
            "doc_id", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
            F.coalesce(F.col("_at"), F.array().cast("array<int>")).alias("removed_lines"), gone.alias("n_removed_words"),
            (~failed & (gone <= max_lost * F.col("n_words"))).alias("kept"),
        )
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """doc_id and text of the kept documents, without the removed lines; ids must be unique."""
    verdicts = judge(docs).where("kept").select("doc_id", "removed_lines")
    lines = F.filter(F.split("text", "\n", -1), lambda _, at: ~F.array_contains("removed_lines", at))
    whole = F.when(F.size("removed_lines") == 0, F.col("text")).otherwise(F.array_join(lines, "\n"))
    return docs.select("doc_id", "text").join(verdicts, "doc_id").select("doc_id", whole.alias("text"))


QUALITY_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS nth, doc_id, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts
), runs AS (
  SELECT nth, unnest(range(1, len(words) - 1)) AS place, words FROM split WHERE len(words) >= 3
), windows AS (
  SELECT nth, place, count(*) OVER (PARTITION BY nth, words[place], words[place + 1], words[place + 2]) AS times FROM runs
), repeats AS (
  SELECT nth, count(DISTINCT place + k) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY nth
), lines AS (
  SELECT nth, source, text, unnest(string_split(text, chr(10))) AS line FROM texts
), spoken AS (
  SELECT nth, source, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
         trim(regexp_replace(regexp_replace(lower(line), '[1-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g')) AS normal
  FROM lines
), filled AS (SELECT * FROM spoken WHERE n > 0
), dups AS (SELECT nth, count(*) - count(DISTINCT line) AS n FROM filled GROUP BY nth
), frequent AS (
  SELECT source, normal FROM filled GROUP BY source, normal
  HAVING count(DISTINCT text) > 20
), lost AS (
  SELECT nth, sum(f.n) AS n FROM filled f JOIN frequent q ON f.normal = q.normal AND f.source IS NOT DISTINCT FROM q.source GROUP BY nth
), figures AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(d.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(l.n, 0) AS lost
  FROM split s LEFT JOIN dups d USING (nth) LEFT JOIN repeats r USING (nth) LEFT JOIN lost l USING (nth)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost <= 0.5 * n_words AS kept
FROM figures
"""
