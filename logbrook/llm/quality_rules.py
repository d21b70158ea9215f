"""Line-first quality rules: judge lines, remove the failing ones, then judge what a document lost."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from logbrook.llm.common import documents, fields, utf8

WHITE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
SHOUTS = SYMBOLS + b"!"
PHRASES = (
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of service",
    "privacy policy",
    "accept cookies",
    "subscribe to our newsletter",
    "sign in",
    "skip to content",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the document rule.

    A line fails with more than ``symbol_percent`` of its word bytes in symbols or ``!``, with
    ``separators`` or more ``|`` (navigation), with a boilerplate phrase (ASCII case ignored), or as
    a repeat of an earlier line. A document fails that loses more than ``lost_percent`` of its word bytes.
    """

    symbol_percent: int = 5
    separators: int = 3
    phrases: tuple[str, ...] = PHRASES
    lost_percent: int = 60

    def fails(self, line: bytes, size: int) -> bool:
        signs = size - len(line.translate(None, WHITE + SHOUTS))
        if signs * 100 > self.symbol_percent * size or line.count(b"|") >= self.separators:
            return True
        low = line.lower()
        return any(phrase.encode() in low for phrase in self.phrases)


def clean_lines(text: bytes, rules: LineRules) -> tuple[bytes, int, int, int]:
    """The text without failing lines, its lines removed, and word bytes lost and in all.

    Lines without a word are kept and never count.
    """
    seen: set[bytes] = set()
    kept, removed, lost, total = [], 0, 0, 0
    for line in text.split(b"\n"):
        size = len(line.translate(None, WHITE))
        if size:
            total += size
            if line in seen or rules.fails(line, size):
                removed += 1
                lost += size
                seen.add(line)
                continue
            seen.add(line)
        kept.append(line)
    return b"\n".join(kept), removed, lost, total


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


_MEASURES = {
    "n_words": T.LongType(),
    "word_chars": T.LongType(),
    "n_symbols": T.LongType(),
    "n_dup_lines": T.LongType(),
    "n_repeat_words": T.LongType(),
    "base_failed": T.BooleanType(),
    "kept": T.BooleanType(),
    "n_removed_lines": T.LongType(),
    "n_removed_bytes": T.LongType(),
}


def measure(text: bytes, rules: LineRules) -> tuple:
    """The values of _MEASURES, and the cleaned text."""
    words = text.split()
    joined = text.translate(None, WHITE)
    lines = [line for line in text.split(b"\n") if line.strip(WHITE)]
    repeats = repeated_words(words)
    base_failed = len(words) < 50 or 100 * repeats > 50 * len(words)
    cleaned, removed, lost, total = clean_lines(text, rules)
    return (
        len(words),
        len(joined.decode()),
        len(joined) - len(joined.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeats,
        base_failed,
        not base_failed and lost * 100 <= rules.lost_percent * total,
        removed,
        lost,
        cleaned,
    )


def judge_documents(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """Every document with its measures, the verdict ``kept`` and ``cleaned``, the text without failing lines.

    Words are runs of anything but ASCII white space, lines end at ``\\n``; a null text has none of
    either and fails. Input columns called like an added one are replaced; all others, and every
    row, repeated or not, come through. No shuffle: a document is judged alone, whatever its length.
    """
    docs = docs.drop(*_MEASURES, "cleaned")
    schema = fields(docs, **_MEASURES, cleaned=T.StringType())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()] * 2 + [pa.string()]
        for batch in batches:
            columns = list(zip(*(measure(value, rules) for value in utf8(batch.column(text))))) or [()] * len(arrow)
            decoded = [value.decode() for value in columns[-1]]
            added = [pa.array(list(column), kind) for column, kind in zip([*columns[:-1], decoded], arrow)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return docs.mapInArrow(judge, schema)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the line-first verdict for all documents."""
    judged = judge_documents(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", *_MEASURES)


_BARE = r"regexp_replace({0}, '[\x20\x09-\x0D]+', '', 'g')"
_PHRASES = " OR ".join(f"contains(low, '{phrase}')" for phrase in PHRASES)

OP8_SQL = rf"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS text FROM documents
),
words AS (
  SELECT k, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    {_BARE.format("text")} AS bare
  FROM docs
),
windows AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM words WHERE len(words) >= 3)
),
repeats AS (
  SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest([i, i + 1, i + 2]) AS j FROM windows WHERE n > 1) GROUP BY k
),
lines AS (
  SELECT k, i, list[i] AS line FROM (
    SELECT k, string_split(text, chr(10)) AS list, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM docs)
  WHERE regexp_matches(list[i], '[^\x20\x09-\x0D]')
),
sized AS (
  SELECT k, line, strlen({_BARE.format("line")}) AS size,
    strlen(regexp_replace(line, '[^#*$%&|<>!]', '', 'g')) AS signs,
    strlen(regexp_replace(line, '[^|]', '', 'g')) AS bars,
    translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    row_number() OVER (PARTITION BY k, line ORDER BY i) > 1 AS again
  FROM lines
),
judged AS (
  SELECT k, count(*) FILTER (again) AS n_dup_lines, sum(size) AS total,
    count(*) FILTER (failed) AS n_removed_lines, coalesce(sum(size) FILTER (failed), 0) AS lost
  FROM (SELECT *, again OR signs * 100 > 5 * size OR bars >= 3 OR {_PHRASES} AS failed FROM sized) GROUP BY k
),
measured AS (
  SELECT doc_id, len(words) AS n_words, length(bare) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    coalesce(n_removed_lines, 0) AS n_removed_lines, coalesce(lost, 0) AS lost, coalesce(total, 0) AS total
  FROM words LEFT JOIN repeats r USING (k) LEFT JOIN judged USING (k)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND lost * 100 <= 60 * total AS kept,
  n_removed_lines, CAST(lost AS BIGINT) AS n_removed_bytes
FROM measured
"""
