"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text.

One weight vector scores a document; ordered thresholds cut the score's line into grades:
P(grade >= k) = sigmoid(score - threshold[k]). The expected grade is the sum of these tail
probabilities, and a tail probability selects documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from logbrook.llm.common import documents, fields, utf8

BUCKETS = 1 << 20
SAMPLE_ROWS = 8192
#: A bucket gets a weight if it is in so many sampled rows, and if the share of some grade among them is
#: so many standard errors away from what is expected.
MIN_DOCUMENTS = 6
MIN_ERRORS = 4.0
#: Bytes of word beginnings that are features too, for words that share a stem.
HEADS = (4, 5, 6)
GRADES = 3
KEEP_FROM = 2
KEEP_TAIL = 0.5
SEED = 7

_WHITE = b" \t\n\x0b\x0c\r"
_SIGNS = b"#*$%&|<>"
_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256)
)


def _level(part: int, whole: int, steps: int = 12) -> int:
    """A share on a logarithmic scale, 0 for none."""
    return 0 if not part else 1 + min(int(-np.log2(part / max(whole, part))), steps)


def buckets(text: bytes) -> np.ndarray:
    """Sorted numbers of the features present: words, their beginnings, odd endings, and levels of some measures of form."""
    words = text.translate(_LOWER).split()
    distinct = set(words)
    heads = {b"\x02" + w[:size] for w in distinct for size in HEADS if len(w) > size}
    raw = text.split()
    ends = {b"\x03" + w[-2:] for w in set(raw) if w[-1] in _SIGNS + b"!?"}
    lines = [line for line in text.split(b"\n") if line.strip(_WHITE)]
    bare = len(text.translate(None, _WHITE))
    upper = bare - len(text.translate(None, _WHITE + bytes(range(65, 91))))
    signs = bare - len(text.translate(None, _WHITE + _SIGNS))
    form = {
        b"size": len(raw).bit_length(),
        b"signs": _level(signs, bare),
        b"bars": _level(text.count(b"|"), len(raw)),
        b"shouts": _level(text.count(b"!"), len(raw)),
        b"upper": _level(upper, bare),
        b"repeats": _level(sum(a == b for a, b in zip(raw, raw[1:])), len(raw)),
        b"lines": _level(len(lines) - len(set(lines)), len(lines)),
        b"distinct": _level(len(distinct), len(words)),
    }
    names = [b"\x01%s:%d" % item for item in form.items()]
    found = [*distinct, *heads, *ends, *names]
    return np.unique(np.fromiter(map(zlib.crc32, found), np.uint32, len(found)) % np.uint32(BUCKETS))


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds; threshold k parts grade k from k + 1."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, found: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1."""
        return _sigmoid(float(self.weights[found].sum(dtype=np.float64)) - self.thresholds)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(features: list[np.ndarray], grades: np.ndarray, grades_in_all: int = GRADES, steps: int = 300, ridge: float = 5e-4) -> OrdinalModel:
    """Maximum likelihood of the cumulative-link model with a ridge, by full-batch Adam.

    Buckets that tell nothing about the grades get no weight, else the many words of a long document
    would outweigh what is wrong with it. Without rows, or with one grade only, the thresholds alone
    carry the answer.
    """
    shares = np.array([(np.sum(grades >= k) + 0.5) / (len(grades) + 1) for k in range(1, grades_in_all)])
    thresholds = np.log((1 - shares) / shares)
    thresholds = np.maximum.accumulate(thresholds + np.arange(grades_in_all - 1) * 1e-3)
    weights = np.zeros(BUCKETS, np.float32)
    lengths = np.array([len(f) for f in features], np.int64)
    if not lengths.sum() or len(np.unique(grades)) < 2:
        return OrdinalModel(weights, thresholds)
    flat = np.concatenate(features).view(np.int32)
    rows = np.repeat(np.arange(len(features), dtype=np.int32), lengths)
    common = telling(flat, grades[rows].astype(np.int8))
    if not len(common):
        return OrdinalModel(weights, thresholds)
    place = np.full(BUCKETS, -1, np.int32)
    place[common] = np.arange(len(common))
    flat = place[flat]
    columns, rows = flat[flat >= 0], rows[flat >= 0]
    del flat
    value = np.concatenate((np.zeros(len(common)), [thresholds[0]], np.log(np.maximum(np.diff(thresholds), 1e-2))))
    first = np.zeros_like(value)
    second = np.zeros_like(value)
    n, cuts = len(grades), grades_in_all - 1
    for step in range(1, steps + 1):
        weight, cut = value[: len(common)], value[len(common)] + np.concatenate(([0], np.cumsum(np.exp(value[len(common) + 1 :]))))
        score = np.bincount(rows, weight[columns], minlength=n)
        tail = np.column_stack((np.ones(n), _sigmoid(score[:, None] - cut), np.zeros(n)))
        slope = tail * (1 - tail)
        here = np.arange(n)
        share = np.maximum(tail[here, grades] - tail[here, grades + 1], 1e-12)
        by_score = -(slope[here, grades] - slope[here, grades + 1]) / share
        by_cut = np.zeros((n, cuts + 2))
        by_cut[here, grades] += slope[here, grades] / share
        by_cut[here, grades + 1] -= slope[here, grades + 1] / share
        cut_gradient = by_cut[:, 1:-1].sum(axis=0)
        gaps = np.exp(value[len(common) + 1 :])
        gradient = np.concatenate(
            (
                np.bincount(columns, by_score[rows], minlength=len(common)) / n + ridge * weight,
                [cut_gradient.sum() / n],
                np.array([cut_gradient[k + 1 :].sum() for k in range(cuts - 1)]) * gaps / n,
            )
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        value = value - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights[common] = value[: len(common)]
    return OrdinalModel(weights, value[len(common)] + np.concatenate(([0], np.cumsum(np.exp(value[len(common) + 1 :])))))


def telling(flat: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Buckets that are frequent enough and whose rows differ in some grade's share.

    ``grades`` are those of the rows that ``flat`` was found in. A share is compared with that among
    all features found, so that long documents, which have more of them, are expected more often.
    """
    found = np.bincount(flat, minlength=BUCKETS)
    errors = np.zeros(BUCKETS)
    for grade in np.unique(grades):
        share = np.mean(grades == grade)
        here = np.bincount(flat[grades == grade], minlength=BUCKETS)
        spread = np.sqrt(np.maximum(found * share * (1 - share), 1e-9))
        errors = np.maximum(errors, np.abs(here - found * share) / spread)
    return np.flatnonzero((found >= MIN_DOCUMENTS) & (errors >= MIN_ERRORS))


def graded(labels: DataFrame) -> DataFrame:
    """One grade for each labelled document: 0 toxic, 1 of low quality, 2 good.

    Rows without a doc_id or without both labels are left out; of repeated labels the worst counts.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    rated = labels.select("doc_id", grade.alias("grade")).filter("doc_id IS NOT NULL AND grade IS NOT NULL")
    return rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, folds: Column | None = None) -> OrdinalModel:
    """Fit on at most ``sample_rows`` labelled documents, chosen by a seeded hash of their id.

    The sample's size is a parameter and does not grow with the input, so its ids are broadcast and
    its features (numbers of hashed buckets, no texts) are fitted on the driver. ``folds``
    restricts the labelled ids, for tests on held-out documents.
    """
    rated = graded(labels)
    if folds is not None:
        rated = rated.filter(folds)
    chosen = rated.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample_rows)
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [buckets(text).tobytes() for text in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("grade"), pa.array(found, pa.binary())], names=["doc_id", "grade", "found"])

    rows = joined.mapInArrow(features, "doc_id long, grade int, found binary").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda row: row["doc_id"])
    grades = np.array([r["grade"] for r in rows], np.int64)
    found = [np.frombuffer(r["found"], np.uint32) for r in rows]
    return fit(found, grades)


_ADDED = {"expected_grade": T.DoubleType(), "tail_1": T.DoubleType(), "tail_2": T.DoubleType(), "kept": T.BooleanType()}


def grade_documents(docs: DataFrame, model: OrdinalModel, text: str = "text") -> DataFrame:
    """Every row with expected_grade, tail_1 = P(grade >= 1), tail_2 = P(grade >= 2) and kept.

    Whole texts are scored; a null text is an empty one. Input columns called like an added one are
    replaced. ``kept``: tail_2 is KEEP_TAIL or more. No shuffle; the model (4 MB) is broadcast.
    """
    docs = docs.drop(*_ADDED)
    schema = fields(docs, **_ADDED)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tails = np.array([shared.value.tails(buckets(value)) for value in utf8(batch.column(text))]).reshape(-1, GRADES - 1)
            added = [tails.sum(axis=1), tails[:, 0], tails[:, 1], tails[:, KEEP_FROM - 1] >= KEEP_TAIL]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, added)], names=schema.names)

    return docs.mapInArrow(grade, schema)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades of all documents by a model fitted on labelled ones."""
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return grade_documents(docs.select("doc_id", "text"), model).select("doc_id", *_ADDED)
