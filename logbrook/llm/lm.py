"""Language-model scores: a log-bilinear model over word classes, trained with noise-contrastive estimation.

A word's probability is that of its class after the two classes before it, times its share of
the class. Frequent words are classes of their own; the others share classes by their first two
bytes. The log-bilinear part is trained in numpy on the class trigram counts of the whole training
text (their number is bounded by the classes, not by the corpus); one batched matrix product over
all class pairs then gives every normalised log-probability. Word shares come from counts of all
training tokens, which stay distributed: only the most frequent words are sent to the tasks.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from logbrook.llm.common import documents, utf8
from logbrook.session import written

#: The end token; no word holds white space.
END = b"\n"
SMOOTH = 0.1
FOLDS = 10
CLASSES = 128
OWN_CLASSES = 64
FREQUENT_WORDS = 65536
_FLUSH = 200_000
_COUNTS = "word binary, c long"
_TRIGRAMS = "code long, n long"
_ROWS = (
    "row long, doc_id long, word binary, n long, held_out boolean, n_tokens long, known long, "
    "base_part double, share_part double, class_part double"
)


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def held_out(doc_id: int | None) -> bool:
    """Whether a document is kept from training; an id of null counts as an empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == 0


def _texts(batches: Iterator[pa.RecordBatch], training: bool) -> Iterator[tuple[int | None, bytes]]:
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
            if not (training and held_out(doc_id)):
                yield doc_id, text


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all training tokens, the end token included; written, one row for each word."""

    def count(batches):
        found: Counter[bytes] = Counter()
        for _, text in _texts(batches, training=True):
            found.update(tokens(text))
            found[END] += 1
            if len(found) > _FLUSH:
                yield _counted(found)
                found = Counter()
        yield _counted(found)

    partial = docs.select("doc_id", "text").mapInArrow(count, _COUNTS)
    return written(partial.groupBy("word").agg(F.sum("c").alias("c")), "lm-counts")


def _counted(found: Counter[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found.keys()), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["word", "c"]
    )


@dataclass
class Lexicon:
    """Counts and classes of the most frequent words, and what the classes hold.

    Class 0 is the end token, the next ones are single words; a word of the later classes has
    the share (c + SMOOTH) / (class total) there, and one place is left for unknown words.
    """

    number: dict[bytes, int]
    counts: np.ndarray
    classes: np.ndarray
    log_total: np.ndarray | None = None

    @staticmethod
    def shared_class(word: bytes) -> int:
        return OWN_CLASSES + zlib.crc32(word[:2]) % (CLASSES - OWN_CLASSES)

    @classmethod
    def of(cls, frequent: list[tuple[bytes, int]]) -> Lexicon:
        words = [(END, 0), *((w, c) for w, c in frequent if w != END)]
        ends = dict(frequent).get(END, 0)
        classes = [k if k < OWN_CLASSES else cls.shared_class(w) for k, (w, _) in enumerate(words)]
        counts = [ends, *(c for _, c in words[1:])]
        return cls({w: k for k, (w, _) in enumerate(words)}, np.array(counts, np.int64), np.array(classes, np.int64))

    def class_of(self, word: bytes) -> int:
        number = self.number.get(word)
        return self.shared_class(word) if number is None else int(self.classes[number])

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(number or -1, class) of each word and the end, and the words that are not among the frequent."""
        get = self.number.get
        numbers = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        classes = np.append(self.classes[numbers], 0)
        rare = np.flatnonzero(numbers < 0)
        others = [words[k] for k in rare]
        classes[rare] = [self.shared_class(w) for w in others]
        return np.append(numbers, 0), classes, others


def read_lexicon(counts: DataFrame, frequent_words: int = FREQUENT_WORDS) -> Lexicon:
    """The ``frequent_words`` most frequent words (a bounded number), and totals of all classes over all words."""
    top = counts.orderBy(F.desc("c"), "word").limit(frequent_words).collect()
    ends = counts.filter(F.col("word") == F.lit(END)).collect()
    frequent = {bytes(r["word"]): r["c"] for r in [*top, *ends]}
    lexicon = Lexicon.of(list(frequent.items()))

    def classify(batches):
        for batch in batches:
            classes = [lexicon.class_of(w) for w in utf8(batch.column("word"))]
            yield pa.RecordBatch.from_arrays([pa.array(classes, pa.int64()), batch.column("c")], names=["class", "c"])

    sums = counts.mapInArrow(classify, "class long, c long").groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    totals, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in sums.collect():
        totals[row["class"]], kinds[row["class"]] = row["c"], row["v"]
    lexicon.log_total = np.log10(totals + SMOOTH * (kinds + 1))
    lexicon.log_total[:OWN_CLASSES] = 0
    return lexicon


def _contexts(classes: np.ndarray) -> np.ndarray:
    """Number of the pair of classes before each token; a text begins after two ends."""
    padded = np.concatenate(([0, 0], classes))
    return padded[:-2] * CLASSES + padded[1:-1]


def class_trigrams(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(code, n) of all class trigrams of the training text, at most CLASSES ** 3 rows."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def count(batches):
        sums = np.zeros(CLASSES**3, np.int64)
        for _, text in _texts(batches, training=True):
            _, classes, _ = shared.value.look_up(tokens(text))
            codes, n = np.unique(_contexts(classes) * CLASSES + classes, return_counts=True)
            sums[codes] += n
        codes = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums[codes])], names=["code", "n"])

    partial = docs.select("doc_id", "text").mapInArrow(count, _TRIGRAMS)
    return partial.groupBy("code").agg(F.sum("n").alias("n"))


def fit(trigrams: DataFrame) -> np.ndarray:
    """The trained table; one task trains, on counts whose number the classes bound."""

    def run(batches):
        table = pa.Table.from_batches(list(batches))
        codes, n = (table.column(name).to_numpy() for name in ("code", "n"))
        order = np.argsort(codes)
        yield pa.RecordBatch.from_arrays([pa.array([train(codes[order], n[order]).tobytes()], pa.binary())], names=["table"])

    if trigrams.isEmpty():
        return train(np.zeros(0, np.int64), np.zeros(0, np.int64))
    row = trigrams.coalesce(1).mapInArrow(run, "table binary").first()
    return np.frombuffer(row["table"], np.float32).reshape(-1, CLASSES)


def train(codes: np.ndarray, n: np.ndarray, width: int = 32, steps: int = 1000, batch: int = 2048, noise: int = 64, seed: int = 11) -> np.ndarray:
    """Table (class pair, class) of log10 probabilities; every row sums to one.

    Scores are context vector times class vector plus bias. Noise-contrastive estimation: each batch of
    trigrams, drawn by their counts, is told apart from classes drawn from the unigram noise.
    """
    rng = np.random.default_rng(seed)
    unigram = np.bincount(codes % CLASSES, n, CLASSES) + 1.0
    unigram /= unigram.sum()
    log_noise = np.log(noise * unigram)
    model = {
        "read": rng.normal(0, 0.1, (CLASSES, width)),
        "near": np.eye(width) + rng.normal(0, 0.05, (width, width)),
        "far": 0.5 * np.eye(width) + rng.normal(0, 0.05, (width, width)),
        "write": rng.normal(0, 0.1, (CLASSES, width)),
        "bias": np.log(unigram),
    }
    moments = {name: (np.zeros_like(v), np.zeros_like(v)) for name, v in model.items()}
    heap = np.cumsum(n, dtype=np.float64)
    eye = np.eye(CLASSES)
    for step in range(1, steps + 1 if len(codes) else 1):
        drawn = codes[np.minimum(np.searchsorted(heap, rng.random(batch) * heap[-1], "right"), len(codes) - 1)]
        one, two, word = drawn // CLASSES**2, drawn // CLASSES % CLASSES, drawn % CLASSES
        false = rng.choice(CLASSES, noise, p=unigram)
        far, near = model["read"][one], model["read"][two]
        context = far @ model["far"] + near @ model["near"]
        true_score = (context * model["write"][word]).sum(axis=1) + model["bias"][word] - log_noise[word]
        false_score = context @ model["write"][false].T + model["bias"][false] - log_noise[false]
        true_slope = -_sigmoid(-true_score) / batch
        false_slope = _sigmoid(false_score) / batch
        to_context = true_slope[:, None] * model["write"][word] + false_slope @ model["write"][false]
        words, falses = eye[word], eye[false]
        gradient = {
            "write": words.T @ (true_slope[:, None] * context) + falses.T @ (false_slope.T @ context),
            "bias": words.T @ true_slope + falses.T @ false_slope.sum(axis=0),
            "far": far.T @ to_context,
            "near": near.T @ to_context,
            "read": eye[one].T @ (to_context @ model["far"].T) + eye[two].T @ (to_context @ model["near"].T),
        }
        rate = 0.02 * min(1.0, 2 * (1 - step / (steps + 1)))
        for name, slope in gradient.items():
            first, second = moments[name]
            first += 0.1 * (slope - first)
            second += 0.01 * (slope**2 - second)
            model[name] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    context = (model["read"] @ model["far"])[:, None, :] + (model["read"] @ model["near"])[None, :, :]
    scores = context.reshape(-1, width) @ model["write"].T + model["bias"]
    scores -= scores.max(axis=1, keepdims=True)
    scores -= np.log(np.exp(scores).sum(axis=1, keepdims=True))
    return (scores / np.log(10)).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def score_documents(docs: DataFrame) -> DataFrame:
    """Base and model scores of every row (doc_id, text); other columns are left out.

    Learns from the rows outside the held-out fold. A null text is empty: its one token is the end.
    Repeated rows are counted and scored one by one. Without training rows all words are unknown and
    the classes are equally likely. Frequent words are looked up in the tasks; a document's
    other words are joined with the counts by word and summed up by document, so neither the
    vocabulary nor a document's words meet in one place.
    """
    spark, texts = docs.sparkSession, docs.select("doc_id", "text")
    counts = word_counts(texts)
    all_tokens, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    lexicon = read_lexicon(counts)
    table = fit(written(class_trigrams(texts, lexicon), "lm-trigrams"))
    shared = spark.sparkContext.broadcast((lexicon, table))

    def score(batches):
        lexicon, table = shared.value
        log_count = np.log10(lexicon.counts + SMOOTH)
        row = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        for doc_id, text in _texts(batches, training=False):
            numbers, classes, others = lexicon.look_up(tokens(text))
            found = numbers[numbers >= 0]
            in_shared = classes >= OWN_CLASSES
            from_shared = numbers[in_shared & (numbers >= 0)]
            rows.append(
                (
                    row,
                    doc_id,
                    None,
                    None,
                    held_out(doc_id),
                    len(numbers),
                    int((lexicon.counts[found] > 0).sum()),
                    float(log_count[found].sum()),
                    float(log_count[from_shared].sum() - lexicon.log_total[classes[in_shared]].sum()),
                    float(table[_contexts(classes), classes].sum(dtype=np.float64)),
                )
            )
            rows.extend((row, None, word, n, *[None] * 6) for word, n in Counter(others).items())
            row += 1
            if len(rows) >= 50_000:
                yield _as_batch(rows)
                rows = []
        yield _as_batch(rows)

    partial = written(texts.mapInArrow(score, _ROWS), "lm-rows")
    log_known = F.log10(F.coalesce(F.col("c"), F.lit(0)) + SMOOTH)
    others = (
        partial.filter("word IS NOT NULL")
        .select("row", "word", "n")
        .join(counts, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("other_known"),
            F.sum(F.col("n") * log_known).alias("other_part"),
        )
    )
    whole = partial.filter("word IS NULL").join(others, "row", "left").na.fill(0, ["other_known", "other_part"])
    base_total = F.lit(float(np.log10(all_tokens + SMOOTH * (kinds + 1))))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.col("other_known")).cast("long").alias("n_known"),
        F.lit(int(all_tokens)).cast("long").alias("train_tokens"),
        (F.col("base_part") + F.col("other_part") - F.col("n_tokens") * base_total).alias("base_score"),
        (F.col("class_part") + F.col("share_part") + F.col("other_part")).alias("score"),
    )


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "double": pa.float64()}
    names, types = zip(*(field.split() for field in _ROWS.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], names=list(names))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return score_documents(documents(spark, sf_dir))
