import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

# Spark pickles functions with its own copy, so that is the one in which tests register modules.
sys.modules["cloudpickle"] = cloudpickle

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
WORDS = "the of and to in river stone cloud house green walk sing light über café señor 山 tree, end. Zug".split()


def prose(rng, words):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", str(rng.randrange(99))]) for _ in range(words))


def hard_rows(seed=5):
    """Nulls, empty and long texts, copies, near copies, a shared passage, a hot source, repeated rows."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    base = prose(rng, 120)
    rows = [(i, prose(rng, rng.choice([1, 2, 3, 5, 60, 90])), "en", rng.choice(["a", "b", "Ä", None, "hot", "hot", "hot"])) for i in range(60)]
    rows += [(100 + i, base, "en", "hot") for i in range(7)]
    for i in range(8):
        words = base.split()
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((200 + i, " ".join(words), None, "b"))
    rows += [(300 + i, prose(rng, 40) + " " + passage + "\n" + prose(rng, 30), "en", "a") for i in range(5)]
    rows += [(400, None, None, None), (401, "", "en", "a"), (402, " \n\t ", "en", "empty"), (None, "no id " * 9, "en", "a")]
    rows += [(500, prose(rng, 9000), "en", "b"), (501, "ab. " * 900, "en", "b"), (502, "x" * 5000, "en", "c")]
    rows += [(503, "left\x0bright\x0cfar\x1cnot split \\ <| <|im_end|> \\\\|", "en", "c")]
    rows += [rows[3], rows[3], rows[-1]]
    return [(d, t, lang, s, None if t is None else len(t)) for d, t, lang, s in rows]


@pytest.fixture(scope="session")
def hard(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hard") / "documents.parquet")
    spark.createDataFrame(hard_rows(), SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
