"""Personal data by weak supervision, with DataFrame functions only.

Candidates are the spans of a base pattern for each kind and, where those leave room, the spans of a
looser one. Labelers vote on each candidate: its pattern and checksum, its grouping, a gazetteer, the words
before it and the characters around it. Expectation-maximisation over the numbers of equal votes estimates
how reliable each labeler is, without any labelled example, and gives every candidate a probability.
With these as weights a final span classifier (naive Bayes over a span's shape, surroundings and votes)
is counted over all candidates of all documents; it decides which loose spans are added.

The driver holds the numbers of equal votes (at most 3**5 for each kind) and of feature values (at most
``_SHAPES`` + ``_WORDS`` and a few dozen for each kind), whatever the number of documents.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logbrook.llm.common import documents
from logbrook.session import written

KINDS = ("email", "ip", "card", "phone")

#: The base patterns. Possessive where nothing could be given back, so that no length of text nests
#: calls, and tied to where a run of characters begins, so that no run is tried from each of its characters.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Loose patterns: other spellings, and spans that a base pattern runs past.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
    r"(?:\.[A-Za-z0-9-]++|\x20?(?:\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Za-z.:])(?:(?:[0-9]{1,3}(?:\.|\[\.\]|\(\.\))){3}[0-9]{1,3}|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4})"
    r"(?![0-9A-Za-z:]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{9,}+)(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+])(?:(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)[\x20.-]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{4}"
    r"|[0-9]{1,4}([./-])[0-9]{1,2}\1[0-9]{1,4})(?![0-9A-Za-z])",
}

# Gazetteers and words of context: fixed values, in small letters.
TOP_DOMAINS = "com org net edu gov mil int info biz io co eu us uk de fr es it nl ch at be ca au in jp cn ru br mx test example"
COUNTRY_CODES = "1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 7 81 82 84 86 90 91 351 352 353 354 358 359 370 371 372 380 385 386 420 421 852 971 972"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|36|38|35|6011|65|62|50|5[6-9])"
CONTEXT = {
    "email": "email e-mail mail contact write reach courriel correo kontakt",
    "ip": "ip host server address client from adresse dirección",
    "card": "card visa mastercard amex credit debit payment carte tarjeta karte",
    "phone": "phone tel telephone call mobile cell fax whatsapp téléphone teléfono telefon",
}
OTHER_CONTEXT = "version section isbn order invoice chapter page serial part article figure table artikel seite página"

VOTERS = ("valid", "grouped", "listed", "context", "bounded")
FOR, AGAINST, NONE = "+", "-", "0"
#: Added counts that favour a labeler's being right, before any vote is seen; the check of ``valid`` weighs more.
RIGHT, RIGHT_IF_VALID = 4.0, 50.0
ROUNDS = 100
THRESHOLD = 0.9

_BEFORE, _AFTER = 40, 4
_SHAPES, _WORDS = 256, 64

_MATCH = "struct<start:int,stop:int,found:string,before:string,after:string>"
_HELD = "struct<start:int,stop:int,found:string,before:string>"


# ---- spans --------------------------------------------------------------------------------------


def spans_of(text: Column, pattern: str) -> Column:
    """All matches of a pattern, leftmost first, none overlapping: (start, stop, found, before, after), in code points.

    Gaps and matches come from two native scans of the text; places are running sums of their lengths.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_MATCH}>").alias("spans"), F.array().cast(f"array<{_HELD}>").alias("held"))

    def step(sums: Column, pair: Column) -> Column:
        start = sums["at"] + F.char_length(pair["gap"])
        stop = start + F.coalesce(F.char_length(pair["found"]), F.lit(0))
        ended = F.transform(
            sums["held"],
            lambda h: F.struct(
                h["start"].alias("start"), h["stop"].alias("stop"), h["found"].alias("found"), h["before"].alias("before"),
                F.left(pair["gap"], F.lit(_AFTER)).alias("after"),
            ),
        )
        new = F.struct(
            start.alias("start"), stop.alias("stop"), pair["found"].alias("found"),
            F.right(pair["gap"], F.lit(_BEFORE)).alias("before"),
        )
        held = F.when(pair["found"].isNotNull(), F.array(new)).otherwise(F.array().cast(f"array<{_HELD}>"))
        return F.struct(stop.alias("at"), F.concat(sums["spans"], ended).alias("spans"), held.alias("held"))

    return F.aggregate(pairs, nothing, step, lambda sums: sums["spans"])


def digits_of(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right: every second digit from the right counts twice, less 9 if above 9."""

    def step(total: Column, place: Column) -> Column:
        digit = F.substring(digits, -place, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def small_octets(found: Column) -> Column:
    """Whether all numbers between the dots are at most 255."""
    octet = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return found.rlike(rf"^{octet}(?:\.{octet}){{3}}$")


def passes(kind: str, found: Column) -> Column:
    """Whether a match of the base pattern passes the checks of its kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return small_octets(found)
    size = F.length(digits_of(found))
    if kind == "phone":
        return size.between(8, 15)
    return F.when(size.between(16, 19), luhn(digits_of(found))).otherwise(False)


# ---- labelers -----------------------------------------------------------------------------------


def _vote(right: Column, wrong: Column) -> Column:
    return F.when(right, FOR).when(wrong, AGAINST).otherwise(NONE)


def _among(words: str) -> str:
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(words.split())})(?![\p{{L}}\p{{N}}])"


def votes_of(kind: str, span: Column) -> Column:
    """The letters of the labelers' votes on a span, in the order of VOTERS."""
    found, never = span["found"], F.lit(False)
    digits = digits_of(found)
    size = F.length(digits)
    if kind == "email":
        last = F.lower(F.substring_index(F.regexp_replace(found, r"[)\]]\x20?", "."), ".", -1))
        valid = _vote(found.rlike(rf"^(?:{BASE[kind]})$") & last.rlike("^[a-z]{2,24}$"), last.rlike("^[0-9-]+$"))
        grouped = _vote(~found.rlike(r"^\.|\.\.|\.@|@-|-\."), F.lit(True))
        listed = _vote(last.isin(TOP_DOMAINS.split()), never)
    elif kind == "ip":
        whole = found.rlike(r"^[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}$")
        valid = _vote(whole | small_octets(found), found.rlike(r"^[0-9.]+$"))
        grouped = _vote(~found.rlike(r"(?:^|[^0-9])0[0-9]"), F.lit(True))
        first = F.regexp_extract(found, r"^([0-9]{1,3})(?![0-9A-Fa-f:])", 1)
        listed = _vote(first.rlike("^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])$"), first != "")
    elif kind == "card":
        fits = F.when(size.between(13, 19), luhn(digits)).otherwise(False)
        valid = _vote(fits, F.lit(True))
        grouped = _vote(found.rlike(r"^[0-9]{13,19}$|^[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"), F.lit(True))
        listed = _vote(digits.rlike(ISSUERS), F.lit(True))
    else:
        dated = found.rlike(r"^[0-9]{1,4}([./-])[0-9]{1,2}\1[0-9]{1,4}$")
        valid = _vote(found.startswith("+") & size.between(8, 15), dated | ~size.between(7, 15))
        grouped = _vote(found.rlike(r"\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-][0-9]{4}$"), dated)
        listed = _vote(found.rlike(rf"^\+(?:{'|'.join(COUNTRY_CODES.split())})[^0-9]"), never)
    context = _vote(span["before"].rlike(_among(CONTEXT[kind])), span["before"].rlike(_among(OTHER_CONTEXT)))
    glued = span["before"].rlike(r"[\p{L}\p{N}_=/#-]$") | span["after"].rlike(r"^[\p{L}\p{N}_=/-]")
    return F.concat(valid, grouped, listed, context, _vote(~glued, F.lit(True)))


def features_of(kind: str, span: Column, votes: Column) -> Column:
    """Named feature values of a span, each ``kind|name=value``; shapes and words are numbers of hashed buckets."""
    shape = F.regexp_replace(F.regexp_replace(span["found"], r"\p{L}+", "a"), "[0-9]", "9")
    shape = F.when(F.lit(kind == "email"), F.regexp_replace(shape, "[a9]+", "a")).otherwise(F.substring(shape, 1, 24))
    word = F.lower(F.regexp_extract(span["before"], r"([\p{L}\p{N}]+)[^\p{L}\p{N}]*$", 1))

    def side(text: Column) -> Column:
        return F.when(text == "", "end").when(text.rlike(r"^\s"), "space").when(text.rlike(r"^[\p{L}\p{N}]"), "word").otherwise("sign")

    values = {
        "shape": F.pmod(F.xxhash64(shape), F.lit(_SHAPES)),
        "digits": F.least(F.length(digits_of(span["found"])), F.lit(20)),
        "left": side(F.right(span["before"], F.lit(1))),
        "right": side(F.left(span["after"], F.lit(1))),
        "word": F.pmod(F.xxhash64(word), F.lit(_WORDS)),
        **{voter: F.substring(votes, number, 1) for number, voter in enumerate(VOTERS, 1)},
    }
    return F.array(*(F.concat(F.lit(f"{kind}|{name}="), value.cast("string")) for name, value in values.items()))


def candidates(docs: DataFrame) -> DataFrame:
    """Documents (doc_id) with ``base`` spans (kind, start, stop) and ``spans``: all candidates with votes and features.

    Base spans are in the order of KINDS and start. Loose spans that overlap a base span are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    def checked(kind: str) -> Callable[[Column], Column]:
        return lambda s: passes(kind, s["found"])

    def possible(kind: str, pattern: str) -> Column:
        # Every match has one of these characters; most texts have none, and are not scanned for the pattern.
        at = F.contains(text, F.lit("@"))
        if pattern == LOOSE["email"]:
            at = at | F.contains(text, F.lit("(at)")) | F.contains(text, F.lit("[at]"))
        needed = {"email": at, "ip": F.col("__digit") | F.contains(text, F.lit(":"))}
        return F.when(needed.get(kind, F.col("__digit")), spans_of(text, pattern)).otherwise(F.array().cast(f"array<{_MATCH}>"))

    found = docs.select("doc_id", "text", F.coalesce(F.col("text").rlike("[0-9]"), F.lit(False)).alias("__digit")).select(
        "doc_id",
        *(F.filter(possible(k, BASE[k]), checked(k)).alias(f"base_{k}") for k in KINDS),
        *(possible(k, LOOSE[k]).alias(f"loose_{k}") for k in KINDS),
    )

    def plain(kind: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))

    def judged(kind: str, spans: Column, is_base: bool) -> Column:
        def judge(voted: Column) -> Column:
            s, votes = voted["span"], voted["votes"]
            return F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), F.lit(is_base).alias("is_base"),
                votes.alias("votes"), features_of(kind, s, votes).alias("features"),
            )

        return F.transform(F.transform(spans, lambda s: F.struct(s.alias("span"), votes_of(kind, s).alias("votes"))), judge)

    found = found.withColumn("base", F.concat(*(plain(k, F.col(f"base_{k}")) for k in KINDS)))

    def apart(spans: Column) -> Column:
        return F.filter(spans, lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))

    every = [judged(k, F.col(f"base_{k}"), True) for k in KINDS] + [judged(k, apart(F.col(f"loose_{k}")), False) for k in KINDS]
    return found.select("doc_id", "base", F.concat(*every).alias("spans"))


# ---- the label model and the classifier -----------------------------------------------------------


def reliabilities(counts: dict[tuple[str, str], int]) -> tuple[dict[str, float], dict[str, dict]]:
    """Expectation-maximisation over (kind, votes) counts.

    Returns the probability of each ``kind|votes`` and, for each kind, the estimated ``prior`` and each
    labeler's chances of a vote on a false and a true span. Votes are independent given the truth. It begins
    from the majority of votes; added counts keep a labeler that never disagrees from being turned around.
    """
    chances, models = {}, {}
    for kind in sorted({kind for kind, _ in counts}):
        rows = [(votes, n) for (k, votes), n in sorted(counts.items()) if k == kind]
        true = [0.5 + 0.45 * (votes.count(FOR) - votes.count(AGAINST)) / len(VOTERS) for votes, _ in rows]
        for _ in range(ROUNDS):
            total = sum(n for _, n in rows)
            prior = (sum(n * p for (_, n), p in zip(rows, true)) + 1) / (total + 2)
            tables = []
            for place, voter in enumerate(VOTERS):
                right = RIGHT_IF_VALID if voter == "valid" else RIGHT
                table = {FOR: [1.0, right], AGAINST: [right, 1.0], NONE: [1.0, 1.0]}
                for (votes, n), p in zip(rows, true):
                    table[votes[place]][0] += n * (1 - p)
                    table[votes[place]][1] += n * p
                sums = [sum(pair[side] for pair in table.values()) for side in (0, 1)]
                tables.append({vote: (pair[0] / sums[0], pair[1] / sums[1]) for vote, pair in table.items()})
            odds = [
                math.log(prior / (1 - prior)) + sum(math.log(t[v][1] / t[v][0]) for t, v in zip(tables, votes)) for votes, _ in rows
            ]
            true = [1 / (1 + math.exp(-max(-500.0, min(500.0, o)))) for o in odds]
        chances |= {f"{kind}|{votes}": p for (votes, _), p in zip(rows, true)}
        models[kind] = {"prior": prior, **dict(zip(VOTERS, tables))}
    return chances, models


def span_weights(rows: list[tuple[str, float, float]]) -> dict[str, float]:
    """Naive Bayes weights by feature value, from (``kind|name=value``, true weight, false weight).

    ``kind`` alone is the prior's; ``kind|name`` is for values never seen, which count against a span.
    """
    names: dict[str, list] = {}
    for feature, true, false in rows:
        names.setdefault(feature.split("=", 1)[0], []).append((feature, true, false))
    weights = {}
    for name, values in names.items():
        all_true, all_false = (sum(v[side] for v in values) for side in (1, 2))
        size = len(values) + 1
        for feature, true, false in [*values, (name, 0.0, 0.0)]:
            weights[feature] = math.log((true + 0.5) / (all_true + 0.5 * size)) - math.log((false + 1) / (all_false + size))
        weights[name.split("|")[0]] = math.log((all_true + 1) / (all_false + 1))
    return weights


def _table(values: dict[str, float]) -> Column:
    """A literal map; its size is that of the model."""
    return F.from_json(F.lit(json.dumps(values)), "map<string,double>")


def train(found: DataFrame) -> tuple[dict[str, float], dict[str, dict]]:
    """Weights of the span classifier and the labelers' reliabilities, from all candidates."""
    spans = found.select(F.explode("spans").alias("span")).select("span.*")
    votes = {(row["kind"], row["votes"]): row["n"] for row in spans.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()}
    chances, models = reliabilities(votes)
    # Equal votes have equal chances, so features are counted with their votes first and weighed then.
    each = spans.select(F.concat_ws("|", "kind", "votes").alias("key"), F.explode("features").alias("feature"))
    true = F.try_element_at(_table(chances), F.col("key"))
    counted = each.groupBy("feature").agg(F.sum(true).alias("true"), F.sum(1 - true).alias("false")).orderBy("feature")
    return span_weights([(row["feature"], round(row["true"], 6), round(row["false"], 6)) for row in counted.collect()]), models


def chance_of(span: Column, weights: dict[str, float]) -> Column:
    """The classifier's probability that a candidate is what its kind says."""
    table = _table(weights)

    def add(total: Column, feature: Column) -> Column:
        unseen = F.try_element_at(table, F.substring_index(feature, "=", 1))
        return total + F.coalesce(F.try_element_at(table, feature), unseen, F.lit(0.0))

    odds = F.aggregate(span["features"], F.coalesce(F.try_element_at(table, span["kind"]), F.lit(0.0)), add)
    return 1 / (1 + F.exp(-odds))


def personal_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Personal data of every document: doc_id, ``base`` and ``spans``, arrays of (kind, start, stop).

    ``docs`` has doc_id and text; other columns are left out. Places are code points, ``stop`` is behind the
    span. A null or empty text has no spans; equal rows and null ids are rows of their own. ``base`` are the
    matches of the base patterns that pass their checks, leftmost and not overlapping within a kind.
    ``spans`` holds them and the loose spans that pass the checks of their kind, as far as these can be made, and
    that the classifier gives at least ``threshold``; both are in the order of kind (as in KINDS) and start. No documents give no rows. There is no shuffle of documents or spans: a
    document's spans stay in its row, and the model is summed on the map side first.
    """
    found = written(candidates(docs), "personal-candidates")
    weights, _ = train(found)

    def kept(span: Column) -> Column:
        return span["is_base"] | (~span["votes"].startswith(AGAINST) & (chance_of(span, weights) >= threshold))

    bare = F.transform(
        F.filter("spans", kept),
        lambda s: F.struct(
            F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("order"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind")
        ),
    )
    spans = F.transform(F.array_sort(bare), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    return found.select("doc_id", "base", spans.alias("spans"))


def spelled(spans: Column) -> Column:
    """``kind:start:stop`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents. The four numbers and the hash are those of the base spans; ``spans`` has the added ones too."""
    found = personal_spans(documents(spark, sf_dir))

    def of_kind(kind: str) -> Callable[[Column], Column]:
        return lambda s: s["kind"] == kind

    numbers = [F.size(F.filter("base", of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return found.select("doc_id", *numbers, F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"), added)
