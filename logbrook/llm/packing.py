"""Hierarchical multi-length packing of tokenised documents.

Context tiers are powers of two. A document gives as many full longest windows as it fills; what
is left is routed to the shortest tier that holds it. Tiers are packed from the longest down: each
left-over opens a window, whole left-overs of shorter tiers fill its gap, and the last bit of a gap
is filled by cutting one. Every sequence thus ends at a power of two, and equal numbers of tokens
of one tier form a step group.
"""

from __future__ import annotations

import os
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from codecs import charmap_decode
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from string import punctuation
from unicodedata import normalize

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from logbrook.llm.common import documents, utf8

TIERS = (256, 512, 1024, 2048)
TOKENIZER = "word_bpe_49k.json"
END_ID = 1
STEP_TOKENS = 1 << 16
#: Left-overs that wait before a task packs them; more give better fits, each needs up to 8 KB.
WAITING = 4096
#: Words that a worker keeps between texts, in each of two generations; about 45 MB in all.
CACHED = 120_000
_ID_BYTES = 4
_CHUNK = 1 << 22

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier long, step_group long"
)


class WordEncoder(dict):
    """Token ids of whole texts as little-endian 32-bit bytes, word by word with a bounded cache.

    The tokenizer's own splitting never joins what ASCII white space divides, so the ids of a
    text are those of its words in a row. Two generations of cached words, of which the young one is
    the dictionary itself, bound the memory.
    """

    def __init__(self, tokenizer: str, cached: int = CACHED):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(tokenizer if os.path.isabs(tokenizer) else public_tokenizers.path(tokenizer))
        self.pieces = self.model.model.tokenize
        self.id_bytes = [i.to_bytes(_ID_BYTES, "little") for i in range(self.model.get_vocab_size())]
        self.cached, self.old = cached, {}

    def encode(self, text: bytes) -> bytes:
        return b"".join(self._words(part) for part in chunks(text))

    def _words(self, text: bytes) -> bytes:
        if b"<|" not in text:  # special tokens are matched with their case
            text = text.lower()
        ids = b"".join(map(self.__getitem__, text.split()))
        if len(self) > self.cached:
            self.old = {w: i for w, i in self.items() if len(w) <= 64}
            self.clear()
        return ids

    def __missing__(self, word: bytes) -> bytes:
        """Ids of a word that the young generation does not have."""
        if word[-1] in _SIGNS and (base := word.rstrip(_SIGNS)):
            if ascii_plain(base) or (letters := base.decode()).isalpha() and stays_letter(letters[-1]):
                return self[base] + self[word[len(base) :]]  # letters, then signs: parts of the splitting rule
        ids = self.old.get(word)
        if ids is None:
            small = word if ascii_plain(word) else latin_letters(word.decode())
            if small:
                found = self.pieces(charmap_decode(small, "strict", _BYTE_LEVEL)[0])
                ids = b"".join([self.id_bytes[token.id] for token in found])
            else:
                (found,) = self.model.encode_batch_fast([word.decode()], add_special_tokens=False)
                ids = array("I", found.ids).tobytes()
        self[word] = ids
        return ids


def ascii_plain(word: bytes) -> bool:
    """Whether a word is nothing but small ASCII letters, which stand for themselves in the byte-level alphabet."""
    return word.isalpha() and word.islower()


def latin_letters(word: str) -> bytes | None:
    """A word of nothing but Latin letters as the tokenizer changes it, in small letters; None for any other.

    Up to U+024F every letter is as NFC leaves it, and one whose small letter is a single one has it wherever it stands.
    """
    if not word.isalpha() or max(word) >= "\u0250":
        return None
    small = word.lower()
    return small.encode() if len(small) == len(word) else None


@lru_cache(maxsize=1 << 16)
def stays_letter(letter: str) -> bool:
    """Whether NFC and lower-casing leave a single letter, so that no combining mark joins the sign behind it."""
    changed = {normalize("NFC", normalize("NFC", letter).lower()), normalize("NFC", letter.lower())}
    return all(len(c) == 1 and c.isalpha() for c in changed)


def _byte_level() -> str:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the others follow from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in visible else next(hidden)) for b in range(256))


_BYTE_LEVEL = _byte_level()
#: ASCII signs: neither letters nor digits nor white space, a run of them is one part of the splitting rule.
_SIGNS = punctuation.encode()


@lru_cache(maxsize=1)
def encoder_of(tokenizer: str) -> WordEncoder:
    """The encoder of a Python worker; tasks that share the worker share its cache."""
    return WordEncoder(tokenizer)


def chunks(text: bytes, size: int = _CHUNK) -> Iterator[bytes]:
    """A long text in parts that end at ASCII white space."""
    begin = 0
    while len(text) - begin > size:
        end = begin + size
        while end < len(text) and text[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield text[begin:end]
        begin = end
    yield text[begin:]


@dataclass(order=True)
class Rest:
    """Ids of a document from ``start`` on that no sequence has yet."""

    length: int
    number: int
    doc_id: int | None = field(compare=False)
    start: int = field(compare=False)
    doc_tokens: int = field(compare=False)
    ids: bytes = field(compare=False, repr=False)

    def cut(self, length: int) -> tuple[Rest, Rest]:
        at = length * _ID_BYTES
        return (
            Rest(length, self.number, self.doc_id, self.start, self.doc_tokens, self.ids[:at]),
            Rest(self.length - length, self.number, self.doc_id, self.start + length, self.doc_tokens, self.ids[at:]),
        )


class Packer:
    """Packs the documents of one task; ``first`` starts its sequence and step numbers."""

    def __init__(self, first: int, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS, waiting: int = WAITING):
        self.tiers, self.step_tokens, self.limit = tuple(sorted(tiers)), step_tokens, waiting
        self.sequence = self.step = first
        self.steps: dict[int, tuple[int, int]] = {}
        self.waiting: list[Rest] = []  # by length
        self.number = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total = len(ids) // _ID_BYTES
        self.number += 1
        rest = Rest(total, self.number, doc_id, 0, total, ids)
        while rest.length >= self.tiers[-1]:
            full, rest = rest.cut(self.tiers[-1])
            self._write([full])
        if rest.length:
            insort(self.waiting, rest)
        if len(self.waiting) >= self.limit:
            self.pack(last=False)

    def pack(self, last: bool) -> None:
        """Pack what waits. Unless ``last``, a quarter of it stays for better fits later."""
        stop = 0 if last else self.limit // 4
        while len(self.waiting) > stop:
            first = self.waiting.pop()
            tier = self.tiers[bisect_left(self.tiers, first.length)]
            window, gap = [first], tier - first.length
            while gap and self.waiting:
                at = bisect_right(self.waiting, gap, key=lambda rest: rest.length)
                if at:
                    window.append(self.waiting.pop(at - 1))
                else:
                    piece, rest = self.waiting.pop(0).cut(gap)
                    window.append(piece)
                    insort(self.waiting, rest)
                gap -= window[-1].length
            if gap:
                self._write_tail(window)
            else:
                self._write(window)

    def _write_tail(self, window: list[Rest]) -> None:
        """The last open window of a task, as sequences of falling powers of two."""
        while window:
            size = 1 << (sum(rest.length for rest in window).bit_length() - 1)
            sequence = []
            while size:
                rest = window.pop(0)
                if rest.length > size:
                    rest, later = rest.cut(size)
                    window.insert(0, later)
                sequence.append(rest)
                size -= rest.length
            self._write(sequence)

    def _write(self, window: list[Rest]) -> None:
        tier = sum(rest.length for rest in window)
        step, room = self.steps.get(tier, (0, 0))
        if room < tier:
            step, room = self.step, max(self.step_tokens, tier)
            self.step += 1
        self.steps[tier] = (step, room - tier)
        offset = 0
        for rest in window:
            self.rows.append(
                (rest.doc_id, rest.start, rest.length, zlib.crc32(rest.ids), rest.doc_tokens, self.sequence, offset, tier, step)
            )
            offset += rest.length
        self.sequence += 1


def pack_documents(docs: DataFrame, tokenizer: str = TOKENIZER, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of a document (doc_id, text) in a sequence; other columns are left out.

    A document is its ids and ``end_id``; a null or empty text is the end id alone. Repeated rows
    are packed one by one, a null doc_id stays null. Sequences fill a tier exactly; only the last
    open window of a task is written as shorter powers of two, so nothing is padded. Each task packs
    its own documents as it reads them: no shuffle, and a repeated task gives the same rows.
    ``sequence_id`` and ``step_group`` are unique across tasks, ``tier`` is the sequence's length;
    a step group holds sequences of one tier, STEP_TOKENS ids in all (the last of a task fewer).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer), end_id.to_bytes(_ID_BYTES, "little")
        packer = Packer(TaskContext.get().partitionId() << 32, tiers)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text"))):
                packer.add(doc_id, encoder.encode(text) + end)
                if len(packer.rows) >= 8192:
                    yield _rows(packer)
        encoder.old = {}  # a worker that goes on with other work keeps one generation at most
        packer.pack(last=True)
        yield _rows(packer)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def _rows(packer: Packer) -> pa.RecordBatch:
    names = [part.split()[0] for part in PIECES.split(", ")]
    columns = list(zip(*packer.rows)) or [()] * len(names)
    packer.rows = []
    return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in columns], names=names)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 256 to 2048 tokens."""
    return pack_documents(documents(spark, sf_dir))
