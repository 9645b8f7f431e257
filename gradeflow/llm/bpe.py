"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last bytes cuts texts into chunks, so that passages which
documents share are cut alike wherever they stand.  Documents are dealt out by the least
hash of their chunks, which brings copies together, in partitions that Spark splits where
they grow too large.  In a partition each chunk is encoded once, however many documents
hold it.

A cut may fall into a word.  So a chunk is encoded between its first and its last white
space only, and a join is repaired by encoding the window around it anew, which grows
over further chunks until both of its ends stand at white space: there the tokenizer
never joins anything, so the window's tokens agree with those of the whole text.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that the rolling hash covers; a cut follows where its low bits are zero.
WINDOW, CUT_BITS = 16, 9
#: Bytes after which a chunk is cut anyway.
LONGEST = 1 << 14
#: Chunks and words that a worker remembers, and the longest such word.
CHUNKS, WORDS, WORD_LENGTH = 30_000, 500_000, 48
#: Words that are encoded in one call.
TOGETHER = 1000
#: White space at which the tokenizer never joins anything.
_SPACE = re.compile(r"[ \n\r\t]+")
#: Between a letter and one of these signs it never does either, so that a space there changes nothing.
_SIGN = re.compile(r"(?<=[a-zß-öø-ÿ])(?=[!#$%&()*+,\-./:;?@\[\\\]^_`{|}~])")

_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_WIDE = re.compile("[^\x00-\xff]")

_TABLE = np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32)
_BASE = 0x9E3779B1


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of UTF-8 data, each at the end of a character."""
    size = len(data)
    if not size:
        return []
    raw = np.frombuffer(data, np.uint8)
    rolled = _TABLE[raw]
    span, factor = 1, _BASE
    while span < WINDOW:
        # From the hash of ``span`` bytes to that of twice as many.
        wider = rolled.copy()
        wider[span:] += rolled[:-span] * np.uint32(factor)
        rolled, span, factor = wider, span * 2, factor * factor & 0xFFFFFFFF
    mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x85EBCA77)
    ends = np.flatnonzero(mixed >> np.uint32(32 - CUT_BITS) == 0) + 1
    ends = ends[ends < size]
    out, last = [], 0
    for end in [*ends.tolist(), size]:
        while end - last > LONGEST:
            last = _character(data, last + LONGEST)
            out.append(last)
        end = _character(data, end)
        if end > last:
            out.append(end)
            last = end
    return out


def _character(data: bytes, at: int) -> int:
    """The first end of a character from ``at`` on."""
    while at < len(data) and data[at] & 0xC0 == 0x80:
        at += 1
    return at


def chunks(text: str) -> list[str]:
    data = text.encode("utf-8")
    last, out = 0, []
    for end in cuts(data):
        out.append(data[last:end].decode("utf-8"))
        last = end
    return out


class Encoder:
    """A tokenizer, and the words and chunks that this worker has encoded."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.names = [self.library.id_to_token(i) for i in range(self.library.get_vocab_size())]
        self.ends = np.array([name.endswith("</w>") for name in self.names])
        self.digits = [str(i) for i in range(len(self.names))]
        self.words: dict[str, bytes] = {"": b""}
        self.chunks: dict[str, tuple[str | None, bytes, str]] = {}

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Encodes words that are not known; those that are too long to keep are returned."""
        new = [w for w in words if w not in self.words]
        if not new:
            return {}
        if len(self.words) > WORDS:
            self.words = {"": b""}
            new = list(words)
        letters = [w for w in new if _LETTERS.fullmatch(w)]
        others = [w for w in new if not _LETTERS.fullmatch(w)]
        made = self.library.encode_batch_fast(others, add_special_tokens=False)
        pairs = [*zip(others, [pack(encoding.ids) for encoding in made]), *self.encode_letters(letters)]
        long = {}
        for word, ids in pairs:
            (self.words if len(word) <= WORD_LENGTH else long)[word] = ids
        return long

    def encode_letters(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """Words of letters only, many in one text: each ends with the one token that ends a word."""
        for start in range(0, len(words), TOGETHER):
            some = words[start : start + TOGETHER]
            ids = np.array(self.library.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            ends = (np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize
            if len(ends) != len(some):
                raise ValueError("this tokenizer does not mark the ends of words")
            data, last = ids.tobytes(), 0
            for word, end in zip(some, ends.tolist()):
                yield word, data[last:end]
                last = end

    def encode_chunks(self, new: list[str]) -> None:
        """Remembers (head, body's tokens, tail) of chunks; head is null without white space."""
        bodies, words = {}, set()
        for chunk in new:
            first, last = _SPACE.search(chunk), None
            if first is None:
                self.chunks[chunk] = (None, b"", chunk)
                continue
            last = max(chunk.rfind(space) for space in " \n\r\t")
            split = plain(chunk[first.end() : last]).split(" ") if last > first.end() else []
            bodies[chunk] = (chunk[: first.start()], split, chunk[last + 1 :])
            words.update(split)
        long = self.learn(words)
        known = self.words
        for chunk, (head, split, tail) in bodies.items():
            body = b"".join([long[w] if w in long else known[w] for w in split])
            self.chunks[chunk] = (head, body, tail)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The token ids of each text."""
        cut = [chunks(text) for text in texts]
        needed = {chunk for own in cut for chunk in own}
        new = [chunk for chunk in needed if chunk not in self.chunks]
        if len(self.chunks) + len(new) > CHUNKS:
            self.chunks = {chunk: self.chunks[chunk] for chunk in needed if chunk in self.chunks}
        self.encode_chunks(new)
        words: set[str] = set()
        plans: list[list[list[str] | bytes]] = []
        for own in cut:
            plan: list[list[str] | bytes] = []
            window: list[str] = []
            for chunk in own:
                head, body, tail = self.chunks[chunk]
                if head is None:
                    window.append(tail)
                    continue
                window.append(head)
                plan += [plain("".join(window)).split(" "), body]
                window = [tail]
            plan.append(plain("".join(window)).split(" "))
            for window in plan[::2]:
                words.update(window)
            plans.append(plan)
        long = self.learn(words)
        known = self.words
        out = []
        for plan in plans:
            parts = [
                part if isinstance(part, bytes) else b"".join([long[w] if w in long else known[w] for w in part])
                for part in plan
            ]
            out.append(np.frombuffer(b"".join(parts), np.uint32))
        return out

    def decode(self, ids: list[int]) -> str:
        """The tokens' names with spaces between, as the library decodes without a decoder."""
        return " ".join([self.names[i] for i in ids])


def pack(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def plain(text: str) -> str:
    """The same to the tokenizer, with fewer different words: lower case, signs and white space apart.

    Only for characters of Latin-1, where lower case is one to one; not where special
    tokens may stand, which are told by case.
    """
    if "<|" not in text and _latin(text):
        text = _SIGN.sub(" ", text.lower())
    return _SPACE.sub(" ", text)


def _latin(text: str) -> bool:
    return text.isascii() or not _WIDE.search(text)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def nearby(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least hash of each text's chunks, equal for copies and most near copies."""
    for batch in batches:
        keys = []
        for text in batch.column(batch.schema.names.index("text")):
            data, last, least = text.as_py().encode("utf-8"), 0, (1 << 63) - 1
            for end in cuts(data):
                least = min(least, xxhash.xxh3_64_intdigest(data[last:end]) >> 1)
                last = end
            keys.append(least)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "key"])


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encoded(docs: DataFrame, path: str, texts: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row; ``texts`` adds ids and decoded.

    Tokens are those the library gives the whole text without added special tokens; ``path``
    names its file, on every executor.  A null text counts as empty: no tokens.  Repeated
    rows and null ids are encoded like any other; an empty table gives no rows; columns
    other than ``doc_id`` and ``text`` are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.mapInArrow(nearby, "doc_id long, text string, key long").hint("rebalance", "key")
    shape = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if texts:
        shape += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(path)
        for batch in batches:
            for part in (batch.slice(i, 200) for i in range(0, batch.num_rows, 200)):
                got = [ids.tolist() for ids in known.encode(part.column(1).to_pylist())]
                columns = [
                    part.column(0),
                    pa.array([len(ids) for ids in got], pa.int64()),
                    pa.array([sha256(" ".join([known.digits[i] for i in ids])) for ids in got]),
                    pa.array([sha256(known.decode(ids)) for ids in got]),
                ]
                if texts:
                    columns.append(pa.array(got, pa.list_(pa.int32())))
                    columns.append(pa.array([known.decode(ids) for ids in got]))
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return dealt.sortWithinPartitions("key").mapInArrow(run, shape)
