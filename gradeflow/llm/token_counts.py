"""Token counts by a two-tier lookup of pre-token lengths.

A pre-token is a run of spaces with what follows up to the next space.  No piece of the
vocabulary holds a space after another character, so a text's tokens are those of its
pre-tokens, one after another.  How many tokens a frequent pre-token has stands in a
table of bounded size that is broadcast; the others are encoded where they occur and
remembered by the worker, up to a bound.  No pre-token is ever shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents whose pre-tokens are counted to find frequent ones; their number in the table.
SAMPLE, FREQUENT = 2000, 50_000
#: Pre-tokens that a worker remembers, and the longest that it does, in characters.
REMEMBERED, LONGEST = 200_000, 64
#: Characters of a text that are split at a time.
SLICE = 1 << 18
SPACE = "▁"

_RUN = re.compile("(?<! ) ")
_models: dict = {}


def model(path: str):
    """The worker's copy of the tokenizer, read once."""
    if path not in _models:
        import sentencepiece

        _models[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _models[path]


def joins_spaces(path: str) -> bool:
    """Whether a piece holds a space after another character, or letters after two spaces."""
    pieces = model(path)
    for i in range(pieces.get_piece_size()):
        bare = pieces.id_to_piece(i).lstrip(SPACE)
        spaces = len(pieces.id_to_piece(i)) - len(bare)
        if SPACE in bare or (bare and spaces > 1):
            return True
    return False


def pre_tokens(text: str) -> Iterator[list[str]]:
    """Lists of pre-tokens of a text, each without its first space; "" is a lone space."""
    start, end = 0, len(text)
    text = text.replace(SPACE, " ")
    while start <= end and end:
        stop = end
        if end - start > SLICE:
            # Cut where a run of spaces begins, so that the run stays whole.
            found = _RUN.search(text, start + SLICE)
            stop = found.start() if found else end
        part = text[start:stop]
        if "  " not in part and not part.startswith(" ") and not part.endswith(" "):
            yield part.split(" ")
        else:
            yield _with_runs(part)
        start = stop + 1
        if stop == end:
            break


def _with_runs(part: str) -> list[str]:
    out, spaces = [], 0
    for word in part.split(" "):
        if word:
            out.append(" " * spaces + word)
            spaces = 0
        else:
            spaces += 1
    if spaces:
        out.append(" " * (spaces - 1))
    return out


def lengths(path: str, words: list[str]) -> list[int]:
    """Tokens of pre-tokens; the model puts the first space before each, except before ""."""
    return [len(ids) if word else 1 for word, ids in zip(words, model(path).encode(words, num_threads=1))]


def frequent(docs: DataFrame, path: str, sample: int, size: int) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of about ``sample`` documents.

    What the sample holds only decides how fast a pre-token is looked up.
    """
    share = min(1.0, sample / max(1, docs.count()))
    chosen = docs.filter(F.rand(11) < share).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for words in pre_tokens(text or ""):
                    seen.update(words)
        most = [w for w, _ in seen.most_common(size) if len(w) <= LONGEST]
        yield pa.RecordBatch.from_pydict(
            {"word": pa.array(most, pa.string()), "n": pa.array(lengths(path, most), pa.int32())}
        )

    table = chosen.repartition(1).mapInArrow(count, "word string, n int").toArrow()
    return dict(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))


def count_tokens(
    docs: DataFrame,
    path: str,
    limit: int = 4096,
    sample: int = SAMPLE,
    table_size: int = FREQUENT,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, tokens as sentencepiece gives them.

    ``path`` names a sentencepiece model, on every executor, that adds a space in front,
    keeps all spaces and has no piece over a space.  A null text counts as empty: no bytes, no tokens.
    Repeated rows and null ids are counted like any other; an empty table gives no rows;
    columns other than ``doc_id`` and ``text`` are ignored.
    """
    if joins_spaces(path):
        raise ValueError("the vocabulary has pieces over spaces")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs, path, sample, table_size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(shared.value)
        for batch in batches:
            counts = []
            for text in batch.column(1).to_pylist():
                total = 0
                for words in pre_tokens(text):
                    new = [w for w in set(words) if w not in known]
                    own = {}
                    if new:
                        own = dict(zip(new, lengths(path, new)))
                        if len(known) > remembered + table_size:
                            known = dict(shared.value)
                        known.update((w, n) for w, n in own.items() if len(w) <= LONGEST)
                    try:
                        total += sum(map(known.__getitem__, words))
                    except KeyError:
                        total += sum(own[w] if w in own else known[w] if w in known else lengths(path, [w])[0] for w in words)
                counts.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    sized = docs.select(F.col("doc_id").cast("long"), "text", F.octet_length("text").cast("long").alias("n_bytes"))
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
