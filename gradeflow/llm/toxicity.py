"""Toxicity by the nearest labelled examples under TF-IDF cosine.

Examples are a bounded sample of labelled documents.  Terms are all their words, and the first
letters of longer words, which inflected forms share, with how many there are; none is left out.  Each counts by its
TF-IDF weight, and the more the less chance explains how concentrated it is in toxic examples,
since over words that weigh alike the cosine of two texts says nothing about one insult.

An inverted index of the examples keeps the postings of a term in blocks of examples, and the
largest weight in each; terms of many examples have a full row.  The rows of a batch of documents
are multiplied at once.  With that a search adds up what cosine each block can reach, looks
into the postings of the most promising blocks, and then of all others that can still
improve on the k-th best, so that its neighbours are exact.  Their votes, weighted by distance, are calibrated on the
examples themselves, each left out of its own vote.

Terms are counted and votes are cast in Spark tasks.  The index is bounded by the sample, in
documents and in characters, and goes to every worker.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm import labelled

#: Labelled documents to learn from, at most about this many, with about so many characters.
SAMPLE, CHARACTERS = 3_000, 12_000_000
#: Letters that longer words are cut to for terms besides the words.
PREFIX = 4
NEIGHBOURS = 15
BLOCK = 64
#: Blocks that a search looks into at first.
FIRST = 4
#: A term of more than one in so many examples has a row of all their weights.
OFTEN = 12
#: Documents whose rows are multiplied at once.
BATCH = 128
THRESHOLD = 0.7
MODULUS, REMAINDER = 3, 1
#: Characters that are split into words at a time.
SLICE = 1 << 18

_WORD = re.compile(r"[^\W\d_]+")


def term_counts(text: str) -> dict[str, int]:
    """Lower-cased runs of letters and how often they occur, and terms for first letters.

    "abcd*" stands for any longer words that begin so, "abcd*2", "abcd*4" and so on for at
    least so many of them; each counts once.
    """
    words: Counter = Counter()
    lower = text.lower()
    start = 0
    while start < len(lower):
        stop = start + SLICE
        while stop < len(lower) and _WORD.match(lower[stop]):
            stop += 1
        words.update(_WORD.findall(lower, start, stop))
        start = stop
    begun: dict[str, int] = {}
    for word, n in words.items():
        if len(word) > PREFIX:
            prefix = word[:PREFIX]
            begun[prefix] = begun.get(prefix, 0) + n
    counts: dict[str, int] = dict(words)
    for prefix, n in begun.items():
        counts[prefix + "*"] = 1
        least = 2
        while least <= n:
            counts[f"{prefix}*{least}"] = 1
            least *= 2
    return counts


def chance(toxic: np.ndarray, total: np.ndarray, rate: float) -> np.ndarray:
    """The logarithm of Chernoff's bound on the probability of so many toxic ones among ``total``."""
    share = toxic / total
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(share > 0, share * np.log(share / rate), 0.0)
        b = np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - rate)), 0.0)
    return np.where(share > rate, -total * (a + b), 0.0)


class Index:
    """Examples by term: postings in blocks of examples, with each block's largest weight.

    ``term``, ``example`` and ``count`` say how often a term occurs in an example.
    """

    def __init__(self, terms: list[str], term: np.ndarray, example: np.ndarray, count: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.terms = {name: i for i, name in enumerate(terms)}
        self.rate = float(labels.mean()) if len(labels) else 0.0
        self.steps, self.values = np.zeros(1), np.zeros(1)
        total = np.bincount(term, minlength=len(terms)).astype(float)
        self.idf = np.log(1 + len(ids) / np.maximum(total, 1))
        if 0 < self.rate < 1 and len(terms):
            toxic = np.bincount(term, labels[example], minlength=len(terms))
            # Of so many terms some are concentrated by chance: those weigh like others.
            self.idf *= 1 + np.maximum(0, -chance(toxic, total, self.rate) - math.log(len(terms)))
        weight = (1 + np.log(count)) * self.idf[term]
        weight /= np.sqrt(np.bincount(example, weight * weight, minlength=len(ids)))[example]
        # Examples with the same heaviest term lie side by side, so that few blocks reach far.
        heaviest = np.zeros(len(ids), dtype=np.int64)
        order = np.lexsort((weight, example))
        heaviest[example[order]] = term[order]
        placed = np.lexsort((ids, heaviest))
        self.ids, self.labels = ids[placed], labels[placed]
        place = np.empty(len(ids), dtype=np.int64)
        place[placed] = np.arange(len(ids))
        example = place[example]
        order = np.lexsort((example, term))
        term, example, weight = term[order], example[order], weight[order]
        # Fewer rows than OFTEN times the terms of a mean example.
        often = np.flatnonzero(total * OFTEN > len(ids))
        self.row = np.full(len(terms), -1, dtype=np.int32)
        self.row[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), len(ids)))
        held = self.row[term] >= 0
        self.rows[self.row[term[held]], example[held]] = weight[held]
        term, example, weight = term[~held], example[~held], weight[~held]
        self.example, self.weight = example.astype(np.int32), weight
        self.size, self.blocks = BLOCK, -(-len(ids) // BLOCK)
        # A part is the postings of one term in one block.
        key = term * max(1, self.blocks) + example // BLOCK
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        self.start = np.r_[first, len(key)].astype(np.int32)
        self.block = (example[first] // BLOCK).astype(np.int32)
        self.largest = np.maximum.reduceat(weight, first) if len(first) else np.zeros(0)
        self.parts = np.searchsorted(term[first], np.arange(len(terms) + 1)).astype(np.int32)

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and weights of a document's known terms, of length one."""
        at = np.fromiter(map(self.terms.get, counts, repeat(-1)), np.int64, len(counts))
        n = np.fromiter(counts.values(), np.float64, len(counts))[at >= 0]
        at = at[at >= 0]
        if not len(at):
            return at, n
        weights = (1 + np.log(n)) * self.idf[at]
        return at, weights / math.sqrt((weights * weights).sum())

    def nearest_of(
        self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, but: list[int] | None = None
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each vector, cosines and places of the k nearest with a cosine above 0, ties to the smaller id.

        ``but`` are ids that are left out, one for each vector.
        """
        for start in range(0, len(vectors), BATCH):
            some = vectors[start : start + BATCH]
            often = np.zeros((len(some), len(self.rows)))
            for i, (at, weights) in enumerate(some):
                row = self.row[at]
                often[i, row[row >= 0]] = weights[row >= 0]
            cosines = often @ self.rows
            for i, (at, weights) in enumerate(some):
                rare = self.row[at] < 0
                yield self._nearest(at[rare], weights[rare], cosines[i], k, but[start + i] if but else None)

    def _nearest(self, at: np.ndarray, weights: np.ndarray, cosines: np.ndarray, k: int, but: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest, with the cosines as far as the full rows go."""
        if not len(cosines):
            return cosines, np.zeros(0, np.int64)
        out = self.ids == but if but is not None else None
        reach = np.maximum.reduceat(cosines, np.arange(0, len(cosines), self.size))
        parts, of = _ranges(self.parts[at], self.parts[at + 1])
        heavy = weights[of]
        block = self.block[parts]
        reach = reach + np.bincount(block, heavy * self.largest[parts], minlength=self.blocks)
        looked = np.zeros(self.blocks, dtype=bool)
        looked[np.argsort(-reach, kind="stable")[:FIRST]] = True
        whole = cosines + self._cosines(parts, heavy, looked[block])
        if out is not None:
            whole[out] = 0.0
        least = np.partition(whole, -k)[-k] if len(whole) > k else 0.0
        # A sum in another order may differ in its last digits.
        more = (reach > 0) & (reach >= least - 1e-9) & ~looked
        if more.any():
            whole += self._cosines(parts, heavy, more[block])
            if out is not None:
                whole[out] = 0.0
        whole = np.round(np.minimum(whole, 1.0), 12)
        found = np.flatnonzero(whole > 0)
        if len(found) > k:
            found = found[whole[found] >= np.partition(whole[found], -k)[-k]]
        found = found[np.lexsort((self.ids[found], -whole[found]))][:k]
        return whole[found], found

    def _cosines(self, parts: np.ndarray, heavy: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """What the chosen parts add to the cosines of all examples."""
        some = parts[chosen]
        postings, of = _ranges(self.start[some], self.start[some + 1])
        return np.bincount(self.example[postings], heavy[chosen][of] * self.weight[postings], minlength=len(self.ids))

    def vote(self, cosines: np.ndarray, found: np.ndarray) -> float:
        closeness = 1 / (1.05 - cosines)
        return float((closeness * self.labels[found]).sum() / closeness.sum())

    def calibrate(self, votes: np.ndarray, labels: np.ndarray) -> None:
        """Monotone steps through (vote, label) by pooling neighbours that are out of order."""
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []
        for vote, label in zip(votes[order], labels[order]):
            pools.append([vote, label, 1.0])
            while len(pools) > 1 and (
                pools[-2][0] == pools[-1][0] or pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2]
            ):
                last = pools.pop()
                pools[-1] = [max(pools[-1][0], last[0]), pools[-1][1] + last[1], pools[-1][2] + last[2]]
        # Half an example of either label, so that no score is certain.
        self.steps = np.array([p[0] for p in pools])
        self.values = np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])

    def scores(self, texts: list[str], k: int) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """For each text the calibrated score, and cosines and places of the neighbours that it rests on."""
        for cosines, found in self.nearest_of([self.vector(term_counts(t)) for t in texts], k):
            if not len(found) or not 0 < self.rate < 1:
                yield self.rate, cosines, found
            else:
                yield float(np.interp(self.vote(cosines, found), self.steps, self.values)), cosines, found


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges one after the other, and which range each is of."""
    sizes = (stop - start).astype(np.int64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    before = np.cumsum(sizes) - sizes
    return np.arange(len(of)) + (start - before)[of], of


def learn(examples: DataFrame, neighbours: int = NEIGHBOURS) -> Index:
    """The index of (doc_id, text, label) examples, all of them and all their terms.

    Without examples of both labels every score is the share of toxic ones, 0 without any.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [term_counts(text.as_py()) for text in batch.column(1)]
            terms = pa.array([list(c) for c in counts], pa.list_(pa.string()))
            times = pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), terms, times], ["doc_id", "label", "terms", "counts"])

    rows = examples.select("doc_id", "text", "label")
    counted = rows.mapInArrow(count, "doc_id long, label int, terms array<string>, counts array<int>").toArrow()
    counted = counted.sort_by("doc_id").combine_chunks()
    ids, labels = counted["doc_id"].to_numpy(), counted["label"].to_numpy().astype(np.float64)
    lists = counted["terms"].combine_chunks()
    sizes = np.asarray(lists.value_lengths()) if len(ids) else np.zeros(0, np.int64)
    encoded = lists.flatten().dictionary_encode()
    names = np.array(encoded.dictionary.to_pylist(), dtype=object)
    # Numbers by name: the same examples give the same index.
    order = np.argsort(names, kind="stable") if len(names) else np.zeros(0, np.int64)
    number = np.empty(len(names), dtype=np.int64)
    number[order] = np.arange(len(names))
    term = number[encoded.indices.to_numpy()] if len(names) else np.zeros(0, np.int64)
    times = counted["counts"].combine_chunks().flatten().to_numpy().astype(np.float64)
    index = Index(names[order].tolist(), term, np.repeat(np.arange(len(ids)), sizes), times, ids, labels)
    if not 0 < index.rate < 1:
        return index
    shared = examples.sparkSession.sparkContext.broadcast(index)

    def cast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shared.value
        for batch in batches:
            votes, own = [], []
            vectors = [learnt.vector(term_counts(text.as_py())) for text in batch.column(1)]
            each = learnt.nearest_of(vectors, neighbours, batch.column(0).to_pylist())
            for (cosines, found), label in zip(each, batch.column(2).to_pylist()):
                if len(found):
                    votes.append(learnt.vote(cosines, found))
                    own.append(float(label))
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), pa.array(own, pa.float64())], ["vote", "label"])

    votes = rows.mapInArrow(cast, "vote double, label double").toArrow()
    if votes.num_rows:
        index.calibrate(votes["vote"].to_numpy(), votes["label"].to_numpy())
    else:
        index.values = np.array([index.rate])
    return index


def score(docs: DataFrame, index: Index, neighbours: int = NEIGHBOURS, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` but clashing ones, then score, predicted and evidence.

    ``evidence`` lists the nearest examples: doc_id, cosine and label.  A text that is
    null, empty or without a term of any example gets the share of toxic examples, and no
    evidence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    docs = docs.drop("score", "predicted", "evidence")
    at = docs.columns.index("text")
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learnt = shared.value
        for batch in batches:
            scores, near = [], []
            texts = batch.column(at)
            # Texts are taken out of the batch a few at a time.
            parts = (texts.slice(i, BATCH).to_pylist() for i in range(0, len(texts), BATCH))
            for got, cosines, found in (one for part in parts for one in learnt.scores([t or "" for t in part], neighbours)):
                scores.append(got)
                near.append(
                    [
                        {"doc_id": int(learnt.ids[r]), "cosine": float(c), "label": int(learnt.labels[r])}
                        for c, r in zip(cosines, found)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()),
                    pa.array(near, evidence),
                ],
                [*batch.schema.names, "score", "predicted", "evidence"],
            )

    shape = docs.limit(0).selectExpr(
        "*",
        "cast(null as double) as score",
        "cast(null as int) as predicted",
        "cast(null as array<struct<doc_id: bigint, cosine: double, label: int>>) as evidence",
    )
    return docs.mapInArrow(run, shape.schema)


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Index:
    learnable = ~labelled.held_out(MODULUS, REMAINDER)
    return learn(labelled.sample(docs, labels, "toxic", learnable, sample, CHARACTERS))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every row of ``docs``.

    Only labels of ids that are not held out are learnt from, and of a bounded sample of
    them.  An empty table gives no rows; repeated rows and null ids are scored like any
    other; a null id counts as empty text for ``held_out``.
    """
    index = trained(docs, labels, sample)
    rows = docs.select("doc_id", labelled.held_out(MODULUS, REMAINDER).alias("held_out"), "text")
    return score(rows, index).drop("text")
