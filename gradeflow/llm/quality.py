"""Document quality by a linear-chain conditional random field over lines.

Every line of a document is labelled good or bad.  A line's features are shares of kinds
of characters, repetition within the line and the document, lengths, and the same of the
lines before and after; each value falls into one of a few bins that were learnt as
quantiles, and a bin has a weight for "good".  Transitions between neighbouring lines
have weights too.  Forward and backward sums give each line's marginal probability; a
document's quality is their mean by length, calibrated on the examples.

Learning takes a bounded sample of labelled documents, whose lines carry their document's
label.  Only numbers, not texts, reach the driver.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm import labelled

#: Labelled documents to learn from, at most about this many; one in HOLD calibrates.
SAMPLE, HOLD = 4000, 4
THRESHOLD = 0.3
MODULUS, REMAINDER = 5, 0
BINS = 8
#: Steps of gradient descent, their size, and the pull of weights towards 0.
STEPS, RATE, PULL = 250, 0.15, 2e-4

OTHER, LOWER, UPPER, DIGIT, SPACE, POINT, EXCLAIM = range(7)
OWN = (
    "chars", "words", "word_length", "upper", "digit", "symbol", "exclaim", "point", "unique",
    "commonest", "same_before", "same_share", "ends",
)
#: Of the line before and the line after; a missing one counts as -1.
NEAR = ("chars", "upper", "symbol", "exclaim", "unique", "commonest", "same_share")
FEATURES = len(OWN) + 2 * len(NEAR)
_NEAR = [OWN.index(name) for name in NEAR]
_KNOWN = 0x3000


def _kinds() -> np.ndarray:
    kinds = np.full(_KNOWN + 1, LOWER, np.uint8)
    for code in range(_KNOWN):
        char = chr(code)
        category = unicodedata.category(char)
        if char == "!":
            kinds[code] = EXCLAIM
        elif char in ".,;:'\"?()-":
            kinds[code] = POINT
        elif char.isspace():
            kinds[code] = SPACE
        elif category in ("Lu", "Lt"):
            kinds[code] = UPPER
        elif category == "Nd":
            kinds[code] = DIGIT
        elif category[0] not in "LM":
            kinds[code] = OTHER
    return kinds


#: Kind of each character below U+3000; beyond, all count as letters.
KINDS = _kinds()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines that are more than white space, a row each, and their lengths."""
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    if not lines:
        return np.empty((0, FEATURES)), np.empty(0)
    lengths = np.array([len(line) for line in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = KINDS[np.minimum(codes, _KNOWN)]
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    counts = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(7)], axis=1)
    solid = np.maximum(1, lengths - counts[:, SPACE])
    letters = np.maximum(1, counts[:, LOWER] + counts[:, UPPER])
    own = np.zeros((len(lines), len(OWN)))
    repeated = Counter(lines)
    for i, line in enumerate(lines):
        words = line.split()
        seen = Counter(words)
        own[i, 1] = len(words)
        own[i, 8] = len(seen) / max(1, len(words))
        own[i, 9] = max(seen.values(), default=0) / max(1, len(words))
        own[i, 10] = i > 0 and line == lines[i - 1]
        own[i, 11] = (repeated[line] - 1) / len(lines)
        own[i, 12] = words[-1][-1] in ".!?" if words else 0
    own[:, 2] = solid / np.maximum(1, own[:, 1])
    own[:, 0], own[:, 1] = np.log1p(lengths), np.log1p(own[:, 1])
    own[:, 3] = counts[:, UPPER] / letters
    for column, kind in ((4, DIGIT), (5, OTHER), (6, EXCLAIM), (7, POINT)):
        own[:, column] = counts[:, kind] / solid
    out = np.full((len(lines), FEATURES), -1.0)
    out[:, : len(OWN)] = own
    out[1:, len(OWN) : len(OWN) + len(NEAR)] = own[:-1, _NEAR]
    out[:-1, len(OWN) + len(NEAR) :] = own[1:, _NEAR]
    return out, lengths.astype(np.float64)


@dataclass
class Field:
    """Weights of bins for "good", of transitions, and the calibration."""

    cuts: np.ndarray  # (features, BINS - 1)
    weights: np.ndarray  # (features * BINS + 1,), the last for every line
    moves: np.ndarray  # (2, 2), from and to bad (0) and good (1)
    slope: float = 1.0
    shift: float = 0.0
    prior: float = 0.5

    def bins(self, features: np.ndarray) -> np.ndarray:
        """Numbers of the weights of each line."""
        return np.stack(
            [np.searchsorted(self.cuts[f], features[:, f], side="right") + f * BINS for f in range(FEATURES)], axis=1
        )

    def emissions(self, bins: np.ndarray) -> np.ndarray:
        return self.weights[bins].sum(axis=1) + self.weights[-1]

    def mean_good(self, good: np.ndarray, lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return np.add.reduceat(good * lengths, starts) / np.add.reduceat(lengths, starts)

    def calibrated(self, mean: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * logit(mean) + self.shift)))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def marginals(emissions: np.ndarray, counts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the expected transitions of each chain, (chains, 2, 2).

    Lines of a chain follow each other; all chains go forward side by side, the longest
    to the end.
    """
    order = np.argsort(-counts, kind="stable")
    starts = (np.cumsum(counts) - counts)[order]
    sizes = counts[order]
    longest = int(sizes[0]) if len(sizes) else 0
    scores = np.stack([np.zeros(len(emissions)), emissions], axis=1)
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    for t in range(longest):
        at = starts[: active[t]] + t
        if t == 0:
            ahead[at] = scores[at]
        else:
            before = ahead[at - 1][:, :, None] + moves
            ahead[at] = np.logaddexp(before[:, 0], before[:, 1]) + scores[at]
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        after = (back[at + 1] + scores[at + 1])[:, None, :] + moves
        back[at] = np.logaddexp(after[:, :, 0], after[:, :, 1])
    total = np.logaddexp(*(ahead + back).T)
    good = np.exp(ahead[:, 1] + back[:, 1] - total)
    expected = np.zeros((len(counts), 2, 2))
    follows = np.ones(len(emissions), bool)
    follows[np.cumsum(counts) - counts] = False
    at = np.flatnonzero(follows)
    chain = np.repeat(np.arange(len(counts)), counts)[at]
    pairs = ahead[at - 1][:, :, None] + moves + (scores[at] + back[at])[:, None, :] - total[at][:, None, None]
    np.add.at(expected, chain, np.exp(pairs))
    return good, expected


def fit(features: np.ndarray, lengths: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Field:
    """Weights by gradient descent on the likelihood of lines that carry their document's label."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    tails = np.array([0.01, *quantiles[1:-1], 0.99]) if BINS > 3 else quantiles
    field = Field(np.quantile(features, tails, axis=0).T.copy(), np.zeros(FEATURES * BINS + 1), np.zeros((2, 2)))
    field.prior = float(labels.mean())
    calibrates = np.arange(len(counts)) % HOLD == 0
    line_of = np.repeat(np.arange(len(counts)), counts)
    learns = ~calibrates[line_of]
    bins = field.bins(features)
    _train(field, bins[learns], counts[~calibrates], labels[~calibrates])
    good, _ = marginals(field.emissions(bins), counts, field.moves)
    mean = field.mean_good(good, lengths, np.cumsum(counts) - counts)
    _calibrate(field, mean[calibrates], labels[calibrates])
    return field


def _train(field: Field, bins: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> None:
    chain = np.repeat(np.arange(len(counts)), counts)
    per_line = (1 / np.sqrt(counts))[chain] / len(counts)
    per_chain = 1 / np.sqrt(counts) / len(counts)
    truth = labels[chain].astype(np.float64)
    seen = np.zeros((len(counts), 2, 2))
    seen[:, 0, 0] = (counts - 1) * (labels == 0)
    seen[:, 1, 1] = (counts - 1) * (labels == 1)
    size = len(field.weights)
    first, second = np.zeros(size + 4), np.zeros(size + 4)
    for step in range(1, STEPS + 1):
        good, expected = marginals(field.emissions(bins), counts, field.moves)
        wrong = (good - truth) * per_line
        gradient = np.zeros(size + 4)
        np.add.at(gradient, bins.ravel(), np.repeat(wrong, FEATURES))
        gradient[size - 1] = wrong.sum()
        gradient[size:] = ((expected - seen) * per_chain[:, None, None]).sum(axis=0).ravel()
        gradient += PULL * np.concatenate([field.weights, field.moves.ravel()])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        if step > STEPS // 2:
            move *= 0.2
        field.weights -= move[:size]
        field.moves = field.moves - move[size:].reshape(2, 2)


def _calibrate(field: Field, mean: np.ndarray, labels: np.ndarray) -> None:
    """A logistic curve through the held-back examples, by Newton's method."""
    if not len(labels) or labels.min() == labels.max():
        return
    x, beta = np.stack([logit(mean), np.ones(len(mean))], axis=1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta -= np.linalg.solve(hessian, x.T @ (p - labels) + 1e-2 * (beta - [1, 0]))
    if beta[0] > 0:
        field.slope, field.shift = float(beta[0]), float(beta[1])


def learn(examples: DataFrame) -> Field | float:
    """The field of (doc_id, text, label) examples; their share of label 1 if that is all they tell."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [line_features(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([f.ravel().tobytes() for f, _ in rows], pa.binary()),
                    pa.array([n.tobytes() for _, n in rows], pa.binary()),
                ],
                ["doc_id", "label", "features", "lengths"],
            )

    measured = examples.mapInArrow(measure, "doc_id long, label int, features binary, lengths binary")
    rows = measured.orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().to_pylist()
    labels = np.array([r["label"] for r in rows], dtype=np.float64)
    if not len(labels) or labels.min() == labels.max():
        return float(labels.mean()) if len(labels) else 0.5
    with_lines = [r for r in rows if r["lengths"]]
    lengths = [np.frombuffer(r["lengths"]) for r in with_lines]
    features = np.concatenate([np.frombuffer(r["features"]).reshape(-1, FEATURES) for r in with_lines])
    counts = np.array([len(n) for n in lengths])
    own = np.array([r["label"] for r in with_lines], dtype=np.float64)
    field = fit(features, np.concatenate(lengths), counts, own)
    field.prior = float(labels.mean())
    return field


def scores_of(field: Field | float, texts: list[str]) -> np.ndarray:
    """Quality of each text, between 0 and 1."""
    if not isinstance(field, Field):
        return np.full(len(texts), field)
    out = np.full(len(texts), field.prior)
    measured = [line_features(text) for text in texts]
    counts = np.array([len(n) for _, n in measured])
    some = np.flatnonzero(counts)
    if len(some):
        features = np.concatenate([measured[i][0] for i in some])
        lengths = np.concatenate([measured[i][1] for i in some])
        good, _ = marginals(field.emissions(field.bins(features)), counts[some], field.moves)
        out[some] = field.calibrated(field.mean_good(good, lengths, np.cumsum(counts[some]) - counts[some]))
    return out


def score(docs: DataFrame, field: Field | float, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``docs`` but clashing ones, then score and predicted.

    A text that is null, empty or only white space has no lines; it gets the share of
    good examples.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                got = scores_of(shared.value, [t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(got, pa.float64()), pa.array((got >= threshold).astype(np.int32))],
                    [*part.schema.names, "score", "predicted"],
                )

    shape = docs.limit(0).selectExpr("*", "cast(null as double) as score", "cast(null as int) as predicted")
    return docs.mapInArrow(run, shape.schema)


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field | float:
    learnable = ~labelled.held_out(MODULUS, REMAINDER)
    return learn(labelled.sample(docs, labels, "quality", learnable, sample))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Only labels of ids that are not held out are learnt from, and of a bounded sample of
    them.  An empty table gives no rows; repeated rows and null ids are scored like any
    other; a null id counts as empty text for ``held_out``.  Without examples of both
    labels, every score is the share of label 1, a half without any.
    """
    field = trained(docs, labels, sample)
    rows = docs.select("doc_id", labelled.held_out(MODULUS, REMAINDER).alias("held_out"), "text")
    return score(rows, field).drop("text")
