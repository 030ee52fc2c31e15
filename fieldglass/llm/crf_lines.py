"""Quality rules: lines labelled content or boilerplate by a linear-chain conditional random field.

The field has a weight per line feature (for content against boilerplate), a weight per pair of neighbouring
labels and one for the first label. Viterbi decoding finds the best labels of all lines of a document together; the share of the
document's word characters in content lines decides whether it is kept.

Weights are fitted on a bounded sample of labelled documents (``SAMPLE_DOCS`` documents with the smallest hash of their id). Of a
document of more than ``SAMPLE_LINES`` lines, three stretches count: its first lines, its last ones, and some from a place in
between that the hash of its text says. Labels of lines are estimated first: they start as their document's, and then follow a
logistic regression on all lines, while at least half of a document's lines keep its label. The fit maximises the
likelihood with the forward-backward recursion; the sample is the only data the driver sees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import record_batch, row_slices
from .text_features import LINE_FEATURES, line_features, lines_of

SAMPLE_DOCS = 3_000
SAMPLE_LINES = 30
#: Least share of word characters in content lines.
CONTENT_SHARE = 0.5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20


@dataclass(frozen=True)
class Field:
    """Emission weights, ``between[a, b]`` for label b after a, and the score of starting with content."""

    emission: np.ndarray
    between: np.ndarray
    start: float


#: Without labelled documents of both kinds every line is content.
ALL_CONTENT = Field(np.eye(1, len(LINE_FEATURES))[0] * 1.0, np.zeros((2, 2)), 0.0)


def viterbi(scores: list[float], field: Field) -> list[int]:
    """Best labels (1: content) for lines with these content scores; ties go to content."""
    (stay0, to1), (to0, stay1) = field.between.tolist()
    best0, best1 = 0.0, field.start
    back = []
    for at, score in enumerate(scores):
        if at:
            from0, from1 = best0 + to1, best1 + stay1
            low0, low1 = best0 + stay0, best1 + to0
            back.append((int(low1 >= low0), int(from1 >= from0)))
            best0, best1 = max(low0, low1), max(from0, from1)
        best1 += score
    if not scores:
        return []
    label = int(best1 >= best0)
    labels = [label]
    for came in reversed(back):
        label = came[label]
        labels.append(label)
    return labels[::-1]


def stretches(n: int, at: int) -> list[range]:
    """Lines of a document of ``n`` lines that the fit sees; ``at`` is any number and says where the middle ones lie."""
    if n <= SAMPLE_LINES:
        return [range(n)]
    size = SAMPLE_LINES // 3
    middle = size + at % (n - 3 * size + 1)
    return [range(size), range(middle, middle + size), range(n - size, n)]


def estimated_labels(features: list[np.ndarray], labels: list[int], rounds: int = 3, penalty: float = 1.0) -> list[np.ndarray]:
    """A label for each line: what a logistic regression on all lines says, but at least half of a document's lines keep its label."""
    x = np.concatenate(features)
    cuts = np.cumsum([len(f) for f in features])[:-1]
    lines = [np.full(len(f), y) for f, y in zip(features, labels)]
    ridge = np.full(x.shape[1], penalty)
    for _ in range(rounds):
        y, w = np.concatenate(lines), np.zeros(x.shape[1])
        for _ in range(15):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (y - p) - ridge * w)
        for i, score in enumerate(np.split(x @ w, cuts)):
            agrees = score if labels[i] else -score
            own = agrees >= 0
            own[np.argsort(-agrees, kind="stable")[: (len(own) + 1) // 2]] = True
            lines[i] = np.where(own, labels[i], 1 - labels[i])
    return lines


def fit(features: list[np.ndarray], labels: list[int], parts: list[list[range]] | None = None, rounds: int = 300, rate: float = 0.1, penalty: float = 1e-3) -> Field:
    """Fit on documents: a matrix of line features each, and the document's label. ``parts``: runs of rows that are neighbours.

    Needs documents of both labels, else every line is content.
    """
    parts = parts or [[range(len(f))] for f in features]
    used = [(f, y, p) for f, y, p in zip(features, labels, parts) if len(f)]
    if len({y for _, y, _ in used}) < 2:
        return ALL_CONTENT
    estimated = estimated_labels([f for f, _, _ in used], [y for _, y, _ in used])
    runs = [(f[r.start : r.stop], e[r.start : r.stop], r.start == 0) for (f, _, p), e in zip(used, estimated) for r in p]
    n, longest, width = len(runs), max(len(f) for f, _, _ in runs), len(LINE_FEATURES)
    x = np.zeros((n, longest, width))
    mask, y = np.zeros((n, longest)), np.zeros((n, longest))
    for i, (f, e, _) in enumerate(runs):
        x[i, : len(f)] = f
        mask[i, : len(f)] = 1
        y[i, : len(f)] = e
    begins = np.array([b for _, _, b in runs], float)
    both = mask[:, 1:]
    seen = np.array([[(both * (y[:, :-1] == a) * (y[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
    seen_emission = np.einsum("nlf,nl,nl->f", x, mask, y)
    w = np.zeros(width + 5)
    first, second = np.zeros_like(w), np.zeros_like(w)
    lines = mask.sum()
    for step in range(1, rounds + 1):
        between = w[width : width + 4].reshape(2, 2)
        score = np.stack([np.zeros((n, longest)), x @ w[:width]], axis=2)
        score[:, 0, 1] += w[-1] * begins
        forward = np.zeros((n, longest, 2))
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            moved = np.logaddexp(forward[:, t - 1, :1] + between[0], forward[:, t - 1, 1:] + between[1]) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None] > 0, moved, forward[:, t - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        backward = np.zeros((n, longest, 2))
        expected = np.zeros((2, 2))
        for t in range(longest - 2, -1, -1):
            ahead = score[:, t + 1] + backward[:, t + 1]
            moved = np.logaddexp(ahead[:, None, 0] + between[:, 0], ahead[:, None, 1] + between[:, 1])
            inside = mask[:, t + 1, None] > 0
            backward[:, t] = np.where(inside, moved, backward[:, t + 1])
            joint = forward[:, t, :, None] + between + ahead[:, None, :] - total[:, None, None]
            expected += (np.exp(np.minimum(joint, 0)) * inside[:, :, None]).sum(axis=0)
        content = np.exp(np.minimum(forward[:, :, 1] + backward[:, :, 1] - total[:, None], 0)) * mask
        gradient = np.concatenate([
            seen_emission - np.einsum("nlf,nl->f", x, content), (seen - expected).ravel(), [begins @ (y[:, 0] - content[:, 0])],
        ]) / lines - penalty * w
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        w += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field(w[:width], w[width : width + 4].reshape(2, 2), float(w[-1]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` labelled documents: those whose id has the smallest hash; of repeated labels the largest counts.

    The ids are bounded, so they are broadcast to the documents.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(most)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select("doc_id", "text", "label")


def sampled_features(docs: DataFrame, labels: DataFrame, label: str, most: int, make: Callable[[str | None], np.ndarray]) -> list[Row]:
    """Id, label and ``make``'s features of at most ``most`` labelled documents, sorted by id.

    Of rows that share an id the one whose text has the smallest hash counts; only it leaves a task, and minima are combined
    before the shuffle.
    """
    schema = pa.schema([("id", pa.int64()), ("label", pa.int32()), ("hash", pa.int64()), ("features", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for ids, texts, known, hashes in row_slices(batches):
            for i, text, y, hashed in zip(ids, texts, known, hashes):
                if i not in held or hashed < held[i][1]:
                    held[i] = (y, hashed, make(text))
        yield record_batch(schema, list(zip(*((i, *v) for i, v in held.items()))) or [[]] * len(schema))

    sample = labelled_sample(docs, labels, label, most).select(F.col("doc_id").cast("long"), "text", "label", F.xxhash64("text"))
    made = sample.mapInArrow(run, "id long, label int, hash long, features array<double>")
    one = made.groupBy("id").agg(F.min_by(F.struct("label", "features"), "hash").alias("one"))
    return sorted(one.select("id", "one.label", "one.features").collect(), key=lambda r: r.id)


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Field:
    """Fit on the labelled sample; ``docs`` needs doc_id and text, ``labels`` doc_id and the label (1: content)."""

    def make(text: str | None) -> np.ndarray:
        lines = line_features(lines_of(text))
        taken = stretches(len(lines), crc32((text or "").encode("utf-8", "replace")))
        return np.concatenate([[len(taken)], *(lines[r.start : r.stop].ravel() for r in taken)])

    rows = sampled_features(docs, labels, label, SAMPLE_DOCS, make)
    features = [np.array(r.features[1:]).reshape(-1, len(LINE_FEATURES)) for r in rows]
    parts = []
    for r, f in zip(rows, features):
        size = len(f) // int(r.features[0])
        parts.append([range(k * size, (k + 1) * size) for k in range(int(r.features[0]))])
    return fit(features, [r.label for r in rows], parts)


def judge(text: str | None, field: Field) -> tuple[int, int, int, int, int, bool, float, int, bool]:
    """Base measures, content share, number of content lines, and the verdict. A text without words has share 0."""
    lines = lines_of(text)
    failed = lines.n_words < LEAST_WORDS or 100 * lines.n_repeat_words > MOST_REPEATED_PERCENT * lines.n_words
    labels = np.array(viterbi((line_features(lines) @ field.emission).tolist(), field), np.int64)
    chars = lines.counts[:, 1:].sum(axis=1)
    share = float(chars @ labels) / lines.word_chars if lines.word_chars else 0.0
    kept = not failed and share >= CONTENT_SHARE
    return (lines.n_words, lines.word_chars, lines.n_symbols, lines.n_dup_lines, lines.n_repeat_words, failed, share, int(labels.sum()), kept)


VERDICT_SQL = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, n_content_lines long, kept boolean"
VERDICTS = pa.schema([("id", pa.int64()), *((c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), ("base_failed", pa.bool_()), ("content_share", pa.float64()), ("n_content_lines", pa.int64()), ("kept", pa.bool_())])


def label_documents(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its measures and verdict. Null texts have no words and fail; null and repeated ids stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in row_slices(batches):
            yield record_batch(VERDICTS, [ids, *zip(*(judge(t, field) for t in texts))] if ids else [[]] * len(VERDICTS))

    picked = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return picked.mapInArrow(run, "id long, " + VERDICT_SQL).withColumnRenamed("id", id_col)


def keep_content(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """The documents whose verdict is to keep them, with all their columns."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([judge(t.as_py(), field)[-1] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def line_labels(text: str | None, field: Field) -> list[tuple[str, int]]:
    """The lines that have a word, with their labels."""
    kept = [line for line in (text or "").split("\n") if line.strip(" \t\n\v\f\r")]
    return list(zip(kept, viterbi((line_features(lines_of(text)) @ field.emission).tolist(), field)))
