"""Quality classifier: a document's own evidence combined with posteriors of its host and path.

1. Evidence: a logistic regression on text features, fitted on a bounded sample of labelled documents (``SAMPLE_DOCS``).
2. Grouped aggregation: number and sums of the evidence probabilities per path, then per host.
3. Empirical Bayes: the spread between hosts, and between paths of a host, in excess of what their sizes explain gives the
   strength of the priors (in documents). Hosts shrink toward the global rate and paths toward their host; sparse ones most.
4. A document's score is its own log odds plus the log odds of its path's posterior, without the document itself, relative to
   the global rate. What a site can add or take is bounded, so that it decides doubtful documents only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.sources.scratch import materialize

from .crf_lines import sampled_features
from .text_features import DOCUMENT_FEATURES, document_features, lines_of

SAMPLE_DOCS = 4_000
#: Most log odds that host and path can add or take.
SITE_BOUND = 2.0
#: Strength of a prior, in documents: at least, and at most when groups do not differ.
STRENGTH = (1.0, 1e6)


@dataclass(frozen=True)
class Evidence:
    weights: np.ndarray
    shift: np.ndarray
    scale: np.ndarray

    def log_odds(self, text: str | None) -> float:
        x = (document_features(lines_of(text)) - self.shift) / self.scale
        return float(np.clip(x @ self.weights, -20, 20))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, rounds: int = 30) -> Evidence:
    """Logistic regression by Newton steps. With one label only, or none, everything is likely good."""
    width = len(DOCUMENT_FEATURES)
    if len(np.unique(y)) < 2:
        return Evidence(np.eye(1, width)[0] * 4.0, np.zeros(width), np.ones(width))
    shift, scale = x.mean(axis=0), x.std(axis=0)
    shift[0], scale[scale < 1e-9] = 0, 1
    x = (x - shift) / scale
    w, ridge = np.zeros(width), np.full(width, penalty)
    ridge[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), slope)
    return Evidence(w, shift, scale)


def fit_on(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Evidence:
    """Fit on at most ``SAMPLE_DOCS`` labelled documents; ``docs`` needs doc_id and text."""
    rows = sampled_features(docs, labels, label, SAMPLE_DOCS, lambda text: document_features(lines_of(text)))
    return fit(np.array([r.features for r in rows]).reshape(-1, len(DOCUMENT_FEATURES)), np.array([r.label for r in rows]))


#: Names of added columns; no column of a document may have one of them.
EVIDENCE, HOST, PATH, SIZE, GOOD, RATE = ("_site_" + c for c in ("evidence", "host", "path", "n", "good", "rate"))


def with_evidence(docs: DataFrame, model: Evidence, columns: list[str], text_col: str = "text") -> DataFrame:
    """The given columns of ``docs`` and the log odds of the document's own text."""
    read = columns if text_col in columns else [*columns, text_col]
    at = read.index(text_col)
    kinds = docs.select(*[F.col(f"`{c}`") for c in columns]).schema.add(EVIDENCE, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([model.log_odds(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], found], names=[*columns, EVIDENCE])

    return docs.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, kinds)


def _odds(p: Column) -> Column:
    kept = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(kept / (1 - kept))


def _strength(groups: DataFrame, mean: str, toward: str) -> float:
    """Prior strength by moments: variance of group means around ``toward`` beyond the sampling variance within groups."""
    centre = F.col(toward)
    row = groups.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * (F.col(mean) - centre) ** 2).alias("spread"),
        F.sum(F.col("squares") / F.col("n") - F.col(mean) ** 2).alias("noise"),
        F.sum(F.col("n") * centre * (1 - centre)).alias("whole"),
    ).first()
    if not row.n:
        return STRENGTH[1]
    between = row.spread / row.n - row.noise / row.n
    return float(np.clip(row.whole / row.n / between - 1, *STRENGTH)) if between > 0 else STRENGTH[1]


@dataclass(frozen=True)
class Sites:
    """Per host and path: number, sum of probabilities, the host's posterior; the global rate and the strength of path priors."""

    paths: DataFrame
    rate: float
    path_strength: float


def sites(evidence: DataFrame, host: str, path: str) -> Sites:
    """Posteriors from a table with evidence. A null host or path is a group of its own; sums are combined before the shuffle."""
    p = 1 / (1 + F.exp(-F.col(EVIDENCE)))
    sums = [F.count("*").cast("double").alias("n"), F.sum(p).alias("good"), F.sum(p * p).alias("squares")]
    by_path = materialize(evidence.groupBy(F.col(f"`{host}`").alias(HOST), F.col(f"`{path}`").alias(PATH)).agg(*sums), "paths")
    total = by_path.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = total.good / total.n if total.n else 0.5
    by_host = by_path.groupBy(HOST).agg(*[F.sum(c).alias(c) for c in ("n", "good", "squares")])
    means = by_host.select("*", (F.col("good") / F.col("n")).alias("mean"), F.lit(rate).alias("rate"))
    strength = _strength(means, "mean", "rate")
    posterior = (F.col("good") + F.lit(strength * rate)) / (F.col("n") + F.lit(strength))
    hosts = by_host.select(F.col(HOST).alias("of"), posterior.alias(RATE))
    paths = materialize(by_path.join(hosts, F.col(HOST).eqNullSafe(F.col("of"))).drop("of"), "path-rates")
    inner = paths.select("n", "squares", RATE, (F.col("good") / F.col("n")).alias("mean"))
    slim = paths.select(HOST, PATH, F.col("n").alias(SIZE), F.col("good").alias(GOOD), RATE)
    return Sites(slim, rate, _strength(inner, "mean", RATE))


def score_columns(found: Sites) -> tuple[Column, Column]:
    """Path rate without the row itself, and the score, for rows joined with their path."""
    p = 1 / (1 + F.exp(-F.col(EVIDENCE)))
    strength = F.lit(found.path_strength)
    others = (F.col(GOOD) - p + strength * F.col(RATE)) / (F.col(SIZE) - 1 + strength)
    site = _odds(others) - _odds(F.lit(found.rate))
    return others, F.col(EVIDENCE) + F.least(F.greatest(site, F.lit(-SITE_BOUND)), F.lit(SITE_BOUND))


def _joined(evidence: DataFrame, found: Sites, host: str, path: str) -> DataFrame:
    same = F.col(f"`{host}`").eqNullSafe(F.col(HOST)) & F.col(f"`{path}`").eqNullSafe(F.col(PATH))
    return evidence.join(found.paths, same, "left")


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", id_col: str = "doc_id") -> DataFrame:
    """One row per document: id, host, path, evidence, the posteriors, score (log odds) and kept (score of at least 0).

    Null texts count as texts without words. Null hosts and paths are groups; ids may be null or repeat.
    """
    model = fit_on(docs, labels)
    evidence = materialize(with_evidence(docs, model, [id_col, host, path]), "evidence")
    found = sites(evidence, host, path)
    others, score = score_columns(found)
    return _joined(evidence, found, host, path).select(
        *[F.col(f"`{c}`") for c in (id_col, host, path)], F.col(EVIDENCE).alias("evidence"), F.col(RATE).alias("host_rate"),
        others.alias("path_rate"), score.alias("score"), (score >= 0).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The documents that ``classify`` keeps, with all their columns."""
    model = fit_on(docs, labels)
    found = sites(materialize(with_evidence(docs, model, [host, path]), "evidence"), host, path)
    whole = _joined(with_evidence(docs, model, docs.columns), found, host, path)
    return whole.where(score_columns(found)[1] >= 0).select(*[F.col(f"`{c}`") for c in docs.columns])
