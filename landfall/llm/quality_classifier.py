"""Quality classifier: regularised quadratic discriminant analysis.

Each text becomes a short vector of transformed statistics. Per class, mean and covariance
come from sums over all labelled texts, which Spark adds up; the covariance is shrunk
towards a multiple of the identity by the strength that Ledoit and Wolf's rule gives when
fed with the class's sums of fourth powers, and mixed with the pooled one. The score is the
difference of the two log densities, with Mahalanobis distances solved from Cholesky
factors that are computed once, squashed after a scale fitted on a binned tally.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import held_out, stored, utf8_texts

FEATURES = (
    "log_words", "log_word_bytes", "word_spread", "symbols", "upper", "digits", "pipes",
    "marks", "repeated_words", "distinct_words", "repeated_lines", "line_words",
)


@dataclass(frozen=True)
class Classifier:
    mean: np.ndarray  # class x feature
    factor: np.ndarray  # class x feature x feature: Cholesky factor of the covariance
    log_det: np.ndarray
    log_prior: np.ndarray
    scale: float
    offset: float


# Byte classes of the statistics.
_SPACE, _UPPER, _DIGIT, _SYMBOL, _MARK, _PIPE = 1, 2, 4, 8, 16, 32
_CLASS = np.zeros(256, np.uint8)
_CLASS[[32, 9, 10, 11, 12, 13]] |= _SPACE
_CLASS[65:91] |= _UPPER
_CLASS[48:58] |= _DIGIT
_CLASS[[ord(c) for c in "#*$%&<>@^~=+_\\{}[]"]] |= _SYMBOL
_CLASS[[ord(c) for c in "!?.,;:"]] |= _MARK
_CLASS[ord("|")] |= _PIPE


def statistics(data: np.ndarray | None) -> list[float]:
    """The transformed statistics of a whole text's UTF-8 bytes; null counts as empty.

    Shares enter as square roots, which evens out their spread, and sizes as logarithms.
    """
    if data is None or len(data) == 0:
        return [0.0] * len(FEATURES)
    n = len(data)
    counts = np.bincount(data, minlength=256)

    def share(bit: int) -> float:
        return float(np.sqrt(counts[(_CLASS & bit) > 0].sum() / n))

    text = data.tobytes()
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    repeated = sum(map(bytes.__eq__, words, words[1:])) / len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        float(np.log1p(len(words))),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        share(_SYMBOL), share(_UPPER), share(_DIGIT), share(_PIPE), share(_MARK),
        float(np.sqrt(repeated)),
        float(np.sqrt(len(set(words)) / len(words))),
        float(np.sqrt(1 - len(set(lines)) / len(lines))),
        float(np.log1p(len(words) / len(lines))),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and its text's statistics, one row per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(data) for data in utf8_texts(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(x, schema.field("x").type)], schema=schema
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return rows.mapInArrow(compute, "doc_id long, x array<double>")


def _moments(labelled: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray, float]]:
    """Per class: rows, mean, covariance and mean squared norm product, from sums over all rows."""
    d = len(FEATURES)
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = labelled.groupBy("quality").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(c) for c in x]).alias("s"),
        F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"),
    )
    out = {}
    for row in sums.collect():
        n, mean = row["n"], np.array(row["s"]) / row["n"]
        second = np.zeros((d, d))
        for (i, j), value in zip(pairs, row["p"]):
            second[i, j] = second[j, i] = value / n
        out[row["quality"]] = (float(n), mean, second - np.outer(mean, mean))
    return out


def _fourth_powers(labelled: DataFrame, moments: dict) -> dict[int, float]:
    """Per class the mean fourth power of the centred norm, which the shrinkage rule needs."""
    d = len(FEATURES)
    centres = F.create_map(*[
        y for c, (_, mean, _) in moments.items()
        for y in (F.lit(c), F.array(*[F.lit(float(v)) for v in mean]))
    ])
    centre = centres[F.col("quality")]
    squares = [F.pow(F.col("x")[i] - F.col("c")[i], 2) for i in range(d)]
    norm = sum(squares[1:], squares[0])
    rows = labelled.withColumn("c", centre).groupBy("quality").agg(F.avg(norm * norm).alias("q"))
    return {r["quality"]: r["q"] for r in rows.collect()}


def fit(labelled: DataFrame, pool_share: float = 0.1, floor: float = 1e-3) -> Classifier | None:
    """Fit on rows (x, quality 0/1); None if no class has rows.

    A class without rows borrows the other's mean and covariance, so it never wins over
    the prior. ``floor`` is added to each variance, so constant statistics do no harm.
    """
    labelled = labelled.where("quality in (0, 1)")
    moments = _moments(labelled)
    if not moments:
        return None
    quartic = _fourth_powers(labelled, moments)
    d = len(FEATURES)
    total = sum(m[0] for m in moments.values())
    pooled = sum(m[0] * m[2] for m in moments.values()) / total
    mean, factor, log_det, log_prior = [], [], [], []
    for c in (0, 1):
        n, centre, cov = moments.get(c, (1.0, next(iter(moments.values()))[1], pooled))
        level = np.trace(cov) / d
        gap = ((cov - level * np.eye(d)) ** 2).sum()
        noise = max(quartic.get(c, 0.0) - (cov**2).sum(), 0.0) / n
        shrink = min(1.0, noise / gap) if gap > 0 else 1.0
        cov = (1 - shrink) * cov + shrink * level * np.eye(d)
        cov = (1 - pool_share) * cov + pool_share * pooled + floor * np.eye(d)
        low = np.linalg.cholesky(cov)
        mean.append(centre)
        factor.append(low)
        log_det.append(2 * np.log(np.diag(low)).sum())
        log_prior.append(np.log((moments[c][0] if c in moments else 0.5) / total))
    model = Classifier(
        np.array(mean), np.array(factor), np.array(log_det), np.array(log_prior), 1.0, 0.0
    )
    return _calibrated(model, labelled)


def log_odds(model: Classifier, x: np.ndarray) -> np.ndarray:
    """Log density of class 1 minus that of class 0, priors included."""
    parts = []
    for c in (0, 1):
        z = np.linalg.solve(model.factor[c], (x - model.mean[c]).T)
        parts.append(-0.5 * ((z**2).sum(axis=0) + model.log_det[c]) + model.log_prior[c])
    return parts[1] - parts[0]


_SPAN, _STEP = 60.0, 0.5  # log odds beyond the span count at its ends


def _calibrated(model: Classifier, labelled: DataFrame) -> Classifier:
    """Scale the log odds by a logistic fit on their tally over all labelled rows."""

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = log_odds(model, _matrix(batch["x"]))
            at = np.rint(np.clip(z, -_SPAN, _SPAN) / _STEP).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["quality"].cast(pa.int32()), pa.array(at, pa.int32())], names=["quality", "at"]
            )

    tally = (
        labelled.select("quality", "x").mapInArrow(bins, "quality int, at int")
        .groupBy("quality", "at").count().collect()
    )
    z = np.array([r["at"] * _STEP for r in tally])
    y = np.array([r["quality"] for r in tally], float)
    w = np.array([r["count"] for r in tally], float)
    w = w / w.sum()
    a, b = 1.0, 0.0
    for _ in range(100):  # Newton steps on two numbers, kept near scale 1 by a small penalty
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))
        g = np.array([(w * (p - y) * z).sum() + 0.01 * (a - 1), (w * (p - y)).sum() + 0.001 * b])
        v = w * p * (1 - p)
        h = np.array([[(v * z * z).sum() + 0.01, (v * z).sum()], [(v * z).sum(), v.sum() + 0.001]])
        step = np.linalg.solve(h, g)
        a, b = max(a - np.clip(step[0], -0.2, 0.2), 1e-3), b - np.clip(step[1], -1, 1)
    return Classifier(model.mean, model.factor, model.log_det, model.log_prior, float(a), float(b))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, len(FEATURES))


def score(statistics_rows: DataFrame, model: Classifier | None) -> DataFrame:
    """Replace x by score (0 to 1) and predicted; score 0.5 for all if nothing was learned."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch["x"])
            if model is None or len(x) == 0:
                p = np.full(len(x), 0.5)
            else:
                p = 1 / (1 + np.exp(-np.clip(model.scale * log_odds(model, x) + model.offset, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = statistics_rows.select("doc_id", "held_out", "x")
    return rows.mapInArrow(compute, "doc_id long, held_out boolean, score double, predicted int")


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every row of ``docs``, learning from labels of rows that are not held out.

    One pass over the texts computes the statistics; all else works on the small vectors.
    A null or empty text, and one of white space only, has all statistics 0 and is scored
    as such. Every row gives one row, also repeated ones. Labels that are null or not 0 or
    1 are passed over; of several labels of one document the lowest counts. Without any
    label all scores are 0.5. Other columns take no part.
    """
    rows = stored(document_statistics(docs), "quality-statistics")
    rows = rows.withColumn("held_out", held_out(F.col("doc_id"), 3, 1))
    wanted = (
        labels.where("quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    labelled = rows.where(~F.col("held_out")).join(wanted, "doc_id").select("x", "quality")
    return score(rows, fit(labelled))
