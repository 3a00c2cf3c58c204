"""Language identification.

A text's subwords are the byte n-grams of its words, hashed into a fixed number of
buckets. Each bucket has an embedding; a text is the mean of its subwords' embeddings and
a linear softmax names the language. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample. A temperature fitted on a part
of the sample kept aside calibrates the probabilities. A text's confidence is its probability,
weighed by the share of its subwords that training has seen, and a text whose confidence lies
below what nearly all calibration texts reach is rejected. How much the share weighs is what
tells each learned language best from the others when it is left out in turn.

As mean and softmax are linear, the trained model folds into one score per bucket and
language; scoring is a table lookup over the bytes of an Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.llm.common import held_out, utf8_texts

UNKNOWN = "und"

_ORDERS = (2, 3, 4)
_PIECE = 1 << 18  # bytes of a text that are hashed at a time

# Byte classes: letters are lower-cased, every other ASCII byte parts words.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


@dataclass(frozen=True)
class Training:
    """Bounds and rates of the training; a sample far beyond its bound is an error."""

    per_language: int = 800  # sampled texts of one language at most, about
    max_sample: int = 20000  # sampled texts in all at most, about; shared evenly by the languages
    buckets: int = 1 << 15
    dimensions: int = 16
    epochs: int = 4
    rate: float = 0.5
    snippet_bytes: int = 48  # each text also trains as one short snippet
    calibration_share: int = 4  # one in so many sampled texts calibrates
    reject_share: float = 0.002  # calibration texts that may fall below the threshold
    weights: tuple[float, ...] = (1.0, 2.0, 4.0, 8.0)  # powers of the known share that are tried
    seed: int = 17


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    scores: np.ndarray  # buckets x languages: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    known: np.ndarray  # buckets that the training has seen
    weight: float  # power of the known share in a confidence
    threshold: float  # texts of a lower confidence are rejected


def has_letter(data: np.ndarray) -> bool:
    """Whether UTF-8 bytes hold a letter of any script."""
    if len(data) == 0:
        return False
    folded = _FOLD[data]
    if ((folded >= 97) & (folded <= 122)).any():
        return True
    if not (data >= 128).any():
        return False
    return any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


def subwords(data: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the byte n-grams of a piece of text; n-grams may start or end, but
    not go across, at the edge of a word."""
    text = np.empty(len(data) + 2, np.uint32)
    text[0] = text[-1] = 32
    text[1:-1] = _FOLD[data]
    space = text == 32
    found = []
    for n in _ORDERS:
        m = len(text) - n + 1
        if m <= 0:
            continue
        value = text[:m].copy()
        for k in range(1, n):
            value *= np.uint32(0x01000193)
            value ^= text[k : k + m]
        spaces = space[:m].astype(np.uint8)
        for k in range(1, n):
            spaces += space[k : k + m]
        keep = (spaces == 0) | ((spaces == 1) & (space[:m] | space[n - 1 : n - 1 + m]))
        value = value[keep] + np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        value ^= value >> np.uint32(13)
        found.append(value & np.uint32(buckets - 1))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)


def subword_counts(data: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    total = np.zeros(buckets, np.int64)
    for start in range(0, len(data), _PIECE):
        total += np.bincount(subwords(data[start : start + _PIECE], buckets), minlength=buckets)
    at = np.flatnonzero(total)
    return at, total[at]


def text_score(data: np.ndarray, model: LanguageModel) -> tuple[np.ndarray, float]:
    """Mean of the folded scores of a whole text's subwords, and the share of known ones."""
    buckets = len(model.scores)
    total, n, known = np.zeros(len(model.languages)), 0, 0
    for start in range(0, len(data), _PIECE):
        at = subwords(data[start : start + _PIECE], buckets)
        if len(at) > 4 * buckets:
            total += np.bincount(at, minlength=buckets) @ model.scores
        else:
            total += model.scores[at].sum(axis=0, dtype=np.float64)
        known += int(np.count_nonzero(model.known[at]))
        n += len(at)
    return total / max(n, 1) + model.bias, known / max(n, 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sample_features(labelled: DataFrame, training: Training) -> list:
    """Subword counts of a bounded sample of labelled texts, spread over the languages.

    Texts are chosen by a hash of id and text, with each language's rate set by its count
    over all rows, so that rare languages are fully used. Each language has the same part
    of the sample, and its text with the smallest hash is always in it. Copies of a row
    count once.
    """
    space = 1 << 30
    placed = labelled.where(F.col("text").rlike(r"\p{L}")).withColumn(
        "place", F.pmod(F.xxhash64("doc_id", "text"), F.lit(space))
    )
    counts = placed.groupBy("lang").agg(F.count("*").alias("n"), F.min("place").alias("least")).limit(
        training.max_sample + 1
    ).collect()
    if len(counts) > training.max_sample:
        raise ValueError(f"more than {training.max_sample} languages cannot all be in a sample of as many texts")
    if not counts:
        return []
    share = min(training.per_language, training.max_sample / len(counts) - 1)
    rates = [(r["lang"], max(r["least"] + 1, round(space * min(1.0, share / r["n"])))) for r in counts]
    rate = labelled.sparkSession.createDataFrame(rates, "lang string, rate long")
    chosen = placed.join(F.broadcast(rate), "lang").where("place < rate")
    buckets, width, seed = training.buckets, training.snippet_bytes, training.seed

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"lang": [], "place": [], "at": [], "n": []}
            rows = zip(batch["lang"].to_pylist(), batch["place"].to_pylist(), utf8_texts(batch["text"]))
            for lang, at_place, data in rows:
                if not has_letter(data):
                    continue
                parts = [data]
                if len(data) > width:
                    start = (at_place * 2654435761 + seed) % (len(data) - width)
                    parts.append(data[start : start + width])
                for part in parts:
                    at, n = subword_counts(part, buckets)
                    if len(at):
                        out["lang"].append(lang)
                        out["place"].append(at_place)
                        out["at"].append(at.astype("<i4").tobytes())
                        out["n"].append(n.astype("<i4").tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("lang", pa.string()), ("place", pa.int64()), ("at", pa.binary()), ("n", pa.binary())])
    features = chosen.select("lang", "place", "text").mapInArrow(
        featurise, "lang string, place long, at binary, n binary"
    )
    # Each text gives two rows; chance alone stays far below this bound.
    bound = 2 * (training.max_sample * 5 // 4 + 100)
    rows = features.dropDuplicates().limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"the sample holds more than {bound} rows")
    return sorted(rows, key=lambda r: (r["place"], r["lang"], len(r["at"]), r["at"]))


def train(rows: list, training: Training) -> LanguageModel:
    """Stochastic gradient descent over embeddings and softmax, then calibration."""
    languages = tuple(sorted({r["lang"] for r in rows}))
    k, rng = len(languages), np.random.default_rng(training.seed)
    embedding = rng.normal(0, 0.1, (training.buckets, training.dimensions))
    weights, bias = np.zeros((training.dimensions, max(k, 1))), np.zeros(max(k, 1))
    if k == 0:
        none = np.zeros(training.buckets, bool)
        return LanguageModel((), np.zeros((training.buckets, 1), np.float32), bias, 1.0, none, 1.0, 0.0)
    weights = rng.normal(0, 0.1, (training.dimensions, k))
    code = {lang: i for i, lang in enumerate(languages)}
    data = [
        (np.frombuffer(r["at"], "<i4"), np.frombuffer(r["n"], "<i4") / np.frombuffer(r["n"], "<i4").sum(),
         code[r["lang"]], r["place"])
        for r in rows
    ]
    fit = [d for d in data if d[3] % training.calibration_share] or data
    # A language whose few texts are all kept aside is still learned.
    learned = {label for _, _, label, _ in fit}
    fit += [d for d in data if d[2] not in learned]
    aside = [d for d in data if d[3] % training.calibration_share == 0] or data
    steps, total = 0, training.epochs * len(fit)
    for _ in range(training.epochs):
        for i in rng.permutation(len(fit)):
            at, share, label, _ = fit[i]
            rate = training.rate * (1 - steps / total)
            hidden = share @ embedding[at]
            error = _softmax(hidden @ weights + bias)
            error[label] -= 1
            back = weights @ error
            weights -= rate * np.outer(hidden, error)
            bias -= 0.1 * rate * error
            # The mean shares a step among all subwords; scaled up so that each learns.
            embedding[at] -= rate * np.minimum(share * 50, 1.0)[:, None] * back
            steps += 1
    # How many languages' texts hold a bucket, and one of them.
    holders, holder = np.zeros(training.buckets, int), np.full(training.buckets, -1)
    for label in range(k):
        at = np.unique(np.concatenate([at for at, _, own, _ in fit if own == label]))
        holders[at] += 1
        holder[at] = label
    known = holders > 0
    # What was never trained still has its random start and says nothing.
    scores = np.where(known[:, None], embedding @ weights, 0.0)
    logits = np.array([share @ scores[at] + bias for at, share, _, _ in aside])
    labels = np.array([label for _, _, label, _ in aside])
    temperature = _fitted_temperature(logits, labels)
    own = np.array([share @ known[at] for at, share, _, _ in aside])
    # Left out: subwords that only the text's own language has count as unknown.
    others = np.array([share @ ((holders[at] > 1) | (known[at] & (holder[at] != label))) for at, share, label, _ in aside])
    weight, threshold = _fitted_rejection(logits / temperature, labels, own, others, training)
    return LanguageModel(languages, scores.astype(np.float32), bias, temperature, known, weight, threshold)


def _fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of the least loss. A label is held for true in n + 1 of n + 2 cases, so
    that texts which the model parts without an error don't ask for endless certainty."""
    n, k = logits.shape
    target = np.full((n, k), 1 / ((n + 2) * max(k - 1, 1)))
    target[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        return float((target * (np.log(np.exp(z).sum(axis=1, keepdims=True)) - z)).sum() / n)

    return float(min(np.geomspace(1e-3, 1e3, 481), key=loss))


def _fitted_rejection(
    logits: np.ndarray, labels: np.ndarray, own: np.ndarray, others: np.ndarray, training: Training
) -> tuple[float, float]:
    """Power of the known share and threshold that reject most texts whose language is left out.

    ``own`` is the share of known subwords of each text, ``others`` the same without its language.
    For any power the threshold is what all but ``reject_share`` of the texts reach; with a single
    language nothing can be left out, and the first power stands.
    """
    top = _softmax(logits).max(axis=1)
    without = logits.copy()
    without[np.arange(len(labels)), labels] = -np.inf
    foreign = _softmax(without).max(axis=1) if logits.shape[1] > 1 else np.zeros(0)
    best = (-1, 1.0, 0.0)
    for weight in training.weights:
        confidence = np.sort(top * own**weight)
        threshold = float(confidence[int(training.reject_share * len(confidence))])
        caught = int((foreign * others[: len(foreign)] ** weight < threshold).sum())
        if caught > best[0]:
            best = (caught, weight, threshold)
    return best[1], best[2]


def fit(labelled: DataFrame, training: Training = Training()) -> LanguageModel:
    """Train on rows (doc_id, text, lang) whose text and lang are known."""
    usable = labelled.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    return train(sample_features(usable, training), training)


def scorer(model: LanguageModel, columns: pa.Schema) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, probabilities, rejected = [], [], []
            for data in utf8_texts(batch["text"]):
                if data is None or not has_letter(data) or not model.languages:
                    names.append(UNKNOWN)
                    probabilities.append(0.0)
                    rejected.append(True)
                    continue
                z, known = text_score(data, model)
                p = _softmax(z / model.temperature)
                best = int(p.argmax())
                names.append(model.languages[best])
                probabilities.append(float(p[best]))
                rejected.append(bool(p[best] * known**model.weight < model.threshold))
            kept = [batch[c] for c in columns.names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names, pa.string()), pa.array(probabilities, pa.float64()),
                 pa.array(rejected, pa.bool_())],
                names=[*columns.names, "lang_pred", "score", "rejected"],
            )

    return score


def identify(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Add lang_pred, score and rejected to the ``keep`` columns of ``docs``.

    A null text and one without a letter of any script are ``und`` with score 0, and
    rejected; so is every text if nothing could be learned. Other texts get the likeliest
    learned language and its calibrated probability, and ``rejected`` tells that the
    confidence, which also counts unknown subwords, is below the calibrated threshold. Every row gives one row: repeated rows
    and ids are scored on their own, empty tables give empty ones, and other columns take
    no part.
    """
    needed = list(dict.fromkeys((*keep, "text")))
    rows = docs.select(*needed)
    kept = pa.schema([(c, pa.null()) for c in keep])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema)
    return rows.mapInArrow(scorer(model, kept), f"{fields}, lang_pred string, score double, rejected boolean")


def predict_languages(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """Train on the rows that are not held out and predict all rows."""
    rows = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id"), 4, 2).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")), training)
    return identify(rows, model, ("doc_id", "held_out"))
