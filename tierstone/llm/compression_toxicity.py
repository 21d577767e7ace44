"""Toxicity by compression distance to two zstandard dictionaries.

Both dictionaries are trained by zstandard. The ordinary one learns from pieces of ordinary
documents. The toxic one learns from windows of toxic documents, each a word typical of them
written three times; windows that its training leaves out are put in front of what it chose.
Typical are words that follow at least ``MIN_CONTEXTS`` different words there, or one for
every ``DOCS_A_CONTEXT`` documents of a larger sample, and are ``MIN_LIFT`` times as frequent
as in ordinary text (different contexts, so that copies of a document do not make its words
typical). Trained on whole documents, or on words with their neighbours, the toxic dictionary
would spend its bytes on the common language and separate worse.

A window that is scored is one word written three times, so that its own repetition is cheap
and its first occurrence is what is priced. Its gain is how much shorter it becomes when the
toxic dictionary stands behind the ordinary one. The gains of a document (largest, second
largest, logarithm of the sum) become a probability by a logistic curve fitted on labelled
documents that the dictionaries have not seen.

The fit uses bounded samples of the labelled training rows (``SAMPLE`` documents in the order
of a hash of doc_id, no more than ``SAMPLE_BYTES`` of text each) and runs in one task; only
the dictionaries and the curve come back. Scoring reads every text whole. Compressed lengths
of words are remembered, at most ``CACHE_WORDS`` in a worker.

Defined cases: a null text is empty and has no window, so its score is that of a document
without gains; a null doc_id belongs to no fold and is never learnt from; of several
labels of one document the highest counts; without labels every score is 0; repeated rows
give repeated rows; other columns play no part.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierstone.llm.wu_manber import words_of

SAMPLE = {"toxic": 1500, "ordinary": 6000, "calibration": 4000}
SAMPLE_BYTES = 32 << 20
DICTIONARY_BYTES = 1 << 16
# The toxic dictionary has so many bytes for each byte of the typical words, within bounds.
BYTES_FOR_TYPICAL, LEAST_BYTES = 8, 1024
LEVEL = 16
TIMES = 3
MIN_CONTEXTS, DOCS_A_CONTEXT = 4, 130
MIN_LIFT = 20.0
CACHE_WORDS = 1_000_000
CUT_OFF = 0.3
FOLDS, HELD_OUT = 4, 2


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id, FOLDS) == HELD_OUT, F.lit(False))


@dataclass
class Distance:
    """Gains of words under the toxic dictionary, and the curve from gains to a score."""

    ordinary: bytes
    toxic: bytes
    weights: list[float] = field(default_factory=lambda: [-30.0, 0.0, 0.0, 0.0])

    def __post_init__(self):
        self.gains: dict[bytes, int] = {}
        self.ready = None

    def __getstate__(self):
        return {"ordinary": self.ordinary, "toxic": self.toxic, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def _compressors(self):
        made = []
        for content in (self.ordinary, self.ordinary + self.toxic):
            book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if content else None
            if book:
                book.precompute_compress(LEVEL)
            made.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=book, write_content_size=False, write_checksum=False, write_dict_id=False).compress)
        return made

    def features(self, text: bytes) -> tuple[float, float, float]:
        if self.ready is None:
            self.ready = self._compressors()
        if len(self.gains) > CACHE_WORDS:
            self.gains.clear()
        plain, toxic = self.ready
        gains, words = self.gains, words_of(text)
        found = []
        for word in words:
            gain = gains.get(word)
            if gain is None:
                window = (b" " + word) * TIMES
                gains[word] = gain = len(plain(window)) - len(toxic(window))
            if gain > 1:
                found.append(gain)
        first, *rest = sorted(found, reverse=True) or [0]
        return float(first), float(rest[0] if rest else 0), float(np.log1p(sum(found)))

    def score(self, text: bytes) -> float:
        z = float(np.dot(self.weights, (1.0, *self.features(text))))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def typical_windows(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words typical of the toxic texts, the least frequent first."""
    pairs = set()
    for text in toxic:
        words = words_of(text)
        pairs.update(zip([b"", *words], words))
    there = Counter(word for _, word in pairs)
    least = max(MIN_CONTEXTS, len(toxic) // DOCS_A_CONTEXT)
    candidates = {w for w, n in there.items() if n >= least}
    n_there, n_here, others = len(pairs), 0, set()
    for text in ordinary:
        words = words_of(text)
        n_here += len(words)
        others.update(p for p in zip([b"", *words], words) if p[1] in candidates)
    here = Counter(word for _, word in others)
    lift = lambda w: there[w] / max(1, n_there) / ((here[w] + 0.5) / max(1, n_here))
    chosen = [w for w in candidates if lift(w) >= MIN_LIFT]
    return sorted(chosen, key=lambda w: (there[w], w))


def _trained(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself
        return b"".join(samples)[-size:]


def ordinary_dictionary(texts: list[bytes]) -> bytes:
    samples = []
    for text in texts:
        joined = b" ".join(words_of(text))
        samples += [joined[i : i + 256] for i in range(0, len(joined), 256)]
    return _trained(samples, DICTIONARY_BYTES)


def toxic_dictionary(texts: list[bytes], typical: list[bytes], ordinary: bytes) -> bytes:
    """Trained on the windows of typical words, one for each context they have in a document."""
    wanted, samples = set(typical), []
    for text in texts:
        words, seen = words_of(text), set()
        for k, word in enumerate(words):
            context = tuple(words[max(0, k - 1) : k + 2])
            if word in wanted and context not in seen:
                seen.add(context)
                samples.append((b" " + word) * TIMES)
    if not samples:
        return b""
    size = BYTES_FOR_TYPICAL * sum(len(word) + 1 for word in typical)
    trained = _trained(samples, min(DICTIONARY_BYTES, max(LEAST_BYTES, size)))
    model = Distance(ordinary, trained)
    left_out = [(b" " + word) * TIMES for word in typical if model.features(word)[0] <= 1]
    return b"".join(left_out) + trained


def logistic(features: np.ndarray, labels: np.ndarray, penalty: float = 0.1, steps: int = 50) -> list[float]:
    """Weights of a logistic curve by penalised Newton steps; the first is the intercept."""
    x = np.column_stack([np.ones(len(features)), features])
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return [float(v) for v in w]


def fitted(parts: dict[str, list[tuple[bytes, int]]]) -> Distance:
    toxic, ordinary = ([text for text, _ in parts[name]] for name in ("toxic", "ordinary"))
    if not toxic or not ordinary:
        return Distance(b"", b"")
    book = ordinary_dictionary(ordinary)
    model = Distance(book, toxic_dictionary(toxic, typical_windows(toxic, ordinary), book))
    if unseen := parts["calibration"]:
        features = np.array([model.features(text) for text, _ in unseen])
        model.weights = logistic(features, np.array([mark for _, mark in unseen], float))
    return model


def _fit_task(batches):
    """The one fit, from the whole sample, which comes in the order of the parts and of the draw."""
    parts: dict[str, list[tuple[bytes, int]]] = {name: [] for name in SAMPLE}
    held = dict.fromkeys(SAMPLE, 0)
    for batch in batches:
        for name, text, toxic in zip(*[batch.column(c) for c in ("part", "text", "toxic")]):
            name, text = name.as_py(), text.as_py()
            held[name] += len(text)
            if held[name] <= SAMPLE_BYTES:
                parts[name].append((text, toxic.as_py()))
    model = fitted(parts)
    yield pa.RecordBatch.from_pydict({
        "ordinary": pa.array([model.ordinary], pa.binary()), "toxic": pa.array([model.toxic], pa.binary()),
        "weights": pa.array([model.weights], pa.list_(pa.float64()))})


def fit(docs: DataFrame, labels: DataFrame) -> Distance:
    """Dictionaries and curve from labelled rows outside the held-out fold."""
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(~held_out(F.col("doc_id"))).withColumn("turn", F.xxhash64("doc_id"))
    seen = fold(F.col("doc_id"), 2 * FOLDS) < FOLDS
    parts = {
        "toxic": marks.where(seen & (F.col("toxic") == 1)), "ordinary": marks.where(seen & (F.col("toxic") == 0)),
        "calibration": marks.where(~seen),
    }
    # Only the drawn ids meet the texts; their number is bounded, so they are broadcast.
    drawn = [
        part.orderBy("turn", "doc_id").limit(SAMPLE[name]).select("doc_id", "turn", "toxic", F.lit(name).alias("part"))
        for name, part in parts.items()
    ]
    drawn = F.broadcast(reduce(DataFrame.unionByName, drawn))
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text")).join(drawn, "doc_id")
    found = found.repartition(1).sortWithinPartitions("part", "turn", "doc_id", "text").select("part", "text", F.col("toxic").cast("int").alias("toxic"))
    row = found.mapInArrow(_fit_task, "ordinary binary, toxic binary, weights array<double>").first()
    return Distance(b"", b"") if row is None else Distance(bytes(row.ordinary), bytes(row.toxic), list(row.weights))


def score(docs: DataFrame, model: Distance) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            scores = [shared.value.score(t.as_py() or b"") for t in texts]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": pa.array(scores, pa.float64())})

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    scored = rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT_OFF).cast("int"))


def drop_toxic(docs: DataFrame, model: Distance, cut_off: float = CUT_OFF) -> DataFrame:
    """The documents scored below the cut-off, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            yield batch.filter(pa.array([shared.value.score(t.as_py() or b"") < cut_off for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
