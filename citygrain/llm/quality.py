"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages. Every passage of a whole text is encoded as the frequencies of
pairs of byte classes, then by a learned layer. A gated attention weighs the passages, and the
weighted sum gives the score. Only document labels are needed to learn all of it.

Defined results: a null or empty text is one passage of zeros and gets a score like any other;
texts of any length are read whole; repeated rows each get the same score; rows with a null id are
scored; an empty table gives an empty result; further columns are ignored, whatever their names.
Without labels, or with labels of one value only, every score is the share of label 1 (0.5 if none).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citygrain.llm.columns import plain_names
from citygrain.llm.words import SLICE_BYTES, slices, text_bytes

PASSAGE_BYTES = 512
CLASSES = 16
FEATURES = CLASSES * CLASSES

#: Labelled documents the model is fitted on at most, and passages of all of them together at most. Both bound
#: what reaches the driver (50 MB), by whole rows; only fitting is bounded, scoring reads every passage.
MAX_TRAINING_DOCUMENTS = 4000
MAX_TRAINING_PASSAGES = 100_000


def _byte_classes() -> np.ndarray:
    classes = np.full(256, 15, dtype=np.int64)
    groups = (
        b"abcdefghijklmnopqrstuvwxyz",
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        b"0123456789",
        b" ",
        b"\n\r\t",
        b".",
        b",",
        b"!",
        b"|",
        b"-_/",
        b"'\"()[]{}<>",
        b"@:;?=",
        b"#$%&*+~^\\`",
    )
    for number, group in enumerate(groups):
        classes[list(group)] = number
    classes[0xC0:] = 13
    classes[0x80:0xC0] = 14
    return classes


_CLASS = _byte_classes()


def passage_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every text, and the index of each text's first passage.

    A very long text is worked on in runs of whole passages, so that memory stays bounded.
    """
    sizes = np.diff(offsets)
    if len(sizes) == 1 and sizes[0] > 2 * SLICE_BYTES:
        cuts = range(0, len(data), SLICE_BYTES)
        parts = [passage_features(data[low : low + SLICE_BYTES], np.array([0, min(SLICE_BYTES, len(data) - low)])) for low in cuts]
        features = np.concatenate([part[0] for part in parts])
        return features, np.array([0, len(features)])
    passages = np.maximum(1, -(-sizes // PASSAGE_BYTES))
    first = np.zeros(len(offsets), dtype=np.int64)
    np.cumsum(passages, out=first[1:])
    codes = _CLASS[data]
    pairs = codes.copy()
    pairs[1:] += codes[:-1] * CLASSES
    begins = offsets[:-1][sizes > 0]  # the first byte of a text has none before it
    pairs[begins] = codes[begins]
    inside = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
    passage = np.repeat(first[:-1], sizes) + inside // PASSAGE_BYTES
    count = int(first[-1])
    table = np.bincount(passage * FEATURES + pairs, minlength=count * FEATURES).reshape(count, FEATURES)
    total = np.maximum(table.sum(axis=1, keepdims=True), 1)
    return np.sqrt(table / total).astype(np.float32), first


class AttentionModel:
    """Encoder, gated attention and output of a bag of passages; fitted with Adam on the driver."""

    HIDDEN, GATE = 24, 12

    def __init__(self, seed: int = 3) -> None:
        random = np.random.default_rng(seed)
        near = lambda rows, columns: (random.normal(size=(rows, columns)) / np.sqrt(rows)).astype(np.float32)
        self.weights = {
            "encode": near(FEATURES, self.HIDDEN),
            "encode_bias": np.full(self.HIDDEN, 0.05, dtype=np.float32),
            "attend": near(self.HIDDEN, self.GATE),
            "gate": near(self.HIDDEN, self.GATE),
            "pick": near(self.GATE, 1)[:, 0],
            "out": near(self.HIDDEN, 1)[:, 0],
            "out_bias": np.zeros(1, dtype=np.float32),
        }
        self.constant: float | None = None

    def _forward(self, passages: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        counts = np.diff(first)
        encoded = np.maximum(passages @ w["encode"] + w["encode_bias"], 0)
        attend = np.tanh(encoded @ w["attend"])
        gate = 1 / (1 + np.exp(-(encoded @ w["gate"])))
        raw = (attend * gate) @ w["pick"]
        raw -= np.repeat(np.maximum.reduceat(raw, first[:-1]), counts)
        share = np.exp(raw)
        share /= np.repeat(np.add.reduceat(share, first[:-1]), counts)
        pooled = np.add.reduceat(encoded * share[:, None], first[:-1], axis=0)
        logit = pooled @ w["out"] + w["out_bias"][0]
        return {"encoded": encoded, "attend": attend, "gate": gate, "share": share, "pooled": pooled, "logit": logit}

    def score(self, passages: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Chance of label 1 for each bag."""
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return 1 / (1 + np.exp(-self._forward(passages, first)["logit"].astype(np.float64)))

    def _gradients(self, passages: np.ndarray, first: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, state = self.weights, self._forward(passages, first)
        counts = np.diff(first)
        error = (1 / (1 + np.exp(-state["logit"])) - labels) / len(labels)
        pooled = np.repeat(error, counts)[:, None] * w["out"][None, :]
        encoded, attend, gate, share = (state[name] for name in ("encoded", "attend", "gate", "share"))
        by_share = (pooled * encoded).sum(axis=1)
        mean = np.add.reduceat(share * by_share, first[:-1])
        raw = share * (by_share - np.repeat(mean, counts))
        into_attend = raw[:, None] * w["pick"] * gate * (1 - attend**2)
        into_gate = raw[:, None] * w["pick"] * attend * gate * (1 - gate)
        into_encoded = pooled * share[:, None] + into_attend @ w["attend"].T + into_gate @ w["gate"].T
        into_encoded *= encoded > 0
        return {
            "encode": passages.T @ into_encoded,
            "encode_bias": into_encoded.sum(axis=0),
            "attend": encoded.T @ into_attend,
            "gate": encoded.T @ into_gate,
            "pick": (attend * gate).T @ raw,
            "out": state["pooled"].T @ error,
            "out_bias": np.array([error.sum()]),
        }

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, steps: int = 900, batch: int = 128, rate: float = 0.01) -> None:
        if len(labels) == 0 or labels.min() == labels.max():
            self.constant = float(labels.mean()) if len(labels) else 0.5
            return
        random = np.random.default_rng(11)
        moments = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in self.weights.items()}
        step = 0
        while step < steps:
            order = random.permutation(len(bags))
            for low in range(0, len(order), batch):
                chosen = order[low : low + batch]
                first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
                gradients = self._gradients(np.concatenate([bags[i] for i in chosen]), first, labels[chosen])
                step += 1
                now = rate * (1 - step / (steps + 1))
                for name, gradient in gradients.items():
                    mean, square = moments[name]
                    mean += 0.1 * (gradient - mean)
                    square += 0.01 * (gradient**2 - square)
                    change = now * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
                    self.weights[name] -= change.astype(np.float32)


def training_rows(docs: DataFrame, labels: DataFrame, train: Column, most: int, most_passages: int) -> DataFrame:
    """(doc_id, _text, label) of the rows to learn from, ``_text`` being a hash: spread by hashes, so alike in every rerun.

    Labels that are null, or of no document, are left out; of repeated labels the mean counts, 0.5 and more
    as 1. Of the rows in order of their hashes as many are taken as have ``most_passages`` passages
    together, ``most`` at most; a row is taken with all its passages or not at all.
    """
    known = labels.where(train & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.ceil(F.octet_length("text") / PASSAGE_BYTES).alias("_passages"))
    rows = rows.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "_text").limit(most)
    # Over the few rows of the limit; a text above the whole allowance doesn't end it for those behind.
    fits = rows.where(F.coalesce("_passages", F.lit(0)) <= most_passages)
    so_far = Window.orderBy(F.xxhash64("doc_id"), "doc_id", "_text").rowsBetween(Window.unboundedPreceding, 0)
    taken = fits.withColumn("_sum", F.sum(F.coalesce("_passages", F.lit(0))).over(so_far)).where(F.col("_sum") <= most_passages)
    return taken.select("doc_id", "_text", "label").distinct()


def fit_quality_model(
    docs: DataFrame,
    labels: DataFrame,
    train: Column,
    max_documents: int = MAX_TRAINING_DOCUMENTS,
    max_passages: int = MAX_TRAINING_PASSAGES,
) -> AttentionModel:
    """Fit on whole labelled documents: at most ``max_documents`` with at most ``max_passages`` passages together.

    ``train`` is a condition on ``doc_id``. Rows that repeat id and text are one.
    """
    chosen = training_rows(docs, labels, train, max_documents, max_passages)  # three numbers a row: broadcast

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            out = []
            for text in range(len(offsets) - 1):
                features, _ = passage_features(data[offsets[text] : offsets[text + 1]], np.array([0, offsets[text + 1] - offsets[text]]))
                out.append(features.astype(np.float16).tobytes())
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("label"), pa.array(out, pa.binary())], ["doc_id", "label", "bag"]
                )

    texts = docs.select("doc_id", "text").withColumn("_text", F.xxhash64("text"))
    rows = (
        texts.join(F.broadcast(chosen), ["doc_id", "_text"])
        .dropDuplicates(["doc_id", "_text"])
        .select("doc_id", "label", "text")
        .mapInArrow(bags, "doc_id long, label int, bag binary")
        .collect()
    )
    rows.sort(key=lambda row: (row["doc_id"], bytes(row["bag"])))
    model = AttentionModel()
    model.fit(
        [np.frombuffer(row["bag"], dtype=np.float16).reshape(-1, FEATURES).astype(np.float32) for row in rows],
        np.array([row["label"] for row in rows], dtype=np.float32),
    )
    return model


def score_quality(docs: DataFrame, model: AttentionModel, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns named by ``keep`` and ``score``, from every passage of every whole text."""
    schema = docs.select(*keep).schema.add("score", "double", False)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(batch.num_columns - 1))
            scores = np.zeros(batch.num_rows)
            for low, high in slices(offsets):
                own = offsets[low : high + 1] - offsets[low]
                features, first = passage_features(data[offsets[low] : offsets[high]], own)
                scores[low:high] = model.score(features, first)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(scores)], [*keep, "score"]
            )

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(scored, schema)


def keep_good(docs: DataFrame, model: AttentionModel, least: float) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``, with all their columns."""
    plain, restored = plain_names(docs, ("doc_id", "text"))
    return restored(score_quality(plain, model, tuple(plain.columns)).where(F.col("score") >= least))
