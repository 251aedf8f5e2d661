"""Language identification by a convolutional network over bytes.

Lower-cased UTF-8 text is cut into windows of ``WINDOW`` bytes that overlap by the widest filter, so that every byte
sequence a filter can see lies in a window; the last window is filled up with zero bytes. Bytes have learned
vectors; filters of 2, 3 and 4 bytes run over them, the largest answer of each filter is kept, and a softmax layer
gives the languages' probabilities. A text's answer is the softmax of the mean logarithm over its windows, weighted
by their bytes, so whole texts of any length count.

The network is trained in numpy on the driver from a sample whose size is a parameter: at most ``per_language``
texts of each language, chosen by a hash of the id, with ``WINDOWS_PER_TEXT`` windows each. Training is repeatable.

Null texts and texts without a letter get ``und`` and score 0, and so does every text if there is no labelled row
to learn from. Rows that repeat are predicted alike; repeated ids share the sample's place. Only the named columns
are read. Labels with nulls or without usable text are not learned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
WINDOW = 192
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
BYTE_VECTOR = 8
PER_LANGUAGE = 600
LANGUAGES = 400  # the most frequent labels that are learned
WINDOWS_PER_TEXT = 4
BATCH_WINDOWS = 64
EPOCHS = 8


class ByteCnn:
    """Network and its training; ``labels`` are the classes."""

    def __init__(self, labels: list[str], seed: int = 7):
        draw = np.random.default_rng(seed)
        self.labels = labels
        widest, filters = max(WIDTHS), FILTERS * len(WIDTHS)
        self.mask = np.zeros((widest, BYTE_VECTOR, filters), dtype=np.float32)
        for n, width in enumerate(WIDTHS):
            self.mask[:width, :, n * FILTERS : (n + 1) * FILTERS] = 1
        self.mask = self.mask.reshape(widest * BYTE_VECTOR, filters)
        shapes = {"bytes": (256, BYTE_VECTOR), "conv": self.mask.shape, "bias": (filters,)}
        shapes |= {"out": (filters, len(labels)), "out_bias": (len(labels),)}
        self.weights = {k: draw.normal(0, 0.3, s).astype(np.float32) for k, s in shapes.items()}
        self.weights["conv"] *= self.mask
        self.weights["bias"][:] = 0
        self.weights["out_bias"][:] = 0

    def _pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest answer of each filter, and the bytes' vectors next to each other at every place."""
        widest = max(WIDTHS)
        padded = np.pad(windows, ((0, 0), (0, widest - 1)))
        vectors = self.weights["bytes"][padded]
        count, length, _ = vectors.shape
        shape = (count, length - widest + 1, widest * BYTE_VECTOR)
        step = vectors.strides
        seen = np.lib.stride_tricks.as_strided(vectors, shape, (step[0], step[1], step[2]))
        flat = np.ascontiguousarray(seen).reshape(-1, shape[2])
        return (flat @ self.weights["conv"]).reshape(count, shape[1], -1), flat.reshape(shape)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        answers, _ = self._pooled(windows)
        top = np.maximum(answers.max(axis=1) + self.weights["bias"], 0)
        return _log_softmax(top @ self.weights["out"] + self.weights["out_bias"])

    def train(self, windows: np.ndarray, targets: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> ByteCnn:
        """Adam on the cross entropy, in an order drawn from ``seed``."""
        draw = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for _ in range(epochs):
            order = draw.permutation(len(windows))
            for at in range(0, len(order), BATCH_WINDOWS):
                chosen = order[at : at + BATCH_WINDOWS]
                step += 1
                for name, slope in self._slopes(windows[chosen], targets[chosen]).items():
                    mean[name] += 0.1 * (slope - mean[name])
                    square[name] += 0.001 * (slope * slope - square[name])
                    size = mean[name] / (1 - 0.9**step) / (np.sqrt(square[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] -= (0.005 * size).astype(np.float32)
        return self

    def _slopes(self, windows: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
        weights, count = self.weights, len(windows)
        answers, seen = self._pooled(windows)
        place = answers.argmax(axis=1)
        raw = np.take_along_axis(answers, place[:, None, :], axis=1)[:, 0] + weights["bias"]
        top = np.maximum(raw, 0)
        wrong = np.exp(_log_softmax(top @ weights["out"] + weights["out_bias"]))
        wrong[np.arange(count), targets] -= 1
        wrong /= count
        back = (wrong @ weights["out"].T) * (raw > 0)
        picked = seen[np.arange(count)[:, None], place]  # window, filter, what the filter saw
        conv = np.einsum("nf,nfv->vf", back, picked) * self.mask
        to_bytes = np.zeros_like(weights["bytes"])
        padded = np.pad(windows, ((0, 0), (0, max(WIDTHS) - 1)))
        spread = back[:, :, None] * weights["conv"].T[None]
        for offset in range(max(WIDTHS)):
            seen_bytes = padded[np.arange(count)[:, None], place + offset]
            part = spread[:, :, offset * BYTE_VECTOR : (offset + 1) * BYTE_VECTOR]
            np.add.at(to_bytes, seen_bytes, part)
        slopes = {"bytes": to_bytes, "conv": conv, "bias": back.sum(axis=0)}
        return slopes | {"out": top.T @ wrong, "out_bias": wrong.sum(axis=0)}

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        """Label and probability of each text, from windows of all texts in batches of fixed size."""
        sums = np.zeros((len(texts), len(self.labels)))
        lengths = np.zeros(len(texts))
        for windows, owners, sizes in window_batches(texts):
            np.add.at(sums, owners, self.log_probabilities(windows) * sizes[:, None])
            np.add.at(lengths, owners, sizes)
        mean = _log_softmax(sums / np.maximum(lengths, 1)[:, None])
        best = mean.argmax(axis=1)
        return [self.labels[n] for n in best], np.exp(mean[np.arange(len(texts)), best]).tolist()


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def window_batches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows over whole texts, the text each belongs to and its number of bytes, ``BATCH_WINDOWS`` at a time."""
    stride = WINDOW - max(WIDTHS) + 1
    windows, owners, sizes = np.zeros((BATCH_WINDOWS, WINDOW), np.uint8), [], []
    for owner, text in enumerate(texts):
        for at in range(0, max(1, len(text) - max(WIDTHS) + 1), stride):
            part = np.frombuffer(text[at : at + WINDOW], np.uint8)
            windows[len(owners), : len(part)] = part
            windows[len(owners), len(part) :] = 0
            owners.append(owner)
            sizes.append(len(part))
            if len(owners) == BATCH_WINDOWS:
                yield windows, np.array(owners), np.array(sizes)
                owners, sizes = [], []
    if owners:
        yield windows[: len(owners)], np.array(owners), np.array(sizes)


def _share(id_column: str) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    return F.pmod(F.xxhash64(F.col(id_column).cast("string")), F.lit(1 << 30)) / F.lit(1 << 30)


def learn(
    labelled: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> ByteCnn | None:
    """A network trained on at most ``per_language`` texts of each label; None if no row can be learned from.

    The driver gets one count per label and the windows of the sample.
    """
    text, label = F.col(text_column), F.col(label_column)
    usable = labelled.where(label.isNotNull() & text.rlike("\\p{L}"))
    counts = usable.groupBy(label.alias("label")).count().orderBy(F.desc("count"), "label").limit(LANGUAGES).collect()
    if not counts:
        return None
    # about twice the sample by a share of ids, then the exact number of rows with the smallest shares
    cut = F.create_map(*[F.lit(x) for row in counts for x in (row["label"], min(1.0, 2 * per_language / row["count"]))])
    source = F.encode(F.lower(text), "utf-8")
    room = F.greatest(F.lit(1), F.octet_length(source) - WINDOW + 1)
    parts = [
        F.substring(source, (F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit(n)), room) + 1).cast("int"), WINDOW)
        for n in range(WINDOWS_PER_TEXT)
    ]
    picked = usable.select(
        label.alias("label"), _share(id_column).alias("share"), F.array(*parts).alias("parts")
    ).where(F.col("share") < F.coalesce(cut[F.col("label")], F.lit(0.0)))
    place = F.row_number().over(Window.partitionBy("label").orderBy("share", "parts"))
    sample = picked.withColumn("n", place).where(F.col("n") <= per_language).collect()
    labels = sorted({row["label"] for row in sample})
    rows = sorted((row["label"], row["share"], part) for row in sample for part in {*map(bytes, row["parts"])})
    windows = np.zeros((len(rows), WINDOW), np.uint8)
    for n, (_, _, part) in enumerate(rows):
        windows[n, : len(part)] = np.frombuffer(part, np.uint8)
    targets = np.array([labels.index(row[0]) for row in rows])
    return ByteCnn(labels).train(windows, targets)


def predict(
    documents: DataFrame, model: ByteCnn | None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """All columns of ``documents`` and ``lang_pred``, ``score``; the text alone decides. Nothing is shuffled.

    The prediction goes through the rows as they are, so ids may repeat or be null.
    """
    names = [c for c in documents.columns if c not in ("lang_pred", "score")]
    text = F.col(text_column)
    bytes_ = F.when(text.rlike("\\p{L}"), F.encode(F.lower(text), "utf-8")).alias("__bytes")
    source = documents.select(*names, bytes_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                texts = some.column(len(names)).to_pylist()
                known = [n for n, found in enumerate(texts) if found is not None and model is not None]
                languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if known:
                    for n, language, score in zip(known, *model.predict([texts[n] for n in known]), strict=True):
                        languages[n], scores[n] = language, score
                columns = [*some.columns[:-1], pa.array(languages), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__bytes")
    return source.mapInArrow(run, f"{kept}, lang_pred string, score double")
