"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded by a small network over its byte and word
statistics, gated attention weighs the passages, and the weighted mean is scored. Only documents
have labels, so the attention learns by itself which passages give a bad document away.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltbed.llm.common import SMALL_SLICE, RollingHash, raw_bytes, slices, texts_in_arrow, word_spans

PASSAGE_WORDS = 64
MAX_TRAINING = 4000  # labelled rows that are learned from
MAX_PASSAGES = 200_000  # of those rows together; a row has a twentieth of that at most
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_classes() -> tuple[np.ndarray, int]:
    """One class per ASCII sign; letters by case, digits, line ends, other blanks, control, above ASCII."""
    table = np.full(256, 4, np.int64)
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[0x80:] = 3
    table[10], table[[9, 32]] = 5, 6
    for i, sign in enumerate(SIGNS):
        table[sign] = 7 + i
    return table, 7 + len(SIGNS)


CLASSES, N_CLASSES = _byte_classes()
N_FEATURES = N_CLASSES + 9


def passages(data: np.ndarray, offsets: np.ndarray, roll: RollingHash) -> tuple[np.ndarray, np.ndarray]:
    """Row and features of every passage of ``PASSAGE_WORDS`` words; a text without words is one passage."""
    n = len(offsets) - 1
    starts, stops, rows = word_spans(data, offsets)
    per_row = np.bincount(rows, minlength=n)
    counts = np.maximum(1, -(-per_row // PASSAGE_WORDS))
    first = np.cumsum(counts) - counts
    total = int(counts.sum())
    place = np.arange(len(rows)) - (np.cumsum(per_row) - per_row)[rows]
    of_word = first[rows] + place // PASSAGE_WORDS
    # A passage reaches from its first word to that of the next; the first takes leading blanks too.
    begins = np.repeat(offsets[:-1], counts)
    heads = np.flatnonzero(place % PASSAGE_WORDS == 0)
    later = heads[place[heads] > 0]
    begins[of_word[later]] = starts[later]
    sizes = np.diff(np.append(begins, len(data)))
    of_byte = np.repeat(np.arange(total), sizes)
    shares = np.bincount(of_byte * N_CLASSES + CLASSES[data], minlength=total * N_CLASSES)
    shares = np.sqrt(shares.reshape(total, N_CLASSES) / np.maximum(sizes, 1)[:, None])
    words = np.bincount(of_word, minlength=total)
    many = np.maximum(words, 1)
    length = (stops - starts).astype(float)

    def mean(values: np.ndarray) -> np.ndarray:
        return np.bincount(of_word, weights=values, minlength=total) / many

    average = mean(length)
    spread = np.sqrt(np.maximum(mean(length**2) - average**2, 0))
    names = roll.span(roll.prefix(data), starts, stops) >> np.uint64(24)
    keys = np.unique(of_word.astype(np.uint64) << np.uint64(40) | names)
    distinct = np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=total) / many
    kinds = CLASSES[data]
    head, tail = (kinds[starts], kinds[stops - 1]) if len(starts) else (starts, starts)
    repeated = np.zeros(len(rows))
    repeated[1:] = (names[1:] == names[:-1]) & (of_word[1:] == of_word[:-1])
    extra = [
        np.log1p(words), average / 8, spread / 8, distinct, mean(head == 1), mean(head >= 7),
        mean(tail >= 7), mean(length <= 2), mean(repeated),
    ]
    return np.repeat(np.arange(n), counts), np.column_stack([shares, *extra])


@dataclass
class BagModel:
    """Weights of the scaler, encoder, gated attention and output; or a constant where nothing was learned."""

    weights: dict[str, np.ndarray]
    constant: float | None = None

    def score(self, bags: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        if self.constant is not None:
            return np.full(n, self.constant)
        w = self.weights
        return _forward(w, bags, (features - w["mean"]) / w["scale"], n)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _forward(w: dict, bags: np.ndarray, x: np.ndarray, n: int) -> dict:
    h = np.tanh(x @ w["E"] + w["e"])
    value, gate = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    energy = (value * gate) @ w["a"]
    top = np.full(n, -np.inf)
    np.maximum.at(top, bags, energy)
    raw = np.exp(energy - top[bags])
    share = raw / np.bincount(bags, weights=raw, minlength=n)[bags]
    bag = np.stack([np.bincount(bags, weights=share * h[:, j], minlength=n) for j in range(h.shape[1])], 1)
    return {"h": h, "value": value, "gate": gate, "share": share, "bag": bag, "p": _sigmoid(bag @ w["o"] + w["b"])}


def train(bags: np.ndarray, features: np.ndarray, labels: np.ndarray, epochs: int = 150) -> BagModel:
    """Fit on the given bags with Adam, full batches and a fixed seed."""
    n = len(labels)
    if not n or labels.min() == labels.max():
        return BagModel({}, float(labels[0]) if n else 0.5)
    rng = np.random.default_rng(7)
    wide, slim = 16, 8
    mean, scale = features.mean(0), features.std(0) + 1e-3
    x = (features - mean) / scale
    w = {
        "E": rng.normal(0, 0.3, (x.shape[1], wide)), "e": np.zeros(wide),
        "V": rng.normal(0, 0.3, (wide, slim)), "U": rng.normal(0, 0.3, (wide, slim)),
        "a": rng.normal(0, 0.3, slim), "o": rng.normal(0, 0.3, wide), "b": np.zeros(1),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    # Both labels weigh the same in total, whatever their shares in the sample.
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / n
    for step in range(1, epochs + 1):
        f = _forward(w, bags, x, n)
        out = (f["p"] - labels) * weight
        grad = {"o": f["bag"].T @ out, "b": np.array([out.sum()])}
        on_bag = out[:, None] * w["o"]
        on_h = f["share"][:, None] * on_bag[bags]
        on_share = (f["h"] * on_bag[bags]).sum(1)
        centre = np.bincount(bags, weights=f["share"] * on_share, minlength=n)
        on_energy = f["share"] * (on_share - centre[bags])
        grad["a"] = (f["value"] * f["gate"]).T @ on_energy
        on_pair = on_energy[:, None] * w["a"]
        on_value = on_pair * f["gate"] * (1 - f["value"] ** 2)
        on_gate = on_pair * f["value"] * f["gate"] * (1 - f["gate"])
        grad["V"], grad["U"] = f["h"].T @ on_value, f["h"].T @ on_gate
        on_h += on_value @ w["V"].T + on_gate @ w["U"].T
        on_x = on_h * (1 - f["h"] ** 2)
        grad["E"], grad["e"] = x.T @ on_x, on_x.sum(0)
        for k, g in grad.items():
            g = g + 1e-4 * w[k]
            first, second = moments[k]
            first += 0.1 * (g - first)
            second += 0.001 * (g * g - second)
            w[k] = w[k] - 0.03 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return BagModel(w | {"mean": mean, "scale": scale})


def held_out(key: str) -> Column:
    """Rows that are never learned from: one fold of the checksum of the key; a NULL key is in no fold."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    max_training: int = MAX_TRAINING, max_passages: int = MAX_PASSAGES,
) -> BagModel:
    """Learn from at most ``max_training`` labelled rows outside the held-out fold.

    The sample is the keys with the smallest hash, so it is the same on every run. A key labelled more than once
    takes the rounded mean, one that stands on several rows is learned from one of them (the text with the
    smallest hash); NULL labels and keys are left out. Without labels, or with one kind only, the
    model is a constant. Only the passages of the sample reach the driver, ``max_passages`` at most: a
    row with more than a twentieth of that is not learned from, and rows end where the bound is reached.
    """
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    known = known.groupBy(key).agg(F.round(F.avg(label)).cast("int").alias("_label"))
    ids = docs.select(F.col(key).alias(key), F.col(text).alias(text)).filter(F.col(key).isNotNull())
    chosen = known.orderBy(F.xxhash64(key), key).limit(max_training)
    chosen = [tuple(r) for r in chosen.collect()]
    if not chosen:
        return train(np.zeros(0, int), np.zeros((0, N_FEATURES)), np.zeros(0))
    kind = docs.schema[key].dataType.simpleString()
    sample = docs.sparkSession.createDataFrame(chosen, f"`{key}` {kind}, _label int")
    # Bounded by max_training rows; of a repeated key one row is enough.
    rows = ids.join(F.broadcast(sample), key)
    one = F.struct(F.xxhash64(text), F.coalesce(text, F.lit("")))
    rows = rows.groupBy(key, "_label").agg(F.min(one).alias("_one")).select(key, "_label", F.col("_one.col2").alias(text))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = RollingHash()
        for part in slices(batches, text, SMALL_SLICE):
            bags, features = passages(*raw_bytes(part.column(text)), roll)
            edges = np.searchsorted(bags, np.arange(part.num_rows + 1))
            blobs = [features[a:b].astype("<f4").tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(key), part.column("_label"), pa.array(blobs, pa.binary())], [key, "_label", "x"]
            )

    encoded = texts_in_arrow(rows, encode, f"`{key}` {kind}, _label int, x binary")
    width = 4 * N_FEATURES
    encoded = encoded.filter(F.octet_length("x") <= width * max_passages // 20)
    # A window over max_training rows, whatever the table.
    so_far = F.sum(F.octet_length("x")).over(Window.orderBy(F.xxhash64(key), key))
    found = encoded.withColumn("_n", so_far).filter(F.col("_n") <= width * max_passages).orderBy(key, "x").collect()
    features = [np.frombuffer(r["x"], "<f4").reshape(-1, N_FEATURES).astype(float) for r in found]
    bags = np.repeat(np.arange(len(found)), [len(f) for f in features])
    targets = np.array([r["_label"] for r in found], float)
    return train(bags, np.concatenate(features) if found else np.zeros((0, N_FEATURES)), targets)


def quality_scores(
    docs: DataFrame, model: BagModel, text: str = "text", out: str = "score", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with ``out`` (0 to 1, higher is better) and ``predicted`` (1 from ``threshold`` on).

    Scores come from the text alone; NULL and empty texts are one empty passage. No shuffle. Columns
    of those names are refused.
    """
    if {out.lower(), "predicted"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"The rows already have a column {out} or predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = RollingHash()
        for part in slices(batches, text, SMALL_SLICE):
            bags, features = passages(*raw_bytes(part.column(text)), roll)
            # Rounded, as sums over differently cut slices may differ in their last digits.
            p = np.round(model.score(bags, features.astype("<f4").astype(float), part.num_rows), 6)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                [*part.schema.names, out, "predicted"],
            )

    return texts_in_arrow(docs, score, schema)


def accuracy(scored: pd.DataFrame, label: str = "quality") -> float:
    """Share of labelled rows whose prediction is right."""
    return float((scored["predicted"] == scored[label]).mean())
