"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of 60 words. Every passage is described by the shares of its characters, the length of its
words, how many of them differ, and how many of its three-word windows stood earlier in the document. A small layer encodes
it; a gated attention layer, learned from document labels alone, weighs the passages; the weighted mean is scored. The
layers are fitted with plain gradient steps in one task on a bounded sample of labelled documents (``PER_LABEL`` of each
label, ``MOST`` in all); the intercept is then shifted from the sample's label shares to those of all labelled rows.

Only the text is an input. Null and empty texts are one passage without words, and are scored. Without both labels to
learn from, every score is the smoothed share of label 1. Null ids are neither learned from nor held out. Repeated rows are
scored each; a document with several labels counts with each of them. Empty tables give an empty result. Other columns
may have any names.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import word_chunks
from faultline.llm.sampling import bounded, fit_in_task, fold

PASSAGE = 60
FOLDS, HELD_OUT = 5, 0
#: Bounds of the sample of labelled documents.
PER_LABEL = 1500
MOST = 3000
ENCODED, GATED = 24, 16
STEPS, RATE, DECAY = 250, 0.02, 1e-4
THRESHOLD = 0.3

#: Character classes: each of the 96 codes from 32 to 127, and one for all bytes of other characters.
_CLASS = np.full(256, 96, np.int64)
_CLASS[32:128] = np.arange(96)
_CLASS[:32] = 0
CLASSES = 97
WIDTH = CLASSES + 4


def passages(text: str | None) -> np.ndarray:
    """One row of measures per passage of a text, at least one row."""
    shares, lengths, differ, codes = [], [], [], []
    left: list[bytes] = []
    chunks = word_chunks((text or "").encode("utf-8", "replace"), lower=False)
    done = False
    while not done:
        part = next(chunks, None)
        done = part is None
        found = left + (part or [])
        upto = len(found) if done else len(found) // PASSAGE * PASSAGE
        found, left = found[:upto], found[upto:]
        if not found:
            continue
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        of_word = np.arange(len(found)) // PASSAGE
        n = int(of_word[-1]) + 1
        letters = np.frombuffer(b"".join(found), np.uint8)
        cells = np.bincount(np.repeat(of_word, sizes) * CLASSES + _CLASS[letters], minlength=n * CLASSES).reshape(n, CLASSES)
        shares.append(cells / np.maximum(cells.sum(axis=1, keepdims=True), 1))
        count = np.bincount(of_word)
        lengths.append(np.stack([np.log1p(count), np.bincount(of_word, sizes) / count], axis=1))
        code = np.fromiter(map(crc32, found), np.uint64, len(found))
        codes.append(code)
        own = np.unique((of_word.astype(np.uint64) << np.uint64(32)) | code) >> np.uint64(32)
        differ.append(np.bincount(own.astype(np.int64), minlength=n) / count)
    if not shares:
        return np.zeros((1, WIDTH), np.float32)
    code = np.concatenate(codes)
    n = sum(map(len, differ))
    again = np.zeros(n)
    if len(code) >= 3:
        window = (code[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (code[2:] << np.uint64(29))
        first = np.zeros(len(window), bool)
        first[np.unique(window, return_index=True)[1]] = True
        of_window = np.arange(len(window)) // PASSAGE
        again[:of_window[-1] + 1] = np.bincount(of_window, ~first) / np.bincount(of_window)
    return np.column_stack([np.concatenate(shares), np.concatenate(lengths), np.concatenate(differ), again]).astype(np.float32)


class Model:
    """Encoder, gated attention and scorer; ``starts`` are the first passages of the documents in ``x``."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, layers: dict[str, np.ndarray]) -> None:
        self.mean, self.spread, self.layers = mean, spread, layers

    @staticmethod
    def new(x: np.ndarray, seed: int = 5) -> "Model":
        draw = np.random.default_rng(seed)
        shapes = {"encode": (WIDTH, ENCODED), "tanh": (ENCODED, GATED), "gate": (ENCODED, GATED), "attend": (GATED, 1), "score": (ENCODED, 1)}
        layers = {k: draw.normal(0, 1 / np.sqrt(s[0]), s) for k, s in shapes.items()}
        layers |= {"encode0": np.zeros(ENCODED), "score0": np.zeros(1)}
        return Model(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3), layers)

    def forward(self, x: np.ndarray, starts: np.ndarray, of: np.ndarray) -> dict[str, np.ndarray]:
        w = self.layers
        x = np.clip((x - self.mean) / self.spread, -8, 8)
        h = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(h @ w["tanh"]), 1 / (1 + np.exp(-(h @ w["gate"])))
        e = ((t * g) @ w["attend"])[:, 0]
        a = np.exp(e - np.maximum.reduceat(e, starts)[of])
        a = a / np.add.reduceat(a, starts)[of]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "logit": (z @ w["score"])[:, 0] + w["score0"]}

    def gradient(self, f: dict[str, np.ndarray], d: np.ndarray, starts: np.ndarray, of: np.ndarray) -> dict[str, np.ndarray]:
        """Of the loss whose derivative by each document's logit is ``d``."""
        w, a, h = self.layers, f["a"], f["h"]
        dz = d[:, None] * w["score"][:, 0]
        da = (dz[of] * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, starts)[of])
        dtg = de[:, None] * w["attend"][:, 0]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = (a[:, None] * dz[of] + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - h ** 2)
        return {"score": f["z"].T @ d[:, None], "score0": d.sum(keepdims=True), "attend": (f["t"] * f["g"]).T @ de[:, None],
                "tanh": h.T @ dt, "gate": h.T @ dg, "encode": f["x"].T @ dh, "encode0": dh.sum(axis=0)}

    def fit(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> None:
        of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(x))))
        weight = np.where(y == 1, 0.5 / max((y == 1).mean(), 1e-9), 0.5 / max((y == 0).mean(), 1e-9)) / len(y)
        m = {k: np.zeros_like(v) for k, v in self.layers.items()}
        v = {k: np.zeros_like(u) for k, u in self.layers.items()}
        for step in range(1, STEPS + 1):
            f = self.forward(x, starts, of)
            grad = self.gradient(f, (1 / (1 + np.exp(-f["logit"])) - y) * weight, starts, of)
            for k, w in self.layers.items():
                g = grad[k] + DECAY * w
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                w -= RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, mean=self.mean, spread=self.spread, **self.layers)
        return out.getvalue()

    @staticmethod
    def from_bytes(data: bytes) -> "Model":
        stored = dict(np.load(io.BytesIO(data)))
        return Model(stored.pop("mean"), stored.pop("spread"), stored)


def fit(sample: pd.DataFrame) -> bytes:
    """A fitted model from rows of doc_id, label and the bytes of the passages' measures."""
    sample = sample.sort_values(["doc_id", "label"], kind="stable")
    bags = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in sample["bag"]]
    x = np.concatenate(bags).astype(np.float64)
    starts = np.cumsum([0, *map(len, bags[:-1])])
    model = Model.new(x)
    model.fit(x, starts, sample["label"].to_numpy(np.float64))
    return model.to_bytes()


def _bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"], "bag": [passages(t).tobytes() for t in pdf["text"]]})


def _scores(batches: Iterator[pd.DataFrame], model: bytes, shift: float) -> Iterator[pd.DataFrame]:
    fitted = Model.from_bytes(model)
    for pdf in batches:
        logits = np.zeros(len(pdf))
        for at in range(0, len(pdf), 64):
            bags = [passages(t) for t in pdf["text"].iloc[at:at + 64]]
            starts = np.cumsum([0, *map(len, bags[:-1])])
            of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
            logits[at:at + 64] = fitted.forward(np.concatenate(bags).astype(np.float64), starts, of)["logit"]
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "score": 1 / (1 + np.exp(-(logits + shift)))})


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             per_label: int = PER_LABEL, most: int = MOST) -> DataFrame:
    """The score of every document, learned from the labelled ones outside the held-out fold."""
    number = F.col(id_col).cast("long")
    named = docs.select(number.alias("doc_id"), F.col(text_col).alias("text"),
                        F.coalesce(fold(number, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"))
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        (fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("label").isin(0, 1)).distinct()
    shares = dict(marks.groupBy("label").count().collect())
    zeros, ones = shares.get(0, 0), shares.get(1, 0)
    model = None
    if zeros and ones:
        sample = bounded(marks, "label", "doc_id", per_label, most, "quality")
        taught = named.where("not held_out").join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")
        model = fit_in_task(taught.mapInPandas(_bags, "doc_id long, label int, bag binary"), fit)
    if model is None:
        return _decided(named.select("doc_id", "held_out", F.lit((ones + 1) / (zeros + ones + 2)).alias("score")))
    shift = float(np.log(ones / zeros))  # the fit weighs both labels alike
    scored = named.select(F.col("doc_id").cast("string"), "text", "held_out").mapInPandas(
        lambda batches: _scores(batches, model, shift), "doc_id string, held_out boolean, score double")
    return _decided(scored.withColumn("doc_id", F.col("doc_id").cast("long")))


def _decided(scored: DataFrame) -> DataFrame:
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
