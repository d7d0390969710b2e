"""Language identification: sparse multinomial logistic regression on TF-IDF weights of character n-grams.

A text is lower-cased and everything between letters becomes one space. Its 1-, 2- and 3-grams are hashed; a gram weighs its
share of the text times its inverse document frequency, which is counted over all documents that may be learned from. The
weights are fitted with the follow-the-regularised-leader rule and elastic-net penalties on a bounded sample (``PER_LANG``
documents of each language, ``MOST`` in all), then one temperature is fitted on a fifth of the sample that the weights
have not seen. Whole texts are read everywhere, long ones piece by piece.

Null texts and texts without a letter are ``und`` with score 0; so is everything if there is nothing to learn from. Equal
scores go to the first language in order. Null ids are not learned from and not held out. Repeated rows each get their
prediction; empty tables give an empty result; other columns may have any names.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.sampling import bounded, fit_in_task, fold

ORDERS = 3
BITS = 16
FOLDS, HELD_OUT = 4, 2
#: Bounds of the sample that the weights are fitted on.
PER_LANG = 400
MOST = 4000
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1
EPOCHS = 4
SCALE = 50.0
UNKNOWN = "und"

_MULTIPLIERS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)
_PIECE = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str | None) -> Iterator[np.ndarray]:
    """The hashed n-grams of a text, repeats included, in pieces; nothing for a text without letters."""
    text = text or ""
    for at in range(0, len(text), _PIECE):
        code = np.frombuffer(text[at:at + _PIECE].lower().encode("utf-32-le", "replace"), np.uint32)
        code = np.where(_letters()[code], code, 32).astype(np.uint32)
        blank = code == 32
        code = code[~(blank & np.append(True, blank[:-1]))]
        if not len(code):
            continue
        code = np.concatenate([np.array([32], np.uint32), code, np.array([32], np.uint32)])
        mixed = np.zeros(len(code), np.uint32)
        for n in range(ORDERS):
            mixed = (mixed[:len(code) - n] ^ code[n:]) * np.uint32(_MULTIPLIERS[n]) if n == 0 else \
                ((mixed[:len(code) - n] ^ (mixed[:len(code) - n] >> np.uint32(15))) + code[n:]) * np.uint32(_MULTIPLIERS[n])
            spread = (mixed ^ (mixed >> np.uint32(13))) * np.uint32(_MULTIPLIERS[(n + 1) % 3])
            yield spread >> np.uint32(32 - BITS)


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(1 << BITS, np.int64)
    seen = np.zeros(1 << BITS, bool)
    for pdf in batches:
        for text in pdf["text"]:
            seen[:] = False
            for part in grams(text):
                seen[part] = True
            total += seen
    at = np.flatnonzero(total)
    yield pd.DataFrame({"gram": at, "n": total[at]})


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for lang, text, key in zip(pdf["lang"], pdf["text"], pdf["doc_id"]):
            counts = np.zeros(1 << BITS, np.int64)
            for part in grams(text):
                counts += np.bincount(part, minlength=1 << BITS)
            at = np.flatnonzero(counts)
            if len(at):
                out.append((lang, key, at.astype(np.int32), (counts[at] / counts.sum()).astype(np.float32)))
        if out:
            yield pd.DataFrame(out, columns=["lang", "doc_id", "gram", "share"])


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The weights that the rule's sums stand for: zero where a sum stays below the L1 penalty."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(sample: pd.DataFrame, idf: np.ndarray) -> bytes:
    """Languages, weights times idf, intercepts and temperature of a sample with lang, doc_id, gram, share."""
    sample = sample.sort_values("doc_id", kind="stable").reset_index(drop=True)
    names = sorted(sample["lang"].unique())
    y = sample["lang"].map({x: i for i, x in enumerate(names)}).to_numpy()
    at = [np.asarray(g, np.int64) for g in sample["gram"]]
    x = [np.asarray(s, np.float64) * idf[g] * SCALE for s, g in zip(sample["share"], at)]
    calibrate = np.arange(len(y)) % 5 == 4
    z, n = np.zeros((idf.size + 1, len(names))), np.zeros((idf.size + 1, len(names)))
    order = np.flatnonzero(~calibrate)
    shuffled = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in shuffled.permutation(order):
            rows, values = np.append(at[i], idf.size), np.append(x[i], 1.0)
            now = _weights(z[rows], n[rows])
            p = _softmax(values @ now)
            p[y[i]] -= 1.0
            g = values[:, None] * p[None, :]
            step = (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / ALPHA
            z[rows] += g - step * now
            n[rows] += g * g
    w = _weights(z, n)
    logits = np.array([values @ w[rows] + w[-1] for rows, values in zip(at, x)])
    test = calibrate if calibrate.any() else ~calibrate
    heats = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    losses = [-np.log(np.maximum(_softmax(logits[test] / t)[np.arange(test.sum()), y[test]], 1e-12)).mean() for t in heats]
    out = io.BytesIO()
    np.savez_compressed(out, names=np.array(names, dtype=str), w=(w[:-1] * idf[:, None] * SCALE).astype(np.float32),
                        bias=w[-1], heat=heats[int(np.argmin(losses))])
    return out.getvalue()


def _predict(batches: Iterator[pd.DataFrame], model: bytes) -> Iterator[pd.DataFrame]:
    stored = np.load(io.BytesIO(model))
    names, w, bias, heat = stored["names"].tolist(), stored["w"], stored["bias"], float(stored["heat"])
    for pdf in batches:
        out = []
        for text in pdf["text"]:
            total, count = np.zeros(len(names)), 0
            for part in grams(text):
                total += w[part].sum(axis=0, dtype=np.float64)
                count += len(part)
            if not count:
                out.append((UNKNOWN, 0.0))
                continue
            p = _softmax((total / count + bias) / heat)
            best = int(np.argmax(p))
            out.append((names[best], float(p[best])))
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": [a for a, _ in out], "score": [b for _, b in out]})


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             per_lang: int = PER_LANG, most: int = MOST) -> DataFrame:
    """The predicted language of every document, learned from those outside the held-out fold."""
    number = F.col(id_col).cast("long")
    named = docs.select(number.alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                        F.coalesce(fold(number, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"))
    taught = named.where("not held_out and doc_id is not null and lang is not null and text is not null")
    sums = taught.select("text").mapInPandas(_document_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(1 << BITS)
    frequency[sums["gram"].to_numpy(np.int64)] = sums["n"].to_numpy(np.float64)
    idf = np.log((1.0 + max(frequency.max(), 1.0)) / (1.0 + frequency)) + 1.0
    ids = bounded(taught.select("doc_id", "lang"), "lang", "doc_id", per_lang, most, "lang").select("doc_id").distinct()
    sample = taught.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "lang").mapInPandas(
        _features, "lang string, doc_id long, gram array<int>, share array<float>")
    model = fit_in_task(sample, lambda pdf: fit(pdf, idf))
    if model is None:
        return named.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return named.select(F.col("doc_id").cast("string"), "text", "held_out").mapInPandas(
        lambda batches: _predict(batches, model), "doc_id string, held_out boolean, lang_pred string, score double").withColumn(
        "doc_id", F.col("doc_id").cast("long"))
