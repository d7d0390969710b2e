"""Near copies by Jaccard similarity of five-word shingles: fingerprints and MinHash find candidates, their shingle sets decide.

Texts are lower-cased (A-Z) and cut at ASCII white space. A text of fewer than five words is one shingle. A text has a
SimHash fingerprint of its shingles, whose keys (Golay codes, ``golay.py``) find near copies first. Texts of similarity 0.8 differ in
about ten of its bits, more than such keys can bridge, so forty-eight minima in twelve keys of four find the rest: a pair of
similarity 0.8 with 99.8 %, more similar ones more surely. Two texts are linked only
if their sets of 64-bit shingle hashes have a similarity of ``SIMILARITY`` or more. Equal texts are one text from the start;
texts without words are equal.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import keep, word_chunks
from faultline.llm.components import EITHER, linked
from faultline.llm.lines import BITMAP_BITS, bitmap, marked

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ORDERS = np.random.default_rng(5).integers(1, 1 << 62, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash for each run of ``width`` words."""
    n = len(hashes) - width + 1
    out = hashes[:n].copy()
    for i in range(1, width):
        out = (out ^ (out >> np.uint64(29))) * _STEP + hashes[i:n + i]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out ^ (out >> np.uint64(32))


def shingles(text: str | None) -> Iterator[np.ndarray]:
    """The shingle hashes of a text in pieces of bounded size."""
    tail, whole = np.zeros(0, np.uint64), True
    for found in word_chunks((text or "").encode("utf-8", "replace")):
        hashes = np.concatenate([tail, np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))])
        if len(hashes) >= WORDS:
            whole = False
            yield _mixed(hashes, WORDS)
        tail = hashes[-(WORDS - 1):]
    if whole and len(tail):
        yield _mixed(tail, len(tail))


def sketch(text: str | None) -> tuple[int, np.ndarray, int]:
    """The node of a text, equal for equal words, its MinHash keys and its fingerprint; 0 and none without words."""
    least, node = np.full(BANDS * ROWS, np.iinfo(np.uint64).max), xxhash.xxh64()
    ones, total, empty = np.zeros(64, np.int64), 0, True
    for part in shingles(text):
        empty = False
        for at in range(0, len(part), 65536):
            ones += np.unpackbits(part[at:at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
        node.update(part.tobytes())
        for at in range(0, len(part), 4096):
            least = np.minimum(least, (part[at:at + 4096, None] * _ORDERS).min(axis=0))
    if empty:
        return 0, np.zeros(0, np.int64), 0
    keys = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ (keys >> np.uint64(29))) * _STEP + column
    code = np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0]
    return int(np.uint64(node.intdigest()).view(np.int64)), (keys ^ (keys >> np.uint64(32))).view(np.int64), int(code)


def shingle_set(text: str | None) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *shingles(text)]))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= SIMILARITY * (len(x) + len(y) - both) - 1e-9


def _slots(numbers: np.ndarray) -> np.ndarray:
    return numbers ^ (numbers >> 13) ^ (numbers >> 33)


def near_copies(rows: DataFrame, keyed_prints: Callable[[DataFrame], DataFrame], most_bits: int) -> DataFrame:
    """``row, id, component`` of every row of (row, id, text).

    ``keyed_prints`` gives the (key, side, node, code) of (node, print); texts that share such a key and differ in at most
    ``most_bits`` bits are candidates, and so are those that share a MinHash key.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [sketch(text) for text in pdf["text"]]
            yield pd.DataFrame({"row": pdf["row"], "id": pdf["id"], "node": np.array([n for n, _, _ in found], np.int64),
                                "keys": [k for _, k, _ in found], "print": np.array([p for _, _, p in found], np.int64)})

    named = rows.select("row", F.col("id").cast("string").alias("id"), "text")
    every = keep(named.mapInPandas(run, "row long, id string, node long, keys array<long>, print long").withColumn("id", F.col("id").cast("long")))
    nodes = keep(every.groupBy("node").agg(F.min("row").alias("row"), F.min("keys").alias("keys"), F.min("print").alias("print")))

    def keyed() -> DataFrame:
        return nodes.select(F.explode("keys").alias("key"), F.lit(EITHER).cast("byte").alias("side"), "node", F.lit(0).cast("long").alias("code"))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = keep(pairs)
        if pairs.isEmpty():
            return pairs
        asked = keep(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "row"), "node"))
        slot = F.col("row").bitwiseXOR(F.shiftright("row", 13)).bitwiseXOR(F.shiftright("row", 33))
        wanted = bitmap(asked.select(slot.alias("slot")), BITMAP_BITS)

        def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for i in marked(wanted, _slots(pdf["row"].to_numpy(np.int64))).tolist():
                    yield pd.DataFrame({"row": [pdf["row"].iloc[i]], "parts": [shingle_set(pdf["text"].iloc[i]).tobytes()]})

        def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                good = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(pdf["x"], pdf["y"])]
                yield pdf.loc[good, ["a", "b"]]

        found = keep(rows.select("row", "text").mapInPandas(sets, "row long, parts binary").join(asked, "row"))
        both = pairs.join(found.select(F.col("node").alias("a"), F.col("parts").alias("x")), "a").join(
            found.select(F.col("node").alias("b"), F.col("parts").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInPandas(judged, "a long, b long")

    alike = linked(lambda: keyed_prints(nodes.where(F.size("keys") > 0).select("node", "print")), most_bits, verify)
    known = linked(keyed, 64, verify, known=alike)
    return every.join(known, "node", "left").select("row", "id", F.coalesce("component", "node").alias("component"))
