"""SimHash near-duplicates found with Golay-code fuzzy hashing.

A fingerprint has 64 bits and is cut into three segments of 22, 21 and 21 bits. The binary Golay code of length 23 is
perfect: every word lies within three bits of exactly one codeword, which is the word's index. The indices of all words
one flip away from a segment are the few (up to six) codewords near it.

Links allow three different bits. Shared out over three segments they leave, in every case, one of these:

* two segments are equal: a key is the pair of segments;
* one segment is equal and another differs in one bit: that flip changes the segment's parity, so even fingerprints give
  their index and odd ones the indices of the codewords nearby;
* every segment differs in one bit: even fingerprints (by the first segment) give the codewords near their first segment and
  the indices of the others, odd ones the reverse.

So every link shares a key of 34 to 43 bits, about 40 keys a fingerprint; equal keys are compared bit by bit. Fingerprints
are compared once each, however many documents have one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import keep, numbered, word_chunks
from faultline.llm.components import EITHER, FIRST, SECOND, linked
from faultline.llm.shingles import near_copies

SHINGLE = 3
SEED = 42
MOST_BITS = 3

#: Generator of the binary Golay code and its length (fixed values).
GENERATOR = 0b110001110101
LENGTH = 23

WIDTHS = (22, 21, 21)
SHIFTS = (0, 22, 43)


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders by the generator polynomial."""
    left = words.astype(np.int64)
    for bit in range(LENGTH - 1, 10, -1):
        left = np.where((left >> bit) & 1 == 1, left ^ (GENERATOR << (bit - 11)), left)
    return left


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """The error pattern of up to three bits for each of the 2048 remainders."""
    patterns = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(LENGTH), n)])
    table = np.zeros(1 << 11, np.int64)
    table[_syndromes(patterns)] = patterns
    return table


def indices(words: np.ndarray) -> np.ndarray:
    """The codeword index (12 bits) of each word."""
    return (words ^ _errors()[_syndromes(words)]) >> 11


def nearby(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct indices of all words one flip away, as (row, index)."""
    flips = 1 << np.arange(width)
    syndromes = _syndromes(words)[:, None] ^ _syndromes(flips)[None, :]
    found = np.sort((words[:, None] ^ flips[None, :] ^ _errors()[syndromes]) >> 11, axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, cols = np.nonzero(new)
    return rows, found[rows, cols]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys of the fingerprints as (row, key, side)."""
    parts = [((prints.view(np.uint64) >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in zip(SHIFTS, WIDTHS)]
    index = [indices(p) for p in parts]
    near = [nearby(p, w) for p, w in zip(parts, WIDTHS)]
    odd = [np.bitwise_count(p).astype(np.int64) & 1 for p in parts]
    every = np.arange(len(prints))
    out: list[tuple[np.ndarray, np.ndarray, int]] = []

    def add(tag: int, rows: np.ndarray, keys: np.ndarray, side: int) -> None:
        out.append((rows, keys | (tag << 44), side))

    for tag, (i, j) in enumerate(combinations(range(3), 2)):
        add(tag, every, parts[i] | (parts[j] << WIDTHS[i]), EITHER)
    for tag, (i, j) in enumerate(((i, j) for i in range(3) for j in range(3) if i != j), 3):
        even = every[odd[j] == 0]
        add(tag, even, parts[i][even] | (index[j][even] << 22), FIRST)
        rows, at = near[j]
        rows, at = rows[odd[j][rows] == 1], at[odd[j][rows] == 1]
        add(tag, rows, parts[i][rows] | (at << 22), SECOND)
    turned = odd[1] | (odd[2] << 1)  # both parities differ between the two sides
    rows, at = near[0]
    rows, at = rows[odd[0][rows] == 0], at[odd[0][rows] == 0]
    add(9, rows, at | (index[1][rows] << 12) | (index[2][rows] << 24) | (turned[rows] << 36), FIRST)
    rows, at = near[1]
    rows, at = rows[odd[0][rows] == 1], at[odd[0][rows] == 1]
    count = np.bincount(near[2][0], minlength=len(prints))
    begin = np.cumsum(count) - count
    again = np.repeat(np.arange(len(rows)), count[rows])
    rank = np.arange(len(again)) - np.repeat(np.cumsum(count[rows]) - count[rows], count[rows])
    rows, at = rows[again], at[again]
    other = near[2][1][begin[rows] + rank] if len(rows) else at
    add(9, rows, index[0][rows] | (at << 12) | (other << 24) | ((turned[rows] ^ 3) << 36), SECOND)
    return (np.concatenate([r for r, _, _ in out]), np.concatenate([k for _, k, _ in out]),
            np.concatenate([np.full(len(r), s, np.int8) for r, _, s in out]))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a text, read in pieces so that a long one needs little memory; 0 without words."""
    ones, total, tail, whole = np.zeros(64, np.int64), 0, [], True
    for found in word_chunks((text or "").encode()):
        found = tail + found
        if len(found) >= shingle:
            whole = False
            line = b" ".join(found)
            ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
            starts = [0, *ends[:-shingle].tolist()]
            hashes = np.array([xxhash.xxh64_intdigest(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())], np.uint64)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = found[-(shingle - 1):]
    if whole:
        if not tail:
            return 0
        return xxhash.xxh64_intdigest(b" ".join(tail), seed)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, print`` of every row, the fingerprint as a signed number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            prints = np.array([fingerprint(t) for t in pdf["text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "print": prints})

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(run, "doc_id long, print long")


def _keyed(prints: DataFrame, node: str = "print") -> DataFrame:
    """The keys of the fingerprints in ``print`` as (key, side, node, code)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values, names = pdf["print"].to_numpy(np.int64), pdf["name"].to_numpy(np.int64)
            for at in range(0, len(values), 4096):
                part = values[at:at + 4096]
                rows, keys, sides = keys_of(part)
                yield pd.DataFrame({"key": keys, "side": sides, "node": names[at:at + 4096][rows], "code": part[rows]})

    return prints.select("print", F.col(node).alias("name")).mapInPandas(run, "key long, side byte, node long, code long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Null and empty texts have fingerprint 0. A component is named by its smallest id; null ids are rows of their own and
    name a component only if it has no other id. Repeated rows give repeated results. Empty tables give an empty result,
    and other columns may have any names.
    """
    every = keep(fingerprints(docs, id_col, text_col))
    prints = keep(every.groupBy("print").agg(F.min("doc_id").alias("least")))
    found = linked(lambda: _keyed(prints), MOST_BITS)
    named = prints.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn("component", F.coalesce("component", "print"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = named.join(names, "component").select("print", "component_id")
    return every.join(of.hint("merge"), "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one row of each group of near copies kept, the one with the smallest id, with their own columns.

    Near copies share 0.8 of their five-word shingles (``shingles.py``). Golay keys of the fingerprints of these shingles
    find them first, at most ``MOST_BITS`` bits apart; MinHash finds those of 0.8 that are further apart.
    Rows are numbered first and decided one by one, so rows that share an id, or have none, but not their text stay. A row
    with an id goes before one without; of rows with the same id the first by number is kept.
    """
    rows = numbered(docs)
    every = keep(near_copies(rows.select(F.col("_row").alias("row"), F.col("_doc")[id_col].cast("long").alias("id"), F.col("_doc")[text_col].alias("text")), lambda prints: _keyed(prints, "node"), MOST_BITS))
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    best = every.groupBy("component").agg(F.min(order)["row"].alias("best"))
    # Few documents go, so the numbers that go are looked up rather than those that stay.
    # They are a table of their own, whose size Spark knows when it chooses the join.
    gone = keep(every.join(best, "component").where("row <> best").select(F.col("row").alias("_row")))
    return rows.join(gone, "_row", "left_anti").select("_doc.*")
