"""Packing token streams into sequences by order-preserving dynamic programming.

The documents of a partition form one stream of ids, in the order in which they are read, each closed by an end id. The
stream is cut into consecutive sequences. A cut may stand after a document, after a sentence, or, where neither comes for
long, between any two words; the last two cost a penalty. A sequence costs the ids it is padded with (none if it is full
or its length is a power of two) and a fixed amount, so that it isn't made of scraps. The cheapest cuts are found from
left to right: costs of a window fall by one with each id, so the best start is the front of a monotone queue over the
last ``limit`` ids, and each power of two is one more candidate.

A partition is streamed: once enough ids are read, all but the last sequences are given out and the rest is carried on.
Ids never leave their task; no shuffle is needed.

Null and empty texts consist of the end id. Null ids are allowed. Repeated rows are packed each. An empty table gives an
empty result. Other columns may have any names. The result depends on how the table is read (files and their splits) and on
nothing else, so a repeated task gives the same rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 2048
END = 1
SENTENCE_COST = 4
BROKEN_COST = 48
SEQUENCE_COST = 16
#: Without a document or sentence end for so many ids, cuts are allowed every ``BROKEN_STEP`` ids.
BROKEN_AFTER = 256
BROKEN_STEP = 64
#: Ids of a stream that are cut at once.
STRETCH = 1 << 18

_WHITE = "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200b)))

RESULT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def has_runs(text: str) -> bool:
    """Whether white space touches a space or ends the text: such a text isn't cut into words."""
    return (text[:1].isspace() or text[-1:].isspace() or "  " in text
            or any(c in text and (f" {c}" in text or f"{c} " in text) for c in _WHITE))


class Encoder:
    """Token ids of whole texts by a byte-level BPE vocabulary.

    The vocabulary's own word pattern starts a word at each single space, so a text falls into words that are encoded
    once and remembered. New words of a batch are encoded in one call: the ids whose bytes begin with a space tell them
    apart. Texts with runs of white space go to the tokenizers library as they are.
    """

    def __init__(self, vocabulary: str, most: int = 400_000) -> None:
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.whole.encode_special_tokens = True
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.words = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}
        self.most = most
        size = max(ranks.values()) + 2
        self.opens, self.closes = np.zeros(size, bool), np.zeros(size, bool)
        for token, i in ranks.items():
            self.opens[i] = token[:1] == b" "
            self.closes[i] = token.rstrip(b"\"')]")[-1:] in (b".", b"!", b"?") or token.endswith(b"\n")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        parts = [None if has_runs(t) else t.split(" ") for t in texts]
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        fresh = list({w for p in parts if p for w in p[1:]} - known.keys())
        for at in range(0, len(fresh), 50_000):
            some = fresh[at:at + 50_000]
            ids = np.array(self.words.encode_ordinary(" " + " ".join(some)), np.uint32)
            begin = np.flatnonzero(self.opens[ids])
            if len(begin) != len(some):
                raise ValueError("a word's ids can't be told apart")
            ends = np.append(begin[1:], len(ids)) * 4
            data = ids.tobytes()
            known.update(zip(some, [data[a:b] for a, b in zip((begin * 4).tolist(), ends.tolist())]))
        out = []
        for t, p in zip(texts, parts):
            if p is None:
                out.append(np.array(self.whole.encode(t, add_special_tokens=False).ids, np.uint32))
            else:
                head = np.array(self.words.encode_ordinary(p[0]), np.uint32).tobytes()
                out.append(np.frombuffer(head + b"".join([known[w] for w in p[1:]]), np.uint32))
        return out


def cuts(ids: np.ndarray, closes: np.ndarray, doc_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in a stream where a cut is allowed, 0 and the end of the stream included, and what a cut there costs."""
    cost = np.full(len(ids) + 1, -1, np.int64)
    cost[1:][closes[ids]] = SENTENCE_COST
    cost[doc_ends] = 0
    cost[0] = 0
    if cost[-1] < 0:
        cost[-1] = BROKEN_COST
    places = np.flatnonzero(cost >= 0)
    for i in np.flatnonzero(np.diff(places) > BROKEN_AFTER):
        cost[np.arange(places[i] + BROKEN_STEP, places[i + 1], BROKEN_STEP)] = BROKEN_COST
    places = np.flatnonzero(cost >= 0)
    return places, cost[places]


def best_cuts(places: np.ndarray, costs: np.ndarray, limit: int = LIMIT) -> tuple[list[int], list[int]]:
    """The least cost up to each place, and the number of the place at which its last sequence begins."""
    powers = [1 << b for b in range(limit.bit_length()) if 1 << b < limit]
    where = np.full(int(places[-1]) + 1, -1, np.int64)
    where[places] = np.arange(len(places))
    at, pos, extra = where.tolist(), places.tolist(), costs.tolist()
    total, back = [0] * len(pos), [0] * len(pos)
    queue: deque[tuple[int, int, int]] = deque([(0, 0, 0)])  # cost + place, place, number: costs ascend
    for j in range(1, len(pos)):
        p = pos[j]
        while queue[0][1] < p - limit:
            queue.popleft()
        value, _, best = queue[0]
        least = value + limit - p
        for step in powers:
            if step > p:
                break
            i = at[p - step]
            if i >= 0 and total[i] < least:
                least, best = total[i], i
        total[j] = least = least + extra[j] + SEQUENCE_COST
        back[j] = best
        value = least + p
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, p, j))
    return total, back


class _Stream:
    """Documents that aren't yet given out, and the sequences cut from them."""

    def __init__(self, encoder: Encoder, limit: int, first: int) -> None:
        self.encoder, self.limit, self.sequence = encoder, limit, first
        self.ids: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, ids of it given out before, all ids of it
        self.length = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(np.append(ids, np.uint32(END)))
        self.docs.append((doc_id, 0, len(ids) + 1))
        self.length += len(ids) + 1

    def give(self, last: bool) -> list[tuple]:
        if not self.length:
            return []
        ids = np.concatenate(self.ids)
        sizes = np.array([whole - done for _, done, whole in self.docs])
        ends = np.cumsum(sizes)
        places, costs = cuts(ids, self.encoder.closes, ends)
        total, back = best_cuts(places, costs, self.limit)
        j = len(places) - 1
        chain = [j]
        while j:
            j = back[j]
            chain.append(j)
        marks = places[chain[::-1]].tolist()
        if not last:  # the end of the stream isn't known yet
            marks = marks[:-4]
        out, doc, stop = [], 0, 0
        for a, b in zip(marks, marks[1:]):
            at = a
            while at < b:
                doc_id, done, whole = self.docs[doc]
                begin = int(ends[doc]) - (whole - done)
                upto = min(b, int(ends[doc]))
                out.append((doc_id, done + at - begin, upto - at, crc32(ids[at:upto].tobytes()), whole, self.sequence, at - a))
                at = upto
                doc += upto == ends[doc]
            self.sequence += 1
            stop = b
        if doc < len(self.docs):
            doc_id, done, whole = self.docs[doc]
            begin = int(ends[doc]) - (whole - done)
            self.docs = [(doc_id, done + stop - begin, whole), *self.docs[doc + 1:]]
        else:
            self.docs = []
        self.ids, self.length = [ids[stop:]], len(ids) - stop
        return out


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """One row per piece of a document: its place in the document, its checksum, and its place in a sequence."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        stream = _Stream(encoder, limit, TaskContext.get().partitionId() << 32)
        names = RESULT.replace(" long", "").split(", ")

        def frame(rows: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            return out

        for pdf in batches:
            ids = [None if x is None or pd.isna(x) else int(x) for x in pdf["doc_id"].tolist()]
            texts = [t or "" for t in pdf["text"]]
            for at in range(0, len(ids), 256):
                for doc_id, tokens in zip(ids[at:at + 256], encoder.encode(texts[at:at + 256])):
                    stream.add(doc_id, tokens)
                    if stream.length > STRETCH:
                        yield frame(stream.give(last=False))
        yield frame(stream.give(last=True))

    named = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInPandas(run, RESULT)
