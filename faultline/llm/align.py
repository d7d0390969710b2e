"""Cross-tokenizer alignment: how two tokenizers' ids of the same bytes meet, in each document and over the corpus.

A space and the text are encoded by a byte-level vocabulary (A) and by a piece vocabulary (B). The bytes where tokens of both
end cut the tokens into groups. An A and a B token are linked if their byte ranges overlap; the ends of either cut the bytes
into intervals, and each interval is one link, so links need no search. Over single spaces neither vocabulary has tokens, so
texts are cut there and a word's ids are remembered.

Over the corpus, links are kept inverted: each pair of ids has compressed bitmaps of the documents that hold it, one for
each bit of its multiplicity in them (its planes). Documents are numbered within a span of at most 65,536 of them; where a plane
holds few it is a list of numbers, otherwise a map of bits. Spans hold different documents, so the OR of a pair's bitmaps
over spans is their concatenation: bits are counted span by span and added up, documents over the OR of the planes, links
over the planes by their weight. A pair's total then returns to the spans that hold it, where each plane adds its pair's
score to the documents in it. No pair, id or document is gathered in one place but a span, whose size
is bounded.

Texts that are null, empty, or not rebuilt by either vocabulary's bytes have no tokens: zeros, and ''. Very long texts are
read in pieces cut at single spaces. Null ids, repeated ids and repeated rows are documents of their own. Pairs tied for
the highest count of a B id are all best. An empty table gives an empty result. Other columns may have any names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import keep
from faultline.llm.packing import has_runs

#: A pair is ``a << SHIFT | b``; keys hold a pair and a document's number in its span.
SHIFT, DOC_BITS = 20, 16
#: A span ends after so many documents, or so many pairs of documents.
SPAN_DOCS, SPAN_ENTRIES = 1 << DOC_BITS, 6_000_000
#: Words of a piece of text, and bytes aligned at once.
PIECE_WORDS, BATCH_BYTES = 1 << 16, 1 << 21
MOST_WORDS = 400_000

_CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> Iterator[list[str]]:
    """The words of a text, cut at spaces that touch no other white space, in lists of bounded length."""
    if len(text) < BATCH_BYTES:
        words = _CUT.split(text) if has_runs(text) else text.split(" ")
        for at in range(0, len(words), PIECE_WORDS):
            yield words[at:at + PIECE_WORDS]
        return
    at = 0
    while at < len(text):
        cut = _CUT.search(text, min(at + BATCH_BYTES, len(text)))
        end = cut.start() if cut else len(text)
        yield _CUT.split(text[at:end])
        at = end + 1 if cut else end


class Vocabularies:
    """Ids of words with a space before them, by both vocabularies, and the bytes that ids stand for."""

    def __init__(self, a: str, b: str, most: int = MOST_WORDS) -> None:
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(f"{a}.json"))
        self.whole.encode_special_tokens = True
        with open(public_tokenizers.path(f"{a}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, lines)}
        self.words = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.opens = np.array([x[:1] == b" " for x in self.a_bytes])
        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{b}.model"))
        self.b_bytes = [self._piece(i) for i in range(self.model.vocab_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        #: Ids as text with what follows them: in a group, before the B ids, or after a group.
        self.shown = np.array([f"{i}{end}".encode() for size, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for i in range(size) for end in ends], object).tolist()
        self.most = most
        self.a_known: dict[str, bytes] = {}
        self.b_known: dict[str, bytes] = {}
        self.bad: set[str] = set()

    def _piece(self, i: int) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(self.model.id_to_piece(i)[3:5], 16)])
        return b"" if self.model.is_control(i) or self.model.is_unknown(i) else self.model.id_to_piece(i).replace("▁", " ").encode()

    def learn(self, words: set[str]) -> None:
        """Encode the words that aren't known yet."""
        if len(self.a_known) > self.most:
            self.a_known.clear(), self.b_known.clear(), self.bad.clear()
        fresh = list(words - self.a_known.keys())
        plain = [w for w in fresh if w and not has_runs(w) and " " not in w]
        for at in range(0, len(plain), 50_000):
            some = plain[at:at + 50_000]
            ids = np.array(self.words.encode_ordinary(" " + " ".join(some)), np.uint32)
            begin = np.flatnonzero(self.opens[ids])
            if len(begin) != len(some):
                raise ValueError("a word's ids can't be told apart")
            data, ends = ids.tobytes(), np.append(begin[1:], len(ids)) * 4
            self.a_known.update(zip(some, [data[x:y] for x, y in zip((begin * 4).tolist(), ends.tolist())]))
        odd = [w for w in fresh if w not in self.a_known]
        for w, found in zip(odd, self.whole.encode_batch([" " + w for w in odd], add_special_tokens=False)):
            self.a_known[w] = np.array(found.ids, np.uint32).tobytes()
        a_bytes, b_bytes = self.a_bytes, self.b_bytes
        for at in range(0, len(fresh), 50_000):
            some = fresh[at:at + 50_000]
            for w, found in zip(some, self.model.encode(some, num_threads=1)):
                self.b_known[w] = np.array(found, np.uint32).tobytes()
                told = (" " + w).encode("utf-8", "replace")
                if b"".join([b_bytes[i] for i in found]) != told:
                    self.bad.add(w)
                elif b"".join([a_bytes[i] for i in np.frombuffer(self.a_known[w], np.uint32).tolist()]) != told:
                    self.bad.add(w)


class Aligned:
    """What alignment finds in consecutive pieces: counts and shown groups for each, and all links as pairs of ids."""

    def __init__(self, known: Vocabularies, found: list[list[str]]) -> None:
        a_parts, b_parts = ([b"".join([table[w] for w in words]) for words in found] for table in (known.a_known, known.b_known))
        self.n_a, self.n_b = (np.array([len(x) // 4 for x in parts]) for parts in (a_parts, b_parts))
        a, b = (np.frombuffer(b"".join(parts), np.uint32).astype(np.int64) for parts in (a_parts, b_parts))
        a_ends, b_ends = known.a_size[a].cumsum(), known.b_size[b].cumsum()
        marks = np.zeros(int(a_ends[-1]) + 1 if len(a) else 1, np.uint8)
        marks[a_ends] |= 1
        marks[b_ends] |= 2
        ends = np.flatnonzero(marks)  # the intervals, by their ends
        marks = marks[ends].astype(np.int64)
        in_a, in_b, common = marks & 1, marks >> 1, marks == 3
        a_upto, b_upto = in_a.cumsum(), in_b.cumsum()
        self.links = (a[a_upto - in_a] << SHIFT) | b[b_upto - in_b]
        #: The interval at which each piece ends.
        stops = np.searchsorted(ends, a_ends[self.n_a.cumsum() - 1]) if len(a) else np.zeros(0, np.int64)
        self.ends = stops + 1
        self.n_links = np.diff(self.ends, prepend=0)
        groups_upto = common.cumsum()
        self.n_groups = np.diff(groups_upto[stops], prepend=0)
        # In each group its A ids come first, so an id's place follows from how many of the other kind precede its group.
        a_at, b_at = np.flatnonzero(in_a), np.flatnonzero(in_b)
        a_total, b_total = (np.concatenate([[0], upto[common]]) for upto in (a_upto, b_upto))
        group = groups_upto - common
        stream = np.empty(len(a) + len(b), np.int64)
        stream[np.arange(len(a)) + b_total[group[a_at]]] = 2 * a + common[a_at]
        stream[np.arange(len(b)) + a_total[group[b_at] + 1]] = 2 * (b + len(known.a_bytes)) + common[b_at]
        shown, parts = known.shown, stream.tolist()
        both = (self.n_a + self.n_b).cumsum().tolist()
        self.groups = [b"".join([shown[i] for i in parts[x:y]]) for x, y in zip([0, *both], both)]


class _Span:
    """Postings of up to ``SPAN_DOCS`` documents."""

    def __init__(self, number: int) -> None:
        self.number, self.size = number, 0
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.keys.append(keys), self.times.append(times)
        self.size += len(keys)

    def postings(self, size: int) -> pa.RecordBatch:
        """A row for each plane of each pair: how many documents it holds, how many of them no lower plane holds, and its bitmap."""
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        planes = []
        for plane in range(int(times.max()).bit_length()):
            inside = np.flatnonzero(times >> plane & 1)
            if not len(inside):
                continue
            lower = times[inside] & ((1 << plane) - 1)
            pairs, docs = keys[inside] >> DOC_BITS, keys[inside].astype(np.uint16)
            begin = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
            n = np.diff(np.append(begin, len(pairs)))
            planes.append(pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), self.number)), pa.array(pairs[begin]), pa.array(np.full(len(n), plane, np.int8)), pa.array(n.astype(np.int32)),
                 pa.array(np.add.reduceat(lower == 0, begin, dtype=np.int32)), *compressed(docs, begin, n, size)], schema=_POSTING_FIELDS))
        return pa.concat_batches(planes)


def compressed(docs: np.ndarray, begin: np.ndarray, n: np.ndarray, size: int) -> tuple[pa.Array, pa.Array]:
    """Runs of ascending document numbers as lists of 16 bits, or as maps of ``size`` bits where these are shorter; and which are maps."""
    width = -(-size // 16) * 2
    lists = 2 * n <= width
    dense = np.flatnonzero(~lists)
    sizes = np.where(lists, 2 * n, width)
    offsets = np.concatenate([[0], sizes.cumsum()])
    out = np.empty(offsets[-1] // 2, np.uint16)
    kept = np.ones(len(docs), bool)
    for i in dense.tolist():
        bits = np.zeros(width * 8, bool)
        bits[docs[begin[i]:begin[i] + n[i]]] = True
        out[offsets[i] // 2:offsets[i + 1] // 2] = np.packbits(bits, bitorder="little").view(np.uint16)
        kept[begin[i]:begin[i] + n[i]] = False
    place = np.repeat(offsets[:-1][lists] // 2 - begin[lists], n[lists]) + np.flatnonzero(kept)
    out[place] = docs[kept]
    if offsets[-1] >= 1 << 31:
        raise ValueError("a span's postings exceed two gigabytes")
    return pa.array(~lists), pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(out.tobytes())])


@lru_cache(maxsize=1)
def _vocabularies(a: str, b: str) -> Vocabularies:
    return Vocabularies(a, b)


_DOCS = "doc long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_POSTINGS = "span long, pair long, plane byte, n int, fresh int, dense boolean, bits binary"
_DOC_FIELDS = pa.schema([("doc", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                         ("groups_sha256", pa.string())])
_POSTING_FIELDS = pa.schema([("span", pa.int64()), ("pair", pa.int64()), ("plane", pa.int8()), ("n", pa.int32()), ("fresh", pa.int32()), ("dense", pa.bool_()), ("bits", pa.binary())])
_FIELDS = pa.schema([*_DOC_FIELDS, *_POSTING_FIELDS])


class _Reader:
    """Reads the documents of a task and gives rows of documents and of postings."""

    def __init__(self, known: Vocabularies, first: int) -> None:
        self.known, self.next = known, first
        self.span = _Span(first)
        self.docs: list[list] = []  # doc_id, counts, digest
        self.waiting: list[tuple[int, list[str]]] = []  # documents of one piece
        self.bytes = 0

    def add(self, doc_id: int | None, text: str | None) -> Iterator[pa.RecordBatch]:
        if len(self.docs) == SPAN_DOCS:
            yield from self.flush()
            yield from self.give()
        row = [doc_id, 0, 0, 0, 0, None]
        self.docs.append(row)
        if not text:
            return
        parts = list(pieces(text)) if len(text) < BATCH_BYTES else None
        if parts is not None and len(parts) == 1:
            self.waiting.append((len(self.docs) - 1, parts[0]))
            self.bytes += len(text)
            if self.bytes >= BATCH_BYTES:
                yield from self.flush()
            return
        yield from self.flush(keep_last=True)
        self._long(row, pieces(text))
        yield from self.flush()

    def _long(self, row: list, parts: Iterator[list[str]]) -> None:
        """A document of several pieces, which the last row of ``docs`` is for."""
        digest, counts = sha256(), np.zeros(4, np.int64)
        links, times, before = np.zeros(0, np.int64), np.zeros(0, np.int64), b""
        for words in parts:
            self.known.learn(set(words))
            if not self.known.bad.isdisjoint(words):
                return
            found = Aligned(self.known, [words])
            digest.update(before + found.groups[0][:-1])
            before = b";"
            counts += [found.n_a[0], found.n_b[0], found.n_groups[0], found.n_links[0]]
            new, n = np.unique(found.links, return_counts=True)
            links, where = np.unique(np.concatenate([links, new]), return_inverse=True)
            times = np.bincount(where, np.concatenate([times, n])).astype(np.int64)
        row[1:6] = [*counts.tolist(), digest.hexdigest()]
        self.span.add((links << DOC_BITS) | (len(self.docs) - 1), times)

    def flush(self, keep_last: bool = False) -> Iterator[pa.RecordBatch]:
        """Align what waits; end the span if it is full. ``keep_last``: the last document isn't read yet."""
        if self.waiting:
            self.known.learn({w for _, words in self.waiting for w in words})
            good = [(at, words) for at, words in self.waiting if self.known.bad.isdisjoint(words)]
            if good:
                found = Aligned(self.known, [words for _, words in good])
                for i, (at, _) in enumerate(good):
                    self.docs[at][1:6] = [int(found.n_a[i]), int(found.n_b[i]), int(found.n_groups[i]), int(found.n_links[i]), sha256(found.groups[i][:-1]).hexdigest()]
                of = np.repeat(np.array([at for at, _ in good]), found.n_links)
                self.span.add(*np.unique((found.links << DOC_BITS) | of, return_counts=True))
            self.waiting, self.bytes = [], 0
        if not keep_last and self.span.size >= SPAN_ENTRIES:
            yield from self.give()

    def give(self) -> Iterator[pa.RecordBatch]:
        """The rows of the span, and a new one."""
        if not self.docs:
            return
        ids, n_a, n_b, n_groups, n_links, digests = zip(*self.docs)
        count = len(ids)
        rows = pa.RecordBatch.from_arrays(
            [pa.array(np.arange(self.next, self.next + count)), pa.array(ids, pa.int64()), pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links),
             pa.array([d or "" for d in digests])], schema=_DOC_FIELDS)
        yield _wide(rows)
        if self.span.size:
            found = self.span.postings(count)
            for at in range(0, found.num_rows, 100_000):
                yield _wide(found.slice(at, 100_000))
        self.next += count
        self.docs, self.span = [], _Span(self.next)


def _wide(rows: pa.RecordBatch) -> pa.RecordBatch:
    """Rows with all fields, those of the other kind null."""
    have = dict(zip(rows.schema.names, rows.columns))
    return pa.RecordBatch.from_arrays([have.get(f.name, pa.nulls(rows.num_rows, f.type)) for f in _FIELDS], schema=_FIELDS)


def read(docs: DataFrame, a: str = "byte_bpe_50k", b: str = "piece_bpe_32k", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (``doc`` set) and of postings (``pair`` set), from one reading of the texts, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(_vocabularies(a, b), TaskContext.get().partitionId() << 40)
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                yield from reader.add(doc_id, text.as_py())
        yield from reader.flush()
        yield from reader.give()

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return keep(named.mapInArrow(run, f"{_DOCS}, {_POSTINGS}"))


def totals(rows: DataFrame) -> DataFrame:
    """``pair, n_docs, n_links`` of every pair over the corpus, by counting the bits of its planes."""
    return rows.where("pair is not null").groupBy("pair").agg(
        F.sum("fresh").alias("n_docs"), F.sum(F.call_function("shiftleft", F.col("n").cast("long"), F.col("plane").cast("int"))).alias("n_links"))


def pair_counts(docs: DataFrame, **names: str) -> DataFrame:
    """``a_id, b_id, n_docs, n_links`` of every pair of linked ids."""
    counted = totals(read(docs, **names))
    return counted.select(F.shiftright("pair", SHIFT).cast("int").alias("a_id"), F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)).cast("int").alias("b_id"),
                          "n_docs", "n_links")


def _scored(postings: pa.Table, scores: pa.Table) -> pa.Table:
    """Sums of the scores that the postings of a span bring to its documents."""
    best, total = np.zeros(SPAN_DOCS, np.int64), np.zeros(SPAN_DOCS, np.int64)
    if not postings.num_rows:
        return pa.table({"doc": pa.array([], pa.int64()), "n_best": pa.array([], pa.int64()), "count_sum": pa.array([], pa.int64())})
    pairs, first = np.unique(scores.column("pair").to_numpy(), return_index=True)
    count, highest = scores.column("count").to_numpy()[first], scores.column("is_best").to_numpy()[first]
    for part in postings.to_batches(max_chunksize=100_000):
        at = np.searchsorted(pairs, part.column("pair").to_numpy())
        weight = np.left_shift(np.int64(1), part.column("plane").to_numpy().astype(np.int64))
        score, weight = weight * count[at], weight * highest[at]
        bits = part.column("bits").cast(pa.large_binary())
        ends = np.frombuffer(bits.buffers()[1], np.int64)[bits.offset:bits.offset + len(bits) + 1]
        data = np.frombuffer(bits.buffers()[2], np.uint16, ends[-1] // 2)[ends[0] // 2:]
        size, ends = np.diff(ends) // 2, (ends - ends[0]) // 2
        dense = part.column("dense").to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(dense).tolist():
            docs = np.flatnonzero(np.unpackbits(data[ends[i]:ends[i + 1]].view(np.uint8), bitorder="little"))
            total[docs] += score[i]
            best[docs] += weight[i]
        docs = data[np.repeat(~dense, size)]
        np.add.at(total, docs, np.repeat(score[~dense], size[~dense]))
        np.add.at(best, docs, np.repeat(weight[~dense], size[~dense]))
    some = np.flatnonzero(total)
    return pa.table({"doc": postings.column("span")[0].as_py() + some, "n_best": best[some], "count_sum": total[some]})


def align(docs: DataFrame, a: str = "byte_bpe_50k", b: str = "piece_bpe_32k", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its ids, groups and links, and what the corpus says of its links."""
    rows = read(docs, a, b, id_col, text_col)
    counted = keep(totals(rows).withColumn("b_id", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1))))
    highest = counted.groupBy("b_id").agg(F.max("n_links").alias("highest"))  # no more rows than B has ids
    scores = counted.join(F.broadcast(highest), "b_id").select("pair", F.col("n_links").alias("count"), (F.col("n_links") == F.col("highest")).alias("is_best"))
    postings = rows.where("pair is not null")
    # Totals return to a span by its pairs alone; its bitmaps move once, to be read beside them.
    returned = postings.where("fresh > 0").select(F.col("span").alias("to"), F.col("pair").alias("pair")).join(scores, "pair").select("to", "pair", "count", "is_best")
    summed = postings.select("span", "pair", "plane", "dense", "bits").groupBy("span").cogroup(returned.groupBy("to")).applyInArrow(
        _scored, "doc long, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    return rows.where("doc is not null").join(summed, "doc", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
