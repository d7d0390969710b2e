"""Cross-tokenizer alignment against token by token comparison."""

from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from conftest import CLASHING, SCHEMA, edge_rows, prose

from faultline.llm import align, queries


def slow_align(texts):
    """A row of values per text, by comparing every A token with every B token that may overlap it."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    # The byte-level alphabet: printable characters stand for themselves, the other bytes for those from 256 on.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    code = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in set(shown))}
    assert sorted(code) == sorted(ByteLevel.alphabet())
    found = []
    for text in texts:
        row = ([], [], [], [])
        if text:
            told = (" " + text).encode()
            a, b = whole.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
            a_told = [bytes(code[c] for c in whole.id_to_token(i)) for i in a]
            b_told = [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(a_told) == told and b"".join(b_told) == told:
                spans = [np.concatenate([[0], np.cumsum([len(x) for x in t])]).tolist() for t in (a_told, b_told)]
                links, at = [], 0
                for i in range(len(a)):
                    while spans[1][at + 1] <= spans[0][i]:
                        at += 1
                    j = at
                    while j < len(b) and spans[1][j] < spans[0][i + 1]:
                        links.append((a[i], b[j]))
                        j += 1
                ends = sorted(set(spans[0][1:]) & set(spans[1][1:]))
                groups, x, y = [], 0, 0
                for end in ends:
                    i, j = x, y
                    while i < len(a) and spans[0][i + 1] <= end:
                        i += 1
                    while j < len(b) and spans[1][j + 1] <= end:
                        j += 1
                    groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
                    x, y = i, j
                row = (a, b, groups, links)
        found.append(row)
    count = Counter(p for *_, links in found for p in links)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    rows = [(len(a), len(b), len(groups), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
             sha256(";".join(groups).encode()).hexdigest() if a else "") for a, b, groups, links in found]
    held = Counter(p for *_, links in found for p in set(links))
    return rows, {p: (held[p], n) for p, n in count.items()}


def got(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


ODD = ["a  b", " a", "a ", "a\nb \n c", "x▁y", "<|endoftext|> <s> </s> <0x41> <unk>", "  x ", "don't  STOP\t\tit's", "\r\n\r\n", "a" * 3000,
       " ", "​́é", "\U0001f600 \U0001f600‍\U0001f600", "日本語テキスト", "1234567890 12 345", "\x1c a", "it’s  　 ok"]


def test_alignment(spark, nothing):
    rows = edge_rows() + [(100 + i, t, "en", "a", 1) for i, t in enumerate(ODD)]
    want, pairs = slow_align([r[1] for r in rows])
    table = spark.createDataFrame([r + (1, "g", 2, 3, "c", 4, "l", "s", 5, 6, 7) for r in rows], CLASHING)
    assert got(align.align(table)) == Counter((r[0], *w) for r, w in zip(rows, want))
    found = {(r.a_id, r.b_id): (r.n_docs, r.n_links) for r in align.pair_counts(table).collect()}
    assert found == pairs
    assert align.align(nothing).count() == 0
    assert got(align.align(spark.createDataFrame([(1, None, "en", "a", 1), (2, "", "en", "a", 1)], SCHEMA))) == Counter([(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


@pytest.mark.parametrize("small", [True, False])
def test_pieces_and_spans(monkeypatch, small):
    """Texts in pieces, several spans, lists and maps of bits give what one reading gives."""
    if small:
        monkeypatch.setattr(align, "SPAN_DOCS", 16)
        monkeypatch.setattr(align, "PIECE_WORDS", 7)
        monkeypatch.setattr(align, "BATCH_BYTES", 300)
        monkeypatch.setattr(align, "SPAN_ENTRIES", 900)
    texts = [prose(i % 37, 1 + i % 60) + ODD[i % len(ODD)] * (i % 3 == 0) for i in range(150)] + [None, "", prose(1, 300), " ".join(ODD) * 3]
    want, pairs = slow_align(texts)
    reader = align._Reader(align._vocabularies("byte_bpe_50k", "piece_bpe_32k"), 1 << 40)
    found = [b for i, t in enumerate(texts) for b in reader.add(i, t)]
    found += [*reader.flush(), *reader.give()]
    docs = [r for b in found for r in b.to_pylist() if r["doc"] is not None]
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in docs] == [(*w[:4], w[6]) for w in want]
    assert [r["doc"] for r in docs] == [(1 << 40) + i for i in range(len(texts))]
    n_docs, n_links = Counter(), Counter()
    for b in found:
        for r in b.to_pylist():
            if r["pair"] is not None:
                pair = (r["pair"] >> align.SHIFT, r["pair"] & (1 << align.SHIFT) - 1)
                n_docs[pair] += r["fresh"]
                n_links[pair] += r["n"] << r["plane"]
    assert {p: (n_docs[p], n) for p, n in n_links.items()} == pairs
    assert any(r["dense"] for b in found for r in b.to_pylist() if r["pair"] is not None)


def test_query_matches_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want, _ = slow_align([r.text for r in rows])
    assert got(queries.op11_alignment(spark, "/root/testdata/sf0.001")) == Counter((r.doc_id, *w) for r, w in zip(rows, want))
