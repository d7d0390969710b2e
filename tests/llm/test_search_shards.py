"""Top-k search, sharding, license scans, packing."""

from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from conftest import SCHEMA, edge_rows, prose

from faultline.llm import licenses, packing, sharding, topk

VECTORS = "vec_id long, embedding array<float>, label int, score long, rank int"


def slow_search(rows, k=5, every=50):
    good = [(r[0], [int(np.floor(256 * float(np.float32(x)))) for x in r[1]]) for r in rows
            if r[1] and all(x is not None and np.isfinite(x) for x in r[1])]
    out = set()
    for q, v in good:
        if q is None or q % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), c is None, c or 0) for c, w in good if c != q and len(w) == len(v)]
        out |= {(q, i + 1, None if none else c, -s) for i, (s, none, c) in enumerate(sorted(scored)[:k])}
    return out


def test_search_matches_brute_force(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(0, 0.3, 8).tolist(), 0, 1, 1) for i in range(400)]
    rows += [(1000 + i, rows[0][1], 0, 1, 1) for i in range(30)]  # ties
    rows += [(500, None, 0, 1, 1), (550, [], 0, 1, 1), (600, [0.1, None] * 4, 0, 1, 1), (650, [float("nan")] * 8, 0, 1, 1),
             (700, [float("inf")] * 8, 0, 1, 1), (750, [0.5, 0.25], 0, 1, 1), (751, [0.5, 0.5], 0, 1, 1), (None, rows[50][1], 0, 1, 1),
             (800, [3.0e6] * 8, 0, 1, 1), (801, [-3.0e6] * 8, 0, 1, 1)]
    got = topk.search(spark.createDataFrame(rows, VECTORS).repartition(5))
    assert {tuple(r) for r in got.collect()} == slow_search(rows)
    assert topk.search(spark.createDataFrame([], VECTORS)).count() == 0
    assert topk.search(spark.createDataFrame(rows[1:40], VECTORS)).count() == 0


def test_search_in_several_batches(spark, monkeypatch):
    draw = np.random.default_rng(4)
    rows = [(i, draw.normal(0, 0.5, 4).tolist(), 0, 1, 1) for i in range(300)]
    monkeypatch.setattr(topk, "BATCH_CELLS", 40)
    got = topk.search(spark.createDataFrame(rows, VECTORS), k=3, every=10)
    assert {tuple(r) for r in got.collect()} == slow_search(rows, 3, 10)


@pytest.mark.parametrize("limit", [1, 700, 20_000, 10_000_000])
def test_shards_are_the_shortest_prefixes_that_fit(spark, edges, limit):
    got = sharding.shards(edges, limit).collect()
    assert len(got) == len(edge_rows())
    of = defaultdict(list)
    for r in got:
        of[r.shard].append(r)
        assert len(r.shard) == r.depth
    names = sorted(of)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for shard, rows in of.items():
        assert sum(r.bytes for r in rows) == rows[0].shard_bytes and len(rows) == rows[0].shard_docs
        assert rows[0].shard_bytes <= limit or len(rows) == 1
        if shard:
            above = [r for r in got if r.shard.startswith(shard[:-1])]
            assert sum(r.bytes for r in above) > limit and len(above) > 1


def test_rows_of_one_id_are_split(spark, nothing, clashing):
    rows = spark.createDataFrame([(7, "x" * 100, "en", "a", 1)] * 50, SCHEMA)
    got = sharding.shards(rows, 400).collect()
    assert len(got) == 50 and max(r.shard_bytes for r in got) <= 400 and min(r.depth for r in got) > 60
    assert sharding.shards(nothing).count() == 0 and sharding.shards(clashing).count() == len(edge_rows())
    assert "Python" not in sharding.shards(rows)._jdf.queryExecution().executedPlan().toString()


def test_write_shards(spark, tmp_path):
    rows = spark.createDataFrame([(i, prose(i, 40), "en", "a", 1) for i in range(60)], SCHEMA)
    sharding.write_shards(rows, str(tmp_path / "out"), 3000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(r.doc_id for r in back.collect()) == Counter(range(60))
    assert back.select("shard_prefix").distinct().count() > 4


def brute_coverage(template, words):
    """Longest common subsequence of a template with any stretch of about its length."""
    best = 0
    for at in range(max(1, len(words) - len(template) + 1)):
        part = words[max(0, at - 2):at + len(template) + 2]
        row = [0] * (len(part) + 1)
        for x in template:
            new = [0]
            for j, y in enumerate(part):
                new.append(max(row[j + 1], new[-1], row[j] + (x == y)))
            row = new
        best = max(best, row[-1])
    return best / len(template)


def test_license_scan(spark, edges, nothing, clashing):
    header = licenses.TEMPLATES["Apache-2.0-header"]
    cut = header.split()
    rows = [(1, prose(1, 300) + "\n" + header + "\n" + prose(2, 300), "en", "a", 1),
            (2, prose(3, 50) + " " + " ".join(cut[:20] + ["changed"] + cut[21:40] + cut[42:]), "en", "a", 1),
            (3, "Released under the MIT License. " + prose(4, 40) + "\nRELEASED under the MIT licence, released under the MIT license", "en", "a", 1),
            (4, "This software license is modified without warranties " * 5, "en", "a", 1), (5, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = licenses.scan(docs).collect()
    index = licenses.Index(licenses.TEMPLATES)
    have = {(r.doc_id, r.license) for r in got}
    want = {(d, name) for d, text, *_ in rows for name, template in index.words.items()
            if brute_coverage(template, [w for w, _, _ in licenses.split(text or "")]) >= licenses.COVERAGE}
    assert have == want and (2, "Apache-2.0-header") in have
    assert sum(r.doc_id == 3 for r in got) == 3  # one of them with another spelling
    for r in got:
        text = rows[r.doc_id - 1][1]
        part = [w for w, _, _ in licenses.split(text[r.start_char:r.end_char])]
        assert brute_coverage(index.words[r.license], part) >= r.coverage - 1e-9
    assert licenses.scan(nothing).count() == 0
    licenses.scan(clashing).collect()
    assert licenses.scan(edges, {"own": "日本語 テキスト です ещё"}).count() == 1


def pieces_of(docs):
    return packing.pack(docs).collect()


def check_pieces(rows, texts):
    """Every id lies in one piece, sequences hold at most the limit and have no gaps."""
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    want = [(d, np.array(whole.encode(t or "", add_special_tokens=False).ids + [1], np.uint32)) for d, t in texts]
    of, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, ids in want:
        mine = [r for r in of[doc_id] if r.doc_tokens == len(ids) and crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32]
        at = 0
        for r in sorted(mine, key=lambda r: r.start):
            if r.start == at:
                at += r.length
        assert at == len(ids), doc_id
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in want)
    padding = 0
    for found in sequences.values():
        found.sort(key=lambda r: r.offset)
        at = 0
        for r in found:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= packing.LIMIT
        padding += 0 if at & (at - 1) == 0 else packing.LIMIT - at
    return padding


def test_packing_round_trip(spark, edges, nothing, clashing):
    check_pieces(pieces_of(edges), [(r[0], r[1]) for r in edge_rows()])
    rows = [(i, ". ".join(prose(100 * i + j, 12) for j in range(i % 40)), "en", "a", 1) for i in range(300)]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    got = pieces_of(docs)
    padding = check_pieces(got, [(r[0], r[1]) for r in rows])
    assert padding < 0.02 * sum(r.length for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, pieces_of(docs)))
    assert packing.pack(nothing).count() == 0
    assert packing.pack(clashing).count() >= len(edge_rows())


def test_encoder_on_odd_spaces():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    encoder = packing.Encoder("byte_bpe_50k")
    texts = ["  a  b", "x\n y", " lead", "tail ", "a\tb c", "don't can't", "<|endoftext|> a <|endoftext|>b", "", "\n\n", "a\x85 b \x1c c　d", "é è  日本 語", "x " * 50]
    assert [x.tolist() for x in encoder.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_cuts_are_the_cheapest():
    draw = np.random.default_rng(1)
    for _ in range(60):
        n = int(draw.integers(1, 60))
        places = np.unique(np.concatenate([[0, n], draw.integers(0, n + 1, int(draw.integers(1, 40)))]))
        while np.diff(places).max() > 16:
            i = int(np.diff(places).argmax())
            places = np.insert(places, i + 1, (places[i] + places[i + 1]) // 2)
        costs = draw.integers(0, 30, len(places))
        total, back = packing.best_cuts(places, costs, 16)
        least = [0] + [None] * (len(places) - 1)
        for j in range(1, len(places)):
            for i in range(j):
                size = int(places[j] - places[i])
                if size <= 16:
                    value = least[i] + int(costs[j]) + packing.SEQUENCE_COST + (0 if size & (size - 1) == 0 else 16 - size)
                    least[j] = value if least[j] is None else min(least[j], value)
        assert total == least


def test_license_with_one_edit():
    """Every template with a word changed, added or removed at each place is found where 80 % are left."""
    index = licenses.Index(licenses.TEMPLATES)
    for name, words in index.words.items():
        for at in range(len(words)):
            for edited in (words[:at] + ["other"] + words[at + 1:], words[:at] + ["other"] + words[at:], words[:at] + words[at + 1:]):
                text = "first " + " ".join(edited) + " last"
                if brute_coverage(words, edited) >= licenses.COVERAGE:
                    assert name in {m[0] for m in licenses.scan_text(text, index)}, text
    assert [m[0] for m in licenses.scan_text("Licensed under the MIT License. " * 3, index)] == ["MIT"] * 3


def test_fingerprints_are_winnowed():
    """Any run of gram + window - 1 words holds a fingerprint that templates and texts select alike."""
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in draw.integers(0, 60, 400)]
    for gram, window in ((1, 1), (2, 1), (1, 3), (2, 2), (3, 4)):
        hashes = licenses.grams_of(licenses.hashed(words), gram)
        assert len(hashes) == len(words) - gram + 1
        slow = {max(i for i in range(a, a + window) if hashes[i] == min(hashes[a:a + window])) for a in range(len(hashes) - window + 1)}
        assert set(licenses.selected(hashes, window).tolist()) == slow
        for at in range(0, 380, 7):
            run = words[at:at + gram + window - 1]
            other = ["x", "y", *run, "z", "u"]
            here = licenses.grams_of(licenses.hashed(other), gram)
            mine = {int(here[i]) for i in licenses.selected(here, window) if 2 <= i <= 1 + window}
            assert mine & {int(hashes[i]) for i in licenses.selected(hashes, window)}
    assert not len(licenses.selected(licenses.grams_of(licenses.hashed(["one"]), 2), 2))
    index = licenses.Index(licenses.TEMPLATES)
    for key, places in index.at.items():
        for name in {n for found in places.values() for n, _ in found}:
            chosen = licenses.selected(licenses.grams_of(licenses.hashed(index.words[name]), key[0]), key[1])
            assert sorted(j for found in places.values() for n, j in found if n == name) == chosen.tolist()
            assert key[1] == 1 or len(chosen) < len(index.words[name]) - key[0]


def test_whole_license_with_scattered_edits():
    """Whole texts are found with a fifth of their words changed, dropped or preceded by others, wherever these are."""
    draw = np.random.default_rng(6)
    index = licenses.Index(licenses.TEMPLATES)
    for name, words in index.words.items():
        missing = licenses.missing_of(len(words), licenses.COVERAGE)
        extra = licenses.band_of(len(words))
        for even in (True, False) * 10:
            places = np.linspace(0, len(words) - 1, missing).astype(int) if even else draw.choice(len(words), missing, replace=False)
            edited = [f"other{i}" if i in set(places.tolist()) else w for i, w in enumerate(words)]
            at = int(draw.integers(0, len(words)))
            edited[at:at] = ["more"] * int(draw.integers(0, extra + 1))
            found = {m[0]: m for m in licenses.scan_text("before it " + " ".join(edited) + " after it", index)}
            assert name in found and found[name][1] == len(words) - missing
    long = " ".join(prose(i, 500) for i in range(40))
    text = long + " " + licenses.TEMPLATES["Zlib"] + " " + long
    (match,) = licenses.scan_text(text, index)
    assert match[0] == "Zlib" and match[3] == 1 and match[4] == len(long) + 1 and match[5] == len(long) + len(licenses.TEMPLATES["Zlib"])
