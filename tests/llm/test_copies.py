"""Near-copies, lines, components."""

import re
from collections import Counter

import numpy as np
import xxhash
from conftest import SCHEMA, edge_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from faultline.llm import components, golay, lines
from faultline.llm.common import keep

WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Sets:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows):
    prints = [(r[0], slow_print(r[1])) for r in rows]
    sets = Sets()
    for i, (_, a) in enumerate(prints):
        for _, b in prints[i:]:
            if (a ^ b).bit_count() <= 3:
                sets.join(a, b)
    least = {}
    for d, p in prints:
        if d is not None:
            least[sets.find(p)] = min(d, least.get(sets.find(p), d))
    return Counter((d, f"{p:016x}", least.get(sets.find(p))) for d, p in prints)


def slow_near(texts):
    """The smallest id of each group of texts that share 0.8 of their five-word shingles, by all pairs."""
    sets, found = Sets(), {}
    for d, text in sorted(texts.items()):
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        found[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    for a, x in found.items():
        sets.find(a)
        for b, y in found.items():
            if b < a and len(x & y) >= 0.8 * len(x | y):
                sets.join(a, b)
    return {sets.find(d) for d in found}


def test_every_close_pair_shares_a_key():
    draw = np.random.default_rng(0)
    a = draw.integers(-2**63, 2**63, 4000)
    b = a.copy()
    for i in range(len(b)):
        for bit in draw.choice(64, i % 4, replace=False):
            b[i] ^= np.uint64(1 << int(bit)).view(np.int64)

    def keys(x):
        out = [set() for _ in x]
        for r, k, s in zip(*(v.tolist() for v in golay.keys_of(x))):
            out[r].add((k, s))
        return out

    for x, y in zip(keys(a), keys(b)):
        assert any((k, {0: 1, 1: 0, 2: 2}[s]) in y for k, s in x)


def test_golay_code_is_perfect():
    assert len(np.unique(golay._syndromes(np.nonzero(golay._errors() >= 0)[0]))) == 2048
    words = np.random.default_rng(1).integers(0, 1 << 23, 500)
    centre = words ^ golay._errors()[golay._syndromes(words)]
    assert (golay._syndromes(centre) == 0).all() and (np.bitwise_count(words ^ centre) <= 3).all()
    assert all(len({*golay.nearby(words[i:i + 1], 23)[1].tolist()}) <= 6 for i in range(200))


def test_fingerprint_in_pieces():
    text = " ".join(prose(i, 3000) for i in range(80))
    assert len(text) > 1 << 20 and golay.fingerprint(text) == slow_print(text)


def test_near_duplicates(spark, edges, clashing, nothing):
    base = prose(50, 400).split()
    near = []
    for i in range(60):
        w = list(base)
        w[i * 5] = f"other{i}"
        near.append((1000 + i, " ".join(w), "en", "a", 1))
    rows = edge_rows() + near
    got = golay.near_duplicates(edges.unionAll(spark.createDataFrame(near, SCHEMA))).collect()
    assert Counter(map(tuple, got)) == slow_groups(rows)
    assert golay.near_duplicates(nothing).count() == 0
    kept = golay.one_of_each(clashing)
    assert kept.columns == clashing.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=repr) == sorted({c for _, _, c in slow_groups(edge_rows())}, key=repr)
    assert golay.one_of_each(nothing).count() == 0


def test_dense_and_chained_fingerprints(spark):
    """A cluster whose members don't all link with each other, and a chain."""
    draw = np.random.default_rng(3)
    prints = {0, 7, 0b111111, 0b111111111}
    middle = int(draw.integers(0, 2**62))
    for _ in range(300):
        p = middle
        for bit in draw.choice(20, draw.integers(1, 6), replace=False):
            p ^= 1 << int(bit)
        prints.add(p)
    prints = sorted(prints)
    table = spark.createDataFrame([(p,) for p in prints], "print long")
    got = dict(map(tuple, components_of(table)))
    sets = Sets()
    for i, a in enumerate(prints):
        sets.find(a)
        for b in prints[i:]:
            if (a ^ b).bit_count() <= 3:
                sets.join(a, b)
    want = {p: sets.find(p) for p in prints}
    assert {p: got.get(p, p) for p in prints} == want


def components_of(table):
    from faultline.llm.components import linked

    return linked(lambda: golay._keyed(table), 3).collect()


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, i) for i in range(501, 700)] + [(9000, 8000), (8000, 9000), (3, 3), (77777, 77777)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    sets = Sets()
    for a, b in edges:
        if a != b:
            sets.join(a, b)
    assert got == {x: sets.find(x) for x in sets.up}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", max_size=14), st.text("abcé", max_size=14))
def test_distance(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    assert lines.distance(a, b) == before[-1]


def slow_code(words):
    half = len(words) // 2
    hashes = [xxhash.xxh64_intdigest(w) for part in (words[:half], words[half:]) for w in set(part)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_codes_of_long_lines():
    words = [f"w{i}" for i in range(3000)]
    rows = [words, words[:255], words[:256], words[:6], words[5:600]]
    got = lines.codes([[w.encode() for w in r] for r in rows]).view(np.uint64)
    assert [int(c) for c in got] == [slow_code(r) for r in rows]


def slow_lines(rows):
    """The normalised lines with their places, and all pairs of different fuzzy lines of an edit similarity of 0.8 or more."""
    found = {}
    for doc_id, text, *_ in rows:
        for place, words in lines.normalised(text):
            found.setdefault(b" ".join(words).decode(), []).append((doc_id is not None, doc_id or 0, place))
    fuzzy = sorted((t for t in found if lines.features(t.encode().split(b" "))), key=len)
    size = np.array([len(t) for t in fuzzy])
    # An edit changes the counts of at most six runs of three characters, three on either side.
    counts = np.zeros((len(fuzzy), 1024), np.int16)
    for row, t in zip(counts, fuzzy):
        x = np.frombuffer(t.encode("utf-32-le"), np.uint32)
        row += np.bincount((x[:-2] * 961 + x[1:-1] * 31 + x[2:]) % 1024, minlength=1024).astype(np.int16)
    pairs = []
    for i, a in enumerate(fuzzy):
        upto = int(np.searchsorted(size, size[i] / 0.8 + 1e-9, side="right"))
        most = 0.2 * size[i + 1:upto] + 1e-9
        near = np.abs(counts[i + 1:upto] - counts[i]).sum(axis=1, dtype=np.int64) <= 6 * most
        pairs += [(a, fuzzy[i + 1 + k]) for k in np.flatnonzero(near).tolist() if lines.distance(a, fuzzy[i + 1 + k]) <= most[k]]
    return found, pairs


def check_lines(got, rows, recall=0.9):
    """Groups hold only lines that true links connect and nearly all true links; the first place of a group is kept."""
    found, pairs = slow_lines(rows)
    group = {(r.doc_id, r.line_no): r.group_id for r in got}
    assert set(group) == {(d if known else None, p) for places in found.values() for known, d, p in places}
    of = {}
    for t, places in found.items():
        ids = {group[d if known else None, p] for known, d, p in places}
        assert len(ids) == 1
        of[t] = ids.pop()
    sets, together = Sets(), {}
    for a, b in pairs:
        sets.join(a, b)
    for t, g in of.items():
        together.setdefault(g, set()).add(sets.find(t))
    assert all(len(x) == 1 for x in together.values())
    classes = [("short", 0, 60), ("middle", 60, 200), ("long", 200, 1 << 30)]
    for _, low, high in classes:
        some = [of[a] == of[b] for a, b in pairs if low <= len(a) < high]
        assert sum(some) >= recall * len(some), (low, sum(some), len(some))
    first = {}
    for t, places in found.items():
        first[of[t]] = min([first[of[t]], *places] if of[t] in first else places)
    for r in got:
        assert r.kept == ((r.doc_id is not None, r.doc_id or 0, r.line_no) == first[r.group_id])


def test_line_groups(spark, edges, clashing, nothing):
    base = prose(60, 120).split()
    near = []
    for i in range(40):
        w = list(base)
        w[i * 2] = f"other{i}"
        near.append((2000 + i, prose(3000 + i, 30) + "\n" + " ".join(w) + "\nshort line", "en", "a", 1))
    # All pairs of lines are compared below, so the longest text is cut to some of its lines there.
    rows = [(r[0], "\n".join(r[1].split("\n")[:12]), *r[2:]) if r[0] == 7 else r for r in edge_rows()] + near
    got = lines.line_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert lines.line_groups(edges).count() == 150 + len([r for r in got if r.doc_id != 7 and (r.doc_id or 0) < 2000])
    check_lines(got, rows)
    assert lines.line_groups(nothing).count() == 0
    out = lines.deduplicated(clashing)
    assert out.columns == clashing.columns
    assert lines.deduplicated(nothing).count() == 0


def test_deduplicated_texts(spark):
    a, b, c = prose(1, 20), prose(2, 20), prose(3, 20)
    rows = [(1, f"{a}\nok\n{b}", "en", "s", 5), (2, f"{c}\n{a.upper()}!\nok", "en", "s", 5), (3, b, "en", "s", 5), (4, f"x\n{c}\n{c}", "en", "s", 5),
            (5, None, None, None, None), (6, "", "en", "s", 0)]
    got = {r.doc_id: r for r in lines.deduplicated(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {1, 2, 4, 5, 6}
    assert got[1].text == rows[0][1] and got[1].n_chars == 5
    assert got[2].text == f"{c}\nok" and got[2].n_chars == len(got[2].text)
    assert got[4].text == "x" and got[5].text is None and got[6].text == ""


def test_lines_with_a_common_core(spark):
    """Lines that share words in the middle but are not alike: the pairs compared grow with the lines, links are found."""
    draw = np.random.default_rng(21)
    core = "alpha bravo charlie delta echo foxtrot golf hotel"

    def word():
        return "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 9))

    sizes = []
    for n in (300, 600, 1200):
        rows = [(i, " ".join([word() for _ in range(4)]) + f" {core} " + " ".join([word() for _ in range(4)]), "en", "a", 1) for i in range(n)]
        rows += [(5000 + i, rows[i][1].replace("echo", "ecko"), "en", "a", 1) for i in range(0, n, 10)]
        compared = []

        def counted(pairs, compared=compared):
            pairs = keep(pairs)
            compared.append(pairs.count())
            return pairs

        found = components.linked

        def watched(rows, bits, verify, *rest, **more):
            return found(rows, bits, lambda pairs: verify(counted(pairs)), *rest, **more)

        lines.linked = watched
        try:
            got = {r.doc_id: r.group_id for r in lines.line_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
        finally:
            lines.linked = found
        assert all((got[i] == got[j]) == (j == 5000 + i) for i in range(0, n, 10) for j in (5000 + i, i + 1))
        sizes.append(sum(compared))
    assert sizes[2] < 3 * sizes[1] < 9 * sizes[0], sizes


def edited_lines(draw, n, size):
    """Lines of ``size`` words and copies of them with one word changed, added or removed."""
    letters = list("abcdefghijklmnopqrstuvwxyz")

    def word():
        return "".join(draw.choice(letters, draw.integers(2, 9)))

    out = []
    for _ in range(n):
        words = [word() for _ in range(size)]
        at, how = int(draw.integers(0, size)), int(draw.integers(0, 3))
        out.append((" ".join(words), " ".join(words[:at] + [[word()], [words[at], word()], []][how] + words[at + 1:])))
    return [(a, b) for a, b in out if a != b]


def test_recall_of_edited_lines(spark):
    """Nearly all pairs with an edit similarity of 0.8 or more are linked, whatever their fingerprints."""
    draw = np.random.default_rng(11)
    pairs = [(size, *p) for size in (8, 12, 20, 60) for p in edited_lines(draw, 200, size) if lines.distance(*p) <= 0.2 * max(map(len, p)) + 1e-9]
    rows = [(2 * i + k, text, "en", "a", 1) for i, (_, *p) in enumerate(pairs) for k, text in enumerate(p)]
    group = {r.doc_id: r.group_id for r in lines.line_groups(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(set(group.values())) >= len(pairs)
    for size, least in ((8, 0.9), (12, 0.95), (20, 0.97), (60, 0.99)):
        linked = [group[2 * i] == group[2 * i + 1] for i, p in enumerate(pairs) if p[0] == size]
        assert len(linked) > 100 and sum(linked) >= least * len(linked), (size, sum(linked), len(linked))


def test_short_lines_and_lines_without_spaces(spark):
    japanese = "これは日本語で書かれた長い一行であり単語の間に空白はありませんが複製されています"
    rows = [(1, "All rights reserved.\nok", "en", "s", 1), (2, f"ok\n{japanese}", "ja", "s", 1), (3, f"all rights RESERVED\n{japanese[:20]}新{japanese[21:]}", "ja", "s", 1),
            (4, "no\n" + prose(4, 20), "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {(r.doc_id, r.line_no): r.kept for r in lines.line_groups(docs).collect()}
    assert got == {(1, 0): True, (1, 1): True, (2, 0): False, (2, 1): True, (3, 0): False, (3, 1): False, (4, 0): True, (4, 1): True}
    left = {r.doc_id: r.text for r in lines.deduplicated(docs, short_lines=True).collect()}
    assert left == {1: rows[0][1], 2: japanese, 4: rows[3][1]}


def test_rows_that_share_an_id(spark):
    """Different texts under one id or none all stay; a line is lost only in the row that repeats it."""
    a, b, c, d = (prose(700 + i, 60) for i in range(4))
    rows = [(None, a, "en", "s", 1), (None, b, "en", "s", 1), (7, c, "en", "s", 1), (7, d, "en", "s", 1), (7, c, "en", "t", 1), (9, d, "en", "s", 1), (None, a, "en", "s", 1)]
    left = golay.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted([(0, a), (0, b), (7, c), (7, d)])
    x, y, z = (prose(800 + i, 20) for i in range(3))
    rows = [(None, f"{x}\n{y}", "en", "s", 1), (None, f"{z}\n{x}", "en", "s", 1), (None, f"{a}\n{b}", "en", "s", 1)]
    left = lines.deduplicated(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    assert sorted(r.text for r in left.collect()) == sorted([f"{x}\n{y}", z, f"{a}\n{b}"])


def test_copies_of_four_fifths(spark):
    """Texts of which 0.8 of the five-word shingles agree are one; those of which less agree are not."""
    rows, want = [], set()
    for i in range(60):
        words = [f"{w}{k}" for k, w in enumerate(prose(900 + i, 200).split())]
        for n, changes in enumerate((0, 2, 3, 8)):
            other = [f"new{i}x{k}" if changes and k % (200 // changes) == 9 else w for k, w in enumerate(words)]
            rows.append((10 * i + n, " ".join(other), "en", "s", 1))
        want |= {10 * i, 10 * i + 3}
    left = golay.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert {r.doc_id for r in left.collect()} == want


@settings(max_examples=200, deadline=None)
@given(st.text("abcé", max_size=30), st.text("abcé", max_size=30))
def test_apart_only_beyond_the_distance(a, b):
    assert not lines.apart(a, b, lines.distance(a, b))


def test_distances_of_many_pairs():
    """Counted together, by length and with every kind of letter, as one by one."""
    draw = np.random.default_rng(11)
    pairs = []
    for i in range(3000):
        n, m = (int(draw.choice([0, 1, 5, 63, 64, 65, 127, 128, 129, 200, 400, 1100])) for _ in range(2))
        letters = list("abcdé語😀" if i % 2 else "ab")
        a, b = "".join(draw.choice(letters, n)), "".join(draw.choice(letters, m))
        pairs.append((a, a[:n // 2] + "zz" + a[n // 2 + 1:] if i % 3 else b))
    assert lines.distances(pairs).tolist() == [lines.distance(*p) for p in pairs]
    assert lines.distances([]).tolist() == [] and lines.distances([("", ""), ("a", ""), ("same", "same")]).tolist() == [0, 1, 0]
    wide = [("".join(map(chr, range(0x4E00 + i, 0x4E00 + i + 50))), "".join(map(chr, range(0x4E02 + i, 0x4E00 + i + 50)))) for i in range(0, 4000, 20)]
    assert set(lines.distances(wide).tolist()) == {2}


def test_large_keys_lose_no_pair(spark):
    """Of lines that nearly all share their minima, every two that share a key and are alike are in one group."""
    draw = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")

    def word(n):
        return "".join(draw.choice(letters, n))

    core = " ".join(word(9) for _ in range(8))
    texts = []
    for i in range(240):
        words = [word(4) for _ in range(12)]
        texts.append(" ".join(words[:6] + [core] + words[6:]))
        if i % 4 == 0:
            texts.append(" ".join([word(1) + w[1:] if k % 3 == 1 else w for k, w in enumerate(words[:6])] + [core] + [w[:3] + word(1) if k % 3 == 1 else w for k, w in enumerate(words[6:])]))
    found = [x.encode().split() for x in texts]
    code, keys = lines.codes(found), lines.keys_of(lines.sketches(found))
    x, y = np.nonzero(np.triu(np.bitwise_count((code[:, None] ^ code[None, :]).view(np.uint64)) <= lines.MOST_BITS, 1))
    shared = (keys[x] == keys[y]).any(axis=1)
    assert shared.sum() > 3000
    pairs = [(texts[i], texts[j]) for i, j in zip(x[shared], y[shared])]
    close = lines.distances(pairs) <= [0.2 * max(map(len, p)) + 1e-9 for p in pairs]
    sets = Sets()
    for i, j in zip(x[shared][close].tolist(), y[shared][close].tolist()):
        sets.join(i, j)
    want = [sets.find(i) for i in range(len(texts))]
    assert 150 < len(set(want)) < 280
    group = {r.doc_id: r.group_id for r in lines.line_groups(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)).collect()}
    together = {}
    for i, w in enumerate(want):
        together.setdefault(w, set()).add(group[i])
    assert all(len(g) == 1 for g in together.values()) and len({min(g) for g in together.values()}) == len(together)


def test_tiles_of_a_key(spark, monkeypatch):
    """Small tiles and classes of length give the links that one comparison of all lines gives."""
    draw = np.random.default_rng(9)
    texts = [x for pair in edited_lines(draw, 60, 9) + edited_lines(draw, 60, 14) for x in pair]
    texts = list(dict.fromkeys(texts))
    found = [x.encode().split() for x in texts]
    code, sketch = lines.codes(found), lines.sketches(found)
    sketch[:, 0] = 12345  # all share the first two minima
    key = int(lines.keys_of(sketch)[0, 0])
    nodes = spark.createDataFrame([(i, t, *map(int, sketch[i])) for i, t in enumerate(texts)], "node long, line string, " + ", ".join(f"{s} long" for s in lines.SKETCH))
    large = spark.createDataFrame([(key, i, int(code[i]), i) for i in range(len(texts))], "key long, node long, code long, component long")
    monkeypatch.setattr(lines, "TILE", 16)
    got, want = Sets(), Sets()
    for r in lines._large_links(large, nodes).collect():
        got.join(r.a, r.b)
    for i in range(len(texts)):
        for j in range(i):
            if (int(code[i] ^ code[j]) & (1 << 64) - 1).bit_count() <= lines.MOST_BITS and lines.distance(texts[i], texts[j]) <= 0.2 * max(len(texts[i]), len(texts[j])) + 1e-9:
                want.join(i, j)
    assert [got.find(i) for i in range(len(texts))] == [want.find(i) for i in range(len(texts))]
    assert len({want.find(i) for i in range(len(texts))}) < 0.7 * len(texts)


def test_near_copies_by_golay_keys(spark, monkeypatch):
    """Near copies whose fingerprints differ in few bits are found by Golay keys alone."""
    from faultline.llm import shingles

    plain = shingles.sketch

    def without_minhash(text):
        node, keys, code = plain(text)
        return node, keys ^ np.int64(node), code  # no two texts share such a key

    rows, want = [], set()
    for i in range(40):
        words = [f"{w}{k}" for k, w in enumerate(prose(300 + i, 300).split())]
        other = [*words[:-1], f"new{i}"]
        rows += [(2 * i, " ".join(words), "en", "s", 1), (2 * i + 1, " ".join(other), "en", "s", 1)]
        a, b = (plain(r[1])[2] for r in rows[-2:])
        want |= {2 * i} if ((a ^ b) & (1 << 64) - 1).bit_count() <= golay.MOST_BITS else {2 * i, 2 * i + 1}
    assert len(want) < 60
    monkeypatch.setattr(shingles, "sketch", without_minhash)
    assert {r.doc_id for r in golay.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()} == want


def test_keyed_rows_are_not_broadcast(spark, monkeypatch):
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)

    monkeypatch.setattr(components, "keep", seen)
    words = [f"w{i}" for i in range(400)]
    docs = spark.createDataFrame([(i, " ".join(words[i % 40:i % 40 + 60])) for i in range(80)], "doc_id long, text string")
    assert len({r["component_id"] for r in golay.near_duplicates(docs).collect()}) <= 40
    assert golay.one_of_each(docs).count() <= 40
    keyed = [p for p in plans if ("MapInPandas" in p or "Generate" in p) and "Project [key#" in p.splitlines()[1]]
    assert len(keyed) == 3 and not any("BroadcastHashJoin" in p for p in keyed)


def test_alike_as_by_distances():
    """The bounded comparison, by length and band, says what edit distances say."""
    draw = np.random.default_rng(17)
    pairs = []
    for i in range(4000):
        n = int(draw.choice([0, 1, 5, 63, 64, 65, 127, 128, 129, 200, 400, 700, 1100]))
        letters = list("abcdé語😀" if i % 2 else "ab")
        a = draw.choice(letters, n).tolist()
        b = list(a)
        for _ in range(int(draw.integers(0, max(1, n // 3)))):
            at, how = int(draw.integers(0, len(b) + 1)), int(draw.integers(0, 3))
            b[at:at + (how > 0)] = [str(draw.choice(letters))] if how < 2 else []
        if i % 3 == 0:
            cut = int(draw.integers(0, n // 6 + 1))
            b = b[cut:] + draw.choice(letters, cut).tolist()
        pairs.append(("".join(a), "".join(b)) if i % 5 else ("".join(b), "".join(a)))
    want = lines.distances(pairs) <= [0.2 * max(map(len, p)) + 1e-9 for p in pairs]
    assert 0.2 < want.mean() < 0.8
    assert lines.alike(pairs).tolist() == want.tolist()
    assert lines.alike([]).tolist() == [] and lines.alike([("", ""), ("a", "")]).tolist() == [True, False]


def test_edits_are_counted_no_further_than_needed(monkeypatch):
    """Few pairs, long pairs and shifted ones: as by their distances, none of which is counted in full."""
    rng = np.random.default_rng(11)
    pairs = []
    for n in (3, 40, 150, 700, 2500):
        for _ in range(8):
            a = "".join(rng.choice(list("abcdefg "), n))
            at, share = int(rng.integers(0, n)), rng.uniform(0.05, 0.4)
            b = "".join(rng.choice(list("xyz"), 1)[0] if rng.random() < share else c for c in a)
            cut = int(share * n / 2)
            pairs += [(a, b), (b, a), (a, a[cut:] + b[:cut]), (b[cut:], a), (a, a[:at] + "q" * cut + a[at:]), (a, "".join(rng.permutation(list(a))))]
    most = [int(0.2 * max(map(len, p)) + 1e-9) for p in pairs]
    want = [lines.distance(*p) <= m for p, m in zip(pairs, most)]
    assert 50 < sum(want) < len(want) - 50
    assert [lines.within(*p, m) for p, m in zip(pairs, most)] == want
    monkeypatch.setattr(lines, "distance", None)
    for step in (1, 7, len(pairs)):
        assert [bool(x) for at in range(0, len(pairs), step) for x in lines.alike(pairs[at:at + step])] == want
    many = pairs * 12
    assert lines.alike(many).tolist() == want * 12


def test_words_are_hashed_once(monkeypatch):
    import pandas as pd

    counted = Counter()

    class Counting:
        @staticmethod
        def xxh64_intdigest(data):
            counted[data] += 1
            return xxhash.xxh64_intdigest(data)

    text = "\n".join(" ".join(f"word{i * 20 + j}" for j in range(20)) for i in range(30))
    rows = pd.DataFrame({"doc_id": ["1"], "row": [0], "text": [text]})
    (want,) = lines._lines(iter([rows]))
    monkeypatch.setattr(lines, "xxhash", Counting)
    (got,) = lines._lines(iter([rows]))
    assert got.equals(want) and len(got) == 30
    assert all(counted[w.encode()] == 1 for w in text.split())


def test_numbers_that_occur_twice(spark):
    numbers = [*range(-500, 500), *range(0, 500, 7), 1 << 62, 1 << 62]
    table = spark.createDataFrame([(x,) for x in numbers], "n long").repartition(5)
    bits = lines.repeated(table, lambda pdf: pdf["n"].to_numpy(np.int64), 26)
    every = np.array(sorted(set(numbers)), np.int64)
    assert every[lines.marked(bits, lines.slots(every))].tolist() == [*range(0, 500, 7), 1 << 62]
    assert not lines.repeated(table.limit(0), lambda pdf: pdf["n"].to_numpy(np.int64), 20).any()


def test_only_keys_that_lines_share_are_dealt(spark):
    """Lines that share no two minima with another one have no rows among the keys."""
    draw = np.random.default_rng(23)
    near = [x for pair in edited_lines(draw, 20, 20) for x in pair]
    alone = [a for a, _ in edited_lines(draw, 400, 20)]
    seen, found = [], components.linked

    def watched(rows, *rest, **more):
        table = rows()
        seen.append((table.count(), table.select("node").distinct().count()))
        return found(rows, *rest, **more)

    lines.linked = watched
    try:
        got = {r.doc_id: r.group_id for r in lines.line_groups(spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(near + alone)], SCHEMA)).collect()}
    finally:
        lines.linked = found
    assert sum(got[i] == got[i + 1] for i in range(0, len(near), 2)) >= 0.95 * len(near) / 2
    assert seen[0][1] <= len(near) + 20 and seen[0][0] <= 28 * seen[0][1], seen
