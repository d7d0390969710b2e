"""The filter audit against orders applied one by one."""

import re
from itertools import permutations

from conftest import edge_rows, prose

from faultline.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_audit(rows, labels):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    parts = {}
    for doc_id, text, _, source, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = set()
        fails |= {"A"} if len(words) < 50 else set()
        fails |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and first[text] < doc_id else set()
        parts.setdefault(source or "", []).append((fails, doc_id in good, doc_id in toxic))
    out, total = {}, {}
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                total[part, f] = total.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs),
                    sum(d[1] for d in gone), sum(d[2] for d in gone))
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_paths_are_counted():
    edges = audit.lattice(5)
    assert len(edges) == 80 and {w for _, _, w in edges} == {24, 6, 4}
    assert all(sum(w for s, _, w in edges if s.bit_count() == k) == 120 for k in range(5))
    counted = {}
    for order in permutations([1, 2, 4, 8, 16]):
        for i, bit in enumerate(order):
            counted[sum(order[:i]), bit] = counted.get((sum(order[:i]), bit), 0) + 1
    assert counted == {(s, b): w for s, b, w in edges}


def test_audit_of_edge_rows(spark, edges, clashing, nothing):
    marks = [(1, 1, 0), (5, 0, 1), (5, 1, 0), (8, 1, None), (9, None, 1), (None, 1, 1), (12, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    want = slow_audit(edge_rows(), marks)
    assert found(audit.audit(edges, labels)) == want
    assert found(audit.audit(clashing, labels)) == want
    assert audit.audit(nothing, labels).count() == 0
    assert found(audit.audit(edges, labels.limit(0))) == slow_audit(edge_rows(), [])


def test_audit_of_many_copies(spark):
    """A text that a third of the rows hold, under equal, missing and repeated ids and in several parts."""
    hot = prose(1, 60)
    rows = [(i % 70 or None, hot, "en", f"s{i % 3}", 1) for i in range(200)]
    rows += [(1000 + i, prose(i, 40 + i % 30) + " A B C D" * (i % 4) + " #" * (i % 5 == 0), "en", None if i % 7 == 0 else "s1", 1) for i in range(400)]
    marks = [(i, i % 2, i % 3 == 0 and 1) for i in range(0, 1400, 3)]
    got = found(audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
                            spark.createDataFrame([(a, b, int(c)) for a, b, c in marks], "doc_id long, quality int, toxic int")))
    assert got == slow_audit(rows, marks)
