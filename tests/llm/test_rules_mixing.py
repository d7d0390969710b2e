import re
from collections import Counter

import pytest
from conftest import SCHEMA, edge_rows, prose
from pyspark.sql import functions as F

from faultline.llm import mixing, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if seen[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_match_brute_force(spark, edges):
    extra = [(100, "a b c a b c a", "en", "x", 1), (101, "a a a a", "en", "x", 1), (102, "x\nx\n\nx y\nx", "en", "x", 1)]
    got = rules.apply_rules(edges.unionAll(spark.createDataFrame(extra, SCHEMA)))
    have = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got.collect())
    want = Counter()
    for doc_id, text, *_ in edge_rows() + extra:
        n = counts(text)
        want[(doc_id, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert have == want


def test_verdict_and_columns(spark, clashing, nothing):
    good = "The house is in the valley and the river was near to it. " * 3 + prose(1, 90)
    docs = spark.createDataFrame([(1, prose(2, 60) + " the " + prose(3, 60), "en", "a", 1), (2, "the # " + "* & ".join(prose(3, 80).split()), "en", "a", 1),
                                  (3, None, None, None, None), (4, good + "\n" + prose(8, 90), "en", "a", 1)], SCHEMA)
    kept = {r.doc_id for r in rules.keep_good(docs).collect()}
    assert kept == {r.doc_id for r in rules.apply_rules(docs).where("kept").collect()}
    assert 1 not in kept or 2 not in kept
    assert 2 not in kept and 3 not in kept and 4 in kept
    assert rules.keep_good(clashing).columns == clashing.columns
    assert rules.keep_good(nothing).count() == 0 and rules.apply_rules(nothing).count() == 0
    with pytest.raises(ValueError):
        rules.apply_rules(docs, (rules.Rule("none", 0, 1),))


def test_plan_has_no_python(edges):
    plan = rules.apply_rules(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def expected_targets(sizes, weights=(5, 2, 1), budget=1.5, most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = budget * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > most * sizes[s]}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free -= over
    return out


def check_mix(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    of = {r[0]: r[3] for r in rows}
    sizes, taken, target = Counter(), Counter(), {}
    for s in {r[3] for r in rows}:
        sizes[s] = sum(counts(r[1])[0] for r in rows if r[3] == s)
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == sizes[s] and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
        target[s] = r.target
    want = expected_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= 3
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()), key=repr)


def test_mix_meets_targets(spark, edges):
    check_mix(edges, edge_rows())
    rows = [(i, prose(i, 1 + i * 7 % 50), "en", ["big", "big", "big", "mid", "small", None][i % 6], 1) for i in range(300)]
    check_mix(spark.createDataFrame(rows, SCHEMA), rows)


def test_mix_takes_rows_of_one_id_alike(spark):
    rows = [(5, prose(1, 10), "en", "a", 1)] * 40 + [(i, prose(i, 10), "en", "b", 1) for i in range(100, 110)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).where("doc_id = 5").collect()
    assert len({r.taken for r in got}) == 1
    assert abs(sum(r.taken for r in got) - got[0].target) <= 40


def test_mixed_documents(spark, edges, clashing, nothing):
    assert mixing.mixed_documents(clashing).columns == clashing.columns
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_documents(nothing).count() == 0
    times = Counter(r.doc_id for r in mixing.mixed_documents(edges).collect())
    assert all(n <= 4 for n in times.values())
    plan = mixing.mix(edges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_mix_one_source_and_empty_source(spark):
    rows = [(i, prose(i, 20), None, "only", 1) for i in range(30)] + [(90, "", None, "void", 0)]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).groupBy((F.col("doc_id") == 90).alias("v")).agg(
        F.sum("taken").alias("t"), F.max("target").alias("g")).orderBy("v").collect()
    assert abs(got[0].t - 900) <= 1 and got[0].g == pytest.approx(900) and got[1].t == 0
