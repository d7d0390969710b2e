"""The registered queries against SQL and brute force on the smallest tables, and the pipeline's stages."""

import os
import sys
from collections import Counter

import pytest

FOLDER = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

import corpus_pipeline  # noqa: E402
from faultline.llm import queries  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    import duckdb
    from compare import canonical

    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER)
    want = con.sql(queries.SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    have = canonical([tuple(r) for r in got.select(*cols).collect()])
    assert have == canonical(want.project(", ".join(cols)).fetchall())


def test_near_duplicate_query_matches_brute_force(spark):
    from test_copies import slow_groups

    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.op4_golay(spark, FOLDER).collect())) == slow_groups(docs)


def test_line_query_matches_brute_force(spark):
    from test_copies import check_lines

    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    check_lines(queries.op3_lines(spark, FOLDER).collect(), docs)


def test_license_query_matches_brute_force(spark):
    from test_search_shards import brute_coverage

    from faultline.llm import licenses

    def shared(template, found):
        return sum((Counter(template) & Counter(found)).values()) >= 0.8 * len(template)

    index = licenses.Index(licenses.TEMPLATES)
    got = {(r.doc_id, r.license) for r in queries.op9_licenses(spark, FOLDER).collect()}
    want = set()
    for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect():
        found = [w for w, _, _ in licenses.split(r.text)]
        want |= {(r.doc_id, k) for k, v in index.words.items() if shared(v, found) and brute_coverage(v, found) >= 0.8}
    assert got == want


def test_packing_query_is_whole(spark):
    from test_search_shards import check_pieces

    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op7_packing(spark, FOLDER).collect()
    assert check_pieces(rows, docs) < 0.02 * sum(r.length for r in rows)


def test_models_on_held_out_rows(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    held = [r for r in queries.op8_langid(spark, FOLDER).collect() if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id] for r in held) >= 0.9 * len(held)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    held = [r for r in queries.op2_quality(spark, FOLDER).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) >= 0.8 * len(held)


def test_pipeline_stages(spark):
    """Every stage works on what its predecessor kept and returns what its operator decides."""
    from test_copies import check_lines, slow_near
    from test_rules_mixing import check_mix
    from test_search_shards import check_pieces

    from faultline.llm import rules
    from faultline.llm.common import keep
    from faultline.llm.lines import line_groups

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "line_dedup", "near_dedup", "source_mix", "token_packing"]

    good = keep(steps["quality_rules"](spark, docs, FOLDER))
    assert {r.doc_id for r in good.collect()} == {r.doc_id for r in rules.apply_rules(docs).where("kept").collect()}
    assert good.columns == columns

    rows = [tuple(r) for r in good.select("doc_id", "text").collect()]
    groups = line_groups(good).collect()
    check_lines(groups, rows)
    lost = {(r.doc_id, r.line_no) for r in groups if not r.kept}
    want = {}
    for d, text in rows:
        lines = text.split("\n")
        rest = "\n".join(x for i, x in enumerate(lines) if (d, i) not in lost)
        if rest.split() or len(rest) == len(text):
            want[d] = rest
    thin = keep(steps["line_dedup"](spark, good, FOLDER))
    assert {r.doc_id: r.text for r in thin.collect()} == want
    assert all(r.n_chars == len(r.text) for r in thin.collect()) and thin.columns == columns

    single = keep(steps["near_dedup"](spark, thin, FOLDER))
    assert {r.doc_id for r in single.collect()} == slow_near(want)
    assert single.columns == columns

    rows = [tuple(r) for r in single.collect()]
    check_mix(single, rows)
    mixed = keep(steps["source_mix"](spark, single, FOLDER))
    assert mixed.columns == columns

    pieces = steps["token_packing"](spark, mixed, FOLDER).collect()
    assert sum(r.length for r in pieces) > 0
    assert Counter(r.doc_id for r in pieces if r.start == 0) == Counter(r.doc_id for r in mixed.collect())
    check_pieces(pieces, [(r.doc_id, r.text) for r in mixed.dropDuplicates(["doc_id"]).collect()] if mixed.count() == mixed.select("doc_id").distinct().count()
                 else [(r.doc_id, r.text) for r in mixed.collect()])
