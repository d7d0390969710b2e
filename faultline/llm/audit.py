"""Filter interaction audit: what each of several filters removes in every order in which they can be applied.

Each document gets a mask of the filters it fails. The masks are counted by part and label, and from then on only those
counts matter. The subsets of the filters form a lattice: a state is the set applied so far, an edge applies one more filter.
An edge's removals are the documents that pass all of its state and fail its filter. Counting paths forwards gives the orders
that reach a state, counting them backwards those that leave it; their product says how many orders use an edge, so a
filter's removals summed over all orders are a weighted sum over its edges, and the steps of an order are read from the
edges it runs along.

Filters: A under 50 words; B ``100 * distinct words < 65 * words``; C ``100 * capitals A-Z > 5 * code points``; D any of
``#$%&*|``; E the text of a row with a smaller id, anywhere in the table.

Null texts are empty; the empty text fails A, and E like any other text. Null sources are the part ''. A row without an id has
no smaller id and makes no other row fail E; it has no label. Rows with one id and one text are no copies of each other.
Several labels of one id count as good (toxic) if one of them is. Very long texts are read by one task, a text at a time.
Ties do not arise. An empty table gives an empty result. Other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
LEAST_WORDS = 50
COPY = 16  # the bit of filter E


def failures(data: bytes, code_points: int) -> int:
    """The filters A to D that a text in UTF-8 fails, A as the lowest bit."""
    words = data.split()  # bytes split at ASCII white space
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return ((len(words) < LEAST_WORDS) | (100 * len(set(words)) < 65 * len(words)) << 1
            | (100 * capitals > 5 * code_points) << 2 | (len(data.translate(None, SYMBOLS)) < len(data)) << 3)


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.utf8_length(batch.column("text"))
        masks, digests = [], []
        for text, size in zip(batch.column("text").cast(pa.binary()), sizes):
            data = text.as_py()
            masks.append(failures(data, size.as_py()))
            digests.append(blake2b(data, digest_size=16).digest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("part"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                                         names=["doc_id", "part", "mask", "digest"])


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``part, mask, good, toxic, n``: the documents of each part by the filters they fail and by their labels.

    Copies are found by digests of texts. Rows are counted by digest, part and label before they move, so a text that a
    third of all rows hold meets itself as a few rows.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Rows without an id match no label; the second key deals them out all the same.
    judged = named.mapInArrow(_judged, "doc_id long, part string, mask int, digest binary").withColumn(
        "spread", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("spread")).agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    group = ["part", "mask", "digest", "good", "toxic"]
    none = F.lit(False)
    rows = judged.join(marks, ["doc_id", "spread"], "left").select(
        "doc_id", "spread", "part", "mask", "digest", F.coalesce("good", none).alias("good"), F.coalesce("toxic", none).alias("toxic"))
    each = rows.groupBy("doc_id", "spread", *group).agg(F.count("*").alias("n"))
    texts = each.groupBy(*group).agg(
        F.sum("n").alias("n"), F.expr("coalesce(sum(n) FILTER (WHERE doc_id IS NOT NULL), 0)").alias("with_id"), F.min("doc_id").alias("first"),
        F.expr("coalesce(min_by(n, doc_id) FILTER (WHERE doc_id IS NOT NULL), 0)").alias("at_first"))
    least = F.min("first").over(Window.partitionBy("digest"))
    again = F.col("with_id") - F.when(F.col("first") == F.col("least"), F.col("at_first")).otherwise(0)
    both = texts.withColumn("least", least).withColumn("again", again).select(
        "part", "good", "toxic", F.explode(F.array(
            F.struct("mask", (F.col("n") - F.col("again")).alias("n")),
            F.struct(F.col("mask").bitwiseOR(F.lit(COPY)).alias("mask"), F.col("again").alias("n")))).alias("of"))
    return both.groupBy("part", F.col("of.mask").alias("mask"), "good", "toxic").agg(F.sum("of.n").alias("n"))


def lattice(size: int) -> list[tuple[int, int, int]]:
    """``state, bit, orders`` of every edge: how many orders of ``size`` filters apply ``bit`` right after those of ``state``."""
    full = (1 << size) - 1
    bits = [1 << i for i in range(size)]
    reach, leave = [1] + [0] * full, [0] * full + [1]
    for state in range(full + 1):
        for bit in bits:
            if not state & bit:
                reach[state | bit] += reach[state]
    for state in range(full, -1, -1):
        for bit in bits:
            if state & bit:
                leave[state ^ bit] += leave[state]
    return [(state, bit, reach[state] * leave[state | bit]) for state in range(full + 1) for bit in bits if not state & bit]


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step from ``part, mask, good, toxic, n``; every part has all edges, with zeros where nothing falls."""
    full = (1 << len(filters)) - 1
    edges = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(b).alias("bit"), F.lit(w).cast("long").alias("orders")) for s, b, w in lattice(len(filters))])
    at = counts.withColumn("edge", F.explode(edges)).select("part", "mask", "good", "toxic", "n", "edge.*")
    alive = F.col("mask").bitwiseAND(F.col("state")) == 0
    fails = alive & (F.col("mask").bitwiseAND(F.col("bit")) > 0)

    def total(where):
        return F.sum(F.when(where, F.col("n")).otherwise(0))

    removals = at.groupBy("part", "state", "bit", "orders").agg(
        total(alive & ~fails).alias("kept"), total(fails).alias("removed"), total(fails & F.col("good")).alias("good_lost"),
        total(fails & F.col("toxic")).alias("toxic_lost"))
    of = Window.partitionBy("part", "bit")  # sixteen edges of five filters
    known = removals.select(
        "*", F.sum(F.col("removed") * F.col("orders")).over(of).alias("shapley"),
        (F.max(F.when(F.col("state") == 0, F.col("removed"))).over(of) - F.col("removed")).alias("redundant"),
        F.max(F.when(F.col("state") == F.lit(full) - F.col("bit"), F.col("removed"))).over(of).alias("unique_fails"))
    steps = []
    for order in permutations(range(len(filters))):
        state = 0
        for step, i in enumerate(order, 1):
            steps.append(("".join(filters[k] for k in order), step, state, 1 << i))
            state |= 1 << i
    walks = counts.sparkSession.createDataFrame(steps, "filter_order string, step int, state int, bit int")
    return known.join(F.broadcast(walks), ["state", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """The audit of the five filters over whole documents."""
    return interactions(failure_counts(docs, labels, id_col, text_col, part_col))


def sql(table: str = "documents", labels: str = "labels") -> str:
    bits = [1 << i for i in range(len(FILTERS))]
    letters = ", ".join(f"('{f}', {b})" for f, b in zip(FILTERS, bits))
    names = "abcde"
    apart = " AND ".join(f"{x}.f <> {y}.f" for i, x in enumerate(names) for y in names[i + 1:])
    walks = " UNION ALL ".join(
        f"SELECT filter_order, {k + 1} AS step, {' + '.join(['0', *names[:k]])} AS state, {names[k]} AS bit FROM o" for k in range(len(names)))
    return f"""
WITH l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM {labels} GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM {table}),
w AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM d),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > least THEN 16 ELSE 0 END) AS mask
  FROM w LEFT JOIN l USING (doc_id)),
h AS (SELECT part, mask, sum(good) AS good, sum(toxic) AS toxic, count(*) AS n FROM m GROUP BY ALL),
f(f, bit) AS (VALUES {letters}),
o AS (SELECT {' || '.join(f'{x}.f' for x in names)} AS filter_order, {', '.join(f'{x}.bit AS {x}' for x in names)}
  FROM {', '.join(f'f {x}' for x in names)} WHERE {apart}),
s AS ({walks}),
r AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN (mask & (state + bit)) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN (mask & state) = 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN (mask & state) > 0 AND (mask & bit) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN (mask & state) = 0 AND (mask & bit) > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN (mask & state) = 0 AND (mask & bit) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM h, s GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""
