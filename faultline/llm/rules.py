"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Null and empty texts have no words; all their ratios are 0 and the base rule on the number of words rejects them. Ties do
not arise; repeated rows each get their verdict; an empty table gives an empty result. Other columns are not looked at and
may have any names, since only the id and the text are selected.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import SPACE, WORD, let, words


class Rule(NamedTuple):
    """A measure stays between two bounds, both included."""

    measure: str
    low: float
    high: float


#: The thresholds in production. Each bounds one ratio of ``ratios``.
RULES = (
    Rule("chars_per_word", 1.5, 40.0),
    Rule("symbols_per_word", 0.0, 0.1),
    Rule("stop_word_share", 0.01, 1.0),
    Rule("duplicate_line_share", 0.0, 0.5),
    Rule("ellipsis_line_share", 0.0, 0.5),
    Rule("bullet_line_share", 0.0, 0.95),
)

#: Frequent function words of the corpus languages.
STOP_WORDS = (
    "a", "and", "for", "in", "is", "it", "of", "on", "that", "the", "to", "was", "with",
    "das", "der", "die", "ein", "eine", "ist", "mit", "nicht", "und", "von", "zu",
    "dans", "des", "du", "elle", "est", "et", "la", "le", "les", "que", "qui", "un", "une",
    "con", "de", "del", "el", "en", "las", "los", "no", "para", "por", "se", "su", "una",
)

MIN_WORDS = 50
REPEAT_PERCENT = 50


def _repeated(w: Column) -> Column:
    """Words that lie in a window of three words found twice or more in the array.

    Windows are compared by a 64-bit hash. Most texts repeat none, which the number of distinct hashes shows at once.
    Otherwise the hashes are sorted with their starts, equal neighbours give the starts of repeated windows, and the union
    of the windows is measured from start to start.
    """
    starts = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def again(h: Column) -> Column:
        spans = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(let(spans, found_again), covered))

    def found_again(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False))
                         | F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))
        return F.aggregate(gaps, F.lit(0), lambda n, x: n + x)

    return F.when(F.size(w) < 4, 0).otherwise(let(hashes, again))


def measures(text: Column) -> Column:
    """The counts of one text as a struct."""
    full = F.coalesce(text, F.lit(""))

    forms = [*STOP_WORDS, *[x.capitalize() for x in STOP_WORDS]]

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"),
            F.size(F.filter(w, lambda x: x.isin(*forms))).cast("long").alias("n_stop_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(x, lambda y: y.endswith("...") | y.endswith("…"))).cast("long").alias("n_ellipsis_lines"),
            F.size(F.filter(x, lambda y: y.rlike(rf"^{SPACE}*[-•*]"))).cast("long").alias("n_bullet_lines"),
        )

    symbols = F.length(full) - F.length(F.regexp_replace(full, r"[#*$%&|<>]+", ""))
    lines = F.filter(F.split(full, "\n"), lambda x: x.rlike(WORD))
    return F.struct(let(words(text), of_words).alias("w"), let(lines, of_lines).alias("l"),
                    symbols.cast("long").alias("n_symbols"))


def ratios(m: Column) -> dict[str, Column]:
    def share(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))

    w, x = m["w"], m["l"]
    return {
        "chars_per_word": share(w["word_chars"], w["n_words"]),
        "symbols_per_word": share(m["n_symbols"], w["n_words"]),
        "stop_word_share": share(w["n_stop_words"], w["n_words"]),
        "duplicate_line_share": share(x["n_dup_lines"], x["n_lines"]),
        "ellipsis_line_share": share(x["n_ellipsis_lines"], x["n_lines"]),
        "bullet_line_share": share(x["n_bullet_lines"], x["n_lines"]),
    }


def base_failed(m: Column) -> Column:
    w = m["w"]
    return (w["n_words"] < MIN_WORDS) | (F.lit(100) * w["n_repeat_words"] > F.lit(REPEAT_PERCENT) * w["n_words"])


def verdict(m: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """True where the base rules and every rule of the table hold."""
    of = ratios(m)
    unknown = [r.measure for r in rules if r.measure not in of]
    if unknown:
        raise ValueError(f"no such measure: {unknown}")
    out = ~base_failed(m)
    for r in rules:
        out = out & (of[r.measure] >= r.low) & (of[r.measure] <= r.high)
    return out


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, ratios and the verdict of every document."""
    m = F.col("m")
    first = docs.select(F.col(id_col).alias("doc_id"), measures(F.col(text_col)).alias("m"))
    return first.select(
        "doc_id", "m.w.n_words", "m.w.word_chars", "m.n_symbols", "m.l.n_dup_lines", "m.w.n_repeat_words",
        base_failed(m).alias("base_failed"), verdict(m, rules).alias("kept"),
        *[c.alias(name) for name, c in ratios(m).items()])


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """The documents that pass, with their own columns."""
    return docs.where(let(measures(F.col(text_col)), lambda m: verdict(m, rules)))


def sql(table: str = "documents", rules: tuple[Rule, ...] = RULES) -> str:
    """``apply_rules`` without the ratios, for DuckDB."""
    of = {
        "chars_per_word": "word_chars / n_words", "symbols_per_word": "n_symbols / n_words",
        "stop_word_share": "n_stop_words / n_words", "duplicate_line_share": "n_dup_lines / n_lines",
        "ellipsis_line_share": "n_ellipsis_lines / n_lines", "bullet_line_share": "n_bullet_lines / n_lines",
    }
    test = " AND ".join(f"coalesce({of[r.measure]}, 0) BETWEEN {r.low} AND {r.high}" for r in rules)
    stop = ", ".join(f"'{x}'" for x in (*STOP_WORDS, *[x.capitalize() for x in STOP_WORDS]))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l
  FROM {table}),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s FROM p),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, s) >= 2),
c AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_repeat_words FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({stop})))::BIGINT AS n_stop_words,
         len(list_filter(l, lambda x: ends_with(x, '...') OR ends_with(x, '…')))::BIGINT AS n_ellipsis_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^{SPACE}*[-•*]')))::BIGINT AS n_bullet_lines
  FROM d LEFT JOIN c ON c.doc_id = d.doc_id),
b AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND {test}) AS kept
FROM b"""
