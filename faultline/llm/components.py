"""Connected components of links, and links among keyed rows without listing all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import keep


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges (a, b); a component is named by its smallest node.

    Alternating stars: every node passes its smallest neighbour to its larger ones, then to its smaller ones, until each
    node hangs on the smallest of its component. Both steps are minima per node and a join, so a node with very many
    links is one partial aggregate and a join that can be split. Rounds are written to the shared folder. Loops and
    repeated links do no harm; null ends are left out.
    """
    now = keep(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = keep(near.unionAll(small.select("a", F.col("m").alias("b"))).distinct())
        before, mark = mark, _mark(now)
        if before == mark:
            break
    ends = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return ends.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


#: A row's side: pairs lie between FIRST and SECOND rows of a key, or among EITHER rows.
FIRST, SECOND, EITHER = 0, 1, 2


def linked(rows: Callable[[], DataFrame], most_bits: int, verify: Callable[[DataFrame], DataFrame] | None = None,
           narrowed: Callable[[DataFrame], DataFrame] | None = None, within: Callable[[DataFrame], DataFrame] | None = None,
           largest: int = 32, known: DataFrame | None = None, counted: bool = False) -> DataFrame:
    """The components (node, component) of all nodes linked to another one.

    ``rows()`` gives (key, side, node, code). Two nodes are linked if they share a key on fitting sides, their codes differ in
    at most ``most_bits`` bits, and ``verify`` keeps the pair; it gets and returns (a, b). ``narrowed`` gives again at least
    the rows with one of the keys in a table, so that the others needn't be dealt out twice. ``known`` are components found
    before, whose nodes needn't be compared with each other. With ``counted``, ``rows()`` is a table that hardly holds a key
    of one row, and keys aren't counted again.

    Spark takes rows that are made in Python or exploded to be as few as those they are made from, and would broadcast them:
    joins with ``rows()`` are merged.

    Pairs of a group are not listed as a whole. First every row is compared with one centre of its key, which joins a
    dense group. Then, where a key still holds several components, the rows outside its largest one are compared with the
    rows of other components. Pairs inside a component can't change it, so no link that matters is left out.

    That second step costs little where rows of a key are linked as a rule. Where they need not be, ``within`` does it for
    the keys that hold more than ``largest`` rows and several components: it gets (key, node, code, component) and returns
    links (a, b) that join all components which any two linked rows of a key join.
    """
    close = F.bit_count(F.col("code").bitwiseXOR(F.col("with.code"))) <= most_bits
    sure = verify or (lambda pairs: pairs)
    some = None if counted else rows().groupBy("key").agg(F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high")).where(
        f"n > 1 and (low < high or low = {EITHER})").select("key")
    if some is None:
        busy = rows()
    elif narrowed is None:
        busy = keep(rows().join(some.hint("merge"), "key"))
    else:
        some = keep(some)
        busy = keep(narrowed(some).join(some.hint("merge"), "key"))
    named = busy.withColumn("component", F.col("node")) if known is None else _named(busy, known)
    centre = F.struct("node", "code", "component")
    centres = named.groupBy("key").agg(*[F.min(F.when(F.col("side") == s, centre)).alias(f"c{s}") for s in (FIRST, SECOND, EITHER)])
    partner = F.when(F.col("side") == FIRST, F.col("c1")).when(F.col("side") == SECOND, F.col("c0")).otherwise(F.col("c2"))
    stars = named.join(centres, "key").select("node", "code", "component", partner.alias("with")).where("component <> with.component").where(close)
    first = keep(sure(stars.select(F.col("node").alias("a"), F.col("with.node").alias("b")).distinct()))
    known = _merged(known, first)

    named = keep(_named(busy, known))
    per = named.groupBy("key", "component").agg(F.count("*").alias("n"))
    main = per.groupBy("key").agg(F.max(F.struct("n", "component"))["component"].alias("main"), F.count("*").alias("groups"), F.sum("n").alias("size"))
    mixed = main.where("groups > 1")
    if within is not None:
        mixed = keep(mixed)
    few = mixed if within is None else mixed.where(F.col("size") <= largest)
    apart = named.join(few.select("key", "main"), "key")
    rest = apart.where("component <> main").select("key", *[F.col(c).alias(f"o_{c}") for c in ("side", "node", "code", "component")])
    across = rest.join(apart, "key").where(
        (F.col("component") != F.col("o_component"))
        & ((F.col("side") + F.col("o_side") == 1) | ((F.col("side") == EITHER) & (F.col("o_side") == EITHER)))
        & (F.bit_count(F.col("code").bitwiseXOR(F.col("o_code"))) <= most_bits))
    second = keep(sure(across.select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b")).distinct()))
    if within is not None:
        many = keep(named.join(mixed.where(F.col("size") > largest).select("key"), "key").select("key", "node", "code", "component"))
        if not many.isEmpty():
            second = second.unionAll(keep(within(many)))
    return _merged(known, second)


def _named(rows: DataFrame, known: DataFrame) -> DataFrame:
    return rows.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _merged(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """The components of known ones and new links."""
    if known is None:
        return keep(components(links))
    if links.isEmpty():
        return known
    return keep(components(known.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(links)))
