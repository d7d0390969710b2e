"""Near-duplicate embeddings by product quantisation: coarse lists, residual codes, table-lookup distances, exact cosine.

Vectors of one label and length are compared. Each becomes a unit vector; equal ones are one class with a count, found before
anything is compared. Coarse centres are fitted on a bounded sample, ``sqrt`` of the classes in number. A class enters the
list of its nearest centre and of every other centre whose border with it lies within ``MARGIN``. Two unit vectors with a
cosine of 0.93 are 0.374 apart, so their middle lies within 0.187 of both: with a margin of 0.187 they always meet in a
list. In many dimensions two such vectors differ by far less across any one border, and a tenth misses hardly any (tests
measure the recall); the margin is a parameter.

In a list, residuals from its centre are cut into subspaces and coded by the nearest of 256 codewords each, and the
distance between a vector and its code's vector is kept. Distances from a vector to all codes of a list are sums of table
entries. By the triangle inequality a true distance differs from that by at most the kept one, so only vectors whose
bounds reach the limit are compared by cosine, and none within the limit is left out. A pair that meets in several lists
counts in the first of them, which the classes' lists, kept as bits, tell.

Lists of more than ``BLOCK`` classes are dealt into blocks, and pairs of blocks are tasks of bounded size. A task gives each
class its number of links and one other class of its component in there; pairs are never given out.

Vectors that are null, empty, zero or hold null or non-finite components, and vectors without a label, link with nothing.
Repeated rows are vectors of their own, which link. A component is named by its smallest id; rows without an id are named
by one only if another row of it has one, and are kept if none has. Ties do not arise. An empty table gives an empty
result. Other columns may have any names. Texts play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property, lru_cache
from hashlib import blake2b
from io import BytesIO

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import keep
from faultline.llm.components import components
from faultline.llm.sampling import fit_in_task
from faultline.operators.joins import heavy_join

LEAST = 0.93
MARGIN = 0.1
MOST_CELLS = 4096
SAMPLE_PER_CELL = 32
SUBSPACES, CODEWORDS = 16, 256
ROUNDS = 8
BLOCK = 1024
#: Numbers in a table of distances that a task holds at once.
SLAB = 1 << 20


def unit(vector: np.ndarray) -> np.ndarray | None:
    """The vector scaled to length one in double precision, whatever its magnitude; None if that can't be."""
    top = float(np.abs(vector).max(initial=0.0))
    if not 0.0 < top < np.inf:  # a NaN isn't either
        return None
    scaled = vector / top
    return scaled / np.sqrt(scaled @ scaled) + 0.0


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column("v")
        flat = column.values.to_numpy(zero_copy_only=False)  # nulls become NaN
        ends = column.offsets.to_numpy().tolist()
        some = column.is_valid().to_numpy(zero_copy_only=False).tolist()
        found = [unit(flat[a:b]) if ok else None for ok, a, b in zip(some, ends, ends[1:])]
        data = [None if u is None else u.tobytes() for u in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array([None if d is None else blake2b(d, digest_size=16).digest() for d in data], pa.binary()),
             pa.array(data, pa.binary())], names=["id", "label", "digest", "unit"])


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the nearest centre of each row."""
    shift = 0.5 * (centres * centres).sum(axis=1)
    return np.concatenate([np.zeros(0, np.int64), *[(rows[a:a + 4096] @ centres.T - shift).argmax(axis=1) for a in range(0, len(rows), 4096)]])


def _centres(rows: np.ndarray, number: int, spherical: bool) -> np.ndarray:
    """Centres by repeated means, from the first distinct rows on."""
    first = np.sort(np.unique(rows, axis=0, return_index=True)[1])[:number]
    centres = rows[first].copy()
    for _ in range(ROUNDS):
        of = _nearest(rows, centres)
        count = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, rows)
        full = count > 0
        centres[full] = sums[full] / count[full, None]
        if spherical:
            centres /= np.maximum(np.linalg.norm(centres, axis=1), 1e-12)[:, None]
    return centres


def _padded(units: list[bytes], width: int) -> np.ndarray:
    """The first ``width`` components of each vector, missing ones 0; distances never grow by that."""
    out = np.zeros((len(units), width))
    for row, data in zip(out, units):
        part = np.frombuffer(data, np.float64, min(width, len(data) // 8))
        row[:len(part)] = part
    return out


class Quantiser:
    """Coarse centres and codewords of residuals per subspace."""

    def __init__(self, centres: np.ndarray, words: list[np.ndarray], margin: float) -> None:
        self.centres, self.words, self.margin = centres, words, margin
        self.width = centres.shape[1]
        self.edges = np.linspace(0, self.width, len(words) + 1).astype(int)

    @classmethod
    def fit(cls, units: list[bytes], cells: int, margin: float) -> Quantiser:
        lengths = np.array([len(u) // 8 for u in units])
        rows = _padded(units, int(np.bincount(lengths).argmax()))  # the most frequent length
        out = cls(_centres(rows, cells, True), [np.zeros((1, 0))], margin)
        at, cell = np.nonzero(out.lists(rows))
        residuals = rows[at] - out.centres[cell]
        parts = min(SUBSPACES, out.width)
        edges = np.linspace(0, out.width, parts + 1).astype(int)
        return cls(out.centres, [_centres(residuals[:, a:b], CODEWORDS, False) for a, b in zip(edges, edges[1:])], margin)

    @cached_property
    def apart(self) -> np.ndarray:
        """Distances between centres."""
        square = (self.centres ** 2).sum(axis=1)
        return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * self.centres @ self.centres.T, 1e-12))

    def lists(self, rows: np.ndarray) -> np.ndarray:
        """Which lists each row enters."""
        near = rows @ self.centres.T
        best = near.argmax(axis=1)
        return near[np.arange(len(rows)), best][:, None] - near <= self.margin * self.apart[best]

    def codes(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far each residual is from what its code stands for."""
        code = np.empty((len(residuals), len(self.words)), np.uint8)
        left = np.zeros(len(residuals))
        for m, (a, b, words) in enumerate(zip(self.edges, self.edges[1:], self.words)):
            part = residuals[:, a:b]
            code[:, m] = _nearest(part, words)
            left += ((part - words[code[:, m]]) ** 2).sum(axis=1)
        return code, np.sqrt(left)

    def distances(self, residuals: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Distances of residuals (rows) to coded ones (columns) from one table a subspace."""
        total = np.zeros((len(residuals), len(code)))
        for m, (a, b, words) in enumerate(zip(self.edges, self.edges[1:], self.words)):
            part = residuals[:, a:b]
            table = (part ** 2).sum(axis=1)[:, None] - 2 * part @ words.T + (words ** 2).sum(axis=1)[None, :]
            total += table[:, code[:, m]]
        return np.sqrt(np.maximum(total, 0))

    def dump(self) -> bytes:
        out = BytesIO()
        np.savez(out, centres=self.centres, margin=self.margin, **{f"w{i}": w for i, w in enumerate(self.words)})
        return out.getvalue()

    @classmethod
    @lru_cache(maxsize=1)
    def load(cls, data: bytes) -> Quantiser:
        with np.load(BytesIO(data)) as f:
            return cls(f["centres"], [f[f"w{i}"] for i in range(len(f.files) - 2)], float(f["margin"]))


def roots(number: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``number`` rows the smallest row of its component under the links (a, b)."""
    up = np.arange(number)
    while len(a):
        x, y = up[a], up[b]
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]
        open_ = up[a] != up[b]
        a, b = a[open_], b[open_]
    return up


def _listed(batches: Iterator[pa.RecordBatch], model: Quantiser) -> Iterator[pa.RecordBatch]:
    """A row for each list that a class enters."""
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            rows = _padded(part.column("unit").to_pylist(), model.width)
            enters = model.lists(rows)
            bits = np.packbits(enters, axis=1, bitorder="little")
            at, cell = np.nonzero(enters)
            code, left = model.codes(rows[at] - model.centres[cell])
            picked = part.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [picked.column("label"), picked.column("node"), picked.column("n"), picked.column("unit"), pa.array(cell, pa.int32()),
                 pa.array([c.tobytes() for c in code], pa.binary()), pa.array(left), pa.array([bits[i].tobytes() for i in at], pa.binary())],
                names=["label", "node", "n", "unit", "cell", "code", "left", "lists"])


def _matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1)


def _compared(table: pa.Table, model: Quantiser, least: float) -> pa.Table:
    """Links of the classes in two blocks of a list: their number for each class, and a class of its component."""
    cell, i, j = (table.column(c)[0].as_py() for c in ("cell", "i", "j"))
    block = table.column("block").to_numpy()
    # The two blocks of a pair, or one block with itself.
    first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
    node, n = table.column("node").to_numpy(), table.column("n").to_numpy()
    units, code, lists = _matrix(table.column("unit"), np.float64), _matrix(table.column("code"), np.uint8), _matrix(table.column("lists"), np.uint8)
    left = table.column("left").to_numpy()
    before = np.unpackbits(lists, axis=1, bitorder="little", count=cell).view(bool) if cell else np.zeros((len(node), 0), bool)
    before = np.packbits(before, axis=1)
    width = min(model.width, units.shape[1])
    residuals = np.zeros((len(node), model.width))
    residuals[:, :width] = units[:, :width]
    residuals -= model.centres[cell]
    most = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    links, a, b = np.zeros(len(node), np.int64), [], []
    step = max(1, SLAB // max(1, len(second)))
    for at in range(0, len(first), step):
        some = first[at:at + step]
        near = np.abs(model.distances(residuals[some], code[second]) - left[second][None, :]) <= most
        if i == j:
            near &= some[:, None] < second[None, :]
        rows, cols = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        if not len(rows):
            continue
        like = (units[some[rows]] @ units[second[cols]].T >= least) & near[np.ix_(rows, cols)]
        x, y = np.nonzero(like)
        x, y = some[rows[x]], second[cols[y]]
        for part in range(0, len(x), 1 << 16):  # pairs that met in an earlier list count there
            p, q = x[part:part + (1 << 16)], y[part:part + (1 << 16)]
            here = ~(before[p] & before[q]).any(axis=1)
            p, q = p[here], q[here]
            np.add.at(links, p, n[q])
            np.add.at(links, q, n[p])
            a.append(p), b.append(q)
    a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (a, b))
    up = roots(len(node), a, b)
    some = links > 0
    return pa.table({"node": node[some], "other": node[up[some]], "links": links[some]})


def near_duplicates(vectors: DataFrame, least: float = LEAST, margin: float = MARGIN, block: int = BLOCK, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row; one row of each component with its name is kept."""
    named = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    every = keep(named.mapInArrow(_units, "id long, label string, digest binary, unit binary"))
    fit = every.where("unit is not null and label is not null")
    # The unit vector is a key only so that it comes along; its digest tells it.
    counted = fit.groupBy("label", "digest", "unit").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    classes = keep(counted.withColumn("node", F.monotonically_increasing_id()))
    total = classes.count()
    cells = max(1, min(MOST_CELLS, round(total ** 0.5)))
    sample = classes.select("unit", F.xxhash64("digest", "label").alias("place")).orderBy("place", "unit").limit(cells * SAMPLE_PER_CELL)

    def fitted(pdf: pd.DataFrame) -> bytes:
        return Quantiser.fit(pdf.sort_values("place")["unit"].tolist(), cells, margin).dump()

    data = fit_in_task(sample, fitted)
    if data is None:
        linked = classes.select("node", F.lit(0).cast("long").alias("links"), F.col("node").alias("component"))
    else:
        linked = _linked(classes, data, least, block)
    names = keep(classes.select("label", "digest", "n", "least", "node").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node")))
    smallest = names.groupBy("component").agg(F.min("least").alias("component_id"))
    of = keep(names.join(smallest, "component").select("label", "digest", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    alone = F.col("n_links").isNull()  # rows that take no part have no class
    out = heavy_join(every.select("id", "label", "digest"), of, ["label", "digest"]).select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(classes: DataFrame, data: bytes, least: float, block: int) -> DataFrame:
    """``node, links, component`` of the classes linked to others."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _listed(batches, Quantiser.load(data))

    def compared(table: pa.Table) -> pa.Table:
        return _compared(table, Quantiser.load(data), least)

    width = F.octet_length("unit").alias("width")
    entries = keep(classes.select("label", "node", "n", "unit").mapInArrow(
        listed, "label string, node long, n long, unit binary, cell int, code binary, left double, lists binary").withColumn("width", width))
    key = ["label", "width", "cell"]
    sizes = entries.groupBy(*key).agg(F.count("*").alias("n_list")).where("n_list > 1").withColumn("blocks", F.ceil(F.col("n_list") / block).cast("int"))
    dealt = heavy_join(entries, keep(sizes), key, "n_list").where("blocks is not null").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    pairs = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key, F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"), "block", "node", "n", "unit", "code", "left", "lists")
    found = keep(pairs.groupBy(*key, "i", "j").applyInArrow(compared, "node long, other long, links long"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    return links.join(components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))), "node", "left")
