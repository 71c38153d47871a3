"""Near-duplicate vectors by collision counting on one-dimensional projections.

A pair at the threshold is sqrt(2 - 2 * cosine) apart on the unit sphere, so its
difference under a Gaussian projection is normal with that deviation, whatever
the data. From this follow, without looking at data, how wide a query-centred
window must be, how many of ``PROJECTIONS`` windows such a pair shares at least,
and how many tables are needed for ``RECALL``.

All pairs are too many to count collisions for, so each table first cuts the
vectors at zero of some projections; their number grows with the logarithm of
the number of vectors, so a cell keeps its size. In a cell every projection is
sorted, each vector's window is a range of that order, shared windows are
counted per pair, and pairs with enough of them are verified in double
precision. A pair is counted in the first table where its cells meet. No pair
leaves a task: a cell gives each vector's number of links and a star of links
with the same components. Equal vectors are one vector with a weight, and cells
beyond ``BLOCK`` vectors (dense groups) are cut into blocks that meet pairwise.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmill.llm.components import components
from eventmill.session import written

COSINE = 0.95
RECALL = 0.99
PROJECTIONS = 24
#: Half a window, in deviations of a pair at the threshold.
WIDTH = 2.0
#: Vectors in a cell on average, and in a block at most.
CELL, BLOCK = 128, 512
SEED = 20


def needed_collisions(projections: int = PROJECTIONS, width: float = WIDTH, loss: float = 1e-3) -> int:
    """The largest count that a pair at the threshold reaches but for a share ``loss``."""
    p, below = math.erf(width / math.sqrt(2)), 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p ** count * (1 - p) ** (projections - count)
        if below > loss:
            return count
    return projections


def tables_for(cuts: int, cosine: float = COSINE, recall: float = RECALL) -> int:
    """Tables until a pair at the threshold shares a cell of ``cuts`` cuts with this probability."""
    together = (1 - math.acos(cosine) / math.pi) ** cuts
    return 1 if together >= recall else math.ceil(math.log(1 - recall) / math.log(1 - together))


def directions(dim: int, count: int, what: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, what]).standard_normal((dim, count))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, by way of their largest number so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def collisions(low: np.ndarray, other: np.ndarray, half: float) -> np.ndarray:
    """For each pair of a row of ``low`` and a row of ``other``: in how many projections the second is in the first's window."""
    counts = np.zeros((len(low), len(other)), np.uint8)
    places = np.arange(len(other))
    for values, queries in zip(other.T, low.T):
        order = np.argsort(values)
        ranked = values[order]
        first, end = np.searchsorted(ranked, queries - half, "left"), np.searchsorted(ranked, queries + half, "right")
        inside = np.empty(len(other), np.intp)
        inside[order] = places
        counts += (inside >= first[:, None]) & (inside < end[:, None])
    return counts


def links_of_cell(a: pd.DataFrame, b: pd.DataFrame | None, table: int, cosine: float) -> tuple[dict[int, int], list[tuple[int, int]]]:
    """Weighted numbers of links by id, and links that join what the found links join; ``b`` None: pairs within ``a``."""
    left = units(np.array(a["v"].tolist(), np.float64))
    right = left if b is None else units(np.array(b["v"].tolist(), np.float64))
    b = a if b is None else b
    lines = directions(left.shape[1], PROJECTIONS, 1)
    counts = collisions(left @ lines, right @ lines, WIDTH * math.sqrt(2 - 2 * cosine))
    i, j = np.nonzero(counts >= needed_collisions())
    if right is left:
        i, j = i[i < j], j[i < j]
    linked = np.einsum("ij,ij->i", left[i], right[j]) >= cosine
    i, j = i[linked], j[linked]
    ids_a, ids_b = a["id"].to_numpy(), b["id"].to_numpy()
    stars, seen = [], {}

    def root(x: int) -> int:
        while seen.get(x, x) != x:
            seen[x] = x = seen.get(seen[x], seen[x])
        return x

    for x, y in zip(ids_a[i].tolist(), ids_b[j].tolist()):
        rx, ry = root(x), root(y)
        if rx != ry:
            seen[max(rx, ry)] = min(rx, ry)
            stars.append((rx, ry))
    cells_a, cells_b = np.array(a["cells"].tolist()), np.array(b["cells"].tolist())
    fresh = ~(cells_a[i, :table] == cells_b[j, :table]).any(axis=1)  # not met in an earlier table
    i, j = i[fresh], j[fresh]
    n_a = np.bincount(i, b["weight"].to_numpy()[j], len(a))
    n_b = np.bincount(j, a["weight"].to_numpy()[i], len(b))
    numbers: dict[int, int] = {}
    for ids, found in ((ids_a, n_a), (ids_b, n_b)):
        for k in np.flatnonzero(found).tolist():
            numbers[int(ids[k])] = numbers.get(int(ids[k]), 0) + int(found[k])
    return numbers, stars


def usable(vectors: DataFrame) -> DataFrame:
    """(id, weight, v): one row for each different vector that has a direction."""
    v = F.col("v")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(v.isNotNull() & fine & F.exists(v, lambda x: x != 0)).groupBy("v").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight")).where("id IS NOT NULL")


def links(distinct: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """(id, n_links) and (a, b) over different vectors: numbers of linked rows, and links with the same components."""
    n = distinct.count()
    cuts = max(0, math.ceil(math.log2(max(1, n) / CELL)))
    tables = tables_for(cuts, cosine)

    def with_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = 1 << np.arange(cuts, dtype=np.int64)
        for batch in batches:
            for dim, rows in batch.groupby(batch["v"].map(len)):
                x = units(np.array(rows["v"].tolist(), np.float64))
                signs = (x @ directions(dim, tables * cuts, 0)).reshape(len(x), tables, cuts) >= 0
                codes = signs @ powers if cuts else np.zeros((len(x), tables), np.int64)
                yield rows.assign(cells=list(codes), dim=dim)

    celled = distinct.select("id", "weight", F.col("v").cast("array<double>").alias("v")).mapInPandas(
        with_cells, "id long, weight long, v array<double>, cells array<long>, dim long")
    celled = written(celled, "cells")
    rows = celled.select("*", F.posexplode("cells").alias("table", "cell"))
    sizes = rows.groupBy("table", "dim", "cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shape = sizes.withColumn("blocks", F.ceil(F.col("size") / BLOCK))
    # Only cells of two vectors or more: at most 1 / CELL as many rows as vectors, in each table, and joined by shuffle beyond Spark's bound.
    rows = rows.join(shape, ["table", "dim", "cell"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # Blocks meet pairwise: a vector of block x goes to the meetings (x, y) and (y, x), y from x on and before it.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    met = rows.select("*", other).select(
        "id", "weight", "v", "cells", "table", "dim", "cell", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))

    def meet(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        table, x, y = int(key[0]), key[3], key[4]
        if x == y:
            a, b = group, None
        else:
            a, b = group[group["block"] == x], group[group["block"] == y]
        numbers, stars = ({}, []) if not len(a) or (b is not None and not len(b)) else links_of_cell(
            a.reset_index(drop=True), None if b is None else b.reset_index(drop=True), table, cosine)
        out = [(k, v, None) for k, v in numbers.items()] + [(p, 0, q) for p, q in stars]
        return pd.DataFrame(out, columns=["id", "n_links", "other"]).astype({"id": "int64", "n_links": "int64", "other": "Int64"})

    found = written(met.groupBy("table", "dim", "cell", "x", "y").applyInPandas(meet, "id long, n_links long, other long"), "met")
    numbers = found.where("other IS NULL").groupBy("id").agg(F.sum("n_links").alias("n_links"))
    return numbers, found.where("other IS NOT NULL").select(F.col("id").alias("a"), F.col("other").alias("b"))


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``embeddings``.

    Vectors of different length are never linked. A vector that is missing,
    zero, empty or holds a missing or non-finite number, and one without an id,
    links with nothing: no links, its own component, kept. Equal rows are
    linked with each other; a repeated id counts each of its rows.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    named = written(usable(rows.where("vec_id IS NOT NULL")), "vectors")
    numbers, stars = links(named, cosine)
    classes = components(stars)
    known = named.join(numbers, "id", "left").join(classes.withColumnRenamed("node", "id"), "id", "left").select(
        "v", (F.coalesce("n_links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    with_id = rows.where("vec_id IS NOT NULL").join(known, "v", "left")
    none = F.lit(0).cast("long")
    component = F.coalesce("component_id", "vec_id")
    return with_id.select("vec_id", F.coalesce("n_links", none).alias("n_links"), component.alias("component_id"),
                          (F.col("vec_id") == component).alias("kept")).unionAll(
        rows.where("vec_id IS NULL").select("vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")))
