"""Embedding near-duplicates: exact threshold pairs by dual traversal of cover trees.

Vectors are scaled to length one, where a cosine of at least c is a distance of at most sqrt(2 - 2c). Equal vectors of a
label are one point with a weight. A tree's levels are nested: a node's point is again the first of its children, each
child lies further than half the node's radius from the others' points, and every point below joins the nearest child.
A node knows its covering radius, the greatest distance to a point below it. Two nodes whose points are further apart
than the threshold and both radii hold no pair; where even their farthest points are close enough all pairs are links.

A label is a cell, and a cell that is too much for a task is split by the same rule, with points drawn by their hash as
centres; the split cells are the upper levels of the tree. A point belongs to one cell and visits those later ones that
its distance from their centre and their radius do not exclude, level by level. Each cell is then one tree in one task:
its points among themselves, and its visitors batch by batch; a cell with many visitors is dealt to several tasks.

Pairs are counted, not written: a task gives each point's weighted number of partners and a spanning forest of its links.

Defined cases: a row whose label or id is null, or whose vector is null, empty, zero or holds a null or non-finite
component, links with nothing (no links, its own component, kept). Vectors of different lengths do not link. Repeated rows,
of one id too, are vectors of their own, so a copy is a link. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areafacts.llm import vectors as V
from areafacts.llm.common import batch, smallest, stored
from areafacts.llm.components import components

# Numbers of a cell's vectors that one task holds (and rows, however short they are).
NUMBERS, ROWS = 2**20, 2**14
# Centres drawn for a cell that is split, and tasks that assign its points.
CENTRES, SALTS = 64, 64
# Points of a node that are compared one by one, and distances computed at once.
SMALL, AT_ONCE = 64, 2**20
# Distances are computed in doubles: no bound excludes a pair by less than this.
SLACK = 1e-6


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by their largest component first, so that no square leaves the range of doubles."""
    rows = rows / np.abs(rows).max(axis=1, initial=0, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def net(points: np.ndarray, apart: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points (the first among them) more than ``apart`` from each other that cover all: (net, nearest of it, distance)."""
    n = len(points)
    near, at = np.full(n, np.inf), np.zeros(n, np.int64)
    chosen: list[int] = []
    while True:
        open_ = np.flatnonzero(near > apart)
        if not len(open_):
            return np.array(chosen), at, near
        some = open_[: max(1, min(256, AT_ONCE // n))]
        d = distances(points[some], points)
        d[np.arange(len(some)), some] = 0
        for row, i in zip(d, some):
            if near[i] > apart:
                closer = row < near
                near[closer], at[closer] = row[closer], len(chosen)
                chosen.append(int(i))


@dataclass
class Tree:
    """Points in tree order, and nodes in arrays: the first point, the end of the points, radius, children."""

    points: np.ndarray
    order: np.ndarray  # original place of each point
    first: np.ndarray
    end: np.ndarray
    radius: np.ndarray
    child: np.ndarray  # first child; children are consecutive
    children: np.ndarray

    @property
    def centres(self) -> np.ndarray:
        return self.points[self.first]


def built(points: np.ndarray) -> Tree:
    """The cover tree of unit vectors, level by level; a node of SMALL points or none away from its own is not split."""
    order, nodes = np.arange(len(points)), []  # nodes: [first, end, radius, child, children]
    d = distances(points[:1], points)[0] if len(points) else np.empty(0)
    nodes.append([0, len(points), float(d.max(initial=0)), 0, 0])
    at = 0
    while at < len(nodes):
        first, end, radius, *_ = nodes[at]
        if end - first > SMALL and radius > SLACK:
            mine = points[order[first:end]]
            chosen, of, away = net(mine, radius / 2)
            by = np.lexsort((np.where(np.isin(np.arange(len(mine)), chosen), -1, away), of))
            order[first:end] = order[first:end][by]
            edges = np.searchsorted(of[by], np.arange(len(chosen) + 1))
            far = np.maximum.reduceat(away[by], edges[:-1])
            nodes[at][3:] = [len(nodes), len(chosen)]
            for a, b, r in zip(edges, edges[1:], far):
                nodes.append([first + int(a), first + int(b), float(r), 0, 0])
        at += 1
    first, end, radius, child, children = (np.array(c) for c in zip(*nodes))
    return Tree(points[order], order, first, end, radius.astype(float), child, children)


class Links:
    """What the traversals find: each point's weight of partners, and a spanning forest of the links."""

    def __init__(self, weight: np.ndarray) -> None:
        self.weight, self.found = weight, np.zeros(len(weight), np.int64)
        self.root = np.arange(len(weight))
        self.edges: list[tuple[int, int]] = []

    def grow(self, weight: np.ndarray) -> int:
        """Room for further points; returns the place of the first."""
        start = len(self.weight)
        self.weight = np.append(self.weight, weight)
        self.found = np.append(self.found, np.zeros(len(weight), np.int64))
        self.root = np.append(self.root, np.arange(start, start + len(weight)))
        return start

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Points linked pair by pair are of one component."""
        low, high = np.minimum(self.root[a], self.root[b]), np.maximum(self.root[a], self.root[b])
        open_ = np.flatnonzero(low != high)
        if not len(open_):
            return
        _, at = np.unique(low[open_] * len(self.root) + high[open_], return_index=True)
        for k in open_[at].tolist():
            x, y = self._top(low[k]), self._top(high[k])
            if x != y:
                self.root[max(x, y)] = min(x, y)
                self.edges.append((int(a[k]), int(b[k])))
        up = self.root[self.root]
        while (up != self.root).any():
            self.root = up
            up = up[up]

    def _top(self, x: int) -> int:
        while x != self.root[x]:
            x = self.root[x]
        return x

    def pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        np.add.at(self.found, a, self.weight[b])
        np.add.at(self.found, b, self.weight[a])
        self.join(a, b)

    def all_of(self, a: np.ndarray, b: np.ndarray | None) -> None:
        """Every point of ``a`` with every one of ``b`` (``None``: among themselves)."""
        self.found[a] += self.weight[a if b is None else b].sum() - (self.weight[a] if b is None else 0)
        if b is not None:
            self.found[b] += self.weight[a].sum()
        everyone = a if b is None else np.append(a, b)
        self.join(np.full(len(everyone) - 1, everyone[0]), everyone[1:])


def traverse(a: Tree, b: Tree | None, cosine: float, links: Links, base_b: int = 0) -> None:
    """All links between the points of two trees, or (``b`` is None) among those of one."""
    alone, b = b is None, a if b is None else b
    if not len(a.points) or not len(b.points):
        return
    reach = np.sqrt(max(0.0, 2 - 2 * cosine))

    def linked(i: np.ndarray, j: np.ndarray, same: bool) -> None:
        if same:
            i, j = i[i < j], j[i < j]
        links.pairs(a.order[i], b.order[j] + base_b)

    def exact(m: int, n: int, same: bool) -> None:
        step = max(1, AT_ONCE // max(1, b.end[n] - b.first[n]))
        for start in range(a.first[m], a.end[m], step):
            i, j = np.nonzero(a.points[start : min(a.end[m], start + step)] @ b.points[b.first[n] : b.end[n]].T >= cosine)
            linked(i + start, j + b.first[n], same)

    def near(left: np.ndarray, right: np.ndarray, same: bool) -> list[tuple[int, int]]:
        """Pairs of nodes that the covering radii do not exclude; those of single points are decided at once."""
        found, points = [], b.points[b.first[right]]
        many_a, many_b = a.end[left] - a.first[left] > 1, b.end[right] - b.first[right] > 1
        step = max(1, AT_ONCE // len(right))
        for start in range(0, len(left), step):
            some = left[start : start + step]
            product = a.points[a.first[some]] @ points.T
            bound = reach + SLACK + a.radius[some][:, None] + b.radius[right][None, :]
            i, j = np.nonzero(np.sqrt(np.maximum(0, 2 - 2 * product)) <= bound)
            if same:
                i, j = i[i + start <= j], j[i + start <= j]
            nodes = many_a[i + start] | many_b[j]
            found += zip(some[i[nodes]].tolist(), right[j[nodes]].tolist())
            i, j = i[~nodes], j[~nodes]
            hit = product[i, j] >= cosine
            linked(a.first[some[i[hit]]], b.first[right[j[hit]]], same)
        return found

    todo = [(0, 0)]
    while todo:
        m, n = todo.pop()
        same = alone and m == n
        size_m, size_n = a.end[m] - a.first[m], b.end[n] - b.first[n]
        span = a.radius[m] + b.radius[n]
        away = 0.0 if same else distances(a.points[a.first[m]][None], b.points[b.first[n]][None])[0, 0]
        if away > reach + span + SLACK:
            continue
        if away + span <= reach - SLACK:
            mine = a.order[a.first[m] : a.end[m]]
            links.all_of(mine, None if same else b.order[b.first[n] : b.end[n]] + base_b)
        elif (not a.children[m] and not b.children[n]) or size_m * size_n <= SMALL**2:
            exact(m, n, same)
        elif same:
            todo += near(_below(a, m), _below(a, m), True)
        elif a.children[m] and (a.radius[m] >= b.radius[n] or not b.children[n]):  # the larger one is opened
            todo += near(_below(a, m), np.array([n]), False)
        else:
            todo += near(np.array([m]), _below(b, n), False)


def _below(tree: Tree, node: int) -> np.ndarray:
    return np.arange(tree.child[node], tree.child[node] + tree.children[node])


# -- cells ------------------------------------------------------------------------------------------------

_POINT = "node long, weight long, vector array<double>"
_STATE = f"cell string, own boolean, {_POINT}"


def _groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Runs of rows with equal keys in batches that are sorted by them; a run may come in several parts."""
    for b in V.slices(batches):
        names = list(zip(*(b.column(k).to_pylist() for k in keys)))
        start = 0
        for i in range(1, len(names) + 1):
            if i == len(names) or names[i] != names[start]:
                yield names[start], b.slice(start, i - start)
                start = i


def _limit(dim: int) -> int:
    return max(2 * CENTRES, min(ROWS, NUMBERS // max(1, dim)))


def _nearest(d: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The nearest centre of each point; those that rounding cannot tell apart share the points by their numbers."""
    tied = d <= d.min(axis=1, keepdims=True) + SLACK
    wanted = node % tied.sum(axis=1)
    return (np.cumsum(tied, axis=1) == (wanted + 1)[:, None]).argmax(axis=1)


def _with_centres(rows: DataFrame, centres: DataFrame, work, ddl: str) -> DataFrame:
    """``work`` over rows dealt to SALTS tasks a cell, each run of them behind its cell's centres (bounded by CENTRES)."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).withColumn("rank", F.lit(-1)).withColumn("radius", F.lit(0.0))
    copies = centres.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumns({"own": F.lit(False), "child": F.lit(-1)})
    columns = ["cell", "salt", "rank", "own", "node", "weight", "vector", "child", "radius"]
    both = copies.select(*columns).union(salted.select(*columns))
    dealt = both.repartition("cell", "salt").sortWithinPartitions("cell", "salt", F.desc("rank"))
    return dealt.mapInArrow(work, ddl)


def _reading(batches) -> Iterator[tuple[str, np.ndarray, np.ndarray, pa.RecordBatch]]:
    """(cell, centres, their radii, rows) of each part of a run."""
    at, centres, radii = None, [], []
    for (cell, salt, is_centre), part in _groups(_flagged(batches), "cell", "salt", "centre"):
        if (cell, salt) != at:
            at, centres, radii = (cell, salt), [], []
        if is_centre:
            order = np.argsort(part.column("rank").to_numpy())  # descending within a run, so parts go in front
            centres = [*V.matrix(part.column("vector"))[order], *centres]
            radii = [*part.column("radius").to_numpy()[order], *radii]
        else:
            yield cell, np.array(centres), np.array(radii), part


def _flagged(batches):
    for b in batches:
        flag = pa.array(b.column("rank").to_numpy() >= 0)
        yield pa.RecordBatch.from_arrays([*b.columns, flag], names=[*b.schema.names, "centre"])


_STATE_ARROW = pa.schema(
    [("cell", pa.string()), ("own", pa.bool_()), ("node", pa.int64()), ("weight", pa.int64()), ("vector", pa.list_(pa.float64()))]
)


_ASSIGNED = _STATE_ARROW.append(pa.field("child", pa.int32())).append(pa.field("away", pa.float64()))


def _assign(batches):
    """Each point of a split cell with its nearest centre and the distance from it."""
    for cell, centres, _, part in _reading(batches):
        d = distances(V.matrix(part.column("vector")), centres)
        at = _nearest(d, part.column("node").to_numpy())
        yield batch(
            _ASSIGNED, [cell] * len(at), part.column("own"), part.column("node"), part.column("weight"), part.column("vector"),
            at, d[np.arange(len(d)), at],
        )


def _visit(reach: float):
    """Rows of a split cell go to the children they may have partners in.

    A point of the cell goes to its own child and visits those after it; one that visits the cell (child -1), all.
    """

    def work(batches):
        for cell, centres, radii, part in _reading(batches):
            at = part.column("child").to_numpy()
            d = distances(V.matrix(part.column("vector")), centres)
            row, child = np.nonzero((d <= reach + radii[None, :] + SLACK) & (np.arange(len(centres))[None, :] > at[:, None]))
            own = np.flatnonzero(at >= 0)
            for rows, children, mine in ((own, at[own], True), (row, child, False)):
                if len(rows):
                    kept = part.take(pa.array(rows))
                    yield batch(
                        _STATE_ARROW, [f"{cell}/{i:02d}" for i in children], np.full(len(rows), mine), kept.column("node"),
                        kept.column("weight"), kept.column("vector"),
                    )

    return work


def _centres_of(points: DataFrame) -> DataFrame:
    """(cell, rank, node, weight, vector): centres of each cell, a net at half the spread of CENTRES drawn points."""
    drawn = smallest(points.withColumn("__h", F.xxhash64("node")), "cell", ["__h", "node"], CENTRES).drop("__h")

    def thin(rows: pa.Table) -> pa.Table:
        found = V.matrix(rows["vector"].combine_chunks())
        spread = distances(found[:1], found).max()
        chosen, _, _ = net(found, spread / 2)
        chosen = chosen if len(chosen) > 1 else np.arange(len(found))  # too close together to be told apart
        kept = rows.take(pa.array(chosen))
        return pa.table(
            {"cell": kept["cell"], "rank": pa.array(np.arange(len(chosen)), pa.int32()), "node": kept["node"],
             "weight": kept["weight"], "vector": kept["vector"]}
        )

    return drawn.select("cell", "node", "weight", "vector").groupBy("cell").applyInArrow(
        thin, f"cell string, rank int, {_POINT}"
    )


def cells(points: DataFrame, reach: float, limit: int | None = None) -> DataFrame:
    """(cell, own, node, weight, vector): points in cells of bounded size, and where they visit others."""
    state, done = points.withColumn("own", F.lit(True)), []
    while True:
        size = state.where("own").groupBy("cell").agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim"))
        most = F.greatest(F.lit(2 * CENTRES), F.least(F.lit(ROWS), F.floor(NUMBERS / F.col("dim")))) if limit is None else F.lit(limit)
        large = stored(size.where(F.col("n") > most).select("cell"), "large")
        if large.isEmpty():
            done.append(state)
            break
        done.append(state.join(large, "cell", "left_anti"))
        split = state.join(large, "cell", "left_semi")
        centres = stored(_centres_of(split.where("own")), "centres")
        unplaced = split.withColumn("child", F.lit(-1))
        assigned = _with_centres(unplaced.where("own"), centres.withColumn("radius", F.lit(0.0)), _assign, f"{_STATE}, child int, away double")
        assigned = stored(assigned, "assigned")  # decided once: in another batch, rounding may turn out otherwise
        radii = assigned.groupBy("cell", F.col("child").alias("rank")).agg(F.max("away").alias("radius"))
        # a centre that no point chose is no child: nothing is within its radius
        measured = stored(centres.join(radii, ["cell", "rank"], "left").fillna(-100.0, ["radius"]), "measured")
        rows = assigned.drop("away").unionByName(unplaced.where(~F.col("own")))
        state = stored(_with_centres(rows, measured, _visit(reach), _STATE), "cells")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("cell", "own", "node", "weight", "vector")


def _linked(cosine: float):
    """Cell by cell: (a, a, n) for the weight n of a's partners, and (a, b, 0) for each link of the forest."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    class Cell:
        """One cell, or its share of the visitors: points first, then visitors in batches; the first share has the pairs within."""

        def __init__(self, salt: int) -> None:
            self.salt, self.tree, self.waiting, self.rows = salt, None, [], 0

        def add(self, own: bool, part: pa.RecordBatch) -> None:
            if not own and self.tree is None:
                self.plant()
            self.waiting.append(part)
            self.rows += part.num_rows
            if not own and self.rows >= _limit(self.tree.points.shape[1]):
                self.visit()

        def taken(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows = pa.Table.from_batches(self.waiting).combine_chunks()
            self.waiting, self.rows = [], 0
            return rows["node"].to_numpy(), rows["weight"].to_numpy(), V.matrix(rows["vector"].combine_chunks())

        def plant(self) -> None:
            self.nodes, weight, points = self.taken()
            self.tree, self.links = built(points), Links(weight)
            if self.salt == 0:
                traverse(self.tree, None, cosine, self.links)

        def visit(self) -> None:
            if self.waiting:
                node, weight, points = self.taken()
                base, self.nodes = self.links.grow(weight), np.append(self.nodes, node)
                traverse(self.tree, built(points), cosine, self.links, base)

        def result(self) -> Iterator[pa.RecordBatch]:
            self.plant() if self.tree is None else self.visit()
            some = np.flatnonzero(self.links.found)
            yield batch(schema, self.nodes[some], self.nodes[some], self.links.found[some])
            if self.links.edges:
                a, b = np.array(self.links.edges).T
                yield batch(schema, self.nodes[a], self.nodes[b], np.zeros(len(a), np.int64))

    def work(batches):
        at, cell = None, None
        for (name, salt, own), part in _groups(batches, "cell", "salt", "own"):
            if (name, salt) != at:
                if cell is not None:
                    yield from cell.result()
                at, cell = (name, salt), Cell(salt)
            cell.add(own, part)
        if cell is not None:
            yield from cell.result()

    return work


def partners(points: DataFrame, cosine: float, limit: int | None = None) -> DataFrame:
    """(a, b, n) as :func:`_linked` gives them, of points (cell, node, weight, vector of length one)."""
    placed = cells(points, float(np.sqrt(max(0.0, 2 - 2 * cosine))), limit)
    visits = placed.where(~F.col("own")).groupBy("cell").agg(F.count("*").alias("visits"), F.max(F.size("vector")).alias("dim"))
    share = F.lit(8) * (F.greatest(F.lit(2 * CENTRES), F.least(F.lit(ROWS), F.floor(NUMBERS / F.col("dim")))) if limit is None else F.lit(limit))
    shares = visits.select(F.col("cell").alias("of"), F.ceil(F.col("visits") / share).cast("int").alias("shares"))
    joined = placed.join(shares, F.col("cell") == F.col("of"), "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
    everywhere = F.sequence(F.lit(0), F.col("shares") - 1)
    one = F.array(F.pmod(F.xxhash64("node"), F.col("shares")).cast("int"))
    salted = joined.withColumn("salt", F.explode(F.when(F.col("own"), everywhere).otherwise(one)))
    dealt = salted.select("cell", "salt", "own", "node", "weight", "vector").repartition("cell", "salt")
    return dealt.sortWithinPartitions("cell", "salt", F.desc("own")).mapInArrow(_linked(cosine), "a long, b long, n long")


def _scaled(batches):
    """Classes with their vectors at length one."""
    for whole in batches:
        for b in V.slices([whole]):
            lengths = np.diff(b.column("vector").offsets.to_numpy())
            flat, owner = V.flat(b.column("vector")), np.repeat(np.arange(len(lengths)), lengths)
            top = np.zeros(len(lengths))
            np.maximum.at(top, owner, np.abs(flat))
            flat = flat / top[owner]
            flat = flat / np.sqrt(np.bincount(owner, flat * flat, len(lengths)))[owner]
            offsets = pa.array(np.append(0, np.cumsum(lengths)), pa.int32())
            columns = {n: b.column(n) for n in b.schema.names} | {"vector": pa.ListArray.from_arrays(offsets, pa.array(flat))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def near_duplicates(
    df: DataFrame,
    cosine: float,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    limit: int | None = None,
) -> DataFrame:
    """``id, n_links, component_id, kept`` of each row; only rows of one label link. ``limit``: rows of a cell, for trials."""
    if not 0 <= cosine <= 1:
        raise ValueError("a cosine from 0 to 1")
    vector = df[f"`{vector_column}`"].cast("array<double>")
    rows = df.select(df[f"`{id_column}`"].cast("long").alias("id"), df[f"`{label_column}`"].alias("label"), vector.alias("vector"))
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & V.usable(F.col("vector"), nonzero=True)
    plain = F.transform("vector", lambda x: x + 0.0)  # -0.0 is 0.0
    rows = rows.withColumn("vector", F.when(usable, plain))
    keys = [F.xxhash64("vector").alias("h1"), F.xxhash64(F.lit(1), "vector").alias("h2")]

    grouped = rows.where(F.col("vector").isNotNull()).groupBy("label", "vector").agg(
        F.count("*").alias("weight"), F.min("id").alias("least")
    )
    cell = F.concat_ws(":", F.size("vector").cast("string"), F.col("label").cast("string")).alias("cell")
    numbered = grouped.select(F.monotonically_increasing_id().alias("node"), cell, "label", "weight", "least", *keys, "vector")
    classes = stored(numbered.mapInArrow(_scaled, numbered.schema), "classes")

    found = stored(partners(classes.select("cell", "node", "weight", "vector"), cosine, limit), "partners")
    counts = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("n = 0").select("a", "b"))
    names = classes.select("node", "label", "h1", "h2", "weight", "least")
    linked = names.join(counts, "node", "left").join(roots, "node", "left").where((F.col("weight") > 1) | F.col("n").isNotNull())
    linked = linked.withColumn("root", F.coalesce("root", "node"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    decided = linked.join(least, "root").select(
        F.col("label").alias("of"), "h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    own = rows.select("id", "label", *[F.when(F.col("vector").isNotNull(), k).alias(f"row_{n}") for k, n in zip(keys, ("h1", "h2"))])
    same = (F.col("label") == F.col("of")) & (F.col("row_h1") == F.col("h1")) & (F.col("row_h2") == F.col("h2"))
    component = F.coalesce("component_id", "id")
    return own.join(decided, same, "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
