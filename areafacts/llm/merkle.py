"""Merkle manifest of a dataset: one tree per group of rows, one tree over their roots, and a proof for every row.

A leaf is the SHA-256 of a row's fields. Per group (``source``) the leaves ascend by id; every ``arity`` consecutive nodes
become the hash of their digests until one is left, the subroot. Subroots, in the order of their groups, make the root
likewise.

Leaves are dealt by range of (group, id) and numbered from the sizes of the ranges, so a hot group is spread like any
other. A block of arity^6 leaves is one unit of work and gives six levels; the blocks' tops make the units of the next
round. The levels are stored as node rows that name their parent: the children of a node and of those above it, and the place
and slot from which the next row goes on. A node above a block is stored once for each block below it, so no more than arity^6
leaves ever meet one row.

A recursive query then climbs from every leaf: each step joins the rows to their node, hashes the (possibly tampered)
digest among its stored siblings, and appends the siblings; its last digest is compared with the root. A node row holds
``stride`` levels of its way up, so that the rows are shuffled once for these. Siblings above a block are the same for
all its leaves: they are appended once, from the block's path.

Defined cases: a null group is a group of its own, before all others; a null id comes before all ids and is not tampered.
Rows that share group and id are ordered by their leaf; each has a row in the result. A null field hashes as ``-``, an
empty one as ``0:``. Tampering that changes nothing verifies. A lone leaf is its subroot, a lone subroot the root, and
with neither the proof is the hash of the empty text. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from areafacts.llm.common import batch, stored

# Units whose rows a task holds at once.
UNITS = 64

_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

CLIMB = """
WITH RECURSIVE climb AS (
  SELECT at, block, 0 AS step, place, slot, digest, found, id FROM {leaves}
  UNION ALL
  SELECT c.at, c.block, c.step + 1, n.parent, n.parent_slot,
         aggregate(n.path, c.digest, (acc, s) -> unhex(sha2(array_join(
           transform(s.children, (x, i) -> lower(hex(if(i = coalesce(s.slot, c.slot), acc, x)))), ''), 256))),
         CASE WHEN NOT n.above THEN aggregate(n.path, X'', (acc, s) -> aggregate(
           filter(s.children, (x, i) -> i <> coalesce(s.slot, c.slot)), acc, (a, x) -> concat(a, x))) END,
         CAST(NULL AS LONG)
  FROM climb c JOIN {nodes} n ON c.block = n.block AND c.step = n.step AND c.place = n.place
)
SELECT at, block, step, digest, found, id FROM climb WHERE found IS NOT NULL OR slot IS NULL
"""


@dataclass(frozen=True)
class Shape:
    """Children of a node, levels that one unit of work builds from at most ``unit`` nodes, levels of a step up."""

    arity: int = 3
    height: int = 6
    stride: int = 3

    @property
    def unit(self) -> int:
        return self.arity**self.height


def leaf(fields: Sequence[Column]) -> Column:
    """Hex digest of a row's fields: ``-`` for a null, else its UTF-8 byte count, a colon and the value."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``at`` (unique, ascending by tree and order), ``tree_at`` (the tree's first ``at``: ascends like the
    tree), ``pos`` (place in the tree) and ``size`` (of the tree).

    No tree is gathered: its rows are counted by range, and only the counts meet.
    """
    sort = [tree, *order]
    placed = stored(rows.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)  # what Spark's number of a row says of its partition
    spans = placed.groupBy(part.alias("part"), tree).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy(tree)
    before = F.sum("n").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(
        "part",
        F.col(tree).alias("__tree"),
        "first",
        F.coalesce(before, F.lit(0)).alias("before"),
        F.sum("n").over(of_tree).alias("size"),
        F.min("first").over(of_tree).alias("tree_at"),
    )
    joined = placed.withColumn("__part", part).join(
        spans, (F.col("__part") == F.col("part")) & F.col(tree).eqNullSafe(F.col("__tree"))
    )
    return joined.withColumn("pos", F.col("at") - F.col("first") + F.col("before")).drop("__part", "part", "__tree", "first", "before")


def levels(nodes: Sequence[bytes], size: int, shape: Shape) -> list[list[bytes]]:
    """The levels above the nodes of one unit, in a tree that has ``size`` nodes on their level.

    The whole tree is climbed if it is this one unit; else exactly ``height`` levels, also where a single node goes up alone.
    """
    built = [list(nodes)]
    while len(built[-1]) > 1 if size <= shape.unit else len(built) <= shape.height:
        below = built[-1]
        built.append(
            [
                hashlib.sha256(b"".join(d.hex().encode() for d in below[i : i + shape.arity])).digest()
                for i in range(0, len(below), shape.arity)
            ]
        )
    return built


_UNIT = "tree long, unit long, block long, depth int, top binary, more long"
_CHAIN = "array<struct<slot:int,children:array<binary>>>"
_STEPS = f"array<struct<step:int,place:int,parent:int,parent_slot:int,path:{_CHAIN}>>"


def _units(rows: DataFrame, shape: Shape) -> DataFrame:
    """(tree, unit, size, block, nodes): consecutive nodes, in order, of (tree, pos, size, digest, at)."""
    unit = F.floor(F.col("pos") / shape.unit).alias("unit")
    return rows.groupBy("tree", unit).agg(
        F.max("size").alias("size"),
        F.min("at").alias("block"),
        F.sort_array(F.collect_list(F.struct("pos", "digest")))["digest"].alias("nodes"),
    )


def _built(each, shape: Shape):
    """Arrow function over units; ``each(levels, shape)`` gives what is kept of a unit's levels."""

    def build(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, UNITS):
                b = whole.slice(start, UNITS)
                out = []
                for tree, unit, size, block, nodes in zip(*(b.column(c).to_pylist() for c in ("tree", "unit", "size", "block", "nodes"))):
                    built = levels(nodes, size, shape)
                    more = -(-size // shape.unit)  # nodes of the tree on the level of the tops
                    out.append((tree, unit, block, len(built) - 1, built[-1][0], more, each(built, shape)))
                yield batch(_SCHEMAS[each], *zip(*out))

    return build


def _way(built, shape, level, at):
    """Where node ``at`` of a level climbs: its slot and the children it is among, up to ``stride`` levels."""
    found = []
    for below in built[level:-1][: shape.stride]:
        found.append((at % shape.arity, below[at // shape.arity * shape.arity :][: shape.arity]))
        at //= shape.arity
    return found, at


def _steps(built, shape):
    """For the nodes of every ``stride``-th level that share a parent: the way up from it, and the place it leads to.

    The first slot is open: it is that of the node that climbs. Nor is the last one known, at the top of the unit.
    """
    found = []
    for step, level in enumerate(range(0, len(built) - 1, shape.stride)):
        for place in range(len(built[level + 1])):
            ((_, children), *more), at = _way(built, shape, level, place * shape.arity)
            top = level + 1 + len(more) == len(built) - 1
            found.append((step, place, at // shape.arity, None if top else at % shape.arity, [(None, children), *more]))
    return found


def _chains(built, shape):
    """For each node of the unit, the children it climbs among, level by level."""
    whole = Shape(shape.arity, shape.height, len(built))
    return [_way(built, whole, 0, at)[0] for at in range(len(built[0]))]


_KEPT_CHAIN = pa.list_(pa.struct([("slot", pa.int32()), ("children", pa.list_(pa.binary()))]))
_KEPT_STEP = pa.struct([*[(c, pa.int32()) for c in ("step", "place", "parent", "parent_slot")], ("path", _KEPT_CHAIN)])
_NAMED = [("tree", pa.int64()), ("unit", pa.int64()), ("block", pa.int64()), ("depth", pa.int32()), ("top", pa.binary()), ("more", pa.int64())]
_SCHEMAS = {
    _steps: pa.schema([*_NAMED, ("kept", pa.list_(_KEPT_STEP))]),
    _chains: pa.schema([*_NAMED, ("kept", pa.list_(_KEPT_CHAIN))]),
}


def _round(rows: DataFrame, shape: Shape, purpose: str, chains: bool) -> DataFrame:
    kept, kind = (_chains, f"array<{_CHAIN}>") if chains else (_steps, _STEPS)
    return stored(_units(rows, shape).mapInArrow(_built(kept, shape), f"{_UNIT}, kept {kind}"), purpose)


def _rounds_above(table: DataFrame, shape: Shape) -> list[DataFrame]:
    """Rounds over the tops of ``table``'s units, until every tree has one top."""
    found = []
    while not table.where("more > 1").isEmpty():
        tops = table.where("more > 1").select(
            "tree", F.col("unit").alias("pos"), F.col("more").alias("size"), F.col("top").alias("digest"), F.col("block").alias("at")
        )
        table = _round(tops, shape, "tops", chains=True)
        found.append(table)
    return found


def _finished(tables: Sequence[DataFrame]) -> DataFrame:
    """(tree, top): of each tree."""
    parts = [t.where("more = 1").select("tree", "top") for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _paths(rounds: Sequence[DataFrame], above: DataFrame, shape: Shape) -> DataFrame | None:
    """(tree, pos, path) of the nodes that the first of ``rounds`` starts from: their chain up to the root.

    ``above`` has the chain (tree, path) from each tree's top. Joins follow the units, so no more rows meet than a unit has.
    """
    up = None
    for table in reversed(rounds):
        children = table.select(
            "tree", "unit", "more", F.posexplode("kept").alias("i", "chain")
        ).withColumn("pos", F.col("unit") * shape.unit + F.col("i"))
        last = children.where("more = 1").join(above, "tree")
        parts = last.select("tree", "pos", F.concat("chain", "path").alias("path"))
        if up is not None:
            higher = up.select("tree", F.col("pos").alias("unit"), "path")
            rest = children.where("more > 1").join(higher, ["tree", "unit"])
            parts = parts.union(rest.select("tree", "pos", F.concat("chain", "path").alias("path")))
        up = parts
    return up


def _node_rows(blocks: DataFrame, paths: DataFrame, shape: Shape) -> DataFrame:
    """(block, step, place, path, parent, parent_slot, above) of the levels in blocks, and of those above for each block."""
    inside = blocks.join(paths, "block").select(
        "block", F.get("path", F.lit(0))["slot"].alias("slot"), F.explode("kept").alias("s")
    )
    inside = inside.select(
        "block", "s.step", "s.place", "s.path", "s.parent", F.coalesce("s.parent_slot", "slot").alias("parent_slot"), F.lit(False).alias("above")
    )
    stride = F.lit(shape.stride)
    parts = F.sequence(F.lit(0), F.ceil(F.size("path") / stride).cast("int") - 1)
    above = blocks.select("block", "depth").join(paths.where(F.size("path") > 0), "block")
    above = above.select("block", "depth", "path", F.explode(parts).alias("i"))
    above = above.select(
        "block",
        (F.ceil(F.col("depth") / stride).cast("int") + F.col("i")).alias("step"),
        F.lit(0).alias("place"),
        F.slice("path", F.col("i") * stride + 1, stride).alias("path"),
        F.lit(0).alias("parent"),
        F.get("path", (F.col("i") + 1) * stride)["slot"].alias("parent_slot"),
        F.lit(True).alias("above"),
    )
    return inside.union(above)


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _siblings(path: Column) -> Column:
    """Digests along a path, without the one that climbs, as text."""
    each = F.transform(path, lambda s: F.transform(F.filter(s["children"], lambda x, i: i != s["slot"]), _text))
    return F.array_join(F.flatten(each), "")


def _climbed(leaves: DataFrame, nodes: DataFrame, above: DataFrame) -> DataFrame:
    """Every row's way up, gathered: (id, own, folded, subroot, proof_sha256). ``above``: (block, siblings, subroot)."""
    spark = leaves.sparkSession
    before = spark.conf.get(_ROW_LIMIT, None)
    spark.conf.set(_ROW_LIMIT, "-1")  # as many rows as leaves and levels
    try:
        steps = spark.sql(CLIMB, leaves=leaves, nodes=nodes)
        way = F.sort_array(F.collect_list(F.when(F.col("found").isNotNull(), F.struct("step", "found"))))
        rows = steps.groupBy("at", "block").agg(F.max("id").alias("id"), F.max_by("digest", "step").alias("folded"), way.alias("way"))
        inside = F.array_join(F.transform(F.slice("way", 2, F.size("way")), lambda s: _text(s["found"])), "")
        joined = rows.join(above, "block")
        proof = F.sha2(F.concat(inside, "siblings"), 256).alias("proof_sha256")
        return stored(joined.select("id", F.col("way")[0]["found"].alias("own"), "folded", "subroot", proof), "climb")
    finally:
        spark.conf.unset(_ROW_LIMIT) if before is None else spark.conf.set(_ROW_LIMIT, before)


def manifest(
    df: DataFrame,
    fields: Sequence[str],
    tampered: Mapping[str, Column],
    id_column: str = "doc_id",
    group_column: str = "source",
    shape: Shape = Shape(),
) -> DataFrame:
    """``id, leaf, subroot, root, proof_sha256, folded_root, verified`` of each row.

    ``tampered`` replaces fields by expressions over ``df``: the changed row is folded with the siblings of the original
    manifest, all of whose digests are hex text.
    """
    spark = df.sparkSession
    columns = {c: df[f"`{c}`"] for c in fields}
    leaves = df.select(
        df[f"`{id_column}`"].cast("long").alias("id"),
        df[f"`{group_column}`"].alias("source"),
        F.unhex(leaf(list(columns.values()))).alias("digest"),
        F.unhex(leaf(list({**columns, **tampered}.values()))).alias("changed"),
    )
    leaves = stored(leaves, "hashed")  # the texts are read once, not again to find the ranges
    ordered = stored(numbered(leaves, "source", ["id", "digest", "changed"]).drop("source").withColumnRenamed("tree_at", "tree"), "leaves")
    blocks = _round(ordered, shape, "blocks", chains=False)
    rounds = _rounds_above(blocks, shape)
    subroots = numbered(_finished([blocks, *rounds]).withColumn("whole", F.lit(0)), "whole", ["tree"])
    subroots = stored(subroots.withColumnRenamed("tree", "of").withColumnRenamed("tree_at", "tree"), "subroots")

    first = _round(subroots.withColumnRenamed("top", "digest"), shape, "subroot_units", chains=True)
    higher = [first, *_rounds_above(first, shape)]
    root = _finished(higher).first()
    nothing = F.array().cast(_CHAIN).alias("path")
    in_whole = _paths(higher, spark.createDataFrame([(r["tree"],) for r in [root] if r], "tree long").select("tree", nothing), shape)
    above = subroots.select(F.col("of").alias("tree"), "pos", F.col("top").alias("subroot")).join(in_whole.select("pos", "path"), "pos")
    above = stored(above.drop("pos"), "subroot_paths")
    paths = blocks.where("more = 1").join(above, "tree").select("block", "path", "subroot")
    if rounds:
        tops = _paths(rounds, above.select("tree", "path"), shape).withColumnRenamed("pos", "unit")
        inner = blocks.where("more > 1").join(tops, ["tree", "unit"]).join(above.select("tree", "subroot"), "tree")
        paths = paths.union(inner.select("block", "path", "subroot"))
    paths = stored(paths, "paths")

    nodes = stored(_node_rows(blocks, paths.select("block", "path"), shape), "nodes")
    start = paths.select("block", F.get("path", F.lit(0))["slot"].alias("slot"))
    of_block = blocks.select("tree", "unit", "block", "depth").join(start, "block")
    place = F.col("pos") % shape.unit
    alone = F.col("depth") == 0
    seeds = ordered.withColumn("unit", F.floor(F.col("pos") / shape.unit)).join(of_block, ["tree", "unit"]).select(
        "at",
        "block",
        F.when(alone, 0).otherwise(F.floor(place / shape.arity)).cast("int").alias("place"),
        F.when(alone, F.col("slot")).otherwise(place % shape.arity).cast("int").alias("slot"),
        F.col("changed").alias("digest"),
        F.col("digest").alias("found"),
        "id",
    )
    above = paths.select("block", _siblings(F.col("path")).alias("siblings"), "subroot")
    climbed = _climbed(stored(seeds, "seeds"), nodes, above)

    top = F.lit(root["top"].hex() if root else None).cast("string")
    return climbed.select(
        F.col("id").alias(id_column),
        _text(F.col("own")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        top.alias("root"),
        "proof_sha256",
        _text(F.col("folded")).alias("folded_root"),
        (_text(F.col("folded")) == top).alias("verified"),
    )
