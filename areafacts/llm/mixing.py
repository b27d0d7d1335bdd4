"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A flow routes tokens from the
patterns to their sources' quotas: a pattern supplies its tokens once at cost 0, and again for each repetition at a
rising cost, so a quota is met with the least repetition. The flow gives every pattern a number of whole passes and a
rest; the rest is filled with documents in seeded order.

The graph has a node for each source and each pattern, as many as the corpus has, however many documents: only their
token counts reach the driver. The order is by hash: where the rest ends is found by histograms of hash prefixes (4,096
sums a pattern and round), down to a bucket of at most FILL rows, from which documents are taken as they fit. No pattern
is ever sorted, so one that holds a third of all rows is as cheap as the others.

Defined cases: a null text has size 0; a document without a source (null) is a member of the null source; a null
element of a list of sources is the null source. Documents of size 0 take no words. Repeated rows are documents of their
own, and which of several identical rows is taken does not show in the result. Extra columns are ignored; an empty table
gives no rows. Reruns agree.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from areafacts.llm.common import WORD, stored

SEED = 7
# Marginal cost of the first, second and third pass over a pattern.
PASS_COSTS = (0, 1, 3)
# Rows in which a pattern's rest is filled document by document.
FILL = 1024
KEY_DIGITS = 32
# Rows (of the plan, of the last buckets) up to which they are sent to every task; a shuffled join serves more.
BROADCAST = 50_000
# A prefix that no key has or precedes: nothing beyond the whole passes is taken.
NOWHERE = "!"


def targets(sizes: list[int], weights: list[float], total: int, most: float) -> list[float]:
    """Shares of ``total`` by weight, none above ``most`` times its size; the excess is shared again by weight."""
    found, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        weight = sum(weights[i] for i in sorted(free))
        over = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                found[i] = left * weights[i] / weight
            break
        for i in sorted(over):
            found[i] = float(most * sizes[i])
            left -= found[i]
            free.remove(i)
    return found


class Flow:
    """Min-cost maximum flow by successive cheapest augmenting paths; integer capacities."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.to))
            self.to.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def cheapest(self, source: int) -> tuple[list[float], list[int]]:
        distance, via, queue = [float("inf")] * len(self.out), [-1] * len(self.out), deque([source])
        distance[source], waiting = 0, {source}
        while queue:
            node = queue.popleft()
            waiting.discard(node)
            for arc in self.out[node]:
                end, d = self.to[arc], distance[node] + self.cost[arc]
                if self.room[arc] > 0 and d < distance[end]:
                    distance[end], via[end] = d, arc
                    if end not in waiting:
                        waiting.add(end)
                        queue.append(end)
        return distance, via

    def run(self, source: int, sink: int) -> None:
        while True:
            distance, via = self.cheapest(source)
            if distance[sink] == float("inf"):
                return
            path, node = [], sink
            while node != source:
                path.append(via[node])
                node = self.to[via[node] ^ 1]
            push = min(self.room[arc] for arc in path)
            for arc in path:
                self.room[arc] -= push
                self.room[arc ^ 1] += push

    def on(self, arc: int) -> int:
        return self.room[arc ^ 1]


def route(patterns: list[tuple[list[int], int]], quotas: list[int], costs=PASS_COSTS) -> list[int]:
    """Tokens to take of each pattern (sources it serves, tokens it has); the sum over its passes."""
    source, sink = len(patterns) + len(quotas), len(patterns) + len(quotas) + 1
    flow = Flow(sink + 1)
    for j, quota in enumerate(quotas):
        flow.arc(len(patterns) + j, sink, quota, 0)
    passes = []
    for i, (members, tokens) in enumerate(patterns):
        passes.append([flow.arc(source, i, tokens, cost) for cost in costs])
        for j in members:
            flow.arc(i, len(patterns) + j, tokens * len(costs), 0)
    flow.run(source, sink)
    return [sum(flow.on(arc) for arc in arcs) for arcs in passes]


def code_points(name: str | None) -> tuple:
    """Sources by code point, null last."""
    return (name is None, name or "")


@dataclass
class Mix:
    """``rows``: id, sources, size, times (passes of the document); ``sources``: name -> (size, target)."""

    rows: DataFrame
    sources: dict[str | None, tuple[int, float]]


def sized(docs: DataFrame, id_column: str, text_column: str, sources_column: str, seed: int, carry: bool) -> DataFrame:
    text, sources = docs[f"`{text_column}`"], docs[f"`{sources_column}`"]
    if docs.schema[sources_column].dataType.typeName() != "array":
        sources = F.array(sources)
    sources = F.coalesce(sources, F.array(F.lit(None).cast("string")))
    sources = F.when(F.size(sources) == 0, F.array(F.lit(None).cast("string"))).otherwise(F.array_sort(F.array_distinct(sources)))
    rank = F.xxhash64(F.lit(seed), docs[f"`{id_column}`"], text)
    # The second half only tells rows apart that are the same document.
    twin = F.xxhash64(F.monotonically_increasing_id())
    return docs.select(
        docs[f"`{id_column}`"].alias("id"),
        F.to_json(sources).alias("pattern"),
        sources.alias("sources"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.concat(*[F.lpad(F.hex(h), 16, "0") for h in (rank, twin)]).alias("key"),
        *([F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if carry else []),
    )


def _narrow(rows: DataFrame, plan: dict[str, dict]) -> None:
    """Moves every large pattern's prefix on by three hex digits, to the bucket in which its rest ends."""
    open_ = {k: p for k, p in plan.items() if p["n"] > FILL and len(p["prefix"]) < KEY_DIGITS}
    bucket = F.substring(F.col("key"), F.lit(1), F.length("prefix") + 3)
    inside = _planned(rows, open_).where(bucket.startswith(F.col("prefix")))
    sums = inside.groupBy("pattern", "rest", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    so_far = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ends = sums.withColumn("sum", F.sum("size").over(so_far)).where("sum > rest and sum - size <= rest")
    for r in ends.collect():  # one row a pattern
        plan[r["pattern"]] |= {"prefix": r["bucket"], "rest": r["rest"] - r["sum"] + r["size"], "n": r["n"]}


def _planned(rows: DataFrame, plan: dict[str, dict]) -> DataFrame:
    names = ("pattern", "whole", "rest", "prefix")
    listed = [tuple(p[c] for c in names) for p in plan.values()]
    small = rows.sparkSession.createDataFrame(listed, "pattern string, whole long, rest long, prefix string")
    return rows.join(F.broadcast(small) if len(listed) <= BROADCAST else small, "pattern")


def _filled(rows: pd.DataFrame) -> pd.DataFrame:
    """Documents of a pattern's last bucket, in order, that still fit."""
    rows, rest, taken = rows.sort_values("key"), int(rows["rest"].iloc[0]), []
    for size in rows["size"]:
        taken.append(size <= rest)
        rest -= size if taken[-1] else 0
    return rows.loc[taken, ["pattern", "key"]]


def mix(
    docs: DataFrame,
    weights: Callable[[list[str | None]], list[float]],
    id_column: str = "doc_id",
    text_column: str = "text",
    sources_column: str = "source",
    most: int = 3,
    seed: int = SEED,
    carry: bool = False,
) -> Mix:
    """Each source's tokens brought near its target; ``weights`` gives one for each of the sorted source names.

    With ``carry``, the rows have their document as a struct ``row``.
    """
    rows = stored(sized(docs, id_column, text_column, sources_column, seed, carry), "sized")
    groups = rows.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("size"), F.count("*").alias("n"))
    groups = sorted(groups.collect(), key=lambda g: g["pattern"])
    names = sorted({s for g in groups for s in g["sources"]}, key=code_points)
    sizes = [sum(g["size"] for g in groups if name in g["sources"]) for name in names]
    wanted = targets(sizes, weights(names), sum(g["size"] for g in groups), most)
    place = {name: i for i, name in enumerate(names)}
    members = [([place[s] for s in g["sources"]], g["size"]) for g in groups]
    taken = route(members, [round(t) for t in wanted], PASS_COSTS[:most])

    plan = {}
    for g, tokens in zip(groups, taken):
        whole, rest = divmod(tokens, g["size"]) if g["size"] else (1, 0)
        plan[g["pattern"]] = {"pattern": g["pattern"], "whole": whole, "rest": rest} | (
            {"prefix": "", "n": g["n"]} if rest else {"prefix": NOWHERE, "n": 0}
        )
    while any(p["n"] > FILL and len(p["prefix"]) < KEY_DIGITS for p in plan.values()):
        _narrow(rows, plan)
    planned = _planned(rows, plan)
    cut = F.substring(F.col("key"), F.lit(1), F.length("prefix"))
    at_end = planned.where(cut == F.col("prefix")).select("pattern", "key", "size", "rest")
    chosen = at_end.groupBy("pattern").applyInPandas(_filled, "pattern string, key string").withColumn("chosen", F.lit(True))
    if sum(FILL for p in plan.values() if p["rest"]) <= BROADCAST:
        chosen = F.broadcast(chosen)
    extra = F.when((cut < F.col("prefix")) | F.col("chosen").isNotNull(), 1).otherwise(0)
    times = planned.join(chosen, ["pattern", "key"], "left").select(
        "id", "sources", "size", (F.col("whole") + extra).cast("long").alias("times"), *(["row"] if carry else [])
    )
    return Mix(times, {name: (sizes[i], wanted[i]) for i, name in enumerate(names)})


def mixture(docs: DataFrame, weights: Callable[[list[str | None]], list[float]], **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    rows = mix(docs, weights, carry=True, **options).rows.where("times > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), "times")).alias("n")).select("row.*")
