"""Mixing overlapping sources to target weights by min-cost flow.

1. Documents are summed by membership pattern, the set of sources they belong to, and patterns by source: tables, however many there are.
   Sources are ranked by a range sort; what a unit of weight is worth is found from a few sums over them.
2. A flow routes the words of the patterns to the quotas of the sources. A pattern gives its words once for nothing, a second and third
   time at rising costs, so nothing is repeated while words that were not used yet can serve. A source that shares no document is a network
   of its own with one way through, which an expression solves; only patterns of several sources, and the sources they touch, come to the driver.
3. A pattern's flow is so many whole copies of all its documents, and a part: that part is taken in the order of a seeded hash. The hash at
   which to stop is found from sums by the hash's upper bits and, within one value of them, from the documents themselves; no source is ever in one task.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemill.llm.common import columns_but, free_names, written

#: Cost of a word's first, second and third use; convex, so uses spread evenly. Their number is the most often that a document is taken.
COSTS = (0, 1, 3)
#: Weights of the sources in their order, repeating.
WEIGHTS = (1.0, 2.0, 3.0)
#: Patterns of two or more sources that the driver solves at most; more are refused, as a network is solved in one place. Others have no limit.
MAX_PATTERNS = 200_000
#: A table of patterns is broadcast up to so many rows and bytes. Beyond, only the hot ones are: those with more than one in HOT of all documents.
FEW, FEW_BYTES, HOT = 200_000, 16 << 20, 1000
SEED = 20_240
#: Upper bits of the hash whose sums are taken.
UPPER_BITS = 12


def words_in(text: Column) -> Column:
    """The number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def pattern_of(sources: Column) -> Column:
    return F.coalesce(F.to_json(F.sort_array(F.array_distinct(sources)), {"ignoreNullFields": "false"}), F.lit("[]"))


def unit(total: int, weights: Sequence[float], most: int, fill: Callable[[float], tuple[dict[int, int], int, int]]) -> float:
    """Words for each unit of weight. ``fill`` tells of such a number: how many sources of each weight are below their ceiling, how many
    have reached it, and the size of these. What the full ones cannot take goes to the others, until none more is full."""
    found, before = 0.0, -1
    while True:
        below, full, size = fill(found)
        weight = sum(weights[k] * n for k, n in sorted(below.items()))
        if full == before or not weight:
            return found
        found, before = (total - most * size) / weight, full


def targets(sizes: dict[str | None, int], weights: Sequence[float] = WEIGHTS, most: int = len(COSTS)) -> dict[str | None, float]:
    """Words wanted of each source. Sources in order of code points, null last, share all words by weight; a target stops at ``most`` times
    its source's size, and the excess is shared anew by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}

    def fill(worth: float) -> tuple[dict[int, int], int, int]:
        full = {s for s in order if worth * weight[s] > most * sizes[s]}
        below = [i % len(weights) for i, s in enumerate(order) if s not in full]
        return {k: below.count(k) for k in below}, len(full), sum(sizes[s] for s in full)

    worth = unit(sum(sizes.values()), weights, most, fill)
    return {s: float(min(worth * weight[s], most * sizes[s])) for s in order}


def cheapest_flow(capacity: dict[int, int], members: dict[int, list[int]], quota: dict[int, int], costs: Sequence[int] = COSTS) -> dict[int, int]:
    """Words that each pattern gives. members: the sources of a pattern.

    A word costs by its use alone, wherever it goes, and no path of least cost passes the start twice. So cheapest paths take up all
    that first uses can give, then second ones, and so on: a greatest flow for each use on top of the last, by blocking flows in layers.
    """
    left, need = dict.fromkeys(capacity, 0), dict(quota)
    held: dict[int, dict[int, int]] = {s: {} for s in quota}  # what a source has of each pattern
    for _ in sorted(costs):
        for p, n in capacity.items():
            left[p] += n
        while blocking_flow(left, members, need, held):
            pass
    return {p: len(costs) * n - left[p] for p, n in capacity.items()}


def layers(left: dict, members: dict, need: dict, held: dict) -> tuple[dict, dict, bool]:
    """How far patterns and sources are from patterns with words left, as far as the nearest source in need; whether there is one."""
    edge = [p for p, n in left.items() if n]
    far_p, far_s, step, found = dict.fromkeys(edge, 1), {}, 1, False
    while edge and not found:
        reached = []
        for p in edge:
            for s in members[p]:
                if s not in far_s:
                    far_s[s] = step + 1
                    reached.append(s)
                    found = found or need[s] > 0
        step, edge = step + 2, []
        for s in [] if found else reached:
            for p, n in held[s].items():
                if n and p not in far_p:
                    far_p[p] = step
                    edge.append(p)
    return far_p, far_s, found


def blocking_flow(left: dict, members: dict, need: dict, held: dict) -> bool:
    """Gives sources in need all that shortest ways can bring; False if there is no way left."""
    far_p, far_s, found = layers(left, members, need, held)
    if not found:
        return False
    at_p, at_s, back = dict.fromkeys(far_p, 0), dict.fromkeys(far_s, 0), {}
    for root in [p for p, step in far_p.items() if step == 1]:
        path = [root]
        while left[root]:
            node, step = path[-1], len(path)
            if step % 2:
                ways, at = members[node], at_p[node]
                while at < len(ways) and far_s.get(ways[at]) != step + 1:
                    at += 1
                at_p[node] = at
            elif need[node]:
                gives = list(zip(path[1:-1:2], path[2::2]))  # sources that let go of a pattern's words for others
                amount = min([left[root], need[node], *[held[s][p] for s, p in gives]])
                left[root] -= amount
                need[node] -= amount
                for s, p in gives:
                    held[s][p] -= amount
                for p, s in zip(path[::2], path[1::2]):
                    held[s][p] = held[s].get(p, 0) + amount
                path = [root]
                continue
            else:
                if node not in back:
                    back[node] = list(held[node])
                ways, at = back[node], at_s[node]
                while at < len(ways) and (far_p.get(ways[at]) != step + 1 or not held[node][ways[at]]):
                    at += 1
                at_s[node] = at
            if at < len(ways):
                path.append(ways[at])
            elif step == 1:
                break
            else:
                path.pop()
                (at_s if step % 2 else at_p)[path[-1]] += 1
    return True


@dataclass
class Lookup:
    """Joins by pattern. A small table is broadcast; of a larger one only the ``hot`` patterns are, fewer than HOT, so no key of what is left fills a task."""

    few: bool
    hot: list[str]

    def join(self, rows: DataFrame, table: DataFrame, key: Column, other: Column, how: str = "inner") -> DataFrame:
        if self.few:
            return rows.join(F.broadcast(table), key == other, how)
        cold = rows.where(~key.isin(self.hot)).join(table.where(~other.isin(self.hot)), key == other, how)
        return rows.where(key.isin(self.hot)).join(F.broadcast(table.where(other.isin(self.hot))), key == other, how).union(cold)

    def by_pattern(self, rows: DataFrame, table: DataFrame) -> DataFrame:
        return self.join(rows, table.withColumnRenamed("pattern", "_of"), F.col("pattern"), F.col("_of")).drop("_of")


@dataclass
class Plan:
    """patterns: (pattern, whole copies of its documents, words of the part); source_table: (source, pattern of that source alone, size, target)."""

    patterns: DataFrame
    source_table: DataFrame
    lookup: Lookup

    @property
    def sources(self) -> list[tuple[str | None, int, float]]:
        """(source, its words, its target), for reports on so many as a driver can hold."""
        return [(r.source, r.size, r.target) for r in self.source_table.orderBy(F.col("source").asc_nulls_last()).collect()]

    def with_targets(self, mixed: DataFrame, source: Column) -> DataFrame:
        """``mixed`` with the size and target of a document's one source, as source_size and target."""
        known = self.source_table.select(F.col("pattern").alias("_of"), F.col("size").alias("source_size"), "target")
        return self.lookup.join(mixed, known, pattern_of(F.array(source)), F.col("_of")).drop("_of")


def ranked(sizes: DataFrame, n_weights: int) -> DataFrame:
    """``sizes`` with ``k``, the number of a source's weight: its place in the order of code points, null last, counted round."""
    placed = written(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id()))
    placed = placed.withColumn("range", F.shiftright("place", 33))
    starts, n = [], 0
    for r in placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).orderBy("range").collect():  # as many as there are partitions
        starts.append((r.range, n))
        n += r.n
    starts = sizes.sparkSession.createDataFrame(starts, "range long, start long")
    k = (F.col("start") + F.col("place") - F.shiftleft("range", 33)) % n_weights
    return placed.join(F.broadcast(starts), "range").withColumn("k", k.cast("int")).drop("place", "range", "start")


def with_target(sources: DataFrame, total: int, weights: Sequence[float], most: int) -> DataFrame:
    """``sources`` (source, size, ...) with ``target``. total: the words of their documents, each counted once; where sources overlap it is less
    than the sum of their sizes, and all targets are scaled to it."""
    weighed = written(ranked(sources, len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("k") + 1)
    counted = weighed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]

    def fill(worth: float) -> tuple[dict[int, int], int, int]:
        full = F.lit(worth) * weight > most * F.col("size")
        rows = weighed.groupBy("k").agg(F.count_if(~full), F.count_if(full), F.sum(F.when(full, F.col("size")).otherwise(0))).collect()
        return {r[0]: r[1] for r in rows}, sum(r[2] for r in rows), sum(r[3] for r in rows)

    worth = unit(counted, weights, most, fill)
    target = F.least(F.lit(worth) * weight, (most * F.col("size")).cast("double"))
    return weighed.withColumn("target", target if counted == total else target * total / counted).drop("k")


def routed(multi: list, shared: list, most: int, costs: Sequence[int]) -> list[tuple[str, int, int]]:
    """(pattern, its words, words it gives). multi: (pattern, words); shared: (source, the pattern of it alone, words of that, target)."""
    at = {r.source: i for i, r in enumerate(shared)}
    words = [r.n for r in multi] + [r.own for r in shared]
    members = [[at[s] for s in json.loads(r.pattern)] for r in multi] + [[i] for i in range(len(shared))]
    given = cheapest_flow(dict(enumerate(words)), dict(enumerate(members)), {i: round(r.target) for i, r in enumerate(shared)}, costs)
    return [(r.pattern, words[i], given[i]) for i, r in enumerate([*multi, *shared])]


def plan(narrow: DataFrame, weights: Sequence[float] = WEIGHTS, costs: Sequence[int] = COSTS) -> Plan:
    """narrow: (pattern, size) of every document."""
    spark, most = narrow.sparkSession, len(costs)
    sums = written(narrow.groupBy("pattern").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("n_rows")))
    is_in = F.from_json("pattern", "array<string>")
    facts = sums.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("pattern")), F.lit(0)), F.coalesce(F.sum("n_rows"), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("pattern") != "[]", F.col("n"))), F.lit(0)),
    ).first()
    few = facts[0] <= FEW and facts[1] <= FEW_BYTES
    hot = [] if few else [r.pattern for r in sums.where(F.col("n_rows") * HOT > facts[2]).select("pattern").collect()]
    several = F.size(is_in) > 1
    each = sums.select(F.explode(is_in).alias("source"), "n", several.alias("several"))
    by_source = each.groupBy("source").agg(
        F.sum("n").alias("size"), F.sum(F.when(~F.col("several"), F.col("n")).otherwise(0)).alias("own"), F.max("several").alias("shared")
    )
    sources = with_target(by_source, facts[3], weights, most).withColumn("pattern", pattern_of(F.array("source")))
    sources = written(sources)
    given = sources.where(~F.col("shared")).select("pattern", F.col("size").alias("n"), F.least(F.rint("target").cast("long"), most * F.col("size")).alias("given"))
    multi = sums.where(several).select("pattern", "n").limit(MAX_PATTERNS + 1).collect()
    if len(multi) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of several sources")
    if multi:
        multi.sort()
        shared = sources.where("shared").select("source", "pattern", "own", "target").orderBy("pattern").collect()
        given = given.union(spark.createDataFrame(routed(multi, shared, most, costs), "pattern string, n long, given long"))
    whole = F.expr("CASE WHEN n > 0 THEN given DIV n ELSE 0L END").alias("whole")
    part = F.expr("CASE WHEN n > 0 THEN given % n ELSE 0L END").alias("part")
    return Plan(written(given.select("pattern", whole, part)), sources.select("source", "pattern", "size", "target"), Lookup(few, hot))


def hashed(docs: DataFrame, id_col: str, text_col: str, seed: int) -> Column:
    """The place of a document in the seeded order; rows all alike share it."""
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def upper(key: Column) -> Column:
    return F.shiftright(key, 64 - UPPER_BITS).cast("int")


def stops(narrow: DataFrame, parts: DataFrame, lookup: Lookup) -> DataFrame:
    """(pattern, stop, swap): documents whose hash is ``stop`` or less make up the part, but for one. parts: (pattern, part)."""
    sums = narrow.groupBy("pattern", upper(F.col("key")).alias("high")).agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("pattern").orderBy("high"))
    sums = lookup.by_pattern(sums.withColumn("before", upto - F.col("n")), parts)
    at = sums.where("before < part AND before + n >= part").select("pattern", "high", (F.col("part") - F.col("before")).alias("need"))
    found = lookup.by_pattern(narrow, at).where(upper(F.col("key")) == F.col("high"))
    # Rows that share a hash are taken or left together: the sum over a range ends after all of them.
    same = found.groupBy("pattern", "high", "need", "key").agg(F.sum("size").alias("n"))
    after = F.sum("n").over(Window.partitionBy("pattern").orderBy("key").rowsBetween(Window.unboundedPreceding, 0))
    near = same.withColumn("after", after).where(F.col("after") - F.col("n") / 2 <= F.col("need"))
    inside = near.groupBy("pattern").agg(F.max("key").alias("last"))
    low = F.shiftleft(F.col("high").cast("long"), 64 - UPPER_BITS)
    stop = at.join(inside, "pattern", "left").select("pattern", F.coalesce("last", F.when(low > F.lit(-(2**63)), low - 1)).alias("stop"))
    return swaps(narrow, parts.join(stop, "pattern"), lookup)


def swaps(narrow: DataFrame, known: DataFrame, lookup: Lookup) -> DataFrame:
    """(pattern, stop, swap): one document beyond the stop that is taken as well, or one before it that is not, where its size comes nearest
    to what the part still lacks, or has too much, and the part is nearer with it than without."""
    known = written(known)
    inside = lookup.by_pattern(narrow, known)
    taken = inside.groupBy("pattern").agg(F.sum(F.when(F.col("key") <= F.col("stop"), F.col("size")).otherwise(0)).alias("taken"))
    open_ = known.join(taken, "pattern").withColumn("gap", F.col("part") - F.col("taken"))
    found = lookup.by_pattern(narrow, open_).withColumn("miss", F.abs(F.abs("gap") - F.col("size")))
    other_side = F.when(F.col("gap") > 0, F.col("stop").isNull() | (F.col("key") > F.col("stop"))).otherwise(F.col("key") <= F.col("stop"))
    found = found.where(other_side & (F.col("miss") < F.abs("gap")))
    best = found.groupBy("pattern").agg(F.min(F.struct("miss", "key")).alias("best"))
    return open_.join(best, "pattern", "left").select("pattern", "stop", F.col("best.key").alias("swap"))


def mix(
    docs: DataFrame, sources: Column, id_col: str = "doc_id", text_col: str = "text", weights: Sequence[float] = WEIGHTS, seed: int = SEED,
    out_col: str = "_mix",
) -> tuple[DataFrame, Plan]:
    """``docs`` with ``out_col``: (size, copies), and the plan. size is a document's words, copies how often the mix takes it, 0 to 3.

    ``sources`` is an array of the sources a document belongs to; null in it is a source of its own, in none of them it is never taken.
    Documents without words (null, empty) have size 0 and come along like others. The order is a hash of seed, id and text, so reruns
    agree whatever the partitions. An empty table gives no rows.
    A column that is called ``out_col`` already gives way to it; other columns may have any name.
    """
    order, pattern, found = free_names(docs, "_order", "_pattern", "_plan")
    named = docs.select("*", F.struct(pattern_of(sources).alias("pattern"), hashed(docs, id_col, text_col, seed).alias("key")).alias(order))
    narrow = written(named.select(f"{order}.pattern", f"{order}.key", words_in(F.col(text_col)).alias("size")))
    made = plan(narrow, weights)
    known = made.patterns.join(stops(narrow, made.patterns.where("part > 0").select("pattern", "part"), made.lookup), "pattern", "left")
    known = known.select(F.col("pattern").alias(pattern), F.struct("whole", "part", "stop", "swap").alias(found))
    mixed = made.lookup.join(named, known, F.col(f"{order}.pattern"), F.col(pattern), "left")
    before_stop = F.coalesce(F.col(f"{order}.key") <= F.col(f"{found}.stop"), F.lit(False))
    swapped = F.col(f"{order}.key").eqNullSafe(F.col(f"{found}.swap"))
    copies = F.coalesce(F.col(f"{found}.whole"), F.lit(0)) + (before_stop != swapped).cast("long")
    return mixed.select(*columns_but(docs, out_col), F.struct(words_in(F.col(text_col)).alias("size"), copies.alias("copies")).alias(out_col)), made


def repeated(mixed: DataFrame, out_col: str = "_mix") -> DataFrame:
    """The mix itself: every document as often as it is taken, without ``out_col``."""
    (copy,) = free_names(mixed, "_copy")
    return mixed.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(f"{out_col}.copies").cast("int")))).drop(copy, out_col)
