"""Mixing overlapping sources to target weights by a min-cost flow.

A document may belong to several sources.  Documents with the same membership are one pattern, and all that is
decided for them follows from a network of patterns and sources: a pattern supplies its words once for each time
that it may be repeated, every further repetition at a higher cost, and may send them to any source it
belongs to; a source takes its quota.  The cheapest of the greatest flows fills the quotas with as little
repetition as possible.

All patterns pay the same for the same repetition, so the shortest augmenting paths come repetition by
repetition: each adds its supply, and paths are searched until none is left.

The words that a pattern sends are then taken document by document.  Its documents lie in a seeded order, which is
passed once for each repetition; sources take consecutive pieces of it.  Where a piece starts and ends is found by
counting (`operators/cuts.py`), so nothing is sorted or numbered.  Documents that lie across an end stay out.  A piece
that misses much by that takes another pass over the documents left that are short enough.  The last words are
closed from the largest power of two downwards with the smallest documents left; and what no document left is
short enough for, by one of them and by documents that make room for it, if that comes nearer to the quota.

Defined results: a NULL source is a source of its own; documents without sources (an empty list) and without words
are never taken; repeated rows are documents of their own; documents of equal draw and size are interchangeable; an empty
table gives none.  The order depends on seed and key alone, not on partitions.  Other columns are kept in `row`.

The driver holds the network: one row for each pattern and source of it, `MAX_ARCS` at most, beyond which a ValueError
is raised: a mixture is stated source by source.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.cuts import cut_points, is_before
from .common import stored
from .vectors import quoted

SEED = 23
REPEATS = 2
SHARE = 1.5
WEIGHTS = (3.0, 1.0, 2.0)
MAX_ARCS = 50_000
PASSES = 3  # over the documents of a pattern, for pieces that are missed by more than
CLOSE = 1000  # one of so many words
OFFERED = 8  # documents of each power of two that can close a gap, or make room for a document that does
ENDLESS = 1 << 62
WORD = r"[^\x20\x09-\x0D]+"
ORDER = ["draw", "size", "nth"]

Source = str | None


class Mixture(NamedTuple):
    rows: DataFrame  # row struct, size, sources, by_source array<struct<source, copies>>, copies, taken
    source_sizes: dict[Source, int]
    targets: dict[Source, float]
    taken: dict[Source, int]
    repetition_cost: int  # words, each counted as often as it was taken before


def in_order(sources) -> list[Source]:
    """By code point, NULL last."""
    return sorted(sources, key=lambda s: (s is None, s or ""))


def weighted_targets(sizes: dict[Source, int], weights: dict[Source, float], total: float, most: float) -> dict[Source, float]:
    """`total` shared by weight; no target above `most` times its source, the excess shared among the others by weight."""
    if not sizes:
        return {}
    names = sorted((s for s in in_order(sizes)), key=lambda s: most * sizes[s] / weights[s])
    level, filled, light = 0.0, 0.0, sum(weights[s] for s in names)
    for s in names:  # sources fill up in this order; the level of the others is the highest of these
        level = max(level, (total - filled) / light)
        filled, light = filled + most * sizes[s], light - weights[s]
        if light <= 0:
            break
    return {s: min(most * sizes[s], weights[s] * level) for s in in_order(sizes)}


def route(supply: list[int], members: list[list[int]], quotas: list[int], repeats: int) -> tuple[dict[tuple[int, int], int], int]:
    """({(pattern, source): words}, cost) of the cheapest greatest flow; the r-th copy of a word costs r - 1."""
    start, end = len(supply) + len(quotas), len(supply) + len(quotas) + 1
    head: list[int] = []
    room: list[int] = []
    arcs: list[list[int]] = [[] for _ in range(end + 1)]

    def arc(a: int, b: int, capacity: int) -> int:
        arcs[a].append(len(head))
        head.append(b)
        room.append(capacity)
        arcs[b].append(len(head))
        head.append(a)
        room.append(0)
        return len(head) - 2

    into = [arc(start, p, 0) for p in range(len(supply))]
    across = {(p, s): arc(p, len(supply) + s, supply[p] * repeats) for p, own in enumerate(members) for s in own}
    for s, quota in enumerate(quotas):
        arc(len(supply) + s, end, quota)

    def augment() -> int:
        """One blocking flow along shortest paths: words sent, 0 if there is no path."""
        level = {start: 0}
        waiting = deque([start])
        while waiting:
            a = waiting.popleft()
            for e in arcs[a]:
                if room[e] and head[e] not in level:
                    level[head[e]] = level[a] + 1
                    waiting.append(head[e])
        if end not in level:
            return 0
        sent, turn, path = 0, [0] * len(arcs), []
        a = start
        while True:
            if a == end:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                sent += least
                cut = next(i for i, e in enumerate(path) if not room[e])
                a, path = head[path[cut] ^ 1], path[:cut]
            while turn[a] < len(arcs[a]):
                e = arcs[a][turn[a]]
                if room[e] and level.get(head[e]) == level[a] + 1:
                    break
                turn[a] += 1
            if turn[a] < len(arcs[a]):
                path.append(arcs[a][turn[a]])
                a = head[path[-1]]
            elif a == start:
                return sent
            else:
                a = head[path.pop() ^ 1]
                turn[a] += 1

    cost = 0
    for repetition in range(repeats):
        for p, words in enumerate(supply):
            room[into[p]] += words
        while sent := augment():
            cost += repetition * sent
    return {place: room[e ^ 1] for place, e in across.items()}, cost


def _number(pattern: str, numbers: dict[str, int], rows: DataFrame) -> DataFrame:
    table = rows.sparkSession.createDataFrame(list(numbers.items()), f"{pattern} string, _pattern long")
    return rows.join(F.broadcast(table), pattern)  # a row for each pattern


def mix(
    docs: DataFrame, key: str, sources: Column, size: Column, targets: Callable[[dict[Source, int]], dict[Source, float]], keep: list[str] | None = None,
    repeats: int = REPEATS, seed: int = SEED,
) -> Mixture:
    """Take documents, up to `repeats` times each, so that every source gets its target of words.

    `sources`: array of the names a document belongs to; `size`: its words; `targets`: from the sizes of all
    sources to the words wanted of each; `keep`: the columns that come back in `row`.
    """
    spark = docs.sparkSession
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), quoted(key).cast("string")).cast("binary"))
    rows = stored(
        docs.select(
            F.struct(*[quoted(c) for c in (keep or docs.columns)]).alias("row"), F.array_sort(F.array_distinct(sources)).alias("sources"),
            size.cast("long").alias("size"), F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("draw"), F.monotonically_increasing_id().alias("nth"),
        ).withColumn("pattern", F.to_json(F.struct("sources")))
    )
    patterns = rows.groupBy("pattern").agg(F.first("sources").alias("sources"), F.sum("size").alias("size")).limit(MAX_ARCS + 1).collect()
    if sum(max(1, len(p["sources"] or [])) for p in patterns) > MAX_ARCS:
        raise ValueError(f"the network of sources has more than {MAX_ARCS} arcs")
    patterns.sort(key=lambda p: p["pattern"])
    names = in_order({s for p in patterns for s in p["sources"] or []})
    sizes = {s: 0 for s in names}
    for p in patterns:
        for s in p["sources"] or []:
            sizes[s] += p["size"]
    wanted = targets(sizes)
    index = {s: i for i, s in enumerate(names)}
    members = [[index[s] for s in in_order(p["sources"] or [])] for p in patterns]
    supply = [p["size"] for p in patterns]
    flow, cost = route(supply, members, [int(wanted[s] + 0.5) for s in names], repeats)

    flows = {place: words for place, words in flow.items() if words}
    most = {p: -(-sum(w for (q, _), w in flows.items() if q == p) // supply[p]) for p in {p for p, _ in flows}}
    numbered = _number("pattern", {p["pattern"]: i for i, p in enumerate(patterns)}, rows)
    nobody = F.array().cast("array<struct<source:string,copies:int>>")
    placed = numbered.withColumns({"by_source": nobody, "copies": F.lit(0)})
    gaps, universe, rounds = dict(flows), numbered, dict(enumerate(supply))
    for turn in range(PASSES):
        open_gaps = {place: gap for place, gap in gaps.items() if not turn or gap * CLOSE > flows[place]}
        if not open_gaps:
            break
        limits = {p: max(g for (q, _), g in open_gaps.items() if q == p) for p in {p for p, _ in open_gaps}}
        if turn:  # once more over the documents left that are short enough
            rounds = dict.fromkeys(limits, ENDLESS)
            table = F.broadcast(spark.createDataFrame([(p, limits[p], most[p]) for p in limits], "_pattern long, _limit long, _most int"))
            placed = placed.drop("_limit", "_most").join(table, "_pattern", "left")
            universe = placed.filter(_free())
        pieces, got = _pieces(universe, open_gaps, rounds, names)
        for place, words in got.items():
            gaps[place] -= words
        placed = _with_pieces(placed, pieces, _free() if turn else F.col("size") > 0)

    # what is left of the gaps: of each power of two the smallest documents left
    table = F.broadcast(spark.createDataFrame([(p, most[p]) for p in most], "_pattern long, _most int"))
    free = placed.drop("_limit", "_most").join(table, "_pattern").filter((F.col("size") > 0) & (F.col("copies") < F.col("_most")))
    offered: dict[int, list] = {}
    for r in _smallest(free, ["_pattern"]):
        offered.setdefault(r["_pattern"], []).append((r["size"], r["nth"]))
    changes: dict[int, list[tuple[Source, int]]] = {}
    for (p, s), gap in sorted(gaps.items(), key=lambda g: (-g[1], g[0])):
        for words, nth in list(offered.get(p, [])):  # the long ones first
            if words <= gap:
                offered[p].remove((words, nth))
                gap -= words
                changes.setdefault(nth, []).append((names[s], 1))
        gaps[p, s] = gap

    # what no document left is short enough for, in small patterns: one more, and some of the taken ones less
    missed = {place: gap for place, gap in gaps.items() if gap and offered.get(place[0])}
    held = placed.filter(F.col("_pattern").isin(sorted({p for p, _ in missed})) & (F.col("size") > 0)).withColumn("own", F.explode(F.array_distinct("by_source.source")))
    droppable: dict[tuple[int, Source], list] = {}
    for r in _smallest(held, ["_pattern", "own"]) if missed else []:
        droppable.setdefault((r["_pattern"], r["own"]), []).append((r["size"], r["nth"]))
    for (p, s), gap in sorted(missed.items()):
        best = (gap, 0, 0, [])
        for words, nth in sorted(offered[p], key=lambda d: d[0]):
            over, given = words - gap, []
            for less, other in droppable.get((p, names[s]), []):
                if less <= over:
                    over -= less
                    given.append(other)
            best = min(best, (over, words, nth, given), key=lambda b: b[0])
        if best[1]:
            offered[p].remove((best[1], best[2]))
            for nth, count in [(best[2], 1), *[(other, -1) for other in best[3]]]:
                changes.setdefault(nth, []).append((names[s], count))
            gaps[p, s] = -best[0]

    table = F.broadcast(spark.createDataFrame(list(changes.items()), "nth long, changes array<struct<source:string,copies:int>>"))  # a few for each gap
    both = placed.join(table, "nth", "left").withColumn("both", F.concat("by_source", F.coalesce("changes", nobody)))
    result = both.withColumn("by_source", F.filter(F.transform(F.array_distinct("both.source"), _summed), lambda c: c["copies"] > 0))
    result = result.withColumn("copies", F.aggregate("by_source", F.lit(0), lambda n, c: n + c["copies"]))
    taken = {s: 0 for s in names}
    for (p, s), words in flows.items():
        taken[names[s]] += words - gaps[p, s]
    return Mixture(result.select("row", "size", "sources", "by_source", "copies", (F.col("copies") * F.col("size")).alias("taken")), sizes, wanted, taken, cost)


def _free() -> Column:
    return (F.col("size") > 0) & (F.col("size") <= F.col("_limit")) & (F.col("copies") < F.col("_most"))


def _summed(source: Column) -> Column:
    own = F.filter("both", lambda b: b["source"].eqNullSafe(source))
    return F.struct(source.alias("source"), F.aggregate(own, F.lit(0), lambda n, b: n + b["copies"]).alias("copies"))


def _smallest(rows: DataFrame, group: list[str]) -> list:
    """The `OFFERED` smallest documents of each group and power of two, the greatest powers first."""
    order = Window.partitionBy(*group, "band").orderBy("size", "draw", "nth")
    banded = rows.select(*group, "size", "draw", "nth", F.floor(F.log2("size")).alias("band")).withColumn("place", F.row_number().over(order))
    return sorted(banded.filter(F.col("place") <= OFFERED).collect(), key=lambda r: (-r["band"], r["size"], r["draw"], r["nth"]))


def _pieces(universe: DataFrame, words: dict[tuple[int, int], int], rounds: dict[int, int], names: list[Source]) -> tuple[dict[int, list[tuple]], dict]:
    """Consecutive pieces, of `words` each at most, of the order of every pattern, which starts again after `rounds` words.

    A piece is (source, whole repetitions, the row it starts at, whether that row is out, the row it ends before).
    """
    ends: list[tuple[int, int, int, int]] = []
    at: dict[int, int] = {}
    for (p, s), own in words.items():
        ends.append((p, s, at.get(p, 0), at.get(p, 0) + own))
        at[p] = at.get(p, 0) + own
    offsets = sorted({(p, x % rounds[p]) for p, _, a, z in ends for x in (a, z) if x % rounds[p]})
    cuts = dict(zip(offsets, cut_points(universe, ORDER, offsets, weight="size", group="_pattern")))

    def place(p: int, x: int) -> tuple[int, tuple, bool, int, int]:
        """Repetition, row, whether it lies across, words before it and words up to its end."""
        if not x % rounds[p]:
            return x // rounds[p], (-1, -1, -1), False, x, x
        cut = cuts[p, x % rounds[p]]
        base = x - x % rounds[p] + cut.before
        if cut.at is None:  # all of it fits
            return x // rounds[p], (ENDLESS, ENDLESS, ENDLESS), False, base, base
        across = cut.before < x % rounds[p]
        return x // rounds[p], cut.at, across, base, base + cut.at[1] * across

    pieces: dict[int, list[tuple]] = {}
    got = {}
    for p, s, a, z in ends:
        left, right = place(p, a), place(p, z)
        if left[:2] != right[:2]:  # else within one document
            got[p, s] = right[3] - left[4]
            pieces.setdefault(p, []).append((names[s], right[0] - left[0], *left[1], left[2], *right[1]))
    return pieces, got


def _with_pieces(placed: DataFrame, pieces: dict[int, list[tuple]], of: Column) -> DataFrame:
    """`by_source` and `copies` with what the pieces give to the rows for which `of` holds."""
    kind = "array<struct<source:string,full:int,a0:long,a1:long,a2:long,across:boolean,z0:long,z1:long,z2:long>>"
    table = F.broadcast(placed.sparkSession.createDataFrame(list(pieces.items()), f"_pattern long, _pieces {kind}"))  # a row for each pattern
    own = [F.col(c) for c in ORDER]

    def copies(i: Column) -> Column:
        first, last = [i["a0"], i["a1"], i["a2"]], [i["z0"], i["z1"], i["z2"]]
        at_first = (own[0] == first[0]) & (own[1] == first[1]) & (own[2] == first[2])
        out = is_before(own, first) | (i["across"] & at_first)
        return F.struct(i["source"].alias("source"), (i["full"] + is_before(own, last).cast("int") - out.cast("int")).alias("copies"))

    given = F.filter(F.transform("_pieces", copies), lambda c: c["copies"] > 0)
    joined = placed.join(table, "_pattern", "left").withColumn("_given", F.when(of & F.col("_pieces").isNotNull(), given))
    more = F.aggregate(F.coalesce("_given", F.array().cast("array<struct<source:string,copies:int>>")), F.lit(0), lambda n, c: n + c["copies"])
    by_source = F.when(F.col("_given").isNull(), F.col("by_source")).otherwise(F.concat("by_source", "_given"))
    return joined.withColumns({"by_source": by_source, "copies": F.col("copies") + more}).drop("_pieces", "_given")


def mixed_documents(docs: DataFrame, mixture: Mixture, key: str) -> DataFrame:
    """`docs` with every document as often as the mixture takes it; `key` is unique and was kept."""
    times = mixture.rows.filter("copies > 0").select(F.col("row").getField(key).alias("_key"), F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"))
    return docs.join(times, quoted(key) == F.col("_key")).select(*[docs[f"`{c}`"] for c in docs.columns])


def contract_targets(sizes: dict[Source, int]) -> dict[Source, float]:
    """Weights 3, 1, 2, repeating; 150 percent of all words; at most twice a source."""
    weights = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(in_order(sizes))}
    return weighted_targets(sizes, weights, SHARE * sum(sizes.values()), float(REPEATS))


def mixture_digests(docs: DataFrame) -> DataFrame:
    """Per document: id, words, words of its source, its source's target, words taken."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0))
    found = mix(docs, "doc_id", F.array("source"), words, contract_targets, keep=["doc_id", "source"])
    table = [(s, found.source_sizes[s], found.targets[s]) for s in found.source_sizes]
    known = F.broadcast(docs.sparkSession.createDataFrame(table, "name string, source_size long, target double"))  # a row for each source
    rows = found.rows.select("row.doc_id", "row.source", "size", "taken")
    return rows.join(known, F.col("source").eqNullSafe(F.col("name"))).select("doc_id", "size", "source_size", "target", "taken", "source")
