"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are aggregated by membership pattern; each pattern offers its words
once for every allowed repetition, at a cost that rises with the repetition (convex), to the sources it belongs
to; the sources ask for their targets. The flow of least cost says how many words of which repetition of which
pattern serve which source, so repeats are used only where fresh words cannot fill a quota. Documents are then
selected in a seeded order: a bucket of that order lies wholly inside a share of the flow, or a share ends in it
and its documents are placed one by one. Only the pattern sums reach the driver; no order is computed over a whole
source, however large one source is.
"""

from __future__ import annotations

import bisect
import heapq

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.llm.common import NOT_SPACE_CLASS, materialise

# Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
DOCS_PER_BUCKET = 1000
MAX_PATTERNS = 100_000


def share_targets(sizes: list[int], weights: list[float], budget: float, ceiling: float) -> list[float]:
    """Split ``budget`` by weight; what exceeds ``ceiling`` times a size is shared again until none is above.

    The outcome is min(cap, level * weight) with one level for all, found by visiting sources from the one whose
    cap is reached first.
    """
    caps = [ceiling * s for s in sizes]
    left, weight = float(budget), float(sum(weights))
    targets = [0.0] * len(sizes)
    by_level = sorted(range(len(sizes)), key=lambda i: (caps[i] / weights[i], i))
    for at, i in enumerate(by_level):
        if caps[i] * weight > left * weights[i]:
            for j in by_level[at:]:
                targets[j] = left / weight * weights[j]
            break
        targets[i] = float(caps[i])
        left, weight = left - caps[i], weight - weights[i]
    return targets


def min_cost_flow(n: int, edges: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each edge (from, to, capacity, cost) of a maximal flow of least cost; successive shortest paths."""
    graph: list[list[int]] = [[] for _ in range(n)]
    to, room, cost = [], [], []
    for a, b, capacity, price in edges:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            graph[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(p)
    potential = [0] * n
    while True:
        dist = [None] * n
        via = [-1] * n
        dist[source] = 0
        heap = [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in graph[u]:
                v = to[e]
                if room[e] > 0:
                    nd = d + cost[e] + potential[u] - potential[v]
                    if dist[v] is None or nd < dist[v]:
                        dist[v], via[v] = nd, e
                        heapq.heappush(heap, (nd, v))
        if dist[sink] is None:
            return [room[2 * i + 1] for i in range(len(edges))]
        reached = max(d for d in dist if d is not None)
        potential = [p + (d if d is not None else reached) for p, d in zip(potential, dist)]
        push, v = None, sink
        while v != source:
            push = room[via[v]] if push is None else min(push, room[via[v]])
            v = to[via[v] ^ 1]
        v = sink
        while v != source:
            room[via[v]] -= push
            room[via[v] ^ 1] += push
            v = to[via[v] ^ 1]


def route(patterns: list[tuple[list, int]], targets: dict, repeats: int) -> list[tuple[int, int, object, int]]:
    """(pattern position, repetition, source, words) of the least-cost flow from patterns to source targets."""
    names = list(targets)
    place = {s: 2 + i for i, s in enumerate(names)}
    first = 2 + len(names)
    edges, meaning = [], []
    for p, (members, size) in enumerate(patterns):
        for r in range(repeats):
            node = first + p * repeats + r
            edges.append((0, node, size, r * r))  # the marginal cost of a repetition rises
            meaning.append(None)
            for s in members:
                if s in place:
                    edges.append((node, place[s], size, 0))
                    meaning.append((p, r, s))
    for s in names:
        edges.append((place[s], 1, round(targets[s]), 0))
        meaning.append(None)
    flow = min_cost_flow(first + len(patterns) * repeats, edges, 0, 1)
    return [(*m, f) for m, f in zip(meaning, flow) if m is not None and f > 0]


def _fill(sizes: list[int], chosen: list, room: list[list], steps: int = 8) -> None:
    """Bring each share's words nearer to its room: take one more document, or one in place of another."""
    for share in room:
        for _ in range(steps):
            free = sorted((sizes[j], j) for j, c in enumerate(chosen) if c is None and sizes[j])
            mine = [(0, None), *((sizes[i], i) for i, c in enumerate(chosen) if c == share[0])]
            best = (abs(share[1]), None, None, 0)
            for size, i in mine:
                # The free document that comes nearest to what is missing once ``i`` goes.
                at = bisect.bisect_left(free, (share[1] + size, -1))
                for gain, j in free[max(0, at - 1):at + 1]:
                    if abs(share[1] + size - gain) < best[0]:
                        best = (abs(share[1] + size - gain), i, j, gain - size)
            if best[2] is None:
                break
            if best[1] is not None:
                chosen[best[1]] = None
            chosen[best[2]] = share[0]
            share[1] -= best[3]


def _place(table: pa.Table) -> pa.Table:
    """Documents of one bucket, in seeded order, to the shares that reach into it: first fit, then nearest."""
    table = table.take(pc.sort_indices(table, sort_keys=[("order", "ascending"), ("row_hash", "ascending")]))
    room = [list(x) for x in zip(table["shares"][0].as_py(), table["rooms"][0].as_py())]
    chosen: list = [None] * table.num_rows
    rest = []
    for i, size in enumerate(table["size"].to_pylist()):
        for share in room:
            if size <= share[1]:
                chosen[i], share[1] = share[0], share[1] - size
                break
        else:
            rest.append((i, size))
    for i, size in rest:
        share = max(room, key=lambda x: x[1])
        if 2 * share[1] > size:
            chosen[i], share[1] = share[0], share[1] - size
    _fill(table["size"].to_pylist(), chosen, room)
    return table.drop_columns(["shares", "rooms", "order", "bucket"]).append_column("given", pa.array(chosen, pa.int32()))


def select_documents(rows: DataFrame, shares: DataFrame, repetition: int, n_buckets: Column, seed: int) -> DataFrame:
    """Adds ``given_<repetition>``: the share (its number) that takes the document in this repetition, or null.

    ``rows`` has pattern, row_hash, size; ``shares`` has pattern, share, lo, hi, the part of the pattern's
    seeded order that belongs to the share.
    """
    order = F.xxhash64(F.lit(seed), F.lit(repetition), "row_hash")
    rows = rows.withColumn("order", order).withColumn("bucket", F.pmod(F.col("order"), n_buckets))
    sums = rows.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
    span = W.partitionBy("pattern").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    spans = sums.withColumn("end", F.sum("words").over(span)).withColumn("begin", F.col("end") - F.col("words"))
    cut = F.least("end", "hi") - F.greatest("begin", "lo")
    rooms = (spans.join(shares, "pattern").withColumn("room", cut).where("room > 0")
             .groupBy("pattern", "bucket")
             .agg(F.sort_array(F.collect_list(F.struct("share", "room"))).alias("s"))
             .select("pattern", "bucket", F.col("s.share").alias("shares"), F.col("s.room").alias("rooms")))
    kept = [f for f in rows.schema.fields if f.name not in ("order", "bucket")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", given int"
    named = f"given_{repetition}"
    joined = rows.join(rooms, ["pattern", "bucket"], "left")
    placed = joined.where("rooms is not null").groupBy("pattern", "bucket").applyInArrow(_place, schema)
    unused = joined.where("rooms is null").select(*[f.name for f in kept], F.lit(None).cast("int").alias("given"))
    return placed.unionByName(unused).withColumnRenamed("given", named)


def mix(rows: DataFrame, targets: dict, repeats: int = 2, seed: int = 7,
        patterns: list[tuple[str, list, int, int]] | None = None) -> DataFrame:
    """Adds ``copies`` (how often the mix takes the document) and ``served`` (the sources it was taken for).

    ``rows`` has doc_id, size (words, not negative) and sources (array of the sources it belongs to; a null
    element is a source of its own); ``targets`` gives words wanted by source. ``patterns`` may hand over
    ``pattern_sums(rows)`` where the caller has them. No document is taken more than ``repeats`` times, and a source
    whose patterns cannot fill its target gets all they have. The same rows and seed give the same mix, however they are
    partitioned. Documents without words are never taken; rows that repeat an id are documents of their own, and rows
    that agree in all columns are interchangeable and lie in one bucket; an empty table gives
    an empty result.
    """
    spark = rows.sparkSession
    sums = pattern_sums(rows) if patterns is None else patterns
    flows = route([(members, size) for _, members, size, _ in sums], targets, repeats)
    names = list(targets)
    number = {s: i for i, s in enumerate(names)}
    # A row's place in the seeded order follows from all its columns, so rows that repeat an id and a size keep theirs in a rerun.
    own = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])))
    rows = rows.withColumn("pattern", pattern_key(F.col("sources"))).withColumn("row_hash", own)
    counts = spark.createDataFrame([(p, max(1, -(-n // DOCS_PER_BUCKET))) for p, _, _, n in sums] or [("", 1)],
                                   "pattern string, n_buckets long")
    rows = rows.join(F.broadcast(counts), "pattern")  # at most MAX_PATTERNS rows, checked in pattern_sums
    for r in range(repeats):
        shares, at = [], {}
        for p, rep, source, words in flows:
            if rep == r:
                lo = at.get(p, 0)
                shares.append((sums[p][0], number[source], lo, lo + words))
                at[p] = lo + words
        part = spark.createDataFrame(shares or [("", 0, 0, 0)], "pattern string, share int, lo long, hi long")
        rows = select_documents(rows, F.broadcast(part), r, F.col("n_buckets"), seed)
    given = [F.col(f"given_{r}") for r in range(repeats)]
    copies = sum((F.when(g.isNotNull() & (F.col("size") > 0), 1).otherwise(0) for g in given), F.lit(0))
    served = F.filter(F.array(*given), lambda g: g.isNotNull())
    return (rows.withColumn("copies", copies)
            .withColumn("served", F.transform(served, lambda g: F.get(F.array(*[F.lit(s).cast("string") for s in names]), g)))
            .drop("pattern", "row_hash", "n_buckets", *[f"given_{r}" for r in range(repeats)]))


def pattern_key(sources: Column) -> Column:
    """The membership pattern as text; a null source has a name that no other source can have."""
    return F.to_json(F.transform(F.array_sort(F.array_distinct(sources)), lambda s: F.struct(s.alias("s"))))


def pattern_sums(rows: DataFrame) -> list[tuple[str, list, int, int]]:
    """(pattern, its sources, words, documents), the only figures of the corpus that reach the driver."""
    sums = (rows.groupBy(pattern_key(F.col("sources")).alias("pattern"))
            .agg(F.first("sources").alias("sources"), F.sum("size").alias("words"), F.count("*").alias("n"))
            .orderBy("pattern").limit(MAX_PATTERNS + 1).collect())
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; group the sources first")
    return [(r["pattern"], sorted(set(r["sources"]), key=lambda s: (s is None, s or "")), r["words"], r["n"]) for r in sums]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE_CLASS + "+")), F.lit(0)).cast("long")


def source_targets(sums: list[tuple[str, list, int, int]], share: float = 1.5, ceiling: float = 2.0) -> dict:
    """Source -> (words, target) where each document has one source: weights by name order, null last."""
    by_source = sorted(((members[0], size) for _, members, size, _ in sums),
                       key=lambda x: (x[0] is None, (x[0] or "").encode("utf-8")))
    sizes = [s for _, s in by_source]
    weights = [float(WEIGHTS[i % len(WEIGHTS)]) for i in range(len(sizes))]
    targets = share_targets(sizes, weights, share * sum(sizes), ceiling)
    return {name: (size, target) for (name, size), target in zip(by_source, targets)}


def mix_sources(docs: DataFrame, seed: int = 7) -> DataFrame:
    """All rows of ``docs`` mixed to the targets of ``source_targets``: doc_id, source, size, source_size, target,
    copies, and two keys of the row.

    Reads ``doc_id``, ``source`` and ``text``; other columns are ignored. A null source is one source, a null text
    has no words.
    """
    # Word counts are needed twice (sums first, then the selection): lean rows, written once.
    rows = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                                   F.array("source").alias("sources"), *_row_keys(docs)))
    sums = pattern_sums(rows)
    plan = source_targets(sums)
    mixed = mix(rows, {s: t for s, (_, t) in plan.items()}, seed=seed, patterns=sums)
    names = docs.sparkSession.createDataFrame([(s, z, t) for s, (z, t) in plan.items()] or [("", 0, 0.0)],
                                              "source string, source_size long, target double")
    known = names.withColumnRenamed("source", "name")  # at most MAX_PATTERNS rows
    return mixed.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("name"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", "row_key", "row_key2")


def _row_keys(docs: DataFrame) -> list[Column]:
    """Two hashes over all columns; rows that agree in them are the same."""
    columns = [F.col(f"`{c}`") for c in sorted(docs.columns)]
    nulls = F.array(*[c.isNull() for c in columns])  # a hash passes over a NULL, so its place must count
    return [F.xxhash64(*columns, nulls).alias("row_key"), F.xxhash64(nulls, *columns).alias("row_key2")]


def mixed_documents(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as the mix takes it."""
    copies = mix_sources(docs, seed).groupBy("row_key", "row_key2").agg(F.sum("copies").cast("int").alias("copies"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *_row_keys(docs))
    taken = row.join(copies.where("copies > 0"), ["row_key", "row_key2"]).dropDuplicates(["row_key", "row_key2"])
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
