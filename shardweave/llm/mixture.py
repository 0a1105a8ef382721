"""Mixing sources to target weights by min-cost flow (problem 2).

The items are aggregated by membership pattern (the set of target sources they belong to).  A small flow
network routes pattern sizes to source quotas; each further pass over a pattern costs more than the one
before (convex), so repetition is spread and used last.  The flow then becomes intervals on a seeded
order of each pattern's items, found by a two-level prefix sum without any global sort.
"""

from __future__ import annotations

from collections import Counter, deque
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import materialize

#: Buckets of the seeded order; a window never holds more than one bucket of one pattern.
BUCKETS = 1024
#: Most membership patterns, which the driver plans with and which are broadcast; more are an error, never a cut.
PATTERNS = 20_000
SEPARATOR = "\x1f"


@dataclass
class Flow:
    """Primal-dual min-cost flow on a small network; the cost of an arc is a whole number.

    Each round finds the cheapest distances and then fills all cheapest paths at once (breadth first, then a
    blocking flow), so the rounds are as many as there are different path costs and lengths, not paths.
    """

    arcs: list[list[int]] = field(default_factory=list)  # to, capacity left, cost; arc i ^ 1 is its reverse
    out: dict[object, list[int]] = field(default_factory=dict)

    def arc(self, a: object, b: object, capacity: int, cost: int) -> int:
        self.out.setdefault(a, []).append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out.setdefault(b, []).append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def _distances(self, source: object) -> dict[object, int]:
        dist, queue, queued = {source: 0}, deque([source]), {source}
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for i in self.out.get(a, ()):
                b, left, cost = self.arcs[i]
                if left > 0 and dist[a] + cost < dist.get(b, 1 << 60):
                    dist[b] = dist[a] + cost
                    if b not in queued:
                        queued.add(b)
                        queue.append(b)
        return dist

    def _hops(self, source: object, dist: dict[object, int]) -> dict[object, int]:
        """Steps from the source along arcs of cheapest paths."""
        hops, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for i in self.out.get(a, ()):
                b, left, cost = self.arcs[i]
                if left > 0 and b not in hops and dist[b] == dist[a] + cost:
                    hops[b] = hops[a] + 1
                    queue.append(b)
        return hops

    def _fill(self, a: object, sink: object, amount: int, dist: dict, hops: dict, at: dict) -> int:
        if a == sink:
            return amount
        arcs, sent = self.out.get(a, ()), 0
        while at.get(a, 0) < len(arcs) and sent < amount:
            i = arcs[at.get(a, 0)]
            b, left, cost = self.arcs[i]
            if left > 0 and hops.get(b, -1) == hops[a] + 1 and dist[b] == dist[a] + cost:
                push = self._fill(b, sink, min(left, amount - sent), dist, hops, at)
                self.arcs[i][1] -= push
                self.arcs[i ^ 1][1] += push
                sent += push
                if sent == amount:
                    break
            at[a] = at.get(a, 0) + 1
        return sent

    def run(self, source: object, sink: object) -> int:
        total = 0
        while True:
            dist = self._distances(source)
            if sink not in dist:
                return total
            while sink in (hops := self._hops(source, dist)):
                total += self._fill(source, sink, 1 << 62, dist, hops, {})

    def reached(self, source: object) -> set:
        """Nodes on the source's side of a smallest cut, once the flow is full."""
        return set(self._distances(source))


def route(sizes: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: dict[str, int]) -> tuple[dict[tuple, int], set[str]]:
    """({(pattern, source): amount}, sources that are short together) at least total repetition cost.

    The set is empty if every quota is met; else it is a set of sources whose joint quota exceeds what their
    patterns can give (a smallest cut).
    """
    net, used = Flow(), {}
    for p, size in sizes.items():
        for k in range(max(repeats[s] for s in p)):
            net.arc("from", ("p", p), size, k)
        for s in p:
            used[p, s] = net.arc(("p", p), ("s", s), size * repeats[s], 0)
    for s, q in quotas.items():
        net.arc(("s", s), "to", q, 0)
    full = net.run("from", "to") == sum(quotas.values())
    short = set() if full else set(quotas) - {n[1] for n in net.reached("from") if n[0] == "s"}
    return {k: net.arcs[i ^ 1][1] for k, i in used.items() if net.arcs[i ^ 1][1]}, short


def _most(sources: set[str], share: dict[str, float], sizes: dict[tuple[str, ...], int], repeats: dict[str, int], high: int) -> int:
    """Largest total at most ``high`` at which the quotas of ``sources`` do not exceed all that their patterns can give."""
    room = sum(n * min(max(repeats[s] for s in p), sum(repeats[s] for s in p if s in sources)) for p, n in sizes.items())
    low = 0
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if sum(_quota(mid, share[s]) for s in sources) <= room else (low, mid - 1)
    return low


def _quota(total: int, share: float) -> int:
    return int(total * share + 1e-9)


def plan_mix(sizes: dict[tuple[str, ...], int], shares: dict[str, float], repeats: dict[str, int], total: int | None = None) -> tuple[dict[tuple, int], dict[str, int]]:
    """(flow, quotas) of the largest mix, at most ``total``, in which every available source meets its share.

    Sources without any sample cannot contribute; the shares of the others keep their proportions.  Patterns that
    are equal once such sources are left out count together; the flow names the patterns without them.  The total
    is found by cuts: while some sources are short, it falls to the most that their patterns can give, which
    takes at most as many flows as there are sets of sources and in practice a few.
    """
    there = {s for p, n in sizes.items() if n for s in p if shares.get(s, 0) > 0 and repeats.get(s, 0) > 0}
    if not there:
        return {}, {}
    whole = sum(shares[s] for s in there)
    share = {s: shares[s] / whole for s in sorted(there)}
    usable: dict[tuple[str, ...], int] = {}
    for p, n in sizes.items():
        if n and (q := tuple(s for s in p if s in there)):
            usable[q] = usable.get(q, 0) + n
    high = sum(n * max(repeats[s] for s in p) for p, n in usable.items()) + len(share)
    high = high if total is None else min(high, total)
    while True:
        quotas = {s: _quota(high, x) for s, x in share.items()}
        flow, short = route(usable, quotas, repeats)
        if not short:
            return flow, quotas
        high = _most(short, share, usable, repeats, high - 1)


def canonical_url(c: Column) -> Column:
    """One spelling per shard: trimmed, s3a as s3, single slashes, the source (the part after pack/) in lower case."""
    u = F.regexp_replace(F.trim(c), r"(?i)^s3[an]://", "s3://")
    u = F.regexp_replace(u, r"(?<!:)/{2,}", "/")
    cut = lambda i: F.regexp_extract(u, r"^(.*?/?)pack/([^/]+)/(.*)$", i)
    return F.when(F.length(cut(2)) > 0, F.concat(cut(1), F.lit("pack/"), F.lower(cut(2)), F.lit("/"), cut(3))).otherwise(u)


def shard_items(index: DataFrame, url: str = "url", n: str = "nsamples", at: str = "indexed_at") -> DataFrame:
    """(item, source, size): each shard once with its latest known count; shards without samples are left out."""
    rows = index.select(canonical_url(F.col(url)).alias("item"), F.col(n).cast("bigint").alias("n"), F.col(at).alias("at")).filter("item is not null and n is not null")
    last = rows.groupBy("item").agg(F.max(F.struct("at", "n")).alias("r")).select("item", F.col("r.n").alias("size"))
    return last.filter("size > 0").select("item", F.lower(F.regexp_extract("item", r"pack/([^/]+)/", 1)).alias("source"), "size")


@dataclass(frozen=True)
class Mix:
    drawn: DataFrame
    report: DataFrame


def draw_mix(members: DataFrame, targets: DataFrame, total: int | None = None, seed: int = 17) -> Mix:
    """Draw the largest mix (at most ``total``) whose sources have their target shares.

    ``members``: (item, source, size), one row per item and source it belongs to; ``targets``: (source,
    target_share, max_repeats), a small table with one row per source.  Items of no target source are not
    drawn.  The driver sees one number per membership pattern, at most PATTERNS; more raise an error.

    ``drawn``: (source, item, size, passes, n_drawn): an item drawn from n_drawn times its samples, at most
    ``passes`` passes over it; the last pass of the item at the edge of an interval may be partial.
    ``report``: (source, target_share, max_repeats, n_available, n_drawn, repeats, actual_share), every target
    source once; a source without samples has 0.  An item of several sources counts as available in each; a
    source with share or max_repeats 0 is reported, and its items are drawn for their other sources only.
    Rows with a null item count as one item; rows with a null source or size are left out.
    """
    spark = members.sparkSession
    rows = targets.groupBy(F.lower(F.trim("source")).alias("source")).agg(F.sum("target_share").alias("share"), F.max("max_repeats").alias("reps")).filter("source is not null").collect()
    shares, repeats = {r["source"]: r["share"] or 0.0 for r in rows}, {r["source"]: int(r["reps"] or 0) for r in rows}
    usable = [s for s in shares if shares[s] > 0 and repeats[s] > 0]
    wanted = members.filter(F.col("source").isin(list(shares)) & (F.col("size") > 0))
    grouped = wanted.groupBy("item").agg(F.array_sort(F.collect_set("source")).alias("every"), F.max("size").alias("size"))
    names = F.array_join("every", SEPARATOR), F.array_join(F.filter("every", lambda s: s.isin(usable)), SEPARATOR)
    order = F.xxhash64(F.lit(seed), "item")
    items = materialize(grouped.select("item", "size", names[0].alias("every"), names[1].alias("pattern"), order.alias("h"), F.pmod(F.shiftright(order, 20), F.lit(BUCKETS)).cast("int").alias("bucket")), "items")
    patterns = items.groupBy("every", "pattern").agg(F.sum("size").alias("n")).limit(PATTERNS + 1).collect()
    if len(patterns) > PATTERNS:
        raise ValueError(f"the sources overlap in more than {PATTERNS} ways; leave out sources or raise PATTERNS")
    sizes, available = Counter(), Counter()
    for r in patterns:
        for s in r["every"].split(SEPARATOR):
            available[s] += r["n"]
        if r["pattern"]:
            sizes[tuple(r["pattern"].split(SEPARATOR))] += r["n"]
    flow, _ = plan_mix(sizes, shares, repeats, total)

    live = items.filter("pattern <> ''")
    buckets = live.groupBy("pattern", "bucket").agg(F.sum("size").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("pattern").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    bases = buckets.select("pattern", "bucket", before.alias("base"))
    inside = F.sum("size").over(W.partitionBy("pattern", "bucket").orderBy("h", "item").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size")
    placed = live.withColumn("inside", inside).join(bases, ["pattern", "bucket"]).withColumn("lo", F.col("base") + F.col("inside"))

    start: dict[tuple, int] = {}
    arcs = []
    for (p, s), amount in sorted(flow.items()):
        arcs.append((SEPARATOR.join(p), s, amount, start.get(p, 0) % sizes[p], sizes[p]))
        start[p] = start.get(p, 0) + amount
    plan = spark.createDataFrame(arcs, "pattern string, source string, amount bigint, first bigint, circle bigint")
    amount, first, circle = F.col("amount"), F.col("first"), F.col("circle")
    passes, rest = F.floor(amount / circle), amount % circle

    def covered(y: Column) -> Column:
        """Samples of [0, y) that the interval of the last, partial round covers, its end wrapping around."""
        return F.greatest(F.lit(0), F.least(y, first + rest) - first) + F.greatest(F.lit(0), F.least(y, first + rest - circle))

    lo, hi = F.col("lo"), F.col("lo") + F.col("size")
    taken = passes * F.col("size") + covered(hi) - covered(lo)
    # at most PATTERNS x sources rows
    drawn = placed.join(F.broadcast(plan), "pattern").withColumn("n_drawn", taken.cast("bigint")).filter("n_drawn > 0")
    drawn = drawn.select("source", "item", "size", F.ceil(F.col("n_drawn") / F.col("size")).cast("int").alias("passes"), "n_drawn")

    got = {s: sum(v for (_, t), v in flow.items() if t == s) for s in shares}
    whole = sum(got.values())
    lines = [(s, shares[s], repeats[s], available[s], got[s], round(got[s] / available[s], 6) if available[s] else 0.0, round(got[s] / whole, 6) if whole else 0.0) for s in sorted(shares)]
    report = spark.createDataFrame(lines, "source string, target_share double, max_repeats int, n_available bigint, n_drawn bigint, repeats double, actual_share double")
    return Mix(drawn, report)
