"""Mixing sources to target weights by Pfair scheduling.

The rows of each source are cut into blocks of equal size. A source with ``a`` of ``T`` tickets must get one slot in
every window of its rate a/T: block i is released at floor(i * T / a) and due at ceil((i + 1) * T / a). Giving
each slot to the released block with the earliest deadline meets all deadlines, as the tickets of the active sources sum to T, and
keeps every source less than one block away from its share at any time.

The schedule repeats after T slots, so one period is laid out on the driver, from a table with a row per source, and everything
else is arithmetic on the rows. When a source is used up the others share its tickets: a new phase begins.

More sources than one period can be laid out for are held in classes of equal weight. A class holds the tickets of all its members and is
scheduled like a source; within it blocks go round the members, which is earliest deadline first where all have equal tickets. Members that are used
up are left out of later rounds. That order is a sort of the rows, so neither the sources nor their number pass through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from heapq import heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazar.operators.ranking import row_positions

# Bounds on what is planned on the driver and broadcast: at most MAX_SOURCES * TICKETS rows. More sources are planned as classes.
MAX_SOURCES = 256
TICKETS = 1024
# Power by which sources are tempered unless tickets are given.
POWER = 0.5
# Without given tickets, sizes of a class differ by less than a factor of 2 ** (1 / SIZES_PER_DOUBLING).
SIZES_PER_DOUBLING = 4
BLOCK_ROWS = 16
# Rows of a source are numbered in this many buckets per shuffle partition, so no source is one task.
BUCKETS_PER_PARTITION = 4


@dataclass(frozen=True)
class Phase:
    """From ``start`` on, block ``first[s] + p * tickets[s] + j`` of source s has slot ``start + p * period + places[s][j]``."""

    start: int
    period: int
    first: dict[str, int]
    tickets: dict[str, int]
    places: dict[str, list[int]]


def one_period(tickets: Mapping[str, int]) -> list[str]:
    """The source of each slot of a period: earliest deadline first among the released blocks.

    Ties go to the source that sorts first.
    """
    period = sum(tickets.values())
    waiting: list[list[tuple[int, str, int]]] = [[] for _ in range(period + 1)]
    for source, a in tickets.items():
        for i in range(a):
            waiting[i * period // a].append((-(-(i + 1) * period // a), source, i))
    ready: list[tuple[int, str, int]] = []
    order = []
    for slot in range(period):
        for block in waiting[slot]:
            heappush(ready, block)
        due, source, _ = heappop(ready)
        assert due > slot
        order.append(source)
    return order


def plan(blocks: Mapping[str, int], tickets: Mapping[str, int]) -> list[Phase]:
    """Phases that place every block of every source; a source without tickets comes last, alone."""
    left = {s: n for s, n in sorted(blocks.items()) if n}
    done = {s: 0 for s in left}
    phases, start = [], 0
    while left:
        active = {s: tickets.get(s, 0) for s in left}
        if not any(active.values()):
            active = dict.fromkeys(active, 1)
        active = {s: a for s, a in active.items() if a}
        order = one_period(active)
        places: dict[str, list[int]] = {s: [] for s in active}
        for slot, s in enumerate(order):
            places[s].append(slot)
        phases.append(Phase(start, len(order), {s: done[s] for s in active}, active, places))
        periods = min(left[s] // a for s, a in active.items())
        for s, a in active.items():
            done[s] += periods * a
            left[s] -= periods * a
        start += periods * len(order)
        if all(left[s] for s in active):  # the last period ends where a source runs out
            for s in order:
                done[s] += 1
                left[s] -= 1
                start += 1
                if not left[s]:
                    break
        left = {s: n for s, n in left.items() if n}
    return phases


def tempered_tickets(rows: Mapping[str, int], power: float = POWER, total: int = TICKETS) -> dict[str, int]:
    """Tickets in proportion to rows ** power: 1 keeps the natural mix, 0 makes all sources equal."""
    return _in_proportion({s: n**power for s, n in rows.items() if n}, total)


def _in_proportion(weights: Mapping[str, float], total: int = TICKETS) -> dict[str, int]:
    whole = sum(weights.values())
    return {s: max(1, round(total * w / whole)) for s, w in weights.items()}


def _held(sources: DataFrame, given: DataFrame | None) -> DataFrame:
    """Add ``__holder``, the class of a source (column __total: its rows), and ``__weight``, its own weight in it."""
    if given is None:
        at = F.floor(F.log2("__total") * SIZES_PER_DOUBLING)
        return sources.withColumn("__holder", F.format_string("%06d", at)).withColumn("__weight", F.pow(F.col("__total").cast("double"), F.lit(POWER)))
    weight = F.coalesce("__given", F.lit(0))
    return sources.join(F.broadcast(given), "__source", "left").withColumn("__weight", weight).withColumn("__holder", F.format_string("%06d", weight)).drop("__given")


def mix_sources(
    docs: DataFrame,
    tickets: Mapping[str, int] | None = None,
    source: str = "source",
    key: str = "doc_id",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``block`` (number within the source), ``slot``, ``phase`` and ``position`` (0, 1, ... over all rows), all bigint.

    ``tickets`` gives whole weights per source, by default ``tempered_tickets``. Every row gets a position: a source that is
    used up leaves its share to the others. A NULL source is a source of its own, without a name; one without tickets follows after all others. Rows of a
    source come in an order that depends on ``key`` alone; rows that repeat a key, NULL included, stand beside each other in the
    order of their other columns. An empty table stays empty. Columns called like the new ones are replaced.

    ``slot`` and ``phase`` are those of what is scheduled: a source, or, with more than ``MAX_SOURCES`` of them, a class of sources with equal tickets
    (by default, of nearly equal size). A member of a class is less than one block from its turn in the class, hence less than two from its share; the tickets of a
    used up member stay with its class. Given tickets of more than ``MAX_SOURCES * TICKETS`` in all are refused, and more than ``MAX_SOURCES`` different
    numbers of them where there are that many sources: these bound the parameter, not the data.
    """
    spark = docs.sparkSession
    added = ["block", "slot", "phase", "position"]
    kept = [c for c in docs.columns if c not in added]
    # a name of its own for NULL; names get a mark in front so it clashes with none
    named = docs.select(F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("__source"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(kept)])
    where = [kept.index(key)] if key in kept else []
    at = F.xxhash64(*[F.col(f"__c{i}") for i in where or range(len(kept))])
    buckets = BUCKETS_PER_PARTITION * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = named.withColumn("__at", at).withColumn("__bucket", F.pmod("__at", F.lit(buckets)))

    sizes = named.groupBy("__source", "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    by_source = sizes.groupBy("__source").agg(F.sum("__n").alias("__total"))
    totals = {r[0]: r[1] for r in by_source.limit(MAX_SOURCES + 1).collect()}
    weights = tempered_tickets(totals) if tickets is None else {("" if s is None else f"={s}"): a for s, a in tickets.items() if a > 0}
    if tickets is not None and sum(weights.values()) > MAX_SOURCES * TICKETS:
        raise ValueError(f"more than {MAX_SOURCES * TICKETS} tickets: divide them")
    classes, given = len(totals) > MAX_SOURCES, None
    if classes:
        if tickets is not None:
            if len(set(weights.values())) > MAX_SOURCES:
                raise ValueError(f"more than {MAX_SOURCES} different numbers of tickets: round them")
            given = spark.createDataFrame(list(weights.items()), "__source string, __given int")
        held = _held(by_source, given).groupBy("__holder").agg(F.sum("__total"), F.sum("__weight")).collect()
        totals = {r[0]: r[1] for r in held}
        weights = _in_proportion({r[0]: r[2] for r in held}) if tickets is None else {r[0]: r[2] for r in held if r[2]}
    blocks = {s: -(-n // block_rows) for s, n in totals.items()}
    phases = plan(blocks, weights)

    starts, places = [], []
    for number, p in enumerate(phases):
        for s, a in p.tickets.items():
            later = min((q.first[s] for q in phases[number + 1 :] if s in q.first), default=blocks[s])
            starts.append((s, number, p.start, p.period, a, p.first[s], later))
            places += [(s, number, j, place) for j, place in enumerate(p.places[s])]
    starts = spark.createDataFrame(starts, "__holder string, phase bigint, __start bigint, __period bigint, __tickets bigint, __first bigint, __later bigint")
    places = spark.createDataFrame(places, "__holder string, phase bigint, __turn bigint, __place bigint")

    before = Window.partitionBy("__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    if classes:
        offsets = _held(offsets.withColumn("__total", F.sum("__n").over(Window.partitionBy("__source"))), given).drop("__weight")
    inside = Window.partitionBy("__source", "__bucket").orderBy("__at", *[f"__c{i}" for i in where], *([F.xxhash64(*[f"__c{i}" for i in range(len(kept))])] if where else []))
    ranked = named.withColumn("__inside", F.row_number().over(inside).cast("bigint") - 1).join(offsets.drop("__n"), ["__source", "__bucket"])
    ranked = ranked.withColumn("__rank", F.col("__before") + F.col("__inside")).withColumn("block", F.floor(F.col("__rank") / block_rows).cast("bigint"))
    if classes:
        rounds = [F.col("__holder"), F.col("block"), F.ceil(F.col("__total") / block_rows).desc(), F.col("__source"), F.col("__rank")]
        earlier, n = [], 0
        for s, rows in sorted(totals.items()):
            earlier.append((s, n))
            n += rows
        earlier = spark.createDataFrame(earlier, "__holder string, __earlier bigint")
        ranked = row_positions(ranked.drop("__at", "__bucket", "__before", "__inside"), rounds, "__row").join(F.broadcast(earlier), "__holder").withColumn("__rank", F.col("__row") - 1 - F.col("__earlier"))
    else:
        ranked = ranked.withColumn("__holder", F.col("__source"))
    ranked = ranked.withColumn("__block", F.floor(F.col("__rank") / block_rows).cast("bigint"))

    place = ranked.join(F.broadcast(starts), "__holder").filter((F.col("__block") >= F.col("__first")) & (F.col("__block") < F.col("__later")))
    nth = F.col("__block") - F.col("__first")
    place = place.withColumn("__turn", nth % F.col("__tickets")).join(F.broadcast(places), ["__holder", "phase", "__turn"])
    place = place.withColumn("slot", F.col("__start") + F.floor(nth / F.col("__tickets")).cast("bigint") * F.col("__period") + F.col("__place"))

    # all blocks are full but the last of each source, whose slots and gaps are known
    gaps = []
    for s, n in blocks.items():
        if n * block_rows > totals[s]:
            gaps.append((slot_of(phases, s, n - 1), n * block_rows - totals[s]))
    gaps.sort()
    missing, late = F.lit(0), 0
    for last, gap in gaps:
        late += gap
        missing = F.when(F.col("slot") > last, F.lit(late)).otherwise(missing)
    place = place.withColumn("position", (F.col("slot") * block_rows + F.col("__rank") % block_rows - missing).cast("bigint"))
    return place.select(*[F.col(f"__c{i}").alias(c) for i, c in enumerate(kept)], *added)


def slot_of(phases: list[Phase], source: str, block: int) -> int:
    phase = next(p for p in reversed(phases) if p.first.get(source, block + 1) <= block)
    nth = block - phase.first[source]
    periods, turn = divmod(nth, phase.tickets[source])
    return phase.start + periods * phase.period + phase.places[source][turn]
