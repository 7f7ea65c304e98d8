"""Pane states: mergeable aggregates between the borders of overlapping windows.

The windows of all snapshot dates cut the time line into panes; every window is
a run of whole panes. A log row belongs to one pane, whatever number of windows
hold it. Rows are folded once into one state per (entity, pane), with map-side
combine, and the states, at most one per entity and pane, are merged into the
windows:

* counts, exact sums, means (sum and count), maxima, value codes and active
  days (bit sets) are states that add up, take the greater, or are or-ed;
* a distinct count is kept as one bit set of panes per (entity, value): the
  value counts for every window that has one of its panes. Two levels of
  aggregation spread a hot entity over its values, and no row is expanded once
  per counted column.

Windows closed or open at either end are exact to the instant, because a border
lies before or after its instant.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.plans.channels import VOCABULARIES

#: Bits of a word of a bit set (a bigint without its sign).
WORD = 63
#: Half days without a border beyond which they are one place of the pane table.
LONG_GAP = 128


@dataclass(frozen=True)
class Windows:
    """Windows (date, first border, last border); a border is (day, after): just
    before the day's midnight, or just after that instant."""

    spans: tuple[tuple[dt.date, tuple[dt.date, bool], tuple[dt.date, bool]], ...]

    @classmethod
    def history(cls, dates, days: int, closed: bool) -> Windows:
        """[T - days, T] if ``closed``, else [T - days, T)."""
        return cls(tuple((d, (d - dt.timedelta(days=days), False), (d, closed)) for d in dates))

    @classmethod
    def label(cls, dates, days: int, open_left: bool) -> Windows:
        """(T, T + days] if ``open_left``, else [T, T + days)."""
        return cls(tuple((d, (d, open_left), (d + dt.timedelta(days=days), open_left)) for d in dates))

    def borders(self) -> list[tuple[dt.date, bool]]:
        return sorted({b for _, lo, hi in self.spans for b in (lo, hi)})

    def panes(self) -> dict[dt.date, range]:
        """The panes of every window: pane i lies between borders i and i + 1."""
        at = {b: i for i, b in enumerate(self.borders())}
        return {d: range(at[lo], at[hi]) for d, lo, hi in self.spans}

    def words(self) -> int:
        return -(-max(1, len(self.borders()) - 1) // WORD)

    def pane_of(self, ts: str) -> Column:
        """The pane of a row, NULL outside all windows: looked up by day and by
        whether the row lies at the day's midnight or after it. A comparison with
        every border made methods too long for the JVM to compile. A long stretch
        without a border is one place of the table, which so stays short when a
        window begins at the first day there is."""
        borders = self.borders()
        first = borders[0][0]
        places = [2 * (d - first).days + after for d, after in borders]  # midnight of day i is place 2 i, the rest of it the next
        day = F.to_date(F.col(ts))
        raw = F.datediff(day, _date(first)) * 2 + F.when(F.col(ts) == day.cast("timestamp_ntz"), 0).otherwise(1)
        place, cut, at = raw, 0, []
        for lo, hi in zip(places, places[1:]):
            at.append(lo - cut)
            if hi - lo > LONG_GAP:
                place = place - F.least(F.greatest(raw - F.lit(lo), F.lit(0)), F.lit(hi - lo - 1))
                cut += hi - lo - 1
        at.append(places[-1] - cut)
        reached = [0] * (at[-1] + 2)  # borders at or before each place
        for x in at:
            reached[x] += 1
        used = {i for r in self.panes().values() for i in r}
        panes = [pane if pane in used else "NULL" for pane in (x - 1 for x in accumulate(reached))]
        return F.get(F.expr(f"CAST(array({', '.join(map(str, panes))}) AS array<int>)"), place)

    def inside(self, df: DataFrame, ts: str) -> DataFrame:
        """Rows with their pane, those outside all windows left out. The outer
        borders stand as plain bounds, which reach the scan."""
        borders = self.borders()
        near = df.where((F.col(ts) >= _instant(borders[0][0])) & (F.col(ts) <= _instant(borders[-1][0])))
        return near.withColumn("pane", self.pane_of(ts)).where(F.col("pane").isNotNull())

    def bits(self) -> list[Column]:
        """The row's pane as one bit in the words of a bit set."""
        if self.words() == 1:
            return [F.expr("shiftleft(1L, pane)")]
        return [F.when(F.col("pane").between(w * WORD, (w + 1) * WORD - 1), F.expr(f"shiftleft(1L, pane - {w * WORD})")) for w in range(self.words())]

    def masks(self, date: dt.date) -> list[int]:
        out = [0] * self.words()
        for i in self.panes()[date]:
            out[i // WORD] |= 1 << (i % WORD)
        return out

    def dates_of_pane(self) -> Column:
        """All dates whose window holds the row's pane."""
        panes = self.panes()
        lists = [", ".join(f"DATE'{d}'" for d, r in panes.items() if i in r) for i in range(max(1, len(self.borders()) - 1))]
        return F.get(F.expr(f"array({', '.join(f'CAST(array({x}) AS array<date>)' for x in lists)})"), F.col("pane"))

    def dates(self) -> Column:
        """All dates in the order of ``panes``."""
        return F.expr(f"""CAST(array({', '.join(f"DATE'{d}'" for d in self.panes())}) AS array<date>)""")

    def counts_by_date(self, words: list[str]) -> Column:
        """Aggregate over bit sets: for each of ``dates`` how many sets hold a pane
        of its window."""
        counts = []
        for d in self.panes():
            hit = [F.coalesce(F.col(w).bitwiseAND(F.lit(m)), F.lit(0)) != 0 for w, m in zip(words, self.masks(d)) if m]
            counts.append(F.count_if(reduce(lambda a, b: a | b, hit, F.lit(False))))
        return F.array(*counts)


def _instant(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("timestamp_ntz")


def _date(d: dt.date) -> Column:
    return F.lit(d.isoformat()).cast("date")


@dataclass(frozen=True)
class Measure:
    """A window aggregate: its states over rows, how states merge, and the result."""

    name: str
    states: tuple[Column, ...]
    merge: str  # sum, max or bit_or
    result: object = None  # function of the merged states; the one state as it is if None


def count(name: str, condition: Column) -> Measure:
    return Measure(name, (F.count_if(F.coalesce(condition, F.lit(False))),), "sum")


def total(name: str, column: str) -> Measure:
    """Exact decimal sum, as double."""
    return Measure(name, (F.sum(F.col(column).cast("decimal(24,6)")),), "sum", lambda s: s.cast("double"))


def mean(name: str, column: str) -> Measure:
    """Exact decimal sum by count; NULL without values."""
    states = (F.sum(F.col(column).cast("decimal(24,6)")), F.count(F.col(column)))
    return Measure(name, states, "sum", lambda s, n: s.cast("double") / F.nullif(n.cast("double"), F.lit(0.0)))


def greatest(name: str, value: Column) -> Measure:
    return Measure(name, (F.max(value),), "max")


def codes(name: str, column: str) -> Measure:
    """Distinct values of a declared vocabulary: one bit a value."""
    bit = F.lit(None).cast("long")
    for i, v in enumerate(VOCABULARIES[column]):
        bit = F.when(F.col(column) == v, F.lit(1 << i).cast("long")).otherwise(bit)
    return Measure(name, (F.bit_or(bit),), "bit_or", lambda b: F.coalesce(F.bit_count(b), F.lit(0)).cast("bigint"))


def active_days(name: str, ts: str, windows: Windows) -> Measure:
    """Distinct calendar days with activity: one bit a day between the outer borders."""
    borders = windows.borders()
    first, n = borders[0][0], (borders[-1][0] - borders[0][0]).days + 1
    day = F.datediff(F.to_date(F.col(ts)), _date(first))
    words = tuple(
        F.bit_or(F.when((day >= w) & (day < w + WORD), F.call_function("shiftleft", F.lit(1).cast("long"), day - F.lit(w)))) for w in range(0, n, WORD)
    )
    return Measure(name, words, "bit_or", lambda *bits: reduce(lambda a, b: a + b, [F.coalesce(F.bit_count(x), F.lit(0)) for x in bits]).cast("bigint"))


@dataclass(frozen=True)
class Distinct:
    """Distinct non-null values of a column without a declared vocabulary."""

    name: str
    column: str


def distinct(name: str, column: str) -> Measure | Distinct:
    return codes(name, column) if column in VOCABULARIES else Distinct(name, column)


_MERGE = {"sum": F.sum, "max": F.max, "bit_or": F.bit_or}


def pane_states(df: DataFrame, entity: str, ts: str, windows: Windows, measures: list[Measure]) -> DataFrame:
    """One row per (entity, pane) with the states ``<name>__<i>``."""
    states = [s.alias(f"{m.name}__{i}") for m in measures for i, s in enumerate(m.states)]
    rows = windows.inside(df, ts)
    return rows.groupBy(entity, "pane").agg(*states) if states else rows.select(entity, "pane").distinct()


def window_aggregates(df: DataFrame, entity: str, ts: str, windows: Windows, measures: list[Measure | Distinct]) -> DataFrame:
    """(entity, snapshot_date, measures) for every window with a row in it.

    States, and distinct counts of all dates as one array, are a bounded number of
    rows an entity. They meet by entity, and dates come in only there: what is
    copied per date is never shuffled."""
    folded = [m for m in measures if isinstance(m, Measure)]
    sets = [m for m in measures if isinstance(m, Distinct)]
    parts = pane_states(df, entity, ts, windows, folded)
    words = [f"_w{i}" for i in range(windows.words())]
    for m in sets:
        rows = windows.inside(df.select(entity, ts, m.column).where(F.col(m.column).isNotNull()), ts)
        values = rows.groupBy(entity, m.column).agg(*[F.bit_or(b).alias(w) for b, w in zip(windows.bits(), words)])
        counted = values.groupBy(entity).agg(windows.counts_by_date(words).alias(f"{m.name}__0"))
        parts = parts.unionByName(counted, allowMissingColumns=True)
    dates = F.when(F.col("pane").isNotNull(), windows.dates_of_pane()).otherwise(windows.dates())
    parts = parts.repartition(F.col(entity)).withColumn("snapshot_date", F.explode(dates))
    if sets:
        at = (F.array_position(windows.dates(), F.col("snapshot_date")) - 1).cast("int")
        counts = {f"{m.name}__0": F.get(f"{m.name}__0", at) for m in sets}
        shown = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) > 0, F.lit(False)) for c in counts], F.col("pane").isNotNull())
        parts = parts.withColumns(counts).where(shown)
    merged = [_MERGE[m.merge](f"{m.name}__{i}").alias(f"{m.name}__{i}") for m in folded for i in range(len(m.states))]
    merged += [F.coalesce(F.sum(f"{m.name}__0"), F.lit(0)).alias(f"{m.name}__0") for m in sets]
    out = parts.groupBy(entity, "snapshot_date").agg(*merged)
    results = []
    for m in measures:
        cols = [F.col(f"{m.name}__{i}") for i in range(len(m.states) if isinstance(m, Measure) else 1)]
        shaped = m.result if isinstance(m, Measure) and m.result else (lambda c: c)
        results.append(shaped(*cols).alias(m.name))
    return out.select(entity, "snapshot_date", *results)


def window_flags(parts: DataFrame, entity: str, ts: str, windows: Windows, tag: str, names: list[str]) -> DataFrame:
    """(entity, snapshot_date, one 0/1 column a name) for windows with a row whose
    ``tag`` is that name: one bit set of panes per entity and name, nothing else
    is shuffled."""
    n = windows.words()
    bits = [F.bit_or(F.when(F.col(tag) == name, b)).alias(f"{name}__{w}") for name in names for w, b in enumerate(windows.bits())]
    sets = windows.inside(parts, ts).groupBy(entity).agg(*bits)
    dates = []
    for d in windows.panes():
        masks = windows.masks(d)
        flags = [
            reduce(lambda a, b: a | b, [F.coalesce(F.col(f"{name}__{w}").bitwiseAND(F.lit(masks[w])), F.lit(0)) != 0 for w in range(n)]).cast("int").alias(name)
            for name in names
        ]
        dates.append(F.struct(_date(d).alias("snapshot_date"), *flags))
    out = sets.select(entity, F.explode(F.array(*dates)).alias("w")).select(entity, "w.*")
    return out.where(reduce(lambda a, b: a | b, [F.col(n) == 1 for n in names]))


def meet(rows: DataFrame, part: DataFrame, entity: str = "hcp_id") -> DataFrame:
    """``rows`` with the columns of ``part`` for the same entity and date, if any.

    Only the entity is a key of the join, the date a condition on the few rows that
    share it: both sides lie by entity already, so the rows of all dates, which only
    grow wider, are not shuffled once more for each part."""
    other = part.withColumnsRenamed({entity: "_entity", "snapshot_date": "_date"})
    same = (F.col(entity) == F.col("_entity")) & (F.datediff("snapshot_date", "_date") == 0)
    return rows.join(other, same, "left").drop("_entity", "_date")
