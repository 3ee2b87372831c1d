"""Per-key operators that depend on row order, written so that no key is ever one task.

A plain ``Window.partitionBy(key)`` puts a key's whole history into one task, which fails as soon as one
symbol or account owns a large share of the table. Here the rows of a large key are cut into ranges of the
full order ``(ts, *tie)``, so that a day or a single instant with many rows is cut like any other stretch:

1. a sample, rows picked by the hash of their position, says which keys have more than ``max_rows`` rows and
   gives their splitters, one for every ``max_rows`` rows;
2. each row finds its range by binary search among its key's splitters, and window functions run inside
   ``(key, range)``;
3. one summary row per range is aggregated with map-side combine and scanned per key for the value carried
   into each range, which is joined back.

Without a large key the second step is all there is: one shuffle and one window. With one, the rows of step 2
are stored, so the source is read twice, for the sample and for the rows. What is broadcast, splitters and
carries, has an entry per ``max_rows`` rows. Keys must not be null and ``(ts, *tie)`` must order a key's rows
uniquely.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import stored

MAX_CHUNK_ROWS = 2_000_000
#: Sampled rows per range. A range strays from ``max_rows`` by an eighth of it, as one standard deviation.
SAMPLED = 64

_SPLITTERS, _RANGE = "__splitters", "__range"


@dataclass(frozen=True)
class Timeline:
    """What orders the rows: the keys, the time column and tie-break columns."""

    keys: tuple[str, ...]
    ts: str
    tie: tuple[str, ...] = ()
    max_rows: int = MAX_CHUNK_ROWS

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.tie]

    @property
    def chunk(self) -> list[str]:
        return [*self.keys, _RANGE]

    def position(self) -> Column:
        return F.struct(*self.order)

    def rows(self, split: bool = True) -> Window:
        return Window.partitionBy(*(self.chunk if split else self.keys)).orderBy(*self.order)

    def chunks(self) -> Window:
        return Window.partitionBy(*self.keys).orderBy(_RANGE)


def splitters(df: DataFrame, line: Timeline) -> DataFrame:
    """Positions at which the rows of each large key are cut, in order, as one array per key.

    One row in ``every`` is sampled. Where fewer than ``SAMPLED`` rows make a range, all rows are.
    """
    every = max(1, line.max_rows // SAMPLED)
    spacing = line.max_rows // every
    sample = df.select(*line.keys, *line.order).filter(
        F.pmod(F.xxhash64(*line.keys, *line.order), F.lit(every)) == 0)
    inside = Window.partitionBy(*line.keys)
    placed = sample.withColumn("__n", F.row_number().over(inside.orderBy(*line.order)) - 1)
    # the first row of a key starts its first range and splits nothing
    cuts = placed.filter((F.col("__n") > 0) & (F.col("__n") % spacing == 0))
    return cuts.groupBy(*line.keys).agg(F.sort_array(F.collect_list(line.position())).alias(_SPLITTERS))


def in_ranges(df: DataFrame, line: Timeline, cuts: DataFrame, most: int) -> DataFrame:
    """The rows with the number of their range: how many splitters of their key are not above them, ``most`` at most."""
    position = line.position()

    def halve(found: Column, _: Column) -> Column:
        middle = F.shiftright(found["low"] + found["high"], 1)
        passed = F.get(F.col(_SPLITTERS), middle) <= position
        return (
            F.when(found["low"] >= found["high"], found)
            .when(passed, F.struct((middle + 1).alias("low"), found["high"].alias("high")))
            .otherwise(F.struct(found["low"].alias("low"), middle.alias("high")))
        )

    whole = F.struct(F.lit(0).alias("low"), F.size(_SPLITTERS).alias("high"))
    steps = F.sequence(F.lit(1), F.lit(most.bit_length()))
    search = F.aggregate(steps, whole, halve, lambda found: found["low"])
    number = F.when(F.col(_SPLITTERS).isNotNull(), search).otherwise(0)
    return df.join(F.broadcast(cuts), list(line.keys), "left").withColumn(_RANGE, number).drop(_SPLITTERS)


def _carried(
    df: DataFrame,
    line: Timeline,
    local: Callable[[Window], dict[str, Column]],
    summary: dict[str, Column],
    carry: dict[str, Callable[[Window], Column]],
    final: dict[str, Column],
) -> DataFrame:
    """``local`` sees the rows of a range, ``summary`` too, ``carry`` the summaries, ``final`` both ``local`` and ``carry``."""
    found = splitters(df, line)
    cuts = found.collect()  # one position per ``max_rows`` rows
    if not cuts:
        rows = df.withColumns(local(line.rows(split=False)))
        nothing = {n: F.lit(None).cast(_kind(df, summary, n)) for n in carry}
        joined = rows.withColumns(nothing)
    else:
        most = max(len(row[_SPLITTERS]) for row in cuts)
        cuts = df.sparkSession.createDataFrame(cuts, found.schema)
        rows = stored(in_ranges(df, line, cuts, most).withColumns(local(line.rows())), "ranges")
        large = rows.join(F.broadcast(cuts.select(*line.keys)), list(line.keys), "left_semi")
        chunks = large.groupBy(*line.chunk).agg(*[c.alias(n) for n, c in summary.items()])
        carries = chunks.withColumns({n: f(line.chunks()) for n, f in carry.items()}).select(*line.chunk, *carry)
        joined = rows.join(F.broadcast(carries), line.chunk, "left")
    return joined.withColumns(final).select(*df.columns, *[n for n in final if n not in df.columns])


def _kind(df: DataFrame, summary: dict[str, Column], carried: str):
    """Type of the summary that a carry continues."""
    name = carried.replace("__c_", "__s_", 1)
    return df.agg(summary[name].alias(name)).schema[name].dataType


def fill_forward(df: DataFrame, line: Timeline, columns: dict[str, Column]) -> DataFrame:
    """Last non-null value of each expression up to and including the row."""
    def local(rows: Window) -> dict[str, Column]:
        upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {f"__l_{name}": F.last(value, ignorenulls=True).over(upto) for name, value in columns.items()}

    summary, carry, final = {}, {}, {}
    for name, value in columns.items():
        summary[f"__s_{name}"] = F.max_by(value, F.when(value.isNotNull(), line.position()))
        carry[f"__c_{name}"] = lambda w, n=f"__s_{name}": F.last(F.col(n), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1)
        )
        final[name] = F.coalesce(F.col(f"__l_{name}"), F.col(f"__c_{name}"))
    return _carried(df, line, local, summary, carry, final)


def running_sum(df: DataFrame, line: Timeline, columns: dict[str, Column]) -> DataFrame:
    """Sum of each expression over the key's rows up to and including the row."""
    def local(rows: Window) -> dict[str, Column]:
        upto = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return {f"__l_{name}": F.sum(value).over(upto) for name, value in columns.items()}

    summary, carry, final = {}, {}, {}
    for name, value in columns.items():
        summary[f"__s_{name}"] = F.sum(value)
        carry[f"__c_{name}"] = lambda w, n=f"__s_{name}": F.sum(F.col(n)).over(
            w.rowsBetween(Window.unboundedPreceding, -1)
        )
        final[name] = F.coalesce(F.col(f"__l_{name}"), F.lit(0)) + F.coalesce(F.col(f"__c_{name}"), F.lit(0))
    return _carried(df, line, local, summary, carry, final)


def previous(df: DataFrame, line: Timeline, columns: dict[str, Column]) -> DataFrame:
    """Value of each expression in the key's preceding row; null in its first row."""
    def local(rows: Window) -> dict[str, Column]:
        lags = {f"__l_{name}": F.lag(value).over(rows) for name, value in columns.items()}
        return {"__first": F.row_number().over(rows) == 1} | lags

    summary, carry, final = {}, {}, {}
    for name, value in columns.items():
        summary[f"__s_{name}"] = F.max_by(value, line.position())
        carry[f"__c_{name}"] = lambda w, n=f"__s_{name}": F.lag(F.col(n)).over(w)
        final[name] = F.when(F.col("__first"), F.col(f"__c_{name}")).otherwise(F.col(f"__l_{name}"))
    return _carried(df, line, local, summary, carry, final)


def as_of(
    probes: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    ts: str,
    values: Sequence[str],
    tie: str,
    max_rows: int = MAX_CHUNK_ROWS,
) -> DataFrame:
    """Each probe row with ``values`` of the key's latest fact at or before the probe's ``ts``.

    Both sides are laid on one time line and the fact values are filled forward, so the cost is that of one
    shuffle however many facts precede a probe. ``tie`` orders facts that share a time stamp.
    """
    fact = F.struct(*values)
    events = facts.select(
        *keys, ts, F.lit(0).alias("__probe"), F.col(tie).alias("__tie"), fact.alias("__fact"),
        F.lit(None).cast(probes.schema).alias("__row"),
    ).unionByName(
        probes.select(
            *keys, ts, F.lit(1).alias("__probe"), F.lit(None).cast(facts.schema[tie].dataType).alias("__tie"),
            F.lit(None).cast(facts.select(*values).schema).alias("__fact"),
            F.struct(*probes.columns).alias("__row"),
        )
    )
    line = Timeline(tuple(keys), ts, ("__probe", "__tie"), max_rows)
    filled = fill_forward(events, line, {"__fact": F.col("__fact")})
    return filled.filter(F.col("__probe") == 1).select("__row.*", *[F.col("__fact")[v].alias(v) for v in values])


def number_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    """Zero-based position of each row in ascending order of a unique BIGINT ``key``.

    Ranges of a million key values hold at most a million rows each, and so do the ranges of ranges; the
    one unpartitioned window runs over the top level, which BIGINT limits to about 18.5 million rows.
    """
    width = 1_000_000
    ranged = df.withColumn("__range", F.floor(F.col(key) / width)).withColumn(
        "__top", F.floor(F.col("__range") / width)
    )
    before = (Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("__top", "__range").agg(F.count(F.lit(1)).alias("__n"))
    tops = ranges.groupBy("__top").agg(F.sum("__n").alias("__n")).select(
        "__top",
        F.coalesce(F.sum("__n").over(Window.orderBy("__top").rowsBetween(*before)), F.lit(0)).alias("__base"),
    )
    within = Window.partitionBy("__top").orderBy("__range").rowsBetween(*before)
    starts = (
        ranges.withColumn("__before", F.coalesce(F.sum("__n").over(within), F.lit(0)))
        .join(tops, "__top")
        .select("__top", "__range", (F.col("__base") + F.col("__before")).alias("__start"))
    )
    local = F.row_number().over(Window.partitionBy("__top", "__range").orderBy(key)) - 1
    return (
        ranged.withColumn("__local", local)
        .join(starts, ["__top", "__range"])
        .withColumn(name, F.col("__start") + F.col("__local"))
        .select(*df.columns, name)
    )
