"""Features of the strict past, as-of lookups, densities, runs.

All orders end in a unique id. Windows that need only the last rows of an entity run in slices: rows are numbered per
entity in two steps, cut into slices of ``slice_rows``, and each slice gets the last rows of the one before it (a halo), so an
entity that holds a third of all rows is many tasks. Whole-history sums carry small per-slice totals over.

Defined results: a null measure counts as a row but not as a value; rows with a null entity are one entity; a null time
sorts first; equal times are ordered by the id; an entity's first row has no past (nulls, count 0); an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

DAY_US = 86_400_000_000


def numbered(df: DataFrame, entity: str, at_us: str, tie: str, chunk_us: int = 30 * DAY_US) -> DataFrame:
    """df with __pos, the 0-based place of each row in its entity; a chunk of time is the largest group."""
    chunk = F.floor(F.coalesce(F.col(at_us), F.lit(-(2**62))) / chunk_us)
    work = df.withColumn("__chunk", chunk)
    sizes = work.groupBy(entity, "__chunk").agg(F.count("*").alias("__n"))
    before = W.partitionBy(entity).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)  # one row per chunk
    starts = sizes.select(F.col(entity).alias("__e"), F.col("__chunk").alias("__c"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(W.partitionBy(entity, "__chunk").orderBy(at_us, tie)) - 1
    placed = work.withColumn("__k", inside).join(starts, F.col(entity).eqNullSafe(F.col("__e")) & (F.col("__chunk") == F.col("__c")))
    return placed.withColumn("__pos", F.col("__k") + F.col("__start")).drop("__chunk", "__k", "__e", "__c", "__start")


def sliced(df: DataFrame, entity: str, at_us: str, tie: str, reach: int, slice_rows: int = 1_000_000, chunk_us: int = 30 * DAY_US) -> DataFrame:
    """df in slices with a halo of ``reach`` rows: partition windows by (entity, __slice), order by __pos, then drop_halo."""
    if slice_rows <= reach:
        raise ValueError("a slice has to be longer than the reach")
    placed = numbered(df, entity, at_us, tie, chunk_us)
    own = F.floor(F.col("__pos") / slice_rows)
    tail = F.col("__pos") % slice_rows >= slice_rows - reach
    return placed.withColumn("__own", own).withColumn("__slice", F.explode(F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))))


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter("__slice = __own").drop("__slice", "__own", "__pos")


def slice_window(entity: str):
    return W.partitionBy(entity, "__slice").orderBy("__pos")


def past(entity_window, rows: int):
    """The ``rows`` rows before the current one."""
    return entity_window.rowsBetween(-rows, -1)


def lagged_mean(x: Column, window, rows: int) -> Column:
    return F.avg(x).over(past(window, rows))


def lagged_std(x: Column, window, rows: int, least: int = 3) -> Column:
    frame = past(window, rows)
    return F.when(F.count(x).over(frame) >= least, F.stddev_samp(x).over(frame))


def days_since(at_us: Column, window, n: int, cap: float) -> Column:
    """Days since the n-th row before, at most cap; null if there is none."""
    days = (at_us - F.lag(at_us, n).over(window)) / DAY_US
    return F.when(days.isNotNull(), F.least(days, F.lit(float(cap))))


def next_calendar_day(at_us: Column, window) -> Column:
    """1.0 if the row before is on the UTC day before, else 0.0."""
    day = F.floor(at_us / DAY_US)
    return F.when(F.coalesce(day - F.lag(day).over(window) == 1, F.lit(False)), 1.0).otherwise(0.0)


def asof_cutoff(at_us: Column, lag_us: int = 43_200_000_000) -> Column:
    """The earlier of the day's start and 12 hours before."""
    return F.least(F.floor(at_us / DAY_US).cast("long") * DAY_US, at_us - lag_us)


def asof_prefix(history: DataFrame, queries: DataFrame, entity: str, history_us: str, cutoff_us: str, query_id: str) -> DataFrame:
    """(query_id, entity, n_before): how many rows of history lie strictly before each query's cutoff.

    History and queries are sorted together, a query before a history row of the same time; the running count of history
    is made per chunk of 30 days and carried over by chunk totals.
    """
    h = history.select(entity, F.col(history_us).alias("__at"), F.lit(1).alias("__h"), F.lit(None).cast("long").alias(query_id))
    q = queries.select(entity, F.col(cutoff_us).alias("__at"), F.lit(0).alias("__h"), F.col(query_id).cast("long").alias(query_id))
    both = h.unionByName(q).withColumn("__chunk", F.floor(F.col("__at") / (30 * DAY_US)))
    sizes = both.groupBy(entity, "__chunk").agg(F.sum("__h").alias("__n"))
    before = W.partitionBy(entity).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)  # one row per chunk
    starts = sizes.select(entity, "__chunk", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    run = F.sum("__h").over(W.partitionBy(entity, "__chunk").orderBy("__at", "__h").rowsBetween(W.unboundedPreceding, 0))
    out = both.withColumn("__run", run).filter("__h = 0").join(starts, [entity, "__chunk"])
    return out.select(query_id, entity, (F.col("__run") + F.col("__start")).alias("n_before"))


def asof_stats(history: DataFrame, queries: DataFrame, entity: str, history_us: str, tie: str, cutoff_us: str, query_id: str, stats: dict[str, Column], rows: int) -> DataFrame:
    """(query_id, entity, n_before, stats...): aggregates over the last ``rows`` rows of history before each cutoff.

    stats are aggregate Columns over history (avg, sum, count ...). They are computed once per history row, then found by
    place: an equi join instead of one search per query.
    """
    cut = sliced(history, entity, history_us, tie, rows)
    frame = slice_window(entity).rowsBetween(-(rows - 1), 0)
    at = cut.withColumns({name: c.over(frame) for name, c in stats.items()}).filter("__slice = __own").select(F.col(entity).alias("__e"), (F.col("__pos") + 1).alias("__end"), *stats)
    found = asof_prefix(history, queries, entity, history_us, cutoff_us, query_id)
    return found.join(at, (F.col(entity) == F.col("__e")) & (F.col("n_before") == F.col("__end")), "left").select(query_id, entity, "n_before", *stats)


def asof_latest(history: DataFrame, queries: DataFrame, entity: str, history_us: str, query_us: str, query_id: str, offsets_us: Sequence[int], complete: Column, keep: Sequence[str]) -> DataFrame:
    """(query_id, offset_us, status, keep...): the newest row of history strictly before each query's cutoff.

    Two newest rows at one time: none ('tied'); an incomplete newest row blocks ('incomplete') and older ones don't
    stand in. The newest time is found by an as-of place, and only rows of that time are looked at.
    """
    q = queries.select(F.col(query_id), entity, F.explode(F.array(*[F.lit(o).cast("long") for o in offsets_us])).alias("offset_us"), F.col(query_us).alias("__q")).withColumn("__cut", F.col("__q") - F.col("offset_us"))
    q = q.withColumn("__qid", F.xxhash64(query_id, "offset_us"))
    times = history.groupBy(entity, F.col(history_us).alias("__t")).agg(F.count("*").alias("__same"), F.bool_and(complete).alias("__complete"), *[F.min(c).alias(c) for c in keep])
    placed = numbered(times, entity, "__t", "__t").select(F.col(entity).alias("__e"), (F.col("__pos") + 1).alias("__end"), "__same", "__complete", *keep)
    at = asof_prefix(times, q, entity, "__t", "__cut", "__qid").select("__qid", "n_before")
    out = q.join(at, "__qid").join(placed, (F.col(entity) == F.col("__e")) & (F.col("n_before") == F.col("__end")), "left")
    status = F.when(F.col("__same").isNull(), "none").when(F.col("__same") > 1, "tied").when(~F.coalesce(F.col("__complete"), F.lit(False)), "incomplete").otherwise("found")
    out = out.withColumn("status", status)
    return out.select(query_id, "offset_us", "status", *[F.when(F.col("status") == "found", F.col(c)).alias(c) for c in keep])


def _with_chunk_totals(df: DataFrame, entity: str, totals: dict[str, Column], carry) -> DataFrame:
    """df joined to what precedes its chunk: totals are aggregates of a chunk, carry turns them into columns over the chunks before."""
    sizes = df.groupBy(entity, "__chunk").agg(*[c.alias(n) for n, c in totals.items()])
    before = W.partitionBy(entity).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)  # one row per chunk
    starts = sizes.select(F.col(entity).alias("__e"), F.col("__chunk").alias("__c"), *carry(before))
    return df.join(starts, F.col(entity).eqNullSafe(F.col("__e")) & F.col("__chunk").eqNullSafe(F.col("__c"))).drop("__e", "__c")


def running_sums(df: DataFrame, entity: str, at_us: str, tie: str, sums: dict[str, Column], chunk_us: int = 30 * DAY_US) -> DataFrame:
    """df with, for each name, the sum over the entity's rows before this one (0 at the start). A chunk of time is the largest group."""
    work = df.withColumn("__chunk", F.floor(F.col(at_us) / chunk_us)).withColumns({f"__x_{n}": c for n, c in sums.items()})
    work = _with_chunk_totals(work, entity, {f"__t_{n}": F.sum(f"__x_{n}") for n in sums}, lambda w: [F.coalesce(F.sum(f"__t_{n}").over(w), F.lit(0)).alias(f"__s_{n}") for n in sums])
    inside = W.partitionBy(entity, "__chunk").orderBy(at_us, tie).rowsBetween(W.unboundedPreceding, -1)
    out = work.withColumns({n: F.coalesce(F.sum(f"__x_{n}").over(inside), F.lit(0)) + F.col(f"__s_{n}") for n in sums})
    return out.select(*df.columns, *sums)


def last_known(df: DataFrame, entity: str, at_us: str, tie: str, columns: dict[str, str], chunk_us: int = 30 * DAY_US) -> DataFrame:
    """df with, for each name, the last known value of a column up to and with this row. Never from later rows."""
    work = df.withColumn("__chunk", F.floor(F.col(at_us) / chunk_us))
    latest = {f"__t_{n}": F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(at_us, tie))) for n, c in columns.items()}
    work = _with_chunk_totals(work, entity, latest, lambda w: [F.last(f"__t_{n}", ignorenulls=True).over(w).alias(f"__s_{n}") for n in columns])
    inside = W.partitionBy(entity, "__chunk").orderBy(at_us, tie).rowsBetween(W.unboundedPreceding, 0)
    out = work.withColumns({n: F.coalesce(F.last(c, ignorenulls=True).over(inside), F.col(f"__s_{n}")) for n, c in columns.items()})
    return out.select(*df.columns, *columns)


def valid_prefix(df: DataFrame, entity: str, at_us: str, tie: str, bad: Column, name: str = "still_valid", chunk_us: int = 30 * DAY_US) -> DataFrame:
    """df with true up to the first bad row of the entity; unknown counts as sound."""
    flag = F.coalesce(bad, F.lit(False)).cast("long")
    out = running_sums(df.withColumn("__bad", flag), entity, at_us, tie, {"__before": F.col("__bad")}, chunk_us)
    return out.withColumn(name, F.col("__before") + F.col("__bad") == 0).drop("__before", "__bad")


def densities(df: DataFrame, entity: str, at_us: str, hours: Sequence[int], chunk_us: int = 30 * DAY_US) -> DataFrame:
    """df with n_<h>h, the entity's rows in [t - h, t), and censored_<h>h, whether that window reaches its first row.

    Rows of a chunk's last ``max(hours)`` are also put into the next chunk, so a chunk of time is the largest group.
    """
    reach = max(hours) * 3_600_000_000
    size = max(chunk_us, reach)
    own, at = F.floor(F.col(at_us) / size), F.col(at_us)
    cut = df.withColumn("__own", own).withColumn("__slice", F.explode(F.when(at >= (F.col("__own") + 1) * size - reach, F.array("__own", F.col("__own") + 1)).otherwise(F.array("__own"))))
    w = W.partitionBy(entity, "__slice").orderBy(at_us)
    counted = cut.withColumns({f"n_{h}h": F.count("*").over(w.rangeBetween(-h * 3_600_000_000, -1)) for h in hours}).filter("__slice = __own").drop("__slice", "__own")
    first = df.groupBy(F.col(entity).alias("__e")).agg(F.min(at_us).alias("__first"))
    out = counted.join(first, F.col(entity).eqNullSafe(F.col("__e")))
    return out.withColumns({f"censored_{h}h": at - h * 3_600_000_000 <= F.col("__first") for h in hours}).drop("__e", "__first")


def run_length(df: DataFrame, entity: str, at_us: str, tie: str, value: str, chunk_us: int = 30 * DAY_US) -> DataFrame:
    """df with run_length (equal known values up to and with this row), prior_run (without it; null where the value is
    null), same_as_before (three-valued) and touches_start (whether the run begins at the entity's first row).

    Runs are counted within chunks; a chunk that goes on with the value before it adds to what it was handed, and what is
    handed on comes from sums over the chunks of the entity, one row each.
    """
    work = numbered(df, entity, at_us, tie, chunk_us).withColumn("__chunk", F.floor(F.coalesce(F.col(at_us), F.lit(-(2**62))) / chunk_us))
    inside = W.partitionBy(entity, "__chunk").orderBy("__pos")
    work = work.withColumn("__new", (~F.coalesce(F.col(value) == F.lag(value).over(inside), F.lit(False))).cast("long"))
    work = work.withColumn("__isle", F.sum("__new").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    work = work.withColumn("__k", F.row_number().over(W.partitionBy(entity, "__chunk", "__isle").orderBy("__pos")))
    chunks = work.groupBy(entity, "__chunk").agg(
        F.min_by(value, "__pos").alias("__first"), F.max_by(value, "__pos").alias("__last"), F.max_by("__k", "__pos").alias("__tail"), F.count("*").alias("__n"), F.max("__isle").alias("__isles")
    )
    order = W.partitionBy(entity).orderBy("__chunk")
    chunks = chunks.withColumn("__handed_value", F.lag("__last").over(order)).withColumn("__has_before", F.lag("__n").over(order).isNotNull())
    goes_on = (F.col("__isles") == 1) & F.coalesce(F.col("__first") == F.col("__handed_value"), F.lit(False))
    chunks = chunks.withColumn("__stretch", F.sum((~goes_on).cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0)))
    along = W.partitionBy(entity, "__stretch").orderBy("__chunk").rowsBetween(W.unboundedPreceding, 0)
    length = F.first("__tail").over(along) + F.sum("__n").over(along) - F.first("__n").over(along)
    chunks = chunks.withColumn("__length", length).withColumn("__handed", F.lag("__length").over(order))
    carry = chunks.select(F.col(entity).alias("__e"), F.col("__chunk").alias("__c"), "__handed_value", "__has_before", "__handed")
    out = work.join(carry, F.col(entity).eqNullSafe(F.col("__e")) & (F.col("__chunk") == F.col("__c")))
    continued = (F.col("__isle") == 1) & F.coalesce(F.col(value) == F.col("__handed_value"), F.lit(False))
    run = F.col("__k") + F.when(continued, F.col("__handed")).otherwise(0)
    before = F.when((F.col("__pos") > 0) & (F.col("__isle") == 1) & (F.col("__k") == 1), F.col("__handed_value")).otherwise(F.lag(value).over(inside))
    out = out.withColumns({"run_length": run, "same_as_before": F.col(value) == before})
    out = out.withColumns({"prior_run": F.when(F.col(value).isNotNull(), F.col("run_length") - 1), "touches_start": F.col("__pos") + 1 == F.col("run_length")})
    return out.select(*df.columns, "run_length", "prior_run", "same_as_before", "touches_start")


def same_as_before(value: str, window) -> Column:
    """Three-valued: null if either is null."""
    return F.col(value) == F.lag(value).over(window)


def prior_distinct_day(df: DataFrame, entity: str, day: str, name: str = "prior_day") -> DataFrame:
    """df with the entity's last different day before this one."""
    days = df.select(entity, day).distinct()
    earlier = days.withColumn(name, F.lag(day).over(W.partitionBy(entity).orderBy(day)))
    return df.join(earlier, [entity, day], "left")


def arrival_gaps(df: DataFrame, entity: str, arrival: str, at_us: str, gap_us: int, chunk: int = 1_000_000) -> DataFrame:
    """df with reversed (time before that of the arrival before) and gap (more than gap_us after it), in slices of arrivals."""
    cut = sliced(df, entity, arrival, arrival, 1, chunk_us=chunk)
    prev = F.lag(at_us).over(slice_window(entity))
    marked = cut.withColumn("reversed", F.coalesce(F.col(at_us) < prev, F.lit(False))).withColumn("gap", F.coalesce(F.col(at_us) - prev > gap_us, F.lit(False)))
    return drop_halo(marked)
