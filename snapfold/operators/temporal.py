"""Facts over time: states and their intervals, beliefs, and what was in force at an instant."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

#: Rows of a key above which it is cut into pieces of time, and how many.
PIECE, CUTS = 1 << 22, 256


def validity(states: DataFrame, key: str, order: list[str], state: str, most: int | None = None) -> DataFrame:
    """Half-open intervals in which a state holds; equal states that follow each other are one interval.

    With ``most``, keys of more rows are scanned in pieces by many tasks: what a piece ends with is handed to the first row of the
    next one, and the start of the next one to the last interval, which are a few rows a key.
    """
    if most is None or not _may_be_hot(states.select(key, order[0]), most):
        w = Window.partitionBy(key).orderBy(*order)
        starts = states.withColumn("_p", F.lag(state).over(w)).withColumn("_n", F.row_number().over(w)).where((F.col("_n") == 1) | ~F.col("_p").eqNullSafe(F.col(state)))
        return starts.drop("_p", "_n").withColumn("valid_to", F.lead(order[0]).over(w)).withColumnRenamed(order[0], "valid_from")
    cut = pieces(states, key, order[0], most).drop("_cuts")
    line, w = Window.partitionBy("_of").orderBy("_at"), Window.partitionBy(key, "_piece").orderBy(*order)
    place = [F.col(key).alias("_of"), F.col("_piece").alias("_at")]
    ends = cut.groupBy(*place).agg(F.max_by(F.struct(F.col(state).alias("s")), F.struct(*order)).alias("_end"))
    ends = ends.select("_of", "_at", F.lag("_end").over(line).alias("_before"))
    here = F.col(key).eqNullSafe(F.col("_of")) & (F.col("_piece") == F.col("_at"))
    rows = cut.withColumns({"_n": F.row_number().over(w), "_p": F.lag(F.struct(F.col(state).alias("s"))).over(w)}).join(ends, here, "left")
    before = F.when(F.col("_n") == 1, F.col("_before")).otherwise(F.col("_p"))
    starts = rows.withColumn("_p", before).where(F.col("_p").isNull() | ~F.col("_p.s").eqNullSafe(F.col(state))).drop("_n", "_p", "_before", "_of", "_at")
    firsts = starts.groupBy(*place).agg(F.min_by(F.struct(F.col(order[0]).alias("t")), F.struct(*order)).alias("_first"))
    firsts = firsts.select("_of", "_at", F.lead("_first").over(line).alias("_next"))
    out = starts.withColumn("valid_to", F.lead(F.struct(F.col(order[0]).alias("t"))).over(w)).join(firsts, here, "left")
    return out.withColumn("valid_to", F.coalesce("valid_to", "_next")["t"]).drop("_of", "_at", "_next", "_piece").withColumnRenamed(order[0], "valid_from")


def belief(evidence: DataFrame, key: str, at: str, method: str, value: str, methods: list[str], most: int | None = None) -> DataFrame:
    """At each instant of a key: each method's newest evidence carried forward, the first method that has any decides.

    Evidence of one instant and method is merged first: one value resolves, several are ambiguous. A key has a row an instant;
    with ``most``, keys of more instants than that are shared by tasks.
    """
    instants = evidence.groupBy(key, at).pivot(method, methods).agg(F.array_sort(F.collect_set(value)))
    held = last_known(instants.withColumns({m: F.when(F.size(m) > 0, F.col(m)) for m in methods}), key, [at], methods, most)
    targets = F.coalesce(*methods)
    state = F.when(targets.isNull(), "unresolved").when(F.size(targets) == 1, "resolved").otherwise("ambiguous")
    by = F.coalesce(*[F.when(F.col(m).isNotNull(), F.lit(m)) for m in methods])
    return held.select(key, at, by.alias("method"), F.when(F.size(targets) == 1, F.element_at(targets, 1)).alias("target"), state.alias("state"), targets.alias("targets"))


def pieces(rows: DataFrame, key: str, at: str, most: int = PIECE, by: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``_piece``: a key of more than ``most`` rows is cut at the quantiles of ``at`` into ``CUTS`` pieces, others are one.

    Rows of one instant stay together, nulls are in the first piece. ``_cuts`` is null where nothing is cut. There are at most
    rows / ``most`` keys that are cut. ``by`` is what is counted, if that is less to read than ``rows``. Quantiles are a sketch that
    depends on the order in which tasks' parts arrive, so they are written once: whoever reads the pieces twice meets the same ones.
    They are 2 KB a key, so every task gets all of them and a hot key's rows needn't meet for it.
    """
    shared_dir(rows.sparkSession)
    by = (rows if by is None else by).select(key, at)
    hot = by.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select(key)
    steps = [i / CUTS for i in range(1, CUTS)]
    cuts = by.join(hot, key, "left_semi").groupBy(key).agg(F.array_distinct(F.percentile_approx(at, steps, 8 * CUTS)).alias("_cuts")).checkpoint()
    return rows.join(F.broadcast(cuts), key, "left").withColumn("_piece", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(at))), F.lit(0)))


def _may_be_hot(rows: DataFrame, most: int) -> bool:
    """Whether a key of ``rows`` can have more than ``most`` rows, by the size that Spark's plan tells: a row has a byte at least."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > most


def last_known(rows: DataFrame, key: str, order: list[str], values: list[str], most: int | None = PIECE, by: DataFrame | None = None) -> DataFrame:
    """``rows`` with each of ``values`` carried on: its last value that isn't null, of the key, up to the row in ``order``.

    A key of more than ``most`` rows is scanned in pieces by many tasks; what a piece ends with is then carried into the next
    ones, which are a few rows a key. Hot keys are looked for in ``by`` (``rows`` if not given), unless that is too small to have
    one. Without ``most`` it is a window, for rows that are few a key by what they are.
    """
    before = Window.rowsBetween(Window.unboundedPreceding, 0)
    if most is None or not _may_be_hot((rows if by is None else by).select(key, order[0]), most):
        w = before.partitionBy(key).orderBy(*order)
        return rows.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values})
    cut = pieces(rows, key, order[0], most, by)
    w = before.partitionBy(key, "_piece").orderBy(*order)
    inside = cut.withColumns({v: F.last(v, ignorenulls=True).over(w) for v in values}).drop("_cuts")
    bearing = cut.where(F.col("_cuts").isNotNull() & F.coalesce(*[F.when(F.col(v).isNotNull(), True) for v in values]))
    ends = bearing.groupBy(key, "_piece").agg(*[F.max_by(v, F.when(F.col(v).isNotNull(), F.struct(*order))).alias(f"_in_{v}") for v in values])
    # a piece without a value of its own hands on what came before: the latest earlier piece that has one
    starts = ends.select(F.col(key).alias("_of"), F.col("_piece").alias("_from"), F.lead("_piece", 1, CUTS).over(Window.partitionBy(key).orderBy("_piece")).alias("_until"), *[F.last(f"_in_{v}", ignorenulls=True).over(Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)).alias(f"_in_{v}") for v in values])
    carried = starts.withColumn("_piece", F.explode(F.sequence(F.col("_from") + 1, F.col("_until")))).select(F.col("_of").alias(key), "_piece", *[f"_in_{v}" for v in values])
    out = inside.join(carried, [key, "_piece"], "left").withColumns({v: F.coalesce(v, f"_in_{v}") for v in values})
    return out.select(*[F.col(f"`{c}`") for c in rows.columns])


def as_of(probes: DataFrame, intervals: DataFrame, key: str, at: str, values: list[str], most: int | None = PIECE) -> DataFrame:
    """Probes with what was in force at their instant; null where nothing was.

    Intervals of a key don't overlap. Their starts and the probes are laid on one line by key and time, so a key with many of
    either costs their sum, not their product; a key with more than ``most`` probes is shared by many tasks (``last_known``).
    """
    what = F.struct(F.col("valid_to"), *[F.col(v) for v in values])
    starts = intervals.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    starts = starts.select(F.col(key).alias("_key"), F.col("valid_from").alias("_at"), F.lit(0).alias("_side"), what.alias("_what"))
    asks = probes.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*[F.col(f"`{c}`") for c in probes.columns]).alias("_probe"))
    met = last_known(starts.unionByName(asks, allowMissingColumns=True), "_key", ["_at", "_side"], ["_what"], most, by=asks).where("_side = 1")
    inside = F.col("_what.valid_to").isNull() | (F.col("_at") < F.col("_what.valid_to"))
    return met.select("_probe.*", *[F.when(inside, F.col(f"_what.{v}")).alias(v) for v in values])


def open_sets(intervals: DataFrame, key: str, target: str, start: str, end: str) -> DataFrame:
    """Intervals of days that may overlap, both ends included, to elementary segments: key, valid_from, valid_to (excluded), targets.

    A segment lasts as long as the set of open targets does; times without an open target have none. A sweep over the sorted
    starts and ends carries the open set on, so a key costs its boundaries and the sets that are written, whatever overlaps;
    a null end is open, a null start or key and an interval that ends before it starts are no interval.
    """
    rows = intervals.where(F.col(key).isNotNull() & F.col(start).isNotNull() & F.col(target).isNotNull() & (F.col(end).isNull() | (F.col(end) >= F.col(start))))
    opened = rows.select(F.col(key).alias("key"), F.col(start).cast("date").alias("at"), F.lit(1).alias("step"), F.col(target).alias("target"))
    closed = rows.where(F.col(end).isNotNull()).select(F.col(key).alias("key"), F.date_add(end, 1).alias("at"), F.lit(-1).alias("step"), F.col(target).alias("target"))
    # steps of one day and target are one: what only starts another interval of an open target changes nothing later on
    line = opened.unionByName(closed).groupBy("key", "at", "target").agg(F.sum("step").alias("step")).where("step <> 0")
    kind = line.schema["key"].dataType
    schema = f"key {kind.simpleString()}, valid_from date, valid_to date, targets array<string>"

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, since, held, open_ = None, None, [], Counter()
        types = None

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], t) for i, t in enumerate(types)], ["key", "valid_from", "valid_to", "targets"])

        size, last = 0, None

        def told(until) -> None:
            """The set that is open from ``since`` on: a segment of its own, or more of the one before."""
            nonlocal last, size
            names = sorted(open_)
            if last and last[0] == now and last[2] == since and last[3] == names:
                last = (*last[:2], until, names)
                return
            if last:
                held.append(last)
                size += len(last[3])
            last = (now, since, until, names) if names else None

        for b in batches:
            types = types or [b.schema.field("key").type, pa.date32(), pa.date32(), pa.list_(pa.string())]
            for k, at, name, step in zip(*[c.to_pylist() for c in b.columns]):
                if (k, at) != (now, since):
                    told(at if k == now else None)
                    if k != now:
                        open_ = Counter()
                    now, since = k, at
                open_[name] += step
                if not open_[name]:
                    del open_[name]
                if size > 100_000:
                    yield flush()
                    held, size = [], 0
        told(None)
        held += [last] if last else []
        if held:
            yield flush()

    out = line.repartition("key").sortWithinPartitions("key", "at").select("key", "at", "target", "step").mapInArrow(swept, schema)
    return out.withColumnRenamed("key", key)
