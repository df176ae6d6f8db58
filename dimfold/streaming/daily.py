"""Structured Streaming trigger for the daily cumulative jobs.

The modelling jobs are batch steps run once per day (datelist cumulation,
monthly metric arrays); late data is handled by re-running a day. This module
turns new event files into those re-runs: a file stream over the event folder
feeds ``foreachBatch``; each micro-batch only says which days received rows.
Every touched day and each later day of the event table (their cumulative state
depends on it) is recomputed from the *whole* event table for that day (the
day filter is pushed into the scan) and its state partition is replaced with
dynamic partition overwrite. Days that no batch named since the last loaded
one are made up for, and a partition wider than a day (a month) is always
rebuilt from its first day. So a re-delivered or late file changes nothing or
exactly what it must; the stream's checkpoint makes the trigger itself
exactly-once, and every write is idempotent.

The loop over days is sequential by nature, as each day's state needs the day
before; each step is a distributed job over that day's events.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimfold.operators.state import write_period
from dimfold.session import cut_lineage

Step = Callable[[DataFrame, DataFrame, dt.date], DataFrame]


class DailyStateLoader:
    """Recompute a day-partitioned cumulative state from an event table.

    ``step(prev_state, events, day)`` returns the state rows of ``day``
    (``datelist_step`` or a wrapper of ``monthly_arrays_step``);
    ``partition_of(day)`` names the state partition that holds ``day``
    (the day itself, or the month start); ``empty_state`` is a zero-row
    DataFrame with the state schema.
    """

    def __init__(self, spark: SparkSession, events_path: str, events_schema: StructType, state_path: str,
                 step: Step, empty_state: DataFrame, partition_col: str = "date",
                 partition_of: Callable[[dt.date], dt.date] = lambda d: d,
                 ts_col: str = "event_time", prepare: Callable[[DataFrame], DataFrame] | None = None):
        self.spark = spark
        self.events_path = events_path
        self.events_schema = events_schema
        self.state_path = state_path
        self.step = step
        self.empty_state = empty_state
        self.partition_col = partition_col
        self.partition_of = partition_of
        self.ts_col = ts_col
        self.prepare = prepare or (lambda df: df)

    # -- state table ---------------------------------------------------------
    def _state(self) -> DataFrame | None:
        """The state table, or None if nothing has been written yet. Any other
        failure to read it is raised: taken for an empty state it would be
        overwritten."""
        try:
            return self.spark.read.schema(self.empty_state.schema).parquet(self.state_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _state_days(self) -> list[dt.date]:
        st = self._state()
        if st is None:
            return []
        return [r[0] for r in st.select(F.col(self.partition_col).cast("date")).distinct().collect()]

    def _read_partition(self, part: dt.date) -> DataFrame:
        st = self._state()
        if st is None:
            return self.empty_state
        rows = st.where(F.col(self.partition_col).cast("date") == F.lit(part))
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in self.empty_state.schema.fields])

    def events(self) -> DataFrame:
        return self.prepare(self.spark.read.schema(self.events_schema).parquet(self.events_path))

    # -- one re-run ----------------------------------------------------------
    def run_days(self, first: dt.date, last: dt.date) -> None:
        """Recompute the state for every day in [first, last], in order.

        The first day of a partition starts it anew from the day before it.
        """
        ev = self.events()
        day = first
        while day <= last:
            before = day - dt.timedelta(days=1)
            fresh = self.partition_of(day) != day or self.partition_of(before) == before
            # A day state continues the day before; a wider partition continues itself and starts empty.
            prev = self._read_partition(self.partition_of(before)) if fresh else self.empty_state
            # The state partition may be the one being replaced (monthly
            # arrays): materialise the input first, in the shared folder.
            prev = cut_lineage(prev)
            nxt = self.step(prev, ev, day)
            nxt = nxt.where(F.col(self.partition_col).cast("date") == F.lit(self.partition_of(day)))
            write_period(nxt, self.state_path, [self.partition_col], rewritten=[(self.partition_of(day),)])
            day += dt.timedelta(days=1)

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        """foreachBatch body: the batch only names the touched days."""
        days = batch.select(F.to_date(self.ts_col).alias("d")).distinct().collect()
        touched = [r.d for r in days if r.d is not None]
        if not touched:
            return
        known = [d for d in self._state_days() if d is not None]
        # Days after the last loaded partition are loaded too, named by a batch or not.
        first = min([min(touched)] + ([max(known) + dt.timedelta(days=1)] if known else []))
        last = self.events().agg(F.max(F.to_date(self.ts_col))).first()[0]
        self.run_days(self.partition_of(first), max(last, max(touched)))

    def start(self, checkpoint_location: str, available_now: bool = True):
        """Start the file stream over the event folder."""
        stream = self.prepare(self.spark.readStream.schema(self.events_schema).parquet(self.events_path))
        w = stream.writeStream.foreachBatch(self.on_batch).option("checkpointLocation", checkpoint_location)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
        return w.start()
