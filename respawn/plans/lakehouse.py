"""Lazy medallion pipeline over a folder of benchmark tables.

``Lakehouse(spark, sf_dir)`` exposes every layer as a DataFrame. The parsed silver
candidates and the daily history are written once per application (see
:class:`Lakehouse`); everything else is lazy and reads them. For scheduled runs the layer jobs in
:mod:`respawn.plans.layers` write every layer as a partitioned table.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respawn.constants import PLAUSIBLE_DAYS
from respawn.operators import gold, silver
from respawn.operators.bi import score_with_standin
from respawn.session import modified, scratch_path
from respawn.sources.driver import raw_events, read_table

# Tables written by this process: (app id, source dir, mtime, name) -> path.
_WRITTEN: dict[tuple, str] = {}


class Lakehouse:
    """Medallion layers over ``sf_dir``.

    ``materialize=True`` (default) writes the cleaned silver table once -- as
    parquet in the shared checkpoint folder (``spark.checkpoint.dir``) -- and
    every downstream layer reads it back: the de-duplication shuffle runs once,
    lineage is cut (an executor loss re-reads parquet instead of recomputing
    raw -> silver), and later filters / projections are pushed into the scan.
    ``materialize=False`` keeps everything as one lazy plan. ``as_of`` defaults to the last
    day of the events. The intermediate tables go with :func:`respawn.session.clear_scratch`.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=None, materialize: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self._as_of = as_of
        self.materialize = materialize

    @cached_property
    def days(self) -> tuple[dt.date, dt.date]:
        """First and last plausible day of the events (a scan of one column)."""
        day = F.to_date("ts")
        known = F.when(day.between(*(F.lit(d).cast("date") for d in PLAUSIBLE_DAYS)), day)
        row = self.table("events").agg(F.min(known), F.max(known)).first()
        day = dt.date(1970, 1, 1)  # an empty table has no days; any will do
        return row[0] or day, row[1] or day

    @cached_property
    def as_of(self) -> dt.date:
        return self.days[1] if self._as_of is None else gold.as_date(self._as_of)

    def _written(self, name: str, build, partition_by: list[str] | None = None) -> DataFrame:
        """Read table ``name`` written by this app, writing ``build()`` first if needed
        (the upstream plan is only constructed when the table does not exist yet)."""
        changed = modified(self.spark, f"{self.sf_dir.rstrip('/')}/events.parquet")
        key = (self.spark.sparkContext.applicationId, self.sf_dir, changed, name)
        path = _WRITTEN.get(key)
        if path is None:
            path = scratch_path(self.spark, f"{uuid.uuid4().hex}/{name}")
            df = build()
            if partition_by:
                from respawn.sources.files import cluster_for_partitions
                df = cluster_for_partitions(df, partition_by)
            w = df.write.mode("overwrite")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
            _WRITTEN[key] = path
        return self.spark.read.parquet(path)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        """The raw envelope: a projection of the events table, never copied."""
        return raw_events(self.spark, self.sf_dir)

    @cached_property
    def bronze(self) -> DataFrame:
        return silver.bronze_events(self.raw)

    @cached_property
    def cleaned_candidates(self) -> DataFrame:
        """Typed, de-duplicated, parsed events *before* the cleaned-table rules
        (written once; rule metrics and the cleaned table both read it)."""
        def build():
            return silver.parse_events(silver.dedup_events(silver.typed_events(self.bronze)))
        return self._written("player_events_parsed", build, ["event_date"]) if self.materialize else build()

    @cached_property
    def cleaned(self) -> DataFrame:
        """C1 output: the candidates that pass the drop rules (the rule filters
        are pushed into the parquet scan)."""
        from respawn.operators import dq
        return dq.expect(self.cleaned_candidates, dq.CLEANED_RULES)

    @cached_property
    def sessions(self) -> DataFrame:
        return silver.sessions_from_end_events(self.cleaned)

    @cached_property
    def purchases(self) -> DataFrame:
        return silver.purchase_events(self.cleaned)

    @cached_property
    def churn(self) -> DataFrame:
        return gold.churn_features(self.cleaned, None, None, self.as_of)

    @cached_property
    def arpu(self) -> DataFrame:
        return gold.arpu_features(None, self.cleaned, self.as_of)

    @cached_property
    def segments(self) -> DataFrame:
        return gold.player_segments(self.churn)

    @cached_property
    def scores(self) -> DataFrame:
        """Churn scores with the deterministic stand-in probability (see bi)."""
        return score_with_standin(self.churn)

    def history(self, start=None, end=None) -> DataFrame:
        """K6 output written as a gold table partitioned by ``compute_date``
        (so a latest-date filter prunes partitions); by default for every day of the events."""
        start, end = start or self.days[0], end or self.days[1]

        def build():
            return gold.churn_history(self.cleaned, None, None, start, end)
        if not self.materialize:
            return build()
        return self._written(f"churn_history_{start}_{end}", build, ["compute_date"]).select(*gold.CHURN_COLUMNS)

    def _once(self, name: str, build) -> str:
        """A scratch folder that ``build(path)`` fills once per application and source."""
        changed = modified(self.spark, f"{self.sf_dir.rstrip('/')}/events.parquet")
        key = (self.spark.sparkContext.applicationId, self.sf_dir, changed, name)
        if key not in _WRITTEN:
            path = scratch_path(self.spark, f"{uuid.uuid4().hex}/{name}")
            build(path)
            _WRITTEN[key] = path
        return _WRITTEN[key]

    def landing(self) -> str:
        """A folder with the raw events as CSV files."""
        from respawn.sources.files import export_csv
        return self._once("landing", lambda path: export_csv(self.raw, path))

    def lake(self, *parts: str) -> str:
        """A path in a lake whose bronze layer was ingested from :meth:`landing` by the stream."""
        from respawn.plans import layers
        root = self._once("lake", lambda path: layers.build_bronze(self.spark, self.landing(), path))
        return "/".join([root, *parts])
