"""Dependent models refreshed in order.

The reference declares derived tables with a target lag and lets its engine
refresh them in dependency order. Here a ``Pipeline`` is a dict of model name
-> (dependencies, function of the dependencies' DataFrames). ``refresh``
evaluates the requested models in topological order, writes the ones given
a path (a derived table: lineage cut, later readers scan Parquet) and
reports one run row per model, failed ones included, to a ``RunLog`` (the
source of M4 and M8). The lag values of the reference become trigger
intervals of whoever calls ``refresh``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riverbed.operators.monitor import RUN_COLS

Model = Callable[..., DataFrame]
RUN_SCHEMA = ("name string, state string, refresh_action string, scheduled_time timestamp_ntz, "
              "start_time timestamp_ntz, end_time timestamp_ntz, row_count bigint")


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class Run:
    name: str
    state: str
    refresh_action: str
    scheduled_time: dt.datetime
    start_time: dt.datetime
    end_time: dt.datetime | None = None
    row_count: int | None = None


class RunLog:
    """Run rows of tasks and models, appended to ``path`` by ``flush`` (one
    small file; a handful of rows per call). Without a path they are only held."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path
        self.held: list[Run] = []

    @contextmanager
    def run(self, name: str, action: str, scheduled: dt.datetime | None = None) -> Iterator[Run]:
        """One run: SUCCEEDED when the block ends, FAILED when it raises."""
        start = utc_now()
        row = Run(name, "SUCCEEDED", action, scheduled or start, start)
        try:
            yield row
        except BaseException:
            row.state = "FAILED"
            raise
        finally:
            row.end_time = utc_now()
            self.held.append(row)

    def rows(self) -> DataFrame:
        return self.spark.createDataFrame([tuple(vars(r).values()) for r in self.held], RUN_SCHEMA).select(*RUN_COLS)

    def flush(self) -> None:
        if self.held and self.path is not None:
            self.rows().coalesce(1).write.mode("append").parquet(self.path)
            self.held = []


def stream_runs(query, name: str, rows_of_epoch: Mapping[int, int] | None = None) -> list[Run]:
    """M4 / M8 from a streaming query's own progress: one run per micro-batch
    that had input (its trigger's start and duration; ``rows_of_epoch`` gives
    the rows where the source's count is not what was loaded), and a failed one
    when the query ended with an exception."""
    out = []
    for p in query.recentProgress:
        if p["numInputRows"] == 0:
            continue
        start = dt.datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).replace(tzinfo=None)
        took = dt.timedelta(milliseconds=p["durationMs"]["triggerExecution"])
        rows = (rows_of_epoch or {}).get(p["batchId"], p["numInputRows"])
        out.append(Run(name, "SUCCEEDED", "INCREMENTAL", start, start, start + took, rows))
    if query.exception() is not None:
        now = utc_now()
        begun = out[-1].end_time if out else now
        out.append(Run(name, "FAILED", "INCREMENTAL", begun, begun, now))
    return out


class Pipeline:
    def __init__(self, sources: Mapping[str, DataFrame]):
        self.sources = dict(sources)
        self.models: dict[str, tuple[tuple[str, ...], Model]] = {}

    def model(self, name: str, deps: Sequence[str]):
        def register(fn: Model) -> Model:
            self.models[name] = (tuple(deps), fn)
            return fn
        return register

    def order(self, targets: Sequence[str] | None = None) -> list[str]:
        """Topological order of the targets and everything they read."""
        out: list[str] = []
        visiting: set[str] = set()

        def visit(n: str) -> None:
            if n in out or n in self.sources:
                return
            if n in visiting:
                raise ValueError(f"cycle through {n}")
            visiting.add(n)
            for d in self.models[n][0]:
                visit(d)
            visiting.discard(n)
            out.append(n)

        for n in targets or list(self.models):
            visit(n)
        return out

    def refresh(self, spark: SparkSession, targets: Sequence[str] | None = None,
                paths: Mapping[str, str] | None = None, log: RunLog | None = None,
                on_failure: str = "raise") -> tuple[dict[str, DataFrame], DataFrame]:
        """Evaluate models in order; models with a path are written (FULL
        refresh) and re-read. Returns the frames and the run rows, which
        ``log`` also stores, whatever happens. After a failure, "raise" ends
        the refresh; "continue" goes on with the models that do not read the
        failed one, those that do get the state UPSTREAM_FAILED."""
        frames: dict[str, DataFrame] = dict(self.sources)
        log, scheduled, failed = log or RunLog(spark), utc_now(), set()
        first = len(log.held)
        try:
            for name in self.order(targets):
                deps, fn = self.models[name]
                if failed & set(deps):
                    failed.add(name)
                    now = utc_now()
                    log.held.append(Run(name.upper(), "UPSTREAM_FAILED", "NONE", scheduled, now, now))
                    continue
                try:
                    with log.run(name.upper(), "FULL", scheduled) as run:
                        df = fn(*[frames[d] for d in deps])
                        if paths and name in paths:
                            # the row count comes from the write itself (no second pass)
                            obs = Observation(f"refresh-{name}-{uuid.uuid4().hex[:8]}")
                            (df.observe(obs, F.count(F.lit(1)).alias("rows"))
                             .write.mode("overwrite").parquet(paths[name]))
                            run.row_count = obs.get["rows"]
                            df = spark.read.parquet(paths[name])
                        frames[name] = df
                except Exception:
                    if on_failure == "raise":
                        raise
                    failed.add(name)
        finally:
            done = RunLog(spark)
            done.held = log.held[first:]
            log.flush()
        return frames, done.rows()


def fraud_v2(raw: Mapping[str, DataFrame]) -> Pipeline:
    """The V2 derived tables as a pipeline over the three raw tables."""
    from riverbed.plans import fraud

    p = Pipeline(raw)
    p.model("dt_transactions", ["raw_trans"])(fraud.stg_transactions)
    p.model("dt_merchants", ["raw_merch"])(
        lambda m: fraud.dim_merchants_cols(fraud.merchants_latest(fraud.stg_merchants(m))))
    p.model("dt_clients_deduped", ["raw_clients"])(
        lambda c: fraud.clients_deduped(fraud.stg_clients(c)))
    p.model("dt_clients_scd2", ["dt_clients_deduped"])(fraud.clients_scd2)
    p.model("dt_invalid_trans", ["dt_transactions"])(fraud.quarantine)
    p.model("dt_fraud_full", ["dt_transactions", "dt_merchants", "dt_clients_scd2"])(fraud.enriched_fact)
    return p
