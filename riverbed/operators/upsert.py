"""Keyed upsert (H1, H2), high-water marks (G3, H3) and new-or-newer deltas.

``merge_frames`` is the pure DataFrame form: (target, source) -> new target,
one ``full_outer`` join on the key. ``KeyedTable`` persists the same result on
plain Parquet, without a MERGE-capable table format, as append-only batches:

* a merge writes the batch, and nothing else, as one folder
  ``data/_kind=delta/_seq=<n>/_batch=<id>/_nulls=<rule>``. Its cost follows the
  batch, whatever the size of the table. Spark's ``_SUCCESS`` marker commits
  it: an attempt that died is not read, and a batch id whose folder is
  committed is not applied again (exactly-once effect on top of at-least-once
  delivery, for late ids too);
* ``read`` resolves the batches by key: the latest row (H2), or, with tracked
  columns, the row of the key's last change with that change's stamp (H1);
* ``compact`` writes the resolved rows as a base folder, from which later
  reads start. A merge calls it once ``compact_after`` batches follow the last
  base, so a read never resolves more than that.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbed.functions.parse import any_distinct, ntz
from riverbed.operators.dedupe import latest_keep_null_keys, latest_per_key
from riverbed.session import glob_paths

_SRC, _TGT = "_src_present", "_tgt_present"
_SEQ, _NULLS = "_seq", "_nulls"
COMPACT_AFTER = 64


def high_water_mark(target: DataFrame | None, col: str, default=None):
    """``MAX(col)`` of the target as a driver literal (one value).

    ``default`` replaces the NULL mark of an empty target (Q3 safe mode);
    pass ``None`` for the literal mode in which ``x > NULL`` keeps nothing."""
    if target is None:
        return default
    mark = target.agg(F.max(col).alias("m")).first()["m"]
    return default if mark is None else mark


def after_mark(df: DataFrame, col: str, mark, literal_mode: bool = False) -> DataFrame:
    """H3: strict ``col > mark``. With a literal mark Parquet row groups are
    skipped by min/max statistics. In literal mode a NULL mark keeps nothing
    (the reference's behaviour on an empty target, Q3)."""
    if mark is None:
        return df.filter(F.lit(False)) if literal_mode else df
    lit = ntz(mark) if isinstance(mark, (_dt.datetime, _dt.date)) else F.lit(mark)
    return df.filter(F.col(col) > lit)


def new_or_newer(source: DataFrame, target: DataFrame | None, keys: Sequence[str],
                 ts_col: str) -> DataFrame:
    """Source rows whose key is new or whose ``ts_col`` is newer than the
    target's. A NULL time on either side of a matched row means "not newer".
    Written as a left join on the key (the target side is only (key, ts))."""
    if target is None:
        return source
    t = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(ts_col).alias("_t_ts"))
    cond = [source[k] == t[f"_t_{k}"] for k in keys]
    joined = source.join(t, cond, "left")
    keep = F.col(f"_t_{keys[0]}").isNull() | (F.col(ts_col) > F.col("_t_ts"))
    return joined.filter(keep).select(*source.columns)


def null_key_rows(keys: Sequence[str]) -> Column:
    """Rows with a NULL in any key column (they can never match a target row)."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def stamp_literal(value) -> Column:
    """A batch stamp as a literal; datetimes become zone-free TIMESTAMP_NTZ."""
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        return ntz(value)
    return F.lit(value)


def merge_frames(target: DataFrame | None, source: DataFrame, keys: Sequence[str], *,
                 tracked: Sequence[str] | None = None,
                 stamp: tuple[str, object] | None = None,
                 order: Sequence[Column | str] | None = None) -> DataFrame:
    """Apply ``source`` to ``target`` by key and return the whole new target.

    * ``tracked=None`` (H2): a matched row takes all source values.
    * ``tracked=[...]`` (H1): a matched row is updated only when one tracked
      column IS DISTINCT FROM the target's; otherwise the target row stays,
      including its stamp.
    * ``stamp=(col, value)`` sets ``col`` on inserted and updated rows.
    * ``order``: the source is first reduced to its latest row per key (Q5).

    Source rows with a NULL key never match; they are inserted unchanged
    (callers that quarantine them filter first). Columns missing from the
    source keep the target value (for example a stamp kept on no-change).
    """
    if order is not None:
        source = latest_per_key(source, keys, order)
    if stamp is not None:
        source = source.withColumn(stamp[0], stamp_literal(stamp[1]))
    if target is None:
        return source
    cols = target.columns
    types = {f.name: f.dataType for f in target.schema.fields}
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns], F.lit(True).alias(_SRC))
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias(_TGT))
    j = t.join(s, [t[f"_t_{k}"] == s[f"_s_{k}"] for k in keys], "full_outer")
    src_in, tgt_in = F.col(_SRC).isNotNull(), F.col(_TGT).isNotNull()
    if tracked is None:
        take_src = src_in
    else:
        changed = any_distinct([F.col(f"_t_{c}") for c in tracked],
                               [F.col(f"_s_{c}") for c in tracked])
        take_src = src_in & (~tgt_in | changed)
    out = []
    for c in cols:
        if c in source.columns:
            out.append(F.when(take_src, F.col(f"_s_{c}").cast(types[c]))
                        .otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*out)


class Folder(NamedTuple):
    """One committed batch or base of a keyed table, read off its path."""
    kind: str   # "delta" or "base"
    seq: int    # order of commit
    batch: int  # source batch id, -1 for none
    nulls: str  # "quarantine" or "insert": what its NULL-key rows are

    @property
    def path(self) -> str:
        return f"_kind={self.kind}/{_SEQ}={self.seq}/_batch={self.batch}/{_NULLS}={self.nulls}"


class KeyedTable:
    """A keyed Parquet table of append-only batches (see module docstring).

    One writer per table, as with the reference's single task per target;
    any number of readers."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], *,
                 tracked: Sequence[str] | None = None, mark_col: str | None = None,
                 compact_after: int | None = COMPACT_AFTER):
        """``tracked`` (H1): a batch row counts as a change only when one of
        these columns IS DISTINCT FROM the key's previous row; otherwise the
        earlier row stays, stamp included. None (H2): the latest row counts.
        ``mark_col``: the column of the high-water mark (G3).
        ``compact_after``: most batches since the last base (None: no limit)."""
        self.compact_after = compact_after
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        self.tracked, self.mark_col = None if tracked is None else list(tracked), mark_col
        self.refresh()

    # -- state: the committed folders -----------------------------------------
    def refresh(self) -> None:
        self._known: list[Folder] | None = None
        self._schema: T.StructType | None = None
        self._mark, self._mark_known = None, False

    def _folders(self) -> list[Folder]:
        """Committed folders in commit order (one listing of names, then kept
        up to date by this writer's own commits)."""
        if self._known is None:
            done = glob_paths(self.spark, f"{self.root}/data/_kind=*/{_SEQ}=*/_batch=*/{_NULLS}=*/_SUCCESS")
            parts = [[x.split("=", 1)[1] for x in p.split("/")[-5:-1]] for p in done]
            self._known = sorted((Folder(k, int(q), int(b), n) for k, q, b, n in parts), key=lambda f: f.seq)
        return self._known

    def _live(self) -> list[Folder]:
        """The newest base and the batches after it."""
        folders = self._folders()
        base = max((i for i, f in enumerate(folders) if f.kind == "base"), default=0)
        return folders[base:]

    def exists(self) -> bool:
        return bool(self._folders())

    def version(self) -> int | None:
        return self._folders()[-1].seq if self.exists() else None

    def applied_batches(self) -> frozenset:
        return frozenset(f.batch for f in self._folders() if f.batch >= 0)

    def schema(self) -> T.StructType:
        """The columns of the committed folder that the table starts from: the
        newest base, or its first batch (later batches take their types)."""
        if self._schema is None:
            self._schema = self.spark.read.parquet(f"{self.root}/data/{self._live()[0].path}").schema
        return self._schema

    def mark(self):
        """Maximum of ``mark_col`` over everything merged (None when empty).
        Merges report their batch's maximum with the write; a fresh handle
        scans that one column once."""
        if not self._mark_known and self.exists():
            self._mark = self._scan(self._folders()).agg(F.max(self.mark_col)).first()[0]
        self._mark_known = True
        return self._mark

    # -- reads ------------------------------------------------------------------
    def _scan(self, folders: Sequence[Folder]) -> DataFrame:
        extra = [T.StructField(_SEQ, T.LongType()), T.StructField(_NULLS, T.StringType())]
        data = f"{self.root}/data"
        rows = (self.spark.read.schema(T.StructType([*self.schema().fields, *extra]))
                .option("basePath", data).parquet(*[f"{data}/{f.path}" for f in folders]))
        return rows.select(*self.schema().names, _SEQ, _NULLS)

    def _resolve(self, folders: Sequence[Folder], only: DataFrame | None = None) -> DataFrame:
        """One row per key, and the NULL-key rows that were inserted. The H2
        form ships at most one row per key and task, and nothing of a base that
        small batches follow; the H1 form compares a key's rows in order, at
        most one per batch since the last base."""
        rows, null_key = self._scan(folders), null_key_rows(self.keys)
        if only is not None:
            names = {c: f"_o{i}" for i, c in enumerate(only.columns)}
            match = F.lit(True)
            for c, o in names.items():
                match = match & F.col(c).eqNullSafe(F.col(o))
            rows = rows.join(only.withColumnsRenamed(names), match, "left_semi")
        inserted = any(f.nulls == "insert" for f in folders)
        if len(folders) == 1:  # a folder holds one row per key
            out = rows if inserted else rows.filter(~null_key)
            return out.drop(_SEQ, _NULLS)
        keyed = rows.filter(~null_key)
        if self.tracked is None and folders[0].kind == "base":
            # The base gives way to the batches after it by their keys alone:
            # they are broadcast while they are small, and it is not shuffled.
            base = keyed.filter(F.col(_SEQ) == folders[0].seq)
            newer = latest_per_key(keyed.filter(F.col(_SEQ) > folders[0].seq), self.keys, [F.col(_SEQ).desc()])
            out = base.join(newer.select(*self.keys), self.keys, "left_anti").select(*newer.columns).unionByName(newer)
        elif self.tracked is None:
            out = latest_per_key(keyed, self.keys, [F.col(_SEQ).desc()])
        else:
            in_order = Window.partitionBy(*self.keys).orderBy(_SEQ)
            changed = (F.row_number().over(in_order) == 1) | any_distinct(
                [F.lag(c).over(in_order) for c in self.tracked], [F.col(c) for c in self.tracked])
            last = F.max(F.when(F.col("_changed"), F.col(_SEQ))).over(Window.partitionBy(*self.keys))
            out = (keyed.withColumn("_changed", changed).withColumn("_last", last)
                   .filter(F.col(_SEQ) == F.col("_last")).drop("_changed", "_last"))
        if inserted:
            out = out.unionByName(rows.filter(null_key & (F.col(_NULLS) == "insert")))
        return out.drop(_SEQ, _NULLS)

    def read(self) -> DataFrame:
        if not self.exists():
            raise FileNotFoundError(f"no committed batch under {self.root}")
        return self._resolve(self._live())

    def read_or_none(self) -> DataFrame | None:
        return self.read() if self.exists() else None

    def changes_since(self, version: int | None) -> DataFrame:
        """Current rows of the keys delivered after ``version`` (None: all),
        so that an incremental consumer reads those batches, not the table.
        Past a newer base the whole table is returned."""
        live = self._live()
        if version is None or live[0].kind == "base" and live[0].seq > version:
            return self.read()
        after = [f for f in live if f.seq > version]
        if not after:
            return self.read().limit(0)
        if self.tracked is None:
            return self._resolve(after)
        keys = self._scan(after).select(*self.keys).distinct()
        return self.read().join(keys, self.keys, "left_semi")

    def offset(self) -> int:
        """The newest applied batch: where a consumer that applies batches in
        order goes on (-1: at the start)."""
        return max(self.applied_batches(), default=-1)

    def changes_after(self, batch_id: int) -> DataFrame:
        """``changes_since`` for consumers that keep a batch id: the current
        rows of the keys delivered by batches past it."""
        after = [f.seq for f in self._folders() if f.batch > batch_id]
        return self.changes_since(min(after) - 1 if after else self.version())

    def read_matching(self, keys: DataFrame) -> DataFrame:
        """The current rows whose ``keys.columns`` are among ``keys``. These
        columns are the same in all rows of a table key (the key, or part of
        it, or what it stands for), so other rows go before batches are resolved
        and never cross the network."""
        if not self.exists():
            raise FileNotFoundError(f"no committed batch under {self.root}")
        return self._resolve(self._live(), keys)

    def quarantined(self) -> DataFrame | None:
        """Every NULL-key row set aside by a merge (None without a table)."""
        if not self.exists():
            return None
        rows = self._scan(self._folders())
        return (rows.filter(null_key_rows(self.keys) & (F.col(_NULLS) == "quarantine"))
                .drop(_SEQ, _NULLS))

    # -- writes -----------------------------------------------------------------
    def _commit(self, kind: str, df: DataFrame, batch_id: int | None, nulls: str) -> None:
        """Write ``df`` as the next folder; the batch's mark comes from the
        same job (``Observation``). What a dead attempt left is overwritten."""
        seq = self.version() + 1 if self.exists() else 0
        folder = Folder(kind, seq, -1 if batch_id is None else batch_id, nulls)
        before = None if kind == "base" or self.mark_col is None else self.mark()
        mark = F.max(self.mark_col or F.lit(None)).alias("mark")
        obs = Observation(f"riverbed-{uuid.uuid4().hex[:8]}")
        (df.observe(obs, F.count(F.lit(1)).alias("rows"), mark)
         .write.mode("overwrite").parquet(f"{self.root}/data/{folder.path}"))
        self._mark = max((m for m in (before, obs.get["mark"]) if m is not None), default=None)
        self._mark_known = True
        self._known = [*self._folders(), folder]
        if kind == "base":
            self._schema = None

    def create_if_missing(self, schema: T.StructType) -> bool:
        """``CREATE TABLE IF NOT EXISTS`` (an empty base)."""
        if self.exists():
            return False
        self._commit("base", self.spark.createDataFrame([], schema), None, "quarantine")
        return True

    def _one_row_per_key(self, df: DataFrame, on_duplicates: str) -> None:
        if on_duplicates not in ("error", "unique"):
            raise ValueError("on_duplicates is 'error' or 'unique'")
        if on_duplicates == "error":
            twice = (df.filter(~null_key_rows(self.keys)).groupBy(*self.keys)
                     .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
            if not twice.isEmpty():
                raise ValueError(f"more than one row for a key of {self.root}")

    def overwrite(self, df: DataFrame, batch_id: int | None = None, on_duplicates: str = "error") -> None:
        """Full build (A14 'table'): one row per key, and all NULL-key rows."""
        self._one_row_per_key(df, on_duplicates)
        self._commit("base", df, batch_id, "insert")

    def compact(self) -> None:
        """Write the resolved rows as a new base; the result does not change."""
        nulls = "insert" if any(f.nulls == "insert" for f in self._live()) else "quarantine"
        mark = self.mark() if self.mark_col is not None else None
        self._commit("base", self.read(), None, nulls)
        self._mark = mark  # quarantined rows count towards it

    def merge(self, source: DataFrame, *, stamp: tuple[str, object] | None = None,
              order: Sequence[Column | str] | None = None, batch_id: int | None = None,
              null_keys: str = "quarantine", on_duplicates: str = "error") -> bool:
        """Upsert ``source``; returns False when ``batch_id`` was already applied.

        The source holds one row per key, whatever the table holds: ``order``
        reduces it to that (Q5), else a source with more is refused, at the
        price of a count by key; ``on_duplicates="unique"`` is the caller's word
        that there is one, as for sources that were just reduced by key. NULL keys never match, so each delivery would insert
        them again: they are set aside (``quarantined``), all of them, unless
        ``null_keys="insert"`` asks for the reference's behaviour. Columns the
        source lacks keep the table's values."""
        if batch_id is not None and batch_id in self.applied_batches():
            return False
        null_key = null_key_rows(self.keys)
        if order is not None:
            source = latest_keep_null_keys(source, self.keys, order)
        else:
            self._one_row_per_key(source, on_duplicates)
        if stamp is not None:
            source = source.withColumn(stamp[0], stamp_literal(stamp[1]))
        if self.exists():
            fields = self.schema().fields
            missing = [f.name for f in fields if f.name not in source.columns]
            if missing:
                source = source.join(self.read().filter(~null_key).select(*self.keys, *missing), self.keys, "left")
            source = source.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        self._commit("delta", source, batch_id, null_keys)
        if self.compact_after is not None and len(self._live()) > self.compact_after:
            self.compact()
        return True
