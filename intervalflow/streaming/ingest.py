"""Structured Streaming ingestion over landed files (ST1, ST5, ST6, ST11, D4), backfills
(ST9, ST10) and late data (ST8).

A stream reads landed Parquet/JSON files.  Each micro-batch is handled in ``foreachBatch``: merge
into the lake (K9, idempotent on the meter interval, so re-delivered records and a
batch replayed after a failure change nothing) and only then advance the high-water
state table (ST1, monotone ST6).  ``run_stream`` can also drop re-delivered records of a source without
such a key, within a watermark that the caller chooses (ST5).  ``trigger(availableNow=True)`` lets any outside
scheduler run it at the reference's cadence (ST11).  The checkpoint gives file-level
exactly-once; the state table gives key-level resume.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import state_key
from ..functions.timefns import ntz_lit, safe_horizon
from ..operators import heating as heat
from ..operators.quality import missing_intervals
from ..operators.rates import normalise_readings
from ..operators.recost import cost_touched, meter_days, recost
from ..session import scratch_path, staged
from ..sources import documents
from ..sinks import files, lake
from ..sinks.totals import update_daily_totals
from . import state as st

STATE_SCHEMA = T.StructType([T.StructField("source_key", T.StringType()),
                             T.StructField("last_interval", T.TimestampNTZType())])


#: Logs of marks that a reader combines before they are folded into one version.
FOLD_AFTER = 16


def _state_parts(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """Complete versions (``version=N``) and logs of marks (``marks-N``) of a state table, oldest first."""
    found = [n for n in files.names(spark, root) if n.startswith(("version=", "marks-"))]
    done = [n for n in found if files.exists(spark, f"{root}/{n}/_SUCCESS")]
    return sorted((int(n[-12:]), f"{root}/{n}") for n in done)


def _state_versions(spark: SparkSession, root: str) -> list[str]:
    """Complete versions of a state table, oldest first."""
    return [path for _, path in _state_parts(spark, root) if "/version=" in path]


def _since_version(spark: SparkSession, root: str) -> list[str]:
    """What makes up the state: the latest version, if there is one, and the logs after it."""
    parts = [path for _, path in _state_parts(spark, root)]
    start = max((i for i, path in enumerate(parts) if "/version=" in path), default=0)
    return parts[start:]


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """``(source_key, last_interval)``: for each key the largest mark of the latest version and the logs since."""
    parts = _since_version(spark, root)
    if not parts:
        return spark.createDataFrame([], STATE_SCHEMA)
    rows = spark.read.schema(STATE_SCHEMA).parquet(*parts)
    return rows if len(parts) == 1 else rows.groupBy("source_key").agg(F.max("last_interval").alias("last_interval"))


def _next_number(spark: SparkSession, root: str) -> int:
    parts = _state_parts(spark, root)
    return parts[-1][0] + 1 if parts else 1


def save_state(spark: SparkSession, state: DataFrame, root: str) -> None:
    """Write the whole state as a new version; readers take the latest complete one, so a crash at any
    time leaves the state before it.  The version before stays, with the logs after it; what is older goes."""
    before = _state_parts(spark, root)
    state.write.mode("overwrite").parquet(f"{root}/version={_next_number(spark, root):012d}")
    versions = [n for n, path in before if "/version=" in path]
    for number, path in before:
        if versions and number < versions[-1]:
            files.delete(spark, path)


def update_state(spark: SparkSession, rows: DataFrame, root: str, key: Sequence[str] | F.Column,
                 ts_col: str = "interval_start") -> None:
    """ST1/ST6: advance ``source_key -> max(ts)`` after the data write.

    The batch's own marks are appended to a log; since a reader takes the largest mark of a key, the state never goes back and a replay
    changes nothing.  The other keys' marks are not read or written, but for every ``FOLD_AFTER`` th time, when the logs are folded into
    a version."""
    k = state_key(*key) if isinstance(key, (list, tuple)) else key
    marks = st.high_water(rows.select(k.alias("source_key"), ts_col), ["source_key"], ts_col)
    marks.write.mode("overwrite").parquet(f"{root}/marks-{_next_number(spark, root):012d}")
    if len(_since_version(spark, root)) > FOLD_AFTER:
        save_state(spark, read_state(spark, root), root)


def run_stream(spark: SparkSession, source: DataFrame, handle_batch: Callable[[DataFrame, int], None],
               checkpoint: str | None = None, dedup_id: str | None = None, event_time: str | None = None,
               delay: str = "30 minutes") -> None:
    """Run a streaming DataFrame to completion with ``availableNow`` and a batch handler."""
    s = source
    if dedup_id and event_time:
        wm = event_time
        if isinstance(s.schema[event_time].dataType, T.TimestampNTZType):
            # watermarks need an instant (TIMESTAMP); UTC wall-clock -> instant via epoch micros
            from ..functions.timefns import epoch_ntz, micros_between
            wm = "_event_instant"
            s = s.withColumn(wm, F.timestamp_micros(micros_between(epoch_ntz(), event_time)))
        s = s.withWatermark(wm, delay).dropDuplicatesWithinWatermark([dedup_id])
        if wm != event_time:
            s = s.drop(wm)
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    q = (s.writeStream.foreachBatch(handle_batch).option("checkpointLocation", ckpt)
          .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def stream_consumption(spark: SparkSession, landing: str, landing_schema: T.StructType,
                       to_readings: Callable[[DataFrame], DataFrame], lake_root: str, state_root: str,
                       max_files_per_trigger: int = 2, checkpoint: str | None = None, late_root: str | None = None,
                       rates: DataFrame | None = None, costed_root: str | None = None, totals_root: str | None = None,
                       by: Sequence[str] = ("tariff_code",)) -> None:
    """L1 as a stream: landed files -> readings -> merge into the lake -> advance state.

    No reading is dropped for its age: the merge is idempotent on (meter, interval), which also takes care of re-delivered
    copies.  Readings that ended at or before their key's state at arrival go to ``late_root/epoch=`` as well (ST8), by default
    the lake's path with ``-late``; an epoch that is replayed replaces its own folder.

    With ``rates`` and ``costed_root`` each batch's partitions are costed again, late readings included, and with ``totals_root`` the totals
    of the batch's meters and days are summed again.
    """
    src = (spark.readStream.schema(landing_schema).option("maxFilesPerTrigger", max_files_per_trigger)
                .parquet(landing))
    late_root = late_root or lake_root.rstrip("/") + "-late"

    def handle(batch: DataFrame, epoch: int) -> None:
        readings = to_readings(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            _, late = split_late(readings, read_state(spark, state_root), state_key("mpan_mprn", "serial"))
            late.write.mode("overwrite").parquet(f"{late_root}/epoch={epoch}")
            lake.write_consumption(readings, lake_root)
            _after_merge(spark, readings, rates, lake_root, costed_root, totals_root, by)
            update_state(spark, readings, state_root, ["mpan_mprn", "serial"])
        finally:
            readings.unpersist()

    run_stream(spark, src, handle, checkpoint)


def _after_merge(spark: SparkSession, readings: DataFrame, rates: DataFrame | None, lake_root: str, costed_root: str | None,
                 totals_root: str | None, by: Sequence[str]) -> None:
    """Bring costs and totals up to date with readings that have just been merged."""
    if rates is not None and costed_root:
        cost_touched(spark, lake_root, costed_root, readings, rates, by)
        if totals_root:
            update_daily_totals(spark, costed_root, totals_root, meter_days(normalise_readings(readings)))


LEDGER = T.StructType([T.StructField("first_day", T.DateType()), T.StructField("last_day", T.DateType())])


def open_windows(spark: SparkSession, start: dt.date, end: dt.date, step_days: int, ledger_root: str | None) -> list[tuple[dt.date, dt.date]]:
    """The windows of ``step_days`` that ``[start, end]`` falls into, without those that the ledger has as finished."""
    days = range((end - start).days // step_days + 1) if start <= end else ()
    windows = [(start + dt.timedelta(days=i * step_days), min(end, start + dt.timedelta(days=(i + 1) * step_days - 1))) for i in days]
    done = {tuple(r) for r in lake.read_lake(spark, ledger_root, LEDGER).distinct().collect()} if ledger_root else set()
    return [w for w in windows if w not in done]


def backfill(readings: DataFrame, lake_root: str, start: dt.date, end: dt.date, step_days: int | None = None,
             prefer: str = "order", ledger_root: str | None = None, most: int | None = None) -> int:
    """ST9/ST10: load ``[start, end]`` (UTC days of ``interval_start``); how many windows are still open is returned.

    ``step_days=None`` loads the range as one job (Spark tasks replace the day loop).  With
    ``step_days`` the range is merged window by window; ``prefer='existing'`` never replaces
    intervals already in the lake (chunked backfill that keeps newer data).  The source is read once a run: the readings of the open windows
    are staged by window.  ``ledger_root`` records finished windows, so a run that stopped, or that was told to stop after ``most`` windows,
    is resumed by the same call.  Readings whose time does not parse join the lake's quarantine.
    """
    spark = readings.sparkSession
    norm = normalise_readings(readings.withColumn("_raw", F.struct(*readings.columns)))
    day = F.to_date("interval_start")
    # Only rejected rows need their raw columns; the others would be staged twice.
    norm = norm.withColumn("_raw", F.when(day.isNull(), F.col("_raw")))
    windows = open_windows(spark, start, end, step_days or max((end - start).days + 1, 1), ledger_root)
    todo = windows[:most] if most is not None else windows
    if not todo:
        return len(windows)
    number = F.floor(F.datediff(day, F.lit(start)) / (step_days or (end - start).days + 1)).cast("int")
    wanted = [(lo - start).days // (step_days or (end - start).days + 1) for lo, _ in todo]
    rows = norm.withColumn("_window", F.when(day.between(F.lit(start), F.lit(end)), number))
    path = scratch_path(spark, "backfill")
    known = rows.filter(day.isNull() | F.col("_window").isin(wanted))
    known.hint("rebalance", "_window").write.partitionBy("_window").parquet(path)
    kept = spark.read.schema(known.schema).option("basePath", path).parquet(path)
    bad = kept.filter(F.col("_window").isNull()).select(F.to_json("_raw").alias("row"))
    # Unreadable rows belong to no window: the run that begins with the first one records them.
    if todo[0][0] == start and not bad.isEmpty():
        lake.append_rejected(bad, lake_root.rstrip("/") + "-quarantine", "no interval_start")
    for window, n in zip(todo, wanted):
        lake.write_consumption(kept.filter(F.col("_window") == n).drop("_window", "_raw"), lake_root, prefer=prefer)
        if ledger_root:
            spark.createDataFrame([window], LEDGER).coalesce(1).write.mode("append").parquet(ledger_root)
    return len(windows) - len(todo)


def split_late(batch: DataFrame, state: DataFrame, key: F.Column, ts_col: str = "interval_end") -> tuple[DataFrame, DataFrame]:
    """ST8: rows whose interval ended before the key's state at arrival are late.

    Returns (on_time, late).  Late rows still go through the K9 merge, which recomputes
    exactly the partitions they touch; the late side table feeds the audit.  Both sides
    read ``state`` lazily: checkpoint them before the state table is replaced.
    """
    s = state.select(F.col("source_key").alias("_k"), F.col("last_interval").alias("_last"))
    j = batch.withColumn("_k", key).join(s, "_k", "left")
    late = F.col("_last").isNotNull() & (F.col(ts_col) <= F.col("_last"))
    return j.filter(~late).drop("_k", "_last"), j.filter(late).drop("_k", "_last")


def scheduled_load(spark: SparkSession, readings: DataFrame, rates: DataFrame, lake_root: str, costed_root: str,
                   state_root: str, now: dt.datetime, by: Sequence[str] = ("tariff_code",),
                   bootstrap_days: int = st.BOOTSTRAP_DAYS, rates_root: str | None = None, totals_root: str | None = None) -> DataFrame:
    """L1 + L3 wired as one batch run (X8): resume from state (ST2/ST3), safe horizon (P19), merge into the lake (K2/K9),
    cost exactly the touched lake partitions (J1, K4), advance state (ST1/ST6) and return
    the per-meter completeness of the batch (A1).

    A meter's window starts at its state less the overlap, or ``bootstrap_days`` before ``now``.  Re-running the same
    batch gives the same lake, state and costed tables.

    Nothing is dropped on the way.  Readings before their meter's window that the lake does not have came late (ST8): they are merged and costed like the
    others and recorded in ``<lake_root>-late``.  What lies before the first run's window was never asked for; a backfill loads it.  Readings whose times do not parse join ``<lake_root>-quarantine``.  With ``rates_root``, the rates
    of the run before are kept there, and readings whose rate has changed since are costed again (:func:`..operators.recost.recost`).  With
    ``totals_root`` the daily totals of all meters and days that were costed are brought up to date.
    """
    horizon = safe_horizon(ntz_lit(now))
    state = read_state(spark, state_root).select(F.col("source_key").alias("_k"), F.col("last_interval").alias("_last"))
    norm = normalise_readings(readings.withColumn("_raw", F.struct(*readings.columns)))
    known = F.col("interval_end").isNotNull() & F.col("interval_start").isNotNull()
    kind = (F.when(~known, F.lit("bad")).when(F.col("interval_end") > horizon, F.lit("early"))
            .when(F.col("interval_start") >= st.resume_start("_last", now, bootstrap_days), F.lit("ready"))
            .when(F.col("_last").isNotNull() & (F.col("interval_start") >= ntz_lit(_loaded_since(spark, state_root, now, bootstrap_days))), F.lit("older"))
            .otherwise(F.lit("before")))
    rows = (norm.withColumn("_k", state_key("mpan_mprn", "serial")).join(state, "_k", "left").withColumn("_kind", kind)
            .drop("_k", "_last").filter(F.col("_kind").isin("bad", "ready", "older")).persist(StorageLevel.MEMORY_AND_DISK))
    try:
        found = {r["_kind"] for r in rows.select("_kind").distinct().collect()}
        if "bad" in found:
            lake.append_rejected(rows.filter("_kind = 'bad'").select(F.to_json("_raw").alias("row")), lake_root.rstrip("/") + "-quarantine", "no time")
        ready = rows.filter("_kind = 'ready'").drop("_kind", "_raw")
        load = ready
        if "older" in found:
            late = staged(_not_stored(spark, rows.filter("_kind = 'older'").drop("_kind", "_raw"), lake_root), "late")
            if not late.isEmpty():
                late.write.mode("append").parquet(lake_root.rstrip("/") + "-late")
                load = ready.unionByName(late)
        lake.write_consumption(load, lake_root)
        before = _latest(spark, rates_root) if rates_root else None
        changed = recost(spark, lake_root, costed_root, before, rates, by) if before is not None else None
        if changed is not None and totals_root:
            update_daily_totals(spark, costed_root, totals_root, changed)
        _after_merge(spark, load, rates, lake_root, costed_root, totals_root, by)
        if rates_root:
            save_state(spark, rates, rates_root)
        update_state(spark, load, state_root, ["mpan_mprn", "serial"])
        done = staged(missing_intervals(ready, ["kind", "mpan_mprn", "serial"]), "completeness")
    finally:
        rows.unpersist()
    return done


def _loaded_since(spark: SparkSession, state_root: str, now: dt.datetime, bootstrap_days: int) -> str:
    """Where the first run's window began, kept beside the state."""
    path = state_root.rstrip("/") + "-since/start.txt"
    if not files.exists(spark, path):
        files.write_text(spark, path, (now - dt.timedelta(days=bootstrap_days)).strftime("%Y-%m-%d %H:%M:%S"))
    return files.read_text(spark, path).strip()


def _latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The last complete version of a table that ``save_state`` writes."""
    versions = _state_versions(spark, root)
    return spark.read.parquet(versions[-1]) if versions else None


def _not_stored(spark: SparkSession, readings: DataFrame, lake_root: str) -> DataFrame:
    """Readings whose (meter, interval) the lake does not have; only the partitions they belong to are read."""
    prepared = lake.prepare_consumption(readings)
    schema = lake.saved_schema(spark, lake_root) or lake.CONSUMPTION_LAKE
    stored = lake.touched_partitions(spark, lake_root, schema, prepared.select(*lake.CONSUMPTION_PARTS).distinct(), lake.CONSUMPTION_PARTS)
    if stored is None:
        return readings
    keys = stored.select(*[F.col(c).alias(f"_s_{c}") for c in lake.CONSUMPTION_KEYS])
    same = None
    for c in lake.CONSUMPTION_KEYS:
        eq = F.col(c).eqNullSafe(F.col(f"_s_{c}"))
        same = eq if same is None else same & eq
    return readings.join(keys, same, "left_anti")


def heating_load(spark: SparkSession, reports: DataFrame, lake_root: str, state_root: str, now: dt.datetime,
                 lookback_hours: int = 1) -> None:
    """Heating load as one run: per-device start (ST4), skip of earlier reports, parse, newer than state (F8), write (K5-K8),
    advance state (A3).

    ``reports(device_id, zone_id, date, value)``.  A device starts at midnight of its last processed day, or ``lookback_hours``
    before ``now``; of that day's report only records after the state are new.  Reports that do not parse and records without a time
    join ``<lake_root>-quarantine``.
    """
    state = read_state(spark, state_root).select(F.col("source_key").alias("_k"), "last_interval")
    due = (reports.withColumn("_k", state_key("device_id", "zone_id")).join(state, "_k", "left")
           .filter(F.col("date") >= F.to_date(st.heating_resume_start("last_interval", now, lookback_hours))).drop("_k", "last_interval"))
    load_reports(spark, due, lake_root, state_root)


def load_reports(spark: SparkSession, reports: DataFrame, lake_root: str, state_root: str, keep_late: bool = False,
                 epoch: int | None = None) -> None:
    """Parse day reports, write the records, keep aside what cannot be used, advance the state.

    Records at or before their device's state are dropped (ST7), or with ``keep_late`` stored like the others and recorded in
    ``<lake_root>-late`` as well.  An ``epoch`` has folders of its own in the side tables, which a replay writes anew."""
    parsed = heat.parse_day_reports(reports).persist(StorageLevel.MEMORY_AND_DISK)
    state = read_state(spark, state_root).select(F.col("source_key").alias("_k"), "last_interval")
    mode, part = ("append", "") if epoch is None else ("overwrite", f"/epoch={epoch}")
    try:
        records = heat.heating_records(parsed, keep_invalid=True).withColumn("_k", state_key(F.coalesce("trv_id", "device_id"), "zone_id"))
        records = records.persist(StorageLevel.MEMORY_AND_DISK)
        unreadable, timeless = heat.unparsable_reports(parsed), records.filter("timestamp IS NULL").drop("_k")
        bad = unreadable.select(F.to_json(F.struct(*unreadable.columns)).alias("row"), F.lit("unreadable report").alias("reason")).unionByName(
            timeless.select(F.to_json(F.struct(*timeless.columns)).alias("row"), F.lit("no timestamp").alias("reason")))
        if epoch is not None or not bad.isEmpty():
            bad.write.mode(mode).parquet(lake_root.rstrip("/") + "-quarantine" + part)
        timed = records.filter("timestamp IS NOT NULL")
        fresh = timed
        if keep_late:
            late = st.newer_than_state(timed, state, ["_k"], keep="late").drop("_k")
            late.write.mode(mode).parquet(lake_root.rstrip("/") + "-late" + part)
        else:
            fresh = st.newer_than_state(timed, state, ["_k"])
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lake.write_heating(fresh.drop("_k"), lake_root)
            update_state(spark, fresh, state_root, F.col("_k"), "timestamp")
        finally:
            fresh.unpersist()
            records.unpersist()
    finally:
        parsed.unpersist()


def stream_reports(spark: SparkSession, landing: str, lake_root: str, state_root: str, max_files_per_trigger: int = 10_000,
                   checkpoint: str | None = None, packed: bool = False) -> None:
    """L2 as a stream: day reports land as JSON documents below ``zone_id=/date=`` folders, in any order, in files of their own or ``packed``.

    Zone and date come from the path.  No record is dropped for its age: the sink replaces records of the same device, sensor and time, so
    a report that is landed again, or a batch that is replayed, changes nothing; records at or before their device's state at arrival are
    recorded in ``<lake_root>-late/epoch=``.  Files that do not parse and records without a time go to ``<lake_root>-quarantine/epoch=``."""
    reports = documents.read_day_reports(spark, landing, streaming=True, max_files=max_files_per_trigger, packed=packed)
    run_stream(spark, reports, lambda batch, epoch: load_reports(spark, batch, lake_root, state_root, keep_late=True, epoch=epoch), checkpoint)
