"""Partitioned Parquet lake: writers (K1-K11) and readers.

Writes
------
* Rows are routed with the ``rebalance`` hint on the partition columns: AQE then splits a
  hot partition over several tasks (several files in its folder) and packs small ones
  together, instead of one task per partition value as a plain ``repartition`` would.
* Partition replace is idempotent (K9): the stored rows of the touched partitions are
  unioned with the new rows, de-duplicated with an explicit precedence and written over the
  lake with ``partitionOverwriteMode=dynamic``.  Spark stages all new files and replaces
  partitions only when every task has ended, so reading and replacing is one job and a lost
  executor or a failed job leaves the lake as it was.  Null partition values are merged like
  any other.  A re-run of the same batch yields the same table.
* The lake's columns are kept in a small file beside it (``<root>-schema``), written when a
  load brings a column that the lake does not have; no load opens the footers of the lake.
* Typed sinks are append-safe: a load replaces stored rows that have its keys and keeps all
  others of the partitions it touches (another device, meter or half of the day).
  Plain Parquet has no multi-partition atomic commit; a table format would add that.

Reads
-----
Always with an explicit schema that includes the partition columns (ids STRING, ``date``
DATE): partition inference would turn the id ``007`` into the number 7.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rates import normalise_readings
from ..operators.dedup import keep_first
from ..session import scratch_path
from . import files, folders

# Default layout: day x meter hash bucket.  The reference's one-folder-per-meter-per-day
# layout (``REFERENCE_CONSUMPTION_PARTS``) yields 48-row files - about 10^10 files at
# 100 TB - so it is kept only as an opt-in for compatibility; rows are sorted by meter and
# time inside each file, so Parquet row-group statistics still prune by meter.
METER_BUCKETS = 8
CONSUMPTION_PARTS = ["date", "meter_bucket"]
REFERENCE_CONSUMPTION_PARTS = ["kind", "mpan_mprn", "serial", "date"]
METER_KEYS = ["kind", "mpan_mprn", "serial"]
METER_SORT = ["kind", "mpan_mprn", "serial", "interval_start"]
RATE_PARTS = ["energy", "product", "tariff", "date"]
HEATING_PARTS = ["record_kind", "date"]
HEATING_SORT = ["trv", "timestamp"]
#: Batches of fewer rows are written by up to SPREAD_TASKS tasks, whatever their bytes.
SMALL_BATCH, SPREAD_TASKS = 2_000_000, 64
#: A layout of many small folders costs by its folders, not its bytes: a task gets at most about so many rows.
FOLDER_ROWS, FOLDER_TASKS = 25_000, 10_000
#: On a machine's own disk (``file:``; other stores ignore this) and without Hadoop's native library every file that is created starts a ``chmod``
#: process, and with its checksum file beside it several.  Parquet files of a layout of many folders are small, so these took most of a load.
_LOCAL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def write_partitioned(df: DataFrame, root: str, partition_cols: Sequence[str] | None = None,
                      dedup_cols: Sequence[str] | None = None, order: str | None = None,
                      mode: str = "dynamic", max_records_per_file: int = 5_000_000,
                      sort_cols: Sequence[str] = (), rows: int | None = None, deal_by: Sequence[str] | None = None) -> None:
    """K1: optional de-dup (keep first), then write partitioned by ``partition_cols``.

    Spark omits partition columns from the files, as the reference drops them.  An empty
    input is a no-op under dynamic overwrite, with or without partition columns.  Without
    an ``order`` the smallest row of a duplicate set stays, so the result is the same on every run.

    The ``rebalance`` hint packs small partitions into one task, which then opens their files one after another; a batch of known
    size (``rows``) below ``SMALL_BATCH`` is spread over tasks by partition instead.  ``deal_by`` (the first of the partition columns) marks a
    layout of many small folders: rows go to tasks by it, to more tasks the more rows there are whatever their bytes, and on
    a machine's own disk the tasks make the folders themselves (``folders.write``); elsewhere one task makes a parent folder, and the commit moves
    that as a whole.
    """
    if dedup_cols:
        df = keep_first(df, dedup_cols, order)
    if not partition_cols and mode == "dynamic" and df.isEmpty():
        return
    w = df
    if partition_cols:
        cores = df.sparkSession.sparkContext.defaultParallelism
        if deal_by:
            w = _stored_values(df, partition_cols).repartition(min(max(cores, (rows or 0) // FOLDER_ROWS), FOLDER_TASKS), *deal_by)
        elif rows is not None and rows < SMALL_BATCH:
            w = df.repartition(min(cores, SPREAD_TASKS), *partition_cols)
        else:
            w = df.hint("rebalance", *partition_cols)
        sort = [c for c in sort_cols if c in df.columns]
        if sort or deal_by:
            w = w.sortWithinPartitions(*partition_cols, *sort)
        if deal_by and mode in ("dynamic", "append") and folders.fits(df.sparkSession, root, df.schema, partition_cols):
            folders.write(w, root, partition_cols, mode == "dynamic", max_records_per_file)
            return
    writer = w.write.options(**_LOCAL_FILES).option("maxRecordsPerFile", max_records_per_file)
    if mode == "dynamic":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(root)


def read_lake(spark: SparkSession, root: str, schema: T.StructType, legacy_root: str | None = None,
              keys: Sequence[str] | None = None) -> DataFrame:
    """S7 (+S8): read the lake with an explicit schema; with ``legacy_root`` the old layout is
    read too and the new layout wins for rows with equal ``keys``."""
    def one(path: str) -> DataFrame | None:
        if not files.exists(spark, path):
            return None
        return spark.read.schema(schema).option("basePath", path).parquet(path)

    new = one(root)
    if legacy_root is None:
        return new if new is not None else spark.createDataFrame([], schema)
    old = folders.read(spark, legacy_root, schema) if files.exists(spark, legacy_root) else None
    old = one(legacy_root) if old is None else old
    if old is None:
        return new if new is not None else spark.createDataFrame([], schema)
    if new is None:
        return old
    both = new.withColumn("_src", F.lit(0)).unionByName(old.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return keep_first(both, list(keys or schema.fieldNames()), "_src").drop("_src") if keys else \
        both.drop("_src").distinct()


@dataclass(frozen=True)
class Extent:
    """What a batch touches: rows, first and last ``date``, and whether some partition value is null."""

    rows: int
    first: object = None
    last: object = None
    nulls: bool = False


def _any_null(cols: Sequence[str]) -> F.Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def batch_extent(batch: DataFrame, partition_cols: Sequence[str]) -> Extent:
    """One aggregate over the batch's partition columns."""
    day = "date" if "date" in partition_cols else None
    row = batch.agg(F.count(F.lit(1)), F.min(day or F.lit(None)), F.max(day or F.lit(None)), F.bool_or(_any_null(partition_cols))).first()
    return Extent(row[0], row[1], row[2], bool(row[3]))


def touched_partitions(spark: SparkSession, root: str, schema: T.StructType, batch: DataFrame,
                       partition_cols: Sequence[str], extent: Extent | None = None) -> DataFrame | None:
    """Stored rows of the partitions a batch touches (None for an empty batch).

    Static pruning that holds for any batch size - the batch's ``date`` range from a one-row,
    column-pruned aggregate - plus dynamic partition pruning from the semi-join on the exact
    partition values.  Only these partitions are read, however large the lake is.  Partitions with a null
    value, which an equi-join never finds, are looked up null-safely, if the batch has such rows.
    """
    extent = extent or batch_extent(batch, partition_cols)
    if not extent.rows:
        return None
    stored = read_lake(spark, root, schema)
    within = F.col("date").between(F.lit(extent.first), F.lit(extent.last)) if extent.first is not None else F.lit(True)
    touched = batch.select(*partition_cols).distinct()
    cols = schema.fieldNames()
    out = stored.filter(within).join(touched, list(partition_cols), "left_semi").select(*cols)
    if extent.nulls:
        if extent.first is not None:
            within = within | F.col("date").isNull()
        gaps = touched.filter(_any_null(partition_cols)).select(*[F.col(c).alias(f"_p_{c}") for c in partition_cols])
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_cols])
        out = out.unionByName(stored.filter(_any_null(partition_cols) & within).join(gaps, same, "left_semi").select(*cols))
    return out


def _stored_values(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Folder names do not tell an empty string from null: both are stored as null."""
    text = [c for c in partition_cols if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text}) if text else df


def merge_partitions(df: DataFrame, root: str, schema: T.StructType, partition_cols: Sequence[str],
                     keys: Sequence[str], order: Sequence[str] | str | None = None,
                     prefer: str = "order", extent: Extent | None = None) -> None:
    """K9: idempotent replace of the partitions touched by ``df``.

    Rows equal on ``keys`` are resolved by ``prefer``: ``order`` keeps the row first in
    ``order`` wherever it is stored (keep-first arrival across loads), ``new`` / ``existing``
    rank that side first and use ``order`` within it.  Only touched partitions are read back: the stored lake is
    semi-joined with the batch's distinct partition values, which Spark turns into
    partition pruning.  A caller that has persisted ``df`` passes its ``extent``.
    """
    spark = df.sparkSession
    cols = schema.fieldNames()
    batch = _stored_values(df.select(*cols), partition_cols)
    own = extent is None
    if own:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for its extent, its partitions and the merge
    try:
        extent = extent or batch_extent(batch, partition_cols)
        old = touched_partitions(spark, root, schema, batch, partition_cols, extent)
        if old is None:
            return
        rank_new, rank_old = {"new": (0, 1), "existing": (1, 0)}.get(prefer, (0, 0))
        both = batch.withColumn("_side", F.lit(rank_new)).unionByName(old.withColumn("_side", F.lit(rank_old)))
        merged = keep_first(both, list(keys), ["_side", *([order] if isinstance(order, str) else order or [])]).drop("_side")
        sort = [c for c in METER_SORT if c in cols]
        # A lake that is not there yet has no partitions to replace one by one.
        mode = "dynamic" if files.exists(spark, root) else "append"
        by_meter = list(METER_KEYS) if set(METER_KEYS) < set(partition_cols) else None
        save_schema(spark, root, schema)
        write_partitioned(merged, root, partition_cols, mode=mode, sort_cols=sort, rows=extent.rows, deal_by=by_meter)
    finally:
        if own:
            batch.unpersist()


def replace_keys(df: DataFrame, root: str, partition_cols: Sequence[str], keys: Sequence[str],
                 schema: T.StructType | None = None, sort_cols: Sequence[str] = ()) -> None:
    """Append-safe load without de-duplication: stored rows whose ``keys`` (nulls equal) occur in ``df``
    are replaced by all of ``df``'s rows with those keys; every other stored row stays.

    Loads that repeat a batch change nothing; loads of other keys only add.  Columns that only one side
    has are kept, null on the other.  Keys must tell their partition: a row whose key moves to another partition stays in both.
    """
    spark = df.sparkSession
    batch = _stored_values(df, partition_cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        schema = lake_schema(spark, root, schema or batch.schema, batch)
        new = batch.select(*[(F.col(f.name) if f.name in batch.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])
        extent = batch_extent(new, partition_cols)
        old = touched_partitions(spark, root, schema, new, partition_cols, extent)
        if old is None:
            return
        mine = new.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        merged = new.unionByName(old.join(mine, same, "left_anti"))
        save_schema(spark, root, schema)
        write_partitioned(merged, root, partition_cols, mode="dynamic",
                          sort_cols=[c for c in sort_cols if c in merged.columns], rows=extent.rows)
    finally:
        batch.unpersist()


def _schema_folder(root: str) -> str:
    return root.rstrip("/") + "-schema"


def saved_schema(spark: SparkSession, root: str) -> T.StructType | None:
    """The columns that the loads of a lake have written so far; None for a lake without such a record."""
    found = [n for n in files.names(spark, _schema_folder(root)) if n.endswith(".json") and not n.startswith(".")]
    return T.StructType.fromJson(json.loads(files.read_text(spark, f"{_schema_folder(root)}/{found[-1]}"))) if found else None


def save_schema(spark: SparkSession, root: str, schema: T.StructType) -> None:
    """Record the lake's columns in a new file, if they are not those recorded last."""
    if saved_schema(spark, root) != schema:
        done = [n for n in files.names(spark, _schema_folder(root)) if n.endswith(".json") and not n.startswith(".")]
        number = int(done[-1].split(".")[0]) + 1 if done else 1
        files.write_text(spark, f"{_schema_folder(root)}/{number:08d}.json", schema.json())


def lake_schema(spark: SparkSession, root: str, declared: T.StructType, batch: DataFrame) -> T.StructType:
    """Declared columns, then other columns of the lake, then other columns of the batch.  The lake's columns come from its own record;
    a lake that other tools wrote has none, and its footers are read for its first load alone."""
    fields = {f.name: f for f in declared}
    stored = saved_schema(spark, root)
    if stored is None and files.exists(spark, root):
        stored = spark.read.option("mergeSchema", "true").parquet(root).schema
    for f in stored or []:
        fields.setdefault(f.name, f)
    for f in batch.schema:
        fields.setdefault(f.name, f)
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields.values()])


# ---------------------------------------------------------------- typed sinks
CONSUMPTION_LAKE = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("interval_start", T.TimestampNTZType()),
    T.StructField("interval_end", T.TimestampNTZType()), T.StructField("consumption", T.DecimalType(18, 6)),
    T.StructField("tariff_code", T.StringType()),
    T.StructField("kind", T.StringType()), T.StructField("mpan_mprn", T.StringType()),
    T.StructField("serial", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("meter_bucket", T.IntegerType()),
])
CONSUMPTION_KEYS = ["kind", "mpan_mprn", "serial", "interval_start", "interval_end"]


HEATING_LAKE = T.StructType([
    T.StructField("trv_id", T.StringType()), T.StructField("zone_id", T.StringType()),
    T.StructField("requested", T.BooleanType()), T.StructField("heat_demand", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()), T.StructField("duration_minutes", T.IntegerType()),
    T.StructField("device_id", T.StringType()), T.StructField("temperature", T.DoubleType()),
    T.StructField("sensor_type", T.StringType()), T.StructField("humidity", T.DoubleType()),
    T.StructField("trv", T.StringType()),
    T.StructField("record_kind", T.StringType()), T.StructField("date", T.DateType()),
])


def meter_bucket(buckets: int = METER_BUCKETS) -> F.Column:
    return F.pmod(F.xxhash64("kind", "mpan_mprn", "serial"), F.lit(buckets)).cast("int")


def prepare_consumption(df: DataFrame, meter: dict | None = None, buckets: int = METER_BUCKETS) -> DataFrame:
    """K2 prelude: stamp meter identity (P5), UTC times (P1), ``date`` = UTC date of
    ``interval_end`` (23:30-00:00 lands on the next day), meter hash bucket.  Rows without
    ``date`` are left for :func:`quarantine` (X12)."""
    out = df
    for k, v in (meter or {}).items():
        out = out.withColumn(k, F.lit(v))
    out = normalise_readings(out)  # P1 + P2 (interval_start derived from the end when absent)
    out = out.withColumn("date", F.to_date("interval_end"))
    if {"kind", "mpan_mprn", "serial"}.issubset(out.columns):
        out = out.withColumn("meter_bucket", meter_bucket(buckets))
    return out


def lake_rows(df: DataFrame, schema: T.StructType = CONSUMPTION_LAKE, buckets: int = METER_BUCKETS) -> DataFrame:
    """Readings prepared for the lake, cast to the types of ``schema``; absent columns are NULL."""
    p = prepare_consumption(df, buckets=buckets)
    return p.select(*[(F.col(f.name) if f.name in p.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_consumption(df: DataFrame, root: str, order: str | None = "event_id", prefer: str = "order",
                      schema: T.StructType = CONSUMPTION_LAKE,
                      partition_cols: Sequence[str] = tuple(CONSUMPTION_PARTS),
                      quarantine_root: str | None = None, buckets: int = METER_BUCKETS) -> None:
    """K2 + D2 + K9: de-duplicate on (meter, interval) and merge into the lake.

    Declared columns are cast to the lake's types (readings to DECIMAL(18,6)); all other columns are
    kept.  ``order`` is the arrival order where the batch has that column; without it the smallest row
    of a duplicate set stays.  ``partition_cols=REFERENCE_CONSUMPTION_PARTS`` writes the per-meter folder
    layout; ``buckets`` is fixed per lake.  Rows whose ``interval_end`` does not parse (no ``date``) go
    to ``quarantine_root``, by default the lake's path with ``-quarantine`` (X12); they never vanish."""
    # D2 happens inside the merge: its keep-first over (batch + stored) also resolves
    # duplicates within the batch, so no separate de-dup shuffle is needed.
    spark = df.sparkSession
    full = lake_schema(spark, root, schema, prepare_consumption(df, buckets=buckets))
    prepared = prepare_consumption(df.withColumn("_raw", F.struct(*df.columns)), buckets=buckets)
    rows = prepared.select(*[(F.col(f.name) if f.name in prepared.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in full],
                           F.when(F.col("date").isNull(), F.to_json("_raw")).alias("_rejected"))
    rows = _stored_values(rows, partition_cols).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, bad = quarantine(rows, ["date"])
        every = batch_extent(rows, partition_cols)
        n_bad = 0 if every.first is not None and not every.nulls else bad.count()
        if n_bad:
            append_rejected(bad.select(F.col("_rejected").alias("row")), quarantine_root or root.rstrip("/") + "-quarantine")
        if every.first is not None:
            extent = batch_extent(good, partition_cols) if n_bad else every
            merge_partitions(good, root, full, list(partition_cols), CONSUMPTION_KEYS, prefer=prefer, extent=extent,
                             order=[order] if order and order in prepared.columns else None)
    finally:
        rows.unpersist()


def append_rejected(rows: DataFrame, root: str, reason: str = "no time") -> None:
    """Rejected rows ``row`` (their raw columns as one JSON text, since they may be of any type) join the side table ``root``."""
    rows.select("row", F.lit(reason).alias("reason")).write.mode("append").parquet(root)


def _with_times(df: DataFrame, ts_col: str, root: str) -> DataFrame:
    """Rows whose ``ts_col`` is known, with ``date``; the others join the side table."""
    out = df.withColumn("date", F.to_date(ts_col))
    bad = df.filter(F.to_date(ts_col).isNull())
    if not bad.isEmpty():
        append_rejected(bad.select(F.to_json(F.struct(*df.columns)).alias("row")), root.rstrip("/") + "-quarantine", f"no {ts_col}")
    return out.filter(F.col("date").isNotNull())


def write_costed(df: DataFrame, root: str, buckets: int = METER_BUCKETS) -> None:
    """K4: costed readings, partitioned like consumption, no de-dup; a load replaces the (meter, interval) rows
    that it has and keeps all others.  Rows without a usable end join ``<root>-quarantine``."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = _with_times(df, "interval_end", root).withColumn("meter_bucket", meter_bucket(buckets))
        replace_keys(out, root, CONSUMPTION_PARTS, CONSUMPTION_KEYS, sort_cols=METER_SORT)
    finally:
        df.unpersist()


def write_unit_rates(df: DataFrame, root: str, order: str | None = None) -> None:
    """K3 + D3: ``energy=/product=/tariff=/date=`` with ``date`` = UTC date of ``valid_from``.  Conflicting rates of one
    key resolve by ``order``, else to the smallest row; a load replaces the keys that it has.  Codes without a product are
    stored under the null product; rates without a start join ``<root>-quarantine``."""
    keys = [c for c in ("valid_from", "valid_to", "tariff_code") if c in df.columns]
    out = (keep_first(df, keys, order) if keys else df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        dated = _with_times(out, "valid_from", root).withColumn("product", F.col("product_code")).withColumn("tariff", F.col("tariff_code"))
        replace_keys(dated, root, RATE_PARTS, keys or RATE_PARTS)
    finally:
        out.unpersist()


def write_heating(df: DataFrame, root: str) -> None:
    """K5-K8: demand and temperature rows kept apart by ``record_kind`` (X2), per device/day, no de-dup.  A load replaces
    the (device, kind, sensor, time) rows that it has; other devices and times of the day stay.  Records without a time join
    ``<root>-quarantine``."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = _with_times(df, "timestamp", root).withColumn("trv", F.coalesce(*[F.col(c) for c in ("trv_id", "device_id") if c in df.columns]))
        keys = [c for c in ("record_kind", "trv", "sensor_type", "timestamp") if c in out.columns]
        replace_keys(out, root, HEATING_PARTS, keys, sort_cols=HEATING_SORT)
    finally:
        df.unpersist()


def write_curated(df: DataFrame, root: str, domain: str, date_col: str = "date", keys: Sequence[str] = ("home_id", "date")) -> None:
    """``domain=/date=`` layout.  A load replaces the rows that have its ``keys`` and keeps all others, so homes may come one by one."""
    replace_keys(df.withColumn("domain", F.lit(domain)), root, ["domain", date_col], ["domain", *keys])


#: Size that compaction packs files to.
TARGET_BYTES = 256 << 20


def partition_files(spark: SparkSession, root: str, schema: T.StructType, partition_cols: Sequence[str]) -> DataFrame:
    """``(*partition_cols, n_files, bytes)`` of a lake, from the listing of its folders: no file is opened."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)

    def value(c: str) -> F.Column:
        text = F.regexp_extract("path", f"/{c}=([^/]*)/", 1)
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).cast(schema[c].dataType)

    return listed.select(*[value(c).alias(c) for c in partition_cols], "length").groupBy(*partition_cols).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))


def compact(spark: SparkSession, root: str, schema: T.StructType, partition_cols: Sequence[str],
            where=None, target_bytes: int = TARGET_BYTES) -> None:
    """Rewrite the partitions that have more files than their bytes need at ``target_bytes`` each; files of other partitions stay as
    they are.  ``where`` (on the partition columns) limits the partitions looked at.  One job reads and replaces them, as in a merge."""
    found = partition_files(spark, root, schema, partition_cols)
    wanted = F.ceil(F.col("bytes") / F.lit(target_bytes)).cast("int")
    todo = found.select(*partition_cols, "n_files", wanted.alias("_wanted")).filter(F.col("n_files") > F.col("_wanted"))
    if where is not None:
        todo = todo.filter(where)
    todo = todo.drop("n_files").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if todo.isEmpty():
            return
        df = read_lake(spark, root, schema)
        known = ~_any_null(partition_cols)
        mine = df.join(todo.filter(known), list(partition_cols)).select(*schema.fieldNames(), "_wanted")
        gaps = todo.filter(~known).select(*[F.col(c).alias(f"_p_{c}") for c in partition_cols], "_wanted")
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_cols])
        mine = mine.unionByName(df.filter(~known).join(gaps, same).select(*schema.fieldNames(), "_wanted"))
        sort = [c for c in METER_SORT if c in schema.fieldNames()] or [c for c in schema.fieldNames() if c not in partition_cols][:1]
        piece = F.pmod(F.xxhash64(*sort[:3]), F.col("_wanted"))
        packed = mine.withColumn("_piece", piece).repartition(*partition_cols, "_piece").sortWithinPartitions(*partition_cols, *sort)
        (packed.drop("_wanted", "_piece").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_cols).parquet(root))
    finally:
        todo.unpersist()


def quarantine(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows with NULL required columns off instead of losing them silently."""
    bad = None
    for c in required:
        cond = F.col(c).isNull()
        bad = cond if bad is None else bad | cond
    return df.filter(~bad), df.filter(bad)


def new_lake_root(spark: SparkSession, tag: str) -> str:
    return scratch_path(spark, f"lake-{tag}-{uuid.uuid4().hex[:8]}")
