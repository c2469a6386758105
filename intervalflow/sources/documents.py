"""Landed JSON documents: pages (S1), accounts (S10), zones (S11), homes (S12),
meter configuration text (P15).

Documents arrive as text (one JSON value per file or per row).  Each reader takes a
DataFrame with a string column (``spark.read.text(path, wholetext=True)`` gives one)
and parses it once with ``from_json`` against an explicit schema; nested arrays are
then flattened with ``explode``/``posexplode`` - all JVM-side, no Python per row.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.codes import first_present


#: Row groups of packed landing files: small enough that a few files are read by many tasks.
PACK_BYTES = 16 << 20


def land_packed(docs: DataFrame, root: str, folders: Sequence[str], text_col: str = "value") -> None:
    """Land documents, each under its own path ``<folder>=<value>/.../part-0.json``, many to a file: Parquet rows ``(path, value)``.  A file
    of its own for each small document costs more to create, list and open than to parse.  Appends; null and empty values are
    stored as Spark names their folders."""
    def folder(name: str) -> F.Column:
        # Escaped as a folder name, and that as a URI, like the path of a file.
        text = F.col(name).cast("string")
        for _ in range(2):
            text = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
        return F.concat(F.lit(f"{name}="), F.coalesce(F.nullif(text, F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")))

    path = F.concat_ws("/", *[folder(c) for c in folders], F.lit("part-0.json"))
    rows = docs.select(path.alias("path"), F.col(text_col).alias("value")).repartition(docs.sparkSession.sparkContext.defaultParallelism)
    rows.write.mode("append").option("parquet.block.size", PACK_BYTES).parquet(root)


def read_text_documents(spark: SparkSession, path: str, streaming: bool = False, glob: str = "*", max_files: int | None = None,
                        packed: bool = False) -> DataFrame:
    """One row per landed document below ``path``: ``(source_file, landed_at, value)``, as a table or as a stream.  Each file is a whole JSON
    document, or with ``packed`` holds many (:func:`land_packed`), whose ``source_file`` is the file's path, ``!`` and their own."""
    reader = spark.readStream.schema("path string, value string" if packed else "value string") if streaming else spark.read
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if packed:
        reader = reader if streaming else reader.schema("path string, value string")
        files = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).parquet(path)
        return files.select(F.concat("_metadata.file_path", F.lit("!/"), "path").alias("source_file"), F.col("_metadata.file_modification_time").alias("landed_at"), "value")
    files = reader.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select(F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_modification_time").alias("landed_at"), "value")


def path_value(name: str, source_file: str = "source_file") -> F.Column:
    """The value of a ``name=value`` folder in a file's path, as text; NULL if there is none.  The path is a URI, and folder names escape
    special characters themselves."""
    def plain(c: F.Column) -> F.Column:
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    text = F.regexp_extract(plain(F.col(source_file)), f"/{name}=([^/]*)/", 1)
    return F.when(~text.isin("", "__HIVE_DEFAULT_PARTITION__"), plain(text))


def read_day_reports(spark: SparkSession, path: str, streaming: bool = False, max_files: int | None = None, packed: bool = False) -> DataFrame:
    """Day reports landed below ``zone_id=/date=`` folders, one JSON document each: ``(device_id, zone_id, date, value, source_file, landed_at)``.
    A zone's device has its id (P17).  The ids stay text, so leading zeros stay too."""
    docs = read_text_documents(spark, path, streaming, max_files=max_files, packed=packed)
    return docs.select(path_value("zone_id").alias("device_id"), path_value("zone_id").alias("zone_id"),
                       path_value("date").try_cast("date").alias("date"), "value", "source_file", "landed_at")


def read_landed_pages(spark: SparkSession, path: str, result_type: T.DataType, packed: bool = False) -> DataFrame:
    """S1 over landed documents, one page each: the page number is that of the ``page=`` folder, else the last number in the file's name."""
    docs = read_text_documents(spark, path, packed=packed)
    in_name = F.regexp_extract("source_file", "([0-9]+)[^0-9/]*$", 1).try_cast("long")
    return read_pages(docs.withColumn("page_no", F.coalesce(path_value("page").try_cast("long"), in_name)), result_type)


def _paths(kind: T.DataType, path: str = "") -> dict[str, T.DataType]:
    """Every declared path below ``path``; an element of an array is ``[]``."""
    if isinstance(kind, T.ArrayType):
        return {f"{path}[]": kind.elementType, **_paths(kind.elementType, f"{path}[]")}
    out = {}
    for f in kind if isinstance(kind, T.StructType) else ():
        child = f"{path}.{f.name}" if path else f.name
        out.update({child: f.dataType, **_paths(f.dataType, child)})
    return out


def unknown_fields(df: DataFrame, declared: T.DataType, text_col: str = "value") -> DataFrame:
    """Schema drift: ``(path, type, n_values, n_documents)`` of the fields that JSON documents have and ``declared`` does not.

    Each document is parsed once, to a VARIANT, and walked as deep as the declared schema goes; an undeclared field is reported with the type of
    its values and not entered.  Documents that do not parse have no fields."""
    known = _paths(declared)
    inner = [p for p, t in known.items() if isinstance(t, (T.StructType, T.ArrayType))]
    level = df.select(F.monotonically_increasing_id().alias("doc"), F.lit("").alias("path"), F.try_parse_json(text_col).alias("v"))
    spark, found, depth = df.sparkSession, None, 1 + max((p.count(".") + p.count("[]") for p in known), default=0)
    for _ in range(depth):
        children = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        step = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key"))
        children = children.select("doc", step.alias("path"), F.col("value").alias("v"))
        new = children.filter(~F.col("path").isin(list(known)))
        found = new if found is None else found.unionByName(new)
        level = children.filter(F.col("path").isin(inner))
    return found.groupBy("path", F.schema_of_variant("v").alias("type")).agg(F.count(F.lit(1)).alias("n_values"), F.count_distinct("doc").alias("n_documents"))


def read_pages(df: DataFrame, result_type: T.DataType, text_col: str = "value",
               page_col: str = "page_no") -> DataFrame:
    """Rows of every page in page order; missing ``results`` = empty page.

    Output keeps ``page_no`` and the position inside the page (arrival order for keep-first)
    and flags the page without a truthy ``next`` as the last one.
    """
    env = F.from_json(F.col(text_col), schemas.page_envelope(result_type))
    parsed = df.select(page_col, env.alias("_p"))
    rows = parsed.select(page_col, F.posexplode("_p.results").alias("page_pos", "_r"),
                         (F.coalesce(F.col("_p.next"), F.lit("")) == "").alias("is_last_page"))
    return rows.select(page_col, "page_pos", "is_last_page", "_r.*")


def read_accounts(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Parse account documents (E5)."""
    keep = [c for c in df.columns if c != text_col]
    return df.select(*keep, F.from_json(F.col(text_col), schemas.ACCOUNT).alias("account"))


def _points(arr, kind: str, ids: tuple[str, ...]):
    """Array of uniform point structs for one kind; NULL array = no points."""
    return F.transform(F.coalesce(arr, F.array()), lambda p, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("point_pos"),
        first_present(*[p[c] for c in ids]).alias("mpan_mprn"),
        p["meters"].alias("meters"), p["agreements"].alias("agreements")))


def meter_points(accounts: DataFrame, account_col: str = "account") -> DataFrame:
    """Electricity and gas meter points with their position, one row each.

    Both kinds are flattened in one pass (one array per document, exploded once), so the
    document source is scanned and parsed a single time.
    """
    a = F.col(account_col)
    pts = F.concat(_points(a["electricity_meter_points"], "electricity", ("mpan", "mpan_number", "mpan_mprn")),
                   _points(a["gas_meter_points"], "gas", ("mprn", "mpan_mprn", "mprn_number")))
    return accounts.select(a["number"].alias("account"), F.explode(pts).alias("p")).select("account", "p.*")


def list_meters(accounts: DataFrame, account_col: str = "account") -> DataFrame:
    """A5 + F11 + P18: (account, kind, mpan_mprn, serial) of every meter with both ids non-empty.

    ``groupBy('kind').agg(collect_list(...))`` would give the reference's map form; the row
    form is kept because a list per kind is an unbounded group.
    """
    pts = meter_points(accounts, account_col)
    m = pts.select("account", "kind", "point_pos", "mpan_mprn", F.posexplode("meters").alias("meter_pos", "m"))
    m = m.select("account", "kind", "point_pos", "meter_pos", "mpan_mprn",
                 first_present("m.serial_number", "m.serial").alias("serial"))
    return m.filter(F.col("mpan_mprn").isNotNull() & F.col("serial").isNotNull())


def devices_from_zones(zones: DataFrame, text_col: str = "value") -> DataFrame:
    """S11 + F5 + P17: heating zones -> TRV devices (ids as strings, name default ``TRV``)."""
    keep = [c for c in zones.columns if c != text_col]
    z = zones.select(*keep, F.explode(F.from_json(F.col(text_col), schemas.ZONES)).alias("z"))
    z = z.filter(F.col("z.type") == "HEATING")
    return z.select(*keep, F.col("z.id").cast("string").alias("device_id"),
                    F.coalesce(F.col("z.name"), F.lit("TRV")).alias("name"),
                    F.lit("trv").alias("device_type"), F.col("z.id").cast("string").alias("zone_id"))


def homes(me: DataFrame, text_col: str = "value") -> DataFrame:
    """The four home fields of ``homes[]``; a document without ``homes`` yields nothing."""
    h = me.select(F.explode(F.from_json(F.col(text_col), schemas.ME)["homes"]).alias("h"))
    return h.select("h.id", "h.name", "h.dateTimeZone", "h.temperatureUnit")


def _meter_lists(df: DataFrame, text_col: str) -> DataFrame:
    """``_m``: the parsed list (NULL if neither parse succeeds); ``repaired``: only the lenient parse did."""
    strict = F.from_json(F.col(text_col), schemas.METER_CONFIG)
    lenient = F.from_json(F.col(text_col), schemas.METER_CONFIG, {"allowUnquotedFieldNames": "true"})
    return df.withColumn("_s", strict).withColumn("_m", F.coalesce("_s", lenient)).withColumn("repaired", F.col("_s").isNull()).drop("_s")


def parse_meter_config(df: DataFrame, text_col: str = "value") -> DataFrame:
    """Meter list JSON; lists with unquoted keys are read by Spark's lenient parser, which leaves
    text inside strings alone.  Documents that do not parse are in :func:`bad_meter_configs`."""
    keep = [c for c in df.columns if c != text_col]
    return _meter_lists(df, text_col).filter(F.col("_m").isNotNull()) \
        .select(*keep, "repaired", F.posexplode("_m").alias("entry_pos", "e")).select(*keep, "repaired", "entry_pos", "e.*")


def bad_meter_configs(df: DataFrame, text_col: str = "value") -> DataFrame:
    """The documents that no parse reads, as they came, for quarantine."""
    return _meter_lists(df, text_col).filter(F.col("_m").isNull()).select(*df.columns)
