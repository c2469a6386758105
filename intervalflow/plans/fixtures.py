"""Domain inputs derived from the driver tables (rules of FIXTURES.md section 2).

Everything is a lazy DataFrame over the given Parquet tables, so the work of every query
grows with them.  Nested documents are produced with ``to_json`` as string columns, the
same shape as landed JSON text, and parsed back by the ``sources`` readers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.timefns import floor_time, format_zulu, plus_micros
from ..operators.dedup import dedup_consumption

HALF_HOUR_US = 1_800_000_000
MINUTE_US = 60_000_000

# The two tariff codes of the two-tariff (skewed) rate shape.
TARIFF_ELECTRICITY = "E-1R-AGILE-24-09-01-A"
TARIFF_GAS = "G-1R-GAS-24-09-01-A"
METER_KEYS = ["kind", "mpan_mprn", "serial"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _even(c: Column) -> Column:
    return F.pmod(c, F.lit(2)) == 0


def meter_columns(user_id: Column) -> list[Column]:
    """E1 from a user id: kind by parity, zero-padded id, serial by id mod 7, tariff by kind."""
    kind = F.when(_even(user_id), F.lit("electricity")).otherwise(F.lit("gas"))
    return [kind.alias("kind"),
            F.lpad(user_id.cast("string"), 10, "0").alias("mpan_mprn"),
            F.concat(F.lit("S"), F.pmod(user_id, F.lit(7)).cast("string")).alias("serial"),
            F.when(_even(user_id), F.lit(TARIFF_ELECTRICITY)).otherwise(F.lit(TARIFF_GAS)).alias("tariff_code")]


def prop_k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def consumption_raw(spark: SparkSession, sf_dir: str, end_only: bool = False) -> DataFrame:
    """E2 with duplicates: one reading per event, half-hour slot of ``ts``; arrival = event_id."""
    ev = table(spark, sf_dir, "events")
    slot = floor_time("ts", 1800)
    cols = [F.col("event_id"), *meter_columns(F.col("user_id"))]
    if not end_only:
        cols.append(slot.alias("interval_start"))
    cols += [plus_micros(slot, HALF_HOUR_US).alias("interval_end"),
             F.col("value").cast("decimal(18,2)").alias("consumption")]
    return ev.select(*cols)


def consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 de-duplicated (D2, keep first arrival)."""
    return dedup_consumption(consumption_raw(spark, sf_dir), METER_KEYS, order="event_id")


def _signups(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    return ev.select("user_id", *meter_columns(F.col("user_id"))[:1],
                     floor_time("ts", 1800).alias("valid_from"), "value", prop_k(F.col("props")).alias("k"))


def _rate_value(vmax: Column) -> Column:
    return (vmax.cast("decimal(18,2)") * F.lit(0.01).cast("decimal(18,2)")).cast("decimal(18,4)")


def rates(spark: SparkSession, sf_dir: str, shape: str = "two") -> DataFrame:
    """E3 unit rates from sign-up events.

    ``two``: one tariff per kind (skewed shape), ``valid_to`` = +15 min when n%5=0 (a gap),
    open when n%7=0, else the next ``valid_from``.  ``many``: one tariff per user.
    ``overlap``: two tariffs, ``valid_to`` = ``valid_from`` + 6 h (rates overlap).
    """
    s = _signups(spark, sf_dir)
    if shape == "many":
        code = F.concat(F.when(_even(F.col("user_id")), F.lit("E")).otherwise(F.lit("G")),
                        F.lit("-1R-USER"), F.col("user_id").cast("string"), F.lit("-A"))
        keys = ["user_id"]
    else:
        code = F.when(F.col("kind") == "electricity", F.lit(TARIFF_ELECTRICITY)).otherwise(F.lit(TARIFF_GAS))
        keys = ["kind"]
    g = s.groupBy(*keys, "valid_from").agg(F.max("value").alias("vmax"), F.max("k").alias("n"))
    g = g.withColumn("tariff_code", code if shape == "many" else
                     F.when(F.col("kind") == "electricity", F.lit(TARIFF_ELECTRICITY)).otherwise(F.lit(TARIFF_GAS)))
    if shape == "overlap":
        vt = plus_micros("valid_from", 6 * 3600 * 1_000_000)
    else:
        nxt = F.lead("valid_from").over(Window.partitionBy("tariff_code").orderBy("valid_from"))
        vt = (F.when(F.pmod("n", F.lit(5)) == 0, plus_micros("valid_from", 15 * MINUTE_US))
               .when(F.pmod("n", F.lit(7)) == 0, F.lit(None).cast("timestamp_ntz"))
               .otherwise(nxt))
    return g.select("tariff_code", "valid_from", vt.alias("valid_to"), _rate_value(F.col("vmax")).alias("value_inc_vat"))


def consumption_many_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings keyed by the per-user tariff of ``rates(shape='many')``."""
    c = consumption(spark, sf_dir)
    uid = F.col("mpan_mprn").cast("long")
    code = F.concat(F.when(_even(uid), F.lit("E")).otherwise(F.lit("G")), F.lit("-1R-USER"),
                    uid.cast("string"), F.lit("-A"))
    return c.withColumn("tariff_code", code)


def order_tariff_code(o: DataFrame) -> Column:
    """Tariff code of an order's agreement: kind letter, register, compacted priority, region.

    Every 11th order key gives the unparsable ``X-1R``; odd keys use ``-BB`` (no region).
    """
    letter = F.when(F.pmod("o_orderkey", F.lit(4)) == 2, F.lit("G")).otherwise(F.lit("E"))
    full = F.concat(letter, F.lit("-1R-"), F.regexp_replace("o_orderpriority", " ", ""),
                    F.when(F.pmod("o_orderkey", F.lit(2)) == 1, F.lit("-BB")).otherwise(F.lit("-A")))
    return F.when(F.pmod("o_orderkey", F.lit(11)) == 0, F.concat(letter, F.lit("-1R"))).otherwise(full)


# Length in days of a billing period and how many a meter has; every bill of the second and third residue of (user + number) mod 3
# differs from the cost of its days by the given factor.
BILL_DAYS, BILLS = 9, 4
BILL_FACTORS = ("1.0000", "1.0050", "1.2000")


def bills(spark: SparkSession, sf_dir: str, daily: DataFrame) -> DataFrame:
    """Bills of every meter: periods of nine days that begin up to four days into January and so split months; the amount follows the cost of the
    days (``daily`` totals).  Bills with (user + number) mod 7 = 3 were never sent; users with id mod 11 = 0 have one more, for June."""
    uid = F.col("mpan_mprn").cast("long")
    first = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(uid, F.lit(5)).cast("int"))
    meters = daily.select(*METER_KEYS).distinct()
    numbers = F.concat(F.sequence(F.lit(0), F.lit(BILLS - 1)), F.when(F.pmod(uid, F.lit(11)) == 0, F.array(F.lit(17))).otherwise(F.array().cast("array<int>")))
    sent = meters.select(*METER_KEYS, F.explode(numbers).alias("no")).filter(F.pmod(uid + F.col("no"), F.lit(7)) != 3)
    sent = sent.select(*METER_KEYS, "no", F.date_add(first, F.col("no") * BILL_DAYS).alias("period_start"), F.date_add(first, (F.col("no") + 1) * BILL_DAYS).alias("period_end"))
    days = daily.select(*[F.col(k).alias(f"_{k}") for k in METER_KEYS], "usage_date", "cost")
    inside = (F.col("usage_date") >= F.col("period_start")) & (F.col("usage_date") < F.col("period_end"))
    same = (F.col("kind") == F.col("_kind")) & (F.col("mpan_mprn") == F.col("_mpan_mprn")) & (F.col("serial") == F.col("_serial"))
    cost = sent.join(days, same & inside, "left").groupBy(*METER_KEYS, "no", "period_start", "period_end").agg(F.coalesce(F.sum("cost"), F.lit(5)).alias("c"))
    factor = F.element_at(F.array(*[F.lit(f).cast("decimal(6,4)") for f in BILL_FACTORS]), (F.pmod(uid + F.col("no"), F.lit(3)) + 1).cast("int"))
    return cost.select(*METER_KEYS, F.concat(F.col("mpan_mprn"), F.lit("/"), F.col("no").cast("string")).alias("bill_id"), "period_start", "period_end",
                       (F.col("c").cast("decimal(18,6)") * factor).cast("decimal(18,6)").alias("billed_amount"))


def rates_before(rates_now: DataFrame) -> DataFrame:
    """What the rates were before a correction of about one in a hundred: others in value, in their end, or not known yet."""
    pick = F.pmod(F.xxhash64("tariff_code", "valid_from"), F.lit(300))
    return (rates_now.filter(pick != 0).withColumn("value_inc_vat", F.when(pick == 1, F.col("value_inc_vat") * 2).otherwise(F.col("value_inc_vat")).cast("decimal(18,4)"))
            .withColumn("valid_to", F.when(pick == 2, plus_micros("valid_from", MINUTE_US)).otherwise(F.col("valid_to"))))


# ---------------------------------------------------------------- documents
DAY_US = 86_400_000_000
AS_OF = "1998-01-01 00:00:00"


def _agreement(o: DataFrame) -> Column:
    vf = F.when(F.pmod("o_orderkey", F.lit(13)) == 0, F.lit("n/a")).otherwise(format_zulu("o_orderdate"))
    vt = F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string")) \
          .otherwise(format_zulu(plus_micros("o_orderdate", 365 * DAY_US)))
    return F.struct(F.col("o_orderkey").alias("k"),
                    F.struct(order_tariff_code(o).alias("tariff_code"), vf.alias("valid_from"),
                             vt.alias("valid_to")).alias("a"))


def accounts_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5 account document per customer, as JSON text in column ``value``.

    Points: electricity #0 (orders with key%4 in 0,1), electricity #1 (key%4=3), gas (key%4=2);
    agreements in order-key order.  Alias keys vary by customer to exercise P18.
    """
    o = table(spark, sf_dir, "orders")
    point = (F.when(F.pmod("o_orderkey", F.lit(4)) == 2, F.lit("g0"))
              .when(F.pmod("o_orderkey", F.lit(4)) == 3, F.lit("e1")).otherwise(F.lit("e0")))
    ag = o.select(F.col("o_custkey").alias("c_custkey"), point.alias("pt"), _agreement(o).alias("x"))

    def lst(p):
        return F.transform(F.sort_array(F.collect_list(F.when(F.col("pt") == p, F.col("x")))), lambda e: e["a"])

    per = ag.groupBy("c_custkey").agg(lst("e0").alias("e0"), lst("e1").alias("e1"), lst("g0").alias("g0"))
    # Hash-partition the customers by key (as a sort-merge join would): the document build and
    # everything downstream then runs in parallel tasks even when the customer table is one file.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cust = table(spark, sf_dir, "customer").select("c_custkey").repartition(n, "c_custkey")
    c = cust.join(per, "c_custkey", "left")
    k = F.col("c_custkey")
    ks = k.cast("string")
    pad = F.lpad(ks, 9, "0")
    none = F.lit(None).cast("string")

    def meter(serial_number, serial=None):
        return F.struct(serial_number.alias("serial_number"), (serial if serial is not None else none).alias("serial"))

    e0 = F.struct(F.when(F.pmod(k, F.lit(5)) == 0, none).otherwise(F.concat(F.lit("E"), pad)).alias("mpan"),
                  F.when(F.pmod(k, F.lit(5)) == 0, F.concat(F.lit("E"), pad)).otherwise(none).alias("mpan_number"),
                  F.array(meter(F.when(F.pmod(k, F.lit(4)) == 0, none).otherwise(F.concat(F.lit("ES"), ks)),
                                F.when(F.pmod(k, F.lit(4)) == 0, F.concat(F.lit("ES"), ks)).otherwise(none))
                          ).alias("meters"),
                  F.col("e0").alias("agreements"))
    e1 = F.struct(F.concat(F.lit("X"), pad).alias("mpan"), none.alias("mpan_number"),
                  F.array(meter(F.when(F.pmod(k, F.lit(6)) == 0, F.lit("")).otherwise(F.concat(F.lit("XS"), ks)))
                          ).alias("meters"),
                  F.col("e1").alias("agreements"))
    g0 = F.struct(F.concat(F.lit("G"), pad).alias("mprn"),
                  F.array(meter(F.concat(F.lit("GS"), ks))).alias("meters"), F.col("g0").alias("agreements"))
    doc = F.struct(F.concat(F.lit("A-"), ks).alias("number"), F.array(e0, e1).alias("electricity_meter_points"),
                   F.array(g0).alias("gas_meter_points"))
    return c.select("c_custkey", F.to_json(doc).alias("value"))


def customer_deployments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account -> deployment (market segment) and the per-meter override rule (key%10=0)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("A-"), F.col("c_custkey").cast("string")).alias("account"),
                    F.col("c_mktsegment").alias("deployment"), "c_custkey")


# Deployments that configure global tariffs, and those tariffs.
GLOBAL_SEGMENTS = ("AUTOMOBILE", "BUILDING")
GLOBAL_TARIFFS = {"electricity": "E-1R-GLOBAL-E-A", "gas": "G-1R-GLOBAL-G-A"}


def global_tariffs(spark: SparkSession) -> DataFrame:
    """Configuration table (deployment, kind, tariff_code); a handful of rows."""
    rows = [(seg, kind, code) for seg in GLOBAL_SEGMENTS for kind, code in GLOBAL_TARIFFS.items()]
    return spark.createDataFrame(rows, "deployment string, kind string, tariff_code string")


PAGE_ORDERS = 64


def lineitem_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 pages of lineitem rows: orders ``[64p, 64p+64)`` form page ``p`` (about 250 rows);
    ``next`` names the following page, NULL on the last one."""
    li = table(spark, sf_dir, "lineitem")
    last_page = li.agg(F.max("l_orderkey")).collect()[0][0] // PAGE_ORDERS
    page = F.floor(F.col("l_orderkey") / PAGE_ORDERS).cast("long")
    row = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                   format_zulu("l_shipdate").alias("l_shipdate"))
    g = li.groupBy(page.alias("page_no")).agg(F.sort_array(F.collect_list(row)).alias("results"))
    nxt = F.when(F.col("page_no") < F.lit(last_page), F.concat(F.lit("page-"), (F.col("page_no") + 1).cast("string")))
    return g.select("page_no", F.to_json(F.struct("results", nxt.alias("next"))).alias("value"))


def zones_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lists of homes: suppliers grouped ten per home; type by nation parity; every
    9th zone lacks a name (device name defaults to ``TRV``)."""
    s = table(spark, sf_dir, "supplier")
    z = F.struct(F.col("s_suppkey").alias("id"),
                 F.when(F.pmod("s_suppkey", F.lit(9)) == 0, F.lit(None).cast("string")).otherwise(F.col("s_name")).alias("name"),
                 F.when(_even(F.col("s_nationkey")), F.lit("HEATING")).otherwise(F.lit("HOT_WATER")).alias("type"))
    home = F.floor(F.col("s_suppkey") / 10).cast("long").alias("home_id")
    g = s.groupBy(home).agg(F.sort_array(F.collect_list(z)).alias("zones"))
    return g.select("home_id", F.to_json("zones").alias("value"))


def homes_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``/me`` documents from customers; every 10th has no ``homes`` key."""
    c = table(spark, sf_dir, "customer")
    h = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                 F.lit("Europe/London").alias("dateTimeZone"), F.lit("CELSIUS").alias("temperatureUnit"))
    doc = F.when(F.pmod("c_custkey", F.lit(10)) == 0, F.lit("{}")).otherwise(F.to_json(F.struct(F.array(h).alias("homes"))))
    return c.select(doc.alias("value"))


def meter_config_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meter list text per supplier: valid JSON for even keys, unquoted keys for odd keys."""
    s = table(spark, sf_dir, "supplier")
    ks = F.col("s_suppkey").cast("string")
    e = F.struct(F.lit("electricity").alias("kind"), F.lpad(ks, 10, "0").alias("mpan_or_mprn"),
                 F.concat(F.lit("M"), ks).alias("serial"), F.lit(None).cast("string").alias("tariff_code"))
    g = F.struct(F.lit("gas").alias("kind"), F.concat(F.lit("G"), F.lpad(ks, 9, "0")).alias("mpan_or_mprn"),
                 F.concat(F.lit("N"), ks).alias("serial"), F.lit(TARIFF_GAS).alias("tariff_code"))
    lst = F.when(_even(F.col("s_nationkey")), F.array(e, g)).otherwise(F.array(e))
    js = F.to_json(lst)
    text = F.when(_even(F.col("s_suppkey")), js).otherwise(F.regexp_replace(js, r'"([a-z_]+)":', "$1:"))
    return s.select("s_suppkey", text.alias("value"))


# ---------------------------------------------------------------- heating
# Call-for-heat levels by k % 4.
HEAT_LEVELS = ("NONE", "LOW", "MEDIUM", "HIGH")
SENSOR_CLOCK_S = 600


def day_reports_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E7 day report per (user, UTC day) from events, arrays in event-id order.

    click/view -> callForHeat (value by k%4, ``to`` = +k minutes, absent when k%13=0);
    purchase -> insideTemperature (celsius = value) and humidity = k when k is even;
    error -> settings (power OFF when k%3=0, target celsius = value, ``to`` = +30 min).
    """
    ev = table(spark, sf_dir, "events")
    k = prop_k(F.col("props"))
    # Sensors report on a ten-minute clock, so one report can hold several points of one stamp.
    stamp = format_zulu(F.when(F.col("event_type") == "purchase", floor_time("ts", SENSOR_CLOCK_S)).otherwise(F.col("ts")))
    t = F.col("event_type")
    level = F.element_at(F.array(*[F.lit(v) for v in HEAT_LEVELS]), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    to = F.when(F.pmod(k, F.lit(13)) == 0, F.lit(None).cast("string")).otherwise(
        format_zulu(plus_micros("ts", k.cast("long") * MINUTE_US)))
    cfh = F.when(t.isin("click", "view"), F.struct(F.col("event_id").alias("o"), F.struct(
        stamp.alias("from"), to.alias("to"), level.alias("value")).alias("x")))
    inside = F.when(t == "purchase", F.struct(F.col("event_id").alias("o"), F.struct(
        stamp.alias("timestamp"), F.struct(F.col("value").alias("celsius")).alias("value")).alias("x")))
    hum = F.when((t == "purchase") & (F.pmod(k, F.lit(2)) == 0), F.struct(F.col("event_id").alias("o"), F.struct(
        stamp.alias("timestamp"), k.cast("double").alias("value")).alias("x")))
    power = F.when(F.pmod(k, F.lit(3)) == 0, F.lit("OFF")).otherwise(F.lit("ON"))
    sett = F.when(t == "error", F.struct(F.col("event_id").alias("o"), F.struct(
        stamp.alias("from"), format_zulu(plus_micros("ts", HALF_HOUR_US)).alias("to"),
        F.struct(power.alias("power"), F.struct(F.col("value").alias("celsius")).alias("temperature")).alias("value")
    ).alias("x")))

    def lst(c):
        return F.transform(F.sort_array(F.collect_list(c)), lambda e: e["x"])

    # One report per (device, day), as it lands.
    g = ev.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        lst(cfh).alias("cfh"), lst(inside).alias("inside"), lst(hum).alias("hum"), lst(sett).alias("sett"))
    doc = F.struct(F.struct(F.col("cfh").alias("dataIntervals")).alias("callForHeat"),
                   F.struct(F.struct(F.col("inside").alias("dataPoints")).alias("insideTemperature"),
                            F.struct(F.col("hum").alias("dataPoints")).alias("humidity")).alias("measuredData"),
                   F.struct(F.col("sett").alias("dataIntervals")).alias("settings"))
    uid = F.col("user_id").cast("string")
    return g.select(uid.alias("device_id"), uid.alias("zone_id"), "date", F.to_json(doc).alias("value"))


def heating_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E13 heating state: per device, max ``ts`` of its error events; ids with id%9=0 have none."""
    ev = table(spark, sf_dir, "events").filter((F.col("event_type") == "error") & (F.pmod("user_id", F.lit(9)) != 0))
    uid = F.col("user_id").cast("string")
    return ev.groupBy(uid.alias("device_id"), uid.alias("zone_id")).agg(F.max("ts").alias("last_interval"))


# ---------------------------------------------------------------- landing, arrival, state codec
def land_event_splits(spark: SparkSession, sf_dir: str, root: str, splits: int = 8, repeat: int = 3) -> None:
    """Landing files for streams: events split by ``event_id % splits`` (one append each),
    plus one re-delivered split to prove de-duplication."""
    ev = table(spark, sf_dir, "events")
    for i in [*range(splits), repeat]:
        ev.filter(F.pmod("event_id", F.lit(splits)) == i).write.mode("append").parquet(root)


def arrival_time(event_id: Column, ts: Column) -> Column:
    """``ingested_at`` = ts + (event_id % 60) min; event_id % 97 = 0 arrives two days late."""
    late = F.when(F.pmod(event_id, F.lit(97)) == 0, F.lit(2 * 1440)).otherwise(F.lit(0))
    return plus_micros(ts, (F.pmod(event_id, F.lit(60)) + late).cast("long") * MINUTE_US)


def state_json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing JSON state maps ``{"<id>:<id>": iso}`` with Z, +01:00, naive and unreadable values."""
    s = heating_state(spark, sf_dir)
    uid = F.col("device_id").cast("long")
    t = F.col("last_interval")
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    val = (F.when(F.pmod(uid, F.lit(11)) == 0, F.lit("garbage"))
            .when(F.pmod(uid, F.lit(3)) == 0, F.concat(F.date_format(t, iso), F.lit("Z")))
            .when(F.pmod(uid, F.lit(3)) == 1,
                  F.concat(F.date_format(plus_micros(t, 3600 * 1_000_000), iso), F.lit("+01:00")))
            .otherwise(F.date_format(t, iso)))
    key = F.concat_ws(":", F.col("device_id"), F.col("zone_id"))
    return s.select(F.to_json(F.create_map(key, val)).alias("value"))
