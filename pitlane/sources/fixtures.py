"""Fixture mapping: derive the lap-timing warehouse from the TPC-H test tables.

The test data is TPC-H shaped, so every warehouse and landing table is a fixed
mapping over ``lineitem, orders, supplier, nation, region`` (FIXTURES.md §3):
an order's date, priority and status pick the session, a lineitem's supplier
is the driver, and the lineitem's position among its (session, driver)
siblings is the lap number.

The mapping runs once per data folder as one Spark job that writes parquet to
the shared folder (``spark.checkpoint.dir``); the analytics read those
tables, which is how the warehouse is used in production too.
"""

from __future__ import annotations

import hashlib
import inspect
import sys
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane import config, schemas
from pitlane.config import new_output_dir, shared_base
from pitlane.operators import joins, ranking
from pitlane.operators.joins import join_dim
from pitlane.operators.ranking import group_row_number, running_sum

# TPC-H fixes region at 5 rows and nation at 25 rows at every scale factor.
TPCH_FIXED_ROWS = {"region": 5, "nation": 25}

# Fixed values of the mapping (FIXTURES.md §3), in natural order.
COMPOUND_BY_CODE = ["SOFT", "MEDIUM", "HARD", "INTERMEDIATE", "WET", "UNKNOWN"]  # code 6 -> NULL
LAP_BASE_MS, LAP_STEP_MS, LAP_BUCKETS = 80000, 97, 50
GAP_STEP_MS, AHEAD_STEP_US, PIT_LAP_US = 1371, 137000, 90000000
UNRACED_SESSION = (9991, 2002, "UNRACED", "Race", 0)
NO_TIME_SORT_MS = 2000000000
WEATHER_FROM_MS, WEATHER_SLOT_MS, WEATHER_SLOTS = 100000, 10000, 100
SEQ_STEP = 1000000  # the frame holds a car's laps together, in order

_LAP_ORDER = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus",
]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fixed_dim(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A TPC-H table whose row count the spec fixes at every scale (``TPCH_FIXED_ROWS``):
    broadcast on that proven bound, without counting it."""
    assert name in TPCH_FIXED_ROWS
    return F.broadcast(_read(spark, sf_dir, name).select(*cols))


def _compound(driver_id: Column, stint_no: Column) -> Column:
    code = (driver_id * 3 + stint_no) % 7
    expr = F.lit(None).cast("string")
    for i in reversed(range(len(COMPOUND_BY_CODE))):
        expr = F.when(code == i, F.lit(COMPOUND_BY_CODE[i])).otherwise(expr)
    return expr


def lap_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per lineitem with session, driver, lap number and position.

    Lap numbering per (session, driver) and the running-time ranking per
    (session, lap) use ``group_row_number``: a (session, lap) group holds
    every car of a lap and grows with the data, so once the largest group
    passes the bound it is numbered slice by slice instead of in one task. Lap numbering orders by the full
    source tuple because (l_orderkey, l_linenumber) is not unique in the
    test data. The running sum per (session, driver) is ``running_sum``,
    checked the same way. One aggregate, the laps of each car, sizes all three: the cars of a
    session are its largest (session, lap) group, since every car has a lap 1.
    """
    li = _read(spark, sf_dir, "lineitem").select("l_suppkey", *_LAP_ORDER)
    orders = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    prio = F.substring("o_orderpriority", 1, 1).cast("int")
    year = F.year("o_orderdate")
    base = li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        ((year - 1990) * 100 + prio * 10
         + F.when(F.col("o_orderstatus").isin("O", "F"), 1).otherwise(2)).cast("int").alias("session_id"),
        year.cast("int").alias("year"),
        (prio - 1).alias("track_key"),
        F.when(F.col("o_orderstatus") == "P", "Qualifying").otherwise("Race").alias("session_type"),
        F.col("l_suppkey").cast("int").alias("driver_id"),
        *_LAP_ORDER,
    )
    cars = base.groupBy("session_id", "driver_id").agg(F.count(F.lit(1)).alias("_laps"))
    sizes = cars.groupBy("session_id").agg(F.max("_laps").alias("_laps"), F.count(F.lit(1)).alias("_cars"))
    most_laps, most_cars = (n or 0 for n in sizes.agg(F.max("_laps"), F.max("_cars")).first())
    numbered = group_row_number(
        base, ["session_id", "driver_id"], [F.col(c).asc_nulls_last() for c in _LAP_ORDER], out="lap_number", largest=most_laps
    )
    timed = numbered.select(
        "session_id", "year", "track_key", "session_type", "driver_id", "lap_number",
        "l_quantity", "l_discount",
        (F.expr("(lap_number - 1) div 4") + 1).cast("int").alias("stint_no"),
        F.when(F.col("l_tax") == 0.0, F.lit(None)).otherwise(
            LAP_BASE_MS + (F.floor("l_extendedprice").cast("int") % LAP_BUCKETS) * LAP_STEP_MS
        ).cast("int").alias("lap_time_ms"),
    )
    cum = running_sum(timed, ["session_id", "driver_id"], "lap_number", "lap_time_ms", "_cum", largest=most_laps).withColumn(
        "cum_ms", F.when(F.col("lap_time_ms").isNotNull(), F.col("_cum").cast("int"))
    ).drop("_cum")
    ranked = group_row_number(
        cum, ["session_id", "lap_number"],
        [F.coalesce("cum_ms", F.lit(NO_TIME_SORT_MS)), F.col("driver_id")], out="_rank", largest=most_cars,
    )
    return ranked.withColumn(
        "position",
        F.when(F.col("l_quantity") == 50.0, F.lit(None)).otherwise(F.col("_rank")).cast("int"),
    ).drop("cum_ms", "_rank")


def laps_from(src: DataFrame) -> DataFrame:
    t = F.col("lap_time_ms")
    no_gap = F.col("l_quantity") <= 5.0
    return src.select(
        "session_id", "driver_id", "lap_number",
        F.when(F.col("l_discount") == 0.0, F.lit(None)).otherwise(F.col("stint_no")).cast("int").alias("stint_id"),
        _compound(F.col("driver_id"), F.col("stint_no")).alias("compound"),
        t.alias("lap_time_ms"),
        F.expr("lap_time_ms div 4").cast("int").alias("sector1_ms"),
        F.expr("lap_time_ms div 2").cast("int").alias("sector2_ms"),
        F.expr("lap_time_ms - lap_time_ms div 4 - lap_time_ms div 2").cast("int").alias("sector3_ms"),
        "position",
        F.when(no_gap, F.lit(None)).otherwise(F.col("position") * GAP_STEP_MS).cast("int").alias("gap_to_leader_ms"),
        F.when(no_gap, F.lit(None)).otherwise(F.lit(GAP_STEP_MS)).cast("int").alias("interval_to_next_ms"),
    )


def raw_laps_from(src: DataFrame) -> DataFrame:
    lap = F.col("lap_number").cast("long")
    qty = F.col("l_quantity")
    t = F.col("lap_time_ms").cast("long")
    return src.select(
        "session_id",
        (F.col("driver_id").cast("long") * SEQ_STEP + lap).alias("seq"),
        F.concat(F.when(F.col("driver_id") % 20 == 7, "X").otherwise("D"), F.col("driver_id").cast("string")).alias("driver"),
        F.col("lap_number").cast("double").alias("lap_number"),
        F.when(F.col("l_discount") == 0.0, F.lit(None)).otherwise(F.col("stint_no")).cast("double").alias("stint"),
        _compound(F.col("driver_id"), F.col("stint_no")).alias("compound"),
        (t * 1000 + (qty.cast("int") % 2) * 600).alias("lap_time_us"),
        (F.expr("lap_time_ms div 4") * 1000).cast("long").alias("sector1_us"),
        (F.expr("lap_time_ms div 2") * 1000).cast("long").alias("sector2_us"),
        (F.expr("lap_time_ms - lap_time_ms div 4 - lap_time_ms div 2") * 1000).cast("long").alias("sector3_us"),
        F.col("position").cast("double").alias("position"),
        F.when(qty <= 5.0, qty.cast("long") * (GAP_STEP_MS * 1000)).alias("gap_to_leader_us"),
        F.when(qty <= 3.0, qty.cast("long") * AHEAD_STEP_US).alias("interval_to_ahead_us"),
        F.when(lap % 4 == 0, lap * PIT_LAP_US).alias("pit_in_us"),
        F.when((lap % 8 == 0) & (qty > 45.0), lap * PIT_LAP_US - 60000000)
        .when((lap % 4 == 1) & (lap > 1), (lap - 1) * PIT_LAP_US + 20000000 + qty.cast("long") * 100000)
        .alias("pit_out_us"),
    )


def landed_laps_from(raw_laps: DataFrame, sessions: DataFrame) -> DataFrame:
    """The raw laps as they land: session by natural key. In even years the event has no official name."""
    even = F.col("year") % 2 == 0
    named = sessions.select(
        "session_id", "year", "track", F.col("session_type").alias("session_name"),
        F.when(even, F.col("track")).otherwise(F.concat(F.lit("GP "), F.col("track"))).alias("event_name"),
        F.when(even, F.lit("")).otherwise(F.col("track")).alias("official_event_name"),
    )
    keyed = join_dim(raw_laps, named, "session_id")
    return keyed.select(*schemas.LANDED_LAPS.fieldNames())


def drivers_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = _fixed_dim(spark, sf_dir, "nation", "n_nationkey", "n_name")
    k = F.col("s_suppkey")
    return sup.join(nation, sup.s_nationkey == nation.n_nationkey).select(
        k.cast("int").alias("driver_id"),
        F.concat(F.lit("D"), k.cast("string")).alias("driver_code"),
        F.when(k % 10 == 9, F.concat(F.lit("Supplier#"), F.lpad((k - 1).cast("string"), 9, "0")))
        .otherwise(F.col("s_name")).alias("full_name"),
        F.when(k % 25 == 24, F.lit(None)).otherwise(F.col("n_name")).alias("team"),
    )


def sessions_from(spark: SparkSession, sf_dir: str, src: DataFrame) -> DataFrame:
    region = _fixed_dim(spark, sf_dir, "region", "r_regionkey", "r_name")
    per = src.groupBy("session_id", "year", "track_key", "session_type").agg(
        F.max("lap_number").cast("int").alias("total_laps")
    )
    raced = per.join(region, per.track_key == region.r_regionkey).select(
        "session_id", "year", F.col("r_name").alias("track"), "session_type", "total_laps"
    )
    unraced = spark.createDataFrame([UNRACED_SESSION], raced.schema)
    return raced.unionByName(unraced)


def raw_results_from(src: DataFrame, drivers: DataFrame) -> DataFrame:
    pairs = src.select("session_id", "driver_id").distinct()
    d = F.col("driver_id")
    return (
        join_dim(pairs, drivers.select("driver_id", "full_name", "team"), "driver_id")
        .select(
            "session_id",
            F.when(d % 20 == 7, F.lit("")).otherwise(F.concat(F.lit(" D"), d.cast("string"), F.lit(" "))).alias("abbreviation"),
            F.when(d % 10 == 3, F.lit(None)).otherwise(F.col("full_name")).alias("full_name"),
            F.when(d % 25 == 24, F.lit("")).otherwise(F.col("team")).alias("team_name"),
            F.concat(F.lit("Team "), (d % 5).cast("string")).alias("team"),
        )
        .distinct()
    )


def schedule_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders").select("o_orderdate", "o_orderpriority")
    region = _fixed_dim(spark, sf_dir, "region", "r_regionkey", "r_name")
    o = orders.join(region, region.r_regionkey == F.substring("o_orderpriority", 1, 1).cast("int") - 1)
    return o.groupBy(F.year("o_orderdate").cast("int").alias("year"), F.col("r_name").alias("event_name")).agg(
        F.max("o_orderdate").alias("event_date")
    )


def weather_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather samples on the sessions' clocks out of the events: a user's events belong to one track
    and year, and their time falls into 10-second slots, so samples tie; every fiftieth has no time."""
    ev = _read(spark, sf_dir, "events")
    # The stored time is without zone: counted from an epoch without zone, whatever the session's.
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    slot = F.floor(us / (WEATHER_SLOT_MS * 1000)) % WEATHER_SLOTS
    user = F.col("user_id")
    return ev.select(
        ((user % 7 + 2) * 100 + (F.floor(user / 7) % 5 + 1) * 10 + F.when(F.col("event_type") == "error", 2).otherwise(1)).cast("int").alias("session_id"),
        F.when(F.col("event_id") % 50 != 0, slot * WEATHER_SLOT_MS + WEATHER_FROM_MS).cast("long").alias("at_ms"),
        F.col("event_id").cast("long").alias("sample"),
        F.col("value").cast("double").alias("track_temp"),
        (F.col("event_type") == "purchase").alias("rainfall"),
        F.get_json_object("props", "$.k").cast("int").alias("wind"),
    )


@dataclass(frozen=True)
class Warehouse:
    """Written fixture tables. They are write-once, so each table's DataFrame
    (and its file listing) is built once and shared by every query."""

    spark: SparkSession
    root: str
    _tables: dict = field(default_factory=dict, compare=False, repr=False)

    def table(self, name: str) -> DataFrame:
        df = self._tables.get(name)
        if df is None:
            df = self._tables[name] = self.spark.read.parquet(f"{self.root}/{name}")
        return df

    sessions = property(lambda self: self.table("sessions"))
    drivers = property(lambda self: self.table("drivers"))
    laps = property(lambda self: self.table("laps"))
    raw_laps = property(lambda self: self.table("raw_laps"))
    raw_results = property(lambda self: self.table("raw_results"))
    landed_laps = property(lambda self: self.table("landed_laps"))
    schedule = property(lambda self: self.table("schedule"))
    weather = property(lambda self: self.table("weather"))


def build(spark: SparkSession, sf_dir: str, root: str) -> Warehouse:
    """Run the mapping and write every table under ``root``.

    The lineitem-sized intermediate is written once and re-read, which cuts
    the lineage of the two windows before the four derived tables fan out.
    """
    lap_source(spark, sf_dir).write.parquet(f"{root}/_lap_source")
    src = spark.read.parquet(f"{root}/_lap_source")
    drivers_from(spark, sf_dir).write.parquet(f"{root}/drivers")
    drivers = spark.read.parquet(f"{root}/drivers")
    derived = {
        "laps": laps_from(src),
        "raw_laps": raw_laps_from(src),
        "sessions": sessions_from(spark, sf_dir, src),
        "raw_results": raw_results_from(src, drivers),
        "schedule": schedule_from(spark, sf_dir),
        "weather": weather_from(spark, sf_dir),
    }
    # Independent write jobs, submitted together so their tasks share the cores.
    with ThreadPoolExecutor(max_workers=len(derived)) as pool:
        for f in [pool.submit(df.write.parquet, f"{root}/{name}") for name, df in derived.items()]:
            f.result()
    written = Warehouse(spark, root)
    landed_laps_from(written.raw_laps, written.sessions).write.parquet(f"{root}/landed_laps")
    return Warehouse(spark, root)


_BUILT: dict[tuple[str, str], Warehouse] = {}
_LOCK = threading.Lock()


def _build_id(spark: SparkSession, sf_dir: str) -> str:
    """Data folder, its files (names, sizes, times) and the code that defines the mapping: neither
    changed data nor a changed mapping ever reuses a build."""
    h = hashlib.sha1(sf_dir.rstrip("/").encode())
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{name}.parquet")
        for f in path.getFileSystem(conf).listStatus(path):
            h.update(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}\n".encode())
    for mod in (sys.modules[__name__], schemas, ranking, joins, config):
        h.update(inspect.getsource(mod).encode())
    return h.hexdigest()[:16]


TABLES = ("sessions", "drivers", "laps", "raw_laps", "landed_laps", "raw_results", "schedule", "weather")
SOURCES = ("lineitem", "orders", "supplier", "nation", "region", "events")


def _finished_build(spark: SparkSession, pointer: str) -> str | None:
    """The root a pointer names, if every table under it is still readable."""
    try:
        row = spark.read.parquet(pointer).first()
        if row is None:
            return None
        for t in TABLES:
            spark.read.parquet(f"{row['root']}/{t}").schema
    except Exception:  # no pointer yet, one still being written, or a removed build
        return None
    return row["root"]


def warehouse(spark: SparkSession, sf_dir: str, reuse: bool = True) -> Warehouse:
    """The fixture warehouse for ``sf_dir``: built once, then shared.

    A finished build is recorded by a pointer table under the shared folder,
    written only after every table is in place, so later applications
    (``reuse=True``) read it instead of rebuilding; an interrupted build
    leaves no pointer and is simply redone in a fresh folder.
    """
    build_id = _build_id(spark, sf_dir)
    key = (spark.sparkContext.applicationId, build_id)
    with _LOCK:
        wh = _BUILT.get(key)
        if wh is not None:
            return wh
        pointer = f"{shared_base(spark)}/pitlane/warehouse-{build_id}.pointer"
        root = _finished_build(spark, pointer) if reuse else None
        if root is None:
            root = new_output_dir(spark, "warehouse")
            build(spark, sf_dir, root)
            spark.createDataFrame([(root,)], "root string").coalesce(1).write.mode("overwrite").parquet(pointer)
        wh = _BUILT[key] = Warehouse(spark, root)
        return wh
