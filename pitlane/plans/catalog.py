"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each reads the fixture warehouse Spark derives from the TPC-H tables in
``sf_dir`` (built once per application, then re-read as parquet).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import datetime

from pyspark.sql import functions as F

from pitlane.config import cleaned_shuffles, materialize, new_output_dir
from pitlane.functions import weather_json
from pitlane.functions.cleanse import clean, duration_text_to_us
from pitlane.operators.filters import past_events
from pitlane.operators import integrity, joins, quality, ranking, timing, upsert
from pitlane.plans import ingest, race, refresh, strategy, views
from pitlane.schemas import LAPS, WAREHOUSE
from pitlane.sources.fixtures import warehouse
from pitlane.sources import landing, session_source
from pitlane.sources.landing import read_view, register_views
from pitlane.streaming import live_timing, messages
from pitlane.streaming.lap_stream import stream_laps
from pitlane.streaming.settings import state_partitions, state_settings

Query = Callable[[SparkSession, str], DataFrame]


def _star_view(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = warehouse(spark, sf_dir)
        return fn(wh.laps, wh.drivers, wh.sessions)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _session_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    return views.session_summary(wh.laps, wh.sessions)


def _w1(**path) -> Query:
    def run(spark, sf_dir):
        raw = warehouse(spark, sf_dir).raw_laps
        return timing.cumulative_ms(raw, **path).select("session_id", "driver", "lap_number", "cum_ms")

    return run


def _w2_w3(**path) -> Query:
    def run(spark, sf_dir):
        raw = warehouse(spark, sf_dir).raw_laps
        return timing.with_gaps(raw, **path).select(
            "session_id", "driver", "lap_number", "position", "cum_ms", "gap_to_leader_ms", "interval_to_next_ms"
        )

    return run


def _w4_n3(**path) -> Query:
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        return timing.normalise_pitstops(wh.raw_laps, wh.drivers, **path)

    return run


def _n1(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return timing.normalise_laps(wh.raw_laps, wh.drivers, fill_gaps=False)[0]


def _n2(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return timing.normalise_laps(wh.raw_laps, wh.drivers, fill_gaps=True)[0]


def _f10(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return timing.normalise_laps(wh.raw_laps, wh.drivers)[1]


# A year whose sessions the base of U1 lacks.
UNSEEN_YEAR = 1995

# Injected "today" for the as-of queries (F6, L3): fixed, so results are reproducible.
AS_OF = datetime.date(2001, 7, 15)


def _u1(spark, sf_dir):
    """Into a base that lacks one year's sessions and counts one lap less in the others."""
    wh = warehouse(spark, sf_dir)
    old = wh.sessions.where(F.col("year") != UNSEEN_YEAR).withColumn("total_laps", F.col("total_laps") - 1)
    base = ingest.warehouse_sessions(old)
    return ingest.upsert_sessions(base, ingest.relanded_sessions(wh.sessions, wh.raw_laps))


def _u2(spark, sf_dir):
    """Into a base that lacks every seventh driver."""
    wh = warehouse(spark, sf_dir)
    return ingest.upsert_drivers(wh.drivers.where(F.col("driver_id") % 7 != 3), wh.raw_results)


def _u3(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    base = wh.drivers.select(clean("team").alias("team_name")).where(F.col("team_name") != "").distinct()
    return ingest.insert_teams(base, wh.raw_results)


def _u4(**path) -> Query:
    def run(spark, sf_dir):
        """Into a base that lacks every fifth lap and has an old compound on every third."""
        wh = warehouse(spark, sf_dir)
        lap = F.col("lap_number")
        base = wh.laps.where(lap % 5 != 0).withColumn("compound", F.when(lap % 3 == 0, "OLD").otherwise(F.col("compound")))
        return ingest.upsert_laps(base, wh.raw_laps, wh.drivers, **path)

    return run


def _u5(spark, sf_dir):
    """Into a base with old values, without every third lap's stop, and with stops no lap has."""
    wh = warehouse(spark, sf_dir)
    stops = timing.normalise_pitstops(wh.raw_laps, wh.drivers)
    lap = F.col("lap_number")
    old = stops.where(lap % 3 != 0).withColumns({"compound_in": F.lit("OLD"), "stop_time_ms": F.lit(1).cast("long")})
    lost = stops.where(lap % 3 == 0).withColumn("lap_number", lap + 1000)
    return ingest.upsert_pitstops(old.unionAll(lost), wh.raw_laps, wh.drivers)


def _u6(**path) -> Query:
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        seen = wh.raw_laps.select(F.col("driver").alias("driver_code"))
        return upsert.assign_ids(wh.drivers, seen, ["driver_code"], "driver_id", **path)

    return run


def _q1(spark, sf_dir):
    res = warehouse(spark, sf_dir).raw_results
    return integrity.duplicate_keys(
        res.select("session_id", clean("abbreviation").alias("driver_code")), ["session_id", "driver_code"]
    )


def _race_sessions(wh):
    return wh.sessions.where(F.col("session_type") == "Race")


def _q2(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return integrity.orphans(wh.laps, _race_sessions(wh), "session_id")


def _q3(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    deleted = wh.sessions.where(F.col("session_type") == "Qualifying")
    return integrity.cascade_delete(wh.laps, deleted, "session_id")


def _q4(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    parts = [
        integrity.null_violations(wh.sessions, "sessions", ["year", "track", "session_type"]),
        integrity.null_violations(wh.drivers, "drivers", ["driver_code", "full_name"]),
        integrity.null_violations(wh.laps, "laps", ["session_id", "driver_id"]),
        integrity.null_violations(wh.raw_results, "raw_results", ["abbreviation", "full_name", "team_name"]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _s8(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return integrity.missing_sessions(wh.sessions, wh.raw_laps, ["session_id"])


def _s10(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    laps, _ = timing.normalise_laps(wh.raw_laps, wh.drivers, fill_gaps=True)
    stops = timing.normalise_pitstops(wh.raw_laps, wh.drivers)
    return integrity.ingest_audit(wh.raw_laps, laps, laps, stops)


def _l3(spark, sf_dir):
    return ranking.latest_event(warehouse(spark, sf_dir).schedule, AS_OF)


def _strategy(fn):
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        return fn(wh.laps, wh.drivers, wh.sessions)

    run.__name__ = fn.__name__
    return run


def _g4(spark, sf_dir):
    return strategy.strategy_header(warehouse(spark, sf_dir).sessions)


def _x1(spark, sf_dir):
    return quality.drop_outliers(warehouse(spark, sf_dir).laps)


def _x2(spark, sf_dir):
    return quality.standardise(warehouse(spark, sf_dir).laps).select(
        "session_id", "driver_id", "lap_number", "compound", "lap_time_ms", "lap_time_ms_z"
    )


def _x3(spark, sf_dir):
    """The whole ingest of all landed sessions from nothing, run twice, then VA4 over its tables."""
    wh = warehouse(spark, sf_dir)
    root = new_output_dir(spark, "ingested")
    for _ in range(2):
        ingest.run_ingest(spark, wh.landed_laps, wh.raw_results, root)
    laps = upsert.read_table(spark, f"{root}/laps", LAPS)
    return views.driver_avg_laptime(laps, spark.read.parquet(f"{root}/drivers"), spark.read.parquet(f"{root}/sessions"))


def _x4(spark, sf_dir):
    """Land the raw laps by session, opening laps first; drain them in several micro-batches through
    the streaming ingest, and read the table it wrote."""
    wh = warehouse(spark, sf_dir)
    out = new_output_dir(spark, "stream")
    early = F.coalesce(F.col("lap_number") <= 3, F.lit(False))
    with cleaned_shuffles(spark):
        for part in (wh.raw_laps.where(early), wh.raw_laps.where(~early)):
            part.repartition("session_id").write.mode("append").partitionBy("session_id").parquet(f"{out}/landing")
    files = wh.sessions.count()  # of each landing, at most: so two micro-batches or more
    query = stream_laps(spark, f"{out}/landing", wh.drivers, f"{out}/laps", checkpoint=f"{out}/_checkpoint", max_files=files)
    query.awaitTermination()
    return upsert.read_table(spark, f"{out}/laps", LAPS)


def _weather_texts(wh) -> DataFrame:
    """Each session's weather as it lands, a JSON text by natural key; every seventh is cut off."""
    per = wh.weather.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("samples"), F.struct(F.min("track_temp").alias("min"), F.max("track_temp").alias("max")).alias("track"),
        F.bool_or("rainfall").alias("wet"),
    )
    text = F.to_json(F.struct("samples", "track", "wet"))
    cut = F.when(F.col("session_id") % 7 == 0, F.substring(text, 1, 11)).otherwise(text)
    keyed = per.select("session_id", cut.alias("weather"))
    return wh.sessions.select("session_id", *ingest.SESSION_KEY).join(keyed, "session_id").drop("session_id")


def _c17(spark, sf_dir):
    """The sessions' weather as a stored Variant: written, upserted from JSON, written again and read by path."""
    wh = warehouse(spark, sf_dir)
    base = materialize(weather_json.with_variant(ingest.warehouse_sessions(wh.sessions)), "c17-sessions")
    merged = materialize(weather_json.upsert_weather(base, _weather_texts(wh)), "c17-sessions")
    return weather_json.weather_fields(merged).select("session_id", *weather_json.FIELDS)


def _q4_json(spark, sf_dir):
    return weather_json.malformed_json(_weather_texts(warehouse(spark, sf_dir)), "sessions", ["weather"])


_REFRESHED: dict[tuple[str, str], str] = {}


def _refreshed(fn) -> Query:
    """A view over the stored parts, after an ingest that changed, added and emptied sessions: first a
    season is missing, every third session has another compound, and a session that is to have no laps has some."""
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        key = (spark.sparkContext.applicationId, wh.root)
        if key not in _REFRESHED:
            root = new_output_dir(spark, "refresh")
            late, other = F.col("session_id").between(500, 599), F.col("session_id") % 3 == 0
            emptied = wh.laps.where("session_id = 631").withColumn("session_id", F.lit(9991))
            first = wh.laps.where(~late).withColumn("compound", F.when(other, "OLD").otherwise(F.col("compound"))).unionByName(emptied)
            refresh.refresh_partials(spark, root, first, first)
            everything = wh.sessions.select("session_id")
            refresh.refresh_partials(spark, root, wh.laps, everything.where(late | other | (F.col("session_id") == 9991)))
            _REFRESHED[key] = root
        return fn(wh, *refresh.stored(spark, _REFRESHED[key]))

    return run


def _refreshed_view(view) -> Query:
    return _refreshed(lambda wh, partials, seen: view(partials, wh.drivers, wh.sessions))


#: Least state partitions of the registered streams.
STREAM_PARTITIONS = 4


def _state_partitions(wh) -> int:
    """For a stream of the raw laps, which holds state for each of them."""
    return state_partitions(ranking.row_count(wh.raw_laps), STREAM_PARTITIONS)


def _place_buckets(wh) -> int:
    """For timing from state: as many as keep the cars of the largest lap in small states."""
    lap = ["session_id", "lap_number"]

    def largest() -> int:
        return wh.raw_laps.groupBy(*lap).agg(F.count(F.lit(1)).alias("_cars")).agg(F.coalesce(F.max("_cars"), F.lit(0))).first()[0]

    return max(1, -(-joins.memo_by_plan(wh.raw_laps.select(*lap), "lap cars", largest) // live_timing.CARS_PER_STATE))


def _x4_state(spark, sf_dir):
    """Raw laps land out of order in two goes, each drained by a start of the stream, the second from the
    state that the first one left; the newest versions are read."""
    wh = warehouse(spark, sf_dir)
    out = new_output_dir(spark, "timing")
    part = F.pmod(F.xxhash64("session_id", "driver", "seq"), F.lit(10))
    for landed in (wh.raw_laps.where(part < 6), wh.raw_laps.where(part >= 6)):
        landed.repartition(_state_partitions(wh), F.xxhash64("seq", "driver")).write.mode("append").parquet(f"{out}/landing")
        live_timing.stream_timing(spark, f"{out}/landing", wh.drivers, f"{out}/log", f"{out}/_checkpoint",
                                  state_partitions=_state_partitions(wh), place_buckets=_place_buckets(wh)).awaitTermination()
    return live_timing.latest(spark, f"{out}/log").drop("seq")


def _lap_clock(raw: DataFrame):
    """When a lap's message is sent: all sessions run at once, a lap each 90 seconds."""
    return F.timestamp_seconds(F.col("seq") % 1_000_000 * 90)


def _land(sent: DataFrame, path: str) -> None:
    """Messages land as compressed files of bounded size, each written where its laps are read: no shuffle."""
    sent.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 500_000).json(path)


def _x4_messages(spark, sf_dir):
    """Laps as messages, some cut off, mistyped, without a driver, or with a field more; read in micro-batches
    into laps and rejected messages, of which all are returned."""
    wh = warehouse(spark, sf_dir)
    out = new_output_dir(spark, "messages")
    raw, seq = wh.raw_laps, F.col("seq")
    anonymous = F.when(seq % 83 != 2, F.col("driver"))
    sent = raw.select(
        messages.lap_key().alias("key"),
        F.to_json(F.struct(*(anonymous.alias("driver") if c == "driver" else F.col(c) for c in raw.columns))).alias("value"),
        _lap_clock(raw).alias("timestamp"), "seq",
    )
    value = (
        F.when(seq % 97 == 0, F.expr("substring(value, 1, length(value) - 9)"))
        .when(seq % 79 == 3, F.regexp_replace("value", '"lap_number":[0-9.]+', '"lap_number":"one"'))
        .when(seq % 89 == 1, F.regexp_replace("value", "^[{]", '{"sensor":7,'))
        .otherwise(F.col("value"))
    )
    _land(sent.withColumn("value", value).drop("seq"), f"{out}/landing")
    files = len(spark.read.schema(messages.MESSAGES).json(f"{out}/landing").inputFiles())
    half = -(-files // 2)  # so two micro-batches, however many files
    messages.stream_messages(spark, f"{out}/landing", f"{out}/laps", f"{out}/rejected", f"{out}/_checkpoint", max_files=half).awaitTermination()
    laps, rejected = spark.read.parquet(f"{out}/laps"), spark.read.parquet(f"{out}/rejected")
    columns = ["key", "reason", "lap_number", "lap_time_us", "compound", "unknown"]
    good = laps.withColumns({"reason": F.lit(None).cast("string"), "unknown": F.concat_ws(",", "unknown_fields")})
    return good.select(columns).unionByName(rejected.select("key", "reason"), allowMissingColumns=True)


def _x4_dedup(spark, sf_dir):
    """Messages land in three goes with replays within the watermark and some laps behind it."""
    wh = warehouse(spark, sf_dir)
    out = new_output_dir(spark, "dedup")
    sent = messages.lap_messages(wh.raw_laps, _lap_clock(wh.raw_laps)).withColumn("seq", F.substring_index("key", "/", -1).cast("long"))
    lap, car = F.col("seq") % 1_000_000, F.floor(F.col("seq") / 1_000_000) % 10
    kept_back, again = (lap == 2) & (car == 3), car == 1
    landings = [
        (lap <= 4) & ~kept_back,
        ((lap > 4) & (lap <= 8)) | ((lap == 4) & again),
        (lap > 8) | kept_back | ((lap == 8) & again),
    ]
    for landing_ in landings:
        _land(sent.where(landing_).drop("seq"), f"{out}/landing")
        with state_settings(spark, _state_partitions(wh), rocksdb=True):
            messages.stream_deduplicated(spark, f"{out}/landing", f"{out}/accepted", f"{out}/_checkpoint", delay="3 minutes").awaitTermination()
    landed = spark.read.schema(messages.MESSAGES).json(f"{out}/landing")
    accepted = spark.read.parquet(f"{out}/accepted")
    with cleaned_shuffles(spark):  # one after the other, so that their shuffles do not lie beside each other
        late = materialize(messages.late_messages(landed, accepted).select("key", F.col("reason").alias("status")), "late")
        counts = materialize(messages.landed_counts(landed, accepted), "landed-counts")
    status = accepted.select("key", F.lit("accepted").alias("status")).unionByName(late)
    return status.join(counts, "key").select("key", "status", "landed")


def _x4_join(spark, sf_dir):
    """A stream of laps joined to a stream of results two hours after the start; rows of no session move both watermarks on."""
    wh = warehouse(spark, sf_dir)
    out = new_output_dir(spark, "stream-join")
    laps = wh.raw_laps.select("session_id", "driver", "seq", _lap_clock(wh.raw_laps).alias("timestamp"))
    results = wh.raw_results.select("session_id", clean("abbreviation").alias("driver"), "team_name", F.timestamp_seconds(F.lit(7200)).alias("published"))
    results = results.where("driver <> ''")
    # The rows themselves, then twice one row of no session: the first moves the watermarks, under which the second is read.
    for day in (0, 100, 101):
        for landed, name, time in ((laps, "laps", "timestamp"), (results, "results", "published")):
            # Not NULL, which an inner side may drop before its watermark sees it.
            fill = {"session_id": F.lit(-1), "driver": F.lit("none"), time: F.timestamp_seconds(F.lit(day * 86400))}
            moved = landed.limit(1).select(*(fill.get(c, F.lit(None)).cast(t).alias(c) for c, t in landed.dtypes))
            (moved if day else landed).write.mode("append").parquet(f"{out}/{name}")
        streams = [spark.readStream.schema(df.schema).parquet(f"{out}/{name}") for df, name in ((laps, "laps"), (results, "results"))]
        joined = messages.join_results(*streams, "1 minute", "1 minute", "3 hours")
        with state_settings(spark, _state_partitions(wh), rocksdb=True):
            sink = joined.writeStream.outputMode("append").format("parquet").option("path", f"{out}/joined").option("checkpointLocation", f"{out}/_checkpoint")
            sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/joined").where("session_id >= 0").select("session_id", "driver", "seq", "team_name")


def _x5_weather(**path) -> Query:
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        return race.enrich_weather(wh.raw_laps, wh.weather, **path)

    return run


def _x5_pace(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return race.weather_pace(wh.raw_laps, wh.weather)


def _x5_traffic(spark, sf_dir):
    return race.pit_traffic(warehouse(spark, sf_dir).raw_laps)


def _x5_battles(spark, sf_dir):
    return race.pit_battles(warehouse(spark, sf_dir).raw_laps)


def _s2(spark, sf_dir):
    return ingest.results_to_drivers(warehouse(spark, sf_dir).raw_results)


def _u7(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return upsert.lookup_ids(wh.sessions, ingest.relanded_sessions(wh.sessions, wh.raw_laps),
                             ingest.SESSION_KEY, "session_id")


def _w5(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    bars = ranking.driver_row(strategy.stint_bounds(wh.laps, wh.drivers, wh.sessions))
    return bars.select("session_id", "full_name", "driver_row").distinct()


def _l4(spark, sf_dir):
    laps = warehouse(spark, sf_dir).laps
    return ranking.first_by(laps.where(F.col("lap_time_ms").isNotNull()), ["session_id", "driver_id"], ["lap_number"])


def _f6(spark, sf_dir):
    return past_events(warehouse(spark, sf_dir).schedule, AS_OF)


def _s9(spark, sf_dir):
    """S9 + S4: register the warehouse tables and every view, then read one through SQL."""
    wh = warehouse(spark, sf_dir)
    register_views(spark, {"laps": wh.laps, "drivers": wh.drivers, "sessions": wh.sessions})
    return read_view(spark, "v_session_summary", session_type="Race")


def _s1(spark, sf_dir):
    """One session by its natural key, through the landing reader."""
    wh = warehouse(spark, sf_dir)
    return landing.landed_laps(spark, f"{wh.root}/landed_laps", year=1995, event="ASIA", session="Race")


def _s1_source(spark, sf_dir):
    """The opening laps of two sessions, through the source with a partition per session."""
    path = new_output_dir(spark, "s1") + "/laps"
    landing.write_table(warehouse(spark, sf_dir).raw_laps.repartition("session_id"), path, partition_by=["session_id"])
    return session_source.read_sessions(spark, path).where("session_id IN (521, 631) AND lap_number <= 5")


def _s2_read(spark, sf_dir):
    """The results of two sessions, through the landing reader."""
    return landing.raw_results(spark, f"{warehouse(spark, sf_dir).root}/raw_results", session_ids=[521, 631])


def _s3(spark, sf_dir):
    """One season's schedule, through the landing reader."""
    return landing.schedule(spark, f"{warehouse(spark, sf_dir).root}/schedule", year=1996)


def _s5(spark, sf_dir):
    """Write the sessions partitioned by year and read them back."""
    wh = warehouse(spark, sf_dir)
    path = new_output_dir(spark, "s5") + "/sessions"
    landing.write_table(wh.sessions, path, partition_by=["year"])
    return spark.read.schema(wh.sessions.schema).parquet(path)


def _s6_s7(spark, sf_dir):
    """Rows of each table after creating it, after creating it again over rows, and after replacing it."""
    wh = warehouse(spark, sf_dir)
    root = new_output_dir(spark, "s6")
    rows = {"sessions": ingest.warehouse_sessions(wh.sessions), "drivers": wh.drivers, "laps": wh.laps}
    out = None

    def count(name: str, step: str) -> DataFrame:
        table = upsert.read_table(spark, f"{root}/{name}", WAREHOUSE[name])
        return table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), F.lit(step).alias("step"), "n")

    for step in ("created", "kept", "replaced"):
        landing.init_tables(spark, root, list(rows), replace=step == "replaced")
        for name, df in rows.items():
            now = materialize(count(name, step), "s6-count")
            out = now if out is None else out.unionAll(now)
            if step == "created":
                landing.write_table(df, f"{root}/{name}", mode="overwrite")
    return out


def _f5(spark, sf_dir):
    """the stint bars of one session."""
    wh = warehouse(spark, sf_dir)
    return strategy.stint_bounds(wh.laps, wh.drivers, wh.sessions, session_id=521)


def _l1(spark, sf_dir):
    wh = warehouse(spark, sf_dir)
    return views.ordered(views.v_pitstops(wh.laps, wh.drivers, wh.sessions), views.V_PITSTOPS_ORDER)


def _c1(spark, sf_dir):
    """C1 on text: lap times written as seconds, as minutes and as a timedelta, read back."""
    raw = warehouse(spark, sf_dir).raw_laps.where(F.col("lap_time_us").isNotNull())
    us = F.col("lap_time_us")
    seconds = F.format_string("%d.%06d", F.floor(us / 1000000), us % 1000000)
    clock = F.format_string("%d:%02d.%06d", F.floor(us / 60000000), F.floor(us / 1000000) % 60, us % 1000000)
    delta = F.concat(F.lit("0 days 00:"), F.format_string("%02d:%02d.%06d", F.floor(us / 60000000), F.floor(us / 1000000) % 60, us % 1000000))
    kind = F.col("seq") % 4
    text = F.when(kind == 0, seconds).when(kind == 1, clock).when(kind == 2, delta).otherwise(F.lit("n/a"))
    return raw.select("session_id", "seq", duration_text_to_us(text).alias("lap_time_us"))


def _c8(spark, sf_dir):
    """C8 + U1: the sessions that landed laps name, by the official event name or the short one."""
    return ingest.landed_sessions(warehouse(spark, sf_dir).landed_laps)


def _forced_star(fn) -> Query:
    def run(spark, sf_dir):
        wh = warehouse(spark, sf_dir)
        return fn(wh.laps, wh.drivers, wh.sessions, max_dim_bytes=0)

    return run


QUERIES: dict[str, Query] = {
    "va1_avg_gap_to_leader": _star_view(views.avg_gap_to_leader),
    "va2_best_laps": _star_view(views.best_laps),
    "va3_driver_avg_by_compound": _star_view(views.driver_avg_by_compound),
    "va4_driver_avg_laptime": _star_view(views.driver_avg_laptime),
    "va5_session_summary": _session_summary,
    "va6_stint_summary": _star_view(views.stint_summary),
    "va7_tyre_degradation": _star_view(views.tyre_degradation),
    "vb1_driver_avg_by_compound": _star_view(views.v_driver_avg_by_compound),
    "vb2_driver_avg_laptime": _star_view(views.v_driver_avg_laptime),
    "vb3_stint_summary": _star_view(views.v_stint_summary),
    "vb4_tyre_degradation": _star_view(views.v_tyre_degradation),
    "vb5_best_laps": _star_view(views.v_best_laps),
    "vb6_avg_gap_to_leader": _star_view(views.v_avg_gap_to_leader),
    "vb7_session_summary": _star_view(views.v_session_summary),
    "vb8_pitstops": _star_view(views.v_pitstops),
    "w1_cumulative_time": _w1(),
    "w2_w3_gaps": _w2_w3(),
    "w4_n3_pitstops": _w4_n3(),
    # The plans for inputs beyond a size bound, forced here, under the same SQL.
    "va4_driver_avg_laptime_forced": _forced_star(views.driver_avg_laptime),
    "vb3_stint_summary_forced": _forced_star(views.v_stint_summary),
    "w1_cumulative_time_forced": _w1(max_group_rows=3),
    "w2_w3_gaps_forced": _w2_w3(max_group_rows=3),
    "w4_n3_pitstops_forced": _w4_n3(max_group_rows=0),
    "u4_upsert_laps_forced": _u4(max_broadcast_bytes=0),
    "s1_landed_laps": _s1,
    "s1_session_source": _s1_source,
    "s2_read_results": _s2_read,
    "s3_read_schedule": _s3,
    "s5_write_table": _s5,
    "s6_s7_init_tables": _s6_s7,
    "f5_one_session": _f5,
    "l1_ordered_pitstops": _l1,
    "l2_ordered_bars": _strategy(strategy.ordered_bars),
    "c1_text_durations": _c1,
    "c8_event_names": _c8,
    "x3_run_ingest": _x3,
    "n1_laps_simple": _n1,
    "n2_laps_full": _n2,
    "f10_rejected_laps": _f10,
    "u1_upsert_sessions": _u1,
    "u2_upsert_drivers": _u2,
    "u3_insert_teams": _u3,
    "u4_upsert_laps": _u4(),
    "u5_upsert_pitstops": _u5,
    "u6_surrogate_keys": _u6(),
    "u6_surrogate_keys_forced": _u6(max_rows=0),
    "q1_duplicate_keys": _q1,
    "q2_orphans": _q2,
    "q3_cascade_delete": _q3,
    "q4_null_report": _q4,
    "s8_missing_sessions": _s8,
    "s10_ingest_audit": _s10,
    "l3_latest_event": _l3,
    "g1_strategy_bars": _strategy(strategy.strategy_bars),
    "g2_strategy_pit_markers": _strategy(strategy.strategy_pit_markers),
    "g3_strategy_total_pitstops": _strategy(strategy.strategy_total_pitstops),
    "g4_strategy_header": _g4,
    "x1_outlier_filter": _x1,
    "x2_standardise": _x2,
    "x4_stream_ingest": _x4,
    "c17_weather_variant": _c17,
    "q4_malformed_weather": _q4_json,
    "s9_refreshed_va1": _refreshed_view(views.avg_gap_to_leader),
    "s9_refreshed_va3": _refreshed_view(views.driver_avg_by_compound),
    "s9_refreshed_va5": _refreshed(lambda wh, partials, seen: refresh.session_summary(partials, seen, wh.sessions)),
    "s9_refreshed_va7": _refreshed_view(views.tyre_degradation),
    "s9_refreshed_vb3": _refreshed_view(views.v_stint_summary),
    "s9_refreshed_vb7": _refreshed_view(views.v_session_summary),
    "s9_refreshed_seasons": _refreshed(lambda wh, partials, seen: refresh.season_summary(partials, seen, wh.sessions)),
    "x4_stateful_timing": _x4_state,
    "x4_messages": _x4_messages,
    "x4_deduplicated": _x4_dedup,
    "x4_results_join": _x4_join,
    "x5_lap_weather": _x5_weather(),
    "x5_lap_weather_forced": _x5_weather(max_group_rows=3),
    "x5_weather_pace": _x5_pace,
    "x5_pit_traffic": _x5_traffic,
    "x5_pit_battles": _x5_battles,
    "s2_driver_results": _s2,
    "u7_session_ids": _u7,
    "w5_driver_rows": _w5,
    "l4_first_timed_lap": _l4,
    "f6_past_events": _f6,
    "s9_sql_view": _s9,
}
