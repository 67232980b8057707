"""Shapes the given ``events`` / ``customer`` tables as vehicle telemetry, for the catalogue.

Every event becomes a reading and every customer a vehicle. The numbers are arbitrary; they
spread the readings over plausible ranges and make some of them bad.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odolake.functions.numeric import unit_label

MODELS = (("Ostrava", "E3", 58.0), ("Lumo", "Kastenwagen", 77.5), ("Ostrava", "E5 lang", 91.25))
RELEASES = {"AUTOMOBILE": "4.1", "BUILDING": "4.2", "FURNITURE": "5.0", "MACHINERY": "5.3"}
OTHER_RELEASE = "6.0"

# stated, so that no job has to look into the files for them
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def readings(events: DataFrame) -> DataFrame:
    """Raw-layer rows: one per event, in the column order of the raw table, no payload.

    Every fiftieth unit reports under an id that no vehicle has.
    """
    k = F.get_json_object("props", "$.k").cast("int")
    unit = F.col("user_id")
    battery = F.lit(100.0) - F.col("value") / F.lit(4.0)
    warm = F.when(unit % 40 == 7, F.lit(20.0)).otherwise(F.lit(0.0))
    click = F.col("event_type") == "click"
    ts = F.col("ts").cast("timestamp")
    return events.select(
        (F.col("event_id") + 1).alias("id"),
        F.when(unit % 50 == 0, F.concat(F.lit("VF-U"), unit.cast("string"))).otherwise(unit_label("VF-", unit))
        .alias("vehicle_id"),
        ts.alias("event_timestamp"),
        (ts + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k)).alias("received_at"),
        battery.alias("battery_pct"),
        (battery * F.lit(0.5625)).alias("state_of_charge_kwh"),
        (F.lit(300.0) + battery * F.lit(0.85)).alias("voltage_v"),
        F.when(click, -(k * F.lit(1.25) + F.lit(2.0))).otherwise(k * F.lit(1.75) + F.lit(12.5)).alias("current_a"),
        F.when((F.col("event_type") == "error") & (k == 99), F.lit(None))
        .otherwise(F.lit(24.0) + k * F.lit(0.625) + warm).cast("double").alias("motor_temp_c"),
        (F.lit(47.0) + (unit % 30) / F.lit(8.0)).alias("latitude"),
        (F.lit(8.0) + k / F.lit(50.0)).alias("longitude"),
        (F.col("event_id") * 7 % 120 + F.lit(5)).cast("double").alias("speed_kmh"),
        click.alias("regen_braking_event"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(table(spark, sf_dir, "events"))


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle metadata, one row per customer."""
    customer = table(spark, sf_dir, "customer")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    kind = F.col("c_custkey") % 3

    def by_model(i: int) -> Column:
        return F.when(kind == 0, F.lit(MODELS[0][i])).when(kind == 1, F.lit(MODELS[1][i])).otherwise(F.lit(MODELS[2][i]))

    release = F.coalesce(
        *[F.when(F.col("c_mktsegment") == seg, v) for seg, v in RELEASES.items()], F.lit(OTHER_RELEASE)
    )
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            unit_label("VF-", F.col("c_custkey")).alias("vehicle_id"),
            F.col("c_name").alias("fleet_label"),
            by_model(0).alias("make"), by_model(1).alias("model"),
            (F.lit(2015) + F.col("c_custkey") % 9).cast("int").alias("manufacture_year"),
            by_model(2).alias("rated_capacity_kwh"),
            F.col("r_name").alias("region"),
            release.alias("software_version"),
        )
    )


def _iso(ts: Column, pattern: str = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") -> Column:
    return F.date_format(ts, pattern)


def in_order(rows: DataFrame, path: str, order: list[str], files: int) -> str:
    """``rows`` as Parquet files that a stream reads one after the other, in the given order."""
    rows.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(path)
    jvm = rows.sparkSession._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    store = place.getFileSystem(rows.sparkSession._jsc.hadoopConfiguration())
    for k, name in enumerate(sorted(f.getPath().toString() for f in store.globStatus(place))):
        store.setTimes(jvm.org.apache.hadoop.fs.Path(name), 1_700_000_000_000 + 60_000 * k, -1)  # streams go by age
    return path


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a file stream."""
    return spark.readStream.schema(SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def raw_events(rows: DataFrame) -> DataFrame:
    """Readings as raw JSON text with the sender's address, a good share of them malformed in known ways.

    A missing temperature is written as ``null`` or left out.
    """
    case = F.col("id") % 44

    def pick(default: Column, cases: dict[int, str | Column]) -> Column:
        out = None
        for number, text in cases.items():
            value = F.lit(text) if isinstance(text, str) else text
            out = F.when(case == number, value) if out is None else out.when(case == number, value)
        return out.otherwise(default)

    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    fmt = lambda c, n=4: F.format_string(f"%.{n}f", c)
    ts, vid = F.col("event_timestamp"), F.col("vehicle_id")
    unit = pick(quoted(vid), {
        9: '"bus 12"', 10: "7", 19: F.concat(F.lit('"  '), vid, F.lit(' "')), 26: '""',
        27: F.concat(F.lit('"\\t'), vid, F.lit('\\n"')), 28: F.concat(F.lit('"'), vid, F.lit('\\u00a0"')),
    })
    stamp = pick(quoted(F.concat(_iso(ts), F.lit("+00:00"))), {
        12: quoted(F.concat(_iso(F.col("received_at") + F.expr("INTERVAL 90 SECONDS")), F.lit("Z"))),
        13: '"yesterday at noon"', 16: quoted(F.concat(_iso(ts), F.lit("Z"))),
        17: quoted(F.concat(_iso(ts + F.expr("INTERVAL 3 HOURS")), F.lit("+03:00"))),
        20: "86400", 24: quoted(_iso(ts, "yyyyMMdd'T'HHmmss")),
        29: F.concat(F.lit('"'), _iso(ts), F.lit('+00:00\\t"')),
    })
    battery = pick(fmt(F.col("battery_pct")), {
        4: "null", 5: '"61.5"', 6: '"half"', 7: "100.25", 15: "true", 23: "-3", 25: "NaN", 30: "-0.0005", 31: "-0.00002",
        32: "25000000", 33: "3e22", 34: '"4_2"', 35: '"_42"', 36: '" Infinity\\t"', 37: '"1e400"',
    })
    temp = pick(F.when(F.col("motor_temp_c").isNull(), "null").otherwise(fmt(F.col("motor_temp_c"), 3)), {8: "181.5"})
    regen = pick(F.col("regen_braking_event").cast("string"), {11: "0", 22: '"true"'})
    left_out = {
        "battery_pct": case == 3, "motor_temp_c": F.col("motor_temp_c").isNull() & (F.col("id") % 2 == 0) & (case != 8)}
    members = [
        ("vehicle_id", unit), ("event_timestamp", stamp), ("battery_pct", battery),
        ("state_of_charge_kwh", fmt(F.col("battery_pct") * F.lit(0.5), 6)),
        ("voltage_v", fmt(F.col("voltage_v"), 6)), ("current_a", fmt(F.col("current_a"), 2)),
        ("motor_temp_c", temp), ("latitude", fmt(F.col("latitude"), 3)),
        ("longitude", fmt(F.col("longitude"), 2)), ("speed_kmh", fmt(F.col("speed_kmh"), 1)),
        ("regen_braking_event", regen),
    ]
    parts = []
    for name, text in members:
        member = F.concat(F.lit(f'"{name}": '), text)
        parts.append(F.when(left_out[name], F.lit(None)).otherwise(member) if name in left_out else member)
    extra = pick(F.lit(None).cast("string"), {
        14: F.concat(F.lit('"note": "'), F.repeat(F.lit("z"), 4500), F.lit('"')), 18: '"speed_kmh": 41.0'})
    body = F.concat(F.lit("{"), F.concat_ws(", ", *parts, extra), F.lit("}"))
    raw = pick(body, {0: "", 1: '{"vehicle_id": ', 2: '["a", 3]', 21: "null"})
    address = F.concat(F.lit("10.1.0."), (F.col("id") % 200).cast("string"))
    return rows.select("id", "received_at", raw.cast(T.StringType()).alias("raw_payload"), address.alias("client_ip"))
