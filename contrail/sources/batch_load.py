"""The batch load end to end: three CSV extracts -> checked rows -> three catalog tables, all or none.

Every line of an extract gets the rule that rejects it, or none. The rows
without one are written; how many each rule has rejected is observed by the
same job that writes, so no extract is read twice. The catalog names move to
the new data only when all three tables are complete.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.functions import geo
from contrail.operators import cleaning
from contrail.sources import landing, sinks

_S, _D = T.StringType(), T.DoubleType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# Fixed values that must equal the reference: columns of the three extracts.
REALTIME_EXTRACT = _schema(("icao24", _S), ("callsign", _S), ("origin_country", _S), ("latitude", _S), ("longitude", _S),
                           ("altitude", _D), ("speed", _D), ("heading", _D))
SCHEDULE_EXTRACT = _schema(("flight_number", _S), ("airline", _S), ("origin_airport", _S), ("destination_airport", _S),
                           ("scheduled_departure", _S), ("scheduled_arrival", _S), ("aircraft_type", _S), ("status", _S),
                           ("gate", _S))
AIRPORT_EXTRACT = _schema(("code", _S), ("name", _S), ("city", _S), ("country", _S), ("latitude", _D), ("longitude", _D))


def realtime_rows(lines: DataFrame) -> DataFrame:
    return (lines.transform(cleaning.tag_provenance, "api", "real_time")
            .transform(cleaning.coerce_numeric, ("latitude", "longitude")))


def schedule_rows(lines: DataFrame) -> DataFrame:
    return (lines.transform(cleaning.tag_provenance, "schedule", "scheduled")
            .transform(cleaning.parse_timestamps).transform(cleaning.flight_duration))


def airport_rows(lines: DataFrame) -> DataFrame:
    return lines


@dataclass(frozen=True)
class Extract:
    """A table's extract: its columns, how its lines become rows, and its rules (the first that holds rejects)."""

    schema: T.StructType
    rows: Callable[[DataFrame], DataFrame]
    rules: dict[str, Column]
    helpers: tuple[str, ...] = ()


def extracts() -> dict[str, Extract]:
    """The three tables by name, in the order of loading."""
    no_place = F.col("latitude").isNull() | F.col("longitude").isNull()
    return {
        "airports": Extract(AIRPORT_EXTRACT, airport_rows, {}),
        "scheduled_flights": Extract(SCHEDULE_EXTRACT, schedule_rows, {"bad_timestamp": ~F.col("timestamps_valid")},
                                     ("timestamps_valid",)),
        "realtime_flights": Extract(REALTIME_EXTRACT, realtime_rows, {
            "no_coordinates": no_place, "coordinates_out_of_range": ~geo.coordinates_valid()}),
    }


def checked(spark: SparkSession, path: str, of: Extract, header: bool = False) -> DataFrame:
    """The rows of an extract with ``reject``: the rule that rejects the row, null for a good one."""
    rows = of.rows(landing.csv_lines(spark, path, of.schema, header))
    reject = F.when(F.col("long_row"), "long_row")
    for name, holds in of.rules.items():
        reject = reject.when(holds, name)
    return rows.withColumn("reject", reject).drop("long_row", *of.helpers)


def load_batch(spark: SparkSession, paths: dict[str, str], location: str, names: dict[str, str] | None = None,
               header: bool = False) -> DataFrame:
    """Load the extracts at `paths` (table -> CSV path) into catalog tables; (table_name, rule, n) of every table.

    Rule 'loaded' counts the rows written, the others those left out. An
    extract that is missing, or has no good row, keeps the table's old rows
    (rule 'kept_old', 0). If any table's job fails, no name moves, and the
    error is raised when all tables have been tried.
    """
    names = names or {}
    folders, told, failed = {}, [], {}
    for table, of in extracts().items():
        if table not in paths or not landing.path_exists(spark, paths[table]):
            told.append((table, "kept_old", 0))
            continue
        rules = ["long_row", *of.rules]
        seen = Observation(f"load of {table}")
        rows = checked(spark, paths[table], of, header).observe(
            seen, F.count_if(F.col("reject").isNull()).alias("loaded"),
            *(F.count_if(F.col("reject") == r).alias(r) for r in rules))
        folder = sinks._new_folder(f"{location.rstrip('/')}/{table}")
        try:
            rows.filter(F.col("reject").isNull()).drop("reject").write.parquet(folder)
        except Exception as e:  # noqa: BLE001 - the other tables are tried, then it is raised
            failed[table] = e
            continue
        counts = seen.get
        told += [(table, r, counts[r]) for r in rules]
        if counts["loaded"]:
            folders[names.get(table, table)] = folder
            told.append((table, "loaded", counts["loaded"]))
        else:
            told.append((table, "kept_old", 0))
    if failed:
        first = next(iter(failed.values()))
        raise RuntimeError(f"nothing loaded, as these tables failed: {', '.join(failed)}") from first
    sinks.switch_together(spark, folders)
    return spark.createDataFrame(told, "table_name string, rule string, n long")
