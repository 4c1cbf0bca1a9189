"""Report documents: named sections of records, written as JSON and read back.

A document is a folder with one folder of JSON records per section. Sections
are written by the partitions they have, so none is pulled into one task; a
reader that wants one nested document collects a bounded section itself
(``reports.route_traffic_report`` does so for its top routes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.operators import anomalies, ml, realtime, reports

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

Sections = dict[str, DataFrame]


def batch_documents(flights: DataFrame) -> dict[str, Sections]:
    """The documents on scheduled flights: traffic, airlines, patterns, summary."""
    return {
        "airport_traffic": {"routes": reports.route_traffic(flights)},
        "airline_performance": {"airlines": reports.airline_performance(flights)},
        "flight_patterns": {"hours": reports.hourly_patterns(flights), "aircraft": reports.aircraft_usage(flights)},
        "ml_preparation": {"summary": ml.feature_summary(ml.ml_features(flights))},
    }


def realtime_documents(snapshot: DataFrame) -> dict[str, Sections]:
    """The documents on the real-time table: the load's summary and the global report."""
    return {
        "realtime_processing": {"summary": realtime.realtime_summary(snapshot),
                                "sources": realtime.source_counts(snapshot)},
        "realtime_report": {"overview": realtime.rt_global_overview(snapshot),
                            "regions": realtime.rt_region_distribution(snapshot),
                            "altitude": realtime.rt_altitude_stats(snapshot),
                            "speed": realtime.rt_speed_stats(snapshot),
                            "quality": realtime.rt_quality_stats(snapshot),
                            "top_airlines": realtime.rt_top_airlines(snapshot),
                            "top_countries": realtime.rt_top_countries(snapshot)},
    }


def anomaly_documents(recent: DataFrame) -> dict[str, Sections]:
    return {"anomalies": {"counts": anomalies.anomaly_report(recent), "first": anomalies.anomaly_list(recent)}}


def summary_documents(flights: DataFrame, positions: DataFrame, airports: DataFrame) -> dict[str, Sections]:
    return {"executive_summary": {"summary": reports.executive_summary(flights, positions, airports)}}


#: Columns that name a record; by default those of text.
RECORD_KEYS = {("flight_patterns", "hours"): ("departure_hour",), ("executive_summary", "summary"): (),
               ("ml_preparation", "summary"): ()}


def write_document(sections: Sections, path: str) -> dict[str, T.StructType]:
    """Write every section under `path`; the schemas to read them back with."""
    for name, df in sections.items():
        df.write.mode("overwrite").option("timestampNTZFormat", TS_FORMAT).json(f"{path}/{name}")
    return {name: df.schema for name, df in sections.items()}


def read_document(spark: SparkSession, path: str, schemas: dict[str, T.StructType]) -> Sections:
    return {name: spark.read.schema(schema).option("timestampNTZFormat", TS_FORMAT).json(f"{path}/{name}")
            for name, schema in schemas.items()}


def record_counts(documents: dict[str, Sections]) -> DataFrame:
    """(document, section, n_records) over all sections."""
    out = None
    for name, sections in documents.items():
        for section, df in sections.items():
            one = df.agg(F.count(F.lit(1)).alias("n_records")).select(
                F.lit(name).alias("document"), F.lit(section).alias("section"), "n_records")
            out = one if out is None else out.unionByName(one)
    return out


def record_values(documents: dict[str, Sections]) -> DataFrame:
    """(document, section, record, field, value): every number in every record of the documents, nulls left out."""
    out = None
    for name, sections in documents.items():
        for section, df in sections.items():
            keys = RECORD_KEYS.get((name, section), tuple(f.name for f in df.schema if isinstance(f.dataType, T.StringType)))
            numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in keys]
            record = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys)) if keys else F.lit("")
            fields = F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).cast("double").alias("value")) for c in numbers))
            one = df.select(F.lit(name).alias("document"), F.lit(section).alias("section"), record.alias("record"),
                            F.inline(fields)).filter("value IS NOT NULL")
            out = one if out is None else out.unionByName(one)
    return out
