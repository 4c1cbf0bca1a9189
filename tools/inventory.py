"""Write docs/INVENTORY.md: every registered key, its SURVEY section, the
library operators its query calls, and its check (SQL oracle or rows-only)."""

from __future__ import annotations

import ast
import inspect
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contrail.plans.registry import REGISTRY  # noqa: E402

SECTIONS = [
    ("2.1 Sources and scans", "scan_table scan_positions flight_etl ingest_state_vectors ingest_nested_live "
                              "ingest_flat_live ingest_merge_snapshot read_csv_lenient read_or_empty airport_dimension read_report_json"),
    ("2.2 Sinks", "write_csv_export load_replace load_metadata declare_tables write_report_json report_documents report_values export_all"),
    ("2.3 Projections, cleaning, enrichment",
     "stamp_extraction tag_provenance clean_callsign coerce_numeric derive_kinematics require_keys "
     "valid_coordinates parse_timestamps flight_duration carrier_prefix harmonize_schema normalize_text "
     "presence_flags classify_region quality_score altitude_band quality_tier on_time_tier map_feed_defaults "
     "nan_to_null route_key"),
    ("2.6 Joins", "attach_route_stats attach_route_moments flag_unusual_hours"),
    ("2.7 Batch reports", "route_traffic route_traffic_report airline_performance best_on_time_airline "
                          "busiest_airline hourly_patterns peak_hour aircraft_usage most_used_aircraft "
                          "schedule_overview table_counts executive_summary top_n_slice"),
    ("2.8 Data-quality checks", "dq_freshness dq_completeness dq_duplicates dq_invalid_coordinates "
                                "dq_same_endpoints dq_airline_counts dq_top_routes dq_status_counts"),
    ("2.9 Real-time merge and reports",
     "merge_sources dedupe_first rank_by_quality realtime_summary rt_global_overview rt_region_distribution "
     "rt_altitude_stats rt_speed_stats rt_quality_stats rt_top_airlines rt_top_countries source_extract_stats "
     "source_last_update latest_flights"),
    ("2.10 Live views", "live_flights regional_stats regional_stats_rollup flight_map source_quality live_metrics "
                        "live_metrics_rollup altitude_distribution"),
    ("2.11 ML features, model, anomalies",
     "ml_features feature_summary encode_labels stratified_split stratified_split_counts train_delay_model "
     "score_delays model_metrics save_model duration_anomalies duration_anomalies_moments duration_anomalies_all_dates "
     "scheduling_anomalies scheduling_anomalies_all_dates performance_anomalies "
     "performance_anomalies_share_066 anomaly_report anomaly_list insight_rules insight_rules_before_training model_checks"),
    ("2.16 Batch load end to end", "batch_load_realtime batch_load_scheduled batch_load_airports batch_load_rejects"),
    ("2.14 Streaming", "stream_feeds stream_positions stream_dedupe stream_snapshot stream_region_windows stream_stale_alerts feed_alerts"),
]
LIB = ("batch_load", "rollups", "feeds", "bounded", "alerts", "docs", "cleaning", "merge", "realtime", "live", "reports", "checks", "anomalies", "ml", "landing", "sinks",
       "sp", "scoring", "testdata", "lw")


def operators_of(fn) -> list[str]:
    tree = ast.parse(inspect.getsource(fn).lstrip())
    out = []
    for n in ast.walk(tree):
        if isinstance(n, ast.Attribute) and isinstance(n.value, ast.Name) and n.value.id in LIB:
            name = f"{n.value.id}.{n.attr}".replace("sp.", "streaming.").replace("lw.", "landing_writers.")
            if name not in out:
                out.append(name)
    return out


def main() -> None:
    lines = ["# Query inventory", "",
             "Generated by `tools/inventory.py` from `contrail/plans/registry.py`. Check: SQL = DuckDB",
             "oracle in `oracle_sql()`; rows = rows-only.", ""]
    seen = set()
    for title, keys in SECTIONS:
        lines += [f"## {title}", "", "| key | operators used | check |", "| --- | --- | --- |"]
        for k in keys.split():
            fn, text = REGISTRY[k]
            seen.add(k)
            ops = ", ".join(f"`{o}`" for o in operators_of(fn)) or "(view only)"
            lines.append(f"| `{k}` | {ops} | {'SQL' if text else 'rows'} |")
        lines.append("")
    missing = sorted(set(REGISTRY) - seen)
    if missing:
        lines += ["## Other", ""] + [f"* `{k}`" for k in missing]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "INVENTORY.md"),
              "w") as fh:
        fh.write("\n".join(lines) + "\n")
    print(len(REGISTRY), "keys;", len(seen), "placed;", "missing:", missing)


if __name__ == "__main__":
    main()
