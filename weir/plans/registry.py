"""Query keys: Spark plan + DuckDB oracle per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weir.plans import formats, ingest, kpi, logs, oracle, orders, sql_reports, streams, tables

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {
    "daily_kpi": kpi.daily_kpi,
    "derive_time_columns": kpi.derive_time_columns,
    "conditional_revenue": kpi.conditional_revenue,
    "filter_non_negative": kpi.filter_non_negative,
    "removed_row_count": kpi.removed_row_count,
    "kept_rows_write": kpi.kept_rows_write,
    "broadcast_left_enrich": kpi.broadcast_left_enrich,
    "repartition_user_join": kpi.repartition_user_join,
    "kpi_grouped": kpi.kpi_grouped,
    "repartition_group_agg": kpi.repartition_group_agg,
    "conditional_count": kpi.conditional_count,
    "distinct_users": kpi.distinct_users,
    "rolling_sum_7_rows": kpi.rolling_sum_7_rows,
    "rolling_sum_7_days": kpi.rolling_sum_7_days,
    "rolling_sum_segmented": kpi.rolling_sum_segmented,
    "distinct_users_merged": kpi.distinct_users_merged,
    "daily_kpi_large_users": kpi.daily_kpi_large_users,
    "bucketed_user_join": kpi.bucketed_user_join,
    "kpi_sorted_preview": kpi.kpi_sorted_preview,
    "kpi_partitioned_roundtrip": kpi.kpi_partitioned_roundtrip,
    "kpi_first_partition": kpi.kpi_first_partition,
    "kpi_single_file_roundtrip": kpi.kpi_single_file_roundtrip,
    "kpi_file_layout": kpi.kpi_file_layout,
    "kpi_layout_comparison": kpi.kpi_layout_comparison,
    "kpi_partition_list": kpi.kpi_partition_list,
    "outer_join_range_on": sql_reports.outer_join_range_on,
    "repeat_buyers": sql_reports.repeat_buyers,
    "alibi_intersection": sql_reports.alibi_intersection,
    "alibi_intersection_df": sql_reports.alibi_intersection_df,
    "union_table_counts": sql_reports.union_table_counts,
    "filter_greater": sql_reports.filter_greater,
    "global_average": sql_reports.global_average,
    "sql_group_avg_desc": sql_reports.sql_group_avg_desc,
    "csv_inferred_roundtrip": formats.csv_inferred_roundtrip,
    "csv_declared_load": formats.csv_declared_load,
    "jsonl_gz_nested_roundtrip": formats.jsonl_gz_nested_roundtrip,
    "flatten_nested_load": ingest.flatten_nested_load,
    "insert_if_absent": ingest.insert_if_absent,
    "new_files_only": ingest.new_files_only,
    "manifest_append": ingest.manifest_append,
    "rows_loaded_per_file": ingest.rows_loaded_per_file,
    "top10_recent": ingest.top10_recent,
    "revenue_by_group": ingest.revenue_by_group,
    "manifest_recent": ingest.manifest_recent,
    "constraint_report": ingest.constraint_report,
    "declared_table_load": tables.declared_table_load,
    "bucketed_table_load": tables.bucketed_table_load,
    "quarantine_load": tables.quarantine_load,
    "decode_payload": streams.decode_payload,
    "stream_batches": streams.stream_batches,
    "file_stream_ingest": streams.file_stream_ingest,
    "order_totals": orders.order_totals,
    "order_totals_nested": orders.order_totals_nested,
    "order_fields_csv": orders.order_fields_csv,
    "order_validation": orders.order_validation,
    "fetch_outcomes": orders.fetch_outcomes,
    "fetched_only": orders.fetched_only,
    "fetch_uniqueness": orders.fetch_uniqueness,
    "parse_access_log": logs.parse_access_log,
    "error_counts": logs.error_counts,
    "users_flatten": logs.users_flatten,
    "log_user_join": logs.log_user_join,
    "dataset_record_counts": kpi.dataset_record_counts,
    "partition_report": kpi.partition_report,
    "item_tag_counts": kpi.item_tag_counts,
    "service_counts": ingest.service_counts,
    "lab_constraint_report": sql_reports.lab_constraint_report,
}

ORACLE: dict[str, str] = {
    "daily_kpi": oracle.DAILY_KPI,
    "derive_time_columns": oracle.DERIVE_TIME_COLUMNS,
    "conditional_revenue": oracle.CONDITIONAL_REVENUE,
    "filter_non_negative": oracle.FILTER_NON_NEGATIVE,
    "removed_row_count": oracle.REMOVED_ROW_COUNT,
    "kept_rows_write": oracle.KEPT_ROWS_WRITE,
    "partition_report": oracle.PARTITION_REPORT,
    "broadcast_left_enrich": oracle.BROADCAST_LEFT_ENRICH,
    "repartition_user_join": oracle.BROADCAST_LEFT_ENRICH,
    "kpi_grouped": oracle.KPI_GROUPED,
    "repartition_group_agg": oracle.KPI_GROUPED,
    "conditional_count": oracle.CONDITIONAL_COUNT,
    "distinct_users": oracle.DISTINCT_USERS,
    "rolling_sum_7_rows": oracle.ROLLING_SUM_7_ROWS,
    "rolling_sum_7_days": oracle.ROLLING_SUM_7_DAYS,
    "rolling_sum_segmented": oracle.ROLLING_SUM_7_ROWS,
    "distinct_users_merged": oracle.DISTINCT_USERS_MERGED,
    "daily_kpi_large_users": oracle.DAILY_KPI,
    "bucketed_user_join": oracle.BROADCAST_LEFT_ENRICH,
    "kpi_sorted_preview": oracle.KPI_SORTED_PREVIEW,
    "kpi_partitioned_roundtrip": oracle.DAILY_KPI,
    "kpi_first_partition": oracle.KPI_FIRST_PARTITION,
    "kpi_single_file_roundtrip": oracle.DAILY_KPI,
    "kpi_file_layout": oracle.KPI_FILE_LAYOUT,
    "kpi_layout_comparison": oracle.KPI_LAYOUT_COMPARISON,
    "kpi_partition_list": oracle.KPI_PARTITION_LIST,
    "outer_join_range_on": oracle.OUTER_JOIN_RANGE_ON,
    "repeat_buyers": oracle.REPEAT_BUYERS,
    "alibi_intersection": oracle.ALIBI_INTERSECTION,
    "alibi_intersection_df": oracle.ALIBI_INTERSECTION,
    "union_table_counts": oracle.UNION_TABLE_COUNTS,
    "filter_greater": oracle.FILTER_GREATER,
    "global_average": oracle.GLOBAL_AVERAGE,
    "sql_group_avg_desc": oracle.SQL_GROUP_AVG_DESC,
    "csv_inferred_roundtrip": oracle.CSV_INFERRED_ROUNDTRIP,
    "csv_declared_load": oracle.CSV_DECLARED_LOAD,
    "jsonl_gz_nested_roundtrip": oracle.JSONL_GZ_NESTED_ROUNDTRIP,
    "flatten_nested_load": oracle.FLATTEN_NESTED_LOAD,
    "insert_if_absent": oracle.INSERT_IF_ABSENT,
    "new_files_only": oracle.NEW_FILES_ONLY,
    "manifest_append": oracle.MANIFEST_APPEND,
    "rows_loaded_per_file": oracle.ROWS_LOADED_PER_FILE,
    "top10_recent": oracle.TOP10_RECENT,
    "revenue_by_group": oracle.REVENUE_BY_GROUP,
    "manifest_recent": oracle.MANIFEST_RECENT,
    "constraint_report": oracle.CONSTRAINT_REPORT,
    "declared_table_load": oracle.DECLARED_TABLE_LOAD,
    "bucketed_table_load": oracle.INSERT_IF_ABSENT,
    "quarantine_load": oracle.QUARANTINE_LOAD,
    "decode_payload": oracle.DECODE_PAYLOAD,
    "stream_batches": oracle.STREAM_BATCHES,
    "file_stream_ingest": oracle.FILE_STREAM_INGEST,
    "order_totals": oracle.ORDER_TOTALS,
    "order_totals_nested": oracle.ORDER_TOTALS_NESTED,
    "order_fields_csv": oracle.ORDER_FIELDS_CSV,
    "order_validation": oracle.ORDER_VALIDATION,
    "fetch_outcomes": oracle.FETCH_OUTCOMES,
    "fetched_only": oracle.FETCHED_ONLY,
    "fetch_uniqueness": oracle.FETCH_UNIQUENESS,
    "parse_access_log": oracle.PARSE_ACCESS_LOG,
    "error_counts": oracle.ERROR_COUNTS,
    "users_flatten": oracle.USERS_FLATTEN,
    "log_user_join": oracle.LOG_USER_JOIN,
    "dataset_record_counts": oracle.DATASET_RECORD_COUNTS,
    "item_tag_counts": oracle.ITEM_TAG_COUNTS,
    "service_counts": oracle.SERVICE_COUNTS,
    "lab_constraint_report": oracle.LAB_CONSTRAINT_REPORT,
}
