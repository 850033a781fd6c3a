"""Scans, bindings, writers, rollups and lookups."""

from grainframe.sources.bind import bind, bind_nested, view
from grainframe.sources.lookup import lookup_from_json
from grainframe.sources.quoted import infer_types, quoted_records, quoted_to_parquet, scan_quoted
from grainframe.sources.rollup import (
    RollupMeasure,
    distinct_read,
    distinct_write,
    freshness,
    pick_source,
    refresh,
    refresh_partitions,
    rollup_read,
    rollup_write,
)
from grainframe.sources.scan import scan_csv, scan_parquet, scan_tsv
from grainframe.sources.write import (
    append_new,
    csv_to_parquet,
    export,
    load,
    materialize,
    materialize_table,
    write_bucketed,
)

__all__ = [
    "RollupMeasure",
    "append_new",
    "bind",
    "bind_nested",
    "csv_to_parquet",
    "distinct_read",
    "distinct_write",
    "export",
    "freshness",
    "infer_types",
    "load",
    "lookup_from_json",
    "materialize",
    "materialize_table",
    "pick_source",
    "quoted_records",
    "quoted_to_parquet",
    "refresh",
    "refresh_partitions",
    "rollup_read",
    "rollup_write",
    "scan_csv",
    "scan_parquet",
    "scan_quoted",
    "scan_tsv",
    "view",
    "write_bucketed",
]
