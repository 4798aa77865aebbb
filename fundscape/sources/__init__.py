"""Scans, sinks, JSON document shapes and small lookup tables."""

from fundscape.sources.json_shapes import (
    read_json_shape,
    records_from_json,
    rows_from_json_columns,
    rows_from_json_map,
)
from fundscape.sources.lookups import iso_codes, parameter_table, small_table, value_list
from fundscape.sources.single_file import write_single_file
from fundscape.sources.tables import (
    mark_missing,
    read_stage,
    read_table,
    with_position,
    write_artifact,
    write_bucketed,
)

__all__ = [
    "iso_codes",
    "mark_missing",
    "parameter_table",
    "read_json_shape",
    "read_stage",
    "read_table",
    "records_from_json",
    "rows_from_json_columns",
    "rows_from_json_map",
    "small_table",
    "value_list",
    "with_position",
    "write_artifact",
    "write_bucketed",
    "write_single_file",
]
