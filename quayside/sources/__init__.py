"""Readers and sinks."""

from .readers import (assert_columns, assert_types, assert_unique, inline_relation, read_csv, read_delta, read_format, read_history,
                      read_parquet, read_partition, read_snapshot)
from .sinks import (restore, write_bounded, write_once, write_overwrite, write_partition, write_partitions,
                    write_staged)
