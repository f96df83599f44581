"""Table specifications: raw schemas and the keyed silver tables.

One spec list replaces seventeen copied streaming cells; every silver job is
the same function driven by a ``TableSpec``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

ADDRESS = T.StructType([
    T.StructField("address", T.StringType()),
    T.StructField("mask", T.IntegerType()),
])

TS = T.TimestampType()
LONG = T.LongType()
INT = T.IntegerType()
STR = T.StringType()


def _schema(*cols: tuple[str, T.DataType], inserted_at: bool = True) -> T.StructType:
    fields = [T.StructField(n, t) for n, t in cols]
    if inserted_at:
        fields.append(T.StructField("inserted_at", TS))
    return T.StructType(fields)


# Columns the pipeline reads from each raw table.  Files may hold more; ingest takes the
# schema from the files and only checks that these are there (``streaming.pipeline``).
RAW_SCHEMAS: dict[str, T.StructType] = {
    "dim_network_host": _schema(("_id", LONG), ("address", ADDRESS), ("host", STR), inserted_at=False),
    "dim_file_reg": _schema(("pid", LONG), ("fd", STR), ("node", LONG)),
    "dim_network_foreign_ip": _schema(("_id", LONG), ("address", ADDRESS)),
    "dim_network_interface": _schema(("_id", LONG), ("address", ADDRESS), ("network", STR)),
    "dim_network_open_port": _schema(("pid", LONG), ("port", INT)),
    "dim_network_socket": _schema(("_id", LONG), ("source_address", ADDRESS)),
    "dim_process": _schema(("pid", LONG), ("ppid", LONG), ("uid", LONG), ("command", STR),
                           ("full_command", STR), ("started_at", TS)),
    "fact_file_reg": _schema(("pid", LONG), ("fd", STR), ("node", LONG), ("created_at", TS)),
    "fact_network_ip": _schema(("_id", LONG), ("source_address", ADDRESS),
                               ("destination_address", ADDRESS), ("source_port", INT),
                               ("destination_port", INT)),
    "fact_network_packet": _schema(("_id", LONG), ("length", LONG), ("created_at", TS),
                                   ("interface", STR)),
    "fact_process": _schema(("pid", LONG), ("started_at", TS), ("created_at", TS)),
    "fact_process_network": _schema(("_id", LONG), ("packet_id", LONG), ("pid", LONG)),
    "file_host": _schema(("name", STR), ("address", ADDRESS)),
    "file_service": _schema(("name", STR), ("port", INT), ("protocol", STR)),
    "file_user": _schema(("name", STR), ("uid", LONG)),
    "tech_chrono": _schema(("name", STR)),
    "tech_table_count": _schema(("_id", LONG)),
}

# Columns bronze adds to every raw row.
BRONZE_COLUMNS = ["file_name", "file_size", "hostname", "date_sent", "dtk_inserted_at"]


@dataclass(frozen=True)
class TableSpec:
    source: str                     # bronze table name
    target: str                     # silver table name
    keys: tuple[str, ...]           # upsert keys, also the latest-row partition
    lookups: tuple[tuple[str, str], ...] = ()   # (address column, host column to add)
    mask_from: str | None = None    # struct column whose ``mask`` field becomes ``mask``
    distinct_only: tuple[str, ...] = ()         # host table: project + distinct, no latest
    order_by: str = "inserted_at"   # arrival clock for the latest row
    tie_break: tuple[str, ...] = field(default=())
    buckets: int = 16               # hash buckets of the keyed table, fixed by its first write


# The silver tables, their keys and enrichments, as the pipeline defines them.
SILVER_TABLES: tuple[TableSpec, ...] = (
    TableSpec("dim_network_host", "dim_network_host", ("_id", "address", "host"),
              distinct_only=("_id", "address", "host")),
    TableSpec("dim_file_reg", "dim_file_reg", ("pid", "fd", "node", "hostname")),
    TableSpec("dim_network_foreign_ip", "dim_network_foreign_ip", ("_id", "hostname"),
              lookups=(("address", "host"),)),
    TableSpec("dim_network_interface", "dim_network_interface", ("_id", "hostname"),
              lookups=(("address", "host"),), mask_from="address"),
    TableSpec("dim_network_open_port", "dim_network_open_port", ("pid", "port", "hostname")),
    TableSpec("dim_network_socket", "dim_network_socket", ("_id", "hostname"),
              lookups=(("source_address", "source_host"),)),
    TableSpec("dim_process", "dim_process", ("pid", "started_at", "hostname")),
    TableSpec("file_host", "dim_file_host", ("name", "address", "hostname")),
    TableSpec("file_user", "dim_file_user", ("name", "uid", "hostname")),
    TableSpec("file_service", "dim_file_service", ("name", "port", "protocol", "hostname")),
    TableSpec("fact_file_reg", "fact_file_reg", ("pid", "fd", "node", "created_at", "hostname")),
    TableSpec("fact_network_ip", "fact_network_ip", ("_id", "hostname"),
              lookups=(("source_address", "source_host"), ("destination_address", "destination_host"))),
    TableSpec("fact_network_packet", "fact_network_packet", ("_id", "hostname")),
    TableSpec("fact_process", "fact_process", ("pid", "started_at", "created_at", "hostname")),
    TableSpec("fact_process_network", "fact_process_network", ("_id", "hostname")),
    TableSpec("tech_chrono", "fact_tech_chrono", ("name", "hostname")),
    TableSpec("tech_table_count", "fact_tech_table_count", ("_id", "hostname")),
)

SPECS_BY_SOURCE = {s.source: s for s in SILVER_TABLES}

# Gold table keys.
PACKET_KEYS = ("packet_id", "source_hostname")
CONNECTION_KEYS = ("created_at", "source_network", "source_host", "source_port",
                   "destination_host", "destination_port", "destination_network")

# Operating constants of the refresh loop and the report.
GOLD_LOOKBACK_MINUTES = 10
GOLD_REFRESH_SECONDS = 30
REPORT_LOOKBACK_MINUTES = 15
