"""Session catalog: databases, tables over files, partition refresh,
schema evolution, statistics."""

from refinery.catalog.tables import (
    SchemaConflict,
    add_partition,
    compare,
    crawl,
    create_database,
    evolve,
    list_tables,
    partition_location,
    partition_specs,
    refresh,
    refresh_by_ledger,
    register,
    same_name,
    set_partition,
    table_stats,
    union_schema,
)

__all__ = ["add_partition", "compare", "crawl", "create_database", "evolve", "list_tables",
           "partition_location", "partition_specs", "refresh", "refresh_by_ledger", "register", "same_name", "set_partition",
           "table_stats", "union_schema", "SchemaConflict"]
