"""Readers. Each returns a lazy DataFrame; nothing is collected."""

from refinery.sources.files import (
    file_inventory,
    inventory_by_folder,
    read_csv,
    read_parquet,
    read_partition,
)
from refinery.sources.jdbc import jdbc_options, read_jdbc

__all__ = [
    "file_inventory", "inventory_by_folder", "jdbc_options", "read_csv", "read_jdbc",
    "read_parquet", "read_partition",
]
