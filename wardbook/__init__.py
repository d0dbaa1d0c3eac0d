"""Teaching-activity warehouse built from reusable Spark DataFrame operators."""

from wardbook.config import Kind, Site, WarehouseConfig

__all__ = ["Kind", "Site", "WarehouseConfig"]
