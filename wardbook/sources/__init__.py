"""Inputs, the standards dictionary, table specifications and publishing."""

from wardbook.sources.inputs import CatalogSource, FrameSource
from wardbook.sources.schemas import INPUTS, OUTPUTS, TableSpec
from wardbook.sources.sink import conform, ensure_database, publish
from wardbook.sources.standards import standards_dictionary

__all__ = [
    "INPUTS",
    "OUTPUTS",
    "CatalogSource",
    "FrameSource",
    "TableSpec",
    "conform",
    "ensure_database",
    "publish",
    "standards_dictionary",
]
