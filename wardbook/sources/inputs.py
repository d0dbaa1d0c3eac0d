"""Where the jobs read from: catalog tables, or DataFrames handed in."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

from wardbook.config import Site, WarehouseConfig
from wardbook.operators.sites import Stacked
from wardbook.sources.schemas import INPUTS
from wardbook.sources.standards import standards_dictionary


def checked(df: DataFrame, name: str, *more: str) -> DataFrame:
    """The declared columns of an input, in their declared types, and ``more`` of its own; missing ones are an error."""
    missing = set(INPUTS[name].names) - set(df.columns)
    if missing:
        raise ValueError(f"{name} lacks columns {sorted(missing)}")
    return df.to(T.StructType([*INPUTS[name].fields, *[df.schema[c] for c in more]]))


def branches(source, entity: str) -> Iterator[tuple[Site, DataFrame]] | Stacked:
    """An entity's rows site by site, or in one relation where the source has them so."""
    stacked = source.stacked(entity) if hasattr(source, "stacked") else None
    return source.sites(entity) if stacked is None else stacked


@dataclass(frozen=True)
class CatalogSource:
    """Site tables and the two shared inputs as tables of the session catalog."""

    spark: SparkSession
    cfg: WarehouseConfig

    def sites(self, entity: str) -> Iterator[tuple[Site, DataFrame]]:
        for site in self.cfg.sites:
            yield site, checked(self.spark.table(f"{self.cfg.db('ods')}.{site.tables[entity]}"), entity)

    def admissions(self) -> DataFrame:
        return checked(self.spark.table(f"{self.cfg.db('dwd')}.{self.cfg.admissions_table}"), "admissions")

    def rotations(self) -> DataFrame:
        return checked(self.spark.table(f"{self.cfg.db('dwd')}.{self.cfg.rotations_table}"), "rotations")

    def standards(self) -> DataFrame:
        return standards_dictionary(self.spark)


@dataclass(frozen=True)
class FrameSource:
    """Inputs as DataFrames: ``site_frames[entity][site_id]`` plus the shared ones."""

    cfg: WarehouseConfig
    site_frames: Mapping[str, Mapping[int, DataFrame]]
    admissions_frame: DataFrame
    rotations_frame: DataFrame
    standards_frame: DataFrame

    def sites(self, entity: str) -> Iterator[tuple[Site, DataFrame]]:
        for site in self.cfg.sites:
            yield site, checked(self.site_frames[entity][site.id], entity)

    def admissions(self) -> DataFrame:
        return checked(self.admissions_frame, "admissions")

    def rotations(self) -> DataFrame:
        return checked(self.rotations_frame, "rotations")

    def standards(self) -> DataFrame:
        return self.standards_frame
