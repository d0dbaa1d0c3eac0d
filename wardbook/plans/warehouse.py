"""Jobs by key, and the warehouse that builds or publishes them.

``Warehouse.table`` composes a job lazily from its inputs. ``Warehouse.staged`` does the
same after writing the tables that are read more than once on the way to a folder, so
that none of them is computed twice and lineage stays short. ``Warehouse.publish`` stores
jobs one after another, each reading the stored tables of the jobs before it, so a table
used several times is computed once and every job starts from storage: a lost executor
costs at most the job it was working on.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardbook.config import WarehouseConfig
from wardbook.plans import detail, report, summary
from wardbook.sources.schemas import OUTPUTS, TableSpec
from wardbook.sources.sink import conform, publish


@dataclass(frozen=True)
class Job:
    key: str
    build: Callable[[Warehouse], DataFrame]
    # Upstream jobs and how often this job reads each of them.
    reads: Mapping[str, int] = field(default_factory=dict)
    # The columns read of an upstream job, where only some are.
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    # The rows before a last step that only drops repeated ones, which other jobs can do where it costs them less.
    repeated: Callable[[Warehouse], DataFrame] | None = None
    order_by: tuple[str, ...] = ()
    descending: tuple[str, ...] = ()

    @property
    def spec(self) -> TableSpec:
        return OUTPUTS[self.key]


@dataclass
class Warehouse:
    spark: SparkSession
    cfg: WarehouseConfig
    source: object
    # Whether jobs that an earlier run published are read from the catalog instead of composed.
    from_catalog: bool = True
    # Lazily composed jobs, and the names of those that have been stored.
    tables: dict[str, DataFrame] = field(default_factory=dict)
    stored: dict[str, str] = field(default_factory=dict)
    # Jobs written to a folder by ``stage``.
    written: set[str] = field(default_factory=set)

    def table(self, key: str) -> DataFrame:
        """A stored job as its table, any other composed from its inputs (once).

        Stored is what this object published or, with ``from_catalog``, what the catalog
        has: layers can be run by themselves, and a failed run goes on where it ended.
        """
        if key not in self.tables:
            job = JOBS[key]
            name = f"`{self.cfg.db(job.spec.layer)}`.`{job.spec.name}`"
            if key not in self.stored and self.from_catalog and self.spark.catalog.tableExists(name):
                self.stored[key] = name
            self.tables[key] = (
                self.spark.table(self.stored[key])
                if key in self.stored
                else conform(job.build(self), job.spec.schema)
            )
        return self.tables[key]

    def repeated(self, key: str) -> DataFrame | None:
        """A job's rows before repeated ones are dropped, or None where the job is stored."""
        self.table(key)
        if key in self.stored or key in self.written:
            return None
        return conform(JOBS[key].repeated(self), JOBS[key].spec.schema)

    def needed(self, key: str) -> list[str]:
        """A job and all jobs below it, in dependency order."""
        below = {key}
        for k in reversed(JOBS):
            if k in below:
                below |= set(JOBS[k].reads)
        return [k for k in JOBS if k in below]

    def staged(self, key: str, folder: str) -> DataFrame:
        """A job's result, with what is read repeatedly below it written to ``folder`` first.

        Rows that cost less to compose again than to group and store are not written.
        """
        self.stage([key], folder, kept=[k for k in JOBS if JOBS[k].repeated])
        return self.table(key)

    def stage_reads(self, reads: Mapping[str, int], folder: str) -> None:
        """Write what is read repeatedly by and below a reader of these tables; see ``staged``."""
        self.stage(reads, folder, kept=[k for k in JOBS if JOBS[k].repeated], reads=reads)

    def stage(self, keys: Iterable[str], folder: str, kept: Iterable[str] = (), reads: Mapping[str, int] | None = None) -> None:
        """Write what is read repeatedly below some jobs to ``folder``, but for these jobs and those ``kept`` elsewhere.

        With ``reads``, how often the caller reads these jobs, they are written as the others are.
        Of a job that is not among ``keys`` only the columns that the others ask for are written.
        """
        keys = list(keys)
        below = {k for key in keys for k in self.needed(key)}
        needed = [k for k in JOBS if k in below]
        often, apart = Counter(reads or {}), {*kept, *(keys if reads is None else ())}
        for k in needed:
            often.update(JOBS[k].reads)
        for k in needed:
            if often[k] > 1 and k not in apart:
                path = f"{folder}/{JOBS[k].spec.name}"
                rows = self.table(k)
                asked = [JOBS[j].columns.get(k, rows.columns) for j in needed if k in JOBS[j].reads]
                if k not in keys:
                    rows = rows.select(*[c for c in rows.columns if any(c in some for some in asked)])
                rows.write.mode("overwrite").parquet(path)
                self.tables[k] = self.spark.read.schema(rows.schema).parquet(path)
                self.written.add(k)

    def publish(self, keys: Iterable[str] | None = None) -> dict[str, str]:
        """Replace the tables of the given jobs (all by default), in dependency order."""
        for key in JOBS if keys is None else [k for k in JOBS if k in set(keys)]:
            job = JOBS[key]
            # Plans composed before a table was replaced would read files that are gone.
            self.tables.clear()
            order = [F.desc(c) if c in job.descending else F.asc(c) for c in job.order_by]
            self.stored[key] = publish(
                job.build(self),
                job.spec,
                self.cfg.db(job.spec.layer),
                order_by=order,
                location=self.cfg.location,
                versions=self.cfg.versions,
            )
        self.tables.clear()
        return dict(self.stored)


# In dependency order. The dictionary (t01) is too small to be worth counting as read.
JOBS = {
    job.key: job
    for job in (
        Job("t01", lambda w: w.source.standards()),
        Job("t02", lambda w: detail.activities(w.cfg, w.source, w.table("t01"))),
        Job(
            "t03",
            lambda w: detail.participation(w.cfg, w.source),
            repeated=lambda w: detail.participation_rows(w.cfg, w.source),
        ),
        Job("t04", lambda w: detail.attachments(w.cfg, w.source)),
        Job("t05", lambda w: detail.students(w.cfg, w.source, w.table("t03")), {"t03": 1}),
        Job(
            "t06",
            lambda w: detail.student_log(w.table("t05"), w.table("t03"), w.table("t02"), w.repeated("t03")),
            {"t05": 1, "t03": 1, "t02": 1},
        ),
        Job("t07", lambda w: detail.teachers(w.cfg, w.source, w.table("t03")), {"t03": 1}),
        Job(
            "t08",
            lambda w: detail.teacher_log(w.table("t07"), w.table("t03"), w.table("t02"), w.repeated("t03")),
            {"t07": 1, "t03": 1, "t02": 1},
        ),
        Job("t09", lambda w: detail.hospital_inductions(w.cfg, w.source.admissions(), w.table("t02")), {"t02": 2}),
        Job("t10", lambda w: detail.specialty_inductions(w.cfg, w.source.admissions(), w.table("t02")), {"t02": 2}),
        Job(
            "t11",
            lambda w: detail.rotation_activities(w.cfg, w.source.rotations(), w.table("t05"), w.table("t06")),
            {"t05": 2, "t06": 2},
        ),
        Job(
            "t12",
            lambda w: detail.titles_with_teachers(w.table("t02"), w.table("t08")),
            {"t02": 2, "t08": 2},
            columns={"t08": detail.TITLE_LOG_COLUMNS},
        ),
        Job("t13", lambda w: summary.overview(w.cfg, w.table("t02"), w.table("t06")), {"t02": 1, "t06": 1}),
        Job("t14", lambda w: summary.counts_against_standards(w.cfg, w.table("t02"), w.table("t01")), {"t02": 1}),
        Job("t15", lambda w: summary.hospital_coverage(w.table("t09")), {"t09": 1}),
        Job("t16", lambda w: summary.specialty_coverage(w.table("t10")), {"t10": 1}),
        # The log keeps every student of t05, so presence in it is presence in t05.
        Job(
            "t17",
            lambda w: summary.admitted_presence(w.cfg, w.source.admissions(), w.source.rotations(), w.table("t05")),
            {"t05": 1},
        ),
        Job("t18", lambda w: summary.rotation_counts(w.cfg, w.table("t11")), {"t11": 1}),
        Job("t19", lambda w: summary.rotation_abnormal(w.cfg, w.table("t18")), {"t18": 1}),
        Job("t20", lambda w: summary.outpatient(w.cfg, w.table("t14")), {"t14": 1}),
        Job("t21", lambda w: summary.irregular_titles(w.cfg, w.table("t12")), {"t12": 1}),
        Job("t22", lambda w: report.average_times(w.table("t13")), {"t13": 1}),
        Job("t23", lambda w: report.sign_in(w.table("t13")), {"t13": 1}),
        Job("t24", lambda w: report.evaluation(w.table("t13")), {"t13": 1}),
        Job("t25", lambda w: report.missed_standards(w.table("t14")), {"t14": 1}),
        Job("t26", lambda w: report.title_quality(w.table("t21")), {"t21": 1}),
        Job(
            "t27",
            lambda w: report.same_title(w.table("t12")),
            {"t12": 1},
            order_by=report.SAME_TITLE_ORDER,
            descending=("month",),
        ),
        Job("t28", lambda w: report.missed_specialty(w.table("t18")), {"t18": 1}),
    )
}
