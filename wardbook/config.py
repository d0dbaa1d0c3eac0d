"""Everything a deployment may want to change: sites, cut-offs, sentinels, names."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

ENTITIES = ("sheet", "person", "file", "student", "teacher")


@dataclass(frozen=True)
class Kind:
    """An (id, name) pair that only counts when both parts agree."""

    id: int
    name: str


@dataclass(frozen=True)
class Site:
    """One hospital: its identity, how rotations spell it, and its source tables."""

    id: int
    name: str
    rotation_alias: str
    tables: Mapping[str, str] = field(default_factory=dict)
    # Sheet rows must carry at least one of these columns; empty means no such rule.
    require_any: tuple[str, ...] = ()


# Fixed public names: sites, their spelling in rotations, and their source tables.
_SITES = (
    Site(
        130,
        "解放军总医院海南医院",
        "301海南医院",
        MappingProxyType(
            {
                "sheet": "ods_hainan_teaching_activity_spt_train_sheet_data_301",
                "person": "ods_hainan_teaching_activity_spt_train_person_data_301",
                "file": "ods_hainan_teaching_activity_spt_train_file_info_301",
                "student": "ods_hainan_basic_spt_student_item_301",
                "teacher": "ods_hainan_teacher_performance_spt_teacher_item_301",
            }
        ),
        ("spt_traintype_id", "spt_major_id"),
    ),
    Site(
        110,
        "海南医学院第一附属医院",
        "海南医学院第一附属医院",
        MappingProxyType(
            {
                "sheet": "ods_hainan_teaching_activity_spt_train_sheet_data_first_affiliated",
                "person": "ods_hainan_teaching_activity_spt_train_person_data_first_affiliated",
                "file": "ods_hainan_teaching_activity_spt_train_file_info_first_affiliated",
                "student": "ods_hainan_basic_spt_student_item_first_affiliated",
                "teacher": "ods_hainan_teacher_performance_spt_teacher_item_first_affiliated",
            }
        ),
        (),
    ),
    Site(
        111,
        "三亚中心医院（海南省第三人民医院）",
        "三亚中心医院（海南省第三人民医院）",
        MappingProxyType(
            {
                "sheet": "ods_hainan_teaching_activity_spt_train_sheet_data_sanya_central",
                "person": "ods_hainan_teaching_activity_spt_train_person_data_sanya_central",
                "file": "ods_hainan_teaching_activity_spt_train_file_info_sanya_central",
                "student": "ods_hainan_basic_spt_student_item_sanya_central",
                "teacher": "ods_hainan_teacher_performance_spt_teacher_item_sanya_central",
            }
        ),
        (),
    ),
)


def default_sites() -> tuple[Site, ...]:
    return _SITES


@dataclass(frozen=True)
class WarehouseConfig:
    sites: tuple[Site, ...] = field(default_factory=default_sites)
    cutoff_year: int = 2019
    # Months that may follow a rotation's first one in the wide table; None keeps them all,
    # 12 is the window of thirteen months that older reports were cut to.
    max_months: int | None = None

    # Roles, sentinels and the activity kinds that have their own indicators.
    student_role: str = "学员"
    teacher_role: str = "老师"
    signed_text: str = "已签到"
    unknown_id: int = -1
    unknown_text: str = "未知"
    other_site: Kind = Kind(-1, "其他")
    hospital_induction: Kind = Kind(14, "入院教育")
    specialty_induction: Kind = Kind(15, "入专业基地教育")
    general_practice: Kind = Kind(18, "全科医学科")
    outpatient: Kind = Kind(22, "门诊教学")
    min_outpatient_specialties: int = 2

    # One database per layer and the two shared inputs.
    databases: Mapping[str, str] = field(
        default_factory=lambda: {layer: f"{layer}_hainan_hospital_info" for layer in ("ods", "dim", "dwd", "dws", "ads")}
    )
    admissions_table: str = "dwd_hainan_admission_data_view_students"
    rotations_table: str = "dwd_hainan_round_spt_round_total_info"

    # With a key, phone and card numbers are stored as keyed pseudonyms, never as they are.
    # It becomes part of query plans, so these should be logged where keys may be.
    pseudonym_key: bytes | None = field(default=None, repr=False)

    # Shared folder for published tables; None leaves it to the catalog.
    location: str | None = None
    # Versions of a published table that stay: the current one, and one for readers of the last.
    versions: int = 2

    @property
    def cutoff_month(self) -> str:
        return f"{self.cutoff_year:04d}-01"

    def db(self, layer: str) -> str:
        return self.databases[layer]
