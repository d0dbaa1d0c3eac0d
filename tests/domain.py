"""A small synthetic warehouse input with the edge rows that matter; all values are made up."""

import datetime as dt

from wardbook.sources import INPUTS


def ts(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def sheet(trainid, title, tid, tname, mid, mname, office, start, people=10):
    begin = ts(start)
    end = begin and begin + dt.timedelta(hours=1)
    return (trainid, title, tid, tname, mid, mname, office, begin, end, 60, people)


ROUND = (4, "教学查房", 1, "内科", "内科")

SHEETS = {
    130: [
        sheet(None, "no key", *ROUND, "2019-03-01"),
        sheet(-1, "negative key", *ROUND, "2019-03-01"),
        sheet(0, "zero key, too early", *ROUND, "2018-12-31 23:00"),
        sheet(1, "neither type nor major", None, None, None, None, "内科", "2019-03-01"),
        sheet(2, ' a\r\nb"c ', 4, ' 教学查房"', None, "   ", "内科", "2019-03-05"),
        sheet(3, "查房A", *ROUND, "2019-03-06"),
        sheet(4, "查房A", *ROUND, "2019-03-20"),
        sheet(4, "查房A", *ROUND, "2019-03-20"),
        sheet(5, "查房A", *ROUND, "2019-04-02"),
        sheet(6, "教学查房", *ROUND, "2019-04-03"),
        sheet(7, None, *ROUND, "2019-04-04"),
        sheet(9, "t1", *ROUND, "2019-05-02"),
        sheet(9, "t2", *ROUND, "2019-05-02"),
        sheet(10, "门诊1", 22, "门诊教学", 3, "妇产科", "妇产科", "2019-06-01"),
        sheet(11, "门诊2", 22, "门诊教学", 5, "急诊科", "急诊科", "2019-06-02"),
        sheet(12, "门诊3", 22, "门诊教学", 18, "全科医学科", "全科", "2019-06-03"),
        sheet(13, "入院", 14, "入院教育", 1, "内科", "内科", "2019-09-01"),
        sheet(14, "入基地", 15, "入专业基地教育", 1, "内科", "内科", "2019-09-02"),
        sheet(15, "wrong name", 14, "别的教育", 1, "内科", "内科", "2020-09-02"),
        sheet(16, "id unknown, name known", 4, "教学查房", None, "外科", "内科", "2019-07-01"),
        sheet(17, "no time", *ROUND, None),
    ],
    110: [
        sheet(1, "neither type nor major", None, None, None, None, "内科", "2019-03-01", people=4),
        sheet(20, "小讲课", 9, "临床小讲课", 2, "外科", "外科", "2019-03-01", people=6),
        sheet(21, "技能", None, "临床技能模拟培训", 13, "麻醉科", "麻醉科", "2019-03-02", people=8),
    ],
    111: [sheet(1, "only activity", *ROUND, "2019-03-09", people=3)],
}

S, T = "学员", "老师"
PERSONS = {
    130: [
        (3, 1, "张一", S, "住院医", 0.9, "已签到"),
        (3, 1, "张一", S, "住院医", 0.9, "已签到"),
        (4, 1, "张一", S, "住院医", None, None),
        (6, 1, "张一", T, "住院医", None, "未签到"),
        (9, 1, "张一", S, None, None, "已签到"),
        (3, 2, "李同名", S, None, None, "已签到"),
        (3, 3, "李同名", S, None, None, "已签到"),
        (3, 50, "王老师", T, "主任", None, "已签到"),
        (4, 51, "赵老师", T, "主任", None, "已签到"),
        (4, 50, "王老师", T, "主任", None, "已签到"),
        (-5, 60, "负键", S, None, None, "已签到"),
        (99, 4, "无活动", S, None, None, "已签到"),
    ],
    110: [(20, 7, "陈外", S, None, 0.5, None), (20, None, ' "', S, None, None, None)],
    111: [],
}

FILES = {
    130: [(3, ' pdf"', " http://x/a.pdf ", None), (3, None, "", "a"), (3, None, "", "a"), (None, "pdf", "u", "n")],
    110: [],
    111: [],
}

STUDENTS = {
    130: [
        (1, " 张一", 1, "内科", 2019, "本院"),
        (1, "张一", 1, "内科", 2019, "本院"),
        (2, "李同名", 1, "内科", 2019, "本院"),
        (3, "李同名", 1, "内科", 2019, "本院"),
        (4, "无活动", 1, "内科", 2019, None),
        (8, "没来过", 1, "内科", 2019, None),
        (1, "别名", 1, "内科", 2019, None),
    ],
    110: [(7, "陈外", 2, "外科", 2019, "外单位"), (1, "张一", 1, "内科", 2019, "本院")],
    111: [],
}


def teacher(pid, name):
    return (pid, name, "内科", "内科一", "主任", "博士", " ", ts("2010-05-01"), "000-0001", None, None)


TEACHERS = {130: [teacher(50, "王老师"), teacher(51, "赵老师"), teacher(52, "未授课")], 110: [], 111: []}

_A = (130, "解放军总医院海南医院")
_B = (110, "海南医学院第一附属医院")
ADMISSIONS = [
    (2019, *_A, 1, "内科", 9001, "张一"),
    (2019, *_A, 1, "内科", 9001, "张一"),
    (2019, *_A, 1, "内科", 9002, "李同名"),
    (2019, *_A, 2, "外科", 9003, "只轮转"),
    (2019, *_A, 2, "外科", 9004, "都没有"),
    (2019, *_B, 2, "外科", 9005, "陈外"),
    (2018, *_A, 1, "内科", 9006, "太早"),
]


def rotation(name, hospital, mid, mname, office_mid, office, start, end, year=2019):
    return (
        *(name, hospital, mid, mname, year, office + "科室", office_mid, office, "大纲", ts(start), ts(end)),
        *("带教", 1, "内科", 88.5),
    )


_ALIAS = "301海南医院"
ROTATIONS = [
    rotation("张一", _ALIAS, 1, "内科", 1, "内科", "2019-03-01", "2019-04-10"),
    rotation("李同名", _ALIAS, 1, "内科", 2, "外科", "2019-03-10", "2019-03-10"),
    rotation("张一", _ALIAS, 1, "内科", 3, "妇产科", "2019-01-20", "2019-02-10"),
    rotation("只轮转", _ALIAS, 2, "外科", 2, "外科", "2019-01-31", "2019-02-28"),
    rotation("陈外", "海南医学院第一附属医院", 2, "外科", 2, "外科", "2019-03-01", "2021-03-01"),
    rotation("路人", "某医院", 1, "内科", 1, "内科", "2019-03-01", "2019-03-02"),
    rotation("张一", _ALIAS, 1, "内科", 1, "内科", "2019-03-05", "2019-03-01"),
    rotation("张一", _ALIAS, 1, "内科", 1, "内科", "2019-03-05", None),
]

SITE_ROWS = {"sheet": SHEETS, "person": PERSONS, "file": FILES, "student": STUDENTS, "teacher": TEACHERS}


def write_inputs(spark, cfg):
    """Create the 15 site tables and the two shared ones in the catalog."""
    for layer in ("ods", "dwd"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{cfg.db(layer)}`")

    def save(rows, entity, db, table):
        spark.createDataFrame(rows, INPUTS[entity]).write.mode("overwrite").saveAsTable(f"`{db}`.`{table}`")

    for site in cfg.sites:
        for entity, by_site in SITE_ROWS.items():
            save(by_site[site.id], entity, cfg.db("ods"), site.tables[entity])
    save(ADMISSIONS, "admissions", cfg.db("dwd"), cfg.admissions_table)
    save(ROTATIONS, "rotations", cfg.db("dwd"), cfg.rotations_table)
