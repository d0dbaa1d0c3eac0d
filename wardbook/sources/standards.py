"""Monthly activity standards per specialty and activity type."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wardbook.sources.schemas import OUTPUTS

# Specialty id and name, activity type id and name, monthly standard, remark.
# Types without an id never match recorded activities, which carry -1 for an unknown type.
STANDARDS = (
    (1, "内科", 10, "入轮转科室教育", 1, None),
    (1, "内科", 4, "教学查房", 2, None),
    (1, "内科", 9, "临床小讲课", 4, None),
    (1, "内科", 8, "教学病例讨论", 2, None),
    (1, "内科", 3, "教学阅片", 0, None),
    (1, "内科", 99, "其他", 0, None),
    (1, "内科", 13, "临床文献研读会", 0, None),
    (1, "内科", None, "教学上机", 0, None),
    (1, "内科", 17, "影像诊断报告书写", 0, None),
    (1, "内科", None, "靶区勾画、计划评估教学", 0, None),
    (1, "内科", None, "报告单分析", 0, None),
    (1, "内科", None, "临床技能模拟培训", 0, None),
    (2, "外科", 10, "入轮转科室教育", 1, None),
    (2, "外科", 4, "教学查房", 2, None),
    (2, "外科", 9, "临床小讲课", 4, None),
    (2, "外科", 8, "教学病例讨论", 2, None),
    (2, "外科", 3, "教学阅片", 0, None),
    (2, "外科", 99, "其他", 1, None),
    (2, "外科", 13, "临床文献研读会", 0, None),
    (2, "外科", None, "教学上机", 0, None),
    (2, "外科", 17, "影像诊断报告书写", 0, None),
    (2, "外科", None, "靶区勾画、计划评估教学", 0, None),
    (2, "外科", None, "报告单分析", 0, None),
    (2, "外科", None, "临床技能模拟培训", 0, None),
    (3, "妇产科", 10, "入轮转科室教育", 1, None),
    (3, "妇产科", 4, "教学查房", 2, None),
    (3, "妇产科", 9, "临床小讲课", 4, None),
    (3, "妇产科", 8, "教学病例讨论", 2, None),
    (3, "妇产科", 3, "教学阅片", 0, None),
    (3, "妇产科", 99, "其他", 0, None),
    (3, "妇产科", 13, "临床文献研读会", 0, None),
    (3, "妇产科", None, "教学上机", 0, None),
    (3, "妇产科", 17, "影像诊断报告书写", 0, None),
    (3, "妇产科", None, "靶区勾画、计划评估教学", 0, None),
    (3, "妇产科", None, "报告单分析", 0, None),
    (3, "妇产科", None, "临床技能模拟培训", 0, None),
    (4, "儿科", 10, "入轮转科室教育", 1, None),
    (4, "儿科", 4, "教学查房", 2, None),
    (4, "儿科", 9, "临床小讲课", 4, None),
    (4, "儿科", 8, "教学病例讨论", 2, None),
    (4, "儿科", 3, "教学阅片", 0, None),
    (4, "儿科", 99, "其他", 1, None),
    (4, "儿科", 13, "临床文献研读会", 0, None),
    (4, "儿科", None, "教学上机", 0, None),
    (4, "儿科", 17, "影像诊断报告书写", 0, None),
    (4, "儿科", None, "靶区勾画、计划评估教学", 0, None),
    (4, "儿科", None, "报告单分析", 0, None),
    (4, "儿科", None, "临床技能模拟培训", 0, None),
    (5, "急诊科", 10, "入轮转科室教育", 1, None),
    (5, "急诊科", 4, "教学查房", 2, None),
    (5, "急诊科", 9, "临床小讲课", 4, None),
    (5, "急诊科", 8, "教学病例讨论", 2, None),
    (5, "急诊科", 3, "教学阅片", 0, None),
    (5, "急诊科", 99, "其他", 0, None),
    (5, "急诊科", 13, "临床文献研读会", 0, None),
    (5, "急诊科", None, "教学上机", 0, None),
    (5, "急诊科", 17, "影像诊断报告书写", 0, None),
    (5, "急诊科", None, "靶区勾画、计划评估教学", 0, None),
    (5, "急诊科", None, "报告单分析", 0, None),
    (5, "急诊科", None, "临床技能模拟培训", 0, None),
    (6, "神经内科", 10, "入轮转科室教育", 1, None),
    (6, "神经内科", 4, "教学查房", 2, None),
    (6, "神经内科", 9, "临床小讲课", 4, None),
    (6, "神经内科", 8, "教学病例讨论", 2, None),
    (6, "神经内科", 3, "教学阅片", 0, None),
    (6, "神经内科", 99, "其他", 0, None),
    (6, "神经内科", 13, "临床文献研读会", 0, None),
    (6, "神经内科", None, "教学上机", 0, None),
    (6, "神经内科", 17, "影像诊断报告书写", 0, None),
    (6, "神经内科", None, "靶区勾画、计划评估教学", 0, None),
    (6, "神经内科", None, "报告单分析", 0, None),
    (6, "神经内科", None, "临床技能模拟培训", 0, None),
    (7, "皮肤科", 10, "入轮转科室教育", 1, None),
    (7, "皮肤科", 4, "教学查房", 2, None),
    (7, "皮肤科", 9, "临床小讲课", 4, None),
    (7, "皮肤科", 8, "教学病例讨论", 2, None),
    (7, "皮肤科", 3, "教学阅片", 0, None),
    (7, "皮肤科", 99, "其他", 0, None),
    (7, "皮肤科", 13, "临床文献研读会", 0, None),
    (7, "皮肤科", None, "教学上机", 0, None),
    (7, "皮肤科", 17, "影像诊断报告书写", 0, None),
    (7, "皮肤科", None, "靶区勾画、计划评估教学", 0, None),
    (7, "皮肤科", None, "报告单分析", 0, None),
    (7, "皮肤科", None, "临床技能模拟培训", 0, None),
    (8, "眼科", 10, "入轮转科室教育", 1, None),
    (8, "眼科", 4, "教学查房", 2, None),
    (8, "眼科", 9, "临床小讲课", 4, None),
    (8, "眼科", 8, "教学病例讨论", 2, None),
    (8, "眼科", 3, "教学阅片", 0, None),
    (8, "眼科", 99, "其他", 0, None),
    (8, "眼科", 13, "临床文献研读会", 0, None),
    (8, "眼科", None, "教学上机", 0, None),
    (8, "眼科", 17, "影像诊断报告书写", 0, None),
    (8, "眼科", None, "靶区勾画、计划评估教学", 0, None),
    (8, "眼科", None, "报告单分析", 0, None),
    (8, "眼科", None, "临床技能模拟培训", 0, None),
    (9, "耳鼻咽喉科", 10, "入轮转科室教育", 1, None),
    (9, "耳鼻咽喉科", 4, "教学查房", 2, None),
    (9, "耳鼻咽喉科", 9, "临床小讲课", 4, None),
    (9, "耳鼻咽喉科", 8, "教学病例讨论", 2, None),
    (9, "耳鼻咽喉科", 3, "教学阅片", 0, None),
    (9, "耳鼻咽喉科", 99, "其他", 0, None),
    (9, "耳鼻咽喉科", 13, "临床文献研读会", 0, None),
    (9, "耳鼻咽喉科", None, "教学上机", 0, None),
    (9, "耳鼻咽喉科", 17, "影像诊断报告书写", 0, None),
    (9, "耳鼻咽喉科", None, "靶区勾画、计划评估教学", 0, None),
    (9, "耳鼻咽喉科", None, "报告单分析", 0, None),
    (9, "耳鼻咽喉科", None, "临床技能模拟培训", 0, None),
    (10, "精神科", 10, "入轮转科室教育", 1, None),
    (10, "精神科", 4, "教学查房", 2, None),
    (10, "精神科", 9, "临床小讲课", 4, None),
    (10, "精神科", 8, "教学病例讨论", 2, None),
    (10, "精神科", 3, "教学阅片", 0, None),
    (10, "精神科", 99, "其他", 4, None),
    (10, "精神科", 13, "临床文献研读会", 0, None),
    (10, "精神科", None, "教学上机", 0, None),
    (10, "精神科", 17, "影像诊断报告书写", 0, None),
    (10, "精神科", None, "靶区勾画、计划评估教学", 0, None),
    (10, "精神科", None, "报告单分析", 0, None),
    (10, "精神科", None, "临床技能模拟培训", 0, None),
    (12, "康复医学科", 10, "入轮转科室教育", 1, None),
    (12, "康复医学科", 4, "教学查房", 2, None),
    (12, "康复医学科", 9, "临床小讲课", 4, None),
    (12, "康复医学科", 8, "教学病例讨论", 2, None),
    (12, "康复医学科", 3, "教学阅片", 0, None),
    (12, "康复医学科", 99, "其他", 0, None),
    (12, "康复医学科", 13, "临床文献研读会", 0, None),
    (12, "康复医学科", None, "教学上机", 0, None),
    (12, "康复医学科", 17, "影像诊断报告书写", 0, None),
    (12, "康复医学科", None, "靶区勾画、计划评估教学", 0, None),
    (12, "康复医学科", None, "报告单分析", 0, None),
    (12, "康复医学科", None, "临床技能模拟培训", 0, None),
    (13, "麻醉科", 10, "入轮转科室教育", 1, None),
    (13, "麻醉科", 4, "教学查房", 2, None),
    (13, "麻醉科", 9, "临床小讲课", 4, None),
    (13, "麻醉科", 8, "教学病例讨论", 2, None),
    (13, "麻醉科", 3, "教学阅片", 0, None),
    (13, "麻醉科", 99, "其他", 0, None),
    (13, "麻醉科", 13, "临床文献研读会", 0, None),
    (13, "麻醉科", None, "教学上机", 0, None),
    (13, "麻醉科", 17, "影像诊断报告书写", 0, None),
    (13, "麻醉科", None, "靶区勾画、计划评估教学", 0, None),
    (13, "麻醉科", None, "报告单分析", 0, None),
    (13, "麻醉科", None, "临床技能模拟培训", 1, None),
    (15, "检验医学科", 10, "入轮转科室教育", 1, None),
    (15, "检验医学科", 4, "教学查房", 0, None),
    (15, "检验医学科", 9, "临床小讲课", 4, None),
    (15, "检验医学科", 8, "教学病例讨论", 2, None),
    (15, "检验医学科", 3, "教学阅片", 2, None),
    (15, "检验医学科", 99, "其他", 0, None),
    (15, "检验医学科", 13, "临床文献研读会", 0, None),
    (15, "检验医学科", None, "教学上机", 0, None),
    (15, "检验医学科", 17, "影像诊断报告书写", 0, None),
    (15, "检验医学科", None, "靶区勾画、计划评估教学", 0, None),
    (15, "检验医学科", None, "报告单分析", 2, None),
    (15, "检验医学科", None, "临床技能模拟培训", 0, None),
    (16, "临床病理科", 10, "入轮转科室教育", 1, None),
    (16, "临床病理科", 4, "教学查房", 0, None),
    (16, "临床病理科", 9, "临床小讲课", 4, None),
    (16, "临床病理科", 8, "教学病例讨论", 2, None),
    (16, "临床病理科", 3, "教学阅片", 2, None),
    (16, "临床病理科", 99, "其他", 0, None),
    (16, "临床病理科", 13, "临床文献研读会", 0, None),
    (16, "临床病理科", None, "教学上机", 0, None),
    (16, "临床病理科", 17, "影像诊断报告书写", 0, None),
    (16, "临床病理科", None, "靶区勾画、计划评估教学", 0, None),
    (16, "临床病理科", None, "报告单分析", 0, None),
    (16, "临床病理科", None, "临床技能模拟培训", 0, None),
    (17, "口腔全科", 10, "入轮转科室教育", 1, None),
    (17, "口腔全科", 4, "教学查房", 2, None),
    (17, "口腔全科", 9, "临床小讲课", 4, None),
    (17, "口腔全科", 8, "教学病例讨论", 1, None),
    (17, "口腔全科", 3, "教学阅片", 0, None),
    (17, "口腔全科", 99, "其他", 0, None),
    (17, "口腔全科", 13, "临床文献研读会", 0, None),
    (17, "口腔全科", None, "教学上机", 0, None),
    (17, "口腔全科", 17, "影像诊断报告书写", 0, None),
    (17, "口腔全科", None, "靶区勾画、计划评估教学", 0, None),
    (17, "口腔全科", None, "报告单分析", 0, None),
    (17, "口腔全科", None, "临床技能模拟培训", 0, None),
    (22, "放射科", 10, "入轮转科室教育", 1, None),
    (22, "放射科", 4, "教学查房", 2, None),
    (22, "放射科", 9, "临床小讲课", 4, None),
    (22, "放射科", 8, "教学病例讨论", 2, None),
    (22, "放射科", 3, "教学阅片", 2, None),
    (22, "放射科", 99, "其他", 0, None),
    (22, "放射科", 13, "临床文献研读会", 0, None),
    (22, "放射科", None, "教学上机", 0, None),
    (22, "放射科", 17, "影像诊断报告书写", 1, None),
    (22, "放射科", None, "靶区勾画、计划评估教学", 0, None),
    (22, "放射科", None, "报告单分析", 0, None),
    (22, "放射科", None, "临床技能模拟培训", 0, None),
    (23, "超声医学科", 10, "入轮转科室教育", 1, None),
    (23, "超声医学科", 4, "教学查房", 0, None),
    (23, "超声医学科", 9, "临床小讲课", 4, None),
    (23, "超声医学科", 8, "教学病例讨论", 2, None),
    (23, "超声医学科", 3, "教学阅片", 0, None),
    (23, "超声医学科", 99, "其他", 0, None),
    (23, "超声医学科", 13, "临床文献研读会", 0, None),
    (23, "超声医学科", None, "教学上机", 0, None),
    (23, "超声医学科", 17, "影像诊断报告书写", 0, None),
    (23, "超声医学科", None, "靶区勾画、计划评估教学", 0, None),
    (23, "超声医学科", None, "报告单分析", 0, None),
    (23, "超声医学科", None, "临床技能模拟培训", 0, None),
    (24, "核医学科", 10, "入轮转科室教育", 1, None),
    (24, "核医学科", 4, "教学查房", 2, None),
    (24, "核医学科", 9, "临床小讲课", 4, None),
    (24, "核医学科", 8, "教学病例讨论", 2, None),
    (24, "核医学科", 3, "教学阅片", 0, None),
    (24, "核医学科", 99, "其他", 0, None),
    (24, "核医学科", 13, "临床文献研读会", 1,
     "3年培训期间，阅读相关专业外语书刊和教科书；阅读公开发表的专业文献并完成文摘总结或读书报告6篇以上，培训期间至少完成文献综述、临床病例总结各2篇"),
    (24, "核医学科", None, "教学上机", 0, None),
    (24, "核医学科", 17, "影像诊断报告书写", 0, None),
    (24, "核医学科", None, "靶区勾画、计划评估教学", 0, None),
    (24, "核医学科", None, "报告单分析", 0, None),
    (24, "核医学科", None, "临床技能模拟培训", 0, None),
    (25, "骨科", 10, "入轮转科室教育", 1, None),
    (25, "骨科", 4, "教学查房", 2, None),
    (25, "骨科", 9, "临床小讲课", 4, None),
    (25, "骨科", 8, "教学病例讨论", 2, None),
    (25, "骨科", 3, "教学阅片", 0, None),
    (25, "骨科", 99, "其他", 0, None),
    (25, "骨科", 13, "临床文献研读会", 0, None),
    (25, "骨科", None, "教学上机", 0, None),
    (25, "骨科", 17, "影像诊断报告书写", 0, None),
    (25, "骨科", None, "靶区勾画、计划评估教学", 0, None),
    (25, "骨科", None, "报告单分析", 0, None),
    (25, "骨科", None, "临床技能模拟培训", 0, None),
    (27, "放射肿瘤科", 10, "入轮转科室教育", 1, None),
    (27, "放射肿瘤科", 4, "教学查房", 2, None),
    (27, "放射肿瘤科", 9, "临床小讲课", 4, None),
    (27, "放射肿瘤科", 8, "教学病例讨论", 2, None),
    (27, "放射肿瘤科", 3, "教学阅片", 2, None),
    (27, "放射肿瘤科", 99, "其他", 0, None),
    (27, "放射肿瘤科", 13, "临床文献研读会", 0, None),
    (27, "放射肿瘤科", None, "教学上机", 0, None),
    (27, "放射肿瘤科", 17, "影像诊断报告书写", 0, None),
    (27, "放射肿瘤科", None, "靶区勾画、计划评估教学", 1, None),
    (27, "放射肿瘤科", None, "报告单分析", 0, None),
    (27, "放射肿瘤科", None, "临床技能模拟培训", 0, None),
    (28, "重症医学科", 10, "入轮转科室教育", 1, None),
    (28, "重症医学科", 4, "教学查房", 2, None),
    (28, "重症医学科", 9, "临床小讲课", 4, None),
    (28, "重症医学科", 8, "教学病例讨论", 2, None),
    (28, "重症医学科", 3, "教学阅片", 0, None),
    (28, "重症医学科", 99, "其他", 0, None),
    (28, "重症医学科", 13, "临床文献研读会", 0, None),
    (28, "重症医学科", None, "教学上机", 0, None),
    (28, "重症医学科", 17, "影像诊断报告书写", 0, None),
    (28, "重症医学科", None, "靶区勾画、计划评估教学", 0, None),
    (28, "重症医学科", None, "报告单分析", 0, None),
    (28, "重症医学科", None, "临床技能模拟培训", 0, None),
    (76, "口腔修复科", 10, "入轮转科室教育", 1, None),
    (76, "口腔修复科", 4, "教学查房", 2, None),
    (76, "口腔修复科", 9, "临床小讲课", 4, None),
    (76, "口腔修复科", 8, "教学病例讨论", 1, None),
    (76, "口腔修复科", 3, "教学阅片", 0, None),
    (76, "口腔修复科", 99, "其他", 0, None),
    (76, "口腔修复科", 13, "临床文献研读会", 0, None),
    (76, "口腔修复科", None, "教学上机", 0, None),
    (76, "口腔修复科", 17, "影像诊断报告书写", 0, None),
    (76, "口腔修复科", None, "靶区勾画、计划评估教学", 0, None),
    (76, "口腔修复科", None, "报告单分析", 0, None),
    (76, "口腔修复科", None, "临床技能模拟培训", 0, None),
    (77, "口腔颌面外科", 10, "入轮转科室教育", 1, None),
    (77, "口腔颌面外科", 4, "教学查房", 0, None),
    (77, "口腔颌面外科", 9, "临床小讲课", 4, None),
    (77, "口腔颌面外科", 8, "教学病例讨论", 1, None),
    (77, "口腔颌面外科", 3, "教学阅片", 2, None),
    (77, "口腔颌面外科", 99, "其他", 1, None),
    (77, "口腔颌面外科", 13, "临床文献研读会", 0, None),
    (77, "口腔颌面外科", None, "教学上机", 0, None),
    (77, "口腔颌面外科", 17, "影像诊断报告书写", 0, None),
    (77, "口腔颌面外科", None, "靶区勾画、计划评估教学", 0, None),
    (77, "口腔颌面外科", None, "报告单分析", 0, None),
    (77, "口腔颌面外科", None, "临床技能模拟培训", 0, None),
    (78, "口腔内科", 10, "入轮转科室教育", 1, None),
    (78, "口腔内科", 4, "教学查房", 2, None),
    (78, "口腔内科", 9, "临床小讲课", 4, None),
    (78, "口腔内科", 8, "教学病例讨论", 1, None),
    (78, "口腔内科", 3, "教学阅片", 0, None),
    (78, "口腔内科", 99, "其他", 0, None),
    (78, "口腔内科", 13, "临床文献研读会", 0, None),
    (78, "口腔内科", None, "教学上机", 0, None),
    (78, "口腔内科", 17, "影像诊断报告书写", 0, None),
    (78, "口腔内科", None, "靶区勾画、计划评估教学", 0, None),
    (78, "口腔内科", None, "报告单分析", 0, None),
    (78, "口腔内科", None, "临床技能模拟培训", 0, None),
    (79, "口腔正畸科", 10, "入轮转科室教育", 1, None),
    (79, "口腔正畸科", 4, "教学查房", 2, None),
    (79, "口腔正畸科", 9, "临床小讲课", 4, None),
    (79, "口腔正畸科", 8, "教学病例讨论", 1, None),
    (79, "口腔正畸科", 3, "教学阅片", 0, None),
    (79, "口腔正畸科", 99, "其他", 0, None),
    (79, "口腔正畸科", 13, "临床文献研读会", 0, None),
    (79, "口腔正畸科", None, "教学上机", 0, None),
    (79, "口腔正畸科", 17, "影像诊断报告书写", 0, None),
    (79, "口腔正畸科", None, "靶区勾画、计划评估教学", 0, None),
    (79, "口腔正畸科", None, "报告单分析", 0, None),
    (79, "口腔正畸科", None, "临床技能模拟培训", 0, None),
    (83, "口腔病理科", 10, "入轮转科室教育", 1, None),
    (83, "口腔病理科", 4, "教学查房", 0, None),
    (83, "口腔病理科", 9, "临床小讲课", 4, None),
    (83, "口腔病理科", 8, "教学病例讨论", 1, None),
    (83, "口腔病理科", 3, "教学阅片", 2, None),
    (83, "口腔病理科", 99, "其他", 1, None),
    (83, "口腔病理科", 13, "临床文献研读会", 0, None),
    (83, "口腔病理科", None, "教学上机", 0, None),
    (83, "口腔病理科", 17, "影像诊断报告书写", 0, None),
    (83, "口腔病理科", None, "靶区勾画、计划评估教学", 0, None),
    (83, "口腔病理科", None, "报告单分析", 0, None),
    (83, "口腔病理科", None, "临床技能模拟培训", 0, None),
    (84, "口腔颌面影像科", 10, "入轮转科室教育", 1, None),
    (84, "口腔颌面影像科", 4, "教学查房", 0, None),
    (84, "口腔颌面影像科", 9, "临床小讲课", 4, None),
    (84, "口腔颌面影像科", 8, "教学病例讨论", 1, None),
    (84, "口腔颌面影像科", 3, "教学阅片", 2, None),
    (84, "口腔颌面影像科", 99, "其他", 1, None),
    (84, "口腔颌面影像科", 13, "临床文献研读会", 0, None),
    (84, "口腔颌面影像科", None, "教学上机", 0, None),
    (84, "口腔颌面影像科", 17, "影像诊断报告书写", 0, None),
    (84, "口腔颌面影像科", None, "靶区勾画、计划评估教学", 0, None),
    (84, "口腔颌面影像科", None, "报告单分析", 0, None),
    (84, "口腔颌面影像科", None, "临床技能模拟培训", 0, None),
    (91, "医学遗传科", 10, "入轮转科室教育", 1, None),
    (91, "医学遗传科", 4, "教学查房", 2, None),
    (91, "医学遗传科", 9, "临床小讲课", 4, None),
    (91, "医学遗传科", 8, "教学病例讨论", 2, None),
    (91, "医学遗传科", 3, "教学阅片", 0, None),
    (91, "医学遗传科", 99, "其他", 0, None),
    (91, "医学遗传科", 13, "临床文献研读会", 0, None),
    (91, "医学遗传科", None, "教学上机", 0, None),
    (91, "医学遗传科", 17, "影像诊断报告书写", 0, None),
    (91, "医学遗传科", None, "靶区勾画、计划评估教学", 0, None),
    (91, "医学遗传科", None, "报告单分析", 0, None),
    (91, "医学遗传科", None, "临床技能模拟培训", 0, None),
    (11, "小儿外科", 10, "入轮转科室教育", 1, None),
    (11, "小儿外科", 4, "教学查房", 2, None),
    (11, "小儿外科", 9, "临床小讲课", 4, None),
    (11, "小儿外科", 8, "教学病例讨论", 2, None),
    (11, "小儿外科", 3, "教学阅片", 0, None),
    (11, "小儿外科", 99, "其他", 0, None),
    (11, "小儿外科", 13, "临床文献研读会", 0, None),
    (11, "小儿外科", None, "教学上机", 0, None),
    (11, "小儿外科", 17, "影像诊断报告书写", 0, None),
    (11, "小儿外科", None, "靶区勾画、计划评估教学", 0, None),
    (11, "小儿外科", None, "报告单分析", 0, None),
    (11, "小儿外科", None, "临床技能模拟培训", 0, None),
    (72, "外科(泌尿外科)", 10, "入轮转科室教育", 1, None),
    (72, "外科(泌尿外科)", 4, "教学查房", 2, None),
    (72, "外科(泌尿外科)", 9, "临床小讲课", 4, None),
    (72, "外科(泌尿外科)", 8, "教学病例讨论", 2, None),
    (72, "外科(泌尿外科)", 3, "教学阅片", 0, None),
    (72, "外科(泌尿外科)", 99, "其他", 0, None),
    (72, "外科(泌尿外科)", 13, "临床文献研读会", 0, None),
    (72, "外科(泌尿外科)", None, "教学上机", 0, None),
    (72, "外科(泌尿外科)", 17, "影像诊断报告书写", 0, None),
    (72, "外科(泌尿外科)", None, "靶区勾画、计划评估教学", 0, None),
    (72, "外科(泌尿外科)", None, "报告单分析", 0, None),
    (72, "外科(泌尿外科)", None, "临床技能模拟培训", 0, None),
    (73, "外科(胸心外科)", 10, "入轮转科室教育", 1, None),
    (73, "外科(胸心外科)", 4, "教学查房", 2, None),
    (73, "外科(胸心外科)", 9, "临床小讲课", 4, None),
    (73, "外科(胸心外科)", 8, "教学病例讨论", 2, None),
    (73, "外科(胸心外科)", 3, "教学阅片", 0, None),
    (73, "外科(胸心外科)", 99, "其他", 0, None),
    (73, "外科(胸心外科)", 13, "临床文献研读会", 0, None),
    (73, "外科(胸心外科)", None, "教学上机", 0, None),
    (73, "外科(胸心外科)", 17, "影像诊断报告书写", 0, None),
    (73, "外科(胸心外科)", None, "靶区勾画、计划评估教学", 0, None),
    (73, "外科(胸心外科)", None, "报告单分析", 0, None),
    (73, "外科(胸心外科)", None, "临床技能模拟培训", 0, None),
    (74, "外科(神经外科)", 10, "入轮转科室教育", 1, None),
    (74, "外科(神经外科)", 4, "教学查房", 2, None),
    (74, "外科(神经外科)", 9, "临床小讲课", 4, None),
    (74, "外科(神经外科)", 8, "教学病例讨论", 2, None),
    (74, "外科(神经外科)", 3, "教学阅片", 0, None),
    (74, "外科(神经外科)", 99, "其他", 0, None),
    (74, "外科(神经外科)", 13, "临床文献研读会", 0, None),
    (74, "外科(神经外科)", None, "教学上机", 0, None),
    (74, "外科(神经外科)", 17, "影像诊断报告书写", 0, None),
    (74, "外科(神经外科)", None, "靶区勾画、计划评估教学", 0, None),
    (74, "外科(神经外科)", None, "报告单分析", 0, None),
    (74, "外科(神经外科)", None, "临床技能模拟培训", 0, None),
    (80, "外科(整形外科)", 10, "入轮转科室教育", 1, None),
    (80, "外科(整形外科)", 4, "教学查房", 2, None),
    (80, "外科(整形外科)", 9, "临床小讲课", 4, None),
    (80, "外科(整形外科)", 8, "教学病例讨论", 2, None),
    (80, "外科(整形外科)", 3, "教学阅片", 0, None),
    (80, "外科(整形外科)", 99, "其他", 0, None),
    (80, "外科(整形外科)", 13, "临床文献研读会", 0, None),
    (80, "外科(整形外科)", None, "教学上机", 0, None),
    (80, "外科(整形外科)", 17, "影像诊断报告书写", 0, None),
    (80, "外科(整形外科)", None, "靶区勾画、计划评估教学", 0, None),
    (80, "外科(整形外科)", None, "报告单分析", 0, None),
    (80, "外科(整形外科)", None, "临床技能模拟培训", 0, None),
)


def standards_dictionary(spark: SparkSession) -> DataFrame:
    """The dictionary as a local relation, so the optimizer knows how small it is."""
    schema = OUTPUTS["t01"].schema
    columns = zip(*STANDARDS)
    return spark.createDataFrame(pa.table({f.name: list(c) for f, c in zip(schema, columns)}), schema)
