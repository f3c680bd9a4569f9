"""Row filters and recodes (F1-F13). All are Column predicates, so they stay
inside whole-stage codegen and reach the parquet scan where possible."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.tags import BOT_MARKERS, is_human

# Spellings of publication types and the class each maps to;
# every other spelling maps to the class "其他" (other).
TYPE_CLASSES = [
    (["CPFD", "中国会议", "会议论文"], "会议"),
    (["CDFD", "博士论文", "博士"], "博士"),
    (["期刊", "CJFD"], "期刊"),
    (["硕士论文", "CMFD", "硕士"], "硕士"),
    (["报纸文献", "CCND", "报纸"], "报纸"),
]
OTHER_TYPE = "其他"



def bot_filter(log: DataFrame, markers=BOT_MARKERS) -> DataFrame:
    """keep rows whose user agent holds no crawler marker."""
    return log.where(is_human(F.col("ua"), markers))


def guests(log: DataFrame) -> DataFrame:
    """rows without a user name but with a class code."""
    return log.where((F.col("un") == "") & (F.col("rcc") != ""))


def normalize_type(c: Column) -> Column:
    """F8: publication-type spelling -> one of six classes."""
    out = F.lit(OTHER_TYPE)
    for spellings, cls in reversed(TYPE_CLASSES):
        out = F.when(c.isin(spellings), F.lit(cls)).otherwise(out)
    return out


def recode_times(c: Column) -> Column:
    """a count of 2 is recorded as 12; others unchanged."""
    return F.when(c == 2, F.lit(12)).otherwise(c)
