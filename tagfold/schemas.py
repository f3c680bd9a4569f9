"""Schemas of the behaviour log, portraits and long-form tags."""

from pyspark.sql import types as T

# The 20 keys of a behaviour-log record, in record order
# (visit time, user name, cookie id, action, resource kind, ..., source).
LOG_FIELDS = [
    "vt", "un", "gki", "ac", "ro", "klc", "ri", "rkd", "sw", "p",
    "ci", "ua", "rcc", "rccc", "pfc", "dt", "di", "au", "jg", "sou",
]

LOG_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in LOG_FIELDS])

# The seven tag dimensions of a registered-user portrait, named
# as in the external portrait schema (spelling kept).
DIM_SUBJECT = "ConcenedSubject"
DIM_SUBSUBJECT = "SubConcenedSubject"
DIM_TOTAL_INTEREST = "SingleArticleTotalInterest"
DIM_RECENT_INTEREST = "SingleArticleRecentInterest"
DIM_TOTAL_AUTHOR = "TotalRelatedAuthor"
DIM_RECENT_AUTHOR = "RecentRelatedAuthor"
DIM_SEARCH = "SearchKeyword"

DIMS = [DIM_SUBJECT, DIM_SUBSUBJECT, DIM_TOTAL_INTEREST, DIM_RECENT_INTEREST,
        DIM_TOTAL_AUTHOR, DIM_RECENT_AUTHOR, DIM_SEARCH]
NESTED_DIMS = [DIM_TOTAL_INTEREST, DIM_RECENT_INTEREST]
FLAT_DIMS = [d for d in DIMS if d not in NESTED_DIMS]

# The 16 columns of the current portrait table, in order.
PORTRAIT_COLUMNS = [
    "UserName", "LawOfworkAndRest", "Area", "Age", "Gender",
    DIM_SUBJECT, DIM_SUBSUBJECT, DIM_TOTAL_INTEREST, DIM_RECENT_INTEREST,
    DIM_TOTAL_AUTHOR, DIM_RECENT_AUTHOR, DIM_SEARCH,
    "JournalsInterests", "ReferenceBookInterests",
    "CustomerPurchasingPowerInterests", "latest_log_time",
]

PORTRAIT_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c in ("Age", "Gender") else T.StringType(), True)
     for c in PORTRAIT_COLUMNS])

# The 14 columns of the legacy / guest portrait, in order.
GUEST_COLUMNS = [
    "UserID", "UserName", "LawOfworkAndRest", "Area", "Age", "Gender",
    "SingleArticleInterest", "BooksInterests", "JournalsInterests",
    "ReferenceBookInterests", "CustomerPurchasingPowerInterests",
    "ProductviscosityInterests", "PurchaseIntentionInterests", "latest_log_time",
]

GUEST_SCHEMA = T.StructType(
    [T.StructField(c, T.LongType() if c == "UserID" else
                   T.IntegerType() if c in ("Age", "Gender") else T.StringType(), True)
     for c in GUEST_COLUMNS])

# Long form of every portrait: one row per (user, dim, module, tag).
# module is '' for the five flat dimensions.
TAGS_SCHEMA = T.StructType([
    T.StructField("user", T.StringType(), False),
    T.StructField("dim", T.StringType(), False),
    T.StructField("module", T.StringType(), False),
    T.StructField("tag", T.StringType(), False),
    T.StructField("weight", T.DoubleType(), False),
    T.StructField("last_ms", T.LongType(), True),
])
TAG_COLUMNS = [f.name for f in TAGS_SCHEMA.fields]

DAY_MS = 86_400_000
