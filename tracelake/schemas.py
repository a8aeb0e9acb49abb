"""Fixed schemas of the three analysed tables.

The exporters of the original tool inferred columns from the keys they saw,
so a column could be missing.  Here every table has a fixed schema: an absent
field is NULL, never a missing column.  Unknown log keys go to ``extras``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Log fields the analyses read.  Names contain dots: always backtick them.
LOG_FIELDS = ["timestamp", "level", "type", "session.id", "tokens.input", "tokens.output", "cost"]

LOGS = T.StructType(
    [T.StructField("timestamp", T.TimestampNTZType())]
    + [T.StructField(name, T.StringType()) for name in LOG_FIELDS[1:]]
    + [
        T.StructField("filename", T.StringType()),
        T.StructField("extras", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Raw logs as stored by the text exporter: every value is text.
RAW_LOGS = T.StructType(
    [T.StructField(name, T.StringType()) for name in LOG_FIELDS]
    + [T.StructField("extras", T.MapType(T.StringType(), T.StringType()))]
)

PARTS = T.StructType(
    [
        T.StructField("part_id", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("time_created", T.LongType()),
        T.StructField("time_updated", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("part_type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("reasoning_time", T.StringType()),
        T.StructField("tool", T.StringType()),
        T.StructField("tool_status", T.StringType()),
        T.StructField("tool_input", T.StringType()),
        T.StructField("tool_output", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("tokens_input", T.LongType()),
        T.StructField("tokens_output", T.LongType()),
        T.StructField("tokens_total", T.LongType()),
        T.StructField("cost", T.DoubleType()),
        T.StructField("files", T.StringType()),
    ]
)

SESSIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("slug", T.StringType()),
        T.StructField("directory", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("summary_additions", T.LongType()),
        T.StructField("summary_deletions", T.LongType()),
        T.StructField("time_created", T.LongType()),
        T.StructField("time_updated", T.LongType()),
    ]
)

SESSION_COLUMNS = [f.name for f in SESSIONS.fields]
PART_COLUMNS = [f.name for f in PARTS.fields]

# Source tables of the conversation store.
SOURCE_PART = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("message_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("time_created", T.LongType()),
        T.StructField("time_updated", T.LongType()),
        T.StructField("data", T.StringType()),
    ]
)
SOURCE_MESSAGE = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("data", T.StringType())]
)

# The part types the exporter knows.
PART_TYPES = ["text", "reasoning", "tool", "step-start", "step-finish", "patch"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` by name: present ones cast (``try_cast``: a value
    that does not fit is NULL, e.g. a NaN token count written as float by a
    pandas exporter), absent ones NULL.  Extra columns are dropped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            cols.append(F.col(f"`{f.name}`"))
        elif isinstance(have[f.name], (T.FloatType, T.DoubleType)) and isinstance(f.dataType, T.LongType):
            c = F.col(f"`{f.name}`")
            cols.append(F.when(~F.isnan(c), c.try_cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
    return df.select(*cols)
