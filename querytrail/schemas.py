"""Column names and schemas shared by sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


QUERY_KEY = ["ProcID", "QueryID", "logdate"]

# The columns of an extract, in order.
EXTRACT_COLUMNS = [
    "ProcID", "logdate", "CollectTimeStamp", "SessionID", "QueryID", "StatementType",
    "ObjectDatabaseName", "ObjectTableName", "Username", "SQLTEXTINFO",
]

# Columns of a lineage row, of the saved map, of run results and of the difference report.
LINEAGE_KEY = [
    "source_col", "source_table", "target_table", "target_col",
    "source_db", "target_db", "Derivation_logic",
]
TABLE_MAP = strings("table_name", "database_name")
RUN_METRICS = T.StructType([
    T.StructField("FileName", T.StringType()),
    T.StructField("DurationSeconds", T.LongType()),
    T.StructField("JsonFile", T.StringType()),
    T.StructField("Status", T.StringType()),
])
DIFFERENCES = strings(
    "error_code", "target_db", "target_table", "target_column",
    "source_db", "source_table", "source_column", "description",
)

# Accepted header spellings of a column mapping, first match wins.
MAPPING_ALIASES = {
    "target_db": ["target_db", "targetdb", "target_database"],
    "target_table": ["target_table", "targettable"],
    "target_column": ["target_column", "targetcolumn"],
    "source_db": ["source_db", "sourcedb", "source_database"],
    "source_table": ["source_table", "sourcetable"],
    "source_column": ["source_column", "sourcecolumn"],
}

# Fields of a token and of a document's metadata.
TOKEN = T.StructType([
    T.StructField("index", T.IntegerType()),
    T.StructField("type", T.IntegerType()),
    T.StructField("typeName", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("startIndex", T.IntegerType()),
    T.StructField("stopIndex", T.IntegerType()),
    T.StructField("line", T.IntegerType()),
    T.StructField("column", T.IntegerType()),
    T.StructField("channel", T.IntegerType()),
])

# What a token's fields are where they are missing.
TOKEN_DEFAULTS = {
    "index": 0, "type": -1, "typeName": "", "text": "", "startIndex": 0, "stopIndex": 0, "line": 1, "column": 0,
    "channel": 0,
}
# Type and name of the token that ends a file.
END_OF_FILE = -1
END_NAME = "EOF"

FILE_METADATA = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("totalTokens", T.IntegerType()),
    T.StructField("processingTime", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("failedQueries", T.ArrayType(T.StringType())),
])

# One row per tree node. node_id counts nodes in pre-order, end_id is the last node_id of the
# subtree, so "below" is a range test and no path strings are needed. What the reader knows anyway
# (number of children, type of the parent, number of rules that end here) is kept as a column.
NODE = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("tree_no", T.IntegerType()),
    T.StructField("node_id", T.LongType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("end_id", T.LongType()),
    T.StructField("depth", T.IntegerType()),
    T.StructField("ordinal", T.LongType()),
    T.StructField("child_count", T.LongType()),
    T.StructField("closes", T.LongType()),
    T.StructField("parent_type", T.StringType()),
    T.StructField("node_type", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("start", T.IntegerType()),
    T.StructField("stop", T.IntegerType()),
    T.StructField("error", T.StringType()),
])

# The tokens at which a node begins and, if it is a rule, ends.
_PLACED = T.StructType([
    T.StructField("type", T.IntegerType()),
    T.StructField("text", T.StringType()),
    T.StructField("line", T.IntegerType()),
    T.StructField("column", T.IntegerType()),
    T.StructField("start_index", T.IntegerType()),
    T.StructField("stop_index", T.IntegerType()),
    T.StructField("token_index", T.IntegerType()),
])
PLACED = T.StructType([T.StructField("start_token", _PLACED), T.StructField("stop_token", _PLACED)])
