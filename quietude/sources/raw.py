"""Raw sensor CSV with a quarantine: readings, and what was wrong with the rest.

Every field is read as text, so nothing fails and nothing vanishes. A line
whose number of fields is not the header's, and a row without a time, are
rejected; a time or a number that does not parse becomes NULL and the row
stays. Either way the fault is recorded with the column, the reason and the
text that was there: ``readings + rejected = lines``, and every fault can be
counted or looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quietude.functions.expr import q, s
from quietude.sources.schemas import RAW_SENSOR_SCHEMA

# A local time (0 to 9 decimals of a second), with what may follow it.
LOCAL_TIME = "^([0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,9})?)(Z|[+-][0-9]{2}:?[0-9]{2})?$"
LINE = "_line"  # the text of a malformed line
FAULTS = "faults"
MALFORMED, MISSING, NOT_TIME, NOT_NUMBER = "malformed line", "missing", "not a time", "not a number"

_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": LINE}


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, LINE]])


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A raw CSV with a header, every column as text, and ``_line`` where the
    number of fields is wrong (which takes all fields: without column pruning)."""
    header = spark.read.options(header=True, escape='"').csv(path).columns
    return spark.read.schema(_text_schema(header)).options(header=True, enforceSchema=True, columnPruning=False, **_OPTIONS).csv(path)


def parse_lines(lines: DataFrame, columns: list[str], col: str = "value") -> DataFrame:
    """The same for lines of text without a header."""
    parsed = F.from_csv(F.col(col), _text_schema(columns).simpleString()[len("struct<"):-1].replace(":", " "), _OPTIONS)
    return lines.select(F.explode(F.array(parsed)).alias("r")).select("r.*")


def time_sql(text: str) -> str:
    """The local wall-clock time of a text that is wholly a time; else NULL."""
    return f"try_cast(regexp_extract({text}, {s(LOCAL_TIME)}, 1) AS TIMESTAMP_NTZ)"


def with_faults(raw: DataFrame, extra_numbers: tuple[str, ...] = (), time_col: str = "time") -> DataFrame:
    """Add ``faults``, an array of (column_name, reason, text), to raw text rows."""
    def fault(column: str, reason: str, text: str, when: str) -> str:
        return f"CASE WHEN {when} THEN named_struct('column_name', {column}, 'reason', {s(reason)}, 'text', {text}) END"

    numbers = [f.name for f in RAW_SENSOR_SCHEMA.fields if isinstance(f.dataType, T.DoubleType)] + list(extra_numbers)
    t = q(time_col)
    found = [fault(s(time_col), MISSING, "CAST(NULL AS STRING)", f"{t} IS NULL"),
             fault(s(time_col), NOT_TIME, t, f"{t} IS NOT NULL AND {time_sql(t)} IS NULL")]
    found += [fault(s(c), NOT_NUMBER, q(c), f"{q(c)} IS NOT NULL AND try_cast({q(c)} AS DOUBLE) IS NULL") for c in numbers]
    broken = fault("CAST(NULL AS STRING)", MALFORMED, LINE, "true")
    whole = f"filter(array({', '.join(found)}), f -> f IS NOT NULL)"
    return raw.withColumn(FAULTS, F.expr(f"CASE WHEN {LINE} IS NOT NULL THEN array({broken}) ELSE {whole} END"))


def accepted(faulty: DataFrame, extra_numbers: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows that stay, the used columns typed (``keep``: further ones as text).
    Times stay text, for ``features.preprocess_raw``, which parses them."""
    cols = [f"try_cast({q(f.name)} AS {f.dataType.simpleString()}) AS {q(f.name)}" for f in RAW_SENSOR_SCHEMA.fields]
    cols += [f"try_cast({q(c)} AS DOUBLE) AS {q(c)}" for c in extra_numbers]
    return faulty.filter(f"{LINE} IS NULL AND `time` IS NOT NULL").selectExpr(*cols, *map(q, keep))


def faults(faulty: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per fault: column_name, reason, text and whether it cost the row."""
    return (faulty.select(*keep, F.explode(FAULTS).alias("f"))
            .selectExpr(*map(q, keep), "f.column_name", "f.reason", "f.text",
                        f"f.reason IN ({s(MALFORMED)}, {s(MISSING)}) AS rejected"))


def fault_counts(found: DataFrame) -> DataFrame:
    """Faults per column and reason."""
    return (found.groupBy("column_name", "reason", "rejected").agg(F.count("*").alias("n"))
            .orderBy("reason", "column_name"))
