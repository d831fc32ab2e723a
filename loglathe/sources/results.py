"""Result folders with one JSON document per line."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType, TimestampType

from ..schema import TABLES
from ..store.paths import exists

logger = logging.getLogger(__name__)

_BAD_DOCUMENT = "_corrupt_record"


def _typed(text: Column, dtype: DataType) -> Column:
    """Read a field by its declared type; dates may also be epoch milliseconds."""
    if isinstance(dtype, TimestampType):
        return F.coalesce(text.try_cast(dtype), F.timestamp_millis(text.try_cast("bigint")))
    return text.try_cast(dtype)


def parse_documents(lines: DataFrame, schema: StructType, col: str = "value") -> DataFrame:
    """JSON text to typed columns; text that is no JSON object is left out.

    Fields are read as text first, so one value of a wrong type becomes null and
    does not cost the whole document.
    """
    names = [*schema.names, _BAD_DOCUMENT]
    as_text = StructType([StructField(name, StringType()) for name in names])
    document = F.from_json(col, as_text, {"columnNameOfCorruptRecord": _BAD_DOCUMENT})
    # The one-row inline keeps the filter from repeating the JSON parse.
    documents = lines.filter(F.trim(col) != "").select(F.inline(F.array(document)))
    readable = documents.filter(F.col(_BAD_DOCUMENT).isNull())
    return readable.select(*[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def load_json_results(
    spark: SparkSession,
    root: str,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    pattern: str = "*.json",
) -> dict[str, DataFrame]:
    """One frame per analysis folder ``<root>/<analysis>/`` that exists.

    A stream with a checkpoint loads each file once, however often it is restarted.
    """
    frames = {}
    for analysis, table in TABLES.items():
        folder = f"{root.rstrip('/')}/{analysis}"
        if not exists(spark, folder):
            logger.warning("result folder not found: %s", folder)
            continue
        reader = spark.readStream if streaming else spark.read
        if streaming and max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        lines = reader.option("pathGlobFilter", pattern).text(folder)
        schema = StructType([f for f in table.schema.fields if f.name != "processed_at"])
        frames[analysis] = parse_documents(lines, schema)
    return frames
