"""Raw -> bronze: rows unchanged plus lineage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_lineage(df: DataFrame, source_file: str | None, started_at: datetime) -> DataFrame:
    """Run timestamp, source file name and run date.

    ``source_file=None`` takes the name of the file each row was read from, for sources that
    consist of many files; it needs a frame straight from a file scan.
    """
    stamp = F.lit(started_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")
    name = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    return df.withColumns(
        {
            "ingestion_timestamp": stamp,
            "source_file": name,
            "processing_date": F.lit(started_at.date().isoformat()).cast("date"),
        }
    )
