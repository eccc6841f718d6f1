"""Writing tables as delimited text."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame


def dated_path(path: str, today: datetime.date | None = None) -> str:
    """'out/name.csv' -> 'out/name_20230401.csv'."""
    stem, dot, ext = path.rpartition(".")
    day = (today or datetime.date.today()).strftime("%Y%m%d")
    return f"{stem}_{day}{dot}{ext}" if dot else f"{path}_{day}"


def write_csv(df: DataFrame, path: str, sep: str = ",", null: str = "NA", dated: bool = False, today=None) -> str:
    """Delimited text with header, one part per task; returns the path.

    ``null`` is what a missing cell becomes; wide exports use the empty text.
    """
    target = dated_path(path, today) if dated else path
    df.write.mode("overwrite").options(header=True, sep=sep, nullValue=null, emptyValue="").csv(target)
    return target
