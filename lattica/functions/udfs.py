"""Row maps in Python with error capture."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lattica.session import ship


def foreach_row(df: DataFrame, func: Callable[[dict], dict | None], schema: str, key: str = "sha256") -> DataFrame:
    """(key, fields of schema, error): func on every row; a row for which it gives None is left out, and one for which it
    raises keeps its key and the error."""
    ship(df.sparkSession)
    fields = T._parse_datatype_string(schema).fieldNames()
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    got = func(row)
                    if got is not None:
                        out.append({key: row[key], **{f: got.get(f) for f in fields}, "error": None})
                except Exception as e:  # noqa: BLE001  any failure of a row is a result
                    out.append({key: row[key], **dict.fromkeys(fields), "error": "".join(traceback.format_exception_only(e)).strip()})
            yield pd.DataFrame(out, columns=[key, *fields, "error"])

    return df.mapInPandas(run, f"{key} {kind}, {schema}, error string")


def split_errors(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    return rows.where(F.col(error).isNull()).drop(error), rows.where(F.col(error).isNotNull())
