"""Runs queries beside their SQL and compares rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and math.isnan(v):
            return None
        if hasattr(v, "item") and not isinstance(v, (list, tuple)) and getattr(v, "ndim", 0) == 0:
            v = v.item()
        if isinstance(v, float):
            return int(v) if v.is_integer() else round(v, 9)
        return tuple(map(plain, v)) if isinstance(v, (list, tuple)) or hasattr(v, "tolist") else v

    names = sorted(frame.columns)
    return sorted((tuple(plain(v) for v in r) for r in frame[names].itertuples(index=False)), key=repr)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str:
    """What differs, or an empty string."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    a, b = rows_of(spark_frame), rows_of(sql_frame)
    if a == b:
        return ""
    only_a, only_b = [x for x in a if x not in set(b)][:2], [x for x in b if x not in set(a)][:2]
    return f"{len(a)} and {len(b)} rows; only Spark {only_a}; only SQL {only_b}"
