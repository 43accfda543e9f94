"""Result tables of an analysis and how they are stored."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quillstat.sources.tables import write_table

Tables = dict[str, DataFrame]


def save_tables(tables: Tables, folder: str) -> None:
    """One parquet folder per table; partitioned by split where the table has one."""
    for name, df in tables.items():
        write_table(df, f"{folder.rstrip('/')}/{name}", ["split"] if "split" in df.columns and name == "prepared" else ())
