"""Strict comparison of a Spark result with the SQL answer: columns, types, rows."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns), key=repr)


def kinds(table: pa.Table) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in table.schema}


def differences(spark_df, con, sql: str) -> str | None:
    """None when both sides agree, otherwise a short description of the first difference."""
    left = spark_df.toArrow()
    right = con.sql(sql).to_arrow_table()
    if kinds(left) != kinds(right):
        a, b = kinds(left), kinds(right)
        return "types " + str({k: (a.get(k), b.get(k)) for k in sorted({*a, *b}) if a.get(k) != b.get(k)})
    if left.num_rows != right.num_rows:
        return f"rows {left.num_rows} != {right.num_rows}"
    a, b = rows_of(left), rows_of(right)
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, columns {sorted(left.column_names)}: {wrong[0]}"
    return None
