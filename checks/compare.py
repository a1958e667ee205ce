"""Run registered queries against their oracle SQL on one scale factor.

    python -m checks.compare /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

from checks.oracles import ORACLES
from checks.queries import QUERIES
from dqspark.session import get_spark

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def oracle_rows(con, sql: str):
    result = con.execute(sql)
    columns = [(c[0], str(c[1])) for c in result.description]
    return columns, result.fetchall()


def normal(rows, names):
    """Rows with columns in name order, comparable across engines."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


FAMILIES = {
    "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE",
    "int": "INTEGER", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def last(value):
    """Sort key of a column that puts missing values last."""
    return value is None, value if value is not None else 0


#: Order in which a query promises its rows, as a sort key of a row.
ORDERED = {
    "histogram": lambda r: r.bin,
    "kde_grid": lambda r: r.point,
    "missing_summary": lambda r: (-r.missing_count, r.column),
    "cardinality": lambda r: (-r.distinct_count, r.column),
    "worst_metrics": lambda r: (last(r.value), r.metric),
    "top_corr_pairs": lambda r: last(None if r.correlation is None else -abs(r.correlation)),
    "fuzzy_duplicates": lambda r: -r.similarity_score,
    "key_duplicates": lambda r: last(r.customer_id),
    "segment_summary": lambda r: ("Low Value", "Medium Value", "High Value").index(r.customer_segment),
}


def difference(df, con, sql: str, name: str | None = None) -> str | None:
    """What differs between a query and its oracle, or None; with ``name``, also whether its order holds."""
    found = df.collect()
    if name in ORDERED and [ORDERED[name](r) for r in found] != sorted(ORDERED[name](r) for r in found):
        return "rows are not in order"
    rows = [tuple(r) for r in found]
    columns, expected = oracle_rows(con, sql)
    names, other = df.columns, [c for c, _ in columns]
    if sorted(names) != sorted(other):
        return f"columns {sorted(names)} != {sorted(other)}"
    types = {f.name: FAMILIES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    wrong = {c: (types[c], t) for c, t in columns if types[c] != t.upper()}
    if wrong:
        return f"types {wrong}"
    if len(rows) != len(expected):
        return f"rows {len(rows)} != {len(expected)}"
    ours, theirs = normal(rows, names), normal(expected, other)
    diff = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(diff)} of {len(rows)} rows, first {diff[0]}" if diff else None


def main(sf_dir: str, keys) -> int:
    spark = get_spark(
        "compare",
        **{"spark.master": "local[8]", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failures = connect(sf_dir), 0
    for name in keys or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            found = difference(df, con, ORACLES[name], name) if name in ORACLES else f"rows only: {df.count()}"
            failures += found is not None and name in ORACLES
        except Exception as error:  # report and go on with the next query
            found, failures = f"error {str(error)[:700]}", failures + 1
        print(f"{'ok  ' if found is None else 'DIFF'} {name} {time.time() - start:.1f}s {found or ''}"[:1200], flush=True)
    print(f"{failures} failures, {len(keys or QUERIES)} queries, sf {Path(sf_dir).name}")
    return failures


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1], sys.argv[2:]))
