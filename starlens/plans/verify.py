"""Compare a registered Spark query with its DuckDB oracle.

Checks row count, column names, Arrow types and the order-insensitive
multiset of rows (floats compared exactly and, separately, to 9 significant
digits). Used by the tests and runnable as
``python -m starlens.plans.verify /root/testdata/sf0.01 [key ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(data_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{data_dir.rstrip('/')}/{t}.parquet"
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
        except Exception:  # table absent at this scale: not needed by any query
            pass
    return con


def _norm(v, digits: int | None):
    if v is None:
        return ("NULL",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("NaN",)
        if digits is not None and v != 0.0:
            return ("f", float(f"{v:.{digits}g}"))
        return ("f", v)
    if hasattr(v, "isoformat"):
        return ("d", v.isoformat())
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", float(v)) if abs(v) < 2**53 else ("i", v)
    return ("s", str(v))


def _rows(table: pa.Table, digits: int | None) -> Counter:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    return Counter(tuple(_norm(col[i], digits) for col in data) for i in range(table.num_rows))


@dataclass
class Result:
    key: str
    rows_spark: int = 0
    rows_oracle: int = 0
    columns_match: bool = False
    types_match: bool = False
    values_exact: bool = False
    values_close: bool = False
    seconds: float = 0.0
    detail: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return (
            self.rows_spark == self.rows_oracle
            and self.columns_match
            and self.types_match
            and self.values_exact
        )


def _type_name(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    return str(t)


def compare(spark_table: pa.Table, oracle_table: pa.Table, key: str = "") -> Result:
    r = Result(key, spark_table.num_rows, oracle_table.num_rows)
    sc, oc = sorted(spark_table.column_names), sorted(oracle_table.column_names)
    r.columns_match = sc == oc
    if not r.columns_match:
        r.detail.append(f"columns spark={sc} oracle={oc}")
        return r
    st = {f.name: _type_name(f.type) for f in spark_table.schema}
    ot = {f.name: _type_name(f.type) for f in oracle_table.schema}
    r.types_match = st == ot
    if not r.types_match:
        r.detail.append(
            "types " + ", ".join(f"{c}: {st[c]} vs {ot[c]}" for c in sc if st[c] != ot[c])
        )
    exact_s, exact_o = _rows(spark_table, None), _rows(oracle_table, None)
    r.values_exact = exact_s == exact_o
    r.values_close = r.values_exact or _rows(spark_table, 9) == _rows(oracle_table, 9)
    if not r.values_exact:
        only_s = list((exact_s - exact_o).elements())[:3]
        only_o = list((exact_o - exact_s).elements())[:3]
        r.detail.append(f"spark-only {only_s} oracle-only {only_o}")
    return r


def run(spark, data_dir: str, keys=None) -> list[Result]:
    from starlens.plans.catalog import QUERIES
    from starlens.plans.oracle import ORACLE_SQL

    con = duckdb_connection(data_dir)
    out = []
    for key in keys or list(QUERIES):
        t0 = time.time()
        spark_table = QUERIES[key](spark, data_dir).toArrow()
        secs = time.time() - t0
        if key not in ORACLE_SQL:
            res = Result(key, spark_table.num_rows, -1)
            res.detail.append("no oracle SQL")
        else:
            oracle_table = con.execute(ORACLE_SQL[key]).to_arrow_table()
            res = compare(spark_table, oracle_table, key)
        res.seconds = secs
        out.append(res)
    return out


def main(argv: list[str]) -> int:
    from starlens.session import build_session

    data_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    results = run(spark, data_dir, argv[2:] or None)
    bad = 0
    for r in results:
        flag = "OK " if r.ok else ("~  " if r.values_close and r.columns_match else "BAD")
        bad += not r.ok
        print(
            f"{flag} {r.key:40s} rows {r.rows_spark}/{r.rows_oracle} "
            f"types={r.types_match} exact={r.values_exact} close={r.values_close} "
            f"{r.seconds:.2f}s {' | '.join(r.detail)}"
        )
    print(f"{len(results) - bad}/{len(results)} exact matches")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
