"""Run registered queries on Spark and their oracle SQL on DuckDB; compare
row count, column names, type families and order-insensitive values.

    python tests/oracle_check.py [--sf DIR] [name ...]
"""
from __future__ import annotations

import argparse
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from corpusmill.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 9))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{_norm(k)}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _family(arrow_type) -> str:
    import pyarrow as pa

    if pa.types.is_integer(arrow_type):
        return f"int{arrow_type.bit_width}"
    if pa.types.is_floating(arrow_type):
        return "float"
    if pa.types.is_string(arrow_type) or pa.types.is_large_string(arrow_type):
        return "string"
    if pa.types.is_boolean(arrow_type):
        return "bool"
    if pa.types.is_timestamp(arrow_type):
        return "timestamp"
    if pa.types.is_list(arrow_type) or pa.types.is_large_list(arrow_type):
        return "list"
    return str(arrow_type)


def digest(table) -> tuple[int, list[str], str]:
    cols = sorted(table.column_names)
    rows = list(zip(*[table.column(c).to_pylist() for c in cols])) if cols else []
    lines = sorted("|".join(_norm(v) for v in r) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    fams = [f"{c}:{_family(table.schema.field(c).type)}" for c in cols]
    return len(rows), fams, h, lines


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    st = sdf.toArrow()
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": st.num_rows, "spark_s": round(t1 - t0, 2)}
    dt = con.sql(sql).to_arrow_table()
    t2 = time.time()
    sn, sf_, sh, sl = digest(st)
    dn, df_, dh, dl = digest(dt)
    ok = sn == dn and sf_ == df_ and sh == dh
    res = {"name": name, "ok": ok, "rows": sn, "oracle_rows": dn, "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    if not ok:
        res["schema"] = (sf_, df_)
        only_s = sorted(set(sl) - set(dl))[:3]
        only_d = sorted(set(dl) - set(sl))[:3]
        res["only_spark"] = [x[:300] for x in only_s]
        res["only_duck"] = [x[:300] for x in only_d]
    return res


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    from corpusmill.session import build_session
    import __spark_entry__ as E

    spark = build_session("local[8]")
    qs, sqls = E.queries(), E.oracle_sql()
    names = a.names or list(qs)
    con = duck(a.sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, qs[n], sqls.get(n), a.sf)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:800]}
        bad += r.get("ok") is False
        print(r, flush=True)
    print(f"FAILED {bad} of {len(names)}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
