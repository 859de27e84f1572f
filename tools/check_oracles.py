"""Run registered queries in Spark and their DuckDB oracles; compare results.

Usage: python tools/check_oracles.py [--json=report.json] [sf_dir] [name ...]

Comparison: same column names, same row count, and equal multisets of rows
(columns sorted by name, floats compared after rounding to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from quire.plans.all_queries import ORACLES, QUERIES  # noqa: E402
from quire.session import build_session  # noqa: E402
from quire.sources.tables import TABLES  # noqa: E402


_SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return round(v, 6) + 0.0
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, sf_dir, name):
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cols = df.columns
    if name not in ORACLES:
        return {"name": name, "status": "rows-only", "rows": len(rows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(ORACLES[name])
    ocols = rel.columns
    orows = rel.fetchall()
    t2 = time.time()
    res = {"name": name, "rows": len(rows), "oracle_rows": len(orows),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if sorted(cols) != sorted(ocols):
        res["status"] = f"COLUMNS differ: {sorted(cols)} vs {sorted(ocols)}"
        return res
    spark_types = {f.name: _SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    duck_types = dict(zip(ocols, (str(t) for t in rel.types)))
    type_diff = {c: (spark_types[c], duck_types[c]) for c in cols if spark_types[c] != duck_types[c]}
    if type_diff:
        res["types"] = type_diff
    a, b = _rows(cols, rows), _rows(ocols, orows)
    if a == b:
        res["status"] = "match"
    else:
        sa, sb = set(a), set(b)
        res["status"] = "VALUES differ"
        res["only_spark"] = [r for r in a if r not in sb][:3]
        res["only_oracle"] = [r for r in b if r not in sa][:3]
    return res


def main(argv):
    out_json = None
    if any(a.startswith("--json=") for a in argv):
        out_json = [a for a in argv if a.startswith("--json=")][0].split("=", 1)[1]
        argv = [a for a in argv if not a.startswith("--json=")]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = oracle_connection(sf_dir)
    bad = 0
    results = []
    for n in names:
        try:
            r = compare(spark, con, sf_dir, n)
        except Exception as e:  # noqa: BLE001
            r = {"name": n, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
        results.append({k: v for k, v in r.items() if k not in ("only_spark", "only_oracle")})
    if out_json:
        import json
        with open(out_json, "w") as f:
            json.dump({"sf_dir": sf_dir, "bad": bad, "queries": results}, f, indent=1, default=str)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
