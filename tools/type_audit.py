"""Compare output column types of every registered query with its DuckDB oracle."""

import sys

import duckdb

sys.path.insert(0, ".")
from tablewatch.plans import load_all  # noqa: E402
from tablewatch.session import get_spark  # noqa: E402
from tablewatch.sources.fixtures import BASE_TABLES  # noqa: E402

SPARK = {"int": "i32", "bigint": "i64", "double": "f64", "string": "str", "boolean": "bool",
         "timestamp": "ts", "timestamp_ntz": "ts", "date": "date", "smallint": "i16", "tinyint": "i8", "float": "f32"}
DUCK = {"INTEGER": "i32", "BIGINT": "i64", "DOUBLE": "f64", "VARCHAR": "str", "BOOLEAN": "bool", "TIMESTAMP": "ts",
        "DATE": "date", "HUGEINT": "i128", "SMALLINT": "i16", "TINYINT": "i8", "FLOAT": "f32"}


def kind(t, table):
    t = str(t)
    if t.lower().startswith("decimal"):
        return "dec"
    return table.get(t, table.get(t.upper(), t))


sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
q, o = load_all()
spark = get_spark("local[8]", 8)
con = duckdb.connect()
for n in BASE_TABLES:
    con.execute(f"create view {n} as select * from read_parquet('{sf}/{n}.parquet')")
bad = 0
for k in sorted(o):
    df = q[k](spark, sf)
    s = {f.name: kind(f.dataType.simpleString(), SPARK) for f in df.schema.fields}
    rel = con.sql(f"select * from ({o[k]}) limit 0")
    d = {c: kind(t, DUCK) for c, t in zip(rel.columns, rel.types)}
    diff = {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
    if diff:
        bad += 1
        print("TYPE", k, diff)
print("type mismatches:", bad)
