"""Compare column types of every Spark query with its DuckDB oracle (names and types)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from listenlens.plans import all_queries  # noqa: E402
from listenlens.session import get_spark  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT"}

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
con = duckdb.connect()
for t in TABLES:
    con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
spark = get_spark("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
only = set(sys.argv[2:])
for name, q in all_queries().items():
    if q.sql is None or (only and name not in only):
        continue
    df = q.build(spark, sf)
    st = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    rel = con.sql(q.sql)
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    diffs = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    print(f"{name:26s} {'OK' if not diffs else 'DIFF ' + str(diffs)}", flush=True)
spark.stop()
