"""Print one comparison line per query: python tests/run_compare.py SF_DIR [name …]."""

import os
import sys
import tempfile
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from stemma.session import build_session  # noqa: E402
from tests.compare import compare, connect  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        try:
            if name in oracles:
                r = compare(spark, con, fn, oracles[name], sf_dir)
                mark = "ok  " if r["equal"] else "DIFF"
                print(f"{mark} {name:28} rows={r['rows']} spark={r['spark_s']}s sql={r['sql_s']}s", flush=True)
                if not r["equal"]:
                    if not r["columns"]:
                        print("     columns", r["cols"])
                    for side in ("only_spark", "only_sql"):
                        for row in r[side]:
                            print("    ", side, repr(row)[:600])
            else:
                print(f"rows {name:28} {fn(spark, sf_dir).count()}", flush=True)
        except Exception as e:
            print(f"FAIL {name}: {str(e)[:1500]}", flush=True)
            if os.environ.get("TRACE"):
                traceback.print_exc()
