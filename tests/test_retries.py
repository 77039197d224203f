"""Task failures (a lost executor) must not change published numbers.

Runs in a subprocess with master ``local[4,4]`` (a task may be attempted 4
times). A test-only Python UDF fails the first attempt of partition 0 --
once inside the raw scan stage (a shuffle-map stage) and once in a write's
result stage -- and every count must stay exact.
"""

import json
import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent('''
    import datetime as dt, json, sys, tempfile
    sys.path.insert(0, ROOT)
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from pyspark.sql.types import BooleanType
    spark = (SparkSession.builder.master("local[4,4]")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp())
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from cardgeo import Params
    from cardgeo.plans import publish_month
    from cardgeo.schemas import FLAGS_SCHEMA, TXN_SCHEMA
    from cardgeo.sinks import SnapshotTable, shared_dir

    import os
    marks = tempfile.mkdtemp()  # one machine: a local test of task retries

    def failing(tag):
        @F.udf(BooleanType())
        def fail_first_attempt(x):
            ctx = TaskContext.get()
            if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
                open(os.path.join(marks, tag), "w").close()
                raise RuntimeError("injected task failure")
            return True
        return fail_first_attempt

    jan = dt.datetime(2023, 1, 9)
    rows = [(f"t{i}", jan, "123456" if i % 3 else "654321", "US" if i % 4 else "CA", i % 10 == 0)
            for i in range(400)]
    tx = spark.createDataFrame(rows, TXN_SCHEMA).repartition(4)
    tx = tx.where(failing("scan")(F.col("BIN")))          # fails inside the scan stage
    vendor = spark.createDataFrame([("123456", "US")], "BIN string, country string")
    flags_t = SnapshotTable(shared_dir(spark, "t", "flags"))
    map_t = SnapshotTable(shared_dir(spark, "t", "map"))
    res = publish_month(tx, vendor, "2023-01", flags_table=flags_t, map_table=map_t,
                        params=Params(min_txns=1))

    plain = SnapshotTable(shared_dir(spark, "t", "plain"))
    f = spark.createDataFrame([(f"B{i}", "US", None, False, 1) for i in range(100)], FLAGS_SCHEMA)
    f = f.repartition(4).where(failing("write")(F.col("BIN")))  # fails in the write stage
    commit = plain.write(f, "2023-01")
    print(json.dumps({"metrics": res.metrics,
                      "flags": [list(r) for r in flags_t.read(spark).orderBy("BIN").collect()],
                      "row_count": commit.row_count, "read_back": plain.read(spark).count(),
                      "failures": sorted(os.listdir(marks))}))
''').replace("ROOT", repr(ROOT))


def test_counts_exact_under_task_retries():
    out = subprocess.run([sys.executable, "-c", SCRIPT], capture_output=True, text=True,
                         timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    got = json.loads(out.stdout.strip().splitlines()[-1])
    m = got["metrics"]
    assert (m["rows_in"], m["fraud"], m["kept"]) == (400, 40, 360)
    assert got["flags"] == [["123456", "US", "US", False, 240, "2023-01"],
                            ["654321", "US", None, False, 120, "2023-01"]]
    assert got["row_count"] == 100 and got["read_back"] == 100
    assert got["failures"] == ["scan", "write"]  # both injected failures happened
