"""Compare queries with their oracles: run_oracle.py <sf_dir> [query ...]"""

import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tests.compare import connect, difference  # noqa: E402

if __name__ == "__main__":
    sf_dir, *names = sys.argv[1:]
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp()).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf_dir), oracle_sql(), []
    for name, function in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            result = difference(function(spark, sf_dir), con, sqls[name])
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{time.time() - start:6.2f} {name}: {result or 'equal'}", flush=True)
        failed += [name] if result else []
    print("failed:", failed)
