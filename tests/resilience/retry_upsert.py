"""Run by tests/test_resilience.py in its own JVM: master local[4,3] lets a failed task retry.

Injected failures: the first attempt of every task that computes the batch, and the first
attempt of every task of the final write, raise. The merged table must equal the
failure-free result.
"""
import datetime as dt
import json
import sys
import tempfile

sys.path.insert(0, sys.argv[1])

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tickvault import schemas  # noqa: E402
from tickvault.session import get_session  # noqa: E402
from tickvault.sinks import merge  # noqa: E402

spark = get_session("retry", "local[4,3]", {"spark.sql.shuffle.partitions": "4",
                                            "spark.checkpoint.dir": tempfile.mkdtemp()})


@F.pandas_udf("double")
def flaky(price):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return price


def rows(n, price):
    t0 = dt.datetime(2024, 1, 1)
    return [(f"c{i % 5}", t0 + dt.timedelta(hours=i), (t0 + dt.timedelta(hours=i)).date(), i % 24, price + i, 1.0, 2.0)
            for i in range(n)]


path = tempfile.mkdtemp() + "/prices"
first = spark.createDataFrame(rows(200, 1.0), schemas.PRICE_TABLE)
merge.upsert(first, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
second = spark.createDataFrame(rows(300, 100.0), schemas.PRICE_TABLE).repartition(4) \
    .withColumn("price", flaky("price"))
orig_layout = merge._layout
merge._layout = lambda df, parts, key: orig_layout(df, parts, key).withColumn("price", flaky("price"))
merge.upsert(second, path, schemas.PRICE_KEY, schemas.PRICE_TABLE, ["date"])
got = sorted((r.coin_id, str(r.read_timestamp), r.price) for r in spark.read.parquet(path).collect())
want = sorted((c, str(t), p) for c, t, _, _, p, _, _ in rows(300, 100.0))
print(json.dumps({"ok": got == want, "rows": len(got)}))
