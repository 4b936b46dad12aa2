"""Tables that are joined again and again on one key, stored in common buckets.

All tables of a call have the same number of buckets on the key, sorted by it, so that their joins and groupings on
the key read matching buckets side by side: no row is shuffled, and a join neither sorts nor needs a small side.
Worth its one shuffle a table where several reports join the same tables; the number of buckets fixes the number
of tasks of those joins, so it should follow the larger table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemark.session import shared_dir

BUCKETS = 64


def colocate(tables: dict[str, DataFrame], key: str, buckets: int = BUCKETS) -> dict[str, DataFrame]:
    """The tables, stored in ``buckets`` on ``key`` below the shared folder under catalog names of their own.

    Rows without a key are kept (they share a bucket and never join).
    """
    spark = next(iter(tables.values())).sparkSession
    mark = uuid.uuid4().hex
    out = {}
    for name, df in tables.items():
        place, table = f"{shared_dir(spark)}/tidemark/buckets-{mark}/{name}", f"tidemark_{name}_{mark[:12]}"
        # one task writes one bucket: a file a bucket, not a file a bucket and task
        spread = df.repartition(buckets, key)
        spread.write.format("parquet").option("path", place).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        out[name] = spark.table(table)
    return out
