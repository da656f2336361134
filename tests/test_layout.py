"""Z-order: bits, even files, and reads that skip files by the statistics that Parquet keeps."""

from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from chronolake.operators.layout import clustered, interleaved, quantile_step


def test_steps_and_bits(spark):
    rows = spark.createDataFrame([(None,), (-5,), (0,), (3,), (10,), (99,)], "x bigint")
    steps = rows.select("x", quantile_step(F.col("x"), [0, 3, 10]).alias("s")).collect()
    assert [r.s for r in steps] == [0, 0, 1, 2, 3, 3]
    pairs = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for r in pairs.withColumn("z", interleaved([F.col("a"), F.col("b")], 3)).collect():
        bits = "".join(x + y for x, y in zip(f"{r.a:03b}", f"{r.b:03b}"))
        assert r.z == int(bits, 2)


def test_point_reads_skip_most_files(spark, tmp_path):
    rows = spark.range(200_000).selectExpr(
        "id", "IF(id % 3 = 0, 7, pmod(xxhash64(id), 5000)) AS row_id", "pmod(xxhash64(id, 1), 1000000) AS at", "'x' AS text"
    )  # a third of all rows has one id
    clustered(rows, ("row_id", "at"), 64).write.parquet(str(tmp_path / "z"))
    assert spark.read.parquet(str(tmp_path / "z")).agg(F.count("id"), F.sum("id")).first() == rows.agg(F.count("id"), F.sum("id")).first()
    boxes = []
    for file in Path(tmp_path / "z").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        box = {n: (meta.row_group(0).column(names.index(n)).statistics.min, meta.row_group(0).column(names.index(n)).statistics.max) for n in ("row_id", "at")}
        boxes.append((box, meta.num_rows))
    assert max(n for _, n in boxes) < 6 * 200_000 / 64
    holding = lambda name, low, high: sum(b[name][0] <= high and b[name][1] >= low for b, _ in boxes)
    assert holding("row_id", 2500, 2500) < 0.4 * len(boxes)
    assert holding("at", 500_000, 500_100) < 0.4 * len(boxes)
    both = sum(b["row_id"][0] <= 2500 <= b["row_id"][1] and b["at"][0] <= 500_000 <= b["at"][1] for b, _ in boxes)
    assert both <= 4
    assert clustered(rows.limit(0), ("row_id", "at"), 4).count() == 0


def test_ranges_grow_with_the_rows_so_a_task_sorts_a_bounded_share(spark):
    rows = spark.range(20_000).selectExpr("id", "pmod(xxhash64(id), 5000) AS row_id", "id * 7 AS at", "repeat('x', 40) AS text")
    laid = clustered(rows, ("row_id", "at"), 4, file_bytes=100_000)
    sizes = laid.rdd.glom().map(len).collect()
    assert sum(sizes) == 20_000 and len(sizes) > 4
    assert max(sizes) < 6 * 20_000 / len(sizes)
    small = clustered(rows.limit(10), ("row_id", "at"), 4)
    assert small.rdd.getNumPartitions() <= 4 and small.count() == 10
