"""Text staging: exact round trips, splittable files, files bounded by bytes."""

import random

import pytest
from pyspark.sql import functions as F

from logweir.sinks.staging import escaped, read_staged, stage, unescaped

ODD = ["", " ", "\0", "\\", "\\n", "\\m", "\\\\n", "a\nb", "a\r\nb", '"', '""', ",", '\n"\n', "\\0", "null", "é\u2028x", "\t", " x ", None]


@pytest.mark.parametrize("staging_format", ["CSV", "CSV GZIP", "JSON", "JSON GZIP"])
def test_odd_texts_come_back(spark, folder, staging_format):
    pick = random.Random(8)
    texts = ODD + ["".join(pick.choices('\\nrm0\0\n\r",a ', k=pick.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, `a.b` string").repartition(3)
    stage(df, f"{folder}/t", staging_format)
    back = read_staged(spark, f"{folder}/t", df.schema, staging_format)
    assert sorted(map(tuple, back.collect())) == list(enumerate(texts))


def test_escapes_have_no_line_breaks_and_undo(texts):
    row = texts(*ODD).select("value", escaped(F.col("value")).alias("cell"))
    for value, cell, back in row.withColumn("back", unescaped(F.col("cell"))).collect():
        assert back == value and not set(cell or "") & set("\n\r\0")


def test_a_plain_file_is_read_by_many_tasks(spark, folder):
    df = spark.range(20_000, numPartitions=1).select("id", F.concat(F.lit("line\n"), F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    stage(df, f"{folder}/t", "CSV")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        back = read_staged(spark, f"{folder}/t", df.schema, "CSV")
        files, tasks = len(back.inputFiles()), back.rdd.getNumPartitions()
        assert files == 1 and tasks >= 5
        assert back.exceptAll(df).count() == 0 and back.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gzip_files_are_bounded_by_bytes(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        files = {}
        for width in (1, 40, 160):
            text = F.concat(*[F.sha2(F.concat("id", F.lit(i)), 256) for i in range(width)])
            df = spark.range(2000, numPartitions=32).select("id", text.alias("text"))
            stage(df, f"{folder}/t{width}", "JSON GZIP")
            sizes = spark.read.json(f"{folder}/t{width}").select("_metadata.file_path", "_metadata.file_size").distinct().collect()
            files[width] = [r.file_size for r in sizes]
        assert len(files[1]) == 1 < len(files[40]) < len(files[160])
        assert max(max(sizes) for sizes in files.values()) < 3 * 300_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
