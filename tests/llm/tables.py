"""Reading of the given tables for the tests of this folder."""


def documents(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")


def pages(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")


def benchmark(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/benchmark.parquet")
