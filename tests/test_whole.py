"""Twins on tables of other sizes than the driver's."""

import duckdb
import pytest
from pyspark.sql import functions as F
from twins import same_rows

from loomsift.plans.catalogue import ORACLES, QUERIES

@pytest.mark.parametrize("name", ["eval_scores", "eval_scores_agg"])
@pytest.mark.parametrize("items", [0, 7, 60])
def test_predictions_go_by_the_number_of_items(name, items, spark, sf_dir, tmp_path):
    con = duckdb.connect()
    for table in ("conversations", "labels"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    spark.range(items).select(F.col("id").alias("item_id"), F.repeat(F.lit("x"), F.col("id").cast("int") * 9 + 1).alias("text")).coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/benchmark.parquet/*.parquet'")
    same_rows(QUERIES[name](spark, str(tmp_path)), con, ORACLES[name])
