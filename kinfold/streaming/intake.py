"""Intake of arriving files: records are normalized and matched exactly against a fixed reference as they come."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.entities import prepare
from ..sources.io import ENTITY
from ..sources.scratch import materialize


def arriving(spark: SparkSession, folder: str, files_per_batch: int = 10) -> DataFrame:
    """A stream of entity records from tab-separated files that appear in folder."""
    return spark.readStream.schema(ENTITY).option("sep", "\t").option("header", True).option("maxFilesPerTrigger", files_per_batch).csv(folder)


def match_arriving(stream: DataFrame, reference: DataFrame, out: str, state: str):
    """Starts a query that appends (s, t) of exact-name matches to Parquet, batch by batch, and ends when no file is left. A batch that is
    repeated after a failure overwrites its own folder. The reference is normalized and written once; a batch reads its name and country
    columns, and is broadcast to it where its measured size allows that."""
    left = materialize(prepare(reference).where("name_norm <> ''").select(F.col("entity_id").alias("s"), "name_norm", "country"), "reference")

    def one(batch: DataFrame, number: int) -> None:
        right = prepare(batch).where("name_norm <> ''").select(F.col("entity_id").alias("t"), "name_norm", "country")
        left.join(right, ["country", "name_norm"]).select("s", "t").write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", state).trigger(availableNow=True).start()
