"""The batch job as a stream: each micro-batch of new articles is enriched and upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from palimpsest.plans import enrich
from palimpsest.sinks import tables as sinks


def article_stream(spark: SparkSession, folder: str, schema: str = "article_id string, category string, html string", per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def start(stream: DataFrame, path: str, checkpoint: str, job: enrich.Job, once: bool = True) -> StreamingQuery:
    """Write the stream into a result table. A batch that is delivered again changes nothing, since its articles have
    results already; a failed one is taken up from the checkpoint."""

    def upsert(rows: DataFrame, _: int) -> None:
        spark = rows.sparkSession
        sinks.ensure(spark, path)
        all_of_them = enrich.Job(job.version, job.model, None, job.numbered_lists, job.names, job.rewriter)
        enrich.run(spark, rows, path, all_of_them)

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
