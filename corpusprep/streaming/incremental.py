"""Documents that arrive as files, chunked as they come: the batch transforms under a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.chunking import ChunkConfig, semantic_chunks


def chunk_stream(spark: SparkSession, source: str, schema: str, checkpoint: str, write: Callable[[DataFrame, int], None], config: ChunkConfig = ChunkConfig(), **trigger: object) -> StreamingQuery:
    """Chunk each new Parquet file of ``source`` once; ``write`` gets the chunks and the batch's number, and should be idempotent in it."""
    docs = spark.readStream.schema(schema).parquet(source)

    def each(batch: DataFrame, number: int) -> None:
        write(semantic_chunks(batch, config), number)

    return docs.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
