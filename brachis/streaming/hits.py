"""The stateless hit operators over a stream of hits.

Filtering, thresholds and lineages are expressions and joins with static tables, so they run on ``readStream`` as they do on
a table; competitive resolution needs all of a protein's hits and stays a batch operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.hits import filter_hits
from ..operators.taxonomy import with_lineage
from ..schemas import HITS


def read_hit_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(HITS).parquet(path)


def enriched(stream: DataFrame, thresholds: DataFrame | None = None, taxonomy: DataFrame | None = None, **limits: float) -> DataFrame:
    """Hits that meet their limits, with lineage if given; ``thresholds`` and ``taxonomy`` are static."""
    rows = filter_hits(stream, thresholds, **limits)
    return rows if taxonomy is None else with_lineage(rows, taxonomy)


def write_hit_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet until what is there has been read; a restart goes on where the last run ended."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
