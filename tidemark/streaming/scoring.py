"""Continuous scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.scoring import predict
from tidemark.sources.registry import ModelRegistry


def score_stream(
    customers: DataFrame, scorer: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Score new customers into parquet files, each exactly once.

    ``scorer`` maps a table to its scored rows and must be a projection, as scorecards and
    trained models are; the stream then keeps no state. Files on hand are processed in as many
    batches as the source's rate limits ask for, and the query ends.
    """
    return (
        scorer(customers)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def serve_stream(
    customers: DataFrame,
    registry: ModelRegistry,
    output: str,
    checkpoint: str,
    version: str | None = None,
    explain: bool = True,
    scored_at: Column | None = None,
    **options,
) -> StreamingQuery:
    """Score and explain new customers with the serving version, or a named one, of a registry.

    The fitted chain and its leaf table are loaded when the stream starts and serve all its batches; a version that is
    deployed later takes over with the next start from the same checkpoint. Rows are dated by their batch, unless ``scored_at`` says otherwise.
    """
    version, model = registry.load(version)
    leaves = registry.leaves(version) if explain else None
    at = F.current_timestamp() if scored_at is None else scored_at

    def scorer(batch: DataFrame) -> DataFrame:
        return predict(model, batch, version, at, leaves=leaves, explain=explain, **options)

    return score_stream(customers, scorer, output, checkpoint)
