"""Score feature files as they land: the same narrow scorer on a file stream.

Scoring is row-local (knock-out, caps, lookup, linear model, band), so the batch
plan runs unchanged per micro-batch: a stream-static broadcast join for the
district weights and no state.  The batch-dependent date unit (``auto_units``)
needs a global minimum and is therefore batch-only.  Progress lives in a
checkpoint folder under the session's shared root, so a restarted query (or a
lost executor) resumes without re-scoring committed files.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from scorewright.models.two_card import two_card
from scorewright.operators.score import score_append, source_projection
from scorewright.plans.layout import SOURCE, schema
from scorewright.session import apply_engine_conf, scratch_path
from scorewright.spec import Scorecard


def score_stream(spark: SparkSession, source_dir: str, sink_dir: str, card: Scorecard | None = None,
                 checkpoint: str | None = None, available_now: bool = True,
                 max_files_per_trigger: int = 64) -> StreamingQuery:
    """Parquet feature files under ``source_dir`` -> scored Parquet under ``sink_dir``."""
    apply_engine_conf(spark)
    card = card or two_card()
    features = (spark.readStream.schema(schema(SOURCE)).option("maxFilesPerTrigger", max_files_per_trigger)
                .parquet(source_dir))
    scored = score_append(source_projection(features, card), card)
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint or scratch_path(spark, "stream-checkpoint")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(sink_dir)
