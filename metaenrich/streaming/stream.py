"""Enrichment of files as they arrive: a stateless stream whose batches run the batch plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.method import EnrichmentMethod
from ..operators.provenance import Provenance
from ..plans.runner import build, judge
from ..sources.corpus import PATTERN, configure, parse


def enrich_stream(spark: SparkSession, method: EnrichmentMethod, root: str, output: str, checkpoint: str, provenance: Provenance, trigger: dict | None = None) -> StreamingQuery:
    """Starts the stream. Each batch writes output/batch=<id>, so a repeated batch replaces its own records only.

    Records have no event time, hence no watermark and no state.
    """
    configure(spark)
    lines = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", PATTERN).option("lineSep", "\n").text(root)

    def enrich(batch: DataFrame, batch_id: int) -> None:
        extracted = method.extract(method.prepare(parse(batch)).where("ok"))
        inputs = method.inputs(extracted)
        parts = method.map_back(extracted, None if inputs is None else method.lookup(inputs))
        valid = judge(build(parts, provenance, method.field), "builtin").where(F.size("errors") == 0)
        valid.select("value").write.mode("overwrite").text(f"{output.rstrip('/')}/batch={batch_id}")

    return lines.writeStream.foreachBatch(enrich).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
