"""Running an enrichment method over a corpus."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.method import EnrichmentMethod
from ..operators.provenance import Provenance, record_column
from ..operators.schema import JsonSchema, record_errors, validate_json
from ..sources.corpus import configure, judge_files, list_files, parse, read_lines
from ..sources.scratch import spread
from ..sources.sink import write_jsonl
from .staged import Stage, WorkDir, run_stages, state_of

log = logging.getLogger("metaenrich")


@dataclass(frozen=True)
class RunOptions:
    """threads and batch_size are accepted for compatibility; the cluster's cores and Spark's iterators decide."""

    input: str
    output: str
    threads: int = 0
    batch_size: int = 5000
    single_file: bool = False
    exact: bool = False  # lines with lone surrogates or numbers beyond the doubles are malformed


@dataclass
class RunStats:
    files_processed: int = 0
    files_failed: int = 0
    records_scanned: int = 0
    lines_malformed: int = 0
    emitted: int = 0
    written: int = 0
    invalid: int = 0
    skipped: dict[str, int] = field(default_factory=dict)

    def report(self) -> str:
        reasons = ", ".join(f"{k} {v}" for k, v in sorted(self.skipped.items())) or "none"
        return f"files {self.files_processed} ({self.files_failed} failed), scanned {self.records_scanned}, emitted {self.emitted}, written {self.written}, invalid {self.invalid}, malformed lines {self.lines_malformed}; skipped: {reasons}"


def build(parts: DataFrame, provenance: Provenance, method_field: str) -> DataFrame:
    """Records (column value) of parts."""
    return parts.select(record_column(provenance, method_field).alias("value"))


def judge(records: DataFrame, validator: JsonSchema | str | None) -> DataFrame:
    """records with errors: by the built-in rules ("builtin"), a compiled schema, or none at all (None)."""
    if validator is None:
        return records.withColumn("errors", F.array().cast("array<string>"))
    if isinstance(validator, JsonSchema):
        return validate_json(records, validator)
    return records.withColumn("errors", record_errors("value"))


def _skipped(extracted: DataFrame) -> dict[str, int]:
    return {r.skip_reason: r["count"] for r in extracted.where("skip_reason is not null").groupBy("skip_reason").count().collect()}


def run(spark: SparkSession, method: EnrichmentMethod, options: RunOptions, provenance: Provenance, validator: JsonSchema | str | None = "builtin", work: WorkDir | None = None, from_scratch: bool = False, only: Stage | None = None) -> RunStats:
    """Reads options.input, writes valid records to options.output and invalid ones to options.output + '.invalid'.

    The corpus is scanned once; a file is unpacked by one task, its lines are dealt to all. What the method reads of it, the classified rows and the judged records are written to
    options.output + '.tmp' and read from there. Counts are aggregations over these tables, not accumulators that a
    repeated task would add to twice. `work` keeps the stages of a lookup method.
    """
    configure(spark)
    scratch = WorkDir(spark, f"{options.output.rstrip('/')}.tmp")
    try:
        prepared = scratch.save(method.prepare(parse(spread(read_lines(spark, options.input)), options.exact)), "prepared")
        files = judge_files(spark, prepared, options.input)
        stats = RunStats(files.count - files.failed, files.failed)
        if files.failed:
            log.warning("unreadable files: %s%s", ", ".join(files.examples), " ..." if files.failed > len(files.examples) else "")
        counts = prepared.agg(F.count_if("ok").alias("ok"), F.count_if(~F.col("ok")).alias("bad")).first()
        stats.records_scanned, stats.lines_malformed = counts.ok, counts.bad
        records = prepared.where("ok")
        if work is None:
            extracted = scratch.save(method.extract(records), "extracted")
            inputs = method.inputs(extracted)
            parts = method.map_back(extracted, None if inputs is None else method.lookup(inputs))
        else:
            parts = run_stages(method, records, work, from_scratch, only, state_of(method, list_files(spark, options.input)))
            if parts is None:
                return stats
            extracted = work.read("extracted")
        stats.skipped = _skipped(extracted)
        judged = scratch.save(judge(build(parts, provenance, method.field), validator), "judged")
        bad = F.size("errors") > 0
        totals = judged.agg(F.count("*").alias("all"), F.count_if(bad).alias("bad")).first()
        stats.emitted, stats.invalid, stats.written = totals["all"], totals.bad, totals["all"] - totals.bad
        write_jsonl(judged.where(~bad), options.output, options.single_file)
        if totals.bad:
            judged.where(bad).write.mode("overwrite").json(f"{options.output.rstrip('/')}.invalid")
        log.info(stats.report())
        return stats
    finally:
        scratch.remove()
