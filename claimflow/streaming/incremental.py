"""Incremental bronze ingestion with Structured Streaming.

Cleaning and the drop rules are stateless projections and filters, so the
same operators that build a bronze table in batch also run on a stream of
newly arriving raw files. Each micro-batch writes the kept rows to the table
and its per-rule counts to a metrics table; progress lives in a checkpoint in
the shared folder, so a restarted query (or a lost executor) resumes where it
stopped without duplicating output: every micro-batch overwrites its own
``batch_id=<n>`` directory, so a batch replayed after a failure replaces
rather than appends. With ``quarantine`` the same write keeps the rows that failed
a drop rule, apart from the others (``row_state=failed``) and with the rules' names;
:func:`read_rows` reads either side, the other's directories pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.clean import CLEANERS
from ..operators.expectations import (FAILED, FAILED_RULES, KEPT, RULES, STATE, apply_rules, observe_rules,
                                      observed_metrics, split_by_rules)
from ..sources.io import lean_writes

METRICS_SCHEMA = "dataset string, rule string, action string, passed long, failed long"


def read_raw_stream(spark: SparkSession, path: str, schema: StructType,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.load(path)
    return df.select(*[f.name for f in schema.fields])


def bronze_stream(raw: DataFrame, table: str, run_ts: str | None = None) -> DataFrame:
    """Cleaned rows of a streaming raw table (before the drop rules)."""
    return CLEANERS[table](raw, run_ts)


def read_rows(spark: SparkSession, out_path: str, failed: bool = False) -> DataFrame:
    """The kept rows of all micro-batches of a stream with quarantine, or the failed ones with ``failed_rules``."""
    rows = spark.read.parquet(out_path).where(F.col(STATE) == (FAILED if failed else KEPT)).drop(STATE)
    return rows if failed else rows.drop(FAILED_RULES)


def start_incremental(spark: SparkSession, table: str, source_path: str, schema: StructType,
                      out_path: str, metrics_path: str, checkpoint: str,
                      run_ts: str | None = None, available_now: bool = True,
                      max_files_per_trigger: int | None = None, quarantine: bool = False):
    """Start the stream; returns the ``StreamingQuery``.

    ``available_now`` processes everything present and stops (a triggered
    pipeline); otherwise the query keeps running on a 1-minute trigger.
    """
    rules = RULES[table]
    raw = read_raw_stream(spark, source_path, schema, max_files_per_trigger)
    cleaned = bronze_stream(raw, table, run_ts)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one pass: the rule counts are observed by the write of the kept rows,
        # so the micro-batch is neither cached nor scanned twice
        observed, obs = observe_rules(batch, rules, f"{table}_{batch_id}")
        path = f"{out_path}/batch_id={batch_id}"
        rows = split_by_rules(observed, rules) if quarantine else apply_rules(observed, rules)
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        with lean_writes(batch.sparkSession):
            (writer.partitionBy(STATE) if quarantine else writer).parquet(path)
        rows = observed_metrics(obs.get, rules, table)
        batch.sparkSession.createDataFrame(rows, METRICS_SCHEMA).write.mode("overwrite") \
            .parquet(f"{metrics_path}/batch_id={batch_id}")

    writer = (cleaned.writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint)
              .queryName(f"bronze_{table}"))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    return writer.start()
