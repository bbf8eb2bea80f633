"""Approval gate as a stream: the latest decision per intervention, kept as state.

Decisions arrive as parquet files (intervention_id, decision, decided_at). The stream keeps one
row of state per intervention, the latest decision seen, so any number of files and late or
repeated decisions leave the same gate. State and the files read are in the checkpoint folder:
a restarted stream goes on where it stopped. After each batch the whole gate (one row per
intervention) is written to a folder of its own; the last batch's is the current one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from liftwise.plans.causal import decision_state
from liftwise.session import scratch_path

DECISION_SCHEMA = "intervention_id string, decision string, decided_at long"


def start_gate(spark: SparkSession, source_dir: str, gate_dir: str, checkpoint_dir: str, max_files_per_trigger: int = 64) -> StreamingQuery:
    """Read what decisions there are, update the gate, and stop. Before the first decision the
    gate is empty: closed for every intervention."""
    none = spark.createDataFrame([], "intervention_id string, approved boolean")
    none.write.mode("ignore").parquet(f"{gate_dir}/batch=-1")
    decisions = spark.readStream.schema(DECISION_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir)

    def write(gate: DataFrame, batch: int) -> None:
        gate.write.mode("overwrite").parquet(f"{gate_dir}/batch={batch:012d}")  # a batch tried again writes the same

    stream = decision_state(decisions, "decided_at").writeStream.outputMode("complete").foreachBatch(write)
    return stream.option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()


def current_gate(spark: SparkSession, gate_dir: str) -> DataFrame:
    """(intervention_id, approved) after the last batch."""
    written = spark.read.schema("intervention_id string, approved boolean, batch long").option("basePath", gate_dir).parquet(gate_dir)
    last = written.agg(F.max("batch").alias("batch"))
    return written.join(F.broadcast(last), "batch").select("intervention_id", "approved")  # one row


def run_gate(spark: SparkSession, source_dir: str, gate_dir: str | None = None, checkpoint_dir: str | None = None) -> DataFrame:
    gate_dir = gate_dir or scratch_path(spark, "gate")
    q = start_gate(spark, source_dir, gate_dir, checkpoint_dir or scratch_path(spark, "gate-checkpoint"))
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced to the caller
        raise q.exception()
    return current_gate(spark, gate_dir)
