"""Bulk validation and enrichment of records that arrive as files.

Each micro-batch is an ordinary batch job against static registry and lookup tables; the
lookup table grows by what the batch had to look up.  A repeated batch gives the same
answers and overwrites its own output folder, so a restart after a lost driver is safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from citeweave.operators.enrich import run_summary
from citeweave.plans.jobs import answers_of, bulk_decide, enrich, search
from citeweave.session import materialize
from citeweave.sources.lookup_store import ANSWER_SCHEMA, load_lookup, upsert_lookup
from citeweave.sources.readers import PUBLICATION_SCHEMA, key_doi_rows
from citeweave.sources.writers import write_outcomes, write_run_outputs


def publication_stream(spark: SparkSession, path: str) -> DataFrame:
    """Publications arriving as JSON lines with a key."""
    return spark.readStream.schema("key string, " + PUBLICATION_SCHEMA).json(path)


def validate_stream(
    pubs: DataFrame,
    registry: DataFrame,
    cutoff: Column,
    out: str,
    checkpoint: str,
    answer_path: str | None = None,
) -> DataStreamWriter:
    """Validate every arriving publication; one output folder per batch.

    With an ``answer_path`` searches made in earlier batches are not made again.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = load_lookup(spark, answer_path, ANSWER_SCHEMA) if answer_path else None
        found = materialize(search(batch, registry, "title", answers=known), "searched")
        write_outcomes(bulk_decide(found, cutoff), f"{out}/batch={batch_id}")
        if answer_path:
            upsert_lookup(spark, answer_path, answers_of(found, "title"), ANSWER_SCHEMA)

    return pubs.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def enrich_stream(
    entries: DataFrame, metadata: DataFrame, lookup_path: str, out: str, checkpoint: str
) -> DataStreamWriter:
    """Enrich arriving (key, doi) pairs, looking up only what the lookup table lacks."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = load_lookup(spark, lookup_path)
        now = F.localtimestamp()
        done = enrich(key_doi_rows(batch), known, metadata, now)
        results = materialize(done.results, "results")
        fresh = materialize(done.fresh, "fresh")
        write_run_outputs(results, done.converted, run_summary(results), f"{out}/batch={batch_id}")
        upsert_lookup(spark, lookup_path, fresh)

    return entries.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
