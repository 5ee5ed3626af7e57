"""The archive job: every message of the log into its collection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorstream.functions.codec import decode
from sensorstream.operators.routing import collection_of
from sensorstream.sources.collections import (
    DOCUMENT,
    FOLDERS,
    QUARANTINE,
    create_folders,
    register_batch,
)
from sensorstream.streaming.groups import Group
from sensorstream.streaming.runner import start_batches
from sensorstream.streaming.sinks import batch_store


def documents(messages: DataFrame) -> DataFrame:
    """Messages as documents with their collection.

    A document keeps the whole message text, whatever fields it has, beside the fields of a
    reading; one of a wrong type is null and spoils no other. What is no JSON object, or
    comes from a topic without a collection, goes to the quarantine collection.
    """
    is_object = F.json_object_keys("raw").isNotNull()
    collection = F.coalesce(F.when(is_object, collection_of(F.col("topic"))), F.lit(QUARANTINE))
    placed = decode(messages).withColumn("collection", collection).withColumn("day", F.to_date("event_time"))
    return placed.select(*DOCUMENT.names, *FOLDERS)


def start_archive(
    messages: DataFrame,
    store: str,
    *,
    checkpoint: str,
    name: str = "archive",
    every: str | None = None,
    files_per_batch: int | None = None,
    database: str | None = None,
    group: Group | None = None,
) -> StreamingQuery:
    """Run the archive on a stream: one pass and one write for all collections.

    ``files_per_batch`` bounds the files of a batch in each folder; ``database`` names the declared
    tables (``create_collections``) in which each batch is to be seen as soon as it is written. With a ``group`` a
    new checkpoint goes on where the group stopped: nothing is stored twice, and nothing is left out.
    """
    create_folders(messages.sparkSession, store)
    store_batch = batch_store(store, FOLDERS, files_per_batch)

    def write_documents(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id)
        if database is not None:
            register_batch(batch.sparkSession, store, batch_id, database)

    stream = documents(messages)
    if group is not None:
        run = group.join(messages.sparkSession, checkpoint, store, FOLDERS)
        stream = run.unread(messages)
        write = run.committing(lambda batch, batch_id: write_documents(documents(batch), batch_id))
    else:
        write = write_documents
    return start_batches(
        stream,
        write,
        name=name,
        checkpoint=checkpoint,
        every=every,
    )
