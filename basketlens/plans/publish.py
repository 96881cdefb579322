"""Collections -> masked documents with load lineage -> topics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation

from basketlens.config import MaskingConfig
from basketlens.functions.masking import mask_documents
from basketlens.operators.flatten import with_lineage
from basketlens.operators.quality import counted, rows_seen
from basketlens.session import shuffles_dropped
from basketlens.sinks.messages import to_messages

# Fixed value: the database named in record_source.
DATABASE = "shop_database"


def outgoing(
    documents: DataFrame, collection: str, masking: MaskingConfig, loaded_at: dt.datetime, database: str = DATABASE
) -> DataFrame:
    """The messages of one collection."""
    return to_messages(with_lineage(mask_documents(documents, masking), loaded_at, database, collection))


def publish(
    collections: Mapping[str, DataFrame], topics, masking: MaskingConfig, loaded_at: dt.datetime
) -> dict[str, int]:
    """Send all collections; returns how many documents of each were sent, counted while they were written."""
    sent = {}
    for name, documents in collections.items():
        seen = Observation()
        with shuffles_dropped(documents.sparkSession):
            topics.publish(counted(outgoing(documents, name, masking, loaded_at), seen), name)
        sent[name] = rows_seen(seen)
    return sent
