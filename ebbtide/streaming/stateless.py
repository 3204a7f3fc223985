"""An extension: the stateless path over a stream, merged into a keyed table batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ebbtide.plans.decide import cleaned, with_recall, with_risk


def screened(rows: DataFrame) -> DataFrame:
    """Cleaned rows with recall and risk; works on streams and on tables alike."""
    return with_risk(with_recall(cleaned(rows)))


def merge_stream(rows: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run what has arrived through the path and hand each batch to ``merge``.

    A batch may come again after a failure; a merge by key makes that harmless."""
    return screened(rows).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
