"""Starting streams whose operators keep arbitrary state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SETTINGS = {
    PROVIDER: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Batches write what has changed, not the files of every partition's store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start_stateful(stream: DataFrame, begin: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Run ``begin`` with the state store that keyed state and timers need.

    A query copies the session's settings when it starts and keeps them in its
    checkpoint, so the session is left as it was for other queries.
    """
    conf = stream.sparkSession.conf
    before = {name: conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        conf.set(name, value)
    try:
        return begin()
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)
