"""The same fingerprint step over items as they land."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ironsift.operators.dedup import latest_per_key
from ironsift.operators.match import fingerprint
from ironsift.sources.tables import audit_lines
from ironsift.sources.versions import VersionedTable
from ironsift.streaming.key_store import KeyStore, once_per_key


def start_fingerprint(items: DataFrame, catalog: list[str], profiles: dict[str, dict], folder: str, checkpoint: str) -> StreamingQuery:
    """Each content key once, scored as in batch, in a versioned table of the folder (rows). What was seen is kept in a store by hash bucket, not in
    the state of the stream, which has none. Rows without symbols pass unscored."""
    spark = items.sparkSession

    def score(df: DataFrame) -> DataFrame:
        return fingerprint(df.withColumn("symbols", F.coalesce("symbols", F.array().cast("array<string>"))), catalog, profiles)

    step = once_per_key(KeyStore(spark, f"{folder}/seen", "item"), VersionedTable(spark, f"{folder}/rows"), score)
    return items.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def new_to_store(store: str, key: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch step: rows whose key the store doesn't have are appended to its table (rows); a repeat adds nothing."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        once_per_key(KeyStore(spark, f"{store}/seen", key), VersionedTable(spark, f"{store}/rows"))(batch, batch_id)

    return step


def latest_view(view: str, keys: list[str], ts: str, seq: str, compact: int = 20, grace: float = 3600) -> Callable[[DataFrame, int], None]:
    """A foreachBatch step: the latest row of each key of the batch, appended under the batch's id (a repeat replaces it). Each
    compact-th batch folds all so far into one part, so that the cost of a batch follows its rows and not the view's, and collects what no reader
    of the last grace seconds can need."""

    def step(batch: DataFrame, batch_id: int) -> None:
        table = VersionedTable(batch.sparkSession, view)
        base = table.append(latest_per_key(batch, keys, ts, seq), batch_id)
        if batch_id % compact == compact - 1 and base.folded < batch_id:
            table.rewrite(latest_per_key(table.read(base), keys, ts, seq), base, folded=batch_id)
            table.collect_garbage(grace)

    return step


def read_latest(spark: SparkSession, view: str, keys: list[str], ts: str, seq: str) -> DataFrame:
    """The latest row of each key, from one version of the view."""
    return latest_per_key(VersionedTable(spark, view).read(), keys, ts, seq)


def rows_and_rejects(lines: DataFrame, schema: str, rows: str, rejects: str, checkpoint: str) -> tuple[StreamingQuery, StreamingQuery]:
    """Rows of a stream of JSON lines, and a dead letter of the lines that are none; a bad line never stops the stream."""
    start = lambda df, path, name: df.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{checkpoint}/{name}").trigger(availableNow=True).start()
    good, bad = audit_lines(lines, schema)
    return start(good, rows, "rows"), start(bad, rejects, "rejects")


def live_totals(items: DataFrame, source: str) -> DataFrame:
    return items.groupBy(source).agg(F.count("*").alias("n"))
