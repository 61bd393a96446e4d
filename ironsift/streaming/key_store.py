"""A store of keys that have been seen, by hash bucket, with a bit filter for each bucket's file.

A batch meets the filters of its own buckets first, and reads only the files that may hold one of its keys. Each file has the keys of one
bucket of one batch; when a bucket has many files they are folded into one. All is kept in versioned tables: a batch that is repeated
replaces itself, and one that died leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ironsift.sources.versions import VersionedTable

BUCKETS = 64
BITS_PER_KEY, HASHES = 12, 4
_FILTER = "bucket int, file string, size long, bits binary"


def _cells(h: np.ndarray, size: int) -> np.ndarray:
    """The places of each hash in a filter of that many bits."""
    h = h.astype(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return ((a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) % np.uint64(size)).astype(np.int64)


def _filter_of(frame: pd.DataFrame) -> pd.DataFrame:
    size = max(64, BITS_PER_KEY * len(frame))
    bits = np.zeros(size, bool)
    bits[_cells(frame["h"].to_numpy().view(np.uint64), size).ravel()] = True
    return pd.DataFrame([(frame["bucket"].iloc[0], frame["file"].iloc[0], size, np.packbits(bits).tobytes())], columns=["bucket", "file", "size", "bits"])


def _may_hold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of a hash and a filter, of which those stay whose filter has the hash."""
    for frame in frames:
        keep = np.zeros(len(frame), bool)
        for _, own in frame.groupby("file"):
            bits = np.unpackbits(np.frombuffer(own["bits"].iloc[0], np.uint8))
            keep[frame.index.get_indexer(own.index)] = bits[_cells(own["h"].to_numpy().view(np.uint64), int(own["size"].iloc[0]))].all(1)
        yield frame.loc[keep, ["file"]].drop_duplicates()


class KeyStore:
    """Keys by bucket. rows: the keys with their batch; filters: a row for each file of rows."""

    def __init__(self, spark: SparkSession, folder: str, key: str, buckets: int = BUCKETS, fold_after: int = 16) -> None:
        self.spark, self.folder, self.key, self.buckets, self.fold_after = spark, folder.rstrip("/"), key, buckets, fold_after
        self.filters = VersionedTable(spark, f"{folder}/filters")

    def _hashed(self, df: DataFrame) -> DataFrame:
        h = F.xxhash64(F.col(self.key))
        return df.withColumns({"h": h, "bucket": F.pmod(h, F.lit(self.buckets)).cast("int")})

    def files_to_read(self, keys: DataFrame, batch: int) -> list[str]:
        """The files of other batches that may hold one of these keys: no more than the store has, names alone."""
        known = self.filters.read(_without(self.filters, batch))
        if known is None:
            return []
        hit = self._hashed(keys.select(self.key).distinct()).select("bucket", "h").join(known, "bucket")
        return sorted(r[0] for r in hit.select("h", "file", "size", "bits").mapInPandas(_may_hold, "file string").distinct().collect())

    def unseen(self, rows: DataFrame, batch: int) -> DataFrame:
        """One row of each key that no other batch has brought."""
        files = self.files_to_read(rows, batch)
        once = rows.filter(F.col(self.key).isNotNull()).dropDuplicates([self.key])
        return once.join(self.spark.read.parquet(*files).select(self.key), self.key, "left_anti") if files else once

    def add(self, keys: DataFrame, batch: int) -> None:
        """The keys of a batch, as a file for each bucket and a filter for each file."""
        folder = f"{self.folder}/keys/batch={batch}-{_salt()}"
        self.filters.append(self._written(keys, folder), batch)
        base = self.filters.manifest()
        if len(base.parts) > self.fold_after:
            self._fold(batch)

    def _written(self, keys: DataFrame, folder: str) -> DataFrame:
        self._hashed(keys.select(self.key)).select("bucket", self.key, "h").repartition(self.buckets, "bucket").write.partitionBy("bucket").parquet(folder)
        rows = self.spark.read.schema(f"`{self.key}` {dict(keys.dtypes)[self.key]}, h long, bucket int").parquet(folder)
        named = rows.select("bucket", F.concat(F.lit(f"{folder}/bucket="), F.col("bucket").cast("string")).alias("file"), "h")
        return named.groupBy("bucket", "file").applyInPandas(_filter_of, _FILTER)

    def _fold(self, batch: int) -> None:
        """All batches before this one as one; a batch that has been folded in can't be repeated any more, as the stream is beyond it."""
        base = self.filters.manifest()
        old = self.filters.read(_without(self.filters, batch))
        files = [r[0] for r in old.select("file").collect()]
        folder = f"{self.folder}/keys/folded-{_salt()}"
        part = self.filters.stage(self._written(self.spark.read.parquet(*files).dropDuplicates([self.key]), folder))
        self.filters.commit([part, *(x for x in base.parts if x.tag == batch)], base, old.schema, folded=batch - 1)


def _salt() -> str:
    import uuid

    return uuid.uuid4().hex


def _without(table: VersionedTable, batch: int):  # noqa: ANN202
    from dataclasses import replace

    base = table.manifest()
    return replace(base, parts=[x for x in base.parts if x.tag != batch])


def once_per_key(store: KeyStore, rows: VersionedTable, score: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame, int], None]:
    """A foreachBatch step: rows whose key is new to the store are scored and appended to a table, then their keys to the store. A batch that is
    repeated, wholly or after it died in between, replaces its own rows and adds none twice."""

    def step(batch: DataFrame, batch_id: int) -> None:
        new = store.unseen(batch, batch_id)
        part = rows.append(score(new) if score else new, batch_id).parts[-1]
        written = rows.spark.read.parquet(f"{rows.folder}/{part.folder}")
        store.add(written.select(store.key), batch_id)

    return step
