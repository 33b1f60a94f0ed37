"""The nightly increments as streams: what they have seen is state by key, so a micro-batch reads and writes the keys that it names.

The state is the table: it begins with an initial one, never expires, and `state_table` reads it from the checkpoint. A micro-batch that is run again
finds the state as it was before it. State lies in RocksDB, beside the checkpoint, so it needs not fit in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerwatch.operators.registry import GROUPS

from .incremental import STORE, labelled

PERSON = "surname string, first_name string, start_date date"
PERSONS = f"array<struct<{PERSON.replace(' ', ':').replace(',:', ',')}>>"
SNAPSHOT = f"register_id string, at bigint, ok boolean, persons {PERSONS}"
STORED = [field.split()[0] for field in STORE.split(", ")]
ACCREDITED = f"register_id string, {PERSON}, at bigint"


#: Session settings for state of this kind: stores that are closed with their task, share a bound of memory for each executor, and
#: don't reserve disk, as there is one for each partition and many are small.
SETTINGS = {
    "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "unloadOnCommit": "true",
    "rocksdb.boundedMemoryUsage": "true",
    "rocksdb.maxMemoryUsageMB": "256",
    "rocksdb.allowFAllocate": "false",
}


def use_rocksdb(spark: SparkSession) -> None:
    for name, value in SETTINGS.items():
        spark.conf.set(f"spark.sql.streaming.stateStore.{name}", value)


def appended(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs the stream over all that has arrived, and gives all rows that it has appended so far, those of earlier runs too."""
    stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def state_table(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """The rows that a stream's state holds after its last micro-batch."""
    return spark.read.format("statestore").option("stateVarName", name).load(checkpoint).select("value.*")


class FirstSight(StatefulProcessor):
    """Keeps and gives the first row of each id; `registrants` holds it."""

    def __init__(self, order: str):
        self.order = order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("registrants", STORE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.stored.exists():
            first = min(rows, key=lambda r: r[self.order])
            out = tuple(first[c] for c in STORED)
            self.stored.update(out)
            yield Row(*STORED)(*out)

    def handleInitialState(self, key, row, timerValues) -> None:
        self.stored.update(tuple(row))

    def close(self) -> None:
        pass


def ingest_registrants(stream: DataFrame, keywords: list[str], detected_at: str, stored: DataFrame | None = None, order: str = "_ord") -> DataFrame:
    """The stream of new registrants, as rows of the store: ids not stored yet whose name or objectives match, the first of an id.

    Feed items that don't match are not remembered, so they are tested again when they come again. `stored` are rows of a store to
    begin with. Rows of one id meet in one task; of each batch that is sent there only the first goes.
    """
    use_rocksdb(stream.sparkSession)
    matched = labelled(stream.filter(F.col("id").isNotNull()), keywords).filter(F.col("match").isNotNull())
    rows = matched.select("id", "name", "registrationDate", "match", F.lit(detected_at).alias("detected_at"), F.col(order).cast("long").alias("_first"))

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values("_first", kind="stable").drop_duplicates("id")

    initial = stored.select(*STORED).groupBy("id") if stored is not None else None
    return rows.mapInPandas(first, f"{STORE}, _first bigint").groupBy("id").transformWithState(FirstSight("_first"), STORE, "Append", "None", initialState=initial)


def person(p: Row | dict) -> tuple:
    return p["surname"], p["first_name"], p["start_date"]


class Watch(StatefulProcessor):
    """Compares each good snapshot of an organisation with the one before; `baseline` and `reported` hold what it compares with."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.baseline = handle.getValueState("baseline", f"register_id string, persons {PERSONS}")
        self.reported = handle.getMapState("reported", PERSON, "register_id string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in sorted(rows, key=lambda r: r["at"]):
            if not row["ok"]:
                continue
            persons = list(dict.fromkeys(person(p) for p in row["persons"] or []))
            if self.baseline.exists():
                known = {person(p) for p in self.baseline.get()[1]}
                for p in persons:
                    if p not in known and not self.reported.containsKey(p):
                        self.reported.updateValue(p, (key[0],))
                        yield Row("register_id", "surname", "first_name", "start_date", "at")(key[0], *p, row["at"])
            self.baseline.update((key[0], persons))

    def handleInitialState(self, key, row, timerValues) -> None:
        if row["persons"] is not None:
            self.baseline.update((key[0], [person(p) for p in row["persons"]]))
        for p in row["reported"] or []:
            self.reported.updateValue(person(p), (key[0],))

    def close(self) -> None:
        pass


def watch_accreditations(snapshots: DataFrame, begun: DataFrame | None = None) -> DataFrame:
    """The stream of new accreditations: persons of a snapshot who are neither in the organisation's last good one nor reported before.

    snapshots: a row for each fetch of an organisation (SNAPSHOT), in the order of `at`. The first good one, which may be empty, only
    sets the baseline; a failed fetch leaves it. begun: register_id, persons (null without a baseline), reported.
    """
    use_rocksdb(snapshots.sparkSession)
    fetched = snapshots.filter(F.col("register_id").isNotNull()).select("register_id", "at", "ok", "persons")
    initial = begun.select("register_id", "persons", "reported").groupBy("register_id") if begun is not None else None
    return fetched.groupBy("register_id").transformWithState(Watch(), ACCREDITED, "Append", "None", initialState=initial)


class Live(StatefulProcessor):
    """Merges updates into the live row of a key, by column groups; `live` holds it."""

    def __init__(self, schema: T.StructType, key: str, groups: dict[str, list[str]], keep: dict[str, bool], order: str | None):
        self.schema, self.key, self.groups, self.keep, self.order = schema, key, groups, keep, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.live = handle.getValueState("live", self.schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        names = self.schema.names
        now = dict(zip(names, self.live.get(), strict=True)) if self.live.exists() else dict.fromkeys(names) | {self.key: key[0]}
        for row in sorted(rows, key=lambda r: r[self.order]) if self.order else rows:
            for group, columns in self.groups.items():
                error = row[f"{group}_error"]
                for c in columns:
                    if error is None:
                        now[c] = row[c]
                    elif not self.keep.get(group, False):
                        now[c] = None
                now[f"{group}_error"] = error
        self.live.update(tuple(now[c] for c in names))
        yield Row(*names)(*(now[c] for c in names))

    def handleInitialState(self, key, row, timerValues) -> None:
        self.live.update(tuple(row))

    def close(self) -> None:
        pass


def upsert_live(updates: DataFrame, current: DataFrame, key: str, groups: dict[str, list[str]], keep_on_error: dict[str, bool] | None = None, order: str | None = None) -> DataFrame:
    """The stream of live rows that changed, each as a whole, by the rules of merge_live; `current` is the table to begin with.

    Of a group, the last writer by `order` wins. Groups that the updates don't have, and keys that they don't name, stay as they are.
    """
    use_rocksdb(updates.sparkSession)
    own = {g: columns for g, columns in groups.items() if f"{g}_error" in updates.columns}
    processor = Live(current.schema, key, own, keep_on_error or GROUPS, order)
    return updates.filter(F.col(key).isNotNull()).groupBy(key).transformWithState(processor, current.schema, "Append", "None", initialState=current.groupBy(key))
