"""A record store as a Spark data source: what a write puts there is seen when all of it is, once, or not at all.

Tasks send records in batches to a session of their own, which nothing reads yet.  When all tasks are done the driver
commits: one file, put in place at once, names the sessions of the attempts that count.  A failed or repeated attempt leaves
a session that no commit names.  A write with a batch name replaces what that batch has committed before, so a replayed
micro-batch is there once.  Records that the store doesn't take come back as a table of their own.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Fixed value: records of a request.
REQUEST = 100
#: What is read back for a record that was rejected.
REASON = "_reason"


class Store:
    """Folders of a file system that pyarrow knows, for a service that takes records by requests."""

    def __init__(self, path: str):
        from pyarrow import fs

        self.fs, self.base = fs.FileSystem.from_uri(path)

    def put(self, session: str, number: int, records: list[dict]) -> list[dict]:
        """Takes a request into a session; what isn't a record of a time and a measure is returned with a reason."""
        good, bad = [], []
        for r in records:
            reason = "no time" if r.get("time") is None else "no measure" if not r.get("measures") or all(m["value"] is None for m in r["measures"]) else None
            (bad if reason else good).append(r | {REASON: reason})
        for kind, rows in (("taken", good), ("rejected", bad)):
            if rows:
                self._write(f"sessions/{session}/{kind}-{number}.json", rows)
        return bad

    def commit(self, name: str, sessions: list[str]) -> None:
        """Makes the sessions what the batch ``name`` consists of: written aside, then put in place at once."""
        aside = f"aside/{uuid.uuid4().hex}"
        self._write(aside, sessions)
        self.fs.create_dir(f"{self.base}/commits")
        self.fs.move(f"{self.base}/{aside}", f"{self.base}/commits/{name}.json")

    def drop(self, sessions: list[str]) -> None:
        for s in sessions:
            if self._names(f"sessions/{s}"):
                self.fs.delete_dir(f"{self.base}/sessions/{s}")

    def files(self, kind: str) -> list[str]:
        """Requests of the sessions that commits name."""
        sessions = sorted({s for c in self._names("commits") for s in self.read(f"commits/{c}")})
        return [f"sessions/{s}/{f}" for s in sessions for f in self._names(f"sessions/{s}") if f.startswith(kind)]

    def read(self, name: str) -> list:
        with self.fs.open_input_stream(f"{self.base}/{name}") as f:
            return json.loads(f.read())

    def _names(self, folder: str) -> list[str]:
        from pyarrow import fs

        return sorted(x.base_name for x in self.fs.get_file_info(fs.FileSelector(f"{self.base}/{folder}", allow_not_found=True)))

    def _write(self, name: str, value: list) -> None:
        self.fs.create_dir(f"{self.base}/{name}".rsplit("/", 1)[0])
        with self.fs.open_output_stream(f"{self.base}/{name}") as f:
            f.write(json.dumps(value).encode())


@dataclass
class Sent(WriterCommitMessage):
    session: str
    sent: int
    rejected: int


@dataclass
class Requests(InputPartition):
    names: list[str]


class Records(DataSource):
    """Options: ``path``; ``size`` (records of a request); ``batch`` (name of what a write replaces); for reading ``kind``, taken or
    rejected.  Rows are those of ``sinks.records``: dimensions, measures, time; rejected ones have a ``_reason``, too."""

    @classmethod
    def name(cls) -> str:
        return "record_store"

    def schema(self) -> str:
        pair = "dimensions array<struct<name string, value string>>, measures array<struct<name string, value string, type string>>, time string"
        return pair + (f", {REASON} string" if self.options.get("kind") == "rejected" else "")

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return RecordsWriter(self.options)

    def reader(self, schema) -> DataSourceReader:
        return RecordsReader(self.options, schema)


class RecordsWriter(DataSourceWriter):
    def __init__(self, options):
        self.path, self.size, self.batch = options["path"], int(options.get("size", REQUEST)), options.get("batch") or uuid.uuid4().hex

    def write(self, iterator: Iterator) -> Sent:
        store, session, held, number, sent, rejected = Store(self.path), uuid.uuid4().hex, [], 0, 0, 0
        for row in iterator:
            held.append(row.asDict(recursive=True))
            if len(held) == self.size:
                rejected += len(store.put(session, number, held))
                sent, number, held = sent + len(held), number + 1, []
        if held:
            rejected += len(store.put(session, number, held))
        return Sent(session, sent + len(held) - rejected, rejected)

    def commit(self, messages: list[Sent | None]) -> None:
        Store(self.path).commit(self.batch, [m.session for m in messages if m and m.sent + m.rejected])

    def abort(self, messages: list[Sent | None]) -> None:
        Store(self.path).drop([m.session for m in messages if m])


class RecordsReader(DataSourceReader):
    def __init__(self, options, schema):
        self.options, self.schema = options, schema

    def partitions(self) -> list[InputPartition]:
        names = Store(self.options["path"]).files(self.options.get("kind", "taken"))
        each = int(self.options.get("files", 64))
        return [Requests(names[i : i + each]) for i in range(0, len(names), each)] or [Requests([])]

    def read(self, partition: Requests) -> Iterator[tuple]:
        from pyspark.sql import Row

        store = Store(self.options["path"])
        for name in partition.names:
            for r in store.read(name):
                lists = ([Row(**x) for x in r[c]] if r[c] is not None else None for c in ("dimensions", "measures"))
                yield (*lists, *(r.get(f.name) for f in self.schema.fields[2:]))


def register(spark: SparkSession) -> None:
    """Makes ``record_store`` known to the session."""
    spark.dataSource.register(Records)


def publish(records: DataFrame, path: str, batch: str | None = None, size: int = REQUEST) -> None:
    """Puts records into the store, all of them or none; with a batch name in place of what that batch had."""
    register(records.sparkSession)
    writer = records.write.format("record_store").mode("append").option("path", path).option("size", size)
    (writer.option("batch", batch) if batch else writer).save()


def published(spark: SparkSession, path: str, kind: str = "taken") -> DataFrame:
    """What the store has: records ``taken``, or those ``rejected`` with the reason."""
    register(spark)
    return spark.read.format("record_store").option("path", path).option("kind", kind).load()
