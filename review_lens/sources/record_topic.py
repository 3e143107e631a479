"""A stream over a folder of published messages, by record: where to start, how many at a time.

Spark's own file source takes whole files and always all of them. Here an offset is a place in
the topic's committed batches, a file's number and a record in it, so a stream can begin
at the end and takes no more than a given number of records with a micro-batch, also
within one file. Only batches whose writing was committed (`sinks.topics.publish`) are
seen, each once: what a failed or repeated write leaves behind is never read.

Batches get their place when they are first seen. The order is kept in `journal`, a folder of
the stream's own that lives as long as its checkpoint, with the place planned last, so a
stream that starts again goes on where it was. If the driver dies between planning a
micro-batch and Spark's writing that down, one micro-batch may have more than the given number.
"""

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

COMMITS = "_commits"
NAME = "committed_topic"
#: Records that are read from a file at a time, and bytes.
STEP_ROWS = 512
STEP_BYTES = 1 << 20


class Slice(InputPartition):
    """Records of one file: the first one's number, and how many."""

    def __init__(self, path: str, first: int, count: int):
        super().__init__((path, first, count))


class CommittedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.journal = options["path"].rstrip("/"), options["journal"].rstrip("/")
        self.limit = int(options["limit"]) if options.get("limit") else None
        self.latest = options.get("starting", "earliest") == "latest"
        self.files, self.known, self.place, self.entries = None, set(), None, 0

    def __getstate__(self):
        # Tasks need the folder alone.
        return {"path": self.path}

    def _read(self, path: str) -> dict:
        store, place = fs.FileSystem.from_uri(path)
        with store.open_input_stream(place) as file:
            return json.loads(file.read())

    def _write(self, path: str, said: dict) -> None:
        """A file appears whole or not at all."""
        store, place = fs.FileSystem.from_uri(path)
        folder, name = place.rsplit("/", 1)
        store.create_dir(folder, recursive=True)
        with store.open_output_stream(f"{folder}/.{name}") as file:
            file.write(json.dumps(said).encode())
        store.move(f"{folder}/.{name}", place)

    def _names(self, path: str) -> list[str]:
        store, place = fs.FileSystem.from_uri(path)
        found = store.get_file_info(fs.FileSelector(place, allow_not_found=True))
        return sorted(i.base_name for i in found if not i.base_name.startswith("."))

    def _discover(self) -> None:
        """Give the batches that were committed since the last time their places."""
        if self.files is None:
            self.files = []
            for name in self._names(self.journal):
                if name.startswith("place"):
                    continue
                self._add(self._read(f"{self.journal}/{name}"))
        names = [n for n in self._names(f"{self.path}/{COMMITS}") if n not in self.known]
        if names:
            entry = {"commits": names, "files": []}
            for commit in sorted((self._read(f"{self.path}/{COMMITS}/{n}") for n in names), key=lambda c: (c["run"], c["batch_id"])):
                entry["files"] += commit["files"]
            self._write(f"{self.journal}/{self.entries:010d}", entry)
            self._add(entry)

    def _add(self, entry: dict) -> None:
        self.entries += 1
        self.known.update(entry["commits"])
        self.files += [(file["path"], file["records"]) for file in entry["files"]]

    def initialOffset(self) -> dict:
        self._discover()
        self.place = (len(self.files), 0) if self.latest else (0, 0)
        return {"file": self.place[0], "record": self.place[1]}

    def latestOffset(self) -> dict:
        self._discover()
        if self.place is None:
            planned = [n for n in self._names(self.journal) if n == "place"]
            said = self._read(f"{self.journal}/place") if planned else self.initialOffset()
            self.place = (said["file"], said["record"])
        file, record = self.place
        left = self.limit
        while file < len(self.files) and (left is None or left > 0):
            have = self.files[file][1] - record
            if left is not None and have > left:
                file, record, left = file, record + left, 0
            else:
                file, record, left = file + 1, 0, None if left is None else left - have
        if (file, record) != self.place:
            self.place = (file, record)
            self._write(f"{self.journal}/place", {"file": file, "record": record})
        return {"file": file, "record": record}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self._discover()
        self.place = max(self.place or (0, 0), (end["file"], end["record"]))
        slices = []
        for k in range(start["file"], min(end["file"] + 1, len(self.files))):
            path, records = self.files[k]
            first = start["record"] if k == start["file"] else 0
            stop = end["record"] if k == end["file"] else records
            if stop > first:
                slices.append(Slice(path, first, stop - first))
        return slices

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        path, first, count = partition.value
        store, place = fs.FileSystem.from_uri(f"{self.path}/{path}")
        values = dict(part.split("=", 1) for part in path.split("/") if "=" in part)
        with store.open_input_file(place) as file:
            # Read and sent on in steps: a row group may be as large as the file.
            parquet, at = pq.ParquetFile(file, buffer_size=STEP_BYTES, pre_buffer=False), 0
            for group in range(parquet.num_row_groups):
                rows = parquet.metadata.row_group(group).num_rows
                a, b = max(first, at), min(first + count, at + rows)
                if a < b:
                    place = at
                    for whole in parquet.iter_batches(STEP_ROWS, row_groups=[group], columns=["key", "value"]):
                        skip = max(a - place, 0)
                        batch = whole.slice(skip, max(min(b - place, whole.num_rows) - skip, 0))
                        place += whole.num_rows
                        n = batch.num_rows
                        if n == 0:
                            continue
                        columns = [batch.column(0).cast(pa.string()), batch.column(1).cast(pa.string())]
                        columns += [pa.array([values["run"]] * n), pa.array([int(values["batch_id"])] * n, pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns, ["key", "value", "run", "batch_id"])
                at += rows


class CommittedTopic(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "key STRING, value STRING, run STRING, batch_id BIGINT"

    def streamReader(self, schema) -> CommittedReader:
        return CommittedReader(self.options)


def register(spark) -> None:
    """Make the source known to a session; its code travels with it to the executors."""
    import sys

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(CommittedTopic)
