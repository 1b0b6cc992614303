"""A message log in a folder, as a stream source with positions of its own.

::

    <log>/data/<append>/part-*.parquet   topic, partition, offset, key, value
    <log>/index/<append>.json            one line per file and topic partition: file, first and next offset
    <log>/groups/<group>.json            positions that a group of readers has saved

:func:`append_messages` writes data files as an ordinary Spark job and then makes them
visible by one rename of their index entry, so a reader sees an append whole or not at all.
The ``message_log`` format is a Spark data source: positions are ``{topic: {partition:
next offset}}`` (what Spark keeps in the query's checkpoint), a micro-batch is
one task per data file and topic partition, and rows travel as Arrow batches.

Where a query without a checkpoint starts (T2): at the positions its ``group`` has saved;
else at ``startingPositions`` - ``latest`` (the newest message, the default), ``earliest`` or positions as
JSON. Positions are saved by :func:`save_positions` after a batch's output, and once Spark has committed
it (T4). With ``maxMessagesPerPartition`` (and a ``group``) a batch takes at most that many offsets of a topic
partition. A topic partition that is new since the start is read from its oldest message. A position before
the oldest offset that is left fails the query unless ``failOnDataLoss`` is ``false``.

The index is read by the query's driver process, data files by the tasks, both through
``pyarrow.fs`` (local paths, ``file:``, and the stores it knows by URI).
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from cellar.session import file_system
from cellar.sources._store import open_store

FORMAT = "message_log"
#: The columns of a message.
MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()), T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])
_COLUMNS = [f.name for f in MESSAGE_SCHEMA.fields]

Positions = dict[str, dict[str, int]]


def append_messages(messages: DataFrame, path: str, files: int | None = None) -> None:
    """Append ``topic, partition, offset, key, value`` to the log at ``path``, visible all at once.

    Rows are range-split by (topic, partition, offset) into ``files`` files (the session's
    shuffle width by default); a topic partition that holds most of them spreads over many.
    """
    spark = messages.sparkSession
    fs, root = file_system(spark, path)
    name = uuid.uuid4().hex
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    data, staged = f"{path.rstrip('/')}/data/{name}", f"{path.rstrip('/')}/staged/{name}"
    order = ["topic", "partition", "offset"]
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    messages.select(*_COLUMNS).repartitionByRange(n, *order).sortWithinPartitions(*order).write.parquet(data)
    rows = spark.read.schema(MESSAGE_SCHEMA).parquet(data)
    file = F.regexp_extract(F.col("_metadata.file_path"), "[^/]+$", 0)
    index = rows.groupBy(F.concat(F.lit(f"data/{name}/"), file).alias("file"), "topic", "partition").agg(
        F.min("offset").alias("first"), (F.max("offset") + 1).alias("next"))
    index.coalesce(1).write.mode("overwrite").json(staged)
    fs.mkdirs(jvm_path(f"{path.rstrip('/')}/index"))
    for status in fs.globStatus(jvm_path(f"{staged}/part-*.json")):
        fs.rename(status.getPath(), jvm_path(f"{path.rstrip('/')}/index/{name}.json"))
    fs.delete(jvm_path(staged), True)


def read_message_log(spark: SparkSession, path: str, **options) -> DataFrame:
    """The log at ``path`` as a stream of ``topic, partition, offset, key, value``.

    Options: ``startingPositions``, ``group``, ``maxMessagesPerPartition``, ``failOnDataLoss``.
    """
    spark.dataSource.register(MessageLogSource)
    return spark.readStream.format(FORMAT).options(path=path, **options).load()


class MessageLogSource(DataSource):
    """The ``message_log`` format."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return MESSAGE_SCHEMA

    def streamReader(self, schema: T.StructType) -> "MessageLogReader":
        return MessageLogReader(dict(self.options))


@dataclass
class Segment(InputPartition):
    """Offsets ``first`` to ``next`` of a topic partition in one data file."""

    file: str
    topic: str
    partition: int
    first: int
    next: int


class Log:
    """The files of a log, as far as index entries list them."""

    def __init__(self, path: str):
        self.fs, self.root = open_store(path)
        self._known: dict[str, list[Segment]] = {}

    def at(self, *names: str) -> str:
        return posixpath.join(self.root, *names)

    def segments(self) -> list[Segment]:
        """All listed segments; entries never change, so each is read once."""
        from pyarrow import fs
        listed = self.fs.get_file_info(fs.FileSelector(self.at("index"), allow_not_found=True))
        names = {i.path for i in listed if i.path.endswith(".json")}
        for name in names - self._known.keys():
            self._known[name] = [Segment(**json.loads(line)) for line in self._text(name).splitlines() if line]
        return [s for name in sorted(names) for s in self._known[name]]

    def _text(self, name: str) -> str:
        with self.fs.open_input_stream(name) as f:
            return f.read().decode("utf-8")

    def positions(self, name: str) -> Positions | None:
        """The positions saved under a name."""
        from pyarrow import fs
        file = self.at("groups", f"{name}.json")
        return None if self.fs.get_file_info(file).type == fs.FileType.NotFound else json.loads(self._text(file))

    def save(self, name: str, positions: Positions) -> None:
        """Move the positions saved under a name forward (none goes back), by one rename."""
        held = self.positions(name) or {}
        for topic, parts in positions.items():
            for part, at in parts.items():
                mine = held.setdefault(topic, {})
                mine[part] = max(int(at), mine.get(part, int(at)))
        file = self.at("groups", f"{name}.json")
        fresh = f"{file}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.at("groups"))
        with self.fs.open_output_stream(fresh) as f:
            f.write(json.dumps(held).encode("utf-8"))
        self.fs.move(fresh, file)


def save_positions(path: str, group: str) -> Callable[[DataFrame], None]:
    """T4: a function that saves a processed batch's positions for ``group`` (one row per topic partition)."""
    def save(batch: DataFrame) -> None:
        found: Positions = {}
        for r in batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next")).collect():
            found.setdefault(r["topic"], {})[str(r["partition"])] = r["next"]
        if found:
            Log(path).save(group, found)
    return save


def _ends(segments: list[Segment], least: bool = False) -> Positions:
    """The next offset of each topic partition, or the oldest one."""
    out: Positions = {}
    for s in segments:
        parts, key = out.setdefault(s.topic, {}), str(s.partition)
        value = s.first if least else s.next
        parts[key] = value if key not in parts else (min if least else max)(parts[key], value)
    return out


class MessageLogReader(DataSourceStreamReader):
    """Positions and tasks of one query; lives in the query's driver process."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.group = options.get("group")
        self.starting = options.get("startingpositions") or options.get("startingPositions") or "latest"
        most = options.get("maxmessagesperpartition") or options.get("maxMessagesPerPartition")
        self.most = int(most) if most else None
        loss = options.get("failondataloss") or options.get("failOnDataLoss") or "true"
        self.fail_on_loss = loss.lower() != "false"
        if self.most and not self.group:
            raise ValueError("maxMessagesPerPartition needs a group: it tells a restarted query how far it had come")
        self._log: Log | None = None
        self._reached: Positions | None = None

    @property
    def log(self) -> Log:
        if self._log is None:
            self._log = Log(self.path)
        return self._log

    def _start(self, segments: list[Segment]) -> Positions:
        saved = self.log.positions(self.group) if self.group else None
        if saved is not None:
            return saved
        if self.starting in ("latest", "earliest"):
            return _ends(segments, least=self.starting == "earliest")
        return {t: {str(p): int(n) for p, n in parts.items()} for t, parts in json.loads(self.starting).items()}

    def initialOffset(self) -> dict:
        return self._start(self.log.segments())

    def latestOffset(self) -> dict:
        segments = self.log.segments()
        end = _ends(segments)
        if self.most:
            # positions planned last, also by the run before a restart: never behind the checkpoint
            reached = self._reached or self.log.positions(f"{self.group}.planned") or self._start(segments)
            oldest = _ends(segments, least=True)
            for topic, parts in end.items():
                for part, until in parts.items():
                    at = reached.get(topic, {}).get(part, oldest[topic][part])
                    parts[part] = max(at, min(until, at + self.most))
        return end

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        if self.most:
            self._reached = end
            self.log.save(f"{self.group}.planned", end)
        segments = self.log.segments()
        oldest = _ends(segments, least=True)
        wanted = []
        for s in segments:
            at = start.get(s.topic, {}).get(str(s.partition), s.first)
            until = end.get(s.topic, {}).get(str(s.partition), at)
            if max(at, s.first) < min(until, s.next):
                wanted.append(Segment(s.file, s.topic, s.partition, max(at, s.first), min(until, s.next)))
        if self.fail_on_loss:
            lost = [(t, p, at) for t, parts in start.items() for p, at in parts.items()
                    if at < oldest.get(t, {}).get(p, at) and end.get(t, {}).get(p, at) > at]
            if lost:
                raise ValueError(f"messages before the oldest offset are gone (failOnDataLoss): {lost}")
        return wanted

    def read(self, partition: Segment) -> Iterator:
        import pyarrow as pa
        import pyarrow.dataset as ds
        log = Log(self.path)
        table = ds.dataset(log.at(partition.file), filesystem=log.fs, format="parquet")
        offset = ds.field("offset")
        mine = ((ds.field("topic") == partition.topic) & (ds.field("partition") == partition.partition)
                & (offset >= partition.first) & (offset < partition.next))
        kinds = {"topic": pa.string(), "partition": pa.int32(), "offset": pa.int64(), "key": pa.string(), "value": pa.string()}
        schema = pa.schema(list(kinds.items()))
        for batch in table.to_batches(columns=_COLUMNS, filter=mine):
            if batch.num_rows:
                yield batch.cast(schema)

    def commit(self, end: dict) -> None:
        if self.group:
            self.log.save(self.group, end)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_log": None}  # tasks open the log themselves


__all__ = ["MESSAGE_SCHEMA", "FORMAT", "append_messages", "read_message_log", "save_positions", "MessageLogSource", "MessageLogReader", "Log"]
