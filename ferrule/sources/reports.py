"""Sectioned report files as a Spark data source (``sectioned_report``).

A report file is text in sections, ``fold_<k> | ...`` over fixed-width rows.  Reading cuts
every file into byte ranges; a range owns the sections whose header line starts in it and
reads on to the end of its last one, line by line, so a large file is read by many tasks
and none holds more than a line.  Writing makes one file per task under a temporary name;
the commit moves them to their place, an aborted job leaves nothing.

    spark.dataSource.register(SectionedReports)
    spark.read.format("sectioned_report").load(uri)
    df.write.format("sectioned_report").mode("append").save(uri)
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

SCHEMA = "file string, fold int, row string, precision double, recall double, f1 double, support double"
SPLIT_BYTES = 32 << 20

_HEADER = re.compile(rb"^fold_(\d+)\s*\|")
_ROW = re.compile(r"^\s*(\S+|macro avg|weighted avg)\s+([0-9.]+)\s+([0-9.]+)\s+([0-9.]+)\s+([0-9.]+)\s*$")
_ACCURACY = re.compile(r"^\s*accuracy\s+([0-9.]+)\s+([0-9.]+)\s*$")


@dataclass
class _Range(InputPartition):
    path: str
    start: int
    end: int

    def __post_init__(self):
        super().__init__(None)


@dataclass
class _Written(WriterCommitMessage):
    name: str | None


def _where(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri)


class _Lines:
    """(offset, line) of a file from an offset on, with a bounded buffer."""

    def __init__(self, stream, at: int):
        self.stream, self.at, self.left = stream, at, b""
        stream.seek(at)

    def __iter__(self):
        while True:
            cut = self.left.find(b"\n")
            if cut < 0:
                more = self.stream.read(1 << 16)
                if more:
                    self.left += more
                    continue
                if self.left:
                    yield self.at, self.left
                return
            line, self.left = self.left[:cut], self.left[cut + 1:]
            yield self.at, line
            self.at += cut + 1


class _Reader(DataSourceReader):
    def __init__(self, uri: str, split: int):
        self.uri, self.split = uri, split

    def partitions(self):
        from pyarrow import fs
        where, path = _where(self.uri)
        info = where.get_file_info(path)
        files = [info] if info.type == fs.FileType.File else [f for f in where.get_file_info(fs.FileSelector(path)) if f.type == fs.FileType.File]
        files = [f for f in files if not f.base_name.startswith(("_", "."))]
        return [_Range(f.path, a, min(f.size, a + self.split)) for f in sorted(files, key=lambda f: f.path) for a in range(0, f.size, self.split)] or [_Range("", 0, 0)]

    def read(self, part: _Range):
        if not part.path:
            return
        where, _ = _where(self.uri)
        fold = None
        with where.open_input_file(part.path) as f:
            first = max(0, part.start - 1)  # whether a line starts at ``start`` shows in the byte before it
            for n, (at, line) in enumerate(_Lines(f, first)):
                if part.start and n == 0:
                    continue
                head = _HEADER.match(line)
                if head:
                    if at >= part.end:
                        return
                    fold = int(head.group(1))
                elif fold is None:
                    if at >= part.end:
                        return
                else:
                    text = line.decode("utf-8", "replace")
                    accuracy = _ACCURACY.match(text)
                    if accuracy:
                        v = float(accuracy.group(1))
                        yield part.path, fold, "accuracy", v, v, v, float(accuracy.group(2))
                    elif row := _ROW.match(text):
                        yield part.path, fold, row.group(1), *(float(row.group(i)) for i in (2, 3, 4, 5))


class _Writer(DataSourceWriter):
    def __init__(self, uri: str, columns: list[str]):
        self.uri, self.columns, self.job = uri, columns, uuid.uuid4().hex

    def write(self, rows):
        """Rows ordered by fold: a header whenever the fold changes."""
        where, folder = _where(self.uri)
        name, out, last = f"{uuid.uuid4().hex}.txt", None, None
        at = {c: self.columns.index(c) for c in ("fold", "row", "precision", "recall", "f1", "support")}
        try:
            for r in rows:
                fold, row, p, rec, f1, n = (r[at[c]] for c in at)
                if out is None:
                    where.create_dir(f"{folder}/_temporary-{self.job}", recursive=True)
                    out = where.open_output_stream(f"{folder}/_temporary-{self.job}/{name}")
                if fold != last:
                    out.write(f"fold_{fold} | scores by class\n".encode())
                    last = fold
                line = f"{row:>14} {'':9} {'':9} {p:9.3f} {n:9.0f}" if row == "accuracy" else f"{row:>14} {p:9.3f} {rec:9.3f} {f1:9.3f} {n:9.0f}"
                out.write(f"{line}\n".encode())
        finally:
            if out is not None:
                out.close()
        return _Written(name if out is not None else None)

    def commit(self, messages):
        where, folder = _where(self.uri)
        where.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None and m.name:
                where.move(f"{folder}/_temporary-{self.job}/{m.name}", f"{folder}/report-{self.job[:8]}-{m.name}")
        self.abort(messages)

    def abort(self, messages):
        from pyarrow import fs
        where, folder = _where(self.uri)
        if where.get_file_info(f"{folder}/_temporary-{self.job}").type == fs.FileType.Directory:
            where.delete_dir(f"{folder}/_temporary-{self.job}")


class SectionedReports(DataSource):
    """Options: ``path`` (a file or folder as URI), ``splitBytes`` (bytes of a reading task)."""

    @classmethod
    def name(cls) -> str:
        return "sectioned_report"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("splitbytes", self.options.get("splitBytes", SPLIT_BYTES))))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("sectioned_report writes into new places or appends")
        return _Writer(self.options["path"], schema.names)


def write_report(report, uri: str) -> None:
    """A report table (fold, row, precision, recall, f1, support) as files: a fold's section is whole,
    folds go to tasks by range."""
    spark = report.sparkSession
    spark.dataSource.register(SectionedReports)
    report.repartitionByRange("fold").sortWithinPartitions("fold", "row").write.format("sectioned_report").mode("append").save(uri)


def read_report(spark, uri: str, split_bytes: int = SPLIT_BYTES):
    spark.dataSource.register(SectionedReports)
    return spark.read.format("sectioned_report").option("splitBytes", split_bytes).load(uri)
