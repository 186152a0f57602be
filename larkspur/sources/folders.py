"""S8 and S12 as a data source with planned partitions, O10 as a sink with two phases.

``scan_folders`` reads ``patient/accession/file`` trees. Folders are the unit of planning: names of patients and
accessions are listed once, equality and ``IN`` filters on them are taken before that, so a folder that no row can
come from is never opened, and what is left is dealt to partitions of ``folders`` folders each, which tasks list and read.

``zip_archives`` writes rows (archive, name, content) as one zip file for each archive. Tasks write to a staging folder of
their attempt; only the commit of the whole job moves the archives of successful attempts to their place, each by one rename, and
an abort removes the staging folder. Archives hold their members by name with fixed times, so a rerun writes the same bytes.

Both need the folder to be mounted by driver and executors, or (reading) any file system that Arrow knows by its address.
"""

from __future__ import annotations

import os
import shutil
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

LEVELS = ("patient", "accession")


def _names(system: fs.FileSystem, folder: str, kind: fs.FileType) -> list[tuple[str, int]]:
    return sorted((info.base_name, info.size or 0) for info in system.get_file_info(fs.FileSelector(folder)) if info.type == kind)


@dataclass
class Folders(InputPartition):
    folders: list[tuple[str, str]]


class FolderReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.ending = options["path"], options.get("ending", "").lower()
        self.together, self.with_content = int(options.get("folders", "16")), options.get("content", "false").lower() == "true"
        self.wanted: dict[str, set[str]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is None or len(f.attribute) != 1 or f.attribute[0] not in LEVELS:
                yield f
                continue
            level = f.attribute[0]
            self.wanted[level] = self.wanted.get(level, values) & values

    def _kept(self, level: str, names: list[tuple[str, int]]) -> list[str]:
        return [n for n, _ in names if level not in self.wanted or n in self.wanted[level]]

    def partitions(self) -> list[Folders]:
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        found = []
        for patient in self._kept("patient", _names(system, root, fs.FileType.Directory)):
            found += [(patient, a) for a in self._kept("accession", _names(system, f"{root}/{patient}", fs.FileType.Directory))]
        return [Folders(found[i : i + self.together]) for i in range(0, len(found), self.together)]

    def read(self, partition: Folders | None) -> Iterator[tuple]:
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path else (fs.LocalFileSystem(), self.path)
        for patient, accession in partition.folders if partition else ():  # without partitions, a task still asks
            for name, size in _names(system, f"{root}/{patient}/{accession}", fs.FileType.File):
                if name.lower().endswith(self.ending):
                    path = f"{root}/{patient}/{accession}/{name}"
                    content = None
                    if self.with_content:
                        with system.open_input_stream(path, compression=None) as stream:
                            content = stream.read()
                    yield patient, accession, name, path, size, content


class ScanFolders(DataSource):
    @classmethod
    def name(cls) -> str:
        return "scan_folders"

    def schema(self) -> str:
        return "patient string, accession string, file string, path string, length long, content binary"

    def reader(self, schema: StructType) -> DataSourceReader:
        return FolderReader(self.options)


def scan_folders(spark: SparkSession, path: str, ending: str = "", content: bool = False, folders: int = 16) -> DataFrame:
    """(patient, accession, file, path, length, content) of the files below ``path`` whose name has ``ending``, in any case; content only if asked for."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ScanFolders)
    return spark.read.format("scan_folders").option("ending", ending).option("content", str(content)).option("folders", folders).load(path)


@dataclass
class Staged(WriterCommitMessage):
    archives: list[tuple[str, str]]


class ZipWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.staging = os.path.join(self.path, f".staging-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[Row]) -> Staged:
        own = os.path.join(self.staging, str(TaskContext.get().taskAttemptId()))
        os.makedirs(own, exist_ok=True)
        done: list[tuple[str, str]] = []
        archive, out = None, None
        for row in iterator:  # the rows of an archive come together, by name
            if row.archive != archive:
                if out:
                    out.close()
                archive = row.archive
                place = os.path.join(own, f"{len(done)}.zip")
                done.append((place, f"{archive}.zip"))
                out = zipfile.ZipFile(place, "w", zipfile.ZIP_DEFLATED)
            out.writestr(zipfile.ZipInfo(row.name, (1980, 1, 1, 0, 0, 0)), bytes(row.content or b""), zipfile.ZIP_DEFLATED)
        if out:
            out.close()
        return Staged(done)

    def commit(self, messages: list[Staged | None]) -> None:
        for message in messages:
            for place, name in message.archives if message else ():
                os.replace(place, os.path.join(self.path, name))
        shutil.rmtree(self.staging, ignore_errors=True)

    def abort(self, messages: list[Staged | None]) -> None:
        shutil.rmtree(self.staging, ignore_errors=True)


class ZipArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_archives"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return ZipWriter(self.options)


def write_archives(rows: DataFrame, path: str) -> None:
    """One zip file in ``path`` for each ``archive`` of ``rows`` (archive, name, content), all of them or none. An archive is written by one task; rows without an archive or name are an error."""
    spark = rows.sparkSession
    spark.dataSource.register(ZipArchives)
    named = rows.select(*[F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is missing"))).otherwise(F.col(c)).alias(c) for c in ("archive", "name")], "content")
    named.repartition("archive").sortWithinPartitions("archive", "name").write.format("zip_archives").mode("append").save(path)
