"""A Spark data source of kit folders: spark.read.format("kit").load(folder).

A folder of Markdown files and text documents becomes rows (path, page, kind, body); every file is a partition, so files
are read where there is room. The folder is a path or the address of a file system that Arrow knows (file, hdfs, s3, gs).
A file that can't be read is a row of kind error.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SUFFIXES = (".md", ".docx")


def file_system(root: str):  # noqa: ANN201
    """The file system of an address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), os.path.abspath(root))


@dataclass
class KitFile(InputPartition):
    path: str


class KitReader(DataSourceReader):
    def __init__(self, root: str) -> None:
        self.root = root

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        system, folder = file_system(self.root)
        found = [f.path for f in system.get_file_info(fs.FileSelector(folder, recursive=True)) if f.is_file]
        return [KitFile(p) for p in sorted(found) if p.lower().endswith(SUFFIXES)] or [KitFile("")]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, str, str]]:
        from ..functions.tables import _HEADING
        from .readers import docx_blocks

        path = partition.path
        if not path:
            return
        try:
            with file_system(self.root)[0].open_input_file(path) as f:
                data = f.read()
            if path.lower().endswith(".docx"):
                for sheet, _, kind, text, cells in docx_blocks(data):
                    yield path, sheet, kind, text or "\n".join(" | ".join(row) for row in cells)
                return
            text = data.decode("utf-8", "replace")
            cuts = [*_HEADING.finditer(text)]
            if not cuts:
                yield path, 1, "text", text.strip()
            for cut, after in zip(cuts, [*cuts[1:], None], strict=False):
                yield path, int(cut[1]), "text", text[cut.end() : after.start() if after else len(text)].strip()
        except Exception as e:  # noqa: BLE001
            yield path, 0, "error", type(e).__name__


class KitSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "kit"

    def schema(self) -> str:
        return "path string, page int, kind string, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return KitReader(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(KitSource)
