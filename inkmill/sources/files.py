"""Scans of files: workbooks as cells, packages as parts and text, markers as entries; and a data source of workbooks.

Files are read through Spark's binary scan, so names, sizes and times prune before any content is read. A file that
can't be read gives one row with its error and no cells; it never ends the query.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from inkmill.sources import packages, workbooks

CELLS = "path string, sheet_no int, sheet string, row int, col int, ord int, value string, warning string, error string"


def binary(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)


def _rows_of(path: str, content: bytes, cap: int) -> Iterator[tuple]:
    try:
        cells, warning = workbooks.read_any(content, cap)
    except Exception as e:  # any broken file is a row of its own
        yield path, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:400]
        return
    for n, (k, sheet, row, col, value) in enumerate(cells):
        yield path, k, sheet, row, col, n, value, warning or None, None


def cells(files: DataFrame, cap: int = workbooks.CAP) -> DataFrame:
    """The cells of workbooks, of a frame with path and content."""
    import pandas as pd

    names = [c.split()[0] for c in CELLS.split(", ")]

    def run(frames):
        for f in frames:
            for path, content in zip(f["path"], f["content"], strict=True):
                rows = list(_rows_of(path, bytes(content), cap))
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    return files.select("path", "content").where("content IS NOT NULL").mapInPandas(run, CELLS)


def package_texts(files: DataFrame) -> DataFrame:
    """(path, text, error) of zipped document packages."""
    import pandas as pd

    def run(frames):
        for f in frames:
            out = []
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    out.append((path, packages.package_text(bytes(content)), None))
                except Exception as e:
                    out.append((path, None, f"{type(e).__name__}: {e}"[:400]))
            yield pd.DataFrame(out, columns=["path", "text", "error"])

    return files.select("path", "content").where("content IS NOT NULL").mapInPandas(run, "path string, text string, error string")


def package_parts(files: DataFrame) -> DataFrame:
    """(path, part_no, part_name, compression, content) of zipped packages; broken ones have no rows."""
    import pandas as pd

    def run(frames):
        for f in frames:
            out = []
            for path, content in zip(f["path"], f["content"], strict=True):
                try:
                    out += [(path, *p) for p in packages.parts(bytes(content))]
                except Exception:  # noqa: S112
                    continue
            yield pd.DataFrame(out, columns=["path", "part_no", "part_name", "compression", "content"])

    return files.select("path", "content").where("content IS NOT NULL").mapInPandas(run, "path string, part_no int, part_name string, compression int, content binary")


def refined(texts: DataFrame, title: str, fields: dict, body: str) -> DataFrame:
    """(value): front matter and body of each row as one text, for a text sink. fields: names and columns; null ones are left out."""
    lines = F.array_compact(F.array(*(F.when(c.isNotNull(), F.concat(F.lit(f"{k}: "), c.cast("string"))) for k, c in fields.items())))
    head = F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---\n\n# "), F.col(title), F.lit("\n\n"))
    return texts.select(F.concat(head, F.col(body)).alias("value"))


class WorkbookSource(DataSource):
    """spark.read.format("workbooks").option("path", file or folder): the cells of workbooks, a partition for each file.

    Register it with spark.dataSource.register(WorkbookSource). Folders must be visible to all executors."""

    @classmethod
    def name(cls) -> str:
        return "workbooks"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> DataSourceReader:
        return _WorkbookReader(self.options)


class _WorkbookReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.path, self.cap = options["path"], int(options.get("cap", workbooks.CAP))

    def partitions(self) -> list[InputPartition]:
        from pathlib import Path

        root = Path(self.path)
        files = [root] if root.is_file() else sorted(p for p in root.rglob("*") if p.suffix.lower() in (".xls", ".xlsx"))
        return [InputPartition(str(p)) for p in files]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pathlib import Path

        return _rows_of(partition.value, Path(partition.value).read_bytes(), self.cap)
