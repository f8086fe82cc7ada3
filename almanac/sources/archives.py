"""Tab-separated members of zip archives as a batch source: a partition per archive, read as a stream.

    spark.dataSource.register(ArchiveSource)
    spark.read.format("tsv_archive").schema("ACCESSION_NUMBER string, ...").option("member", "SUBMISSION.tsv").load(folder)

Only the columns of the schema are parsed, by name; those that an archive lacks are null. Archives are opened by the task
that reads them, wherever the session's folders are: a local or shared path, or any address that Arrow's file systems know.
"""

from __future__ import annotations

import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes that are parsed at once, and lines up to which an archive is filled.
BLOCK, LINES = 1 << 20, 250_000


def _opened(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


@dataclass
class Member(InputPartition):
    """One member of one archive."""

    archive: str
    member: str


class ArchiveReader(DataSourceReader):
    def __init__(self, schema, options) -> None:
        self.columns, self.path = [f.name for f in schema.fields], options["path"]
        self.member, self.mode = options["member"], options.get("mode", "DROPMALFORMED").upper()
        if self.mode not in ("DROPMALFORMED", "FAILFAST"):
            raise ValueError(f"mode {self.mode}")
        if any(f.dataType.simpleString() != "string" for f in schema.fields):
            raise ValueError("members hold text: the schema's columns are strings")

    def partitions(self) -> list[Member]:
        """The archives of a folder that have such a member, whatever its letters' case; names are listed, nothing is read."""
        fs, root = _opened(self.path)
        found = fs.get_file_info([root])[0]
        files = [found] if found.is_file else fs.get_file_info(pa.fs.FileSelector(root, recursive=True))
        return [Member(f.path, self.member) for f in sorted(files, key=lambda f: f.path) if f.is_file and f.extension == "zip"]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        fs, _ = _opened(self.path)
        with fs.open_input_file(partition.archive) as file, zipfile.ZipFile(file) as archive:
            for name in archive.namelist():
                if name.rpartition("/")[2].lower() == partition.member.lower():
                    with archive.open(name) as member:
                        yield from self._rows(member)

    def _rows(self, member) -> Iterator[pa.RecordBatch]:
        odd = "error" if self.mode == "FAILFAST" else "skip"
        parse = pa.csv.ParseOptions(delimiter="\t", quote_char=False, invalid_row_handler=lambda row: odd)
        convert = pa.csv.ConvertOptions(column_types={c: pa.string() for c in self.columns}, include_columns=self.columns, include_missing_columns=True, strings_can_be_null=True, null_values=[""])
        head = member.peek(1) if hasattr(member, "peek") else b"x"
        if not head:
            return
        for batch in pa.csv.open_csv(pa.PythonFile(member, mode="r"), pa.csv.ReadOptions(block_size=BLOCK), parse, convert):
            yield pa.RecordBatch.from_arrays([c.cast(pa.string()) for c in batch.columns], self.columns)


class ArchiveSource(DataSource):
    """Options: path, a zip archive or a folder of them; member, the file's name in each; mode, DROPMALFORMED (rows that have
    not as many fields as the header go) or FAILFAST. Empty fields are null. Archives without the member have no rows."""

    @classmethod
    def name(cls) -> str:
        return "tsv_archive"

    def schema(self) -> str:
        raise ValueError("name the columns to read by a schema")

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(schema, self.options)


def archived(spark, path: str, member: str, columns: list[str], mode: str = "DROPMALFORMED") -> DataFrame:
    """The named columns of a member of each archive at path, as strings."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("tsv_archive").schema(", ".join(f"`{c}` string" for c in columns)).option("member", member).option("mode", mode).load(path)


def archive(tables: dict[str, DataFrame], key: str, n: int, path: str) -> int:
    """Write tables of strings into zip archives at path, rows dealt by a hash of ``key``: a member per table in each.

    There are n archives, or as many more as keep them near LINES lines, so that what a task writes, and later reads, doesn't
    grow with the tables. A task writes an archive, its rows as they come by member; path must be one that tasks can write
    to. Gives the number of archives written; those that no row falls to are left out."""
    from pyspark import TaskContext
    from pyspark.sql import functions as F

    heads, lines = [(name, f"{'\t'.join(df.columns)}\n".encode()) for name, df in tables.items()], None
    for k, df in enumerate(tables.values()):
        fields = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "[\t\r\n]", " ") for c in df.columns]
        own = df.select(F.xxhash64(F.col(key).cast("string")).alias("h"), F.lit(k).alias("m"), F.concat_ws("\t", *fields).alias("line"))
        lines = own if lines is None else lines.unionByName(own)
    n = max(n, -(-lines.count() // LINES))

    def write(batches):
        fs, root = _opened(path)
        at, out, sink, member = None, None, None, None
        for batch in batches:
            numbers, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cuts = [0, *(k for k in range(1, len(numbers)) if numbers[k] != numbers[k - 1]), len(numbers)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if out is None:
                    fs.create_dir(root)
                    sink = fs.open_output_stream(f"{root}/part-{TaskContext.get().partitionId():05d}.zip")
                    out = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED)
                if numbers[a] != at:
                    if member is not None:
                        member.close()
                    at = numbers[a]
                    name, head = heads[at]
                    member = out.open(name, "w", force_zip64=True)
                    member.write(head)
                member.write("".join(f"{x}\n" for x in texts[a:b]).encode())
        for x in (member, out, sink):
            if x is not None:
                x.close()
        yield pa.RecordBatch.from_arrays([pa.array([int(out is not None)], pa.int32())], ["n"])

    written = lines.repartition(n, "h").select("m", "line").sortWithinPartitions("m").mapInArrow(write, "n int")
    return written.agg(F.sum("n")).first()[0]
