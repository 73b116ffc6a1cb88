"""Zipped and UTF-16 objects: members of zips as records, whole texts."""

from __future__ import annotations

import csv
import io
import struct
import zipfile
from collections.abc import Callable, Iterator, Sequence
from itertools import chain, islice
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reportloom.functions.names import numbered_member
from reportloom.workspace import new_folder, path_exists

# Records and characters that a batch holds, and records that are read together.
_BATCH = 4096
_BATCH_CHARACTERS = 16 * 1024 * 1024
_READ = 128
# Most tasks of one scan; members beyond share them.
MOST_TASKS = 20_000

# The fixed part of a member's own header in a zip: its length, and where it has the
# lengths of name and extra field.
_HEADER = struct.Struct("<26xHH")
_MEMBERS = "member string, at long, packed long, size long, method int, crc long, flags int"


def scan_objects(
    spark: SparkSession, root: str, file_filter: Column | None = None
) -> DataFrame:
    """(path, content) of the objects below ``root``; the filter prunes by ``_metadata``.

    No folder means no objects. Spark reads objects of up to 2 GB; a frame without
    ``content`` reads none.
    """
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string, content binary")
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    )
    if file_filter is not None:
        files = files.filter(file_filter)
    return files.select("path", "content")


def open_object(path: str):
    """The object at ``path``, to be read from any place: a local file, or whatever
    Arrow has a file system for."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        return open(unquote(parts.path) if parts.scheme else path, "rb")  # noqa: SIM115
    system, place = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(place)


def list_members(archives: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The members of the zips at ``path``: name, where they lie, sizes, method, checksum.
    Only the directory at a zip's end is read, by as many tasks as there are zips to list."""
    names = [*carry, "path"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                with open_object(batch.column("path")[i].as_py()) as held, zipfile.ZipFile(held) as archive:
                    found = [m for m in archive.infolist() if not m.is_dir()]
                row = pa.array([i] * len(found), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(n).take(row) for n in names),
                        pa.array([m.filename for m in found], pa.string()),
                        *(
                            pa.array([getattr(m, a) for m in found], kind)
                            for a, kind in (
                                ("header_offset", pa.int64()), ("compress_size", pa.int64()), ("file_size", pa.int64()),
                                ("compress_type", pa.int32()), ("CRC", pa.int64()), ("flag_bits", pa.int32()),
                            )
                        ),
                    ],
                    [*names, "member", "at", "packed", "size", "method", "crc", "flags"],
                )

    schema = "".join(f"`{n}` string, " for n in names) + _MEMBERS
    return archives.select(*names).mapInArrow(run, schema)


def _open_member(held, row: dict):
    """The content of one member, found by its place in the zip; its checksum is verified."""
    if row["flags"] & 1:
        raise ValueError(f"{row['member']} in {row['path']} is encrypted")
    held.seek(row["at"])
    name, extra = _HEADER.unpack(held.read(_HEADER.size))
    held.seek(row["at"] + _HEADER.size + name + extra)
    info = zipfile.ZipInfo(row["member"])
    info.compress_size, info.file_size = row["packed"], row["size"]
    info.compress_type, info.CRC = row["method"], row["crc"]
    return zipfile.ZipExtFile(held, "r", info, None, False)


class _Records:
    """CSV records of members as Arrow batches of bounded size."""

    def __init__(self, encoding: str, errors: str, carry: Sequence[str], named: str | None) -> None:
        self.encoding, self.errors, self.named = encoding, errors, named
        self.schema = pa.schema(
            [
                *((name, pa.string()) for name in (*carry, "path", "member")),
                ("row_no", pa.int64()),
                ("fields", pa.list_(pa.string())),
                *([("named", pa.string())] if named else []),
            ]
        )

    def batches(self, origin: Sequence[str], member: str, stream) -> Iterator[pa.RecordBatch]:
        """The records of one member; the csv module reads many at a time."""
        # A field may be as long as its member.
        csv.field_size_limit(2**31 - 1)
        reader = csv.reader(io.TextIOWrapper(stream, self.encoding, self.errors, newline=""))
        number, held, size, place = 0, [], 0, None
        while True:
            read = list(islice(reader, _READ))
            if self.named and place is None and read:
                if self.named not in read[0]:
                    raise ValueError(f"no column {self.named!r} in {member}")
                place = read[0].index(self.named)
            held += read
            size += sum(map(len, chain.from_iterable(read)))
            if held and (not read or len(held) >= _BATCH or size >= _BATCH_CHARACTERS):
                yield self._batch([*origin, member], number, held, place)
                number, held, size = number + len(held), [], 0
            if not read:
                return

    def _batch(self, origin: list[str], number: int, rows: list[list[str]], place: int | None) -> pa.RecordBatch:
        count = len(rows)
        columns = [pa.array([value] * count, pa.string()) for value in origin]
        columns += [pa.array(range(number, number + count), pa.int64()), pa.array(rows, pa.list_(pa.string()))]
        if place is not None:
            columns.append(pa.array([r[place] if place < len(r) else None for r in rows], pa.string()))
        return pa.RecordBatch.from_arrays(columns, schema=self.schema)


def _from_contents(records: _Records, names: Sequence[str]) -> Callable:
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                origin = [batch[name][i].as_py() for name in names]
                # Read in place: the batch holds the zip once.
                with zipfile.ZipFile(pa.BufferReader(batch["content"][i].as_buffer())) as archive:
                    for info in archive.infolist():
                        if not info.is_dir():
                            with archive.open(info) as stream:
                                yield from records.batches(origin, info.filename, stream)

    return expand


def _from_members(records: _Records, names: Sequence[str]) -> Callable:
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_object(row["path"]) as held, _open_member(held, row) as stream:
                    yield from records.batches([row[n] for n in names], row["member"], stream)

    return expand


def expand_archives(
    archives: DataFrame,
    encoding: str = "utf-8",
    errors: str = "strict",
    carry: Sequence[str] = (),
    named: str | None = None,
) -> DataFrame:
    """CSV records of every member of every zip in ``archives`` (path, and maybe content).

    Line breaks inside quotes stay within their record. Row 0 of a member is its
    header. ``numbered_member`` is the member name with the archive's number.
    Text columns named in ``carry`` go along; ``named`` asks for a column of that name
    with the field below that header, which every member then has to have.

    Without ``content`` the zips are read at their paths: first their directories, then
    each member by a task of its own, from its place in the zip, so one zip of many
    members uses many tasks and a zip of any size can be read. With ``content`` one
    task streams one zip. No more than a batch of records is held.
    """
    names = [*carry, "path"]
    records = _Records(encoding, errors, carry, named)
    if "content" in archives.columns:
        source, expand = archives.select(*names, "content"), _from_contents(records, names)
    else:
        spark = archives.sparkSession
        listed = list_members(archives, carry)
        # Kept: the members are counted, and a task that runs again finds the same ones.
        path = new_folder(spark, "zip-members")
        listed.write.parquet(path)
        members = spark.read.schema(listed.schema).parquet(path)
        tasks = min(max(1, members.count()), MOST_TASKS)
        # Large ones first, so that they do not end up in one task.
        source = members.sort(F.desc("packed")).repartition(tasks)
        expand = _from_members(records, names)
    origin = "".join(f"`{name}` string, " for name in names)
    return source.mapInArrow(
        expand, f"{origin}member string, row_no bigint, fields array<string>" + (", named string" if named else "")
    ).withColumn("numbered_member", numbered_member(F.col("member"), F.col("path")))


def archive_rows(
    records: DataFrame, columns: Sequence[str], strict: bool = False
) -> DataFrame:
    """Data rows under column names: headers dropped, short rows filled with NULL.

    Rows of more fields than ``columns`` end there, or fail with ``strict``.
    """
    others = [c for c in records.columns if c not in ("member", "row_no", "fields")]
    data = records.filter((F.col("row_no") > 0) & (F.size("fields") > 0))
    if strict:
        told = F.concat(F.lit(f"more than {len(columns)} columns in "), F.col("path"))
        data = data.filter(
            F.when(F.size("fields") > len(columns), F.raise_error(told).cast("boolean")).otherwise(True)
        )
    return data.select(
        *(F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(columns)), *others
    )


def transcode_utf16(files: DataFrame) -> DataFrame:
    """(path, content) in UTF-16 to (path, text); the byte order mark is consumed."""
    return files.select("path", F.decode("content", "UTF-16").alias("text"))


def split_lines(texts: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line: key, line_no from 0, line."""
    return texts.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
