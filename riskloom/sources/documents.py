"""Raw JSON documents: one object per file, loose in a folder or inside the tar archives of that folder.

The driver has to list every file that Spark's readers open, so millions of small ones belong in archives: it then
lists the archives, and tasks find the documents in them by name.
"""

from __future__ import annotations

import re
import tarfile
from collections.abc import Iterable, Iterator
from fnmatch import translate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of raw document files, and of archives of them.
DOCUMENT_GLOB = "APP*.json"
ARCHIVE_GLOB = "*.{tar,tar.zst}"

# Bytes that a task exchanges with its Python worker at a time, in archives and in documents.
_BATCH, _PORTION = 2 << 20, 1 << 20


def stem_of(file_name):
    """File name without its last extension, the key that pairs both documents of an applicant."""
    return F.regexp_replace(file_name, r"\.[^.]*$", "")


def _alternatives(glob: str) -> list[str]:
    """A glob without braces for each choice that they give."""
    found = re.search(r"\{([^{}]*)\}", glob)
    if not found:
        return [glob.replace("[^", "[!")]
    before, after = glob[: found.start()], glob[found.end() :]
    return [g for choice in found[1].split(",") for g in _alternatives(before + choice + after)]


class _Rest:
    """A file from some place on: bytes that were read already, then what follows them."""

    def __init__(self, held: bytes, file) -> None:
        self.held, self.file = held, file

    def read(self, size: int) -> bytes:
        if not self.held:
            return self.file.read(size)
        found, self.held = self.held[:size], self.held[size:]
        return found


def _is_header(block: bytes) -> bool:
    """Whether a block of an archive is sound and not one of its end."""
    if len(block) < tarfile.BLOCKSIZE or not any(block):
        return False
    try:
        told = tarfile.nti(block[148:156])
    except tarfile.HeaderError:
        return False
    return told == 256 + sum(block) - sum(block[148:156]) or told in tarfile.calc_chksums(block)


def _members(file) -> Iterator[tuple[str, bytes]]:
    """Name and content of the regular files of a tar archive, which is read a portion at a time.

    Headers of plain files are taken apart here, as ``tarfile`` takes several times as long over a small document; it
    reads the rest of an archive from the first other one (a long name, a link, another format).
    """
    held, at, first = b"", 0, True

    def reach(size: int) -> bool:
        """Whether there are so many bytes; they are in ``held`` from ``at`` then."""
        nonlocal held, at
        if len(held) - at < size:
            parts, found = [held[at:]], len(held) - at
            while found < size and (more := file.read(max(_PORTION, size - found))):
                parts.append(more)
                found += len(more)
            held, at = b"".join(parts), 0
        return len(held) >= at + size

    while True:
        reach(tarfile.BLOCKSIZE)
        head = held[at : at + tarfile.BLOCKSIZE]
        sound = _is_header(head)
        if not sound and not first:
            return
        name = head[:100].partition(b"\0")[0]
        if not sound or head[156] not in b"0\0" or head[345] or not name.isascii() or name.endswith(b"/"):
            break
        first, size = False, tarfile.nti(head[124:136])
        begin, end = tarfile.BLOCKSIZE, tarfile.BLOCKSIZE + size
        after = end + -size % tarfile.BLOCKSIZE
        if not reach(after):
            raise tarfile.ReadError("unexpected end of data")
        yield name.decode(), held[at + begin : at + end]
        at += after
    with tarfile.open(fileobj=_Rest(held[at:], file), mode="r|*" if first else "r|") as members:
        for member in members:
            if member.isfile():
                yield member.name, members.extractfile(member).read()


def _archived(
    spark: SparkSession,
    path: str,
    glob: str,
    columns: tuple[str, ...] = ("file_name", "raw"),
    last_name: str | None = None,
    last_stem: str | None = None,
) -> DataFrame:
    """``file_name``, ``path`` or ``raw`` of the documents in a folder's archives, up to the last one wanted."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    if not held.isdigit() or not 0 < int(held) <= _BATCH:  # else all archives of a task would be in memory at once
        spark.conf.set(name, str(_BATCH))
    archives = spark.read.format("binaryFile").option("pathGlobFilter", ARCHIVE_GLOB).load(path)
    wanted, portion = "|".join(translate(g) for g in _alternatives(glob)), _PORTION
    kinds = {"file_name": pa.string(), "path": pa.string(), "raw": pa.binary()}

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fits = re.compile(wanted).match

        def batch_of(found: list[tuple]) -> pa.RecordBatch:
            by_column = zip(*found) if found else [()] * len(columns)
            return pa.RecordBatch.from_arrays(
                [pa.array(values, kinds[c]) for c, values in zip(columns, by_column)], names=list(columns)
            )

        for batch in batches:
            for archive, content in zip(*batch.columns):
                data, place = pa.BufferReader(content.as_buffer()), archive.as_py()
                found, held = [], 0
                for member, raw in _members(pa.CompressedInputStream(data, "zstd") if place.endswith(".zst") else data):
                    name = member.rsplit("/", 1)[-1]
                    beyond = (last_name is not None and name > last_name) or (
                        last_stem is not None and name.rsplit(".", 1)[0] > last_stem
                    )
                    if beyond or not fits(name):
                        continue
                    values = {"file_name": name, "path": f"{place}/{member}", "raw": raw}
                    found.append(tuple(values[c] for c in columns))
                    held += len(raw) if "raw" in columns else len(values["path"])
                    if held > portion:
                        yield batch_of(found)
                        found, held = [], 0
                yield batch_of(found)

    schema = ", ".join(f"{c} {'binary' if c == 'raw' else 'string'}" for c in columns)
    found = archives.select("path", "content").mapInArrow(documents, schema)
    return found.withColumn("raw", F.col("raw").cast("string")) if "raw" in columns else found


def document_files(spark: SparkSession, path: str, glob: str = DOCUMENT_GLOB) -> DataFrame:
    """``file_name, stem, path`` of every document; contents of loose files are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    loose = files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "path")
    found = loose.unionByName(_archived(spark, path, glob, ("file_name", "path")))
    return found.select("file_name", stem_of(F.col("file_name")).alias("stem"), "path")


def _loose(spark: SparkSession, path: str, glob: str) -> DataFrame:
    texts = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    return texts.select("_metadata.file_name", F.col("value").alias("raw"))


def _with_stem(*found: DataFrame) -> DataFrame:
    columns = ["file_name", stem_of(F.col("file_name")).alias("stem"), "raw"]
    return found[0].select(*columns).unionByName(found[1].select(*columns))


def read_documents(spark: SparkSession, path: str, glob: str = DOCUMENT_GLOB) -> DataFrame:
    """``file_name, stem, raw`` with the whole text of each document.

    Small files are packed into splits by ``spark.sql.files.maxPartitionBytes`` and
    ``openCostInBytes``. A folder without a matching document is an error.
    """
    loose = _loose(spark, path, glob)
    # One row is taken and not isEmpty() asked, which would begin every archive.
    if not loose.select("file_name").take(1) and not _archived(spark, path, glob, ("file_name",)).take(1):
        raise FileNotFoundError(f"no raw documents {glob} in {path}")
    return _with_stem(loose, _archived(spark, path, glob))


def read_first_documents(
    spark: SparkSession, path: str, limit: int | None, glob: str = DOCUMENT_GLOB
) -> DataFrame:
    """The first ``limit`` documents by file name; ``None`` or 0 reads all.

    Only the last name that still counts comes to the driver. The filter on it is one on file metadata,
    so later loose files are not opened; of archives only the documents up to it leave a task.
    """
    if not limit:
        return read_documents(spark, path, glob)
    names = document_files(spark, path, glob).select("file_name").orderBy("file_name").limit(limit)
    last = names.agg(F.max("file_name")).first()[0]
    if last is None:
        raise FileNotFoundError(f"no raw documents {glob} in {path}")
    loose = _loose(spark, path, glob).where(F.col("file_name") <= last)
    return _with_stem(loose, _archived(spark, path, glob, last_name=last))


def read_matching_documents(
    spark: SparkSession, path: str, stems: DataFrame, glob: str = DOCUMENT_GLOB
) -> DataFrame:
    """The documents whose stem is in ``stems`` (a limited set, see ``read_first_documents``).

    Loose files whose stem lies beyond the last of them are not opened.
    """
    last = stems.agg(F.max("stem")).first()[0]
    if last is None:
        return spark.createDataFrame([], "file_name string, stem string, raw string")
    loose = _loose(spark, path, glob).where(stem_of(F.col("file_name")) <= last)
    found = _with_stem(loose, _archived(spark, path, glob, last_stem=last))
    return found.join(stems.select("stem"), "stem", "left_semi").select("file_name", "stem", "raw")
