"""Raw page files, as a crawler leaves them, to pages and rejects: S2.

Pages are a file each, dealt to one folder per task that writes them, so a listing asks for few
folders. Files are written through ``pyarrow.fs``, so the folder must be one it reaches. They
are read by Spark's binary source, so any store that Spark reads will do, and each is
decoded by the character set that it states: a byte order mark, else a ``meta`` element in its
first kilobyte, else UTF-8. What is not valid in its character set is a reject with a reason,
never text with signs replaced.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOOKED_AT = 1024
DECODED_BYTES = 1 << 20
_MARKS = ((codecs.BOM_UTF8, "utf-8"), (codecs.BOM_UTF16_LE, "utf-16-le"), (codecs.BOM_UTF16_BE, "utf-16-be"))
_META = re.compile(rb"""<meta\b[^>]*?\bcharset\s*=\s*["']?\s*([\w.:-]+)""", re.I)
# fixed values: names under which pages mean the Windows code page
_WINDOWS = {"ascii", "us-ascii", "iso-8859-1", "latin-1", "latin1", "iso8859-1"}


def charset_of(content: bytes) -> tuple[str, int]:
    """The character set that a page states, and the length of its byte order mark."""
    for mark, name in _MARKS:
        if content.startswith(mark):
            return name, len(mark)
    stated = _META.search(content[:_LOOKED_AT])
    name = stated[1].decode("ascii", "replace").lower() if stated else "utf-8"
    return "cp1252" if name in _WINDOWS else name, 0


def decode_page(content: bytes | None) -> tuple[str | None, str | None, str | None]:
    """(html, charset, problem): either a text or a problem."""
    if content is None:
        return None, None, "no content"
    name, start = charset_of(content)
    try:
        return content[start:].decode(name), name, None
    except LookupError:
        return None, name, "unknown character set"
    except (UnicodeError, ValueError) as wrong:
        at = getattr(wrong, "start", None)
        return None, name, "not text in its character set" + ("" if at is None else f", byte {at + start}")


def _located(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder as Spark names it, and its path there."""
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"\As3[an]:", "s3:", uri))


def write_page_files(pages: DataFrame, folder: str, key: str, content: str) -> None:
    """One file ``<key>=K.txt`` for every whole number ``key``; each content ends with a line break.

    Rows that share a key, or have none (``<key>=None.txt``), stand in one file. A task that
    runs again writes the same files again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _located(folder)
        home = f"{root}/task={TaskContext.get().partitionId():05d}"
        system.create_dir(home)
        file, last, written = None, None, 0
        for batch in batches:
            for of, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if file is None or of != last:
                    if file is not None:
                        file.close()
                    file, last, written = system.open_output_stream(f"{home}/{key}={of}.txt"), of, written + 1
                if text.is_valid:
                    file.write(text.as_buffer())
                file.write(b"\n")
        if file is not None:
            file.close()
        yield pa.RecordBatch.from_arrays([pa.array([written])], names=["files"])

    system, root = _located(folder)
    system.create_dir(root)
    # The tasks share the pages, however few files their table has.
    dealt = pages.select(F.col(key).cast("long"), F.col(content).cast("binary")).repartition(key).sortWithinPartitions(key)
    dealt.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def key_of_file(key: str) -> Column:
    """The key in the name of a file of ``write_page_files``, from its ``path``."""
    return F.regexp_extract("path", f"/{key}=(-?[0-9]+)[.]txt$", 1).try_cast("long").alias(key)


def page_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The files below a folder: path, length, content, and columns that partition folders name."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)


def decoded_files(files: DataFrame, keep: Sequence[str] = ("path",)) -> DataFrame:
    """One row per file: ``keep``, html, charset and problem, in one pass. No shuffle.

    Store the result, then take ``pages_of`` and ``rejected_files`` from it, so that no file is
    read twice.
    """
    keep = list(keep)
    schema = T.StructType([files.schema[c] for c in keep] + [
        T.StructField(c, T.StringType()) for c in ("html", "charset", "problem")])

    def decoded(batch: pa.RecordBatch, start: int, found: list[tuple]) -> pa.RecordBatch:
        some = batch.slice(start, len(found))
        return pa.RecordBatch.from_arrays(
            [some.column(c) for c in keep] + [pa.array(x, pa.string()) for x in zip(*found)],
            names=[*keep, "html", "charset", "problem"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, size, found = 0, 0, []
            for row in range(batch.num_rows):  # a megabyte of files at a time, as their text is as large again
                content = batch.column("content")[row].as_py()
                found.append(decode_page(content))
                size += len(content or b"")
                if size >= DECODED_BYTES or row + 1 == batch.num_rows:
                    yield decoded(batch, start, found)
                    start, size, found = row + 1, 0, []

    return files.select(*keep, "content").mapInArrow(run, schema)


def pages_of(decoded: DataFrame) -> DataFrame:
    """The files that are text."""
    return decoded.where(F.col("problem").isNull()).drop("problem")


def rejected_files(decoded: DataFrame) -> DataFrame:
    """The files that are not, each with its reason."""
    return decoded.where(F.col("problem").isNotNull()).drop("html")
