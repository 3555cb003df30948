"""Landed answers of the registry and search services, as typed tables.

Each service answer is kept as one JSON text per request; these readers give
them columns. Requests that failed have no row (or an empty answer), which the
joins treat as nothing found.
"""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator
from functools import reduce
from operator import or_
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmscope.functions.headcount import lossy_text
from firmscope.functions.text import ADDRESS_PARTS, pad_number
from firmscope.shared import small_batches

ADDRESS = T.StructType([T.StructField(part, T.StringType()) for part in ADDRESS_PARTS])

PROFILE = T.StructType(
    [
        T.StructField("company_name", T.StringType()),
        T.StructField("company_status", T.StringType()),
        T.StructField("company_type", T.StringType()),
        T.StructField("date_of_creation", T.StringType()),
        T.StructField("registered_office_address", ADDRESS),
        T.StructField("sic_codes", T.ArrayType(T.StringType())),
    ]
)

FILING = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("made_up_date", T.StringType()),
        T.StructField("links", T.MapType(T.StringType(), T.StringType())),
    ]
)

SEARCH_HIT = T.StructType([T.StructField(f, T.StringType()) for f in ("href", "title", "body")])


def profiles(answers: DataFrame) -> DataFrame:
    """(company_number, payload) -> one row per profile; ``fetched_at`` comes along where there is one."""
    more = [c for c in answers.columns if c == "fetched_at"]
    parsed = answers.select(
        pad_number(F.col("company_number")).alias("company_number"),
        F.from_json("payload", PROFILE).alias("profile"),
        *more,
    )
    return parsed.filter("profile is not null").select("company_number", "profile.*", *more)


def filings(answers: DataFrame) -> DataFrame:
    """(company_number, payload) -> one row per listed filing, ``seq`` its place."""
    listing = T.StructType([T.StructField("items", T.ArrayType(FILING))])
    return answers.select(
        pad_number(F.col("company_number")).alias("company_number"),
        F.posexplode(F.from_json("payload", listing)["items"]).alias("seq", "filing"),
    ).select("company_number", F.col("seq").cast("bigint"), "filing.*")


def search_results(answers: DataFrame) -> DataFrame:
    """(company_name, payload) -> one row per hit, ``rank`` from 0."""
    return answers.select(
        "company_name",
        F.posexplode(F.from_json("payload", T.ArrayType(SEARCH_HIT))).alias("rank", "hit"),
    ).select("company_name", "rank", "hit.*")


#: Endings of files that hold many documents.
ARCHIVES = (".tar", ".tar.gz", ".tgz")
#: Bytes of documents that are packed into one archive.
ARCHIVE_BYTES = 1 << 26
DOCUMENTS = "document_id string, content binary, text string"


def filing_documents(spark: SparkSession, path: str) -> DataFrame:
    """Folder of document files, named by id -> (document_id, content, text).

    Files that end in .txt hold text; all others are read by their content.
    Archives hold many documents, named the same way inside: a landing zone of
    some thousand archives is listed where one of a file per document would
    not be.
    """
    files = spark.read.format("binaryFile").load(path)
    name = F.lower(F.substring_index("path", "/", -1))
    packed = reduce(or_, [name.endswith(ending) for ending in ARCHIVES])
    single = files.filter(~packed).select(F.substring_index("path", "/", -1).alias("name"), "content")
    return _named(single).unionByName(packed_documents(files.filter(packed)))


def _named(members: DataFrame) -> DataFrame:
    """(name, content) -> documents."""
    return members.select(
        F.regexp_replace("name", r"\.[^.]*$", "").alias("document_id"),
        "content",
        F.when(F.lower("name").endswith(".txt"), lossy_text(F.col("content"))).alias("text"),
    )


def packed_documents(archives: DataFrame) -> DataFrame:
    """Documents in tar archives, given as rows with the archive in ``content``.

    An archive is read member by member, so that a task holds one archive and
    one batch of documents. One that cannot be read fails the job by its error.
    """

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                if not archive.is_valid:
                    continue
                names, contents, size = [], [], 0
                with tarfile.open(fileobj=io.BytesIO(archive.as_py())) as tar:
                    for member in tar:
                        if not member.isfile():
                            continue
                        names.append(unquote(member.name.rsplit("/", 1)[-1]))
                        contents.append(tar.extractfile(member).read())
                        size += len(contents[-1])
                        if size >= GATHERED:
                            yield _members(names, contents)
                            names, contents, size = [], [], 0
                yield _members(names, contents)

    small_batches(archives.sparkSession)
    return _named(archives.select("content").mapInArrow(members, "name string, content binary"))


#: Bytes of documents that leave an archive in one batch, or lie in archives of one row group.
GATHERED = 1 << 22


def _members(names: list[str], contents: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(contents, pa.binary())], ["name", "content"])


def pack_documents(documents: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(content): tar archives of about ``archive_bytes`` of documents each, as ``packed_documents`` reads them.

    Documents (document_id, content, text) without content are packed as text;
    those without either, or without an id, as nothing.
    """

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for number, content, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number is None or (content is None and text is None):
                    continue
                plain = content is None
                held.append((quote(number, safe="") + (".txt" if plain else ".bin"), text.encode() if plain else content))
                size += len(held[-1][1])
                if size >= archive_bytes:
                    yield _archive(held)
                    held, size = [], 0
        if held:
            yield _archive(held)

    small_batches(documents.sparkSession)
    return documents.select("document_id", "content", "text").mapInArrow(archives, "content binary")


def write_archives(documents: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the archives of ``pack_documents`` as a Parquet table.

    Parquet's readers decode thousands of rows of a row group at once, whatever
    they hold, and zeros between members compress so well that a group of usual
    size holds gigabytes of archives; so groups are cut by rows.
    """
    rows = max(1, GATHERED // archive_bytes)
    pack_documents(documents, archive_bytes).write.option("parquet.block.row.count.limit", rows).parquet(path)


def _archive(members: list[tuple[str, bytes]]) -> pa.RecordBatch:
    sink = io.BytesIO()
    with tarfile.open(fileobj=sink, mode="w") as tar:
        for name, content in members:
            entry = tarfile.TarInfo(name)
            entry.size = len(content)
            tar.addfile(entry, io.BytesIO(content))
    return pa.RecordBatch.from_arrays([pa.array([sink.getvalue()], pa.binary())], ["content"])
