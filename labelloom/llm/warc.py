"""WARC archives, written and read back with the boundaries of records proved.

Writing: every page is a record. Of pages with the same payload of at least
``REVISIT_BYTES`` bytes, the one with the smallest id carries it; the others are
revisit records that name it. Spark's text writer puts the end of a record
behind each, turns over to a new file after some number of them, and compresses.

Reading: a record begins at the start of a file or behind the end of a record,
so a task streams through a file and takes every WARC magic in such a place for
the start of a record, also where a payload only quotes one. Each candidate
gives its own offset and that of its successor, by its header's length and the
content length in it. Pointer jumping from the start of every file then keeps
the candidates that a chain of successors reaches; magic inside payloads isn't
reached. A chain that doesn't end at the file's end is an error. Payloads are
hashed as they stream by and are never held or shuffled.

Defined results for odd input: a null payload counts as empty; a null URL is left
out of the header, line breaks in one become spaces; rows that repeat an id are
written and read one by one, and those with the smallest id are all responses; a
null id is written as an empty one and is larger than any other; an empty table
makes an archive without records. Columns other than id, URL and payload are not
looked at. Payloads are text in UTF-8.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm.shared import attach
from labelloom.operators.pin import settle, shared_folder

#: Smaller payloads are written out each time.
REVISIT_BYTES = 100

#: Records of a file. A chain of so many takes ten rounds of jumps.
FILE_RECORDS = 1000

#: Fixed values of the format.
MAGIC = "WARC/"
VERSION = "1.1"
RECORD_END = "\r\n\r\n"

#: A header that is longer isn't one.
MAX_HEADER = 1 << 16


def revisits(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """``id, refers_to`` of the pages whose payload a smaller id has."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    prints = settle(
        pages.where(F.octet_length(payload) >= REVISIT_BYTES).select(F.col(id_col).alias("id"), F.sha2(payload.cast("binary"), 256).alias("digest"))
    )
    groups = prints.groupBy("digest").agg(F.min("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    found = attach(prints, settle(groups.where("n > 1")), "digest", "n", prints.count())
    return found.where("refers_to is not null and not id <=> refers_to").select("id", "refers_to").distinct()


def records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, date: str) -> DataFrame:
    """One string per page: its record without the record's end."""
    again = settle(revisits(pages, id_col, payload_col)).hint("shuffle_hash")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(payload_col), F.lit("")).alias("_payload"))
    rows = rows.join(again, rows["_id"].eqNullSafe(again["id"]), "left")
    n_bytes, is_revisit = F.octet_length("_payload"), F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), n_bytes.cast("string"), F.lit("\r\n\r\n")
    )
    block = F.concat(http, F.when(is_revisit, "").otherwise(F.col("_payload")))

    def line(name: str, value: Column) -> Column:
        """Nothing for null."""
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def urn(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), page.cast("string"), F.lit(">"))

    header = F.concat(
        F.lit(f"{MAGIC}{VERSION}\r\n"),
        line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.coalesce(urn(F.col("_id")), F.lit("<urn:page:>"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace("_url", r"[\r\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.sha2(F.col("_payload").cast("binary"), 256))),
        line("WARC-Profile", F.when(is_revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", urn(F.col("refers_to"))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
    )
    # What separates header and block is the end of the header's last line and an empty one.
    return rows.select(F.concat(header, F.lit("\r\n"), block).alias("record"))


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = "1970-01-01T00:00:00Z"
) -> None:
    """``pages`` as files of compressed WARC records under ``path``; ``date`` is what records give as their date."""
    written = records(pages, id_col, url_col, payload_col, date).write
    written.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)


class Candidate:
    """What may be a record, fed with the bytes behind its magic until it is complete."""

    def __init__(self, offset: int):
        self.offset, self.fields, self.missing = offset, None, None
        self._head, self._http, self._hash, self.payload_bytes = b"", None, hashlib.sha256(), 0

    def feed(self, data: bytes) -> bool:
        """Whether more is wanted; a candidate that can't be a record has no ``fields``."""
        if self.fields is None:
            self._head += data
            end = self._head.find(b"\r\n\r\n")
            if end < 0:
                return len(self._head) <= MAX_HEADER
            head, data, self._head = self._head[:end], self._head[end + 4 :], b""
            fields = _fields(head)
            if not re.fullmatch(rb"1\.[01]", head.split(b"\r\n", 1)[0]) or not re.fullmatch(r"\d{1,18}", fields.get("content-length", "")):
                return False
            self.fields, self.missing = fields, int(fields["content-length"])
            self.successor = self.offset + len(MAGIC) + len(head) + 4 + self.missing + len(RECORD_END)
        data = data[: self.missing]
        self.missing -= len(data)
        if self._http is None:
            self._head += data
            end = self._head.find(b"\r\n\r\n")
            if end < 0:
                return self.missing > 0
            self._http, data, self._head = _fields(self._head[:end]), self._head[end + 4 :], b""
        self._hash.update(data)
        self.payload_bytes += len(data)
        return self.missing > 0

    def row(self, file: str) -> dict:
        kind, digest = self.fields.get("warc-type"), self._hash.hexdigest()
        n_bytes = self.payload_bytes
        if kind == "revisit":  # its payload is elsewhere
            digest = self.fields.get("warc-payload-digest", "").removeprefix("sha256:")
            stated = (self._http or {}).get("content-length", "")
            n_bytes = int(stated) if stated.isdigit() else None
        return {
            "file": file, "offset": self.offset, "successor": self.successor, "record_type": kind, "payload_bytes": n_bytes, "payload_digest": digest,
            "record_id": self.fields.get("warc-record-id"), "url": self.fields.get("warc-target-uri"), "refers_to": self.fields.get("warc-refers-to"),
        }


def _fields(head: bytes) -> dict[str, str]:
    """The named fields of a header without its first line, names in lower case."""
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {name.strip().lower().decode("utf-8", "replace"): value.strip().decode("utf-8", "replace") for name, _, value in lines}


CANDIDATES = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("successor", pa.int64()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
     ("payload_digest", pa.string()), ("record_id", pa.string()), ("url", pa.string()), ("refers_to", pa.string())]
)


def candidate_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per complete candidate of the files under ``path``, and one per file, without a type, at its end.

    The files are compressed, so that one task reads a file from its start.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separator = (RECORD_END + MAGIC).encode()
        file, at, waiting, found = None, 0, [], []

        def close() -> None:
            # The last record's end has no magic behind it, so the file is as long as what was read.
            found.append({"file": file, "offset": at, "successor": at})

        for batch in batches:
            for name, part in zip(batch.column("file").to_pylist(), batch.column("part"), strict=True):
                data = part.as_py()
                if name != file:
                    if file is not None:
                        close()
                    file, at, waiting = name, 0, []
                    if not data.startswith(MAGIC.encode()):
                        raise ValueError(f"{file} doesn't begin with a WARC record")
                    data, start = data[len(MAGIC) :], 0
                    at = len(MAGIC)
                else:
                    still = []
                    for candidate in waiting:
                        if candidate.feed(separator):
                            still.append(candidate)
                        elif candidate.fields:
                            found.append(candidate.row(file))
                    waiting, start = still, at + len(RECORD_END)
                    at += len(separator)
                still = []
                for candidate in [*waiting, Candidate(start)]:
                    if candidate.feed(data):
                        still.append(candidate)
                    elif candidate.fields:
                        found.append(candidate.row(file))
                waiting = still
                at += len(data)
            yield pa.RecordBatch.from_pylist(found, CANDIDATES)
            found.clear()
        if file is not None:
            close()
        yield pa.RecordBatch.from_pylist(found, CANDIDATES)

    lines = spark.read.option("lineSep", RECORD_END + MAGIC).text(path)
    parts = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("part"))
    return parts.mapInArrow(
        scan,
        "file string, offset long, successor long, record_type string, payload_bytes long, payload_digest string, "
        "record_id string, url string, refers_to string",
    )


def reachable(candidates: DataFrame) -> DataFrame:
    """``file, offset`` of what a chain of successors reaches from the start of its file.

    Each round doubles the reach of the jumps, so that their number is the
    logarithm of a file's records. A step is a join by place in a file, which
    nothing skews; every round is written to the shared folder.
    """
    jumps = settle(candidates.select("file", "offset", "successor"))
    reached = jumps.where("offset = 0").select("file", "offset").distinct()
    n_reached = -1
    while (n := reached.count()) != n_reached:
        n_reached = n
        landed = reached.join(jumps, ["file", "offset"]).select("file", F.col("successor").alias("offset"))
        reached = settle(reached.unionByName(landed).distinct())
        on = jumps.select("file", F.col("offset").alias("successor"), F.col("successor").alias("next"))
        jumps = settle(jumps.join(on, ["file", "successor"]).select("file", "offset", F.col("next").alias("successor")))
    return reached


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the files under ``path``: ``CANDIDATES`` that their file's chain reaches."""
    found = settle(candidate_records(spark, path))
    proved = reachable(found)
    is_end = F.col("record_type").isNull()
    unproved = found.where(is_end).join(proved, ["file", "offset"], "left_anti").count()
    if unproved:
        raise ValueError(f"{unproved} files have a chain of records that doesn't end where the file does")
    return found.where(~is_end).join(proved, ["file", "offset"])


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``pages`` written to the shared folder and read back.

    Per record: id, ``payload_bytes, payload_digest, record_type, refers_to``, the last an id too.
    """
    spark = pages.sparkSession
    path = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, id_col, url_col, payload_col)
    kind = pages.schema[id_col].dataType
    number = lambda urn: F.regexp_extract(urn, "^<urn:page:(.*)>$", 1)
    to_id = lambda urn: F.when(number(urn) != "", number(urn)).cast(kind)
    return read_archives(spark, path).select(
        to_id("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", to_id("refers_to").alias("refers_to")
    )
