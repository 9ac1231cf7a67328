"""WARC archives from a chunked record table, with revisit records for repeated payloads.

A payload is cut into chunks of 64 KiB: rows of a record number and a chunk number, each with the SHA-1 of
the record up to that chunk, carried on from chunk to chunk. The last chunk's digest is the
record's. Records that repeat a payload of at least 1000 bytes become revisits of the one with the largest
page_id. Chunks are written as the segments of a WARC 1.1 record (the first a ``response``, the others
``continuation`` records), so neither writing nor reading ever holds a whole payload. Files are text files
compressed with gzip, as many as their bytes ask for; reading takes what lies between double line ends, follows the
Content-Length of each record through it and computes the digests again.

Nulls and empties: a null payload is empty; a null url has no target field; records without a page_id are
responses. Rows that repeat a page_id are records of their own; those that share the largest page_id of
a payload are all responses. An empty table gives no files with records. Extra columns are not archived.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import query, table
from revenue_lens.operators.storage import materialize, shared_folder

CHUNK_BYTES = 64 << 10
REVISIT_BYTES = 1000
#: Payload of an archive file, of which one task reads each; a small table still gets a file per core.
ARCHIVE_BYTES = 256 << 20
DATE = "2000-01-01T00:00:00Z"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def chunked(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(record, page_id, url, chunk, chunks, data, upto, digest) from ``pages(page_id, url, html)``:
    ``upto`` and ``digest`` are the length and SHA-1 of the payload up to this chunk."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.monotonically_increasing_id().alias("record"), F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("chunks", F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / chunk_bytes)).cast("int"))
    rows = rows.select("record", "page_id", "url", "chunks", "payload", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    rows = rows.select("record", "page_id", "url", "chunk", "chunks", F.substring(F.col("payload"), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes)).alias("data"))

    def run(batches):
        sha, length = hashlib.sha1(), 0
        for batch in batches:  # the chunks of a record follow each other
            upto, digests = [], []
            for chunk, data in zip(batch["chunk"].to_pylist(), batch["data"]):
                if chunk == 0:
                    sha, length = hashlib.sha1(), 0
                part = data.as_buffer()
                sha.update(part)
                length += len(part)
                upto.append(length)
                digests.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto, pa.int64()), pa.array(digests, pa.string())], [*batch.schema.names, "upto", "digest"])

    return rows.mapInArrow(run, "record bigint, page_id bigint, url string, chunk int, chunks int, data binary, upto bigint, digest string")


def decided(chunks: DataFrame) -> DataFrame:
    """(record, digest, length, original) per record; ``original``: the record it revisits, else null."""
    heads = chunks.where("chunk = chunks - 1").select("record", "page_id", "digest", F.col("upto").alias("length"))
    large = heads.where((F.col("length") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
    last = large.groupBy("digest", "length").agg(F.max(F.struct("page_id", "record")).alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    original = F.when(F.col("page_id") < F.col("last.page_id"), F.col("last.record"))
    return heads.join(last, ["digest", "length"], "left").select("record", "digest", "length", original.alias("original"))


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(record: Column) -> Column:
    return F.concat(F.lit("<urn:x-record:"), record.cast("string"), F.lit(">"))


def _record_text() -> Column:
    """A segment as text; the line end that the writer adds is the second of the two behind a record."""
    first, revisit = F.col("chunk") == 0, F.col("original").isNotNull()
    kind = F.when(~first, "continuation").when(revisit, "revisit").otherwise("response")
    head = F.when(first & ~revisit, F.lit(_HTTP)).otherwise(F.lit(""))
    data = F.when(revisit, F.lit("")).otherwise(F.col("data").cast("string"))
    # Bytes that may not stand in a header field are percent-encoded.
    url = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), " ", "%20")
    when_first = lambda c: F.when(first, c)
    several = ~revisit & (F.col("chunks") > 1)
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", kind),
        _field("WARC-Record-ID", F.when(first, _urn(F.col("record"))).otherwise(_urn(F.concat(F.col("record").cast("string"), F.lit("-"), F.col("chunk").cast("string"))))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", when_first(url)),
        _field("WARC-Page-ID", when_first(F.col("page_id").cast("string"))),
        _field("WARC-Payload-Digest", when_first(F.concat(F.lit("sha1:"), F.col("payload_digest")))),
        _field("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _urn(F.col("original")))),
        _field("WARC-Segment-Origin-ID", F.when(~first, _urn(F.col("record")))),
        _field("WARC-Segment-Number", F.when(several, (F.col("chunk") + 1).cast("string"))),
        _field("WARC-Segment-Total-Length", F.when(several & (F.col("chunk") == F.col("chunks") - 1), (F.col("length") + len(_HTTP)).cast("string"))),
        _field("Content-Type", F.when(first & ~revisit, F.lit("application/http; msgtype=response"))),
        _field("Content-Length", (F.octet_length(head) + F.octet_length(data)).cast("string")),
        F.lit("\r\n"),
        head,
        data,
        F.lit("\r\n"),
    )


def write_archives(pages: DataFrame, folder: str, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write one record per row of ``pages(page_id, url, html)`` under ``folder``; the segments of a record follow
    each other in one file."""
    chunks = materialize(chunked(pages, chunk_bytes), "zstd")
    size = chunks.where("chunk = chunks - 1").agg(F.sum("upto").alias("n")).first()["n"] or 0
    files = max(pages.sparkSession.sparkContext.defaultParallelism, -(-size // ARCHIVE_BYTES))
    kinds = decided(chunks.drop("data", "url")).withColumnRenamed("digest", "payload_digest")
    rows = chunks.repartition(files, "record").join(kinds, "record").where("original IS NULL OR chunk = 0")
    rows = rows.sortWithinPartitions("record", "chunk").select(_record_text().alias("value"))
    rows.write.option("lineSep", "\r\n").option("compression", "gzip").text(folder)


class _Reader:
    """Follows the records of a file, given as what lies between its double line ends; keeps a header and a digest, never
    a payload."""

    def __init__(self):
        self.rest = 0  # bytes of the segment still to come
        self.gap = b""  # what the next piece has to start with, of the double line end behind a record
        self.between = True  # the next piece is a header
        self.record = self.segment = None
        self.http = False
        self.done = []

    def take(self, piece) -> None:
        """A piece and the double line end behind it."""
        if self.gap is None:  # the whole double line end follows an empty piece
            if len(piece):
                raise ValueError("a record does not end where its Content-Length says")
            self.gap = b""
            return
        if self.gap:
            if bytes(piece[: len(self.gap)]) != self.gap:
                raise ValueError("a record does not end where its Content-Length says")
            piece, self.gap = piece[len(self.gap) :], b""
            if not len(piece):  # the end of the file
                return
        if self.between:
            self._header(bytes(piece))
            return
        size = len(piece)
        if self.http:  # the answer's own header ends with a double line end
            self.http, self.rest = False, self.rest - size - len(_END)
        elif self.rest >= size:
            inside = min(self.rest - size, len(_END))  # of the double line end, still in the segment
            self._hash(piece)
            if inside:
                self._hash(_END[:inside])
            self.rest -= size + inside
            if not self.rest and inside < len(_END):
                self._segment_ends(_END[len(_END) - inside :])
                return
        else:
            raise ValueError("a record does not end where its Content-Length says")
        if not self.rest:
            self._segment_ends(None)

    def _hash(self, data) -> None:
        self.record["sha"].update(data)
        self.record["length"] += len(data)

    def _header(self, text: bytes) -> None:
        lines = text.decode("utf-8", "replace").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        self.rest, self.between, self.segment = int(fields["Content-Length"]), False, fields
        if fields["WARC-Type"] != "continuation":
            self.record = {"fields": fields, "sha": hashlib.sha1(), "length": 0}
            self.http = fields["WARC-Type"] == "response"
        elif self.record is None or fields["WARC-Segment-Origin-ID"] != self.record["fields"]["WARC-Record-ID"]:
            raise ValueError("a segment stands apart from its record")
        if not self.rest:
            self._segment_ends(None)

    def _segment_ends(self, gap: bytes | None) -> None:
        self.gap, self.between = gap, True
        if "WARC-Segment-Number" in self.segment and "WARC-Segment-Total-Length" not in self.segment:
            return
        fields, digest = self.record["fields"], self.record["sha"].hexdigest()
        declared = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        if fields["WARC-Type"] == "response" and digest != declared:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} does not have its digest")
        page = fields.get("WARC-Page-ID")
        self.done.append((fields["WARC-Record-ID"], None if page is None else int(page), fields["WARC-Type"], self.record["length"], declared, fields.get("WARC-Refers-To")))
        self.record = None


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(record_id, page_id, record_type, payload_bytes, payload_digest, refers_to_record) of every record under ``folder``."""
    names = ["record_id", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to_record"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches):
        reader = _Reader()
        for batch in batches:
            for piece in batch["value"]:
                reader.take(memoryview(piece.as_buffer()))
            found, reader.done = reader.done, []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], kind) for k, kind in enumerate(kinds)], names)
        if reader.record or reader.gap != b"":
            raise ValueError("the last record is not complete")

    # Compressed files are read from start to end by one task each, so pieces come in order; none is longer than a segment.
    pieces = spark.read.option("lineSep", _END.decode()).text(folder).select(F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(run, "record_id string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to_record string")


def resolved(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits take the length from the
    response they refer to, whose page_id is ``refers_to``."""
    answers = records.where("record_type = 'response'")
    to = answers.select(F.col("record_id").alias("to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest"))
    revisits = records.where("record_type = 'revisit'").join(to, (F.col("refers_to_record") == F.col("to")) & (F.col("payload_digest") == F.col("to_digest")))
    none = F.lit(None).cast("bigint")
    return answers.select("page_id", "payload_bytes", "payload_digest", "record_type", none.alias("refers_to")).unionByName(
        revisits.select("page_id", F.col("to_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("to_page").alias("refers_to"))
    )


_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
l AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes::BIGINT AS payload_bytes, p.payload_digest,
    CASE WHEN p.page_id < l.last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN p.page_id < l.last THEN l.last END AS refers_to
FROM p LEFT JOIN l ON l.payload_digest = p.payload_digest AND p.payload_bytes >= 1000
"""


@query("op1_warc", _SQL)
def op1_warc(spark, sf_dir) -> DataFrame:
    folder = f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), folder)
    return resolved(materialize(read_archives(spark, folder)))
