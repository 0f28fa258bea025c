"""Operator 12: captures to WARC archives and back, assembled from their records.

Writing. A capture is three records: the page (``response``, or ``revisit`` where another page holds the
same payload), its ``request``, and ``metadata`` that carries the page's id; the last two name the first in
WARC-Concurrent-To. Records are composed as text columns and written by Spark's text writer with the
record terminator as line separator, so an archive is a plain (or gzipped) WARC file and a lost task's
file is never seen. A revisit has no payload; it is told by its payload digest (SHA-256), as the profile
identical-payload-digest has it. Which page answers for a payload is one grouped aggregate of digests.

Reading. Each archive is parsed from its start by Content-Length, so no payload can be taken for a
record's border; gzip members are inflated piece by piece. One file is read at a time and a record is
held whole, nothing else.

Assembly. Requests and metadata join their captures through the record ids of WARC-Concurrent-To, and
revisits find the response with their payload digest: one nested row a capture. Where a capture has
several requests or metadata records, the one with the least record id is nested and ``n_requests`` and
``n_metadata`` count all (each is also a row of ``read_records``); so a record that a third of all others
name costs partial aggregates, not one task's list. Joins carry the nested fields only; drop the payload
column first if it isn't needed.

Defined results: a null html is an empty payload; payloads below ``LEAST`` bytes are always written
whole; of equal payloads the one with the greatest page_id is the response, and rows that repeat that
page_id are responses too; a null page_id is always a response and refers to nothing; each repeated row
is a capture of its own. Line breaks in a url are written as %0D and %0A. An empty table gives an empty
table. A damaged stretch of an archive is one record of type ``damaged`` that holds its bytes, and reading
goes on at the next line that starts a record. Extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import in_arrow, written
from tripmart.session import scratch_dir

LEAST = 1000  # bytes of a payload from which copies are written as revisits
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
START = re.compile(rb"(?:\A|(?<=\n))WARC/1\.[01]\r\n")
MARK = len(b"\nWARC/1.1\r\n")
PIECE = 1 << 20  # bytes inflated at a time
BATCH = 1 << 22  # bytes of blocks in one batch that is handed on
RECORDS = """record_id string, type string, concurrent_to string, uri string, digest string, page_id long,
             http_head string, payload binary"""


def _uuid(*parts) -> str:
    """SQL of a record id made from the SQL expressions ``parts``."""
    cut = "regexp_replace(md5(concat_ws(' ', {})), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '<urn:uuid:$1-$2-$3-$4-$5>')"
    return cut.format(", ".join(f"coalesce(cast({p} AS STRING), '')" for p in parts))


def _record(kind: str, of: str, content: str, block: str, more: str = "''") -> str:
    """SQL of a record up to its terminator. ``more`` gives further header lines, each with its end."""
    return (f"concat('WARC/1.1\\r\\nWARC-Record-ID: ', {of}, '\\r\\nWARC-Type: ', {kind}, '\\r\\nWARC-Date: {DATE}\\r\\nWARC-Target-URI: ', uri, "
            f"'\\r\\n', {more}, 'Content-Type: {content}\\r\\nContent-Length: ', octet_length({block}), '\\r\\n\\r\\n', {block})")


def revisits(pages: DataFrame) -> DataFrame:
    """page_id and sha of the pages (page_id, sha, bytes) whose payload a page with a greater page_id holds too."""
    answers = pages.where(f"page_id IS NOT NULL AND bytes >= {LEAST}").groupBy("sha", "bytes").agg(
        F.max("page_id").alias("answer"), F.min("page_id").alias("least")).where("least < answer").drop("least")
    return pages.join(answers, ["sha", "bytes"]).where("page_id < answer").select("page_id", "sha").distinct()


def write_archives(pages: DataFrame, path: str, compression: str = "gzip") -> None:
    """One archive per partition of ``pages`` (page_id, url, html) below ``path``."""
    clean = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html"),
        F.regexp_replace(F.regexp_replace(F.coalesce("url", F.lit("")), "\r", "%0D"), "\n", "%0A").alias("uri"))
    clean = clean.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("sha", F.sha2("html", 256))
    digests = written(clean.select("page_id", "sha", "bytes"), "digests")
    again = written(revisits(digests), "revisits").withColumn("again", F.lit(True))
    row = clean.join(again, ["page_id", "sha"], "left").selectExpr(
        "*", "IF(again, 'revisit', 'response') AS kind", "monotonically_increasing_id() AS nth").selectExpr(
        "*", f"{_uuid('kind', 'page_id', 'sha', 'nth')} AS id",
        "concat('HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ', bytes, '\\r\\n\\r\\n') AS head").selectExpr(
        "*", "IF(again, head, concat(head, html)) AS block",
        "regexp_extract(uri, '^[a-zA-Z]+://([^/?#]*)', 1) AS host",
        "regexp_extract(uri, '^[a-zA-Z]+://[^/?#]*(.*)$', 1) AS target",
        "concat('page-id: ', page_id, '\\r\\n') AS note")
    digest = f"concat('WARC-Payload-Digest: sha256:', sha, '\\r\\n', IF(again, 'WARC-Profile: {PROFILE}\\r\\n', ''))"
    with_it = "concat('WARC-Concurrent-To: ', id, '\\r\\n')"
    asked = "concat('GET ', IF(target = '', '/', target), ' HTTP/1.1\\r\\nHost: ', host, '\\r\\n\\r\\n')"
    row.select(F.explode(F.array(
        F.expr(_record("kind", "id", "application/http;msgtype=response", "block", digest)),
        F.expr(_record("'request'", _uuid("'request'", "id"), "application/http;msgtype=request", asked, with_it)),
        F.expr(_record("'metadata'", _uuid("'metadata'", "id"), "application/warc-fields", "coalesce(note, '')", with_it)),
    )).alias("value")).write.option("lineSep", END).option("compression", compression).text(path)


class _Bytes:
    """Bytes of an archive, inflated as they are asked for."""

    def __init__(self, content: memoryview):
        self.left, self.at = content, 0
        self.gzip = bytes(content[:2]) == b"\x1f\x8b"
        self.member = zlib.decompressobj(31) if self.gzip else None
        self.held, self.pos = bytearray(), 0

    def more(self) -> bool:
        """Add a piece to ``held``; False at the end of the archive (or of what can be inflated)."""
        if self.pos > PIECE:
            del self.held[:self.pos]
            self.pos = 0
        if self.at >= len(self.left):
            return False
        piece = self.left[self.at:self.at + PIECE]
        self.at += len(piece)
        if not self.gzip:
            self.held += piece
            return True
        try:
            while piece:
                if self.member.eof:
                    self.member = zlib.decompressobj(31)
                self.held += self.member.decompress(piece)
                piece = self.member.unused_data
        except zlib.error:  # what follows can't be read
            self.at = len(self.left)
        return True

    def upto(self, mark: bytes) -> int:
        """Where ``mark`` ends in ``held``; -1 if it doesn't come."""
        start = self.pos
        while (found := self.held.find(mark, start)) < 0:
            start = max(self.pos, len(self.held) - len(mark) + 1) - self.pos
            if not self.more():
                return -1
            start += self.pos
        return found + len(mark)

    def whole(self, n: int) -> bool:
        """Whether n bytes from ``pos`` are there."""
        while len(self.held) - self.pos < n:
            if not self.more():
                return False
        return True


def parse(content: memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of every record; damaged stretches have the type ``damaged``."""
    source = _Bytes(content)
    while source.whole(1):
        end = source.upto(END.encode())
        head = bytes(source.held[source.pos:end]) if end > 0 else b""
        if START.match(head):
            fields = {}
            for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
                name, _, value = line.partition(":")
                fields.setdefault(name.strip().lower(), value.strip())
            size = fields.get("content-length", "")
            if size.isdecimal():
                skip = end - source.pos
                if source.whole(skip + int(size)):
                    at = source.pos + skip
                    block = bytes(source.held[at:at + int(size)])
                    source.pos = at + int(size)
                    if source.whole(4) and source.held[source.pos:source.pos + 4] == END.encode():
                        source.pos += 4
                    yield fields, block
                    continue
        # Not a record: on to the next line that begins one.
        ahead = 1
        while not (found := START.search(source.held, source.pos + ahead)):
            ahead = max(1, len(source.held) - source.pos - MARK)
            if not source.more():
                break
        stop = found.start() if found else len(source.held)
        lost, source.pos = bytes(source.held[source.pos:stop]), stop
        if lost.strip():
            yield {"warc-type": "damaged"}, lost


def _row(fields: dict[str, str], block: bytes) -> tuple:
    head, page = None, None
    if fields.get("content-type", "").startswith("application/http"):
        head, _, block = block.partition(END.encode())
        head = head.decode("utf-8", "replace")
    elif fields.get("warc-type") == "metadata":
        found = re.search(rb"^page-id: (-?\d+)\r?$", block, re.M)
        page = int(found[1]) if found else None
    return (fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-concurrent-to"), fields.get("warc-target-uri"),
            fields.get("warc-payload-digest"), page, head, block)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """A row per record of the archives below ``path`` (each of less than 2 GB, as Spark's file reader takes them)."""
    files = spark.read.format("binaryFile").load(path).select("content")
    kinds = [pa.string()] * 5 + [pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in RECORDS.split(",")]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                rows, size = [], 0
                for fields, block in parse(memoryview(batch.column(0)[i].as_buffer())):
                    rows.append(_row(fields, block))
                    size += len(block) + 500
                    if size > BATCH:
                        yield packed(rows)
                        rows, size = [], 0
                if rows:
                    yield packed(rows)

    return in_arrow(files, run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: id, uri, page_id, ``response`` (struct of the record's other columns: of the record
    itself, or for a revisit of the response with its digest), record_type, refers_to (a revisit's response), ``request``,
    ``metadata``, n_requests and n_metadata. ``records`` has the columns of ``read_records``, payload or not, or more."""
    own = [c for c in records.columns if c not in ("record_id", "type", "concurrent_to", "uri", "digest", "page_id")]

    def beside(kind: str, count: str) -> DataFrame:
        fields = F.struct("record_id", "uri", "page_id", *own)
        return records.where(f"type = '{kind}' AND concurrent_to IS NOT NULL").groupBy(F.col("concurrent_to").alias("id")).agg(
            F.min_by(fields, "record_id").alias(kind), F.count("*").alias(count))

    main = records.where("type IN ('response', 'revisit')").select(
        F.col("record_id").alias("id"), "uri", F.col("type").alias("record_type"), "digest", F.struct(*own).alias("response"))
    joined = main.join(beside("request", "n_requests"), "id", "left").join(beside("metadata", "n_metadata"), "id", "left").select(
        "id", "uri", "record_type", "digest", "response", "request", "metadata", F.col("metadata.page_id").alias("page_id"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_requests", "n_metadata")])
    joined = written(joined, "captures")
    whole = joined.where("record_type = 'response'")
    answers = whole.join(joined.where("record_type = 'revisit'").select("digest").distinct(), "digest", "left_semi").groupBy("digest").agg(
        F.max_by(F.struct("page_id", "response"), "page_id").alias("answer"))
    again = joined.where("record_type = 'revisit'").join(answers, "digest", "left").withColumns(
        {"response": F.coalesce("answer.response", "response"), "refers_to": F.col("answer.page_id")}).drop("answer")
    return again.unionByName(whole.withColumn("refers_to", F.lit(None).cast("long")))


def captures(pages: DataFrame) -> DataFrame:
    """The nested captures of ``pages`` (page_id, url, html), written to archives and read back; in place of the payload
    the response has payload_bytes and payload_digest (SHA-1, hex)."""
    path = scratch_dir(pages.sparkSession, "warc")
    write_archives(pages, path)
    records = read_records(pages.sparkSession, path)
    return assemble(written(records.select(
        *[c for c in records.columns if c != "payload"], F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest")), "records"))
