"""WARC archives written from and read into a chunked record table.

A payload never travels as one value: it is cut into rows of ``(record, chunk
number, at most CHUNK bytes)``, and the SHA-256 of the payload is carried along
its chunks, so every row holds the digest of the payload up to its end and the
last row that of the whole. Per digest the record of smallest page id is the
response, the others become revisits of it. To write, a head row per record is
united with its chunk rows and both are dealt by record and sorted by chunk
number; a task streams them into lines that end in CRLF. The payload is stored
in HTTP's chunked transfer coding, whose frames end in CRLF too, so a frame is a
line of the file and neither side ever holds more than a chunk. Files are
compressed, hence read by one task each, which parses the lines as they come,
carries the digest again and fails if it differs from the one in the head.

Edge cases: a null text is an empty payload, which has one chunk row without
bytes; a null page id sorts after all others, a null url leaves out its field;
repeated rows are records of their own, one of them the response (ties between
equal ids: by row number); payloads that hold CRLF or cut code points are kept
byte for byte; a very long payload costs memory for one chunk wherever it is
read or written (only the table's own reader holds the row); an empty table
gives an empty archive; extra columns are left aside by name.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import BROADCAST_ROWS, small, written

CHUNK = 16 * 1024
MIN_REVISIT = 100
DATE = "2024-02-01T00:00:00Z"
EOL = "\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
CHUNKED = HTTP + b"Transfer-Encoding: chunked\r\n\r\n"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNSAFE = re.compile(rb"[\x00-\x20\x7f<>]")


def chunk_table(pages: DataFrame, size: int = CHUNK) -> DataFrame:
    """``(rec, page_id, url, n_bytes, n_chunks, chunk_no, data, digest)``: the
    chunks of every page in order, with the digest up to each chunk's end."""
    body = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.monotonically_increasing_id().alias("rec"), "page_id", "url", body.alias("body"))
    rows = rows.withColumn("n_bytes", F.octet_length("body").cast("long"))
    last = F.expr(f"CAST(greatest(n_bytes - 1, 0) DIV {size} AS INT)")
    rows = rows.select("*", (last + 1).alias("n_chunks"), F.explode(F.sequence(F.lit(0), last)).alias("chunk_no"))
    data = F.expr(f"substring(body, chunk_no * {size} + 1, {size})")
    rows = rows.select("rec", "page_id", "url", "n_bytes", "n_chunks", "chunk_no", data.alias("data"))

    def carry(batches):
        state = None
        for b in batches:
            digests = []
            for no, piece in zip(b.column("chunk_no").to_pylist(), b.column("data")):
                if no == 0:
                    state = hashlib.sha256()
                state.update(piece.as_buffer())
                digests.append(state.copy().hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(digests, pa.string())],
                                             names=[*b.schema.names, "digest"])

    schema = ("rec long, page_id long, url string, n_bytes long, n_chunks int, chunk_no int, "
              "data binary, digest string")
    return rows.select("rec", F.col("page_id").cast("long"), "url", "n_bytes", "n_chunks", "chunk_no",
                       "data").mapInArrow(carry, schema)


def record_heads(chunks: DataFrame) -> DataFrame:
    """One row per record of a written chunk table; ``first_rec`` and
    ``first_page`` name the response that a revisit refers to."""
    ends = chunks.filter("chunk_no = n_chunks - 1").drop("data", "chunk_no")
    firsts = (ends.filter(f"n_bytes >= {MIN_REVISIT}").groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"),
                   F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "rec")).alias("f"))
              .filter("n > 1").select(F.col("digest").alias("_digest"), F.col("f.rec").alias("first_rec"),
                                      F.col("f.page_id").alias("first_page")))
    firsts = written(firsts, "op11_firsts")
    again = (F.col("digest") == F.col("_digest")) & (F.col("rec") != F.col("first_rec"))
    return ends.join(small(firsts), again, "left").drop("_digest")


def record_id(rec: int, page_id) -> bytes:
    name = hashlib.sha256(f"{rec}:{page_id}".encode()).digest()[:16]
    return f"<urn:uuid:{uuid.UUID(bytes=name)}>".encode()


def framed(n_bytes: int, size: int) -> int:
    """Bytes of a payload in chunked transfer coding."""
    full, rest = divmod(n_bytes, size)
    frame = lambda n: len(f"{n:x}") + n + 4
    return full * frame(size) + (frame(rest) if rest else 0) + 5


def head_lines(h: dict, size: int) -> list[bytes]:
    """The lines of a record before its payload."""
    revisit = h["first_rec"] is not None
    block = len(HTTP) + 2 if revisit else len(CHUNKED) + framed(h["n_bytes"], size)
    out = [b"WARC/1.1", b"WARC-Type: " + (b"revisit" if revisit else b"response"),
           b"WARC-Record-ID: " + record_id(h["rec"], h["page_id"]), b"WARC-Date: " + DATE.encode(),
           b"WARC-Payload-Digest: sha256:" + h["digest"].encode()]
    if h["url"] is not None:
        url = UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], h["url"].encode())
        out.append(b"WARC-Target-URI: " + url)
    if h["page_id"] is not None:
        out.append(b"Page-ID: %d" % h["page_id"])
    if revisit:
        out += [b"WARC-Refers-To: " + record_id(h["first_rec"], h["first_page"]), b"WARC-Profile: " + PROFILE]
    out += [b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % block, b""]
    return out + (HTTP + b"\r\n" if revisit else CHUNKED)[:-2].split(b"\r\n")


def write_archive(chunks: DataFrame, heads: DataFrame, path: str, size: int = CHUNK) -> None:
    """Write the records of a written chunk table as compressed WARC files."""
    revisits = written(heads.filter("first_rec IS NOT NULL").select("rec"), "op11_revisits")
    if revisits.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        # only spares the shuffle: the chunks of a revisit are passed over below
        chunks = chunks.join(F.broadcast(revisits), "rec", "left_anti")
    rows = (heads.withColumn("chunk_no", F.lit(-1)).unionByName(chunks.select("rec", "chunk_no", "data"),
                                                                allowMissingColumns=True)
            .repartition("rec").sortWithinPartitions("rec", "chunk_no"))

    def lines(batches):
        head = None
        info = b"software: tagfold\r\nformat: WARC File Format 1.1\r\n"
        out = [b"WARC/1.1", b"WARC-Type: warcinfo", b"WARC-Date: " + DATE.encode(),
               b"WARC-Record-ID: " + record_id(-1, len(info)), b"Content-Type: application/warc-fields",
               b"Content-Length: %d" % len(info), b"", *info[:-2].split(b"\r\n"), b"", b""]
        for b in batches:
            data = b.column("data")
            no = b.column("chunk_no").to_pylist()
            plain = b.drop_columns(["data"])
            for i, k in enumerate(no):
                if k < 0:
                    head = plain.slice(i, 1).to_pylist()[0]
                    out += head_lines(head, size)
                    if head["first_rec"] is not None:
                        out += [b"", b""]
                elif head["first_rec"] is None:
                    piece = data[i].as_py()
                    if piece:
                        out += [b"%x" % len(piece), piece]
                    if k == head["n_chunks"] - 1:
                        out += [b"0", b"", b"", b""]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["line"])
            out = []

    text = rows.mapInArrow(lines, "line binary").select(F.col("line").cast("string").alias("value"))
    text.write.option("lineSep", EOL).option("compression", "gzip").text(path)


def parsed(lines):
    """Events of the lines of an archive: ``("head", fields)``, ``("data",
    bytes)`` for each piece of a payload and ``("end", None)``. Holds one line."""
    state, fields, left = "between", {}, 0
    for line in lines:
        if state == "between":
            if line:
                if not line.startswith(b"WARC/1."):
                    raise ValueError("not the start of a record")
                state, fields = "head", {}
        elif state == "head":
            if line:
                k, _, v = line.partition(b":")
                fields[k.decode().lower()] = v.strip().decode()
            else:
                yield "head", fields
                left, state = int(fields["content-length"]), "http" if "application/http" in fields["content-type"] else "skip"
                chunked = False
        elif state == "http":
            left -= len(line) + 2
            chunked = chunked or line.lower() == b"transfer-encoding: chunked"
            if not line:
                state = "size" if chunked else "skip"
        elif state == "size":
            piece = int(line, 16)
            left -= len(line) + 2
            state = "data" if piece else "tail"
        elif state == "data":
            n = min(piece, len(line) + 2)
            yield "data", line if n <= len(line) else line + b"\r\n"
            left -= len(line) + 2
            piece -= n
            if n <= len(line):
                state = "size"
        else:  # the end of a chunked payload, or a block that is passed over
            left -= len(line) + 2
        if state in ("skip", "tail", "http") and left <= 0:
            if left < 0 or state == "http":
                raise ValueError("the block is not as long as its head says")
            yield "end", None
            state = "between"
    if state != "between":
        raise ValueError("the last record is cut off")


RECORD = ("record_id string, record_type string, page_id long, url string, payload_bytes long, "
          "payload_digest string, refers_to string")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", EOL).text(path).select(F.col("value").cast("binary").alias("line"))


def _stream(batches):
    for b in batches:
        for line in b.column(0):
            yield line.as_buffer().to_pybytes()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives: length and digest are measured on
    the stored payload of a response, and taken from the head of a revisit
    (its length is null)."""
    def run(batches):
        out, h, n = [], None, 0
        for what, x in parsed(_stream(batches)):
            if what == "head":
                f, h, n = x, hashlib.sha256(), 0
            elif what == "data":
                h.update(x)
                n += len(x)
            elif f["warc-type"] != "warcinfo":
                digest = f["warc-payload-digest"].removeprefix("sha256:")
                full = f["warc-type"] == "response"
                if full and digest != h.hexdigest():
                    raise ValueError(f"payload of {f['warc-record-id']} does not have its digest")
                page = f.get("page-id")
                out.append((f["warc-record-id"], f["warc-type"], int(page) if page else None, f.get("warc-target-uri"),
                            n if full else None, digest, f.get("warc-refers-to")))
            if len(out) >= 1024:
                yield _batch(out)
                out = []
        yield _batch(out)

    return _lines(spark, path).mapInArrow(run, RECORD)


def _batch(rows):
    names = ["record_id", "record_type", "page_id", "url", "payload_bytes", "payload_digest", "refers_to"]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``(record_id, chunk_no, data, digest)`` of the stored payloads, in pieces
    as they lie in the files, with the digest up to each piece's end."""
    def run(batches):
        for what, x in parsed(_stream(batches)):
            if what == "head":
                f, h, k = x, hashlib.sha256(), 0
            elif what == "data":
                h.update(x)
                yield pa.RecordBatch.from_pydict({"record_id": [f["warc-record-id"]], "chunk_no": pa.array([k], pa.int32()),
                                                  "data": pa.array([x], pa.binary()), "digest": [h.hexdigest()]})
                k += 1

    return _lines(spark, path).mapInArrow(run, "record_id string, chunk_no int, data binary, digest string")


def archive_pages(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` to WARC files under ``path``, read them back, and give
    each page's digest row."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "op11_warc")
    table, kept = chunk_table(pages), scratch_path(spark, "op11_chunks")
    table.write.option("compression", "zstd").parquet(kept)
    chunks = spark.read.schema(table.schema).parquet(kept)
    write_archive(chunks, record_heads(chunks), path)
    records = written(read_records(spark, path), "op11_records")
    full = records.filter("record_type = 'response'")
    target = full.select(F.col("record_id").alias("_id"), F.col("page_id").alias("_page"),
                         F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest"))
    again = records.filter("record_type = 'revisit'").join(target, F.col("refers_to") == F.col("_id"), "left")
    same = F.col("payload_digest") == F.col("_digest")
    checked = F.when(same, F.col("_bytes")).otherwise(F.raise_error(F.lit("a revisit refers to another payload")))
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return (full.select(*cols, F.lit(None).cast("long").alias("refers_to"))
            .unionByName(again.withColumn("payload_bytes", checked.cast("long")).select(*cols, F.col("_page").alias("refers_to"))))


ORACLE = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d,
         row_number() OVER () AS rid FROM pages),
g AS (
  SELECT *, row_number() OVER (PARTITION BY d ORDER BY page_id NULLS LAST, rid) AS k,
         first_value(page_id) OVER (PARTITION BY d ORDER BY page_id NULLS LAST, rid) AS f FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND k > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND k > 1 THEN f END AS refers_to
FROM g
"""
