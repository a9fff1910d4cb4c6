"""WARC archives compressed with Zstandard, one frame for each record, and a dictionary in front.

Spark writes and reads the files, so any file system it knows will do. Its text writer ends each
row with a line feed; a row here ends with the header of a skippable frame of one byte, and
the line feed is that byte. Any reader of the format passes over such frames.
"""

import hashlib
import struct
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanbook.llm.shared import keep
from loanbook.session import work_folder

#: Fixed values of the formats.
ZSTD_MAGIC, DICTIONARY_MAGIC, SKIPPABLE = 0xFD2FB528, 0x184D2A5D, range(0x184D2A50, 0x184D2A60)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LINE_FEED_FRAME = struct.pack("<II", 0x184D2A50, 1)

DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 64 << 10, 400, 8 << 20
#: Payloads shorter than this are never revisits.
LEAST_BYTES = 100
#: Bytes of payload that the reader hands on at once.
BATCH_BYTES = 8 << 20


def _uri(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(uri: str | None):
    return int(uri[10:-1]) if uri and len(uri) > 11 else None


def record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record: an HTTP response, or a revisit that repeats only its HTTP header."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": _uri(page_id), "WARC-Date": date,
        "WARC-Target-URI": quote(url or "", safe="%:/?#[]@!$&'()*+,;=~-._"),
        "WARC-Payload-Digest": f"sha256:{digest}", "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    if revisit:
        head |= {"WARC-Refers-To": _uri(refers_to), "WARC-Profile": PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _archive(date: str):
    """One archive from the rows of a task: the dictionary is trained on its first records."""
    def dictionary(samples):
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        except zstandard.ZstdError:  # too few or too short records: the archive goes without
            return None

    def rows(records):
        waiting, size, compress = [], 0, None

        def begin():
            trained = dictionary(waiting)
            if trained is not None:
                body = zstandard.compress(trained.as_bytes())
                yield struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body
            return zstandard.ZstdCompressor(dict_data=trained, write_checksum=True, write_content_size=True).compress

        for r in records:
            if compress:
                yield compress(r)
                continue
            waiting.append(r)
            size += len(r)
            if len(waiting) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
                compress = yield from begin()
                yield from map(compress, waiting)
                waiting = []
        if waiting:
            compress = yield from begin()
            yield from map(compress, waiting)

    def records(batches):
        for batch in batches:
            for r in zip(*(batch.column(k) for k in range(6))):
                page_id, url, html, digest, first, revisit = (x.as_py() for x in r)
                yield record(page_id, url, html, digest, first, revisit, date)

    def run(batches):
        out, size = [], 0
        for frame in rows(records(batches)):
            out.append(frame + _LINE_FEED_FRAME)
            size += len(frame)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a record for each row of pages into archives below folder, about one for each
    spark.sql.adaptive.advisoryPartitionSizeInBytes of pages.

    The payload is the html in UTF-8, empty for null. Of equal payloads of at least LEAST_BYTES
    bytes the smallest page id is a response, others revisit it; repeated rows of that id are
    responses each. Null ids are never referred to. An empty table writes an empty folder.
    """
    html = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("digest"))
    long = F.octet_length("html") >= LEAST_BYTES
    firsts = keep(rows.where(long).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                  .where("n > 1 and first is not null").drop("n"), "firsts")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    planned = rows.join(firsts, "digest", "left").select("page_id", "url", "html", "digest", "first", revisit.alias("revisit"))
    (planned.hint("rebalance").mapInArrow(_archive(date), "value binary")
     .select(F.col("value").cast("string").alias("value")).write.option("lineSep", "\n").text(folder))


def frames(data: bytes):
    """(magic, body) of skippable frames and (magic, whole frame) of Zstandard frames, in order."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise ValueError("a frame header is cut off")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            end = at + 8 + size
            if end > len(data):
                raise ValueError("a skippable frame is cut off")
            yield magic, data[at + 8:end]
        elif magic == ZSTD_MAGIC:
            head = data[at:at + 18]
            end = at + zstandard.frame_header_size(head)
            last = False
            while not last:
                if end + 3 > len(data):
                    raise ValueError("a frame is cut off")
                block = int.from_bytes(data[end:end + 3], "little")
                last, kind, length = block & 1, block >> 1 & 3, block >> 3
                end += 3 + (1 if kind == 1 else length)
            end += 4 * zstandard.get_frame_parameters(head).has_checksum
            if end > len(data):
                raise ValueError("a frame is cut off")
            yield magic, data[at:end]
        else:
            raise ValueError(f"no frame begins with {magic:#x}")
        at = end


def parsed(raw: bytes) -> tuple[dict, bytes]:
    """Header and block of a record, or ValueError."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise ValueError(f"header line without colon: {line[:80]}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"{name} is missing")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"content-length is {n}, the record has {len(rest) - 4}")
    return fields, rest[:n]


def _checked(raw: bytes) -> tuple:
    fields, block = parsed(raw)
    if fields.get("warc-block-digest", "").removeprefix("sha256:") != hashlib.sha256(block).hexdigest():
        raise ValueError("the block digest differs")
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("the HTTP header does not end")
    sizes = [x.partition(":")[2] for x in http.decode("latin-1").split("\r\n") if x.lower().startswith("content-length:")]
    if len(sizes) != 1:
        raise ValueError("no single HTTP content-length")
    kind, digest = fields["warc-type"], fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response" and (len(payload) != int(sizes[0]) or digest != hashlib.sha256(payload).hexdigest()):
        raise ValueError("the payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("a revisit has no payload and refers to a record")
    refers = _page(fields["warc-refers-to"]) if kind == "revisit" else None
    return (_page(fields["warc-record-id"]), fields.get("warc-target-uri"), int(sizes[0]), digest, kind, refers,
            payload if kind == "response" else None, None)


def _read(with_payload: bool):
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "problem"]

    def found(data: bytes):
        decoder = zstandard.ZstdDecompressor()
        first = True
        try:
            for magic, body in frames(data):
                if magic == DICTIONARY_MAGIC and first:
                    raw = zstandard.decompress(body) if body[:4] == struct.pack("<I", ZSTD_MAGIC) else body
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
                elif magic == ZSTD_MAGIC:
                    try:
                        yield _checked(decoder.decompress(body))
                    except (ValueError, zstandard.ZstdError) as e:
                        yield (None,) * 7 + (str(e),)
                first = False
        except (ValueError, zstandard.ZstdError) as e:  # what follows cannot be found
            yield (None,) * 7 + (str(e),)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for r in found(content.as_py()):
                    rows.append(r if with_payload else (*r[:6], None, r[7]))
                    size += 200 + len(rows[-1][6] or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
    return run


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for each record below folder: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload (null for revisits) and problem.

    A leading dictionary frame is loaded first; each further frame must hold one whole record.
    Header fields, lengths and digests are checked; a bad record gives a row with only the problem, and
    so does what follows a broken frame.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInArrow(
        _read(with_payload), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                             "refers_to long, payload binary, problem string")


def round_trip(pages: DataFrame, with_payload: bool = False, **columns: str) -> DataFrame:
    """Write pages into archives in the shared folder and read them back."""
    folder = work_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, **columns)
    return read_archives(pages.sparkSession, folder, with_payload)
