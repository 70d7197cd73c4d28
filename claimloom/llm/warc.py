"""WARC archives: an index of byte ranges first, then coalesced reads of the selected records.

Writing tasks compress each record as its own gzip member and return its file, offset, length, URL
and digest; that index is what Spark commits. A task that is tried again writes files of new
names, so only files of successful attempts are ever referred to. Reading sorts the selected
index rows by file and offset, joins near ranges into one read, and parses the members.
"""

from __future__ import annotations

import base64
import hashlib
import math
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimloom.llm.shared import saved
from claimloom.sources.shared import new_folder

#: Compressed bytes at which a new archive begins.
ARCHIVE_BYTES = 64 << 20
#: Ranges this close are read together, up to so many bytes at once.
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20
#: Compressed bytes that a reading task is meant for.
TASK_BYTES = 16 << 20
#: Payloads of fewer bytes are never revisits.
MIN_BYTES = 0

# Fixed values of the format.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
GZIP = 16 + zlib.MAX_WBITS


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _header(text: str | None) -> str:
    """A value that can't end its line."""
    return (text or "").replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, revisit_of: int | None) -> bytes:
    """One uncompressed record; a revisit has the HTTP header only."""
    block = HTTP if revisit_of is not None else HTTP + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if revisit_of is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_header(url)}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit_of is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(revisit_of)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """What a record says; the digest and length of a response are taken from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])

    def page(name: str) -> int | None:
        number = name.removeprefix("<urn:page:").removesuffix(">")
        return None if number == "none" else int(number)

    out = {
        "page_id": page(fields["WARC-Record-ID"]),
        "payload_bytes": int(fields["X-Payload-Length"]),
        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": fields["WARC-Type"],
        "refers_to": None,
        "url": fields["WARC-Target-URI"],
        "payload": None,
    }
    if out["record_type"] == "revisit":
        out["refers_to"] = page(fields["WARC-Refers-To"])
    else:
        payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        out |= {"payload_bytes": len(payload), "payload_digest": payload_digest(payload), "payload": payload}
    return out


INDEX = "file string, offset long, length long, url string, digest string, record_type string"


def _writer(folder: str, archive_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        stream, name, at = None, "", 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                index = []
                for row in batch.slice(begin, 256).to_pylist():
                    if stream is None or at >= archive_bytes:
                        if stream is not None:
                            stream.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        stream = system.open_output_stream(f"{root}/{name}", compression=None)
                    payload = (row["html"] or "").encode()
                    raw = record(row["page_id"], row["url"], payload, row["revisit_of"])
                    packer = zlib.compressobj(wbits=GZIP)
                    member = packer.compress(raw) + packer.flush()
                    stream.write(member)
                    index.append(
                        (
                            name, at, len(member), row["url"], payload_digest(payload),
                            "response" if row["revisit_of"] is None else "revisit",
                        )
                    )
                    at += len(member)
                names = [field.split()[0] for field in INDEX.split(", ")]
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*index), kinds)], names=names
                )
        if stream is not None:
            stream.close()

    return run


def write_warc(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archives in ``folder`` (a shared one), and their index as a stored table.

    Of rows with equal payloads of ``min_bytes`` or more, those of the least identifier are
    responses and the others revisit it; smaller payloads are responses. NULL payloads are empty.
    A NULL identifier is never the least one and is a response where the group has no other.
    Repeated rows are written each. An empty table gives an empty index. Other columns are not
    read.
    """
    narrow = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
        F.sha1(F.coalesce(F.col(html_col).cast("string"), F.lit(""))).alias("sha1"),
    )
    # Stored, so that its size is known: where it is small it is broadcast and no page moves.
    repeated = saved(
        narrow.where(F.coalesce(F.octet_length("html"), F.lit(0)) >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .select("sha1", "first_id"),
        "repeated",
    )
    revisit_of = F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    typed = narrow.join(repeated, "sha1", "left").select(
        "page_id", "url", "html", revisit_of.alias("revisit_of")
    )
    return saved(typed.mapInArrow(_writer(folder, archive_bytes), INDEX), "index")


RECORD = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " url string"
)


def _reader(folder: str, gap: int, most: int, payloads: bool):
    names = [field.split()[0] for field in RECORD.split(", ")] + ["payload"] * payloads
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def ranges(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
        held: list[tuple] = []
        for row in rows:
            if held and not (
                row[0] == held[-1][0]
                and row[1] - held[-1][1] - held[-1][2] <= gap
                and row[1] + row[2] - held[0][1] <= most
            ):
                yield held
                held = []
            held.append(row)
        if held:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        name, source = None, None
        for held in ranges(rows):
            if held[0][0] != name:
                if source is not None:
                    source.close()
                name = held[0][0]
                source = system.open_input_file(f"{root}/{name}")
            begin = held[0][1]
            data = source.read_at(held[-1][1] + held[-1][2] - begin, begin)
            found = [parse(zlib.decompress(data[a - begin : a - begin + n], GZIP)) for _, a, n in held]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[n] for r in found], k) for n, k in zip(names, kinds)], names=names
            )
        if source is not None:
            source.close()

    return run


def read_warc(
    index: DataFrame,
    folder: str,
    *,
    gap_bytes: int = GAP_BYTES,
    read_bytes: int = READ_BYTES,
    payloads: bool = False,
) -> DataFrame:
    """The records of the index rows given, with ``payload`` (responses) where asked for.

    A task reads the shares of whole archives in offset order, about ``TASK_BYTES`` in all; a read
    is ``read_bytes`` or one record. Tasks follow from the bytes to read: the index rows are too
    small to tell.
    """
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, math.ceil(total / TASK_BYTES))
    dealt = index.select("file", "offset", "length").repartition(tasks, "file")
    ordered = dealt.sortWithinPartitions("file", "offset")
    schema = RECORD + ", payload binary" * payloads
    return ordered.mapInArrow(_reader(folder, gap_bytes, read_bytes, payloads), schema)


def archived_pages(pages: DataFrame, **names) -> DataFrame:
    """Pages written to archives in the shared folder and read back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_warc(write_warc(pages, folder, **names), folder)
