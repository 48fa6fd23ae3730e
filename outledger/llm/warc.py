"""WARC archives: writing with segments and chunked framing, reading with reassembly."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from outledger.llm import frames

END = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---------------------------------------------------------------- framing


def chunked(payload: bytes, size: int) -> bytes:
    """HTTP chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(payload[k : k + size]), payload[k : k + size]) for k in range(0, len(payload), size)]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        stop = body.index(END, at)
        size = int(body[at:stop].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        parts.append(body[stop + 2 : stop + 2 + size])
        at = stop + 2 + size
        if body[at : at + 2] != END or len(parts[-1]) != size:
            raise ValueError("chunk without its end")
        at += 2


def record(headers: dict[str, object], block: bytes) -> bytes:
    """A record without the two line ends that follow it: the writer puts these."""
    lines = [f"{k}: {v}" for k, v in headers.items() if v is not None]
    head = "\r\n".join(["WARC/1.1", *lines, f"Content-Length: {len(block)}"])
    return head.encode("utf-8") + 2 * END + block


def records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a byte stream; an error where the stream ends inside one."""
    held, at, headers, begin, end = bytearray(), 0, None, 0, 0
    for piece in pieces:
        held += piece
        while True:
            if headers is None:
                stop = held.find(2 * END, at)
                if stop < 0:
                    break
                headers = _headers(bytes(held[at:stop]))
                begin = stop + 4
                end = begin + int(headers["content-length"])
            if end + 4 > len(held):
                break
            yield headers, bytes(held[begin:end])
            at, headers = end + 4, None
        # What has been read goes at once, so that a long record is copied once.
        del held[:at]
        begin, end, at = begin - at, end - at, 0
    if headers is not None and end <= len(held) and not held[end:].strip():
        yield headers, bytes(held[begin:end])
    elif headers is not None or held.strip():
        raise ValueError("archive ends inside a record")


def _headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
    if not lines[0].startswith(("WARC/", "HTTP/")):
        raise ValueError(f"no record at {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def inflated(content: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """All members of a gzip file in pieces, one after the other; other content as it is.

    Archives usually have one member per record. A file that ends inside a member is an error; zeros
    behind the last one are padding.
    """
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    stream = None
    for k in range(0, len(content), step):
        piece = content[k : k + step]
        while piece:
            if stream is None:
                piece = piece.lstrip(b"\0")
                if not piece:
                    break
                stream = zlib.decompressobj(31)
            yield stream.decompress(piece)
            piece = stream.unused_data if stream.eof else b""
            if stream.eof:
                stream = None
    if stream is not None:
        raise ValueError("archive ends inside a gzip member")


# ---------------------------------------------------------------- writing


def page_records(page, url, payload, digest, first, group, date, segment_bytes, chunk_bytes) -> Iterator[bytes]:
    """The record of a page, or its first segment and continuations."""
    name = f"<urn:page:{'' if page is None else page}>"
    headers = {
        "WARC-Type": "response" if first is None else "revisit",
        "WARC-Record-ID": name,
        "WARC-Date": date,
        "WARC-Target-URI": " ".join(url.split()) if url else None,
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    status = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if first is not None:
        headers |= {"WARC-Refers-To": f"<urn:page:{first}>", "WARC-Profile": REVISIT_PROFILE}
        yield record(headers, status + b"Content-Length: %d\r\n\r\n" % len(payload))
        return
    block = status + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk_bytes)
    if len(block) <= segment_bytes:
        yield record(headers, block)
        return
    cuts = range(0, len(block), segment_bytes)
    for number, k in enumerate(cuts, 1):
        part = block[k : k + segment_bytes]
        own = {"WARC-Segment-Number": number, "WARC-Segment-Set": group}
        if number == 1:
            yield record(headers | own, part)
            continue
        total = len(block) if number == len(cuts) else None
        yield record(
            {"WARC-Type": "continuation", "WARC-Record-ID": f"<urn:page:{page}:{group}:{number}>", "WARC-Date": date}
            | own | {"WARC-Segment-Origin-ID": name, "WARC-Segment-Total-Length": total},
            part,
        )


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_revisit: int = 100,
    date: str = "2024-01-01T00:00:00Z",
    segment_bytes: int = 1 << 15,
    chunk_bytes: int = 1 << 13,
    records_per_file: int = 10_000,
) -> None:
    """One record per row. Equal payloads of `least_revisit` bytes or more are written once.

    The response is the row with the smallest id; rows with that same id are responses too. Rows
    with a NULL id never stand for others, and revisit where an equal payload has an id.
    """
    named = (
        frames.pick(pages, page=id_col, url=url_col, html=html_col)
        .withColumn("page", F.col("page").cast("long"))
        .withColumn("payload", F.coalesce("html", F.lit("")).cast("binary")).drop("html")
        .withColumn("digest", F.sha2("payload", 256))
    )
    several = frames.stored(
        named.filter(F.octet_length("payload") >= least_revisit)
        .groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null").select("digest", "first"),
        "equal-payloads",
    )
    first = F.when(F.col("page").eqNullSafe(F.col("first")), None).otherwise(F.col("first"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            done = []
            for page, url, payload, digest, before in batch.itertuples(index=False):
                number += 1
                done += page_records(
                    _whole(page), url, payload, digest, _whole(before), f"{task}-{number}", date, segment_bytes, chunk_bytes
                )
            yield pd.DataFrame({"record": done})

    (
        named.join(several, "digest", "left")
        .select("page", "url", "payload", "digest", first.alias("first"))
        .mapInPandas(run, "record binary")
        .select(F.col("record").cast("string"))
        .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
        .option("maxRecordsPerFile", records_per_file).text(folder)
    )


def _whole(x) -> int | None:
    return None if pd.isna(x) else int(x)


# ---------------------------------------------------------------- reading


#: Types that are read; others (about the crawl, requests) are passed by.
READ = {"response", "revisit", "resource"}
DIGESTS = {"sha256", "sha1", "md5", "sha512"}


def _page(urn: str | None) -> int | None:
    """The page id in a name of this writer; other names have none."""
    tail = (urn or "").removeprefix("<urn:page:").rstrip(">")
    return int(tail) if urn and urn.startswith("<urn:page:") and tail else None


def _is_digest(claimed: str, *contents: bytes) -> bool:
    """Whether a labelled digest, in hex or base32, is that of one of the contents; unknown kinds pass."""
    kind, _, value = claimed.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in DIGESTS:
        return True
    for content in contents:
        found = hashlib.new(kind, content).digest()
        if value.strip().lower() == found.hex() or value.strip().upper().rstrip("=") == base64.b32encode(found).decode().rstrip("="):
            return True
    return False


def _settled(headers: dict[str, str], block: bytes) -> dict[str, object]:
    """A whole record's row: HTTP head apart, chunked framing decoded, digest verified."""
    http, body = {}, block
    if block.startswith(b"HTTP/"):
        head, _, body = block.partition(2 * END)
        http = _headers(head)
    claimed = headers.get("warc-payload-digest")
    row = {
        "page_id": _page(headers["warc-record-id"]), "url": headers.get("warc-target-uri"),
        "record_type": headers["warc-type"], "refers_to": _page(headers.get("warc-refers-to")),
        "record_id": headers["warc-record-id"], "refers_to_id": headers.get("warc-refers-to"),
    }
    if row["record_type"] == "revisit":
        length = http.get("content-length", "")
        return row | {
            "payload_digest": claimed and claimed.removeprefix("sha256:"),
            "payload_bytes": int(length) if length.isdigit() else None, "payload": None,
        }
    payload = unchunked(body) if http.get("transfer-encoding", "").lower() == "chunked" else body
    # Writers digest the payload with or without its transfer framing.
    if claimed and not _is_digest(claimed, payload, body):
        raise ValueError(f"payload of {headers['warc-record-id']} has another digest")
    return row | {
        "payload_digest": hashlib.sha256(payload).hexdigest(), "payload_bytes": len(payload), "payload": payload,
    }


COLUMNS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, record_id string, refers_to_id string, payload binary"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def _frame(rows: list[dict], with_payload: bool) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=NAMES, dtype=object)
    for name in ("page_id", "payload_bytes", "refers_to"):
        out[name] = out[name].astype("Int64")
    if not with_payload:
        out["payload"] = None
    return out


def read_archive(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per response, revisit and resource of the archives in a folder, of any writer.

    page_id, url, payload_bytes, payload_digest (sha256, hex), record_type, refers_to, record_id,
    refers_to_id, payload. Records of other types are passed by. Records are parsed as a stream, from
    plain files and from gzip files with any number of members; a truncated file, or one that isn't an
    archive, fails the read. Segments go on by origin identifier (and by set, where the writer names
    one): ordered by segment number they must be complete and as long as the total length says. Digests
    of known kinds are verified. A revisit has no payload of its own (NULL): its digest is the one it
    claims, its length that of its HTTP head (NULL without one). page_id and refers_to are set for names
    of this module's writer. An empty folder gives no rows.
    """

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = []
                for headers, block in records(inflated(content)):
                    if headers["warc-type"] not in READ and "warc-segment-number" not in headers:
                        continue
                    if "warc-segment-number" not in headers:
                        rows.append(_settled(headers, block))
                        if not with_payload:
                            rows[-1]["payload"] = None
                    else:
                        rows.append({
                            "origin": headers.get("warc-segment-origin-id", headers["warc-record-id"]),
                            "set": headers.get("warc-segment-set"),
                            "number": int(headers["warc-segment-number"]),
                            "total": headers.get("warc-segment-total-length"),
                            "headers": "\n".join(f"{k}:{v}" for k, v in headers.items()),
                            "payload": block,
                        })
                    if len(rows) >= 2000:
                        yield table(rows)
                        rows = []
                yield table(rows)

    segment = ", origin string, set string, number long, total long, headers string"

    def table(rows: list[dict]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=[*NAMES, "origin", "set", "number", "total", "headers"], dtype=object)
        for name in ("page_id", "payload_bytes", "refers_to", "number", "total"):
            out[name] = pd.to_numeric(out[name]).astype("Int64")
        return out

    def assemble(segments: pd.DataFrame) -> pd.DataFrame:
        ordered = segments.sort_values("number")
        block, total = b"".join(ordered["payload"]), ordered["total"].iloc[-1]
        name = ordered["origin"].iloc[0]
        if ordered["number"].tolist() != list(range(1, len(ordered) + 1)):
            raise ValueError(f"segments of {name} are missing")
        if pd.isna(total) or int(total) != len(block):
            raise ValueError(f"segments of {name} have {len(block)} bytes instead of {total}")
        headers = dict(x.split(":", 1) for x in ordered["headers"].iloc[0].split("\n"))
        return _frame([_settled(headers, block)] if headers["warc-type"] in READ else [], with_payload)

    files = spark.read.format("binaryFile").load(folder).select("content")
    parsed = frames.stored(files.mapInPandas(parse, COLUMNS + segment), "warc-records")
    whole = parsed.filter("number is null").select(*NAMES)
    # A group is the segments of one record.
    joined = parsed.filter("number is not null").groupBy("origin", "set").applyInPandas(assemble, COLUMNS)
    return whole.unionByName(joined)


def archive_round_trip(pages: DataFrame, folder: str, **columns: str) -> DataFrame:
    """Write `pages` to `folder` and read it back: the rows of read_archive without payloads.

    A NULL html is an empty payload. NULL urls give no target URI; NULL ids stay NULL and get a
    record each, as do repeated rows; an empty table gives no rows; other columns are not read. Ids
    must be whole numbers.
    """
    write_archive(pages, folder, **columns)
    return read_archive(pages.sparkSession, folder, with_payload=False).drop("payload")
