"""WARC records in ZIP-packaged archives: written, then read back by range without extraction.

An archive is a ZIP file with two stored members, ``archive/data.warc.gz`` (one gzip member for each
record) and ``indexes/index.cdxj`` (one line for each record: offset and length in the archive member).
The reader parses the central directory, ZIP64 forms included, locates all stored archive members and all
indexes by their names, wherever they lie, and reads single records by their range. Indexes may be compressed;
archive members that no index lists are read from end to end, record by record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import os
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from itertools import chain
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tessera.llm.shared import own_columns, shared_folder, stored

GZIP = b"\x1f\x8b"
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
ARCHIVES, INDEXES = (".warc.gz", ".warc"), (".cdxj", ".cdx", ".cdxj.gz", ".cdx.gz")
ARCHIVE_BYTES, BLOCK = 16 << 20, 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Storage: local paths directly, any other scheme by pyarrow's file systems.


def _place(uri: str):
    if uri.startswith("file:"):
        return None, "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return None, uri
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _put(uri: str, write) -> None:
    store, path = _place(uri)
    if store is not None:
        with store.open_output_stream(path) as out:
            write(out)
        return
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        write(out)


def _open(uri: str) -> BinaryIO:
    store, path = _place(uri)
    return open(path, "rb") if store is None else store.open_input_file(path)


# Records


def name_of(page: str | None) -> str:
    """A record's name for an id, whatever characters that has."""
    return "<urn:nothing>" if page is None else f"<urn:page:{quote(page, safe='')}>"


def page_of(name: str) -> str | None:
    return unquote(name[len("<urn:page:") : -1]) if name.startswith("<urn:page:") else None


def record(kind: str, page: str | None, url: str, payload: bytes, sha1: str, refers_to: str | None) -> bytes:
    """One record as a gzip member. A revisit has the HTTP header, with the payload's length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": name_of(page),
        "WARC-Target-URI": url.replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Payload-Digest": f"sha1:{sha1}",
    }
    if kind == "revisit":
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": name_of(refers_to)}
    head |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n"
    coder = zlib.compressobj(1, zlib.DEFLATED, 31)
    return coder.compress(text.encode() + block + b"\r\n\r\n") + coder.flush()


def parse(member: bytes) -> dict:
    """Fields, HTTP length and payload of one record, a gzip member or plain."""
    raw = zlib.decompress(member, 47) if member[:2] == GZIP else member
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if len(block) < int(fields["Content-Length"]):
        raise ValueError("record cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return fields | {"payload": payload, "length": length}


# ZIP


def write_zip(out: BinaryIO, data: bytes, index: bytes, zip64: bool = False) -> None:
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, content in ((DATA, data), (INDEX, index)):
            info = zipfile.ZipInfo(name)
            with z.open(info, "w", force_zip64=zip64) as member:
                member.write(content)


def _range(file: BinaryIO, start: int, size: int) -> bytes:
    file.seek(start)
    got = file.read(size)
    if len(got) != size:
        raise ValueError("archive cut short")
    return got


def directory(file: BinaryIO) -> dict[str, tuple[int, int, int]]:
    """Start, size and method (0: stored) of every member, from the central directory and its ZIP64 forms."""
    size = file.seek(0, io.SEEK_END)
    tail_at = max(0, size - 65557)
    tail = _range(file, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        (where,) = struct.unpack_from("<Q", tail, end - 12)
        wide = _range(file, where, 56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", wide, 32)
    entries, at, found = _range(file, start, length), 0, {}
    for _ in range(count):
        if entries[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", entries, at + 8)
        packed, full, n, extra, comment = struct.unpack_from("<IIHHH", entries, at + 20)
        (header,) = struct.unpack_from("<I", entries, at + 42)
        name = entries[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        fields = entries[at + 46 + n : at + 46 + n + extra]
        full, packed, header = _wide_values(fields, full, packed, header)
        local = _range(file, header, 30)
        found[name] = (header + 30 + sum(struct.unpack_from("<HH", local, 26)), packed, method)
        at += 46 + n + extra + comment
    return found


def _wide_values(fields: bytes, *values: int) -> list[int]:
    """32-bit values, those that are all ones taken from the ZIP64 extra field in order."""
    at, wide = 0, b""
    while at + 4 <= len(fields):
        kind, size = struct.unpack_from("<HH", fields, at)
        if kind == 1:
            wide = fields[at + 4 : at + 4 + size]
        at += 4 + size
    out, taken = [], 0
    for v in values:
        if v == 0xFFFFFFFF:
            (v,) = struct.unpack_from("<Q", wide, taken)
            taken += 8
        out.append(v)
    return out


def _blocks(file: BinaryIO, start: int, size: int) -> Iterator[bytes]:
    for at in range(start, start + size, BLOCK):
        yield _range(file, at, min(BLOCK, start + size - at))


def _inflated(blocks: Iterator[bytes], bits: int) -> Iterator[bytes]:
    """What compressed members, one behind the other, hold; ``bits`` as zlib has them."""
    coder = zlib.decompressobj(bits)
    for block in blocks:
        while block:
            yield coder.decompress(block)
            block = coder.unused_data
            if coder.eof:
                coder = zlib.decompressobj(bits)


def _lines(file: BinaryIO, member: tuple[int, int, int]) -> Iterator[str]:
    """Lines of an index, which ZIP, gzip or both may have compressed."""
    start, size, method = member
    blocks = _blocks(file, start, size)
    if method:
        blocks = _inflated(blocks, -15)
    rest, coded = b"", None
    first = next((b for b in blocks if b), b"")
    blocks = chain([first], blocks)
    coded = _inflated(blocks, 47) if first[:2] == GZIP else blocks
    for block in coded:
        *full, rest = (rest + block).split(b"\n")
        yield from (x.decode() for x in full if x.strip())
    if rest.strip():
        yield rest.decode()


def _scanned(file: BinaryIO, start: int, size: int) -> Iterator[bytes]:
    """Records of an archive member in their order: gzip members, or plain ones by their lengths."""
    at = start
    while at < start + size:
        if _range(file, at, min(2, start + size - at)) == GZIP:
            coder, parts = zlib.decompressobj(47), []
            for block in _blocks(file, at, start + size - at):
                parts.append(coder.decompress(block))
                at += len(block) - len(coder.unused_data)
                if coder.eof:
                    break
            else:
                raise ValueError("record cut short")
            yield b"".join(parts)
        else:
            head, known = b"", -1
            for block in _blocks(file, at, start + size - at):
                head += block
                if (known := head.find(b"\r\n\r\n")) >= 0:
                    break
            length = next((int(x.split(b":")[1]) for x in head[: max(known, 0)].split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
            if length is None:
                raise ValueError("not a WARC record")
            n = known + 4 + length
            yield _range(file, at, n)
            at += n + 4  # and two line breaks


def read_archive(file: BinaryIO) -> Iterator[dict]:
    """Every record of a package's archive members: those that an index lists by their ranges, the others' one after another.

    An index entry names its archive member by ``filename``, as its last part; that may lack if there is one only.
    """
    members = directory(file)
    archives = {n: m for n, m in members.items() if n.lower().endswith(ARCHIVES)}
    if packed := [n for n, m in archives.items() if m[2]]:
        raise ValueError(f"not stored, so no range can be read: {packed[0]}")
    short, listed = {n.rsplit("/", 1)[-1]: n for n in archives}, set()
    for index in sorted(n for n in members if n.lower().endswith(INDEXES)):
        for line in _lines(file, members[index]):
            entry = json.loads(line[line.index("{") :])
            named = entry.get("filename", "").rsplit("/", 1)[-1]
            name = short.get(named) or (next(iter(archives)) if not named and len(archives) == 1 else None)
            if name is None:
                raise ValueError(f"the index names no archive member: {line[:200]}")
            (start, size, _), at, n = archives[name], int(entry["offset"]), int(entry["length"])
            if at + n > size:
                raise ValueError("index beyond the archive member")
            listed.add(name)
            yield parse(_range(file, start + at, n))
    for name in sorted(set(archives) - listed):
        yield from map(parse, _scanned(file, *archives[name][:2]))


# Operators


def write_archives(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Writes a record for each page; returns archive, n_records.

    Of pages whose payloads (UTF-8, null: empty) are equal and have at least ``least`` bytes, the one with
    the smallest id is a response, the others are revisits that refer to it; smaller payloads are all
    responses. Rows that repeat that id and payload are responses as well. A null id never is the
    smallest unless all are null. Columns beyond the three are not read.
    """
    own_columns(pages, page_id, url, html)
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).cast("string").alias("page"), F.col(page_id).alias("id"), F.coalesce(F.col(url), F.lit("")).alias("url"), body.alias("body"))
    rows = rows.withColumn("sha1", F.sha1("body"))
    # Stored, so that both sides of the join are dealt anew and a payload with very many rows can be split.
    firsts = stored(rows.groupBy("sha1").agg(F.min("id").alias("first")))
    rows = rows.join(firsts, "sha1")
    small = F.octet_length("body") < least
    refers = F.when(~small & ~F.col("id").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    rows = rows.select("page", "url", "body", "sha1", refers.alias("refers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, index = io.BytesIO(), []

        def flush() -> pa.RecordBatch:
            at = f"{folder}/{uuid.uuid4().hex}.wacz"
            lines = "".join(x + "\n" for x in sorted(index)).encode()
            _put(at, lambda out: write_zip(out, data.getvalue(), lines))
            done = pa.RecordBatch.from_pydict({"archive": [at], "n_records": [len(index)]})
            data.seek(0)
            data.truncate()
            index.clear()
            return done

        for batch in batches:
            for page, url_, text, sha1, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                name = base64.b32encode(bytes.fromhex(sha1)).decode()
                one = record("response" if refers_to is None else "revisit", page, url_, text.encode(), name, refers_to)
                entry = {"url": url_, "digest": f"sha1:{name}", "filename": DATA.rsplit("/", 1)[-1], "offset": str(data.tell()), "length": str(len(one))}
                index.append(f"{quote(page or '', safe='')} 19700101000000 {json.dumps(entry)}")
                data.write(one)
                if data.tell() >= ARCHIVE_BYTES:
                    yield flush()
        if index:
            yield flush()

    return rows.mapInArrow(run, "archive string, n_records bigint")


def read_archives(archives: DataFrame, page_id: str = "page_id", with_payload: bool = False, whole: bool = True) -> DataFrame:
    """Reads archives (column ``archive``) record by record; ids come back as long, or, if not ``whole``, as strings."""
    kind = "bigint" if whole else "string"
    schema = f"`{page_id}` {kind}, payload_bytes bigint, payload_digest string, record_type string, refers_to {kind}, url string"
    schema += ", payload binary" * with_payload

    def number(name: str) -> int | str | None:
        page = page_of(name)
        return int(page) if whole and page is not None else page

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            names = [page_id, "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
            id_ = pa.int64() if whole else pa.string()
            types = [id_, pa.int64(), pa.string(), pa.string(), id_, pa.string(), pa.binary()]
            columns = zip(names, types, zip(*rows, strict=True), strict=False)
            return pa.RecordBatch.from_pydict({n: pa.array(c, t) for n, t, c in columns})

        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows = []
                with _open(uri) as file:
                    for r in read_archive(file):
                        sha1, kind = r["WARC-Payload-Digest"].removeprefix("sha1:"), r["WARC-Type"]
                        if kind == "response" and (sha1 != digest(r["payload"]) or r["length"] != len(r["payload"])):
                            raise ValueError(f"payload of {r['WARC-Record-ID']} is damaged")
                        row = (number(r["WARC-Record-ID"]), r["length"], sha1, kind, number(r.get("WARC-Refers-To", "")), r["WARC-Target-URI"])
                        rows.append((*row, r["payload"]) if with_payload else row)
                        if len(rows) == 500:
                            yield flush(rows)
                            rows = []
                if rows:
                    yield flush(rows)

    return archives.select("archive").mapInArrow(run, schema)


def round_trip(pages: DataFrame, **names: str) -> DataFrame:
    """Writes archives to the shared folder and reads them back; one row for each page.

    Ids that aren't whole numbers come back as strings. A page may have any length below 2 GB; an empty table has
    no archive. The list of archives is stored before it is read: a task that runs twice leaves a file that no list names.
    """
    spark = pages.sparkSession
    archives = stored(write_archives(pages, shared_folder(spark), **names))
    key = names.get("page_id", "page_id")
    whole = isinstance(pages.schema[key].dataType, IntegralType)
    return read_archives(archives.repartition(max(1, archives.count())), key, whole=whole)
