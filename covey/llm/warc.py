"""WARC records in ZIP archives: written one archive per task, read by byte ranges.

An archive holds stored (uncompressed) members only: ``archive/data-N.warc.gz``, in which every
record is a gzip member of its own, and ``indexes/data-N.cdxj``, a line per record with its offset
and length. A reader parses the end record, the ZIP64 records where there are any, and the central
directory; finds where a member's bytes begin from its local header; and reads just the ranges of
the records it wants. Nothing is extracted.

Records of equal payloads are written once: the one with the largest page_id is a response, the
others are revisits that refer to it. Which they are is found from digests alone; html is never
shuffled, except that of pages which a bitmap of fixed size cannot rule out as revisits.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covey.llm import columns, files
from covey.llm.components import bitmap, passes
from covey.sources.shared import fresh_path, materialise

SMALLEST_REVISIT = 1000
RECORDS_PER_MEMBER = 4096
CAPTURED = "2020-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RANGE = 1 << 22


# --- records -------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record, not compressed. A revisit's block is the HTTP header without the payload."""
    digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Target-URI: {_uri(url)}",
        f"WARC-Payload-Digest: {digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    digits = (name or "")[len("<urn:page:") : -1]
    return int(digits) if digits else None


def _uri(url: str | None) -> str:
    """White space and control characters, which would end the line, are escaped."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "about:blank")


def parse(raw: bytes) -> dict:
    """A record's page_id, url, payload (None for a revisit), its size and digest, type, and the
    page it refers to. A payload that doesn't fit its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, v in (line.split(":", 1) for line in lines)}
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    sizes = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
    revisit = fields["warc-type"] == "revisit"
    if not revisit and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"payload of {fields['warc-record-id']} doesn't fit its digest")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "url": fields["warc-target-uri"],
        "record_type": fields["warc-type"],
        "payload_bytes": int(sizes[0]) if revisit else len(payload),
        "payload_digest": digest.hex(),
        "refers_to": _page(fields.get("warc-refers-to")),
        "payload": None if revisit else payload,
    }


# --- archives ------------------------------------------------------------------------------


class ArchiveWriter:
    """A ZIP archive of WARC members and their indexes, written front to back."""

    def __init__(self, out, records_per_member: int = RECORDS_PER_MEMBER):
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.most, self.members, self.n = records_per_member, 0, 0
        self.member, self.lines, self.at = None, [], 0

    def add(self, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> None:
        if self.member is None:
            self.member = self.zip.open(f"archive/data-{self.members:06d}.warc.gz", "w", force_zip64=True)
        data = gzip.compress(record(page_id, url, payload, refers_to), 6, mtime=0)
        self.member.write(data)
        self.lines.append(json.dumps({"page": page_id, "offset": self.at, "length": len(data)}))
        self.at += len(data)
        self.n += 1
        if len(self.lines) == self.most:
            self._end_member()

    def _end_member(self) -> None:
        self.member.close()
        index = "".join(x + "\n" for x in self.lines).encode()
        self.zip.writestr(f"indexes/data-{self.members:06d}.cdxj", index)
        self.member, self.lines, self.at, self.members = None, [], 0, self.members + 1

    def close(self) -> int:
        if self.member is not None:
            self._end_member()
        self.zip.close()
        return self.n


@dataclass
class Member:
    name: str
    stored: bool
    size: int
    header: int  # where its local header begins

    def start(self, source) -> int:
        """Where its bytes begin: the local header's own lengths count, not the directory's."""
        head = source.read_at(30, self.header)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"no local header of {self.name}")
        names, extra = struct.unpack_from("<HH", head, 26)
        return self.header + 30 + names + extra


def directory(source) -> list[Member]:
    """The members of an archive, from its central directory alone."""
    size = source.size()
    tail = source.read_at(min(size, 22 + 65535), max(0, size - 22 - 65535))
    end = len(tail)
    while True:  # the comment may hold the mark too: the right one's comment reaches the end
        end = tail.rfind(b"PK\x05\x06", 0, end)
        if end < 0:
            raise ValueError("not a ZIP archive")
        if end + 22 <= len(tail) and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] == len(tail):
            break
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if count == 0xFFFF or length == 0xFFFFFFFF or start == 0xFFFFFFFF:
        locator = source.read_at(20, size - len(tail) + end - 20)
        if locator[:4] == b"PK\x06\x07":
            record64 = source.read_at(56, struct.unpack_from("<Q", locator, 8)[0])
            if record64[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record where its locator says")
            count, length, start = struct.unpack_from("<QQQ", record64, 32)
    raw, at, out = source.read_at(length, start), 0, []
    for _ in range(count):
        if raw[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is damaged")
        method, packed, full, names, extra, comment = struct.unpack_from("<10xH8xIIHHH", raw, at)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + names].decode()
        more, end = at + 46 + names, at + 46 + names + extra
        while more + 4 <= end:
            kind, width = struct.unpack_from("<HH", raw, more)
            if kind == 1:  # 64-bit values, only of the fields that are full, in this order
                values = iter(struct.unpack_from(f"<{width // 8}Q", raw, more + 4))
                full = next(values) if full == 0xFFFFFFFF else full
                packed = next(values) if packed == 0xFFFFFFFF else packed
                header = next(values) if header == 0xFFFFFFFF else header
            more += 4 + width
        out.append(Member(name, method == 0, packed, header))
        at = end + comment
    return out


def records(uri: str) -> Iterator[dict]:
    """All records of an archive: its indexes are read, then neighbouring records in one range."""
    with files.open_random(uri) as source:
        members = {m.name: m for m in directory(source)}
        for name in sorted(n for n in members if n.startswith("indexes/")):
            index, data = members[name], members[name.replace("indexes/", "archive/").replace(".cdxj", ".warc.gz")]
            if not (index.stored and data.stored):
                raise ValueError(f"{data.name} is not stored, so its records can't be read by range")
            lines = source.read_at(index.size, index.start(source)).splitlines()
            start = data.start(source)
            spots = [(x["offset"], x["length"]) for x in map(json.loads, lines)]
            i = 0
            while i < len(spots):
                j, first = i, spots[i][0]
                while j < len(spots) and (j == i or sum(spots[j]) - first <= _RANGE):
                    j += 1
                raw = source.read_at(sum(spots[j - 1]) - first, start + first)
                for offset, length in spots[i:j]:
                    yield parse(zlib.decompress(raw[offset - first : offset - first + length], 31))
                i = j


# --- tables --------------------------------------------------------------------------------


def revisits(pages: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """``page_id, digest, refers_to`` of the pages whose payload another page of larger id has."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    facts = pages.select("page_id", F.sha1(payload).alias("digest"), F.length(payload).alias("n")).filter(
        F.col("n") >= smallest
    )
    keep = facts.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
    return (
        facts.join(keep.filter("copies > 1"), ["digest", "n"])
        .filter("page_id < refers_to")
        .select("page_id", "digest", "refers_to")
        .distinct()
    )


def write(pages: DataFrame, folder: str, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """Write a record for every row of ``pages``; the manifest ``uri, n_records`` lists the
    archives. A null html is an empty payload, a null url ``about:blank``. Pages that tie for the
    largest page_id of a payload are all responses, as is every page without page_id."""
    refs = materialise(revisits(pages, smallest), "warc-revisits")
    maybe = bitmap(refs, "page_id")

    def possible(batch: pa.RecordBatch) -> pa.Array:
        ids = batch.column("page_id")
        hit = passes(maybe.value, ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)
        return pa.array(hit)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in columns.texts(batches, "html"):
            known = "refers_to" in batch.schema.names
            if not known:
                batch = batch.filter(pa.compute.invert(possible(batch)))
            refer = batch.column("refers_to").to_pylist() if known else [None] * batch.num_rows
            ids, urls, htmls = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
            for page_id, url, html, other in zip(ids, urls, htmls, refer, strict=True):
                if archive is None:
                    uri, out = files.create(folder, f"pages-{TaskContext.get().partitionId():06d}")
                    archive = ArchiveWriter(out)
                archive.add(page_id, url, (html or "").encode(), other)
        if archive:
            n = archive.close()
            out.close()
            yield pa.record_batch({"uri": [uri], "n_records": [n]})

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(possible(batch))

    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    kind = "uri string, n_records long"
    straight = plain.mapInArrow(put, kind)
    digest = F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    rest = plain.mapInArrow(pick, "page_id long, url string, html string").withColumn("digest", digest)
    joined = rest.join(refs, ["page_id", "digest"], "left").select("page_id", "url", "html", "refers_to")
    return materialise(straight.unionByName(joined.mapInArrow(put, kind)), "warc-manifest")


_READ = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def read(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """A row for every record of the archives: page_id, url, record_type, payload_bytes,
    payload_digest (hexadecimal SHA-1), refers_to and, for responses, the payload."""
    schema = _READ + ", payload binary" * with_payload
    names = [x.split()[0] for x in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                held, size = [], 0
                for row in records(uri):
                    held.append(row)
                    size += len(row["payload"] or b"") if with_payload else 0
                    if size > 1 << 22 or len(held) >= 1 << 12:
                        yield rows_of(held)
                        held, size = [], 0
                if held:
                    yield rows_of(held)

    def rows_of(held: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([h[n] for h in held], t) for n, t in zip(names, types, strict=False)], names)

    spread = manifest.select("uri").repartition(max(1, manifest.count()), "uri")
    return spread.mapInArrow(get, schema)


def folder(spark) -> str:
    return fresh_path(spark, "warc")
