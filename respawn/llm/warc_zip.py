"""WARC records in ZIP packages: a writer, and a reader that fetches records by byte range.

Layout of a package: ``archive/data.warc.gz`` (one gzip member a record, so each can be read
alone), ``indexes/index.cdxj`` (offset and length of each record) and ``datapackage.json``, all
stored without compression.

The reader never extracts: it reads the end record of the central directory, follows the ZIP64
locator where there is one, parses the directory, finds where each stored member's bytes begin,
reads the index member, and then reads each record's bytes by range. A package without an index
is walked through its WARC members instead. Files are opened through ``pyarrow.fs``, so any store
it knows will do; paths must be visible to all executors.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respawn.llm.common import scratch, stored, tasks

WARC_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
#: Payloads below this many bytes are never written as revisits.
REVISIT_BYTES = 100
#: Bytes fetched at once when neighbouring records are read.
FETCH = 1 << 22
DATE = "2024-01-01T00:00:00Z"
_BLANK = re.compile(r"[\s\x00-\x20{]")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# -- records --------------------------------------------------------------------------------

def record_id(page_id) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def warc_record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record; a revisit carries the HTTP headers but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    lines += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload, the HTTP headers taken off."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    block = rest[:int(fields["content-length"])]
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    return fields, payload


# -- ZIP directories ---------------------------------------------------------------------------

@dataclass
class Member:
    name: str
    method: int
    size: int
    header: int  # where the local header begins


def read_directory(file, size: int) -> list[Member]:
    """The members of the ZIP file, from its central directory (ZIP64 or not)."""
    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = file.read_at(size - tail_at, tail_at)
    def is_end(at: int) -> bool:
        """Its comment fills the file, and the directory (or the ZIP64 locator) stands right before it."""
        if len(tail) - at < 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail):
            return False
        length, start = struct.unpack_from("<II", tail, at + 12)
        return start + length == tail_at + at or at >= 20 and tail[at - 20:at - 16] == b"PK\6\7"

    end = tail.rfind(b"PK\5\6")
    while end >= 0 and not is_end(end):
        end = tail.rfind(b"PK\5\6", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20:end - 16] == b"PK\6\7":
        at = struct.unpack_from("<Q", tail, end - 12)[0]
        record = file.read_at(56, at)
        if record[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory, members, at = file.read_at(length, start), [], 0
    for _ in range(count):
        sig, flags, method, packed, plain, n_name, n_extra, n_comment, header = struct.unpack_from("<4s4xHH8xIIHHH8xI", directory, at)
        if sig != b"PK\1\2":
            raise ValueError("broken central directory")
        name = directory[at + 46:at + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n_name:at + 46 + n_name + n_extra]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:  # ZIP64: only the fields that don't fit, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, 4))
                plain = wide.pop(0) if plain == 0xFFFFFFFF else plain
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                header = wide.pop(0) if header == 0xFFFFFFFF else header
            extra = extra[4 + n:]
        if flags & 1:
            raise ValueError(f"{name} is encrypted")
        members.append(Member(name, method, packed, header))
        at += 46 + n_name + n_extra + n_comment
    return members


def data_start(file, member: Member) -> int:
    """Where the member's bytes begin. Only stored members can be read by range."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; only stored members can be read by range")
    sig, n_name, n_extra = struct.unpack("<4s22xHH", file.read_at(30, member.header))
    if sig != b"PK\3\4":
        raise ValueError(f"no local header for {member.name}")
    return member.header + 30 + n_name + n_extra


def _walk(file, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of each gzip member in a stored WARC member, for packages without an index."""
    at, begin, unzip, left = start, start, zlib.decompressobj(31), b""
    while at < start + size or left:
        chunk = left or file.read_at(min(FETCH, start + size - at), at)
        at += 0 if left else len(chunk)
        unzip.decompress(chunk)
        left = unzip.unused_data
        if unzip.eof:
            yield begin, at - len(left) - begin
            begin, unzip = at - len(left), zlib.decompressobj(31)
        else:
            left = b""


def locate_records(path: str) -> Iterator[tuple[int, int]]:
    """(offset, length) in the file of every record of the package."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_file(name) as file:
        members = {m.name: m for m in read_directory(file, file.size())}
        indexes = [m for n, m in members.items() if n.startswith("indexes/") and n.endswith((".cdxj", ".cdx"))]
        if not indexes:
            for m in members.values():
                if m.name.endswith(".warc.gz"):
                    yield from _walk(file, data_start(file, m), m.size)
        starts: dict[str, int] = {}
        for index in indexes:
            at, left = data_start(file, index), b""
            for lo in range(0, index.size, FETCH):
                lines = (left + file.read_at(min(FETCH, index.size - lo), at + lo)).split(b"\n")
                left = lines.pop()
                for line in lines:
                    own = json.loads(line[line.index(b"{"):])
                    target = own["filename"]
                    if target not in starts:
                        starts[target] = data_start(file, members[target])
                    yield starts[target] + int(own["offset"]), int(own["length"])


# -- Spark ------------------------------------------------------------------------------------

def with_roles(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """``pages`` with payload (binary), digest, record_type and refers_to."""
    body = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.withColumn("payload", body).withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest").agg(F.min(id_col).alias("first"), F.count("*").alias("n"))
    first = stored(large.where("n > 1").select("digest", "first"), "firsts")  # payloads that stand alone need no look-up
    again = F.col("first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("first"))
    return rows.join(first, "digest", "left").withColumn("record_type", F.when(again, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(again, F.col("first")))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record for each row, a package for each task; returns the manifest (path, records).

    A task that runs again writes another file; only files of the manifest count.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, name = fs.FileSystem.from_uri(folder)
        store.create_dir(name, recursive=True)
        file, index, offset = f"{uuid.uuid4().hex}.wacz", [], 0
        first = next((b for b in batches if len(b)), None)
        if first is None:
            return
        with store.open_output_stream(f"{name}/{file}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
            with package.open(zipfile.ZipInfo(WARC_MEMBER), "w", force_zip64=True) as member:
                for batch in chain([first], batches):
                    offset = _append(batch, member, index, offset)
            with package.open(zipfile.ZipInfo(INDEX_MEMBER), "w", force_zip64=True) as member:
                for line in index:
                    member.write(line)
            package.writestr(zipfile.ZipInfo("datapackage.json"), json.dumps({"profile": "data-package", "resources": [{"path": WARC_MEMBER}, {"path": INDEX_MEMBER}]}))
        yield pd.DataFrame({"path": [f"{folder}/{file}"], "records": [len(index)]})

    rows = with_roles(pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(payload_col).alias("body")), "id", "body")
    ids = F.col("id").cast("string").alias("id"), F.col("refers_to").cast("string").alias("refers_to")
    return stored(rows.select(*ids, "url", "payload", "digest", "record_type").mapInPandas(run, "path string, records long"), "manifest", wide=True)


def _append(batch: pd.DataFrame, member, index: list[bytes], offset: int) -> int:
    columns = (batch[c].tolist() for c in ("id", "url", "payload", "digest", "record_type", "refers_to"))
    for page, url, payload, digest, kind, refers_to in zip(*columns):
        raw = gzip.compress(warc_record(page, url, payload, digest, kind, refers_to), 6, mtime=0)
        member.write(raw)
        entry = {"url": url, "digest": f"sha256:{digest}", "filename": WARC_MEMBER, "offset": offset, "length": len(raw)}
        index.append(f"{_BLANK.sub('%20', url or '-')} 20240101000000 {json.dumps(entry)}\n".encode("utf-8", "replace"))
        offset += len(raw)
    return offset


def read_archives(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of the packages (column path): (record_id, record_type, refers_to, url,
    declared_digest, payload_bytes, payload_digest[, payload]).

    payload_bytes and payload_digest are of the bytes read; a revisit has no payload of its own
    (null). A response whose digest isn't the declared one fails the job.
    """
    def locate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                found = pd.DataFrame(locate_records(path), columns=["offset", "length"], dtype="int64")
                yield found.assign(path=path)[["path", "offset", "length"]]

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened, file, have, at = None, None, b"", 0
        for batch in batches:
            out = []
            for path, offset, length in zip(batch["path"].tolist(), batch["offset"].tolist(), batch["length"].tolist()):
                if path != opened:
                    store, name = fs.FileSystem.from_uri(path)
                    opened, file, have, at = path, store.open_input_file(name), b"", 0
                if not at <= offset <= offset + length <= at + len(have):
                    at, have = offset, file.read_at(max(length, 1 << 16), offset)
                raw = gzip.decompress(have[offset - at:offset - at + length])
                fields, payload = parse_record(raw)
                kind, declared = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
                digest = hashlib.sha256(payload).hexdigest() if kind != "revisit" else None
                if digest and declared and digest != declared:
                    raise ValueError(f"{path} at {offset}: payload digest {digest}, declared {declared}")
                out.append((fields.get("warc-record-id"), kind, fields.get("warc-refers-to"), fields.get("warc-target-uri"), declared,
                            None if digest is None else len(payload), digest, payload if payloads and digest else None))
            frame = pd.DataFrame(out, columns=["record_id", "record_type", "refers_to", "url", "declared_digest", "payload_bytes", "payload_digest", "payload"])
            frame["payload_bytes"] = frame["payload_bytes"].astype("Int64")
            yield frame if payloads else frame.drop(columns="payload")

    spark = packages.sparkSession
    places = stored(packages.select("path").mapInPandas(locate, "path string, offset long, length long"), "places", wide=True)
    spread = places.repartition(tasks(spark), "path", F.floor(F.col("offset") / FETCH)).sortWithinPartitions("path", "offset")
    kinds = "record_id string, record_type string, refers_to string, url string, declared_digest string, payload_bytes long, payload_digest string"
    return spread.mapInPandas(fetch, kinds + ", payload binary" * payloads)


def resolved(records: DataFrame) -> DataFrame:
    """``records`` with payload_bytes and payload_digest of revisits taken from what they refer to."""
    asked = records.where("record_type = 'revisit'").select("refers_to").distinct()
    known = records.where("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("__bytes"), F.col("payload_digest").alias("__digest"))
    known = known.join(asked, "refers_to", "left_semi").dropDuplicates(["refers_to"])
    out = records.join(known, "refers_to", "left")
    return out.withColumn("payload_bytes", F.coalesce("payload_bytes", "__bytes")).withColumn(
        "payload_digest", F.coalesce("payload_digest", "__digest")).drop("__bytes", "__digest")


def archive_round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write all rows to packages in ``folder`` (by default in the shared folder) and read them back.

    (id_col, payload_bytes, payload_digest, record_type, refers_to), one row for each row of
    ``pages``. Null payloads are empty. Of equal payloads of at least ``REVISIT_BYTES`` bytes the
    row with the smallest id is the response; rows that repeat that id and payload are responses
    too, rows with a null id revisit it, and if all ids are null all are responses. Null
    urls have no target; white space in urls is percent-encoded. An empty table writes nothing.
    Other columns aren't read.
    """
    spark: SparkSession = pages.sparkSession
    manifest = write_archives(pages, folder or scratch(spark, "packages"), id_col, url_col, payload_col)
    records = stored(read_archives(manifest, payloads=False), "records", wide=True)
    page = lambda c: F.nullif(F.regexp_extract(c, "^<urn:x-page:(.*)>$", 1), F.lit("")).cast(dict(pages.dtypes)[id_col])
    return resolved(records).select(page("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


#: The query's result in DuckDB.
ORACLE_SQL = f"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM payloads WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM payloads LEFT JOIN firsts USING (payload_digest)
"""
