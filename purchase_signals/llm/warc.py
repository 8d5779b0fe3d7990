"""WARC archives with a two-level capture index.

Archives: every record is its own gzip member, so a record can be read by its
range alone.  Records of equal payloads meet in one task (a payload with more
than a 1/``HOT`` share of all rows is spread by page id), the one with the
largest page id is written as response, the others as revisits of it.

Index: captures are sorted by reversed-host URL key and page id over range
partitions; each partition writes one index file of compressed blocks of
``BLOCK_CAPTURES`` lines (unless told otherwise) and a sparse directory with the first key, offset and
length of every block.  A look-up finds the index file among the files' first
keys, binary-searches that file's directory, reads one block by its range,
binary-searches in it, and then reads the record by its range.  Look-ups are
sorted the same way, so a task opens each block it needs once.

Files are opened through Arrow's file systems (local or mounted paths, ``hdfs``,
``s3``, ``gs``) in the shared folder; a file counts only once the staged table of
its task names it, so files of lost attempts are never read.
"""

from __future__ import annotations

import base64
import bisect
import datetime as dt
import gzip
import hashlib
import re
import uuid
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .common import prepare, stage

#: Payloads of fewer bytes are always written whole.
REVISIT_BYTES = 1000
#: Compressed bytes after which a task begins another archive.
ARCHIVE_BYTES = 256 << 20
BLOCK_CAPTURES = 2000
#: A payload on more than 1/HOT of the rows is spread over SALTS tasks; there are fewer than HOT.
HOT, SALTS = 1024, 1024
LEVEL = 6
CAPTURES = "key string, page_id long, archive string, offset long, length long"
PARTS = "file string, directory string, first_key string, first_page long, n_blocks long, n_captures long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)(:\d*)?([^#]*)")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder or file."""
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def escaped(url: str) -> str:
    return _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url)


def url_key(url: str | None) -> str:
    """Reversed-host key: ``http://www.example.com/a?b`` gives ``com,example,www)/a?b``.
    Scheme, user and fragment are left out, numeric hosts stay as they are, a text
    that is no URL is its own key, null gives ''."""
    text = escaped(url or "")
    m = _URL.match(text)
    if m is None:
        return text
    host, port, rest = m.group(1).lower(), (m.group(2) or "").strip(":"), m.group(3)
    if not host.startswith("[") and not host.replace(".", "").isdigit():
        host = ",".join(reversed(host.split(".")))
    return f"{host}{':' + port if port else ''}){rest or '/'}"


@F.pandas_udf(T.StringType())
def url_keys(urls: pd.Series) -> pd.Series:
    return urls.map(url_key, na_action=None)


def record_id(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ':'.join(map(str, parts)))}>"


def record(kind: str, name: str, date: str, fields: dict, block: bytes) -> bytes:
    """One record as a gzip member."""
    head = [b"WARC/1.1", f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: {name}".encode(), f"WARC-Date: {date}".encode()]
    head += [f"{k}: {v}".encode() for k, v in fields.items() if v is not None]
    head.append(f"Content-Length: {len(block)}".encode())
    return gzip.compress(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def parsed(member: bytes) -> tuple[dict, bytes]:
    """Header fields and block of a record's gzip member."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[:int(fields["Content-Length"])]


class Archives:
    """The archives of one task; files begin with a warcinfo record."""

    def __init__(self, folder: str, date: str, archive_bytes: int):
        self.folder, self.date, self.archive_bytes, self.stream, self.at = folder, date, archive_bytes, None, 0

    def write(self, member: bytes) -> tuple[str, int, int]:
        if self.stream is None or self.at >= self.archive_bytes:
            self.close()
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            files, path = opened(self.folder)
            files.create_dir(path, recursive=True)
            self.stream = files.open_output_stream(f"{path}/{self.name}", compression=None, buffer_size=1 << 20)
            info = record("warcinfo", record_id(self.name), self.date, {"WARC-Filename": self.name, "Content-Type": "application/warc-fields"},
                          b"format: WARC File Format 1.1\r\n")
            self.stream.write(info)
            self.at = len(info)
        place = (self.name, self.at, len(member))
        self.stream.write(member)
        self.at += len(member)
        return place

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None


def response_block(payload: bytes) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + payload


def writer(folder: str, date: str, archive_bytes: int):
    """Rows sorted by (key, page id falling) to archives; gives the captures."""
    def write(batches):
        out, key, same, first = Archives(folder, date, archive_bytes), None, (None, 0), None
        for batch in batches:
            rows = batch.to_pydict()
            cols = [[], [], [], [], []]
            for k, page, url, payload, is_hot, top in zip(*(rows[c] for c in ("k", "page_id", "url", "payload", "is_hot", "top"))):
                digest = hashlib.sha1(payload).digest()
                fields = {"WARC-Target-URI": escaped(url) if url else "about:blank", "X-Page-ID": page,
                          "WARC-Payload-Digest": "sha1:" + base64.b32encode(digest).decode(), "X-Payload-Length": len(payload),
                          "Content-Type": "application/http;msgtype=response"}
                if k != key:
                    key, first = k, page
                    leads = len(payload) < REVISIT_BYTES or not is_hot or page == top
                else:
                    leads = len(payload) < REVISIT_BYTES
                mark = (page, url, digest)
                same = (mark, same[1] + 1) if mark == same[0] else (mark, 0)
                if leads:
                    name = record_id("response", page, digest.hex()) if len(payload) >= REVISIT_BYTES else record_id(page, url, digest.hex(), same[1])
                    member = record("response", name, date, fields, response_block(payload))
                else:
                    target = top if is_hot else first
                    fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                               "WARC-Refers-To": record_id("response", target, digest.hex()), "X-Refers-To-Page-ID": target}
                    member = record("revisit", record_id(page, url, digest.hex(), same[1], "revisit"), date, fields, b"")
                for c, v in zip(cols, (url_key(url), page, *out.write(member))):
                    c.append(v)
            yield captures_batch(cols)
        out.close()

    return write


def captures_batch(cols) -> pa.RecordBatch:
    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], [c.split()[0] for c in CAPTURES.split(", ")])


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every row under ``folder``; gives the captures (staged):
    key, page_id, archive, offset, length."""
    rows = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"),
                        F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.when(F.octet_length("payload") >= REVISIT_BYTES, F.sha2("payload", 256)))
    total = rows.select(F.count(F.lit(1))).scalar()
    # by count fewer than HOT rows
    hot = rows.where("sha IS NOT NULL").groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("top"))
    hot = stage(hot.where((F.col("n") > 1) & (F.col("n") * HOT > total)).select("sha", "top", F.lit(True).alias("is_hot")), "warc-hot")
    spread = F.xxhash64("page_id", "url", F.octet_length("payload")).cast("string")
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("string")
    keyed = rows.join(F.broadcast(hot), "sha", "left").withColumn("is_hot", F.coalesce("is_hot", F.lit(False))).withColumn(
        "k", F.when(F.col("sha").isNull(), spread).when(F.col("is_hot"), F.concat_ws("#", "sha", salt)).otherwise(F.col("sha")))
    ordered = keyed.repartition("k").sortWithinPartitions("k", F.col("page_id").desc_nulls_last(), "url")
    date = dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    written = ordered.select("k", "page_id", "url", "payload", "is_hot", "top").mapInArrow(writer(folder, date, archive_bytes), CAPTURES)
    return stage(written, "warc-captures")


def order(key: str, page: int | None) -> tuple:
    """Sort order of captures: by key, then page id, null first."""
    return key, page is not None, page or 0


@dataclass
class Index:
    """Where the archives are, and each index file with its first capture, in order."""
    archives: str
    folder: str
    parts: list


def index_writer(folder: str, block_captures: int):
    """Sorted captures of a task to one index file and its directory."""
    def write(batches):
        files, path = opened(folder)
        lines, blocks, stream, at, n, name = [], [], None, 0, 0, uuid.uuid4().hex

        def flush():
            nonlocal at, lines
            member = gzip.compress("".join(lines).encode(), LEVEL, mtime=0)
            key, page = lines[0].split("\t", 2)[:2]
            blocks.append(f"{key}\t{page}\t{at}\t{len(member)}\n")
            stream.write(member)
            at, lines = at + len(member), []

        for batch in batches:
            rows = batch.to_pydict()
            for key, page, archive, offset, length in zip(*(rows[c] for c in ("key", "page_id", "archive", "offset", "length"))):
                if stream is None:
                    files.create_dir(path, recursive=True)
                    stream, first = files.open_output_stream(f"{path}/{name}.cdx.gz", compression=None, buffer_size=1 << 20), (key, page)
                lines.append(f"{key}\t{'' if page is None else page}\t{archive}\t{offset}\t{length}\n")
                n += 1
                if len(lines) == block_captures:
                    flush()
        if stream is None:
            return
        if lines:
            flush()
        stream.close()
        with files.open_output_stream(f"{path}/{name}.idx") as directory:
            directory.write("".join(blocks).encode())
        values = (f"{name}.cdx.gz", f"{name}.idx", *first, len(blocks), n)
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], [c.split()[0] for c in PARTS.split(", ")])

    return write


def write_index(captures: DataFrame, archives: str, folder: str, block_captures: int = BLOCK_CAPTURES) -> Index:
    """Write the capture index; the driver holds one line for each index file."""
    ordered = captures.repartitionByRange("key", "page_id", "archive", "offset").sortWithinPartitions("key", "page_id", "archive", "offset")
    parts = stage(ordered.mapInArrow(index_writer(folder, block_captures), PARTS), "warc-parts").collect()
    return Index(archives, folder, sorted((order(r.first_key, r.first_page), r.file, r.directory) for r in parts))


class Reader:
    """Look-ups of one task, in order: keeps the directory and block last used."""

    def __init__(self, index: Index):
        self.index, self.firsts = index, [p[0] for p in index.parts]
        self.files, self.path = opened(index.folder)
        self.part, self.number, self.reads = None, None, 0

    def directory(self, part: int) -> None:
        if part != self.part:
            with self.files.open_input_stream(f"{self.path}/{self.index.parts[part][2]}") as f:
                rows = [line.split("\t") for line in f.read().decode().splitlines()]
            self.starts = [order(k, int(p) if p else None) for k, p, _, _ in rows]
            self.ranges = [(int(a), int(n)) for _, _, a, n in rows]
            self.part, self.number = part, None

    def block(self, number: int) -> None:
        if number != self.number:
            with self.files.open_input_file(f"{self.path}/{self.index.parts[self.part][1]}") as f:
                at, length = self.ranges[number]
                f.seek(at)
                rows = [line.split("\t") for line in gzip.decompress(f.read(length)).decode().splitlines()]
            self.rows = [(order(k, int(p) if p else None), a, int(o), int(n)) for k, p, a, o, n in rows]
            self.keys, self.number = [r[0] for r in self.rows], number
            self.reads += 1

    def find(self, wanted: tuple):
        """Captures whose order begins with ``wanted``: (key,) or a whole order."""
        part = max(bisect.bisect_left(self.firsts, wanted) - 1, 0)
        while part < len(self.firsts) and self.firsts[part][:len(wanted)] <= wanted:
            self.directory(part)
            number = max(bisect.bisect_left(self.starts, wanted) - 1, 0)
            while number < len(self.starts) and self.starts[number][:len(wanted)] <= wanted:
                self.block(number)
                i = bisect.bisect_left(self.keys, wanted)
                while i < len(self.keys) and self.keys[i][:len(wanted)] == wanted:
                    yield self.rows[i]
                    i += 1
                if i < len(self.keys):
                    return
                number += 1
            if number < len(self.starts):
                return
            part += 1


def look_up(index: Index, wanted: DataFrame, by_page: bool) -> DataFrame:
    """Captures (staged) of the distinct rows of ``wanted`` (key, and page_id if
    ``by_page``): all captures of a URL, or those of one page of it."""
    names = ["key", "page_id"] if by_page else ["key"]
    asked = stage(wanted.select(*names).distinct(), "warc-wanted")
    ordered = asked.repartitionByRange(*names).sortWithinPartitions(*names)

    def find(batches):
        reader = Reader(index)
        for batch in batches:
            rows, cols = batch.to_pydict(), [[], [], [], [], []]
            for one in zip(*(rows[c] for c in names)):
                for (key, known, page), archive, offset, length in reader.find(order(*one) if by_page else one):
                    for c, v in zip(cols, (key, page if known else None, archive, offset, length)):
                        c.append(v)
            yield captures_batch(cols)

    return stage(ordered.mapInArrow(find, CAPTURES), "warc-found") if index.parts else asked.sparkSession.createDataFrame([], CAPTURES)


def read_records(index: Index, captures: DataFrame, payloads: bool = True) -> DataFrame:
    """The records at ``captures``, read by their ranges, payload digests verified.
    A revisit has no payload of its own; its bytes and digest are the original's."""
    ordered = captures.repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches):
        files, path = opened(index.archives)
        name, f = None, None
        for batch in batches:
            rows, cols = batch.to_pydict(), [[] for _ in names]
            for archive, offset, length in zip(rows["archive"], rows["offset"], rows["length"]):
                if archive != name:
                    if f is not None:
                        f.close()
                    name, f = archive, files.open_input_file(f"{path}/{archive}")
                f.seek(offset)
                fields, block = parsed(f.read(length))
                digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                page, target = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                payload = None
                n = int(fields["X-Payload-Length"])
                if fields["WARC-Type"] == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    if hashlib.sha1(payload).hexdigest() != digest or len(payload) != n:
                        raise ValueError(f"{archive} at {offset}: the payload is not what was written")
                for c, v in zip(cols, (page and int(page), fields["WARC-Target-URI"], n, digest, fields["WARC-Type"], target and int(target),
                                       payload if payloads else None)):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)
        if f is not None:
            f.close()

    return ordered.mapInArrow(read, RECORDS)


def archive(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            archive_bytes: int = ARCHIVE_BYTES, block_captures: int = BLOCK_CAPTURES) -> Index:
    """Write the rows of ``pages`` as archives with their index under ``folder``.

    A null html counts as empty, a null URL is written as ``about:blank`` and has
    the key ''.  Every row has its record: of rows repeated with one page id and
    payload (1,000 bytes and more) one is the response.  Null page ids rank below
    all others.  An empty table gives an index without files; other columns are
    ignored.
    """
    prepare(pages.sparkSession)
    captures = write_archives(pages, f"{folder}/archives", id_col, url_col, html_col, archive_bytes)
    return write_index(captures, f"{folder}/archives", f"{folder}/index", block_captures)


def new_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-warc-{uuid.uuid4().hex}"


def pages_records(pages: DataFrame, index: Index, id_col: str = "page_id", url_col: str = "url", payloads: bool = False) -> DataFrame:
    """The records of ``pages``, each found through the index by URL and page id."""
    wanted = pages.select(url_keys(pages[url_col].cast("string")).alias("key"), pages[id_col].cast("long").alias("page_id"))
    return read_records(index, look_up(index, wanted, True), payloads)


def url_records(urls: DataFrame, index: Index, url_col: str = "url", payloads: bool = True) -> DataFrame:
    """All records of each distinct URL, found through the index."""
    return read_records(index, look_up(index, urls.select(url_keys(urls[url_col].cast("string")).alias("key")), False), payloads)
