"""WARC archives with a two-level capture index.

Captures' URLs, with their hosts reversed, are sorted; blocks of sorted index lines are compressed
one by one, and a sparse directory has each block's first key, file, place and length.  A lookup
binary-searches the directory, reads the blocks that can hold the key by range, searches in them, and
reads the records by range.

The directory lies beside each index file; one row a file, its first and last key, routes keys to
files.  Tasks write files under names of their own attempt and return these, so a task that runs again
never touches what another wrote, and what a lost attempt left is not referred to.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import re
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_folder, written

_DATE = "2024-01-01T00:00:00Z"
_ENTRY = "key string, page long, has_page boolean, url string, digest string, kind string, file string, offset long, length long"


def sort_key(url: str | None) -> str:
    """Host reversed and comma-separated, port, then path and query, all in lower case, without scheme, user, "www." and fragment."""
    if not url:
        return ""
    text = url.strip()
    try:
        parts = urlsplit(text if "://" in text else "//" + text)
        host, port = (parts.hostname or "").removeprefix("www."), parts.port
    except ValueError:
        return text.lower()
    port = f":{port}" if port and port not in (80, 443) else ""
    return (",".join(reversed(host.split("."))) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")).lower()


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record_id(page: int | None) -> str:
    """A version 8 UUID that holds the page's number."""
    n = (page or 0) & (2**64 - 1)
    tag = 0x6B6977656176 if page is not None else 0x6B69776E756C
    x = tag << 80 | 0x8 << 76 | (n >> 62) << 64 | 0b10 << 62 | n & (2**62 - 1)
    h = f"{x:032x}"
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def _page_of(record_id: str) -> int | None:
    x = int(re.sub(r"[^0-9a-f]", "", record_id.removeprefix("<urn:uuid:")), 16)
    if x >> 80 != 0x6B6977656176:
        return None
    n = (x >> 64 & 3) << 62 | x & (2**62 - 1)
    return n - 2**64 if n >> 63 else n


def record(page: int | None, url: str | None, payload: bytes, revisits: int | None, is_revisit: bool) -> tuple[bytes, str]:
    """A record of the WARC/1.1 format, and its payload's digest.  A revisit has the HTTP header and no payload."""
    digest = payload_digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    uri = re.sub(r"[\r\n]+", " ", url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_record_id(page)}",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {uri}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_record_id(revisits)}", f"WARC-Refers-To-Date: {_DATE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse(raw: bytes) -> dict:
    """A record's headers, in lower case, and under "block" its block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogateescape").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record begins here")
    out: dict = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(out["content-length"])
    if len(rest) < n + 4 or rest[n : n + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    return out | {"block": rest[:n]}


class _Files:
    """Files under a folder that driver and executors share, by URI."""

    def __init__(self, uri: str) -> None:
        from pyarrow import fs

        self.fs, self.base = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))

    def create(self) -> None:
        self.fs.create_dir(self.base, recursive=True)

    def put(self, name: str, chunks: Iterable[bytes]) -> None:
        with self.fs.open_output_stream(f"{self.base}/{name}", compression=None) as f:
            for x in chunks:
                f.write(x)

    def get(self, name: str, offset: int = 0, length: int | None = None) -> bytes:
        with self.fs.open_input_file(f"{self.base}/{name}") as f:
            return f.read_at(f.size() - offset if length is None else length, offset)


def _own_name(kind: str) -> str:
    task = TaskContext.get()
    return f"{kind}-{task.partitionId():06d}-{task.taskAttemptId()}"


def _decided(pages: DataFrame, least: int) -> DataFrame:
    """page_id, url, html, and of revisits the response's page_id in ``refers``."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    # Only the digests of payloads that occur more than once are looked up.
    rows = rows.withColumn("sha1", F.unhex(F.sha1(F.encode("html", "UTF-8")))).withColumn("long", F.octet_length("html") >= least)
    several = rows.where("long").groupBy(F.col("sha1").alias("same")).agg(F.max("page_id").alias("refers"), F.count("*").alias("n")).where("n > 1 and refers is not null")
    joined = rows.join(several.drop("n"), F.col("long") & (F.col("sha1") == F.col("same")), "left")
    return joined.select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("refers")), F.col("refers")).alias("refers"))


def write_archives(pages: DataFrame, folder: str, least: int = 0, level: int = 6) -> DataFrame:
    """Write a gzip member a record, a file a task; the index entries.

    Of records with equal payloads of at least ``least`` bytes, those with the largest page_id are
    responses and the others revisits of them.  Repeated rows are written each for itself; those with the largest
    page_id are all responses.  A null page_id is smaller than any, and a payload that only such pages have is
    written whole each time.
    """
    _Files(folder).create()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, entries, at = _own_name("archive") + ".warc.gz", [], 0

        def members() -> Iterator[bytes]:
            nonlocal at
            for df in batches:
                for page, url, html, refers in zip(df["page_id"], df["url"], df["html"], df["refers"], strict=True):
                    page = None if page is None else int(page)
                    raw, digest = record(page, url, html.encode("utf-8", "surrogatepass"), None if refers is None else int(refers), refers is not None)
                    got = zlib.compress(raw, level, 31)
                    entries.append((sort_key(url), page or 0, page is not None, url, digest, "response" if refers is None else "revisit", name, at, len(got)))
                    at += len(got)
                    yield got

        _Files(folder).put(name, members())
        if entries:
            yield pd.DataFrame(entries, columns=[c.split()[0] for c in _ENTRY.split(", ")])

    # Numbers as text: pandas would turn a column with a null into floating point.
    rows = _decided(pages, least).select(F.col("page_id").cast("string").alias("page_id"), "url", "html", F.col("refers").cast("string").alias("refers"))
    return rows.mapInPandas(run, _ENTRY)


def write_index(entries: DataFrame, folder: str, lines_per_block: int = 1000, level: int = 6) -> DataFrame:
    """Sort entries by key and write compressed blocks and their directories; a row an index file: file, head, tail, n.

    Entries are dealt out by ranges of key and page, so one URL's captures can fill many blocks and files.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, directory, at, n = _own_name("index"), [], 0, 0

        def blocks() -> Iterator[bytes]:
            nonlocal at, n
            held: list = []

            def block(rows: list) -> bytes:
                nonlocal at, n
                got = gzip.compress(_lines(rows), level, mtime=0)
                directory.append((rows[0][0], rows[-1][0], at, len(got)))
                at += len(got)
                n += len(rows)
                return got

            for df in batches:
                held += [[r.key, int(r.page) if r.has_page else None, r.url, r.digest, r.kind, r.file, int(r.offset), int(r.length)] for r in df.itertuples(index=False)]
                while len(held) >= lines_per_block:
                    yield block(held[:lines_per_block])
                    del held[:lines_per_block]
            if held:
                yield block(held)

        files = _Files(folder)
        files.put(name, blocks())
        files.put(name + ".dir", [_lines(directory)])
        if directory:
            yield pd.DataFrame({"file": [name], "head": [directory[0][0]], "tail": [directory[-1][1]], "n": [n]})

    dealt = entries.repartitionByRange("key", "page", "file", "offset").sortWithinPartitions("key", "page", "file", "offset")
    return dealt.mapInPandas(run, "file string, head string, tail string, n long")


def _lines(rows: list) -> bytes:
    return "".join(json.dumps(r, ensure_ascii=False) + "\n" for r in rows).encode("utf-8", "surrogatepass")


def _unlined(raw: bytes) -> list[list]:
    return [json.loads(x) for x in raw.decode("utf-8", "surrogatepass").split("\n") if x]


def _between(heads: list[str], tails: list[str], key: str) -> range:
    """Which of some sorted stretches can hold a key: two binary searches."""
    return range(bisect.bisect_left(tails, key), bisect.bisect_right(heads, key))


class IndexFile:
    """One file of the index: its directory, and the block read last."""

    def __init__(self, files: _Files, name: str) -> None:
        self.files, self.name = files, name
        self.directory = _unlined(files.get(name + ".dir"))
        self.heads, self.tails = [r[0] for r in self.directory], [r[1] for r in self.directory]
        self.block: tuple[int, list, list] = (-1, [], [])

    def entries(self, key: str) -> Iterator[list]:
        """The index lines of a key: key, page, url, digest, kind, file, offset, length."""
        for k in _between(self.heads, self.tails, key):
            if self.block[0] != k:
                lines = _unlined(gzip.decompress(self.files.get(self.name, *self.directory[k][2:])))
                self.block = (k, lines, [x[0] for x in lines])
            _, lines, keys = self.block
            yield from lines[bisect.bisect_left(keys, key) : bisect.bisect_right(keys, key)]


class Archive:
    """The archives and the index in a folder, for lookups one by one."""

    def __init__(self, folder: str, tops: DataFrame) -> None:
        self.files = _Files(folder)
        self.tops = _sorted_tops(tops)
        self.open: dict[str, IndexFile] = {}

    def captures(self, url: str | None) -> Iterator[dict]:
        """The records of a URL's captures."""
        names, heads, tails = self.tops
        key = sort_key(url)
        for k in _between(heads, tails, key):
            index = self.open.get(names[k]) or self.open.setdefault(names[k], IndexFile(self.files, names[k]))
            for e in index.entries(key):
                yield parse(zlib.decompress(self.files.get(e[5], e[6], e[7]), 31))


def _sorted_tops(tops: DataFrame) -> tuple[list[str], list[str], list[str]]:
    """Names, first and last keys of the index files: one row for each task that wrote one."""
    rows = sorted((r["head"], r["tail"], r["file"]) for r in tops.collect())
    return [r[2] for r in rows], [r[0] for r in rows], [r[1] for r in rows]


def look_up(urls: DataFrame, tops: DataFrame, folder: str) -> DataFrame:
    """file, offset, length: where the captures of the URLs in column url of ``urls`` are.

    Each distinct key goes to the index files that can hold it, and keys go through a file in order,
    so that a block is read once.
    """
    files = urls.sparkSession.sparkContext.broadcast(_sorted_tops(tops))

    @F.pandas_udf("string")
    def key_of(x: pd.Series) -> pd.Series:
        return x.map(sort_key, na_action=None)

    @F.pandas_udf("array<string>")
    def files_of(keys: pd.Series) -> pd.Series:
        names, heads, tails = files.value
        return keys.map(lambda k: [names[i] for i in _between(heads, tails, k)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = None
        for df in batches:
            out = []
            for name, key in zip(df["name"], df["key"], strict=True):
                if index is None or index.name != name:
                    index = IndexFile(_Files(folder), name)
                for e in index.entries(key):
                    out.append(e[5:])
                    if len(out) >= 10_000:
                        yield pd.DataFrame(out, columns=["file", "offset", "length"])
                        out = []
            if out:
                yield pd.DataFrame(out, columns=["file", "offset", "length"])

    keys = urls.select(F.col("url").cast("string").alias("url")).distinct().select(key_of(F.coalesce("url", F.lit(""))).alias("key")).distinct()
    dealt = keys.select("key", F.explode(files_of("key")).alias("name")).repartition("name").sortWithinPartitions("name", "key")
    return dealt.mapInPandas(run, "file string, offset long, length long")


_RECORD = "page_id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def read_records(places: DataFrame, folder: str, stretch: int = 8 << 20, with_payload: bool = True) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_digest, payload_bytes, payload: the records at ``places``.

    Records that begin in the same ``stretch`` of a file are read at once.  A response whose payload
    does not have its digest and length is an error.  A revisit has no payload; its digest and length are those of the
    payload that it refers to.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files = _Files(folder)
        for df in batches:
            for (name, _), part in df.groupby(["file", "stretch"], sort=False):
                begin, end = int(part["offset"].min()), int((part["offset"] + part["length"]).max())
                raw, out = files.get(name, begin, end - begin), []
                for offset, length in zip(part["offset"], part["length"], strict=True):
                    r = parse(zlib.decompress(raw[offset - begin : offset - begin + length], 31))
                    http, _, payload = r["block"].partition(b"\r\n\r\n")
                    n = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
                    digest, revisit = r["warc-payload-digest"].removeprefix("sha1:"), r["warc-type"] == "revisit"
                    if not revisit and (len(payload) != n or payload_digest(payload) != digest):
                        raise ValueError(f"{name} at {offset}: the payload is not what its headers say")
                    page, refers = _page_of(r["warc-record-id"]), _page_of(r["warc-refers-to"]) if revisit else None
                    out.append((None if page is None else str(page), r["warc-target-uri"], r["warc-type"], None if refers is None else str(refers), digest, n, payload if with_payload and not revisit else None))
                yield pd.DataFrame(out, columns=[c.split()[0] for c in _RECORD.split(", ")])

    dealt = places.withColumn("stretch", F.floor(F.col("offset") / stretch)).repartition("file", "stretch").sortWithinPartitions("file", "stretch", "offset")
    got = dealt.mapInPandas(run, _RECORD)
    return got.select(F.col("page_id").cast("long"), "url", "record_type", F.col("refers_to").cast("long"), "payload_digest", "payload_bytes", "payload")


def archive(pages: DataFrame, folder: str | None = None, least: int = 0, level: int = 6) -> tuple[str, DataFrame]:
    """Write ``pages`` (page_id, url, html) and their index; the folder and the index files' rows.

    An empty table makes no record.  A null url is written as an empty one.
    """
    folder = folder or shared_folder(pages.sparkSession, "warc")
    entries = written(write_archives(pages, folder, least, level), "captures")
    return folder, written(write_index(entries, folder), "index")
