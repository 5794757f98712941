"""WARC archives: a writer with revisit records and a splittable reader.

Each record is a gzip member of its own. The reader gives byte ranges of the files to tasks; a task looks for the gzip
magic in its range, takes a place for a record only if what decodes there begins with a WARC header, and owns the
records that start in its range, reading past the end to finish the last. A record that is cut off or damaged, or whose
payload does not match its digest, is reported with its status and ends nothing. Files of a writing task that was lost
and run again are in no manifest and are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.llm.common import cut, join_groups

MAGIC = b"\x1f\x8b\x08"
#: Bytes of a range, of a read past its end, and of what is decoded at a time.
SPLIT, AHEAD, PIECE = 16 << 20, 1 << 16, 1 << 13
#: Payloads from this size on are written once.
LEAST = 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def decide(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int = LEAST) -> DataFrame:
    """k_id, url, html (null where it is not written), n (bytes), sha, copy (from 1, among rows that agree in id, url and
    payload), first_id and first_url (of the response), is_response.

    Rows that agree in all three are counted and written out again by number, so no task holds or ranks them; of equal
    payloads the row of the smallest id (null last) and then url is the response. Hot payloads are combined before the
    shuffle and their decision is broadcast."""
    html = F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").alias("k_id"), F.col(f"`{url_col}`").cast("string").alias("url"), html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("n"),
    )
    leaves = cut(rows.where(F.col("n") >= least).groupBy("k_id", "url", "sha").agg(F.count("*").alias("copies")))
    place = F.struct(F.col("k_id").isNull().alias("no_id"), F.col("k_id").alias("id"), F.col("url").isNull().alias("no_url"), F.col("url").alias("url"))
    first = cut(leaves.groupBy("sha").agg(F.min(place).alias("first"), F.count("*").alias("sharers")))
    is_first = F.col("k_id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
    known = join_groups(leaves, first, ["sha"], "sharers", leaves.count())
    to = cut(known.where((F.col("copies") > 1) | ~is_first).select(
        F.col("k_id").alias("t_id"), F.col("url").alias("t_url"), F.col("sha").alias("t_sha"), "copies", F.col("first.id").alias("first_id"),
        F.col("first.url").alias("first_url"), (~is_first).alias("revisits"),
    ))
    on = F.col("k_id").eqNullSafe(F.col("t_id")) & F.col("url").eqNullSafe(F.col("t_url")) & (F.col("sha") == F.col("t_sha"))
    plain = rows.join(to, on, "left").where("copies is null or copies = 1").select(
        "k_id", "url", F.when(F.col("copies").isNull(), F.col("html")).alias("html"), "n", "sha", F.lit(1).alias("copy"), "first_id", "first_url",
        F.col("copies").isNull().alias("is_response"),
    )
    if to.where("copies > 1").isEmpty():
        return plain
    each = rows.join(to.where("copies > 1"), on).groupBy("k_id", "url", "sha", "copies", "first_id", "first_url", "revisits").agg(F.first("html").alias("html"), F.first("n").alias("n"))
    numbered = each.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).withColumn("is_response", ~F.col("revisits") & (F.col("copy") == 1))
    repeated = numbered.withColumn("html", F.when(F.col("is_response"), F.col("html"))).select(*plain.columns)
    return plain.unionByName(repeated)


def record(page_id: str | None, url: str | None, payload: bytes | None, n_copy: int, n: int = 0, sha: str = "", refers: tuple | None = None) -> bytes:
    """A record as it stands in the file before compression. A revisit is given by refers, the id and url of its
    response, and the bytes and digest of the payload that it leaves out."""
    sha, n = (digest(payload), len(payload)) if refers is None else (sha, n)
    name = lambda i, u, copy: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{i}/{sha}/{copy}/{u}')}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http if refers else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {name(page_id, url, n_copy)}",
        "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(*refers, 1)}"]
        head += [f"X-Refers-To-Page-ID: {refers[0]}"] if refers[0] is not None else []
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST, level: int = 6
) -> DataFrame:
    """Writes one record per row of pages below folder (a URI that all executors reach); the manifest, cut: path,
    length, records. Payloads are html in UTF-8 (null: empty). Of equal payloads of at least `least` bytes the one
    with the smallest id (null last; of repeated rows one) is a response and the others are revisits. An empty table
    writes nothing; other columns are not looked at."""
    rows = decide(pages, id_col, url_col, html_col, least).select(
        F.col("k_id").cast("string").alias("k_id"), "url", "html", "copy", F.col("n").cast("long").alias("n"), "sha", F.col("first_id").cast("string").alias("first_id"), "first_url", "is_response"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        out, name, n = None, f"part-{uuid.uuid4().hex}.warc.gz", 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    store.create_dir(path)
                    out = store.open_output_stream(f"{path}/{name}", compression=None)
                page_id, url, html, copy, size, sha, first_id, first_url, is_response = r
                made = zlib.compressobj(level, zlib.DEFLATED, 31)
                if is_response:
                    raw = record(page_id, url, html.encode(), copy)
                else:
                    raw = record(page_id, url, None, copy, size, base64.b32encode(bytes.fromhex(sha)).decode(), (first_id, first_url))
                out.write(made.compress(raw) + made.flush())
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([size]), pa.array([n])], ["path", "length", "records"])

    return cut(rows.mapInArrow(run, "path string, length long, records long"))


def archive_files(spark: SparkSession, folder: str) -> DataFrame:
    """path and length of the gzipped archives below a folder, for read_archives."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(folder).select("path", "length")


def salvage(f, start: int) -> bytes:
    """What decodes of a damaged member, up to a few bytes before the damage."""
    f.seek(start)
    d, parts = zlib.decompressobj(31), []
    try:
        while more := f.read(16):
            parts.append(d.decompress(more))
    except zlib.error:
        pass
    return b"".join(parts)


def members(f, length: int, start: int, end: int) -> Iterator[tuple[bytes, bool]]:
    """The records whose gzip member starts in [start, end) of a file: what of each can be decoded, and whether that is
    all of it. A member that is cut off or damaged ends where its bytes do; the search goes on after its beginning."""
    f.seek(start)
    held, base = f.read(min(end + len(MAGIC) - 1, length) - start), start
    at, view = held.find(MAGIC), memoryview(held)
    while at >= 0 and base + at < end:
        try:
            begins = zlib.decompressobj(31).decompress(held[at : at + 4096], 16)
            if len(begins) < 8:  # a member that begins at the range's end
                f.seek(base + at)
                begins = zlib.decompressobj(31).decompress(f.read(4096), 16)
        except zlib.error:
            begins = b""
        if not begins.startswith(b"WARC/"):
            at = held.find(MAGIC, at + 1)
            continue
        d, parts, size, whole = zlib.decompressobj(31), [], 0, True
        while whole and not d.eof:
            if at + size < len(held):
                more = view[at + size : at + size + PIECE]
            else:
                f.seek(base + at + size)
                more = f.read(AHEAD)
            try:
                parts.append(d.decompress(more))
            except zlib.error:
                parts, whole = [salvage(f, base + at)], False
            whole = whole and len(more) > 0
            size += len(more)
        yield b"".join(parts), whole
        at += size - len(d.unused_data) if whole else 1
        at = held.find(MAGIC, at) if at < len(held) else -1


def same_digest(named: str, payload: bytes) -> bool:
    """Whether a digest as other writers put it, an algorithm's name and base32 or hexadecimal digits in either case, is
    that of the payload; so is one of an algorithm that is not known here."""
    kind, _, digits = named.rpartition(":")
    kind = (kind or "sha1").lower().replace("-", "")
    if kind not in hashlib.algorithms_guaranteed or kind.startswith("shake"):
        return True
    own, digits = hashlib.new(kind, payload), digits.strip().rstrip("=")
    return digits.lower() == own.hexdigest() or digits.upper() == base64.b32encode(own.digest()).decode().rstrip("=")


def parse(raw: bytes, whole: bool = True) -> dict:
    """The parts of a record that the reader returns. status: ok; truncated, if the member or the block is shorter than
    its length says; mismatch, if the payload is not that of the digest; unreadable, if there is no type or a length is
    no number. A payload_digest is that of the payload that is there, of a revisit the one it names."""
    head, end, rest = raw.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    kind, named, size = fields.get("warc-type"), fields.get("warc-payload-digest", ""), fields.get("content-length", str(len(rest)))
    status = "ok" if whole and end else "truncated"
    if kind is None or not size.isdecimal():
        status, size = "unreadable" if status == "ok" else status, str(len(rest))
    block = rest[: int(size)]
    status = "truncated" if status == "ok" and len(block) < int(size) else status
    http, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        lines = dict(x.lower().split(b":", 1) for x in http.split(b"\r\n")[1:] if b":" in x)
        length = lines.get(b"content-length", b"0").strip()
        n, payload, sha = int(length) if length.isdigit() else 0, None, named.rpartition(":")[2]
    else:
        n, sha = len(payload), digest(payload)
        status = "mismatch" if status == "ok" and named and not same_digest(named, payload) else status
    return {
        "page_id": fields.get("x-page-id"), "url": fields.get("warc-target-uri"), "record_type": kind, "payload_bytes": n, "payload_digest": sha,
        "refers_to": fields.get("x-refers-to-page-id"), "status": status, "html": None if payload is None else payload.decode("utf-8", "replace"),
    }


def read_archives(files: DataFrame, split: int = SPLIT, with_html: bool = True) -> DataFrame:
    """files (path, length) -> one row per record: page_id (text), url, record_type, payload_bytes, payload_digest,
    refers_to (text), status (see parse) and html (null for revisits). Any range of split bytes may be a task of its own.
    Records that are cut off or damaged are rows too; an empty table gives none."""
    ranges = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split))).alias("start"))
    ranges = cut(ranges)
    columns = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "status"] + ["html"] * with_html
    schema = ", ".join(f"{c} {'long' if c == 'payload_bytes' else 'string'}" for c in columns)
    kinds = [pa.int64() if c == "payload_bytes" else pa.string() for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(held: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[c] for r in held], k) for c, k in zip(columns, kinds)], columns)

        for b in batches:
            for path, length, start in zip(*(c.to_pylist() for c in b.columns)):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as f:
                    held, size = [], 0
                    for raw in members(f, length, start, min(start + split, length)):
                        held.append(parse(*raw))
                        size += len(raw[0])
                        if size > 8 << 20:
                            yield batch(held)
                            held, size = [], 0
                    if held:
                        yield batch(held)

    return ranges.repartition(max(1, min(ranges.count(), 100_000))).mapInArrow(run, schema)


_NIBBLE = "strpos('0123456789abcdef', substr(h, (5 * i) // 4 + {}, 1)) - 1"
#: DuckDB SQL of the op9 contract.
SQL = f"""
SELECT page_id, n AS payload_bytes,
array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (((16 * ({_NIBBLE.format(1)}) + {_NIBBLE.format(2)}) >> CAST(3 - (5 * i) % 4 AS INT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
CASE WHEN row_number() OVER w = 1 THEN 'response' ELSE 'revisit' END AS record_type,
CASE WHEN row_number() OVER w > 1 THEN first_value(page_id) OVER w END AS refers_to
FROM (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS h FROM pages)
WINDOW w AS (PARTITION BY h ORDER BY page_id)
"""
