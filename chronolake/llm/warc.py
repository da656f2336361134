"""Web archives (WARC 1.1) written in deterministic shards, and read back.

1. One narrow row for each page: id, URL, size and digests of the payload, and a stored row number. Of
   equal payloads the page with the largest id is the response, found by a combined maximum for each
   digest; the others revisit it. Payloads with very many copies are looked up in a broadcast list of
   bounded size, all others meet their response by digest. Payloads are shuffled once, straight to the
   shard of their page; of one with very many copies only the response's is sent.
2. Records are put in order by page id, digest and a salt. Splitters taken from a hash sample of the narrow
   rows, weighted by bytes, deal that order into shards. The sample depends on the rows only, so the shards
   are the same on any cluster (equal rows of a hot payload apart), and no page id, however frequent, has to fit into one shard.
3. A task sorts its shards, each payload before the record that may need it, and writes a sequence of files, one gzip member for each record with
   headers and digests generated anew. A file is closed when its compressed size passes the limit.
4. Files are written under temporary names. Each finished file gives one row of a manifest, which Spark
   stores; only files that it lists count, so the leavings of lost or repeated tasks are ignored. The files
   are then moved to their names (a step that may be repeated), and the manifest is moved last: an archive
   folder with a manifest is complete.

Tasks hold one record at a time, besides Spark's batches.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolake.llm.text import text_of
from chronolake.session import stored

SHARD_BYTES = 64 << 20  # of uncompressed records
FILE_BYTES = 1 << 30  # compressed size at which a file is closed
MAX_SHARDS = 10_000  # beyond it shards grow, and have several files
SAMPLED = 128  # sampled rows for each shard; the driver sees at most MAX_SHARDS * SAMPLED of 20 bytes
MAX_COPIES = 10_000  # narrow rows of one digest that may meet in one task
MAX_HOT = 200_000  # digests in the broadcast list; the limit of copies rises with the table
SALTS = 256
OVERHEAD = 600  # bytes of a record besides its payload, for the sizes of shards
DATE = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"
MANIFEST = "manifest.jsonl"

# Fixed value: how a revisit says that the payloads are identical.
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORDS = (
    "place binary, kind int, row long, page_id string, url string, sha1 string, sha256 string, bytes long, "
    "salt int, is_response boolean, to_page string, to_url string, html string"
)
_WRITTEN = "shard int, number int, temporary string, name string, records long, bytes long, sha256 string"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


# --- what is written ------------------------------------------------------------------------------


def _pages(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """Narrow rows of all pages, numbered."""
    payload = text_of(F.col(f"`{html}`")).cast("binary")
    return stored(
        pages.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{key}`").cast("long").alias("page_id"),
            F.col(f"`{url}`").cast("string").alias("url"),
            F.sha1(payload).alias("sha1"),
            F.sha2(payload, 256).alias("sha256"),
            F.octet_length(payload).cast("long").alias("bytes"),
        ),
        "warc-pages",
    )


def _first_of_copies(narrow: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The response (of, first) of each payload with copies: those with very many, and all others."""
    first = F.struct(F.col("page_id").isNotNull().alias("some"), "page_id", "url", "row")
    groups = narrow.where(F.col("bytes") >= least).groupBy(F.col("sha256").alias("of"))
    groups = groups.agg(F.max(first).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    groups = stored(groups, "warc-copies")
    limit = max(MAX_COPIES, narrow.count() // MAX_HOT)  # so that at most MAX_HOT payloads have more copies
    few, many = F.col("copies") <= limit, F.col("copies") > limit
    return groups.where(many).drop("copies"), groups.where(few).drop("copies")


def _salt(row: Column) -> Column:
    return F.pmod(F.xxhash64(row), F.lit(SALTS)).cast("int")


def _typed(narrow: DataFrame, hot: DataFrame, rest: DataFrame, least: int) -> DataFrame:
    """Add ``is_response`` and ``salt``, and for revisits ``to_page`` and ``to_url``; small payloads never revisit."""
    rest = rest.select(F.col("of").alias("r_of"), F.col("first").alias("r_first"))
    joined = narrow.join(F.broadcast(hot), (F.col("sha256") == F.col("of")) & (F.col("bytes") >= least), "left")
    # Rows of hot payloads have their answer, and are kept off the second join's key by their row number.
    digest = F.when(F.col("first").isNull() & (F.col("bytes") >= least), F.col("sha256"))
    joined = joined.withColumn("by", F.coalesce(digest, F.col("row").cast("string")))
    joined = joined.join(rest, F.col("by") == F.col("r_of"), "left")
    lead = F.coalesce("first", "r_first")
    is_response = lead.isNull() | (F.col("row") == lead["row"])
    return joined.select(
        *narrow.columns,
        is_response.alias("is_response"),
        # Only rows of hot payloads are cut apart by their number, which depends on the table's layout.
        F.when(F.col("first").isNotNull(), _salt(F.col("row"))).otherwise(0).alias("salt"),
        F.when(~is_response, lead["page_id"]).alias("to_page"),
        F.when(~is_response, lead["url"]).alias("to_url"),
    )


def _payloads(pages: DataFrame, hot: DataFrame, key: str, html: str) -> DataFrame:
    """Texts (page_id, sha256, salt, html) of all pages that may be responses; empty ones need none."""
    text = text_of(F.col(f"`{html}`"))
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("page_id"), F.sha2(text.cast("binary"), 256).alias("sha256"), text.alias("html")
    ).where("html <> ''")
    if hot.isEmpty():
        return rows.withColumn("salt", F.lit(0))
    joined = rows.join(F.broadcast(hot), F.col("sha256") == F.col("of"), "left")
    others = joined.where(F.col("of").isNull()).select("page_id", "sha256", F.lit(0).alias("salt"), "html")
    # Rows with the response's id may be many as well: they are folded before they are sent.
    own = joined.where(F.col("of").isNotNull() & F.col("page_id").eqNullSafe(F.col("first.page_id")))
    own = own.groupBy("sha256").agg(
        F.any_value("page_id").alias("page_id"), F.any_value(_salt(F.col("first.row"))).alias("salt"), F.any_value("html").alias("html")
    )
    return others.unionByName(own)


def _place() -> Column:
    """Order of the records as bytes: page id (null first), digest, salt."""
    sign = F.col("page_id").bitwiseXOR(F.lit(-(2**63)))
    return F.concat(
        F.when(F.col("page_id").isNull(), F.unhex(F.lit("00"))).otherwise(F.unhex(F.lit("01"))),
        F.unhex(F.lpad(F.hex(F.coalesce(sign, F.lit(0).cast("long"))), 16, "0")),
        F.unhex(F.substring("sha256", 1, 16)),
        F.unhex(F.lpad(F.hex(F.col("salt").cast("long")), 2, "0")),
    )


def _splitters(typed: DataFrame, shard_bytes: int) -> np.ndarray:
    """First places of all shards but the first, cut at even weights of a hash sample."""
    weight = F.when(F.col("is_response"), F.col("bytes")).otherwise(0) + OVERHEAD
    total = typed.agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("bytes")).first()
    shards = int(min(MAX_SHARDS, -(-(total["bytes"] or 0) // shard_bytes)))
    if shards < 2:
        return np.zeros(0, dtype="S18")
    share = F.pmod(F.xxhash64("place"), F.lit(1 << 40)) * F.lit(total["n"] / float(1 << 40))
    sampled = typed.where(share < SAMPLED * shards).groupBy("place").agg(F.sum(weight).alias("weight")).collect()
    sampled.sort(key=lambda r: bytes(r["place"]))
    places = np.array([bytes(r["place"]) for r in sampled], dtype="S18")
    along = np.cumsum([r["weight"] for r in sampled])
    cuts = np.searchsorted(along, np.arange(1, shards) * (along[-1] / shards)) if len(along) else []
    return np.unique(places[np.minimum(cuts, len(places) - 1)]) if len(along) else places


def _plain(batch: pd.DataFrame) -> pd.DataFrame:
    return batch.astype(object).where(batch.notna(), None)


def _sharded(splitters: np.ndarray):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            places = np.array(batch.column("place").to_pylist(), dtype="S18")
            shard = np.searchsorted(splitters, places, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], ["shard", *batch.schema.names])

    return run


def _records(
    pages: DataFrame, narrow: DataFrame, key: str, html: str, least: int, shard_bytes: int
) -> tuple[DataFrame, int]:
    """Payloads (kind 0) and records (kind 1) with their shards, and the number of shards."""
    hot, rest = _first_of_copies(narrow, least)
    typed = stored(_typed(narrow, hot, rest, least).withColumn("place", _place()), "warc-types")
    splitters = _splitters(typed, shard_bytes)
    payloads = _payloads(pages, hot, key, html).withColumn("place", _place())
    both = typed.withColumn("kind", F.lit(1)).unionByName(payloads.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    columns = [F.col(c).cast(t).alias(c) for c, t in (x.split() for x in _RECORDS.split(", "))]
    # Ids are text by now: pandas would read longs with nulls as doubles.
    return both.select(columns).mapInArrow(_sharded(splitters), f"shard int, {_RECORDS}"), len(splitters) + 1


# --- records --------------------------------------------------------------------------------------


def _base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _uri(url) -> str:
    """A target URI that can't break the header: white space and control characters are escaped."""
    if url is None or url == "":
        return "about:blank"
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record_id(page_id, sha256: str, copy: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{sha256[:32]}:{copy}>"


def page_of(record_id: str) -> int | None:
    """The page id in a record id."""
    name = record_id.split(":")[2]
    return int(name) if name else None


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own; equal records give equal bytes."""
    head = "".join([f"{VERSION}\r\n", *[f"{name}: {value}\r\n" for name, value in headers], "\r\n"])
    return gzip.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n", 6, mtime=0)


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _info(name: str) -> bytes:
    block = b"software: chronolake\r\nformat: WARC File Format 1.1\r\n"
    return _member(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", f"<urn:file:{name}>"),
            ("WARC-Date", DATE),
            ("WARC-Filename", name),
            ("WARC-Block-Digest", _digest(block)),
            ("Content-Type", "application/warc-fields"),
            ("Content-Length", str(len(block))),
        ],
        block,
    )


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def _page_record(page: dict, html: str, copy: str) -> bytes:
    """A response with its payload, or a revisit with the response's HTTP header only."""
    headers = [("WARC-Type", "response" if page["is_response"] else "revisit")]
    block = _http(page["bytes"])
    if page["is_response"]:
        block += html.encode("utf-8", "surrogatepass")
        if len(block) != len(_http(page["bytes"])) + page["bytes"]:
            raise ValueError(f"no payload for page {page['page_id']}")
    else:
        headers += [
            ("WARC-Profile", IDENTICAL),
            ("WARC-Refers-To", _record_id(page["to_page"], page["sha256"], "response")),
            ("WARC-Refers-To-Target-URI", _uri(page["to_url"])),
            ("WARC-Refers-To-Date", DATE),
        ]
    headers += [
        ("WARC-Record-ID", _record_id(page["page_id"], page["sha256"], copy)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _uri(page["url"])),
        ("WARC-Payload-Digest", "sha1:" + _base32(page["sha1"])),
        ("WARC-Block-Digest", _digest(block)),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    return _member(headers, block)


# --- files ----------------------------------------------------------------------------------------


def _filesystem(folder: str):
    """File system and path of a folder that all executors share, by its address."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


class _Files:
    """Writes the records of one shard into a sequence of files."""

    def __init__(self, folder: str, shard: int, limit: int):
        self.system, self.path = _filesystem(folder)
        self.shard, self.limit, self.number, self.stream = shard, limit, 0, None

    def add(self, member: bytes) -> Iterator[dict]:
        if self.stream is None:
            self._open()
        self._put(member)
        self.records += 1
        if self.size >= self.limit:
            yield self.close()

    def _open(self) -> None:
        self.name = f"pages-{self.shard:05d}-{self.number:05d}.warc.gz"
        self.temporary = f"{self.name}.{uuid.uuid4().hex}.temporary"  # another one for each attempt
        self.stream = self.system.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
        self.size, self.records, self.sha = 0, 0, hashlib.sha256()
        self._put(_info(self.name))

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.sha.update(data)
        self.size += len(data)

    def close(self) -> dict:
        self.stream.close()
        self.stream = None
        self.number += 1
        return {
            "shard": self.shard,
            "number": self.number - 1,
            "temporary": self.temporary,
            "name": self.name,
            "records": self.records,
            "bytes": self.size,
            "sha256": self.sha.hexdigest(),
        }


def _written(folder: str, file_bytes: int):
    def run(batches):
        files, last, copies = None, None, 0
        held, html = None, ""
        done: list[dict] = []
        for batch in batches:
            for page in _plain(batch).to_dict("records"):
                if page["kind"] == 0:
                    held, html = (page["page_id"], page["sha256"]), page["html"]
                    continue
                if files is None or files.shard != page["shard"]:
                    if files is not None and files.stream is not None:
                        done.append(files.close())
                    files, last = _Files(folder, page["shard"], file_bytes), None
                same = (page["page_id"], page["sha256"], page["salt"])
                copies = copies + 1 if same == last else 0
                last = same
                copy = "response" if page["is_response"] else f"{page['salt']}-{copies}"
                own = html if held == (page["page_id"], page["sha256"]) else ""
                done += files.add(_page_record(page, own, copy))
            if done:
                yield pd.DataFrame(done)
                done = []
        if files is not None and files.stream is not None:
            done.append(files.close())
        if done:
            yield pd.DataFrame(done)

    return run


def _moved(folder: str):
    """Give files their names. A file that was moved before, by an attempt that got lost, is left."""

    def run(batches):
        from pyarrow import fs

        system, path = _filesystem(folder)
        for batch in batches:
            for temporary, name, size in zip(batch["temporary"], batch["name"], batch["bytes"]):
                if system.get_file_info(f"{path}/{temporary}").type == fs.FileType.File:
                    system.move(f"{path}/{temporary}", f"{path}/{name}")
                elif system.get_file_info(f"{path}/{name}").size != size:
                    raise FileNotFoundError(f"{path}/{temporary}")
            yield batch

    return run


@dataclass(frozen=True)
class Archive:
    """A folder of committed files, and one row for each: shard, number, name, records, bytes, sha256."""

    folder: str
    manifest: DataFrame


def write_warc(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    least: int = 0,
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
) -> Archive:
    """Write one record for each page into the new folder ``folder``, shared by all executors.

    The payload is the page's text in UTF-8 (null: empty). Of pages with equal payloads of at least ``least``
    bytes, the one with the largest id (null lowest; of repeated ids, one row) is a response record and the
    others are revisit records that refer to it; pages with smaller payloads are all responses. Rows without
    an id or URL are written with an empty id and the URI about:blank. Equal rows are written as often as
    they occur. An empty table gives a manifest without files. Other columns are ignored.
    """
    spark = pages.sparkSession
    system, path = _filesystem(folder)
    if system.get_file_info(f"{path}/{MANIFEST}").is_file:
        raise FileExistsError(f"{folder} holds an archive")
    system.create_dir(path, recursive=True)
    narrow = _pages(pages, key, url, html)
    records, shards = _records(pages, narrow, key, html, least, shard_bytes)
    dealt = records.repartitionById(shards, F.col("shard"))
    dealt = dealt.sortWithinPartitions("shard", "place", "kind", "url", F.desc("is_response"), "row")
    manifest = stored(dealt.mapInPandas(_written(folder, file_bytes), _WRITTEN), "warc-manifest")
    moved = manifest.mapInPandas(_moved(folder), _WRITTEN)
    files = sorted(moved.select("name", "records", "bytes", "sha256").collect())  # a row for each file
    listing = f"{path}/{MANIFEST}"
    with system.open_output_stream(f"{listing}.temporary") as out:
        for r in files:
            out.write((json.dumps(r.asDict()) + "\n").encode())
    system.move(f"{listing}.temporary", listing)
    return Archive(folder, manifest.drop("temporary"))


# --- reading --------------------------------------------------------------------------------------


def _members(stream) -> Iterator[bytes]:
    """The uncompressed gzip members of a stream, one at a time."""
    inflate, parts, rest = zlib.decompressobj(wbits=31), [], b""
    while data := rest or stream.read(1 << 20):
        parts.append(inflate.decompress(data))
        rest = b""
        if inflate.eof:
            rest = inflate.unused_data
            yield b"".join(parts)
            inflate, parts = zlib.decompressobj(wbits=31), []
    if parts:
        raise ValueError("the archive ends within a record")


def _parsed(record: bytes) -> dict | None:
    """The row of one record, digests checked; None for records about the file."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    named = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(named["Content-Length"])]
    if version != VERSION or rest[len(block) :] != b"\r\n\r\n" or _digest(block) != named["WARC-Block-Digest"]:
        raise ValueError(f"damaged record {named.get('WARC-Record-ID')}")
    if named["WARC-Type"] not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    is_response = named["WARC-Type"] == "response"
    if is_response and (len(payload) != size or _digest(payload) != named["WARC-Payload-Digest"]):
        raise ValueError(f"damaged payload {named['WARC-Record-ID']}")
    return {
        "page_id": page_of(named["WARC-Record-ID"]),
        "payload_bytes": size,
        "payload_digest": named["WARC-Payload-Digest"].removeprefix("sha1:"),
        "record_type": named["WARC-Type"],
        "refers_to": None if is_response else page_of(named["WARC-Refers-To"]),
        "url": named["WARC-Target-URI"],
        "payload": payload if is_response else None,
    }


def _read(folder: str, with_payload: bool):
    def run(batches):
        system, path = _filesystem(folder)
        for batch in batches:
            for name in batch["name"]:
                rows, held = [], 0
                with system.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for member in _members(stream):
                        row = _parsed(member)
                        if row is None:
                            continue
                        payload = row.pop("payload")
                        rows.append({**row, "payload": payload} if with_payload else row)
                        held += len(member) if with_payload else 100
                        if held > 8 << 20:
                            yield _frame(rows)
                            rows, held = [], 0
                if rows:
                    yield _frame(rows)

    return run


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows).astype({"page_id": "Int64", "refers_to": "Int64"})


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Rows of all page records of a committed archive, in no order: ``page_id``, ``payload_bytes``,
    ``payload_digest`` (base32 SHA-1), ``record_type``, ``refers_to`` (page id), ``url``, and ``payload``
    (binary, null for revisits) if asked for.

    Block and payload digests are checked; a damaged or cut record is an error. One task reads a file at a
    time, record by record. A folder without a manifest was not committed and is an error.
    """
    listing = spark.read.schema("name string, bytes long").json(f"{folder.rstrip('/')}/{MANIFEST}")
    files = listing.repartition(max(1, min(listing.count(), 100_000)))
    return files.mapInPandas(_read(folder, with_payload), _READ + (", payload binary" if with_payload else ""))
