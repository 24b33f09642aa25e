"""WARC archives: a deterministic sharded writer, and its reader.

Records are range-sorted by page id: cuts of like bytes are computed from all rows
(``cuts``), not from a sample, and each task writes its range into files rolled by compressed size, one gzip member a record, with headers and digests made anew from the
payload. A file is written under a temporary name and renamed when whole; the manifest,
written last, names the files that count. Same rows and settings give the same bytes:
shards follow from the rows alone, record ids from the page id and payload, the date
is a parameter.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest
page id is a ``response``; others are ``revisit`` records without a payload that refer
to it. Each payload passes one shuffle; what is looked up across the table are digests.

Defined results: a null html is an empty payload; a null url gives an empty target; a null
page id is written without one, sorts first and is never the response that others refer
to unless all of the group are null; of rows with equal id and payload the first written
is the response if the id is the smallest; repeated rows give a record each; an empty
table gives an empty manifest; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.cuts import LOWEST, range_cuts, shard_of, shards_for
from hourglass.llm.joins import join_measured
from hourglass.llm.shared_files import committed_output, open_input, qualified, ship_package
from hourglass.session import work_dir

LEAST_DEDUP_BYTES = 100
ROLL_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")   # fixed value: the URL namespace
MANIFEST_SCHEMA = ("shard int, part int, file string, n_records long, n_bytes long, sha256 string, "
                   "first_page_id long, last_page_id long")
RECORD_SCHEMA = ("page_id long, url string, record_type string, refers_to long, payload_bytes long, "
                 "payload_digest string, payload binary")


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}')}>"


def header_value(text: str) -> str:
    """A value on one line: characters that cannot stand in a header are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f\x85\u2028\u2029%]",
                  lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), text)


def plain_value(text: str) -> str:
    """The inverse of ``header_value``."""
    return re.sub(r"(?:%[0-9A-F]{2})+", lambda m: bytes.fromhex(m[0].replace("%", "")).decode(), text)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, response_id: int | None,
           revisit: bool, date: str) -> bytes:
    """The bytes of a record, uncompressed."""
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
            ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", header_value(url)))
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_id(response_id, digest))]
        if response_id is not None:
            head.append(("X-Refers-To-Page-Id", str(response_id)))
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    else:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                 + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload)
    head += [("Content-Type", "application/http; msgtype=response"),
             ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def gzip_member(raw: bytes, level: int) -> bytes:
    """One gzip member without a time, so equal records give equal bytes."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


class RollingFiles:
    """Files of one shard; a new one begins when the last has reached ``roll_bytes``."""

    def __init__(self, out_dir: str, shard: int, attempt: str, roll_bytes: int):
        self._dir, self._shard, self._attempt, self._roll = out_dir, shard, attempt, roll_bytes
        self._open = None
        self.parts: list[tuple] = []
        self._begun = 0

    def add(self, page_id: int | None, member: bytes) -> None:
        if self._open is None:
            name = f"pages-{self._shard:06d}-{self._begun:05d}.warc.gz"
            context = committed_output(f"{self._dir}/{name}", self._attempt)
            self._open = [name, context, context.__enter__(), 0, 0, hashlib.sha256(), page_id]
            self._begun += 1
        state = self._open
        state[2].write(member)
        state[3] += 1
        state[4] += len(member)
        state[5].update(member)
        self._last = page_id
        if state[4] >= self._roll:
            self.close()

    def close(self) -> None:
        if self._open is not None:
            name, context, _, n, size, sha, first = self._open
            context.__exit__(None, None, None)
            self.parts.append((self._shard, self._begun - 1, name, n, size, sha.hexdigest(), first, self._last))
            self._open = None

    def abandon(self, error: BaseException) -> None:
        if self._open is not None:
            context, self._open = self._open[1], None
            try:
                context.__exit__(type(error), error, error.__traceback__)
            except BaseException as again:
                if again is not error:
                    raise


def responses(pages: DataFrame, least: int) -> DataFrame:
    """(digest, response_id): the smallest page id of each payload that occurs twice or more."""
    return (pages.where(F.col("n_bytes") >= least).groupBy("digest")
            .agg(F.count("*").alias("n"), F.min("page_id").alias("response_id"))
            .where("n > 1").select("digest", "response_id"))


def write_warc(pages: DataFrame, out_dir: str, least: int = LEAST_DEDUP_BYTES, roll_bytes: int = ROLL_BYTES,
               date: str = DATE, level: int = 6, shards: int | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``out_dir``; returns the manifest.

    ``shards`` is their number about; without it, it follows from the payloads' bytes.
    """
    spark = pages.sparkSession
    ship_package(spark)
    out_dir = qualified(spark, out_dir)
    html = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("payload")) \
        .withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.length("payload")})
    # Ids, digests and lengths, read once from the pages.
    folder = work_dir(spark, "warc-digests")
    keyed.select("page_id", "digest", "n_bytes").write.parquet(folder)
    named = spark.read.schema("page_id long, digest string, n_bytes int").parquet(folder)
    key = F.coalesce("page_id", F.lit(LOWEST).cast("long"))
    sized = named.select(key.alias("key"), (F.col("n_bytes") + 500).cast("long").alias("n_bytes"))
    ids = sized.where(F.col("key") != LOWEST)
    total = sized.agg(F.sum("n_bytes")).first()[0] or 0
    least_id = ids.agg(F.min("key")).first()[0]
    if least_id is not None and least_id > LOWEST:      # nulls stand right before the least id
        key = F.coalesce("page_id", F.lit(least_id - 1).cast("long"))
        sized = sized.withColumn("key", F.greatest("key", F.lit(least_id - 1).cast("long")))
    cuts = range_cuts(sized, shards or shards_for(total))
    repeats = join_measured(named, responses(named, least), ["digest"], "inner", F.col("page_id"))
    # What a record needs to know of its group travels as a row of its own that sorts right
    # before the record, so payloads are shuffled once, by range.
    notes = repeats.groupBy("page_id", "digest").agg(F.first("response_id").alias("response_id")).select(
        "page_id", "digest", F.lit(0).alias("kind"), "response_id", F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("binary").alias("payload"))
    records = keyed.select("page_id", "digest", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("response_id"),
                           "url", "payload")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()      # its partition is the shard: rows are dealt by id
        files = RollingFiles(out_dir, task.partitionId(), str(task.taskAttemptId()), roll_bytes)
        note = written = None
        try:
            for batch in batches:
                columns = [batch.column(k) for k in range(batch.num_columns)]
                for i in range(batch.num_rows):
                    page_id, digest, kind, response_id, url, payload = (c[i].as_py() for c in columns)
                    key = (page_id, digest)
                    if kind == 0:
                        note = (key, response_id)
                        continue
                    known = note is not None and note[0] == key
                    # The first record of the smallest id stands for the group.
                    revisit = known and not (page_id == note[1] and written != key)
                    raw = record(page_id, url, payload, digest, note[1] if revisit else None, revisit, date)
                    files.add(page_id, gzip_member(raw, level))
                    written = key
            files.close()
        except BaseException as e:
            files.abandon(e)
            raise
        if files.parts:
            columns = list(zip(*files.parts, strict=True))
            kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            names = [f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    # Rows of one page and payload stay together; a page id that many rows share is split by payload.
    every = records.unionByName(notes)
    ordered = every.repartitionById(len(cuts) + 1, shard_of(key, F.col("digest"), cuts)) \
        .sortWithinPartitions("page_id", "digest", "kind", "url")
    ordered.mapInArrow(write, MANIFEST_SCHEMA).write.mode("overwrite").parquet(f"{out_dir}/manifest.parquet")
    return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out_dir}/manifest.parquet")


def read_members(path: str, step: int = 1 << 20) -> Iterator[bytes]:
    """The uncompressed gzip members of a file, one at a time."""
    with open_input(path) as f:
        rest, unpacker, out = b"", None, []
        while True:
            if not rest:
                rest = f.read(step)
                if not rest:
                    break
            unpacker = unpacker or zlib.decompressobj(31)
            out.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(out)
                unpacker, out = None, []
        if unpacker is not None:
            raise ValueError(f"{path} ends inside a record")


def parse_record(raw: bytes) -> tuple:
    """A row of ``RECORD_SCHEMA``; digests are checked."""
    head, _, block = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = block[:int(fields["Content-Length"])]
    if "sha256:" + hashlib.sha256(block).hexdigest() != fields["WARC-Block-Digest"]:
        raise ValueError(f"{fields['WARC-Record-ID']}: the block does not match its digest")
    payload = block.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    if payload is not None and (hashlib.sha256(payload).hexdigest(), len(payload)) != (digest, size):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    url = fields.get("WARC-Target-URI")
    return (number("X-Page-Id"), None if url is None else plain_value(url), fields["WARC-Type"],
            number("X-Refers-To-Page-Id"), size, digest, payload)


def read_warc(spark: SparkSession, out_dir: str, payloads: bool = True) -> DataFrame:
    """The records of the files in the manifest; without payloads if not asked for."""
    ship_package(spark)
    out_dir = qualified(spark, out_dir)
    files = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{out_dir}/manifest.parquet").select("shard", "part", "file")
    schema = RECORD_SCHEMA if payloads else RECORD_SCHEMA.removesuffix(", payload binary")
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()][:len(names)]

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(kinds)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                found, held = [], 0
                for member in read_members(f"{out_dir}/{name}"):
                    found.append(parse_record(member))
                    held += len(member) if payloads else 200
                    if held > 8 << 20:
                        yield rows(found)
                        found, held = [], 0
                if found:
                    yield rows(found)

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartitionByRange(n, "shard", "part").mapInArrow(read, schema)
