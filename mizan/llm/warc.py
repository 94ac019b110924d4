"""WARC archives: a deterministic sharded writer and its reader.

Records are range-sorted by key, each is a gzip member of its own, files roll by compressed
size, and headers and digests are made anew.  Tasks write under temporary names that no other
attempt uses; a manifest says which of them count, and only then they get their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, bounded, discard, fresh_path, slices, staged, table
from .graph import meet

#: Payload bytes that a shard holds at least; shards by range at most, beyond which they grow.
SHARD_BYTES, MOST_SHARDS = 16 << 20, 32_768
#: Compressed bytes from which on a file is closed: this share of a shard's payload, between both bounds.
ROLL_SHARE, LEAST_ROLL, MOST_ROLL = 8, 4 << 20, 1 << 30
#: What a record counts for besides its payload, in bytes; bounds that a lookup compares with at once.
RECORD_BYTES, STEP = 512, 128
DATE = "2020-01-01T00:00:00Z"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(kind: str, key: int | None, url: str, payload: bytes, refers: int | None = None) -> bytes:
    """One WARC/1.1 record, not compressed; a revisit leaves its payload out."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:uuid:{record_id(key, url, digest)}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": header_text(url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32(hashlib.sha1(block).digest())}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if key is not None:
        head["X-Record-Key"] = str(key)
    if kind == "revisit":
        head |= {"WARC-Profile": _PROFILE, "X-Refers-To-Key": str(refers)}
    return framed(head, block)


def framed(head: dict[str, str], block: bytes) -> bytes:
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def record_id(key: int | None, url: str, digest: str) -> uuid.UUID:
    return uuid.uuid5(_NAMESPACE, f"{key} {digest} {url}")


def header_text(text: str) -> str:
    """A header's value in one line."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A") if "\n" in text or "\r" in text else text


def member(data: bytes) -> bytes:
    """A gzip member without a time stamp."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; ValueError where length or digests do not hold."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    n = int(headers["Content-Length"])
    block = rest[:n]
    if not lines[0].startswith("WARC/1.") or rest[n:] != b"\r\n\r\n" or headers.get("WARC-Block-Digest") not in (None, f"sha1:{base32(hashlib.sha1(block).digest())}"):
        raise ValueError(f"a record is damaged: {headers.get('WARC-Record-ID')}")
    return headers, block


def members(stream):
    """The content of each gzip member; holds one of them at a time."""
    z, out = zlib.decompressobj(31), []
    while chunk := stream.read(1 << 20):
        while chunk:
            out.append(z.decompress(chunk))
            chunk = b""
            if z.eof:
                yield b"".join(out)
                chunk, z, out = z.unused_data, zlib.decompressobj(31), []
    if any(out):
        raise ValueError("the last member is not whole")


def revisits(rows: DataFrame, total: int, least: int) -> DataFrame:
    """(key, digest, refers) of the records that revisit another: those with equal payloads of ``least`` bytes
    at least, but for the largest key; groups' keys are pre-aggregated, and hot groups joined by broadcast."""
    ids = rows.where(F.length("payload") >= least).select("key", F.unhex(F.sha1("payload")).alias("digest"))
    groups = ids.groupBy("digest").agg(F.max("key").alias("refers"), F.count("*").alias("n")).where("n > 1")
    both = meet(ids, staged(groups, "warc-groups"), "digest", total)
    return both.where(F.col("refers").isNotNull() & (F.col("key").isNull() | (F.col("key") < F.col("refers")))).select("key", "digest", "refers").distinct()


def shards(rows: DataFrame, shard_bytes: int, most: int = MOST_SHARDS) -> tuple[list[tuple], int, int, int]:
    """Ranges of keys as (first key, first shard, number of shards), rising, null first; how many shards, rows and bytes a shard there are.

    Bounds are exact quantiles of the bytes in key order: sizes are summed by key, sorted by range, and each
    range's sum is added to what comes before, so equal tables get equal bounds whatever the partitions were,
    and no arithmetic is done on keys.  A key with more bytes than a shard gets a range and several shards of its own."""
    sizes = rows.groupBy("key").agg(F.sum(F.length("payload") + RECORD_BYTES).alias("bytes"), F.count("*").alias("n"))
    sizes = staged(sizes.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "warc-sizes")
    sums = sizes.groupBy("part").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).orderBy("part").collect()  # one row a partition
    total, count = sum(r.bytes for r in sums), sum(r.n for r in sums)
    goal = max(shard_bytes, -(-total // most))
    before, at = [], 0
    for r in sums:
        before.append((r.part, at))
        at += r.bytes
    offsets = rows.sparkSession.createDataFrame(before or [(0, 0)], "part int, before bigint")
    w = Window.partitionBy("part").orderBy(F.asc_nulls_first("key")).rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("bytes").over(w), F.lit(0))
    placed = sizes.join(F.broadcast(offsets), "part").select("key", "bytes", F.floor(start / goal).alias("place"))
    ranges = placed.groupBy("place", F.col("key").isNull().alias("none"), (F.col("bytes") > goal).alias("big")).agg(F.min("key").alias("first"), F.sum("bytes").alias("bytes")).collect()
    plan, shard = [], 0
    for r in sorted(ranges, key=lambda r: (not r.none, r.first or 0)):
        parts = -(-r.bytes // goal) if r.big else 1
        plan.append((None if r.none else r.first, shard, parts))
        shard += parts
    discard(sizes)
    return plan, max(1, shard), count, goal


def numbers(values: list[int]) -> Column:
    """A constant array; as one literal, however long."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def shard_of(plan: list[tuple], key: Column, digest: Column) -> Column:
    """The shard of a row: its key's range is looked up in two steps; in a range of several shards the payload's digest decides."""
    none = [p for p in plan if p[0] is None]
    rest = [p for p in plan if p[0] is not None]
    bounds = numbers([p[0] for p in rest])
    upto = lambda of: F.size(F.filter(of, lambda b: b <= key))
    step = F.greatest(upto(numbers([p[0] for p in rest[::STEP]])) - 1, F.lit(0)) * STEP
    index = F.when(key.isNull(), 0).otherwise(step + upto(F.slice(bounds, step + 1, F.lit(STEP))) - 1 + len(none))
    every = none + rest
    first, parts = F.get(numbers([p[1] for p in every]), index), F.get(numbers([p[2] for p in every]), index)
    return F.coalesce(F.when(parts > 1, first + F.pmod(F.xxhash64(digest), parts)).otherwise(first), F.lit(0)).cast("int")


def write(rows: DataFrame, path: str, roll_bytes: int | None = None, shard_bytes: int = SHARD_BYTES, least: int = 0) -> DataFrame:
    """Writes rows (key long, url string, payload binary) as WARC files under ``path``, which must be new; returns the manifest.

    Null payloads count as empty, null urls as ``about:blank``; null keys sort first.  Of rows with
    equal payloads those with the largest key are responses, even if it occurs twice.
    Equal tables give equal files, names and manifests whatever the partitions were.  Files follow the order of
    keys; only the records of a single key that fills several shards are dealt to them by digest.
    """
    spark = rows.sparkSession
    rows = rows.select("key", F.coalesce("url", F.lit("about:blank")).alias("url"), F.coalesce("payload", F.lit(bytearray())).alias("payload"))
    plan, n, count, goal = shards(rows, shard_bytes)
    roll = roll_bytes or max(LEAST_ROLL, min(MOST_ROLL, goal // ROLL_SHARE))
    again = revisits(rows, count, least)
    # What is a revisit comes before the payloads of its key, in the same shard: no join moves a payload.
    none = F.lit(None)
    digest = F.unhex(F.sha1("payload"))
    records = rows.select(shard_of(plan, F.col("key"), digest).alias("shard"), "key", F.lit(1).alias("what"), "url", "payload", none.cast("binary").alias("digest"), none.cast("bigint").alias("refers"))
    notes = again.select(shard_of(plan, F.col("key"), F.col("digest")).alias("shard"), "key", F.lit(0).alias("what"), none.cast("string").alias("url"), none.cast("binary").alias("payload"), "digest", "refers")
    dealt = records.unionByName(notes)
    dealt = dealt.repartitionById(n, "shard").sortWithinPartitions(F.asc_nulls_first("key"), "what", "url", "payload")
    bounded(spark)
    temporary = f"{path}/_temporary"

    def put(batches):
        yield from written(batches, temporary, roll)

    manifest = dealt.mapInArrow(put, "shard int, seq int, temporary string, name string, bytes bigint, sha1 string, records bigint, first_key bigint, last_key bigint")
    manifest.write.parquet(f"{path}/_manifest")
    manifest = spark.read.parquet(f"{path}/_manifest")

    def name_them(batch: pa.RecordBatch) -> pa.RecordBatch:
        files, root = fs.FileSystem.from_uri(path)
        for old, new in zip(batch.column("temporary").to_pylist(), batch.column("name").to_pylist()):
            if files.get_file_info(f"{root}/{new}").type == fs.FileType.NotFound:  # else an earlier attempt did it
                files.move(f"{root}/_temporary/{old}", f"{root}/{new}")
        return pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})

    named = arrow_map(manifest.repartition(min(64, max(1, n))), name_them, "n bigint").agg(F.sum("n")).first()[0] or 0
    files, root = fs.FileSystem.from_uri(path)
    if files.get_file_info(f"{root}/_temporary").type != fs.FileType.NotFound:
        files.delete_dir(f"{root}/_temporary")
    with files.open_output_stream(f"{root}/_SUCCESS.new") as out:
        out.write(json.dumps({"files": named}).encode())
    files.move(f"{root}/_SUCCESS.new", f"{root}/_SUCCESS")
    return manifest


def written(batches, temporary: str, roll_bytes: int):
    """Writes one task's sorted rows; yields the manifest's rows for the files it closed."""
    files, root = fs.FileSystem.from_uri(temporary)
    attempt, out, shard, row, refers, at_key = uuid.uuid4().hex, None, None, None, {}, object()
    seqs: dict[int, int] = {}

    def close():
        nonlocal out
        out.close()
        out = None
        done = row | {"sha1": row["sha1"].hexdigest()}
        return pa.record_batch({k: pa.array([v], _KINDS[k]) for k, v in done.items()})

    for batch in (part for b in batches for part in slices(b)):
        for s, key, what, url, payload, digest, ref in zip(*(c.to_pylist() for c in batch.columns)):
            if key != at_key:
                refers, at_key = {}, key
            if not what:
                refers[digest] = ref
                continue
            if out is not None and (s != shard or row["bytes"] >= roll_bytes):
                yield close()
            if out is None:
                shard, seq = s, seqs.get(s, 0)
                seqs[s] = seq + 1
                name = f"part-{s:05d}-{seq:05d}.warc.gz"
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(f"{root}/{attempt}-{name}", compression=None)
                row = {"shard": s, "seq": seq, "temporary": f"{attempt}-{name}", "name": name, "bytes": 0, "sha1": hashlib.sha1(), "records": 0, "first_key": key, "last_key": key}
                info = framed({"WARC-Type": "warcinfo", "WARC-Record-ID": f"<urn:uuid:{uuid.uuid5(_NAMESPACE, name)}>", "WARC-Date": DATE, "WARC-Filename": name, "Content-Type": "application/warc-fields", "Content-Length": "20"}, b"format: WARC/1.1\r\n\r\n")
                _put(out, row, member(info))
            ref = refers.get(hashlib.sha1(payload).digest()) if refers else None
            _put(out, row, member(record("response" if ref is None else "revisit", key, url, payload, ref)))
            row["records"] += 1
            row["last_key"] = key
    if out is not None:
        yield close()


_KINDS = {"shard": pa.int32(), "seq": pa.int32(), "temporary": pa.string(), "name": pa.string(), "bytes": pa.int64(), "sha1": pa.string(), "records": pa.int64(), "first_key": pa.int64(), "last_key": pa.int64()}


def _put(out, row: dict, data: bytes) -> None:
    out.write(data)
    row["bytes"] += len(data)
    row["sha1"].update(data)


def read(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of an archive that write() made, checked against their digests; files that the manifest does not name are ignored.

    Columns key, url, record_type, payload_bytes, payload_digest, refers_to and, if asked for, payload (null for revisits)."""
    manifest = spark.read.parquet(f"{path}/_manifest").select("name")
    n = manifest.count()
    kinds = {"key": pa.int64(), "url": pa.string(), "record_type": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64()} | ({"payload": pa.binary()} if payloads else {})
    schema = "key bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint" + ", payload binary" * payloads

    def run(batches):
        files, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name in batch.column("name").to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for data in members(stream):
                        if (r := fields(*parsed(data))) is None:
                            continue
                        rows.append(r if payloads else r[:-1])
                        held += len(r[-1] or b"") if payloads else 200
                        if len(rows) >= 1000 or held > 4 << 20:
                            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))
                            rows, held = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))

    return manifest.repartition(max(1, min(n, 10_000))).mapInArrow(run, schema)


def fields(head: dict[str, str], block: bytes) -> tuple | None:
    """What a row holds of a record; None for records about the archive itself."""
    kind = head["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    n = next(int(line.split(b":")[1]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != n or base32(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"a payload is damaged: {head['WARC-Record-ID']}")
    key, refers = head.get("X-Record-Key"), head.get("X-Refers-To-Key")
    return key and int(key), head["WARC-Target-URI"], kind, n, digest, refers and int(refers), payload if kind == "response" else None


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per page, as read back from the archives: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload.  A null page_id is smaller than any other and revisits; pages that
    repeat the largest page_id of their payload are responses, too.
    """
    pages = table(spark, sf_dir, "pages", F.col("page_id").cast("bigint").alias("key"), "url", F.col("html").cast("binary").alias("payload"))
    path = fresh_path(spark, "warc")
    write(pages, path)
    return read(spark, path).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


_ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
), m AS (SELECT h, max(page_id) AS top FROM p GROUP BY h)
SELECT p.page_id AS page_id,
       CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(p.h, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INT), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN p.page_id < m.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < m.top THEN m.top END AS refers_to
FROM p JOIN m ON p.h = m.h
"""
QUERIES = {"op1_warc": op1_warc}
ORACLES = {"op1_warc": _ORACLE}
