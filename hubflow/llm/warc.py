"""WARC archives compressed with Zstandard: one frame per record, dictionary in the leading skippable frame.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself possibly a
Zstandard frame; then every record is one frame.  The reader streams a file: it loads the dictionary, decodes
frame by frame, and checks the version line, the named fields every record must have, the block's length
against Content-Length, the HTTP body's length, and the digests.  A bad record raises ``BadRecord``.

Definitions: a null html is an empty payload; a null url gives a record without a target; a null page_id is
kept (id ``urn:x-page:``) and is never the response of a group with known page_ids; rows that share the largest
page_id of their group are responses all; an empty table gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hubflow.llm.common import CommittedFile, file_list, filesystem, work_dir, written

#: Fixed values of the format.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, b"\x28\xb5\x2f\xfd"
VERSION, PROFILE = b"WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Records that a file's dictionary is fitted on, their bytes, the dictionary's, and compressed bytes to a file.
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES, FILE_BYTES = 200, 2 << 20, 32 << 10, 512 << 20
REVISIT_BYTES = 1_000
MANIFEST = "path string, records long, bytes long"
RECORDS = ("path string, frame_offset long, record_id string, record_type string, refers_to string, target_uri string, "
           "payload_bytes long, payload_digest string, payload binary")


#: Bytes that a frame's decoder is given at a time.
PIECE = 4096


class BadRecord(ValueError):
    pass


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to, date: str) -> bytes:
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    block = http if kind == "revisit" else http + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x-page:{'' if page_id is None else page_id}>"),
              ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("WARC-Block-Digest", "sha1:" + hashlib.sha1(block).hexdigest()),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:x-page:{refers_to}>")]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def _archives(folder: str, date: str):
    """Writes each task's rows as archives; the dictionary is fitted on the file's first records."""
    def run(batches):
        import zstandard as zstd
        from pyspark import TaskContext

        rows = (row for b in batches for row in zip(*(b.column(i).to_pylist() for i in range(b.num_columns))))
        part = TaskContext.get().partitionId()
        number, pending = 0, next(rows, None)
        while pending is not None:
            first, held = [], 0
            while pending is not None and len(first) < SAMPLE_RECORDS and held < SAMPLE_BYTES:
                first.append(record(*pending, date))
                held += len(first[-1])
                pending = next(rows, None)
            try:
                dictionary = zstd.train_dictionary(DICTIONARY_BYTES, [r[:64 << 10] for r in first])
            except zstd.ZstdError:  # too few or too small records
                dictionary = None
            packer = zstd.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True, write_content_size=True)
            name, records, size = f"{folder}/part-{part:06d}-{number:04d}.warc.zst", 0, 0
            with CommittedFile(name) as f:
                if dictionary is not None:
                    raw = zstd.ZstdCompressor(level=19).compress(dictionary.as_bytes())
                    f.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
                    size += 8 + len(raw)
                for r in first:
                    f.write(frame := packer.compress(r))
                    records, size = records + 1, size + len(frame)
                while pending is not None and size < FILE_BYTES:
                    f.write(frame := packer.compress(record(*pending, date)))
                    records, size = records + 1, size + len(frame)
                    pending = next(rows, None)
            number += 1
            yield pa.record_batch([pa.array([name]), pa.array([records], pa.int64()), pa.array([size], pa.int64())],
                                  names=["path", "records", "bytes"])
    return run


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes (page_id, url, html) rows; returns the written manifest (path, records, bytes).

    Of equal payloads of at least REVISIT_BYTES, the one with the largest page_id is the response.  Only digests
    that occur more than once are joined back; the join's sides are plain exchanges, so that AQE splits a digest
    that holds many rows.
    """
    rows = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
            .withColumn("digest", F.sha1("payload")))
    copies = (rows.filter(F.octet_length("payload") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1")
              .select(F.unhex("digest").alias("copied"), "keeper"))
    kept = rows.join(copies, F.unhex("digest") == F.col("copied"), "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    out = kept.select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"),
                      F.when(revisit, F.col("keeper")).alias("refers"))
    return written(out.mapInArrow(_archives(folder, date), MANIFEST), "warc-manifest")


def frames(stream, chunk: int = 1 << 20):
    """(offset, decoded bytes) of each frame of a stream; loads the dictionary of the leading skippable frame."""
    import zstandard as zstd

    data, at, offset, leading = b"", 0, 0, True  # offset: of data[at] in the archive
    decoder = zstd.ZstdDecompressor()

    def more(need: int) -> bool:
        """At least ``need`` bytes from ``at`` on; what lies before is dropped when a chunk is added."""
        nonlocal data, at
        while len(data) - at < need:
            if not (got := stream.read(max(chunk, need - (len(data) - at)))):
                return False
            data, at = data[at:] + got, 0
        return True

    while more(4) or at < len(data):
        if len(data) - at < 4:
            raise BadRecord(f"{len(data) - at} stray bytes at {offset}")
        magic = struct.unpack_from("<I", data, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            if not more(8) or not more(8 + struct.unpack_from("<I", data, at + 4)[0]):
                raise BadRecord(f"skippable frame cut off at {offset}")
            size = struct.unpack_from("<I", data, at + 4)[0]
            if leading and magic == DICTIONARY_MAGIC:
                raw = data[at + 8:at + 8 + size]
                dictionary = zstd.ZstdCompressionDict(zstd.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME_MAGIC else raw)
                decoder = zstd.ZstdDecompressor(dict_data=dictionary)
            at, offset, leading = at + 8 + size, offset + 8 + size, False
            continue
        leading = False
        if data[at:at + 4] != FRAME_MAGIC:
            raise BadRecord(f"no frame at {offset}")
        one, out, used = decoder.decompressobj(), [], 0
        try:
            while not one.eof:
                if at == len(data) and not more(1):
                    raise BadRecord(f"frame cut off at {offset}")
                piece = memoryview(data)[at:at + PIECE]  # what the decoder leaves over is at most a piece
                out.append(one.decompress(piece))
                taken = len(piece) - len(one.unused_data)
                at, used = at + taken, used + taken
        except zstd.ZstdError as e:
            raise BadRecord(f"frame at {offset}: {e}") from e
        yield offset, b"".join(out)
        offset += used


def parse(data: bytes, offset: int = 0) -> tuple[dict, bytes]:
    """(named fields in lower case, block) of one record; lengths and digests are checked."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise BadRecord(f"record at {offset}: no WARC header")
    fields = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        if not colon or not key.strip():
            raise BadRecord(f"record at {offset}: bad field {line[:60]!r}")
        fields[key.strip().lower().decode()] = value.strip().decode()
    if missing := [k for k in REQUIRED if k not in fields]:
        raise BadRecord(f"record at {offset}: no {', '.join(missing)}")
    if not fields["content-length"].isdigit() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise BadRecord(f"record at {offset}: Content-Length {fields['content-length']}, block of {len(rest) - 4}")
    block = rest[:-4]
    digest = fields.get("warc-block-digest")
    if digest and digest != "sha1:" + hashlib.sha1(block).hexdigest():
        raise BadRecord(f"record at {offset}: block digest differs")
    return fields, block


def payload_of(fields: dict, block: bytes, offset: int) -> tuple[bytes | None, int, str]:
    """(payload or None for a revisit, its full length, its SHA-1) of an HTTP response or revisit."""
    http, _, body = block.partition(b"\r\n\r\n")
    found = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    length = int(found[1]) if found else len(body)
    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if fields["warc-type"] == "revisit":
        if body or "warc-refers-to" not in fields:
            raise BadRecord(f"record at {offset}: a revisit with a body or without its response")
        return None, length, declared
    digest = hashlib.sha1(body).hexdigest()
    if len(body) != length or declared and declared != digest:
        raise BadRecord(f"record at {offset}: payload of {len(body)} bytes differs from its length or digest")
    return body, length, digest


def _records(with_payload: bool):
    bare = lambda uri: uri.strip("<>") if uri else uri

    def run(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, path = filesystem(uri)
                out, held = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for offset, data in frames(stream):
                        fields, block = parse(data, offset)
                        payload, length, digest = payload_of(fields, block, offset)
                        out.append((uri, offset, bare(fields["warc-record-id"]), fields["warc-type"],
                                    bare(fields.get("warc-refers-to")), fields.get("warc-target-uri"), length, digest,
                                    payload if with_payload else None))
                        held += len(block) if with_payload else 200
                        if held > 16 << 20:
                            yield _batch(out)
                            out, held = [], 0
                if out:
                    yield _batch(out)

    def _batch(out):
        s, n = pa.string(), pa.int64()
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), (s, n, s, s, s, s, n, s, pa.binary()))],
                               names=["path", "frame_offset", "record_id", "record_type", "refers_to", "target_uri",
                                      "payload_bytes", "payload_digest", "payload"])
    return run


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the manifest's files (a table with a ``path`` column)."""
    return file_list(manifest, "path").mapInArrow(_records(with_payload), RECORDS)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages to a new shared folder and reads them back: page_id, payload_bytes, payload_digest,
    record_type, refers_to (page_id of the response, for revisits)."""
    spark = pages.sparkSession
    manifest = write_archives(pages, work_dir(spark, "warc"))
    page = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) as long)")
    return read_archives(spark, manifest, with_payload=False).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))
