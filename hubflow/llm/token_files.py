"""Token files: frequency-ranked ids, byte-aligned variable-length codes, control bytes kept apart.

A corpus folder holds ``ranks.u32`` (the token id of each rank, most frequent first) and one
``part-*.svb`` per range of doc_id.  A file is ``HEAD``, then per document a block header, its
control bytes (two bits an id: its number of bytes less one) and its data bytes, then a trailer with the file's
totals.  Decoding needs no loop over ids: byte lengths, masks and token ids all come from numpy tables.

Definitions: a null text is an empty one; the end id is appended to every document; a null doc_id sorts
first; rows with equal doc_id keep a stable place next to each other and each has its own block; an empty
table gives no files and no rows; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hubflow.llm.common import CommittedFile, file_list, filesystem, parallelism, slices, work_dir, written
from hubflow.llm.tokenization import encoded, vocabulary_size

HEAD, TAIL = b"SVBTOK01", b"SVBEND01"
#: Layout of a block header (doc_id known, doc_id, ids, data bytes) and of the trailer (documents, ids, mark).
BLOCK, TRAILER = "<?qQQ", "<QQ8s"
#: Documents that one file holds on average, beyond the cluster's parallelism.
DOCS_PER_FILE = 100_000
#: Bytes of ids that a task holds before it hands them on.
HELD_BYTES = 4 << 20

_LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1
_MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_ids(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of 32-bit numbers."""
    r = np.ascontiguousarray(ranks, "<u4")
    extra = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    codes = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    codes[:len(r)] = extra
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    width = int(extra.max(initial=0)) + 1
    used = np.arange(width, dtype=np.uint8) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), r.view(np.uint8).reshape(-1, 4)[:, :width][used].tobytes()


def unpack_ids(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    if (int(ends[-1]) if n else 0) != len(data) or len(control) != -(-n // 4):
        raise ValueError("token block: control bytes and data bytes disagree")
    at = ends - lengths
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    words = raw[at].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):  # bytes that no number of the block has are not looked up
        words |= raw[at + k].astype(np.uint32) << np.uint32(8 * k)
    return words & _MASKS[lengths]


def _tokenize(path: str, end_id: int, vocab: int, width: str):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(vocab, np.int64)
        for b in batches:
            first, held, size = 0, [], 0
            for i, ids in encoded(path, b.column(1), end_id):
                held.append(ids.astype(width, copy=False).tobytes())
                size += len(held[-1])
                if size > HELD_BYTES or i == b.num_rows - 1:
                    counts += np.bincount(np.frombuffer(b"".join(held), width), minlength=vocab)
                    yield pa.record_batch([b.column(0).slice(first, len(held)), pa.array(map(zlib.crc32, held), pa.int64()),
                                           pa.array(held, pa.binary()), pa.nulls(len(held), pa.binary())], schema=schema)
                    first, held, size = i + 1, [], 0
        if counts.any():  # one row for each task: how often it met each id
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                   pa.array([counts.tobytes()], pa.binary())], schema=schema)
    return run


def _frequencies(batches):
    for b in batches:
        total = np.zeros(0, np.int64)
        for _, some in slices(b.column(0)):
            for c in some:
                total = np.frombuffer(c, np.int64) + (total if len(total) else 0)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["id", "n"])


def _write_files(folder: str, rank_of: np.ndarray, width: str):
    """One file for the rows of a task; its name is the task's place among the ranges, so a retry replaces it."""
    def run(batches):
        from pyspark import TaskContext

        bucket, docs, tokens = TaskContext.get().partitionId(), 0, 0
        name, out = f"{folder}/part-{bucket:08d}.svb", None
        for b in batches:
            if not b.num_rows:
                continue
            if out is None:
                out = CommittedFile(name)
                out.write(HEAD)
            keys = b.column(0)
            for first, some in slices(b.column(1)):
                for i, raw in enumerate(some, first):
                    key, ids = keys[i].as_py(), np.frombuffer(raw, width)
                    control, data = pack_ids(rank_of[ids])
                    out.write(struct.pack(BLOCK, key is not None, key or 0, len(ids), len(data)) + control + data)
                    docs, tokens = docs + 1, tokens + len(ids)
        if out is not None:
            with out as f:
                f.write(struct.pack(BLOCK, False, -1, 0, 0) + struct.pack(TRAILER, docs, tokens, TAIL))
            yield pa.record_batch([pa.array([bucket], pa.int64()), pa.array([name]), pa.array([docs], pa.int64()),
                                   pa.array([tokens], pa.int64())], names=["bucket", "path", "docs", "tokens"])
    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes ``documents`` (doc_id, text) as token files in ascending doc_id; returns the file manifest.

    One pass tokenizes and counts; the counts of all tasks are summed per id, which gives the ranks (ties:
    smaller id first; the table is as long as the vocabulary).  The ids then move once, to their range of doc_id
    and, within one doc_id, of a checksum.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n = rows.count()
    files = max(2 * parallelism(spark), n // DOCS_PER_FILE)
    vocab = vocabulary_size(tokenizer)
    width = "<u2" if vocab <= 1 << 16 else "<u4"
    tokens = written(rows.mapInArrow(_tokenize(tokenizer, end_id, vocab, width),
                                     "doc_id long, mark long, ids binary, counts binary"), "token-ids")
    counted = (tokens.filter("counts is not null").select("counts").mapInArrow(_frequencies, "id long, n long")
               .groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id").collect())
    by_rank = np.array([r["id"] for r in counted], "<u4")
    rank_of = np.zeros(vocab, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    with CommittedFile(f"{folder}/ranks.u32") as f:
        f.write(by_rank.tobytes())
    order = [F.col("doc_id").asc_nulls_first(), F.col("mark")]  # rows without a doc_id, or with one, spread by their marks
    sorted_rows = (tokens.filter("ids is not null").select("doc_id", "ids", "mark")
                   .repartitionByRange(files, *order).sortWithinPartitions(*order).select("doc_id", "ids"))
    return written(sorted_rows.mapInArrow(_write_files(folder, rank_of, width),
                                          "bucket long, path string, docs long, tokens long"), "token-manifest")


def blocks(uri: str, id_of: np.ndarray):
    """(doc_id, ids) of each document of one file, read as a stream and checked against the trailer."""
    fs, path = filesystem(uri)
    docs = tokens = 0
    with fs.open_input_stream(path, compression=None) as f:
        def take(k: int) -> bytes:
            data = f.read(k)
            if len(data) != k:
                raise ValueError(f"{uri}: cut off")
            return data

        if take(8) != HEAD:
            raise ValueError(f"{uri}: not a token file")
        while True:
            valid, doc_id, n, size = struct.unpack(BLOCK, take(struct.calcsize(BLOCK)))
            if not valid and doc_id == -1:
                break
            control = take(-(-n // 4))
            yield (doc_id if valid else None), id_of[unpack_ids(control, take(size), n)]
            docs, tokens = docs + 1, tokens + n
        if struct.unpack(TRAILER, take(struct.calcsize(TRAILER))) != (docs, tokens, TAIL):
            raise ValueError(f"{uri}: trailer disagrees with the blocks")


def _read_files(folder: str, with_ids: bool):
    def run(batches):
        fs, path = filesystem(f"{folder}/ranks.u32")
        id_of = None
        for b in batches:
            for uri, start in zip(*(b.column(c).to_pylist() for c in range(2))):
                if id_of is None:
                    with fs.open_input_stream(path, compression=None) as f:
                        id_of = np.frombuffer(f.read(), "<u4")
                out, held = [], 0
                for doc_id, ids in blocks(uri, id_of):
                    raw = ids.astype("<u4").tobytes()
                    out.append((doc_id, start, len(ids), zlib.crc32(raw), raw if with_ids else None))
                    start, held = start + len(ids), held + len(raw)
                    if held > 32 << 20:
                        yield _batch(out)
                        out, held = [], 0
                if out:
                    yield _batch(out)

    def _batch(out):
        k, s, n, c, x = zip(*out)
        return pa.record_batch([pa.array(k, pa.int64()), pa.array(s, pa.int64()), pa.array(n, pa.int64()),
                                pa.array(c, pa.int64()), pa.array(x, pa.binary())],
                               names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
    return run


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start, n_tokens, ids_crc32, ids (<u4 bytes)."""
    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    starts = manifest.select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("start"))
    return file_list(starts, "path", "start").mapInArrow(
        _read_files(folder, with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")


def token_file_digests(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Writes the files in a new shared folder, reads them back: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = work_dir(spark, "token-files")
    manifest = write_token_files(docs, folder, tokenizer, end_id)
    return read_token_files(spark, folder, manifest, with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
