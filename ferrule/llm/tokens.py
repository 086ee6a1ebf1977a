"""Operator 1: token-ID output in training order.

Texts are encoded, closed with an end token and cut into sequences of ``seq_len`` ids.
All sequences are numbered densely in the order of document id, and a keyed Feistel
permutation with cycle-walking sends each number to its global slot: the training order
is a function of key, data and sequence length alone, whatever the partitioning.  Slots
are cut into ranges of ``shard_rows``; each range is one partition, ordered by slot, of
records of one fixed size, so record ``s`` lies at byte ``(s mod shard_rows) * stride``
of shard ``s div shard_rows`` and a reader resumes anywhere by arithmetic.  The query and
the pipeline write the shards as files of the shared folder and return where each record
lies; the records are not kept a second time in the result.

The encoded documents are saved once, in pieces, where they were encoded, and don't move
to be numbered: only (id, hash of the text, number of ids) is dealt out by ranges of the
id, summed up in order, and sent back as one file of start numbers per encoding task.
The pieces are then cut and shuffled once, by groups of shards, packed per piece and shard.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ordering import chunk_offsets, ranged
from . import common
from .words import U, mix

#: A byte-level BPE vocabulary in tiktoken's format, on every node.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the splitting pattern that belongs to that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The first free id of that vocabulary ends a document and fills its last record.
END = 50256
SEQ_LEN, SHARD_ROWS, KEY = 512, 16384, 20240607
MAX_RANGES = 8192
_ROUNDS = 6
_ENCODERS: dict[str, object] = {}


def encoder(vocabulary: str):
    if vocabulary not in _ENCODERS:
        import tiktoken
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        _ENCODERS[vocabulary] = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[vocabulary]


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """Permutation of 0..n-1: balanced Feistel rounds over the next even power of two,
    walked along the cycle until the value is below ``n`` (fewer than 4 steps on average)."""
    half = max(1, (max(1, n - 1).bit_length() + 1) // 2)
    mask = U((1 << half) - 1)
    keys = mix(np.arange(_ROUNDS, dtype=np.uint64) + U((key * 0x9E3779B97F4A7C15) & ((1 << 64) - 1)))
    out = x.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        v = out[todo]
        left, right = v >> U(half), v & mask
        for k in keys:
            left, right = right, left ^ (mix(right ^ k) & mask)
        v = (left << U(half)) | right
        out[todo] = v
        todo = todo[v >= U(n)]
    return out.astype(np.int64)


_PIECES = "piece long, doc_ids array<long>, ties array<long>, sizes array<int>, often array<int>, counts array<int>, body binary"
_LEVEL = 6  # of compression
SLICE_BYTES = 8 << 20  # of text in a piece
_SLICE_BITS = 24  # of a piece's number: its place in its task


def _ranked(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids that occur, most frequent first, how often each does, and every id as its place
    among them: small numbers, which compress better than ids."""
    n = np.bincount(ids, minlength=1)
    often = np.argsort(-n, kind="stable")[:np.count_nonzero(n)]
    place = np.zeros(len(n), ids.dtype)
    place[often] = np.arange(len(often))
    return often.astype(np.int32), n[often].astype(np.int32), place[ids]


def _encode(vocabulary, end, wide, slice_bytes):
    """Documents (id, text, hash) to pieces: the ids of a slice of texts, one after another."""
    dtype = np.uint32 if wide else np.uint16

    def run(batches):
        enc, z = encoder(vocabulary), zstandard.ZstdCompressor(level=_LEVEL)
        piece = TaskContext.get().partitionId() << _SLICE_BITS
        for part, texts in common.text_slices(batches, limit=slice_bytes):
            size, ids = [], []
            for t in texts:
                got = enc.encode_ordinary(t.decode("utf-8", "replace")) if t else []
                if got:
                    got.append(end)
                size.append(len(got))
                ids.append(np.array(got, dtype))
            one = lambda c, t: pa.array([c], pa.list_(t))
            often, counts, places = _ranked(np.concatenate(ids))
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), one(part.column(0).to_pylist(), pa.int64()), one(part.column(2).to_pylist(), pa.int64()),
                                              one(size, pa.int32()), one(often, pa.int32()), one(counts, pa.int32()), pa.array([z.compress(places.tobytes())], pa.binary())],
                                             names=["piece", "doc_ids", "ties", "sizes", "often", "counts", "body"])
            piece += 1

    return run


def _write_starts(uri: str):
    """Rows (piece, row, start) in order to a file of pieces and starts per encoding task."""
    def run(batches):
        from pyarrow import fs
        where, folder = fs.FileSystem.from_uri(uri)
        where.create_dir(folder, recursive=True)
        task, held = None, []

        def close():
            both = np.concatenate(held, axis=1)
            new = f"{folder}/.{task}-{uuid.uuid4().hex}"
            with where.open_output_stream(new) as f:
                f.write(both.tobytes())
            where.move(new, f"{folder}/{task}")
            return pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int64()), "rows": pa.array([both.shape[1]], pa.int64())})

        for b in batches:
            piece, start = b.column(0).to_numpy(), b.column(2).to_numpy()
            cuts = np.flatnonzero(np.diff(piece >> _SLICE_BITS)) + 1
            for p, s in zip(np.split(piece, cuts), np.split(start, cuts)):
                if not len(p):
                    continue
                if task is not None and task != p[0] >> _SLICE_BITS:
                    yield close()
                    held = []
                task = int(p[0] >> _SLICE_BITS)
                held.append(np.stack([p, s]))
        if task is not None:
            yield close()

    return run


_CUT = "shard long, slots binary, doc_ids array<long>, seqs binary, sizes binary, body binary"


def _cut(uri, seq_len, total, key, shard_rows, wide, often):
    """Pieces to their sequences, packed per shard, ids as their places in ``often``."""
    dtype = np.uint32 if wide else np.uint16
    place = np.zeros(int(often.max(initial=0)) + 1, dtype)
    place[often] = np.arange(len(often))

    def run(batches):
        from pyarrow import fs
        where, folder = fs.FileSystem.from_uri(uri)
        z, uz = zstandard.ZstdCompressor(level=_LEVEL), zstandard.ZstdDecompressor()
        task, known = None, None
        for b in batches:
            for i in range(b.num_rows):
                piece, doc_ids, sizes, here, body = (c[i] for c in b.columns)
                piece, doc_ids = piece.as_py(), doc_ids.values
                if piece >> _SLICE_BITS != task:
                    task = piece >> _SLICE_BITS
                    with where.open_input_stream(f"{folder}/{task}") as f:
                        known = np.frombuffer(f.read(), np.int64).reshape(2, -1)
                lo, hi = np.searchsorted(known[0], [piece, piece + 1])
                size = sizes.values.to_numpy().astype(np.int64)
                ids = place[here.values.to_numpy()][np.frombuffer(uz.decompress(body.as_py()), dtype)]
                n = -(-size // seq_len)
                row = np.repeat(np.arange(len(n)), n)
                seq = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                slot = feistel(known[1, lo:hi][row] + seq, total, key)
                first = (np.cumsum(size) - size)[row] + seq * seq_len
                own = np.minimum(size[row] - seq * seq_len, seq_len)
                by = np.argsort(slot // shard_rows, kind="stable")
                shard = (slot // shard_rows)[by]
                ends = np.flatnonzero(np.append(shard[1:] != shard[:-1], True)) + 1 if len(shard) else []
                at, out = 0, [[] for _ in range(6)]
                for to in ends:
                    mine = by[at:to]
                    tokens = np.concatenate([ids[f: f + k] for f, k in zip(first[mine].tolist(), own[mine].tolist())])
                    for col, v in zip(out, (int(shard[at]), z.compress(slot[mine].tobytes()), doc_ids.take(pa.array(row[mine])), z.compress(seq[mine].tobytes()), z.compress(own[mine].tobytes()), z.compress(tokens.tobytes()))):
                        col.append(v)
                    at = to
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, out[2])]), pa.int32()), pa.concat_arrays(out[2]) if out[2] else pa.array([], pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), lists, *[pa.array(c, pa.binary()) for c in out[3:]]],
                                                 names=["shard", "slots", "doc_ids", "seqs", "sizes", "body"])

    return run


def _records(seq_len, shard_rows, end, wide, often):
    """Packed sequences ordered by shard to records in slot order, one shard in memory at a time."""
    dtype = np.uint32 if wide else np.uint16
    ids_of = often.astype(dtype)
    stride = seq_len * np.dtype(dtype).itemsize

    def run(batches):
        uz = zstandard.ZstdDecompressor()
        shard, held = None, []

        def close():
            slot, seq, size = (np.concatenate([h[k] for h in held]) for k in (0, 2, 3))
            doc = pa.concat_arrays([h[1] for h in held])
            ids = ids_of[np.concatenate([np.frombuffer(uz.decompress(h[4]), dtype) for h in held])]
            first = np.cumsum(size) - size
            order = np.argsort(slot)
            for at in range(0, len(order), 2048):
                o = order[at: at + 2048]
                rec = np.full((len(o), seq_len), end, dtype)
                for r, f, k in zip(rec, first[o].tolist(), size[o].tolist()):
                    r[:k] = ids[f: f + k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(o), shard), pa.int64()), pa.array(slot[o]), pa.array(slot[o] % shard_rows * stride), doc.take(pa.array(o)), pa.array(seq[o]), pa.array(size[o]),
                     pa.array([r.tobytes() for r in rec], pa.binary())], names=["shard", "slot", "byte_offset", "doc_id", "seq", "n_tokens", "tokens"])

        for b in batches:
            for i in range(b.num_rows):
                s, slots, doc, seqs, sizes, body = (c[i] for c in b.columns)
                if shard is not None and s.as_py() != shard:
                    yield from close()
                    held = []
                shard = s.as_py()
                slot, seq, size = (np.frombuffer(uz.decompress(x.as_py()), np.int64) for x in (slots, seqs, sizes))
                held.append((slot, doc.values, seq, size, body.as_py()))
        if held:
            yield from close()

    return run


_RECORD = "shard long, slot long, byte_offset long, doc_id long, seq long, n_tokens long, tokens binary"


def _packed(docs, id_col, text_col, vocabulary, seq_len, shard_rows, key, end, slice_bytes) -> tuple[DataFrame, int, np.ndarray]:
    """Packed sequences in order of their shards (the rows that ``_records`` takes), their number,
    and the ids by frequency, which the packed numbers are places in."""
    spark, wide = docs.sparkSession, end >= 1 << 16
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("tie"))
    pieces = common.save(src.mapInArrow(_encode(vocabulary, end, wide, slice_bytes), _PIECES), "tokens-pieces")
    # Numbers: light rows only, dealt out by ranges of unique keys.
    light = pieces.select("piece", F.posexplode(F.arrays_zip("doc_ids", "ties", "sizes")).alias("row", "d"))
    light = light.select("piece", "row", F.col("d.doc_ids").alias("doc_id"), F.col("d.ties").alias("tie"), F.expr(f"(d.sizes + {seq_len - 1}) div {seq_len}").alias("seqs"))
    order = ["doc_id", "tie", "piece", "row"]
    dealt = ranged(light, order, "tokens-order")
    before = Window.partitionBy("_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = chunk_offsets(dealt.withColumn("start", F.coalesce(F.sum("seqs").over(before), F.lit(0))), [], "seqs")
    starts = counted.select("piece", "row", (F.col("start") + F.col("_off")).cast("long").alias("start"))
    uri = f"{common.shared_dir(spark)}/tokens-starts-{uuid.uuid4().hex[:12]}"
    task = F.shiftright("piece", _SLICE_BITS)
    common.save(starts.repartition(task).sortWithinPartitions("piece", "row").mapInArrow(_write_starts(uri), "task long, rows long"), "tokens-starts")
    total = int(dealt.agg(F.coalesce(F.sum("seqs"), F.lit(0))).first()[0])
    shards = max(1, math.ceil(total / shard_rows))
    each = math.ceil(shards / MAX_RANGES)  # shards of one range partition, written one after another
    used = pieces.select(F.inline(F.arrays_zip("often", "counts"))).groupBy("often").agg(F.sum("counts").alias("n")).collect()  # at most the vocabulary
    often = np.array([r["often"] for r in sorted(used, key=lambda r: (-r["n"], r["often"]))], np.int64)
    cut = pieces.select("piece", "doc_ids", "sizes", "often", "body").mapInArrow(_cut(uri, seq_len, total, key, shard_rows, wide, often), _CUT)
    return cut.repartitionById(math.ceil(shards / each), F.expr(f"int(shard div {each})")).sortWithinPartitions("shard"), total, often


def training_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, seq_len: int = SEQ_LEN,
                   shard_rows: int = SHARD_ROWS, key: int = KEY, end: int = END, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``(shard, slot, byte_offset, doc_id, seq, n_tokens, tokens)``: one row per sequence.

    ``tokens`` is a record of ``seq_len`` little-endian ids (16 bits while ``end`` < 2^16, else
    32), filled up with ``end``; the slots are 0..n-1 without gap.  A null or empty text
    has no sequence; null ids come first in the numbering; rows that share an id are ordered
    by a hash of the text (equal rows are interchangeable); other columns are ignored.
    """
    packed, _, often = _packed(docs, id_col, text_col, vocabulary, seq_len, shard_rows, key, end, slice_bytes)
    return packed.mapInArrow(_records(seq_len, shard_rows, end, end >= 1 << 16, often), _RECORD)


def training_shards(docs: DataFrame, uri: str | None = None, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, seq_len: int = SEQ_LEN,
                    shard_rows: int = SHARD_ROWS, key: int = KEY, end: int = END, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Write the records of ``training_order`` as shard files below ``uri`` (by default a new
    folder of the shared folder) and return ``(shard, slot, byte_offset, doc_id, seq, n_tokens,
    file)``: the record of a row is at ``byte_offset`` of ``file``.  The files are there when
    this returns; the rows are a saved table, so reading them writes nothing again."""
    uri = (uri or f"{common.shared_dir(docs.sparkSession)}/tokens-shards-{uuid.uuid4().hex[:12]}").rstrip("/")
    with common.scratch(docs.sparkSession) as keep:
        packed, total, often = _packed(docs, id_col, text_col, vocabulary, seq_len, shard_rows, key, end, slice_bytes)
        records, write = _records(seq_len, shard_rows, end, end >= 1 << 16, often), _write(uri, key, total, True)
        return keep(common.save(packed.mapInArrow(lambda batches: write(records(batches)),
                                                  "shard long, slot long, byte_offset long, doc_id long, seq long, n_tokens long, file string"), "tokens-index"))


def _write(uri: str, key: int | None, total: int | None, index: bool):
    """Batches of records in slot order to shard files; gives a row per record (``index``) or shard."""
    def run(batches):
        from pyarrow import fs
        where, folder = fs.FileSystem.from_uri(uri)
        notes = f"{folder}.manifest"
        for path in (folder, notes):
            where.create_dir(path, recursive=True)
        out, shard, state, digest = None, None, None, None

        def read(path):
            if where.get_file_info(path).type != fs.FileType.File:
                return None
            with where.open_input_stream(path) as f:
                return f.read()

        def close():
            out.close()
            name, note = f"{folder}/shard-{shard:08d}.bin", f"{notes}/shard-{shard:08d}.json"
            mine = json.dumps({"key": key, "total": total, "first_slot": state[0], "records": state[1], "bytes": state[2], "blake2b": digest.hexdigest()}).encode()
            have = where.get_file_info(name)
            if have.type == fs.FileType.File and have.size == state[2] and read(note) == mine:
                where.delete_file(state[3])
            else:
                # No manifest while the file changes: a crash in between leaves none, so the file is not trusted.
                if where.get_file_info(note).type == fs.FileType.File:
                    where.delete_file(note)
                where.move(state[3], name)
                new = f"{notes}/.{uuid.uuid4().hex}"
                with where.open_output_stream(new) as f:
                    f.write(mine)
                where.move(new, note)
            return pa.RecordBatch.from_pydict({"shard": [shard], "first_slot": [state[0]], "records": [state[1]], "bytes": [state[2]]})

        for b in batches:
            col = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            for s, slot, rec in zip(*[col[c].to_pylist() for c in ("shard", "slot", "tokens")]):
                if s != shard:
                    if out is not None:
                        made = close()
                        if not index:
                            yield made
                    shard, state, digest = s, [slot, 0, 0, f"{folder}/.shard-{s:08d}-{uuid.uuid4().hex}"], hashlib.blake2b(digest_size=16)
                    out = where.open_output_stream(state[3])
                out.write(rec)
                digest.update(rec)
                state[1] += 1
                state[2] += len(rec)
            if index:
                file = pa.array([f"{uri}/shard-{s:08d}.bin" for s in col["shard"].to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns[:6], file], names=[*b.schema.names[:6], "file"])
        if out is not None:
            made = close()
            if not index:
                yield made

    return run


def write_shards(rows: DataFrame, uri: str, key: int | None = None, total: int | None = None) -> DataFrame:
    """Write each shard to ``uri``/shard-<number>.bin and return ``(shard, first_slot, records,
    bytes)``.  Records go out in slot order at their fixed stride; a file is written
    under a name of its own and renamed, so a task that runs again replaces it whole.
    ``uri``.manifest holds a note per shard (key, total, hash of the content); a shard is left
    as it is only where its note says the same, otherwise it is replaced.  ``total`` tells a
    reader which shards belong to the run, should an earlier one have left more.  ``uri`` is
    a folder that every executor reaches (file://, hdfs://, s3://, gs://)."""
    return rows.select("shard", "slot", "tokens").mapInArrow(_write(uri.rstrip("/"), key, total, False), "shard long, first_slot long, records long, bytes long")


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: the shards as files, and every sequence with its slot and place."""
    return training_shards(common.table(spark, sf_dir, "documents"))
