"""Token-ID output: documents as separately compressed id arrays in shard files.

A shard holds documents in ascending doc_id order:

    8 bytes magic, 8 bytes hash of the shared dictionary,
    the frames: one zstandard frame per document, of its ids as little-endian
        unsigned 32-bit integers, compressed with the shared dictionary,
    the index: per document null flag, doc_id, offset, frame bytes, ids (five arrays),
    8 bytes number of documents, 8 bytes offset of the index, 8 bytes magic.

One short document is read with the index and one frame.  The dictionary is
trained on serialised ids and stored beside the shards.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import shared_dir, ship, table

MAGIC = b"TOKSHRD1"
END_ID = 2
#: Documents (lowest id hash) and bytes of each one's ids that the dictionary is trained on, at most.
DICT_DOCS, DICT_SLICE, DICT_BYTES = 2000, 4096, 64 * 1024
LEVEL = 3
#: Documents of a shard, about (more for a large corpus: a shard is one file).
SHARD_DOCS = 4096
#: Distinct units and pieces a task remembers; further ones are worked out each time.
UNITS, PIECES = 250_000, 600_000

_SPACED = re.compile(r"\s ")
#: ASCII and the Latin-1 characters from \u00C0 on: what is a letter, a digit or white space there is the same to
#: Python's expressions and to the tokenizer's (further on, their Unicode tables may be of different age).
_PLAIN = re.compile("[\x00-\x7f\xc0-\xff]*")
_WHITE, _LETTERS = "\t-\r ", "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_WHITE}{_LETTERS}0-9]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_ENCODERS: dict[str, "Encoder"] = {}


class _Memory(dict):
    """A dictionary that works a missing value out, and keeps it while there is room."""

    def __init__(self, make, room: int) -> None:
        super().__init__()
        self.make, self.room = make, room

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) < self.room:
            self[key] = value
        return value


class Encoder:
    """Ids of whole texts, with each piece, or blank-separated unit, encoded once.

    A text of plain characters is cut into the pieces of byte-level
    pre-tokenisation by one expression, and its ids are its pieces' ids in a row.
    In other texts that pre-tokenisation starts a new piece at every single blank
    that follows a character other than white space, so the ids are those of
    the units; the tokenizer's own pre-tokeniser cuts those that are not plain, and
    texts with white space before a blank are encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.plain = _Memory(self._plain, PIECES)    # pieces as they stand in the text
        self.units = _Memory(self._unit, UNITS)      # units without the blank before them
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        state = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else {}
        self.byte_level = (state.get("type") == "ByteLevel" and not state["add_prefix_space"] and state["use_regex"]
                           and self.tokenizer.normalizer is None)
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # how byte-level vocabularies write a byte: of the characters below \u0100, UTF-8 has one byte or two
        self.spelling = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(256)}

    def _ids(self, piece: str) -> bytes:
        ids = [t.id for t in self.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, piece: str) -> bytes:
        return self._ids(piece.translate(self.spelling))

    def _unit(self, word: str) -> bytes:
        return self._cut(" " + word)

    def _cut(self, unit: str) -> bytes:
        if _PLAIN.fullmatch(unit):
            return b"".join(map(self.plain.__getitem__, _PIECES.findall(unit)))
        return b"".join([self._ids(p) for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(unit)])

    def ids(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        special = not self.byte_level or any(s in text for s in self.special)
        if not special and _PLAIN.fullmatch(text):
            return self._cut(text)
        if special or _SPACED.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        return (self._cut(first) if first else b"") + b"".join(map(self.units.__getitem__, rest))


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def open_shared(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else "/" + uri)


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from the ids of at most DICT_DOCS documents, a slice of each
    (a sample: it only changes how small the frames get)."""
    import zstandard

    key = F.xxhash64("doc_id", "text")
    chosen = docs.where(F.length("text") > 0).select(key.alias("key")).orderBy(F.xxhash64("key"), "key").limit(DICT_DOCS)
    pick = docs.join(F.broadcast(chosen.distinct()), key == F.col("key"), "left_semi").limit(DICT_DOCS)  # DICT_DOCS keys

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [encoder(tokenizer).ids(t)[:DICT_SLICE] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    samples = sorted(bytes(r["ids"]) for r in pick.mapInArrow(slices, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return b"".join(samples)[:DICT_BYTES]


def _dictionary(raw: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(raw) if raw else None


def compressor(raw: bytes):
    """Frames without checksum and dictionary id: the head of the shard and its index have them."""
    import zstandard

    return zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(raw), write_checksum=False, write_dict_id=False)


def _dictionary_hash(raw: bytes) -> int:
    import xxhash

    return xxhash.xxh64(raw).intdigest()


class ShardWriter:
    """Writes one shard beside its final name and moves it there when complete,
    so that a task that is run again replaces whole files only."""

    def __init__(self, folder: str, name: str, dictionary: bytes) -> None:
        self.fs, root = open_shared(folder)
        self.final, self.work = f"{root}/{name}.tok", f"{root}/.{name}-{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.work)
        self.out.write(MAGIC + _dictionary_hash(dictionary).to_bytes(8, "little"))
        self.at, self.rows = 16, []

    def add(self, doc_id: int | None, frame: bytes, n_ids: int) -> None:
        self.out.write(frame)
        self.rows.append((doc_id is None, doc_id or 0, self.at, len(frame), n_ids))
        self.at += len(frame)

    def close(self) -> tuple[int, int]:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [()] * 5
        for values in columns:
            self.out.write(np.array(values, "<i8").tobytes())
        self.out.write(len(self.rows).to_bytes(8, "little") + self.at.to_bytes(8, "little") + MAGIC)
        self.out.close()
        self.fs.move(self.work, self.final)
        return len(self.rows), sum(r[4] for r in self.rows)


class ShardReader:
    """Random access to the documents of one shard."""

    def __init__(self, folder: str, name: str, dictionary: bytes) -> None:
        import zstandard

        filesystem, root = open_shared(folder)
        self.file = filesystem.open_input_file(f"{root}/{name}.tok")
        size = self.file.size()
        tail = self.file.read_at(24, size - 24)
        head = self.file.read_at(16, 0)
        if head[:8] != MAGIC or tail[16:] != MAGIC:
            raise ValueError(f"{name} is not a complete shard")
        if int.from_bytes(head[8:], "little") != _dictionary_hash(dictionary):
            raise ValueError(f"{name} was written with another dictionary")
        n, at = int.from_bytes(tail[:8], "little"), int.from_bytes(tail[8:16], "little")
        index = np.frombuffer(self.file.read_at(40 * n, at), "<i8").reshape(5, n)
        self.null, self.doc_id, self.offset, self.length, self.n_ids = index
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.doc_id)

    def raw(self, k: int) -> bytes:
        """Ids of the k-th document as bytes."""
        frame = self.file.read_at(int(self.length[k]), int(self.offset[k]))
        return self.decompressor.decompress(frame, max_output_size=4 * int(self.n_ids[k]) or 1)

    def ids(self, k: int) -> np.ndarray:
        return np.frombuffer(self.raw(k), "<u4")


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """Tokenise (doc_id, text) into shards below ``folder``; returns (shard,
    n_docs, n_tokens), a row per shard, with shards numbered in id order.

    The shards' id ranges come from quantiles of the ids; each document's ids
    are compressed where its text is read, and only compressed frames move.
    """
    spark = docs.sparkSession
    ship(spark)
    filesystem, root = open_shared(folder)
    filesystem.create_dir(root, recursive=True)
    dictionary = train_dictionary(docs, tokenizer)
    with filesystem.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)
    n = docs.agg(F.count("*")).first()[0]
    shards = max(1, -(-n // shard_docs))
    cuts = docs.agg(F.percentile_approx("doc_id", F.array(*[F.lit(k / shards) for k in range(1, shards)] or [F.lit(0.5)]),
                                        F.lit(max(10_000, 20 * shards)))).first()[0] if shards > 1 else []
    bounds = np.unique(np.array(cuts or [], np.int64))
    sent = spark.sparkContext.broadcast((dictionary, bounds))  # a number per shard, and 64 KB

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, limits = sent.value
        frames = compressor(raw)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            ids = [encoder(tokenizer).ids(t or "") + end for t in batch.column("text").to_pylist()]
            null = np.asarray(batch.column("doc_id").is_null())
            key = batch.column("doc_id").fill_null(0).to_numpy()
            shard = np.where(null, 0, np.searchsorted(limits, key, "left"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard, pa.int32()), batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([frames.compress(x) for x in ids], pa.binary())], ["shard", "doc_id", "n_ids", "frame"])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, _ = sent.value
        now, writer, done = None, None, []
        for batch in batches:
            for shard, doc_id, n_ids, frame in zip(*(batch.column(k).to_pylist() for k in ("shard", "doc_id", "n_ids", "frame")),
                                                   strict=True):
                if shard != now:
                    if writer is not None:
                        done.append((now, *writer.close()))
                    now, writer = shard, ShardWriter(folder, f"shard-{shard:06d}", raw)
                writer.add(doc_id, frame, n_ids)
        if writer is not None:
            done.append((now, *writer.close()))
        yield pa.RecordBatch.from_pylist(
            [{"shard": s, "n_docs": d, "n_tokens": t} for s, d, t in done],
            pa.schema([("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    frames = docs.select("doc_id", "text").mapInArrow(encode, "shard int, doc_id long, n_ids long, frame binary")
    dealt = frames.repartition(min(shards, 4096), "shard").sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "frame")
    written = dealt.mapInArrow(store, "shard int, n_docs long, n_tokens long")
    return spark.createDataFrame(written.collect(), written.schema)  # one row per shard


def read_tokens(spark: SparkSession, folder: str, written: DataFrame, digest: bool = True) -> DataFrame:
    """Documents read back from the shards: (doc_id, start, n_tokens,
    ids_crc32), or with ``digest=False`` (doc_id, start, ids)."""
    rows = sorted(written.collect(), key=lambda r: r["shard"])
    starts, total = [], 0
    for r in rows:
        starts.append((r["shard"], total))
        total += r["n_tokens"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = open_shared(folder)
        with filesystem.open_input_file(f"{root}/dictionary") as f:
            dictionary = f.read()
        for batch in batches:
            for shard, start in zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist(), strict=True):
                r = ShardReader(folder, f"shard-{shard:06d}", dictionary)
                at = start + np.concatenate([[0], np.cumsum(r.n_ids)])
                for i in range(0, len(r), 2048):
                    own = range(i, min(i + 2048, len(r)))
                    ids = [r.raw(k) for k in own]
                    head = [pa.array([None if r.null[k] else int(r.doc_id[k]) for k in own], pa.int64()),
                            pa.array(at[i:i + len(own)], pa.int64())]
                    if digest:
                        tail = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([zlib.crc32(x) for x in ids], pa.int64())]
                        yield pa.RecordBatch.from_arrays(head + tail, ["doc_id", "start", "n_tokens", "ids_crc32"])
                    else:
                        yield pa.RecordBatch.from_arrays(
                            [*head, pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32()))],
                            ["doc_id", "start", "ids"])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" if digest else "doc_id long, start long, ids array<int>"
    if not rows:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(starts, "shard int, start long").repartition(len(starts), "shard")
    return files.mapInArrow(read, schema)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_digest(docs: DataFrame) -> DataFrame:
    """Write (doc_id, text) as token shards in the shared folder and return per
    document, from the files: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is the end id alone; null doc_ids come first; rows of
    one doc_id stand in the order of their compressed ids; an empty table
    writes no shard and returns no row; other columns are not read.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark) + "/tokens"
    return read_tokens(spark, folder, write_tokens(docs.select("doc_id", "text"), folder, tokenizer_path()))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digest(table(spark, sf_dir, "documents"))
