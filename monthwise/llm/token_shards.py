"""Training-order shards of token ids.

Documents become sequences of at most `sequence_tokens` ids, the last one padded, an end mark closing each
document. A keyed Feistel permutation with cycle-walking maps the number of a sequence to its global slot, so the
training order is a shuffle of all sequences that needs no sort by a random key and can be computed for any slot.
Range partitions on the shard number write each shard as one file of fixed-stride records in slot order; a reader
seeks to any slot and goes on from there.

Numbers are dealt over a written table of sequences, by file and row, so lost tasks compute the same slots again.
A record is doc_id (int64, the least int64 for null), number of the sequence in its document (uint32), number of
tokens (uint32), the ids (uint16) and two line feeds.

Defined results: a null or empty text is one sequence that holds the end mark; repeated rows have sequences of
their own; an empty table gives no shard; a tie of slots cannot occur; further columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthwise.llm.common import mix, new_path, remove

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how this family of vocabularies cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_MARK = 50256
SEQUENCE_TOKENS, SHARD_SEQUENCES = 256, 8192
NO_ID = -(1 << 63)
END = b"\n\n"
_ROUNDS = 6
#: Records that a task holds before it packs them, so that a blob stays long enough to compress among many shards.
HELD_BYTES = 64 << 20
#: Shards that one key of the shuffle stands for.
RANGE_SHARDS = 4
_ZSTD_LEVEL = 9


def permuted(index: np.ndarray, count: int, key: int) -> np.ndarray:
    """Slots of sequence numbers below `count`: a bijection on [0, count)."""
    half = max(1, (max(count - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & mask
        for r in range(_ROUNDS):
            left, right = right, left ^ (mix(right + np.uint64(r << 56), key * 31 + r) & mask)
        return left << shift | right

    out = once(index.astype(np.uint64))
    while len(outside := np.flatnonzero(out >= count)):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def record_type(sequence_tokens: int) -> np.dtype:
    return np.dtype([("doc_id", "<i8"), ("part", "<u4"), ("n", "<u4"), ("tokens", "<u2", (sequence_tokens,)), ("end", "S2")])


def sequences(documents: DataFrame, vocabulary: str = VOCABULARY, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """(doc_id, part, tokens) of every document; the vocabulary, of bounded size, goes to the tasks."""
    spark = documents.sparkSession
    with open(vocabulary, "rb") as lines:
        shared = spark.sparkContext.broadcast(lines.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, shared.value.splitlines())}
        encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            ids, parts, tokens = [], [], []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                found = np.array([*encoding.encode_ordinary(text.as_py() or ""), END_MARK], np.uint16)
                for part, first in enumerate(range(0, len(found), sequence_tokens)):
                    ids.append(doc_id)
                    parts.append(part)
                    tokens.append(found[first : first + sequence_tokens].tobytes())
                if len(ids) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.array(tokens, pa.binary())], ["doc_id", "part", "tokens"])
                    ids, parts, tokens = [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.array(tokens, pa.binary())], ["doc_id", "part", "tokens"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, part int, tokens binary")


def write_shards(documents: DataFrame, folder: str, key: int = 1, vocabulary: str = VOCABULARY, sequence_tokens: int = SEQUENCE_TOKENS, shard_sequences: int = SHARD_SEQUENCES) -> None:
    """Writes `folder`/shards/shard=K/ with one file each, and `folder`/manifest with what a reader must know."""
    spark = documents.sparkSession
    path = new_path(spark, "sequences")
    sequences(documents, vocabulary, sequence_tokens).write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", _ZSTD_LEVEL).parquet(path)
    table = spark.read.parquet(path)
    files = table.select(F.col("_metadata.file_name").alias("file")).groupBy("file").count()
    offset = F.sum("count").over(Window.orderBy("file")) - F.col("count")
    files = files.select("file", offset.alias("offset"), "count")  # one row for each task that wrote
    count = files.agg(F.sum("count")).first()[0] or 0
    numbered = table.select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).join(F.broadcast(files), "file")
    kind = record_type(sequence_tokens)

    range_slots = RANGE_SHARDS * shard_sequences

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=_ZSTD_LEVEL)
        held, size = [], 0

        def packed() -> pa.RecordBatch:
            slots, out = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(slots)
            slots = slots[order]
            ranges, first = np.unique(slots // range_slots, return_index=True)
            bounds = [*first.tolist(), len(slots)]
            blobs = [pack.compress(slots[a:b].tobytes() + out[order[a:b]].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(ranges, pa.int64()), pa.array(blobs, pa.binary())], ["range", "blob"])

        for batch in batches:
            slots = permuted(batch["index"].to_numpy(), count, key)
            out = np.zeros(len(slots), kind)
            out["doc_id"] = batch["doc_id"].fill_null(NO_ID).to_numpy()
            out["part"], out["end"] = batch["part"].to_numpy(), END
            for k, tokens in enumerate(batch["tokens"]):
                found = np.frombuffer(tokens.as_buffer(), np.uint16)
                out["n"][k] = len(found)
                out["tokens"][k, : len(found)] = found
            held.append((slots, out))
            size += out.nbytes
            if size >= HELD_BYTES:
                yield packed()
                held, size = [], 0
        if held:
            yield packed()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held, current = zstandard.ZstdDecompressor(), [], None

        def whole() -> Iterator[pa.RecordBatch]:
            slots = np.concatenate([s for s, _ in held])
            order = np.argsort(slots)
            records = np.concatenate([r for _, r in held])
            start = current * range_slots
            want = min(range_slots, count - start)
            if not np.array_equal(slots[order], np.arange(start, start + want)):
                raise ValueError(f"slots from {start} have {len(slots)} of {want} sequences")
            for a in range(0, want, shard_sequences):
                value = records[order[a : a + shard_sequences]].tobytes()[: -len(END)]
                yield pa.RecordBatch.from_arrays([pa.array([(start + a) // shard_sequences], pa.int64()), pa.array([value], pa.binary())], ["shard", "value"])

        for batch in batches:
            for at, blob in zip(batch["range"].to_pylist(), batch["blob"], strict=True):
                if held and at != current:
                    yield from whole()
                    held = []
                current = at
                data = unpack.decompress(blob.as_buffer())
                n = len(data) // (8 + kind.itemsize)
                held.append((np.frombuffer(data, np.int64, n), np.frombuffer(data, kind, n, 8 * n)))
        if held:
            yield from whole()

    placed = numbered.select((F.col("offset") + F.col("row")).alias("index"), "doc_id", "part", "tokens").mapInArrow(place, "range long, blob binary")
    # Ranges of shards are known beforehand: each is a partition of its own, and no pass has to sample their bounds.
    ranged = placed.repartitionById(max(1, -(-count // range_slots)), F.col("range").cast("int"))
    # A shard is one value; the writer's line separator closes its last record.
    ranged.mapInArrow(assemble, "shard long, value binary").select("shard", F.col("value").cast("string")).write.option("lineSep", END.decode()).partitionBy("shard").text(f"{folder}/shards")
    remove(spark, path)
    spark.createDataFrame(
        [(count, sequence_tokens, shard_sequences, key, END_MARK)], "sequences long, sequence_tokens int, shard_sequences int, key long, end_mark int"
    ).coalesce(1).write.json(f"{folder}/manifest")


def read_shards(spark: SparkSession, folder: str, first_slot: int = 0, last_slot: int | None = None) -> DataFrame:
    """(slot, shard, offset, doc_id, part, n_tokens, tokens) from `first_slot` up to before `last_slot`; only their shards are read."""
    about = spark.read.json(f"{folder}/manifest").first()
    count, per = about["sequences"], about["shard_sequences"]
    kind = record_type(about["sequence_tokens"])
    last_slot = count if last_slot is None else min(last_slot, count)
    schema = "slot long, shard long, offset long, doc_id long, part int, n_tokens int, tokens binary"
    if first_slot >= last_slot:
        return spark.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch["shard"].to_pylist(), batch["content"], strict=True):
                found = np.frombuffer(content.as_buffer(), kind)
                slots = shard * per + np.arange(len(found))
                use = (slots >= first_slot) & (slots < last_slot)
                found, slots = found[use], slots[use]
                ids = pa.array(found["doc_id"], mask=found["doc_id"] == NO_ID)
                tokens = [r[:n].tobytes() for r, n in zip(found["tokens"], found["n"], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slots), pa.array(np.full(len(slots), shard)), pa.array((slots - shard * per) * kind.itemsize), ids,
                     pa.array(found["part"].astype(np.int32)), pa.array(found["n"].astype(np.int32)), pa.array(tokens, pa.binary())],
                    ["slot", "shard", "offset", "doc_id", "part", "n_tokens", "tokens"],
                )

    files = spark.read.format("binaryFile").load(f"{folder}/shards").where(F.col("shard").between(first_slot // per, (last_slot - 1) // per))
    return files.select(F.col("shard").cast("long"), "content").mapInArrow(run, schema)
