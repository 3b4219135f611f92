"""Exact dedup by Golomb-coded fingerprint exchange.

Rows are written in blocks, as they are read. Each block sorts the fingerprints of its normalised texts, splits them by owner (a range
of the fingerprint) and sends each owner one Golomb-Rice coded list. An owner merges the lists it got and answers each with a bitmap:
bit k says that the block's k-th fingerprint also lies in another block. The answers become one bitmap by place per block: rows whose
bit is set, or whose fingerprint is twice in their own block, are suspects. The written blocks are bucketed by block, so a block meets
its bitmap without an exchange of texts; only suspects' texts are shuffled and grouped by their bytes, with counts summed before the
shuffle, so a text copied a million times is one row per task there. Dropping rows works the same way, by a bitmap of the lost places.

Defined cases: a null text counts as empty; all empty and null texts are equal. Rows with the same id and text are copies too:
exactly one stays. A null id is larger than every other id. Very long texts are single values like others. Of an empty table nothing is
left. Other columns are ignored by the groups and pass through dropping untouched, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from stockcast.llm.text import BATCH_ROWS, arrow_batches, bucketed, materialize, owners, packed, quoted, unpacked

#: rows of a block: its fingerprints are held in one task
BLOCK_ROWS = 1 << 18
FINGERPRINT_BITS = 48


def normalise(text: str | None) -> bytes:
    """Each run of space and \\x09-\\x0D as one space, in UTF-8."""
    if not text:
        return b""
    raw = text.encode("utf-8", "surrogatepass")
    parts = raw.split()
    if not parts:
        return b" "
    return (b" " if raw[0] <= 32 and raw[:1].isspace() else b"") + b" ".join(parts) + (b" " if raw[-1:].isspace() else b"")


def fingerprint(norm: bytes, bits: int = FINGERPRINT_BITS) -> int:
    return xxhash.xxh3_64_intdigest(norm) >> (64 - bits)


def golomb_encode(values: np.ndarray, bits: int) -> bytes:
    """Sorted distinct numbers below 2**bits: Golomb-Rice codes of the gaps, the unary parts first, then the remainders."""
    gaps = np.diff(values.astype(np.int64), prepend=np.int64(-1)) - 1
    shift = max(0, bits - 1 - max(1, len(values)).bit_length())
    quotient, rest = gaps >> shift, gaps & ((1 << shift) - 1)
    unary = np.zeros(int(quotient.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    low = ((rest[:, None] >> np.arange(shift)) & 1).astype(np.uint8).ravel()
    return np.packbits(np.concatenate([unary, low])).tobytes()


def golomb_decode(data: bytes, count: int, bits: int) -> np.ndarray:
    shift = max(0, bits - 1 - max(1, count).bit_length())
    stream = np.unpackbits(np.frombuffer(data, np.uint8))
    ends = np.flatnonzero(stream[: len(stream) - count * shift])[:count]
    if len(ends) < count:  # the padding may hide some of the unary part's ones: look a little further
        ends = np.flatnonzero(stream)[:count]
    quotient = np.diff(ends, prepend=-1) - 1
    begin = int(ends[-1]) + 1 if count else 0
    low = stream[begin : begin + count * shift].reshape(count, shift).astype(np.int64)
    rest = low @ (np.int64(1) << np.arange(shift, dtype=np.int64)) if shift else np.zeros(count, np.int64)
    return np.cumsum((quotient.astype(np.int64) << shift) + rest + 1) - 1


#: what a block adds to its rows. Kind 0: a document. Kind 1: a coded list for one owner. Kind 2: the rank of each place's fingerprint.
ADDED = StructType([
    StructField("kind", IntegerType()), StructField("block", LongType()), StructField("at", IntegerType()),
    StructField("fp", LongType()), StructField("sha", StringType()),
    StructField("owner", IntegerType()), StructField("count", IntegerType()), StructField("payload", BinaryType()),
])


def _renamed(docs: DataFrame, whole: bool) -> tuple[DataFrame, list[Column]]:
    """Id and text under names of our own and, if asked, all other columns; and what gives the columns of `docs` back."""
    known = {("doc_id", "bigint"): "own_id", ("text", "string"): "own_text"}
    chosen, back = [F.col("doc_id").cast("long").alias("own_id"), F.col("text").cast("string").alias("own_text")], []
    for k, field in enumerate(docs.dtypes if whole else []):
        inner = known.get(field, f"own_{k}")
        if field not in known:
            chosen.append(F.col(quoted(field[0])).alias(inner))
        back.append(F.col(inner).alias(field[0]))
    return docs.select(*chosen), back


def _blocks(rows: DataFrame, shares: int, bits: int, block_rows: int) -> DataFrame:
    """The rows with what ADDED names, written in buckets by block."""
    target = StructType([*rows.schema.fields, *ADDED.fields])
    kinds = [f.type for f in to_arrow_schema(ADDED)]

    def batch(own: list, n: int, **added) -> pa.RecordBatch:
        made = [pa.array(added[f.name], t) if f.name in added else pa.nulls(n, t) for f, t in zip(ADDED.fields, kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*own, *made], names=target.names)

    def close(prints: list[int], block: int, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        distinct, place = np.unique(np.array(prints, np.int64), return_inverse=True)
        owner = ((distinct >> (bits - 24)) * shares) >> 24  # ranges of the fingerprint's first 24 bits
        starts = np.searchsorted(owner, np.arange(shares + 1))
        full = [k for k in range(shares) if starts[k + 1] > starts[k]]
        n = len(full)
        yield batch(
            [pa.nulls(n, t) for t in types], n, kind=[1] * n, block=[block] * n, owner=full,
            count=[int(starts[k + 1] - starts[k]) for k in full],
            payload=[golomb_encode(distinct[starts[k] : starts[k + 1]], bits) for k in full],
        )
        yield batch([pa.nulls(1, t) for t in types], 1, kind=[2], block=[block], payload=[packed(place.astype(np.int32))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial, types = TaskContext.get().partitionId(), 0, []
        prints: list[int] = []
        for got in batches:
            types = [c.type for c in got.columns]
            norms = [normalise(x.as_py()) for x in got.column(1)]
            own, n, block = [fingerprint(x, bits) for x in norms], len(norms), (part << 32) | serial
            yield batch(
                got.columns, n, kind=[0] * n, block=[block] * n, at=range(len(prints), len(prints) + n), fp=own,
                sha=[hashlib.sha256(x).hexdigest() for x in norms],
            )
            prints += own
            if len(prints) >= block_rows:
                yield from close(prints, block, types)
                prints, serial = [], serial + 1
        if prints:
            yield from close(prints, (part << 32) | serial, types)

    return bucketed(arrow_batches(rows, work, target, min(BATCH_ROWS, block_rows)), "block", shares)


def _answers(lists: DataFrame, bits: int) -> DataFrame:
    """Per list that an owner got, the bitmap of fingerprints that other blocks have too."""

    def own(table: pa.Table) -> pa.Table:
        counts = table.column("count").to_pylist()
        got = [golomb_decode(p, n, bits) for p, n in zip(table.column("payload").to_pylist(), counts, strict=True)]
        _, place, times = np.unique(np.concatenate(got), return_inverse=True, return_counts=True)
        cuts = np.cumsum(counts)[:-1]
        maps = [np.packbits(x).tobytes() for x in np.split(times[place] > 1, cuts)]
        return pa.table({**{c: table.column(c) for c in ("block", "owner", "count")}, "payload": pa.array(maps, pa.binary())})

    return lists.groupBy("owner").applyInArrow(own, "block long, owner int, count int, payload binary")


def _suspects(ranks: DataFrame, answers: DataFrame) -> DataFrame:
    """Per block, the bitmap of the places whose fingerprint is in another place too, here or in another block."""

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: -1 if r["owner"] is None else r["owner"])
        place = unpacked(rows[0]["payload"], np.int32)
        shared = np.concatenate([np.unpackbits(np.frombuffer(r["payload"], np.uint8))[: r["count"]] for r in rows[1:]])
        marked = (shared | (np.bincount(place) > 1))[place]
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(marked).tobytes()], pa.binary())})

    return ranks.unionByName(answers).groupBy("block").applyInArrow(join, "block long, bits binary")


def _bitmaps(places: DataFrame) -> DataFrame:
    """Rows (block, at) as one bitmap per block; a block has few rows by its size."""

    def join(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        marked = np.zeros(int(at.max()) + 1, np.uint8)
        marked[at] = 1
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(marked).tobytes()], pa.binary())})

    return places.groupBy("block").applyInArrow(join, "block long, bits binary")


def _with_bit(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows with `bit`, that of their place. Rows are bucketed by block: only the bitmaps are exchanged, and hashed, not sorted."""
    byte = F.conv(F.hex(F.expr("substring(bits, cast(at div 8 + 1 as int), 1)")), 16, 10).cast("int")
    bit = F.coalesce(F.getbit(byte, 7 - F.col("at") % 8) == 1, F.lit(False))
    return rows.join(bitmaps.hint("shuffle_hash"), "block", "left").withColumn("bit", bit).drop("bits")


def _suspect_texts(rows: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Fingerprint and normalised bytes of the suspects."""
    norm = F.regexp_replace(F.coalesce("own_text", F.lit("")), "[ \\x09-\\x0D]+", " ").cast("binary")
    return _with_bit(rows.select("block", "at", "fp", "own_text"), bitmaps).where("bit").select("fp", norm.alias("norm"))


def _grouped(rows: DataFrame, bitmaps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that no other row equals; and the suspects with their place, group and whether they stay."""
    light = _with_bit(rows.select("own_id", "block", "at", "fp", "sha"), bitmaps)
    suspects = materialize(light.where("bit").drop("bit"))
    # the bytes themselves are the key: copies fall together in each task before the shuffle
    verified = _suspect_texts(rows, bitmaps).groupBy("fp", "norm").agg(F.count("*").alias("size"))
    verified = (
        verified.select("fp", F.sha2("norm", 256).alias("sha"), "size")
        .groupBy("fp", "sha")
        .agg(F.max("size").alias("size"), F.count("*").alias("texts"))
        .select("fp", "sha", F.when(F.col("texts") == 1, F.col("size")).otherwise(
            F.raise_error(F.lit("two texts with one SHA-256"))).cast("long").alias("size"))
    )
    # of rows that repeat the kept id and text, the first in block order stays
    first = F.min(F.struct(F.col("own_id").isNull().alias("unnamed"), "own_id", "block", "at"))
    # written, so that Spark may split the rows of a large group in the join
    groups = materialize(suspects.groupBy("fp", "sha").agg(first.alias("first")).join(verified, ["fp", "sha"]))
    stays = (F.col("block") == F.col("first.block")) & (F.col("at") == F.col("first.at"))
    return light.where("not bit"), suspects.join(groups, ["fp", "sha"]).withColumn("stays", stays)


def _marked_blocks(rows: DataFrame, bits: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The written rows, and the suspects' bitmaps."""
    shares = owners(rows.sparkSession)
    table = _blocks(rows, shares, bits, block_rows)
    answers = _answers(table.where("kind = 1").select("block", "owner", "count", "payload"), bits)
    ranks = table.where("kind = 2").select("block", "owner", "count", "payload")
    return table.where("kind = 0"), materialize(_suspects(ranks, answers))


def exact_groups(docs: DataFrame, bits: int = FINGERPRINT_BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    single, found = _grouped(*_marked_blocks(_renamed(docs, False)[0], bits, block_rows))
    own = F.col("own_id").alias("doc_id")
    found = found.select(
        own, F.col("first.own_id").alias("keep_id"), F.col("size").alias("group_size"), F.col("stays").alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    single = single.select(
        own, F.col("own_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return single.unionByName(found)


def drop_exact_copies(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The documents that stay, with all their columns. Of rows that repeat one id and text, one stays at most."""
    renamed, back = _renamed(docs, True)
    rows, bitmaps = _marked_blocks(renamed, FINGERPRINT_BITS, block_rows)
    _, found = _grouped(rows, bitmaps)
    lost = materialize(_bitmaps(found.where("not stays").select("block", "at")))
    return _with_bit(rows, lost).where("not bit").select(*back)
