"""A Bloom filter of join keys, as a small table that reaches the scan of the other side.

A key sets ``BITS_SET`` bits of one block of 2^15 bits; its hash names the block and the bits.
``BLOCK_KEYS`` keys to a block make 16 bits a key, and a key that was not put in passes in some
2 or 3 of 1000 cases. Blocks are rows, broadcast and joined by their number: every row of the
other side meets one block at most, in place, before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftgauge.checkpoints import store

BLOCK_KEYS = 2048
BITS_SET = 4
#: Bytes of all blocks up to which they are broadcast: some 33 million keys.
FILTER_BYTES = 64 * 1024 * 1024

_POSITION_BITS = 15  # of a block, as Spark's bitmap functions have it
_BLOCK_BYTES = (1 << _POSITION_BITS) // 8
_WORDS = _BLOCK_BYTES // 8

#: Types of which equal values have equal hashes.
_HASHABLE = (T.IntegralType, T.DecimalType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def can_filter(one: DataFrame, other: DataFrame, keys: list[str]) -> bool:
    """Do equal keys of both sides have equal hashes? Only if their types are the same."""
    kinds = [(one.schema[k].dataType, other.schema[k].dataType) for k in keys]
    return all(a == b and isinstance(a, _HASHABLE) for a, b in kinds)


def blocks_for(count: int, limit_bytes: int = FILTER_BYTES) -> int | None:
    """Number of blocks for so many keys, or None if they were too large to broadcast."""
    blocks = max(1, -(-count // BLOCK_KEYS))
    return blocks if blocks * _BLOCK_BYTES <= limit_bytes else None


def key_blocks(df: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    """_block, _words: the filter of the keys of ``df``, stored; one row a block at most."""
    block, bits = _places(keys, blocks)
    placed = df.select(block.alias("_block"), F.explode(F.array(*bits)).alias("_bit"))
    maps = placed.groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    word = lambda i: F.conv(F.hex(F.substring("_map", i * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    words = F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), word)
    return store(maps.select("_block", words.alias("_words")))[0]


def with_possible_keys(df: DataFrame, keys: list[str], filters: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``df`` whose key may be in the filter; no row with a key in it is lost."""
    block, bits = _places(keys, blocks)
    met = df.withColumn("_own", block).join(F.broadcast(filters), F.col("_own") == F.col("_block"))
    for bit in bits:
        met = met.where(_is_set(F.col("_words"), bit))
    return met.select(*[F.col(f"`{c}`") for c in df.columns])


def _places(keys: list[str], blocks: int) -> tuple[Column, list[Column]]:
    columns = [F.col(f"`{k}`") for k in keys]
    block = F.pmod(F.xxhash64(*columns), F.lit(blocks))
    other = F.xxhash64(F.lit(1), *columns)
    mask = F.lit((1 << _POSITION_BITS) - 1).cast("bigint")
    bits = [F.shiftrightunsigned(other, _POSITION_BITS * i).bitwiseAND(mask) for i in range(BITS_SET)]
    return block, bits


def _is_set(words: Column, bit: Column) -> Column:
    """Bytes are in order in a word, the first in the highest place; bits count from the lowest."""
    place = (7 - F.shiftright(bit, 3).bitwiseAND(F.lit(7).cast("bigint"))) * 8
    place = place + bit.bitwiseAND(F.lit(7).cast("bigint"))
    return F.getbit(F.get(words, F.shiftright(bit, 6).cast("int")), place.cast("int")) == 1
