"""Which files of a table may hold given ids, without opening them.

With every folder of data an index is written: per file its smallest and largest id
and a Bloom filter of its ids. The filter comes in blocks of 32,768 bits, the size of
Spark's bitmap aggregate; a hash of the id chooses the block, eight positions in it
are set. A file gets as many blocks (a power of two) as leave an id 16 to 32 bits, so
a strange id passes in about one of 2,000 to 170,000 cases. Nothing that a file holds
is ever missed.

Looking ids up joins them with the blocks they fall into: the index is read once and,
as the ids are few, not shuffled.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.session import materialized
from paystrata.sources import files

INDEX_SCHEMA = "file string, low string, high string, n_blocks int, block int, bits binary"
#: Bits of one block, fixed by ``bitmap_construct_agg``, and ids that share it at most.
BLOCK_BITS, BLOCK_IDS = 32768, 2048
#: A larger batch would pass the filters of most files by chance: all ids are read then.
MOST_IDS = 1_000_000

_POSITION_BITS = 15
_SEEDS = (1, 2)


def _positions(key: Column) -> list[Column]:
    """Eight positions in the block, from two hashes of four positions each."""
    return _positions_of(*(F.xxhash64(key, F.lit(seed)) for seed in _SEEDS))


def _positions_of(*hashes: Column) -> list[Column]:
    return [
        F.shiftright(hashed, _POSITION_BITS * part).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int")
        for hashed in hashes
        for part in range(4)
    ]


def _block(key: Column, n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key), n_blocks).cast("int")


def has_bit(bits: Column, position: Column) -> Column:
    """Whether a bitmap of ``bitmap_construct_agg`` has a bit at ``position``."""
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), position % 8) == 1


def index_folder(spark: SparkSession, root: str, folder: str, index: str, scratch: str, key: str = "txn_id") -> None:
    """Write the index of all Parquet files below ``root/folder`` (reads their ids).

    File names are kept relative to ``root``, as they begin with ``folder``. An id is one
    narrow row in its task's sort: each of its eight positions has a bitmap of its own,
    and the eight of a block are united when the ids have become blocks.
    """
    rows = spark.read.parquet(f"{root}/{folder}")
    name = F.regexp_extract("_metadata.file_path", f"({folder}/.*)$", 1)
    ids = rows.select(F.col(key).alias("id"), name.alias("file"))
    blocks = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") / BLOCK_IDS, F.lit(1.0))))).cast("int")
    sizes = ids.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    numbered = sizes.withColumn("n_blocks", blocks).drop("n").withColumn("number", F.monotonically_increasing_id())
    sizes = materialized(numbered, scratch)
    placed = ids.join(sizes, "file").select(
        "number", _block(F.col("id"), F.col("n_blocks")).alias("block"),
        *(F.xxhash64("id", F.lit(seed)).alias(f"hash_{seed}") for seed in _SEEDS),
    )
    positions = _positions_of(*(F.col(f"hash_{seed}") for seed in _SEEDS))
    single = placed.groupBy("number", "block").agg(
        F.array(*(F.bitmap_construct_agg(position) for position in positions)).alias("parts")
    )
    united = single.select("number", "block", F.explode("parts").alias("part")).groupBy("number", "block")
    filters = united.agg(F.bitmap_or_agg("part").alias("bits")).join(sizes, "number")
    filters.select("file", "low", "high", "n_blocks", "block", "bits").write.parquet(index)


def files_that_may_hold(index: DataFrame, ids: DataFrame, key: str = "txn_id") -> list[str]:
    """Names of the files whose range and filter do not exclude all ``ids``.

    What reaches the driver is at most the table's file names, and one record per
    number of blocks.
    """
    bounds = ids.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    if bounds.low is None:
        return []
    near = index.where((F.col("low") <= bounds.high) & (F.col("high") >= bounds.low))
    layouts = [row.n_blocks for row in near.select("n_blocks").distinct().collect()]
    if not layouts:
        return []
    wanted = ids.select(
        F.col(key).alias("id"), F.explode(F.array(*(F.lit(n) for n in layouts))).alias("n_blocks")
    ).withColumn("block", _block(F.col("id"), F.col("n_blocks")))
    found = near.join(wanted, ["n_blocks", "block"]).where((F.col("id") >= F.col("low")) & (F.col("id") <= F.col("high")))
    for position in _positions(F.col("id")):
        found = found.where(has_bit(F.col("bits"), position))
    return sorted(row.file for row in found.select("file").distinct().collect())


def read_index(spark: SparkSession, paths: Collection[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], INDEX_SCHEMA)
    return spark.read.schema(INDEX_SCHEMA).parquet(*sorted(paths))


def has_index(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path}/_SUCCESS")
