"""Silver: one row per transaction, kept current by upserts.

Silver is a Parquet table with a folder per event date; a version file names the
folders that make up the table, and an index tells which files may hold an id. Rows without an id (NULL or
blank) cannot be addressed by an upsert; the quarantine has them as ``no_id``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from paystrata.functions.ids import has_id
from paystrata.functions.times import parse_event_time
from paystrata.operators import locator
from paystrata.operators.duplicates import group_sizes
from paystrata.schema import TRANSACTION_COLUMNS, TRANSACTION_SCHEMA
from paystrata.session import materialized, scratch_path
from paystrata.sources import files, versions

SILVER_SCHEMA = T.StructType(
    [
        *TRANSACTION_SCHEMA.fields,
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
    ]
)
_INDEX = "_files"
_NO_DATE = "none"
_LATEST_FIRST = ("arrival_timestamp", "txn_timestamp")


def latest_per_transaction(df: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """The row with the latest arrival per ``txn_id``; rows without an id are left out.

    Arrivals are compared as times, whatever their spelling; a readable time beats any
    unreadable one. Ties are broken by event time, then by both texts (the greater
    first) and every other column, so the result does not depend on row order. Spark pushes the rank filter below the shuffle
    (window group limit): a task sends at most one row per id, which is what
    keeps a hot id from flooding one reducer.
    """
    rest = [name for name in TRANSACTION_COLUMNS if name not in (*_LATEST_FIRST, "txn_id")]
    ranking = Window.partitionBy("txn_id").orderBy(
        *(parse_event_time(F.col(name)).desc_nulls_last() for name in _LATEST_FIRST),
        *(F.col(name).desc_nulls_last() for name in _LATEST_FIRST),
        *(F.col(name).asc_nulls_first() for name in (*rest, *tie_breakers)),
    )
    return (
        df.where(has_id(F.col("txn_id")))
        .withColumn("_place", F.row_number().over(ranking))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def version_order() -> Column:
    """The order of :func:`latest_per_transaction` as one value, for aggregates: the least wins.

    Times are negated and texts complemented digit by digit in hexadecimal, with an end
    mark above all digits, so that what is greatest there is least here.
    """

    def last_time(name: str) -> Column:
        micros = F.unix_micros(parse_event_time(F.col(name)))
        return F.coalesce(-micros, F.lit((1 << 63) - 1)).alias(f"{name}_back")

    def last_text(name: str) -> Column:
        digits = F.translate(F.hex(F.col(name)), "0123456789ABCDEF", "FEDCBA9876543210")
        return F.coalesce(F.concat(digits, F.lit("G")), F.lit("H")).alias(f"{name}_text_back")

    rest = [name for name in TRANSACTION_COLUMNS if name not in (*_LATEST_FIRST, "txn_id")]
    return F.struct(*map(last_time, _LATEST_FIRST), *map(last_text, _LATEST_FIRST), *rest)


def latest_versions(df: DataFrame, scratch: str) -> DataFrame:
    """Same rows as :func:`latest_per_transaction`, cheaper where ids rarely
    repeat (runs a job that writes below ``scratch``).

    The repeated ids are found first, from the id column alone, and written, so
    that the planner knows their size in bytes. Where it finds them small enough to
    broadcast, all other rows pass without shuffle or sort and only the rows that
    compete are ranked; else both joins meet by id.
    """
    repeated = materialized(
        group_sizes(df).where(F.col("group_size") > 1).select("txn_id"), scratch
    )
    alone = df.where(has_id(F.col("txn_id"))).join(repeated, "txn_id", "left_anti")
    competing = df.join(repeated, "txn_id", "left_semi")
    return alone.unionByName(latest_per_transaction(competing))


def silver_rows(latest: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Deduplicated transactions in the silver layout."""
    event_date = F.to_date(parse_event_time(F.col("txn_timestamp")))
    return latest.select(
        *TRANSACTION_COLUMNS,
        (F.current_timestamp() if updated_at is None else updated_at).alias("updated_at"),
        event_date.alias("event_date"),
    )


def _versions(spark: SparkSession, path: str) -> list[str]:
    return versions.listed(spark, path)


def _folders(spark: SparkSession, version: str) -> dict[str, str]:
    """Date (or ``none``) to folder, one record per date."""
    return versions.content(spark, version)


def current_folders(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder of every event date (or ``none``) in the newest version."""
    found = _versions(spark, path)
    return _folders(spark, found[-1]) if found else {}


def _read(spark: SparkSession, path: str, folders: Collection[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], SILVER_SCHEMA)
    return spark.read.schema(SILVER_SCHEMA).parquet(*(f"{path.rstrip('/')}/{name}" for name in sorted(folders)))


def read_folders(spark: SparkSession, path: str, folders: Collection[str]) -> DataFrame:
    """Rows of chosen folders of a version, with the ``slot`` (date or ``none``) they lie in."""
    slot = F.coalesce(F.date_format("event_date", "yyyy-MM-dd"), F.lit(_NO_DATE))
    return _read(spark, path, folders).withColumn("slot", slot)


def read_silver(
    spark: SparkSession, path: str, dates: Collection[dt.date | None] | None = None
) -> DataFrame:
    """The table's newest version, or only some event dates of it.

    A version names its folders, so a reader sees one state of the table even
    while an upsert runs, and only the folders of the chosen dates are listed.
    """
    folders = current_folders(spark, path)
    if dates is not None:
        chosen = {_slot(date) for date in dates}
        folders = {slot: name for slot, name in folders.items() if slot in chosen}
    return _read(spark, path, folders.values())


def upsert_silver(
    txns: DataFrame, path: str, *, updated_at: Column | None = None
) -> None:
    """Merge new transactions into the silver table at ``path`` (runs jobs).

    * The batch is evaluated once. Only dates that receive rows, or hold an older
      version of a received id, are rewritten. The latter are found in the files
      whose range of ids and Bloom filter allow a received id; other files are not
      opened. Batches of more than ``locator.MOST_IDS`` ids read all ids.
    * Existing rows without a new version are copied where they are read: they only
      meet the (unique) new ids in a semi and an anti join, which become broadcasts
      when the batch is small, and are neither sorted nor shuffled for the write.
    * Changed dates are written once, to new folders, and then named by a new
      version. A run that dies before that has changed nothing; the next one
      removes what it left. Repeating a batch changes nothing.

    One writer at a time per table: a version that exists is not replaced. Folders
    stay until the second upsert after the one that replaced them, for readers.
    """
    spark = txns.sparkSession
    earlier = _versions(spark, path)
    current = _folders(spark, earlier[-1]) if earlier else {}
    _remove_unnamed(spark, path, earlier)
    scratch = scratch_path(spark, "upsert")
    try:
        batch = materialized(txns.select(*TRANSACTION_COLUMNS), f"{scratch}/batch")
        latest = latest_versions(batch, f"{scratch}/repeated")
        incoming = materialized(silver_rows(latest, updated_at), f"{scratch}/incoming")
        named = _write_changed(incoming, path, current, scratch)
    finally:
        files.delete(spark, scratch)
    versions.publish(spark, path, earlier, named)


def _holders(ids: DataFrame, path: str, current: dict[str, str]) -> list[str]:
    """Files, or whole folders where there is no index, that may hold one of the ids."""
    spark = ids.sparkSession
    if ids.count() > locator.MOST_IDS:
        return list(current.values())
    root = path.rstrip("/")
    loads = {name.split("/")[1] for name in current.values()}
    indexed = {load for load in loads if locator.has_index(spark, f"{root}/{_INDEX}/{load}")}
    index = locator.read_index(spark, [f"{root}/{_INDEX}/{load}" for load in indexed])
    # A load's later replaced dates stay in its index: one record per date is current.
    index = index.where(F.regexp_extract("file", "^(.*)/[^/]*$", 1).isin(list(current.values())))
    unknown = [name for name in current.values() if name.split("/")[1] not in indexed]
    return [*locator.files_that_may_hold(index, ids), *unknown] if indexed else unknown


def _write_changed(incoming: DataFrame, path: str, current: dict[str, str], scratch: str) -> dict[str, str]:
    """Write the changed dates to a new folder; the folders of the next version."""
    spark = incoming.sparkSession
    ids = incoming.select("txn_id")
    existing = _read(spark, path, _holders(ids, path, current))
    # Ids that the table holds: only their rows compete, all others are written as they are.
    replaced = existing.select("txn_id", "event_date").join(ids, "txn_id", "left_semi")
    replaced = materialized(replaced, f"{scratch}/replaced")
    held = replaced.select("txn_id")
    # One record per calendar day at most.
    affected = {
        _slot(row.event_date)
        for row in replaced.select("event_date")
        .unionByName(incoming.select("event_date"))
        .distinct()
        .collect()
    }
    in_affected = _read(spark, path, [name for slot, name in current.items() if slot in affected])
    untouched = in_affected.join(held, "txn_id", "left_anti")
    inserted = incoming.join(held, "txn_id", "left_anti")
    contested = in_affected.unionByName(incoming).join(held, "txn_id", "left_semi")
    winners = latest_per_transaction(contested, tie_breakers=["updated_at"])
    received = inserted.unionByName(winners).select(*SILVER_SCHEMA.names).hint("rebalance", "event_date")
    merged = untouched.select(*SILVER_SCHEMA.names).unionByName(received)
    root, load = path.rstrip("/"), uuid.uuid4().hex
    slot = F.coalesce(F.date_format("event_date", "yyyy-MM-dd"), F.lit(_NO_DATE))
    merged.withColumn("slot", slot).write.partitionBy("slot").parquet(f"{root}/data/{load}")
    kept = {slot: name for slot, name in current.items() if slot not in affected}
    written = files.matching(spark, f"{root}/data/{load}/slot=*")
    for folder in written:
        name = folder.rsplit("/", 1)[1]
        kept[name.removeprefix("slot=")] = f"data/{load}/{name}"
    if written:
        locator.index_folder(spark, root, f"data/{load}", f"{root}/{_INDEX}/{load}", f"{scratch}/sizes")
    return kept


def changed_rows(spark: SparkSession, path: str) -> DataFrame:
    """What the newest version changed: ``sign`` -1 with the row before, 1 with the row after.

    An inserted transaction has one row, an updated or moved one two. Only dates whose
    folder differs between the two newest versions are read; rows that an upsert has
    merely copied do not show. The sums of any measure times its sign are what the
    upsert added to it.
    """
    found = _versions(spark, path)
    after = _folders(spark, found[-1]) if found else {}
    before = _folders(spark, found[-2]) if len(found) > 1 else {}
    old, new = (
        _read(spark, path, [name for slot, name in one.items() if other.get(slot) != name])
        for one, other in ((before, after), (after, before))
    )
    row = F.struct(*SILVER_SCHEMA.names)
    pairs = old.select("txn_id", row.alias("old")).join(new.select("txn_id", row.alias("new")), "txn_id", "full_outer")
    differs = ~F.col("old").eqNullSafe(F.col("new"))
    sides = F.array(
        *(
            F.when(F.col(side).isNotNull(), F.struct(F.lit(sign).alias("sign"), F.col(side).alias("row")))
            for side, sign in (("old", -1), ("new", 1))
        )
    )
    signed = pairs.where(differs).select(F.inline(F.filter(sides, lambda side: side.isNotNull())))
    return signed.select("sign", "row.*")


def _slot(date: dt.date | None) -> str:
    return _NO_DATE if date is None else date.isoformat()


def _remove_unnamed(spark: SparkSession, path: str, earlier: list[str]) -> None:
    """Delete folders that neither of the two newest versions names, and their indexes."""
    named = {name for version in earlier[-2:] for name in _folders(spark, version).values()}
    versions.remove_unnamed(spark, path, "data/*/slot=*", named)
    loads = {name.split("/")[1] for name in named}
    versions.remove_unnamed(spark, path, f"{_INDEX}/*", {f"{_INDEX}/{load}" for load in loads})
