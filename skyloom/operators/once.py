"""Exactly one copy of every message that was delivered at least once."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom import schemas
from skyloom.functions.columns import hex_id, key128
from skyloom.session import shared_dir
from skyloom.sources.versioned import VersionedTable

#: An identifier with more rows than this in one delivery log is laid out by salt before its copies meet. At most
#: rows / HOT_ROWS identifiers can be hot, which bounds what is broadcast.
HOT_ROWS = 1_000_000
SALTS = 64


@dataclass(frozen=True)
class Copies:
    """What makes two rows copies, and which of them stays.

    ``identifier`` is the message's own id (compared as its 64 hexadecimal digits; where not ``hexadecimal`` the message is identified by
    it and the natural key together), ``natural`` the rest of the key,
    ``arrival`` then ``row_id`` the order: the smallest stays. ``partition`` gives the partition of a row from its natural key, so all
    copies of a row lie in one partition. A row whose identifier is NULL cannot be recognised again and always stays; NULLs in
    the natural key are equal to each other; a NULL arrival is earliest.
    """

    identifier: str
    natural: tuple[str, ...]
    arrival: str
    row_id: str
    partition: Column
    hexadecimal: bool = True

    def ident(self) -> Column:
        if self.hexadecimal:
            return hex_id(self.identifier)
        return F.concat_ws("|", F.col(self.identifier).cast("string"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in self.natural])

    def rows(self, df: DataFrame) -> DataFrame:
        """Only what the decision needs: a 128-bit key, the identifier's own hash, the order and the partition."""
        i = self.ident()
        a, b = key128(i, *self.natural)
        return df.select(
            F.col(self.row_id).alias("id"), F.col(self.arrival).alias("at"), F.when(F.col(self.identifier).isNotNull(), F.xxhash64(i)).alias("ident"),
            a.alias("k1"), b.alias("k2"), self.partition.cast("string").alias("part"),
        )


def _later(rows: DataFrame, *by: str) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(F.col("at").asc_nulls_first(), F.col("id").asc_nulls_first())) > 1


def losers(rows: DataFrame, index: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``tab``, ``id`` and ``part`` of all rows but the single winner of each key, among rows with an identifier.

    Rows of identifiers that the index shows as hot are first decided within salts, and only the winners of the salts meet: a
    group of copies that holds a third of all rows never lies in one task.
    """
    out = ["tab", "id", "part"]
    known = rows.where(F.col("ident").isNotNull()).select(*out, "at", "ident", "k1", "k2")
    hot = index.groupBy("ident").agg(F.sum("n").alias("n")).where(F.col("n") > hot_rows).select("ident", F.lit(True).alias("hot"))
    marked = known.join(F.broadcast(hot), "ident", "left").drop("ident")
    plain = marked.where(F.col("hot").isNull())
    cold = plain.withColumn("x", _later(plain, "k1", "k2")).where("x").select(*out)
    salted = marked.where(F.col("hot")).withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    first = salted.withColumn("x", _later(salted, "k1", "k2", "salt"))
    kept = first.where(~F.col("x"))
    second = kept.withColumn("x", _later(kept, "k1", "k2"))
    return cold.unionByName(first.where("x").select(*out)).unionByName(second.where("x").select(*out))


_SURPLUS = schemas.flat("tab int, id bigint, part string")


class SurplusLedger:
    """Which rows of a partitioned delivery log are surplus: the decision of ``OnceStore`` kept beside a log that stays as it is.

    The log's own partitions are the history. A merge looks up the historical partitions that hold an identifier of the incoming
    messages, combines their rows with the incoming ones, recomputes the single winners, and overwrites only those
    partitions of the ledger, in one atomic rename. What other partitions hold is what earlier merges left there.
    """

    def __init__(self, spark: SparkSession, root: str, hot_rows: int = HOT_ROWS):
        self.table = VersionedTable(spark, f"{root}/surplus", F.col("part"), _SURPLUS)
        self.hot_rows = hot_rows
        shared_dir(spark)

    @staticmethod
    def index(rows: DataFrame) -> DataFrame:
        """The identifier index: one entry per message and partition with its number of rows, a small part of the rows; written once."""
        return rows.where(F.col("ident").isNotNull()).groupBy("ident", "part").agg(F.count(F.lit(1)).alias("n")).checkpoint()

    def _write(self, rows: DataFrame, index: DataFrame, parts: list[str] | None) -> None:
        self.table.replace(losers(rows, index, self.hot_rows).select(*_SURPLUS.names), parts)

    def load(self, rows: DataFrame, index: DataFrame) -> None:
        """The first load: every partition is decided by itself, for copies share a partition."""
        self._write(rows, index, None)

    def merge(self, history: DataFrame, index: DataFrame, incoming: DataFrame) -> list[str]:
        """Merge a batch; returns the partitions that were rewritten. A batch that was merged before changes nothing."""
        arriving = self.index(incoming)
        known = index.join(arriving.select("ident").distinct(), "ident", "left_semi").select("part")
        affected = sorted(r[0] for r in known.union(arriving.select("part")).distinct().collect())  # partitions, not rows
        if affected:
            self._write(history.where(F.col("part").isin(affected)).unionByName(incoming), index.unionByName(arriving), affected)
        return affected

    def read(self) -> DataFrame:
        return self.table.read()


def surplus_of_tables(tables: dict[str, tuple[DataFrame, Copies, Column]], root: str | None = None, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, list[str]]:
    """The surplus rows (``table_name``, ``id``, ``part``) of delivery logs, each with its copies' rule and the instant at which the incoming batch begins.

    Rows with ``arrival < cut`` (or without one) are the history, which is loaded first; then the batch is merged through the identifier
    index (see ``SurplusLedger``; its folder is ``root``, by default a new one in the shared folder). All tables go
    in one pass, their partitions, identifiers and keys kept apart by their place in the list. Also returns the partitions that the
    batch rewrote.
    """
    parts = []
    for i, (df, copies, cut) in enumerate(tables.values()):
        r = copies.rows(df)
        own = {"ident": F.when(F.col("ident").isNotNull(), F.xxhash64(F.lit(i), F.col("ident"))), "k1": F.xxhash64(F.lit(i), F.col("k1")), "part": F.concat(F.lit(f"{i}_"), F.coalesce("part", F.lit("none")))}
        parts.append(r.withColumns(own | {"new": F.coalesce(F.col("at") >= cut, F.lit(False)), "tab": F.lit(i)}))
    rows = reduce(DataFrame.unionByName, parts)
    ledger = SurplusLedger(rows.sparkSession, root or f"{shared_dir(rows.sparkSession)}/surplus-{uuid.uuid4().hex[:10]}", hot_rows)
    history, incoming = rows.where(~F.col("new")), rows.where("new")
    index = ledger.index(history)
    ledger.load(history, index)
    rewritten = ledger.merge(history, index, incoming)
    names = F.array(*[F.lit(n) for n in tables])
    return ledger.read().select(F.get(names, F.col("tab")).alias("table_name"), "id", "part"), rewritten


def surplus_by_arrival(df: DataFrame, copies: Copies, cut: Column, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The surplus rows of one table that holds both sides, as one column ``id``."""
    return surplus_of_tables({"": (df, copies, cut)}, None, hot_rows)[0].select("id")


class OnceStore:
    """A partitioned table that keeps exactly one copy of each message, with its identifier index beside it.

    Both are ``VersionedTable``s: a merge writes the recomputed partitions under new names and makes them valid in one
    atomic rename, rows first and then the index. If the index is lost in between, ``reindex`` restores it from the rows.
    """

    def __init__(self, spark: SparkSession, root: str, copies: Copies, schema: T.StructType | None = None):
        self.copies = copies
        self.rows = VersionedTable(spark, f"{root}/rows", copies.partition, schema)
        self.index = VersionedTable(spark, f"{root}/index", F.col("part"), schemas.flat("ident bigint, part string"))
        shared_dir(spark)

    def read(self) -> DataFrame | None:
        return self.rows.read()

    def _entries(self, df: DataFrame) -> DataFrame:
        ident = F.xxhash64(self.copies.ident())
        return df.where(F.col(self.copies.identifier).isNotNull()).select(ident.alias("ident"), self.rows.part().alias("part")).distinct()

    def merge(self, incoming: DataFrame) -> list[str]:
        """Merge a batch; returns the partitions that were rewritten. A batch that was merged before changes no row.

        The index gives the historical partitions that hold an identifier of the batch; they and those the batch lands in
        are combined with it, their single winners recomputed, and only they are overwritten.
        """
        c = self.copies
        batch = incoming.checkpoint()
        entries = self._entries(batch)
        landed = {r[0] for r in batch.select(self.rows.part()).distinct().collect()}  # partitions, not rows
        if not landed:
            return []
        known = {r[0] for r in self.index.read().join(entries.select("ident").distinct(), "ident", "left_semi").select("part").distinct().collect()}
        affected = sorted(landed | known)
        history = self.rows.read(affected)
        both = batch if history is None else history.unionByName(batch, allowMissingColumns=True)
        a, b = key128(c.ident(), *c.natural)
        lone = F.col(c.identifier).isNull()
        keyed = both.withColumns({"_k1": F.when(lone, F.xxhash64(c.row_id)).otherwise(a), "_k2": F.when(lone, F.lit(-1).cast("bigint")).otherwise(b)})
        order = Window.partitionBy("_k1", "_k2").orderBy(F.col(c.arrival).asc_nulls_first(), F.col(c.row_id).asc_nulls_first())
        winners = keyed.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").select(*both.columns).checkpoint()
        self.rows.replace(winners, affected)
        self.index.replace(self._entries(winners), affected)
        return affected

    def reindex(self) -> None:
        rows = self.rows.read()
        if rows is not None:
            self.index.replace(self._entries(rows), set(self.rows.partitions()) | set(self.index.partitions()))


def forecast_copies(period: str = "day") -> Copies:
    return Copies("source_event_id", ("model", "location_id", "init_time", "valid_time", "variable"), "inserted_at", "forecast_id", F.to_date(F.date_trunc(period, "init_time")))


def observation_copies(period: str = "day") -> Copies:
    return Copies("source_event_id", ("station", "observed_at", "variable"), "inserted_at", "observation_id", F.to_date(F.date_trunc(period, "observed_at")))


#: Offsets of a topic partition that share a partition of the history: a late copy touches one such stretch, not the topic's past.
OFFSETS = 500


def dead_letter_copies() -> Copies:
    """Dead letters have no hexadecimal id: topic, partition and offset identify the message."""
    stretch = F.concat_ws("_", F.col("source_topic"), F.col("source_partition").cast("string"), F.floor(F.col("source_offset") / OFFSETS).cast("string"))
    return Copies("source_topic", ("source_partition", "source_offset"), "failed_at", "dlq_id", stretch, hexadecimal=False)
