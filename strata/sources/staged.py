"""A relational load that can be repeated (S-6, S-7, R-1).

A plain JDBC append inserts a partition's rows again when its task is retried, runs
twice by speculation, or the whole load is repeated. Here every partition goes into
a staging table in one transaction together with its row in a ledger, whose primary
key is (batch, part): of several copies of a task one commits and the others find
the part taken. When the ledger holds all parts of a batch, one more transaction
merges the staged rows into the target by key and marks the batch as merged. A load
that stops anywhere is resumed by calling it again; a merged one changes nothing.

A row's part follows from its key and the number of parts, never from the way rows
happened to be dealt, so a repeated run fills the same parts with the same rows.

``connect`` is any function without arguments that opens a DB-API 2 connection (of
the database's own Python driver) in the task that calls it. Statements are those of
PostgreSQL; nothing here starts a database, and the tests run none.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import dedup
from .jdbc import SQL_TYPES, loadable

log = logging.getLogger(__name__)
#: The part that stands for the merge in the ledger.
MERGED = -1


class Statements:
    """The statements of a staged load of ``columns`` into ``table``."""

    def __init__(self, table: str, schema: T.StructType, key: str, mark: str = "%s"):
        columns = schema.fieldNames()
        staging, ledger = f"{table}_staging", f"{table}_ledger"
        listed, marks = ", ".join(columns), ", ".join([mark] * (len(columns) + 2))
        typed = ", ".join(f"{f.name} {SQL_TYPES[f.dataType.simpleString()]}" for f in schema.fields)
        self.create = [
            f"CREATE TABLE IF NOT EXISTS {staging} (load_batch TEXT, load_part INT, {typed})",
            f"CREATE TABLE IF NOT EXISTS {ledger} (load_batch TEXT, load_part INT, parts INT, "
            "PRIMARY KEY (load_batch, load_part))"]
        self.taken = f"SELECT parts FROM {ledger} WHERE load_batch = {mark} AND load_part = {mark}"
        self.known = f"SELECT max(parts) FROM {ledger} WHERE load_batch = {mark}"
        self.take = f"INSERT INTO {ledger} (load_batch, load_part, parts) VALUES ({mark}, {mark}, {mark})"
        self.stage = f"INSERT INTO {staging} (load_batch, load_part, {listed}) VALUES ({marks})"
        self.count = f"SELECT count(*) FROM {ledger} WHERE load_batch = {mark} AND load_part <> {MERGED}"
        others = [c for c in columns if c != key]
        action = "DO UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in others) if others else "DO NOTHING"
        self.merge = (f"INSERT INTO {table} ({listed}) SELECT {listed} FROM {staging} WHERE load_batch = {mark} "
                      f"ON CONFLICT ({key}) {action}")
        self.clear = f"DELETE FROM {staging} WHERE load_batch = {mark}"
        self.empty = f"DELETE FROM {table}"


def _one(cursor, statement: str, values: tuple):
    cursor.execute(statement, values)
    row = cursor.fetchone()
    return row[0] if row else None


def stage_part(rows: Iterable[tuple], part: int, parts: int, batch: str, connect: Callable, sql: Statements,
               batch_size: int) -> bool:
    """Stages one part in one transaction; False if it is staged already."""
    connection = connect()
    try:
        cursor = connection.cursor()
        if _one(cursor, sql.taken, (batch, part)) is not None:
            return False
        try:
            # first, so that a copy of this task waits here and then finds the part taken
            cursor.execute(sql.take, (batch, part, parts))
            rows = iter(rows)
            while some := [(batch, part, *r) for r in islice(rows, batch_size)]:
                cursor.executemany(sql.stage, some)
            connection.commit()
        except Exception:
            connection.rollback()
            if _one(connection.cursor(), sql.taken, (batch, part)) is None:
                raise
            return False
        return True
    finally:
        connection.close()


def staged_load(df: DataFrame, connect: Callable, table: str, batch: str, schema: T.StructType,
                parts: int = 32, batch_size: int = 1000, clear_first: bool = False, mark: str = "%s") -> bool:
    """Loads ``df`` into ``table`` once, as ``batch``; False if it was merged before.

    Rows are those of :func:`strata.sources.jdbc.loadable`, one for each value of the
    first column of ``schema``, the target's primary key. ``clear_first`` empties the
    target in the merging transaction, so readers never see it half filled.
    """
    key = schema.fields[0].name
    sql = Statements(table, schema, key, mark)
    connection = connect()
    try:
        cursor = connection.cursor()
        for statement in sql.create:
            cursor.execute(statement)
        connection.commit()
        if _one(cursor, sql.taken, (batch, MERGED)) is not None:
            return False
        # a load that goes on keeps the number of parts that it began with
        parts = _one(cursor, sql.known, (batch,)) or parts
        connection.rollback()
    finally:
        connection.close()

    if df.sparkSession.conf.get("spark.speculation", "false") == "true":
        log.warning("spark.speculation is on: copies of load tasks wait for each other in the database")
    rows = dedup(loadable(df, schema), [key])
    part = F.pmod(F.xxhash64(F.col(key)), F.lit(parts)).cast("int")
    dealt = rows.withColumn("__part", part).repartition(parts, "__part").sortWithinPartitions("__part")
    width = len(schema.fields)

    def load(partition: Iterator) -> None:
        # several parts may share a task; each is a transaction of its own
        for own, at in groupby(partition, key=lambda r: r[width]):
            stage_part((tuple(r[:width]) for r in at), own, parts, batch, connect, sql, batch_size)

    dealt.foreachPartition(load)
    # parts without rows have no task that would enter them
    for empty in range(parts):
        stage_part((), empty, parts, batch, connect, sql, batch_size)

    connection = connect()
    try:
        cursor = connection.cursor()
        if _one(cursor, sql.count, (batch,)) != parts:
            raise RuntimeError(f"batch {batch} of {table} is not staged whole")
        try:
            cursor.execute(sql.take, (batch, MERGED, parts))
            if clear_first:
                cursor.execute(sql.empty)
            cursor.execute(sql.merge, (batch,))
            cursor.execute(sql.clear, (batch,))
            connection.commit()
        except Exception:
            connection.rollback()
            raise
    finally:
        connection.close()
    return True
