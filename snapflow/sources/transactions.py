"""Transactions over several tables under one folder.

    <store>/intents/<try>/<table>/...   rows that a transaction will write, complete before any table is touched
    <store>/tx/<n>.json                 the record: from here on the transaction counts
    <store>/done/<n>.json               all tables have its rows

A transaction computes its rows from the tables, stores them, and takes the next number by creating that record's
file, which only one writer can. Whoever finds a record without its ``done`` file carries it out: every table is
written by a commit under the record's name, so a part done twice counts once. A job that dies before its record
leaves nothing that counts; one that dies after it is finished by its own repeat or by the next writer. A writer
who finds his number taken carries the other's record out and computes his rows again from the tables as they are
then, so transactions have the results of one after another, in the order of their numbers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapflow.sources.markers import create_if_absent, numbered, read_text

_RECORDS = "number long, name string, attempt string, tables array<string>, facts map<string, string>"

#: Writes the rows of one table of a record: (table, rows, name of the commit).
Apply = Callable[[str, DataFrame, str], None]


@dataclass
class Record:
    number: int
    name: str
    attempt: str
    tables: list[str]              # in the order in which they are written
    facts: dict[str, str] = field(default_factory=dict)  # what the next transaction should know


@dataclass
class Prepared:
    """Rows by table, in the order in which they are to be written, and facts for the record."""

    rows: dict[str, DataFrame]
    facts: dict[str, str] = field(default_factory=dict)


def record(spark: SparkSession, store: str, number: int) -> Record:
    return Record(**json.loads(read_text(spark, f"{store}/tx/{number}.json")))


def find_record(spark: SparkSession, store: str, name: str) -> Record | None:
    """The record of a transaction's name, if it has one; one scan of the small record files."""
    try:
        row = spark.read.schema(_RECORDS).json(f"{store}/tx").filter(F.col("name") == name).select("number").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return record(spark, store, row.number) if row else None


def unfinished(spark: SparkSession, store: str) -> list[int]:
    done = set(numbered(spark, f"{store}/done"))
    return [n for n in numbered(spark, f"{store}/tx") if n not in done]


def intents(spark: SparkSession, store: str, of: Record, table: str) -> DataFrame:
    return spark.read.parquet(f"{store}/intents/{of.attempt}/{table}")


def roll_forward(spark: SparkSession, store: str, apply: Apply) -> None:
    """Carry out all records that are not done, in their order."""
    for number in unfinished(spark, store):
        now = record(spark, store, number)
        for table in now.tables:
            apply(table, intents(spark, store, now, table), now.name)
        create_if_absent(spark, f"{store}/done/{number}.json", json.dumps({"name": now.name}))


class Transaction:
    """One named transaction; ``prepare(last record)`` computes its rows from the tables as they are."""

    def __init__(self, spark: SparkSession, store: str, name: str, prepare: Callable[[Record | None], Prepared], apply: Apply):
        self.spark, self.store, self.name, self.compute, self.apply = spark, store, name, prepare, apply
        self.base: int | None = None

    def prepare(self) -> "Transaction":
        """Compute the rows from the tables as they are and store them; nothing counts yet."""
        base = max(numbered(self.spark, f"{self.store}/tx"), default=0)
        roll_forward(self.spark, self.store, self.apply)  # up to the base at least; whatever comes after takes its number
        found = self.compute(record(self.spark, self.store, base) if base else None)
        self.attempt = uuid.uuid4().hex
        for table, rows in found.rows.items():
            rows.write.parquet(f"{self.store}/intents/{self.attempt}/{table}")
        self.tables, self.facts, self.base = list(found.rows), found.facts, base
        return self

    def take(self) -> Record:
        """Get a number, computing the rows again as often as another transaction has come between."""
        while True:
            known = find_record(self.spark, self.store, self.name)
            if known:
                return known
            if self.base is None or self.base != max(numbered(self.spark, f"{self.store}/tx"), default=0):
                self.prepare()
            mine = Record(self.base + 1, self.name, self.attempt, self.tables, self.facts)
            if create_if_absent(self.spark, f"{self.store}/tx/{mine.number}.json", json.dumps(vars(mine))):
                return mine

    def commit(self) -> Record:
        """Take a number and carry everything out that is not done."""
        taken = self.take()
        roll_forward(self.spark, self.store, self.apply)
        return taken
