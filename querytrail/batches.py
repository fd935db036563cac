"""Extraction batch by batch: what succeeds is kept, what fails is named and repeated."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from querytrail.operators import extraction
from querytrail.schemas import EXTRACT_COLUMNS
from querytrail.session import move_into_place, store
from querytrail.sources import sinks

BATCH = ["db", "batch_number"]
LEDGER = "target_db string, target_table string, batch_number long, batch_size int, processed_date string, run long"
FAILED = "db string, batch_number long, tables array<string>, batch_size int, statement string, error string"
#: A caller's check or conversion of extracted rows; it may raise for some of them.
Check = Callable[[DataFrame], DataFrame]
FAILURES = (PySparkException, Py4JJavaError)


class TooManyFailures(RuntimeError):
    """So many batches failed that the cause is not theirs. Batches that were done are in the ledger."""


@dataclass(frozen=True)
class _Share:
    """Some of the batches: those whose hash has this remainder."""

    modulus: int = 1
    remainder: int = 0

    def holds(self, db: str = "db") -> Column:
        number = F.xxhash64(F.col(db), F.col("batch_number").cast("long"))
        return F.pmod(number, F.lit(self.modulus)) == self.remainder

    def halves(self) -> list[_Share]:
        return [_Share(2 * self.modulus, self.remainder + at) for at in (0, self.modulus)]


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The tables that finished batches hold."""
    return _read_or_empty(spark, folder, LEDGER)


def _read_or_empty(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


def read_extract(spark: SparkSession, target: str, ledger: str) -> DataFrame:
    """Extracted rows of the runs in the ledger. A run that stopped between its rows and its ledger entry
    may have left rows, which the next run replaces; they don't count."""
    runs = read_ledger(spark, ledger).select("run").distinct()
    return spark.read.parquet(target).join(runs, "run", "left_semi")


def read_failed(spark: SparkSession, folder: str) -> DataFrame:
    """The batches that failed in the last run: their tables, statement type and error."""
    return _read_or_empty(spark, folder, FAILED)


class BatchRun:
    """One run over the open batches of a work list."""

    def __init__(
        self, spark: SparkSession, batches: DataFrame, packed: DataFrame,
        extract: Callable[[DataFrame, list[str]], DataFrame], statements: list[str], check: Check,
        target: str, ledger: str, day: Column,
    ):
        """`batches` is the numbered work list, `packed` the same with a row per batch, both stored;
        `extract` gives the rows of some batches and statement types."""
        self.spark, self.batches, self.packed = spark, batches, packed
        self.extract, self.statements, self.check = extract, statements, check
        self.target, self.ledger, self.day = target, ledger, day
        done = read_ledger(spark, ledger)
        self.run = (done.agg(F.max("run")).first()[0] or 0) + 1 if not done.isEmpty() else 0
        self.rows: DataFrame | None = None

    def _rows(self, share: _Share, statements: list[str]) -> DataFrame:
        if self.rows is not None:
            kind = F.trim("StatementType").isin(statements)
            return self.check(self.rows.filter(share.holds("ObjectDatabaseName") & kind))
        return self.check(self.extract(self.batches.filter(share.holds()), statements))

    def _commit(self, share: _Share) -> DataFrame:
        """Rows and ledger entries of some batches, each moved into place when it is whole."""
        rows = store(self._rows(share, self.statements), "extract")
        staged = f"{self.target}/_staged-{uuid.uuid4().hex}"
        sinks.replace_extracts(rows.select(*EXTRACT_COLUMNS), staged)
        finished = f"{self.ledger}/_staged-{uuid.uuid4().hex}"
        held = self.packed.filter(share.holds())
        outcomes = held.select(*BATCH, F.lit(True).alias("ok"))
        extraction.append_ledger(extraction.ledger_rows(held, outcomes, self.day), finished)
        move_into_place(self.spark, staged, f"{self.target}/run={self.run}")
        move_into_place(self.spark, finished, f"{self.ledger}/run={self.run}")
        self.run += 1
        return rows

    def whole(self) -> DataFrame:
        """All batches at once; an error is the run's."""
        self.rows = self.extract(self.batches, self.statements)
        return self._commit(_Share())

    def one_by_one(self, failed: str, max_failures: int) -> DataFrame:
        """All batches at once if that succeeds. Where it does not, halves of them, and so on down to the
        batches that fail, which stay out of the ledger and are listed in `failed` with what they met."""
        try:
            self.rows = store(self.extract(self.batches, self.statements), "extract")
        except FAILURES:
            self.rows = None  # each share is extracted by itself
        done, errors = [], []
        for found in self._attempts(_Share(), max_failures):
            (errors if isinstance(found, list) else done).append(found)
        listed = self.spark.createDataFrame(
            [e for each in errors for e in each], "modulus long, remainder long, statement string, error string")
        number = F.xxhash64("db", F.col("batch_number").cast("long"))
        rows = self.packed.join(listed, F.pmod(number, "modulus") == F.col("remainder"))
        rows.select(
            "db", F.col("batch_number").cast("long"), "tables", F.col("batch_size").cast("int"), "statement", "error",
        ).write.mode("overwrite").parquet(failed)
        total = done[0] if done else self.spark.createDataFrame([], self._schema())
        for more in done[1:]:
            total = total.unionByName(more)
        return total

    def _schema(self):
        return self.extract(self.batches.limit(0), self.statements).schema

    def _attempts(self, share: _Share, left: int) -> Iterator[DataFrame | list]:
        """Committed rows, or the errors of a batch, share by share."""
        failures, open_shares = 0, [share]
        while open_shares:
            share = open_shares.pop()
            held = self.packed.filter(share.holds())
            if held.isEmpty():
                continue
            try:
                yield self._commit(share)
            except FAILURES as problem:
                if held.count() > 1:
                    open_shares.extend(share.halves())
                    continue
                failures += 1
                yield self._errors(share, problem)
                if failures > left:
                    raise TooManyFailures(
                        f"more than {left} batches failed, the last one with: {_message(problem)}") from problem

    def _errors(self, share: _Share, whole: Exception) -> list[tuple]:
        """What each statement type of a single batch meets, or its own error if they only fail together."""
        found = []
        for statement in self.statements:
            try:
                self._rows(share, [statement]).write.format("noop").mode("overwrite").save()
            except FAILURES as problem:
                found.append((share.modulus, share.remainder, statement, _message(problem)))
        return found or [(share.modulus, share.remainder, None, _message(whole))]


def _message(problem: Exception) -> str:
    """The first line that says something of its own."""
    lines = [line.strip() for line in str(problem).splitlines() if line.strip()]
    return next((line for line in lines if "[" in line and "]" in line), lines[0] if lines else type(problem).__name__)
