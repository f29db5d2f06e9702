"""The fact kept up to date at the cost of what a load has changed.

A load that replaces days of silver is compared with what those days held before: rows that
were added, changed or withdrawn.  Four logs say which fact rows such a change concerns, each
cut into buckets by the key it is searched with:

* ``versions``    transaction -> its snapshots, with their reference and start;
* ``references``  reference -> the transactions that have it now;
* ``payments``    reference -> its payments, all that the final state needs;
* ``orphans``     merchant -> references whose final merchant was unknown.

Logs are appended to, never rewritten: a row is told from its earlier forms by the load's
number, and a withdrawn one is a row, too.  A lookup reads only the buckets of its keys.
``compact`` folds a log's loads into one.  So an increment reads the loaded days, buckets of
the logs, and the periods of the fact that lose or gain a row; neither all payments nor the
whole fact.  Only if a merchant is withdrawn is the fact searched for its key.

What a load changes is stored before anything is replaced, and applied from there.  A run
that fails is applied by the next one; applying a load twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake import schemas as S
from paylake.operators.merge import empty
from paylake.plans import gold
from paylake.session import fresh_path
from paylake.sinks import tables as sink
from paylake.sources.tables import read_table, table_exists

LOAD, ALIVE, BUCKET = "_load", "_alive", "_bucket"
BUCKETS = 256


@dataclass(frozen=True)
class Log:
    """A log: the key it is searched by, what else tells its rows apart, and what they say."""

    key: T.StructField
    identity: list[T.StructField]
    values: list[T.StructField]

    @property
    def names(self) -> list[str]:
        return [self.key.name, *[field.name for field in self.identity]]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([self.key, *self.identity, *self.values, T.StructField(ALIVE, T.BooleanType())])

    @property
    def stored(self) -> T.StructType:
        return T.StructType([
            *self.schema.fields, T.StructField(LOAD, T.IntegerType()), T.StructField(BUCKET, T.IntegerType()),
        ])


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
}


def _fields(text: str) -> list[T.StructField]:
    """Fields written as ``name type, ...``."""
    return [T.StructField(name, _TYPES[type_]) for name, type_ in (field.split() for field in text.split(", "))]


LOGS = {
    "versions": Log(
        *_fields("transaction_id bigint"), _fields(f"{S.SNAPSHOT} date"),
        _fields("payment_reference string, tx_started_at timestamp"),
    ),
    "references": Log(
        *_fields("payment_reference string"), _fields("transaction_id bigint"), _fields("tx_started_at timestamp"),
    ),
    "payments": Log(
        *_fields("reference string"), _fields(f"transaction_id bigint, {S.SNAPSHOT} date"),
        _fields(
            "merchant_id bigint, payment_state string, card_type string, created_at timestamp, updated_at timestamp"
        ),
    ),
    "orphans": Log(*_fields("merchant_id bigint"), _fields("reference string"), []),
}
MERCHANT_CHANGES = T.StructType(_fields("merchant_id bigint, merchant_sk bigint") + _fields(f"{ALIVE} boolean"))


def differences(before: DataFrame, after: DataFrame, log: Log) -> DataFrame:
    """Rows of ``after`` that ``before`` has not or has otherwise, and, not alive, those it has no more.

    Both have the columns of the log, and each identity at most once.
    """
    values = [field.name for field in log.values]

    def side(frame: DataFrame, name: str) -> DataFrame:
        row = F.struct(F.lit(True).alias("given"), *values)
        return frame.select(*log.names, row.alias(name), F.lit(True).alias(f"{name}_given"))

    both = side(before, "_was").join(side(after, "_is"), log.names, "full")
    kept = F.coalesce("_is", "_was")
    # First what costs nothing: if one side has no rows, as with a first load, values that are
    # computed are not computed again for a comparison.
    on_one_side = F.col("_was_given").isNull() | F.col("_is_given").isNull()
    return both.where(on_one_side | ~F.col("_was").eqNullSafe(F.col("_is"))).select(
        *log.names, *[kept[name].alias(name) for name in values], F.col("_is").isNotNull().alias(ALIVE)
    )


def transaction_versions(silver_link_tx: DataFrame) -> DataFrame:
    """Snapshots of transactions as the ``versions`` log has them."""
    return gold.referenced(silver_link_tx).select("transaction_id", S.SNAPSHOT, "_row.*")


def payment_parts(silver_payments: DataFrame) -> DataFrame:
    """Payments as the ``payments`` log has them: those without a reference match nothing."""
    return silver_payments.where("reference IS NOT NULL").select(LOGS["payments"].schema.fieldNames()[:-1])


def _latest(rows: DataFrame, log: Log) -> DataFrame:
    """The last form of each row of a log, of those that are alive."""
    values = [field.name for field in log.values]
    latest = rows.groupBy(*log.names).agg(F.max_by(F.struct(ALIVE, *values), LOAD).alias("_row"))
    return latest.where(F.col(f"_row.{ALIVE}")).select(*log.names, *[f"_row.{name}" for name in values])


def _alive(rows: DataFrame, log: Log) -> DataFrame:
    """:func:`_latest` of rows of one load, which has each row of a log at most once."""
    return rows.where(ALIVE).select(*log.names, *[field.name for field in log.values])


def _newest(versions: DataFrame) -> DataFrame:
    """Reference and start of the latest snapshot of each transaction."""
    newest = versions.groupBy("transaction_id").agg(
        F.max_by(F.struct("payment_reference", "tx_started_at"), S.SNAPSHOT).alias("_row")
    )
    return newest.select("transaction_id", "_row.*")


@dataclass(frozen=True)
class FactIncrements:
    """The logs and pending loads below ``root``, and the fact at ``fact``."""

    spark: SparkSession
    root: str
    fact: str
    grain: str = "day"
    buckets: int = BUCKETS

    # ---- tables ----

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _stored(self, frame: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        frame.write.options(**sink.PACKED).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _loads(self, state: str) -> set[int]:
        """Numbers of the loads that are recorded or done; one row per load."""
        return {row.number for row in read_table(self.spark, self._path(state), _LOADS).collect()}

    def pending(self) -> list[int]:
        return sorted(self._loads("recorded") - self._loads("done"))

    def _mark(self, state: str, numbers: Iterable[int]) -> None:
        rows = [(number,) for number in numbers]
        self.spark.createDataFrame(rows, _LOADS).coalesce(1).write.mode("append").parquet(self._path(state))

    # ---- recording ----

    def record(
        self,
        transactions: tuple[DataFrame, DataFrame] | None = None,
        payments: tuple[DataFrame, DataFrame] | None = None,
        merchants: tuple[DataFrame, DataFrame] | None = None,
    ) -> int:
        """Stores what changes from the first to the second of each pair, before the tables change.

        Pairs are silver rows of the days that are loaded, and the merchant dimension.
        """
        number = max(self._loads("recorded"), default=0) + 1
        if transactions:
            before, after = map(transaction_versions, transactions)
            self._write_changes("versions", differences(before, after, LOGS["versions"]), number)
        if payments:
            before, after = map(payment_parts, payments)
            self._write_changes("payments", differences(before, after, LOGS["payments"]), number)
        if merchants:
            before, after = [frame.select("merchant_id", "merchant_sk") for frame in merchants]
            gone = before.join(after, "merchant_id", "left_anti").withColumn(ALIVE, F.lit(False))
            new = after.join(before, "merchant_id", "left_anti").withColumn(ALIVE, F.lit(True))
            self._write_changes("merchants", new.unionByName(gone), number)
        self._mark("recorded", [number])
        return number

    def _write_changes(self, name: str, rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").options(**sink.PACKED).parquet(self._path(f"changes/{name}/{LOAD}={number}"))

    def _changes(self, name: str, loads: list[int]) -> DataFrame:
        contract = MERCHANT_CHANGES if name == "merchants" else LOGS[name].schema
        numbered = T.StructType([*contract.fields, T.StructField(LOAD, T.IntegerType())])
        rows = read_table(self.spark, self._path(f"changes/{name}"), numbered)
        return rows.where(F.col(LOAD).isin(loads))

    # ---- logs ----

    def _append(self, name: str, rows: DataFrame) -> None:
        """Adds rows with their load; a load that was added before is replaced."""
        log = LOGS[name]
        bucket = F.pmod(F.xxhash64(log.key.name), F.lit(self.buckets)).cast("int")
        placed = rows.withColumn(BUCKET, bucket).hint("rebalance", F.col(LOAD), F.col(BUCKET))
        (
            placed.sortWithinPartitions(LOAD, BUCKET, log.key.name)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**sink.PACKED)
            .partitionBy(LOAD, BUCKET).parquet(self._path(f"logs/{name}"))
        )

    def lookup(self, name: str, keys: DataFrame, upto: int) -> DataFrame:
        """Rows of a log with one of the ``keys`` (one column, named as the log's key), as of a load."""
        log = LOGS[name]
        wanted = keys.select(log.key.name).where(F.col(log.key.name).isNotNull()).distinct()
        bucket = F.pmod(F.xxhash64(log.key.name), F.lit(self.buckets)).cast("int")
        asked = [row[0] for row in wanted.select(bucket).distinct().collect()]  # at most all numbers of buckets
        rows = (
            read_table(self.spark, self._path(f"logs/{name}"), log.stored)
            .where(F.col(BUCKET).isin(asked) & (F.col(LOAD) <= upto))
            .join(wanted, log.key.name, "left_semi")
        )
        return _latest(rows, log)

    def compact(self, name: str) -> None:
        """Folds all loads of a log into the last one that is done, without rows that are not alive."""
        log, done = LOGS[name], max(self._loads("done"), default=0)
        if self.pending() or not done:
            raise ValueError("apply all pending loads first")
        rows = read_table(self.spark, self._path(f"logs/{name}"), log.stored)
        kept = _latest(rows, log).withColumn(ALIVE, F.lit(True)).withColumn(LOAD, F.lit(done))
        staged = self._stored(kept.select([f.name for f in log.stored.fields[:-1]]), "compacted")
        older = [row[0] for row in rows.select(LOAD).distinct().collect()]  # one row per load
        # First the complete last load, then the others go: a lookup never misses a row.
        self._append(name, staged)
        sink.drop_partitions(self.spark, self._path(f"logs/{name}"), [f"{LOAD}={n}" for n in older if n != done])

    # ---- applying ----

    def apply(self, merchants: DataFrame) -> None:
        """Brings the fact up to date with all loads that are recorded and not done."""
        loads = self.pending()
        if not loads:
            return
        last = max(loads)
        versions, payments = self._changes("versions", loads), self._changes("payments", loads)
        self._append("versions", versions)
        self._append("payments", payments)
        exists = table_exists(self.spark, self.fact)
        if exists:
            was, now, affected, final = self._touched(versions, payments, self._changes("merchants", loads), loads)
        else:
            # The first load is all there is.
            merged = _alive if len(loads) == 1 else _latest
            now = self._stored(_newest(merged(versions, LOGS["versions"])), "now")
            was, affected = now.where("false"), now
            final = self._stored(gold.payment_final(merged(payments, LOGS["payments"])), "final")
        self._append("references", self._moved(was, now).withColumn(LOAD, F.lit(last)))
        unknown = final.selectExpr("final_merchant_id AS merchant_id", "pay_reference AS reference").where(
            "merchant_id IS NOT NULL"
        ).join(merchants, "merchant_id", "left_anti")
        self._append("orphans", unknown.withColumn(ALIVE, F.lit(True)).withColumn(LOAD, F.lit(last)))

        rows = gold.shaped(affected, final, merchants)
        if exists:
            gone = was.join(now, "transaction_id", "left_anti")
            sink.change_fact(rows, gone.select("transaction_id"), was.select("tx_started_at"), self.fact, self.grain)
        else:
            sink.write_fact(rows, self.fact, self.grain)
        self._mark("done", loads)

    def _touched(
        self, versions: DataFrame, payments: DataFrame, arrivals: DataFrame, loads: list[int]
    ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """Changed transactions as they were and are, all transactions concerned, and their final payments."""
        last, before = max(loads), min(loads) - 1
        touched = self._stored(versions.select("transaction_id").distinct(), "touched")
        was = self._stored(_newest(self.lookup("versions", touched, before)), "was")
        now = self._stored(_newest(self.lookup("versions", touched, last)), "now")
        # Other transactions of references whose payments or merchant changed.
        arrived = arrivals.where(ALIVE).select("merchant_id")
        concerned = (
            payments.select(F.col("reference").alias("payment_reference"))
            .unionByName(self.lookup("orphans", arrived, last).selectExpr("reference AS payment_reference"))
        )
        others = self.lookup("references", concerned, before).unionByName(self._without_merchant(arrivals))
        affected = self._stored(
            now.unionByName(others.join(touched, "transaction_id", "left_anti").distinct()), "affected"
        )
        wanted = affected.selectExpr("payment_reference AS reference")
        final = self._stored(gold.payment_final(self.lookup("payments", wanted, last)), "final")
        return was, now, affected, final

    def _moved(self, was: DataFrame, now: DataFrame) -> DataFrame:
        """What becomes of the ``references`` log: transactions that left a reference or came to one."""
        key = ["payment_reference", "transaction_id"]
        old, new = [frame.where("payment_reference IS NOT NULL") for frame in (was, now)]
        return differences(old, new, LOGS["references"]).select(*key, "tx_started_at", ALIVE)

    def _without_merchant(self, arrivals: DataFrame) -> DataFrame:
        """Transactions in the fact whose merchant was withdrawn: seldom, so the fact is searched for them."""
        columns = ["payment_reference", "transaction_id", "tx_started_at"]
        gone = arrivals.where(~F.col(ALIVE)).select("merchant_sk")
        if gone.isEmpty() or not table_exists(self.spark, self.fact):
            return empty(self.spark, T.StructType(_fields("payment_reference string, transaction_id bigint, tx_started_at timestamp")))
        found = sink.read_fact(self.spark, self.fact).join(gone.distinct(), "merchant_sk", "left_semi")
        return found.withColumnRenamed(S.GATING_TS, "tx_started_at").select(*columns)


_LOADS = T.StructType(_fields("number int"))
