"""The stored lakehouse: load a range of days from files to gold.

Each step takes a date range, so a catch-up over many days is one job per table
and not one per day; a daily run is a range of one day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylake import schemas as S
from paylake.operators import quality
from paylake.operators.merge import align, empty
from paylake.plans import bronze, gold, silver
from paylake.plans.increments import BUCKETS, FactIncrements
from paylake.session import fresh_path
from paylake.sinks import tables as sink
from paylake.sources.daily_files import DailyFiles, day_range, read_days, snapshot_day
from paylake.sources.tables import of_days, read_delivered, read_drifted, read_table

Day = str | dt.date


@dataclass(frozen=True)
class Lakehouse:
    spark: SparkSession
    root: str
    # What the names of incoming files begin with, before the entity.
    file_prefix: str = ""
    # Buckets of the logs behind the fact, see plans.increments.
    buckets: int = BUCKETS
    _flagged: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _files(self, folder: str, name: str) -> DailyFiles:
        return DailyFiles(f"{folder.rstrip('/')}/{name}", f"{self.file_prefix}{name}")

    # ---- bronze ----

    def load_bronze(self, folder: str, first: Day, last: Day) -> None:
        """Payments, merchants and link transactions of the days; repeating it changes nothing.

        Merchants keep just the columns that were delivered, so that silver can tell which are missing.
        """
        spark = self.spark
        for name, contract in (
            ("bronze/payments", S.BRONZE_PAYMENTS),
            ("bronze/merchants", S.BRONZE_MERCHANTS),
            ("bronze/link_transactions", S.BRONZE_LINK_TX),
            ("landing/link_transactions", S.BRONZE_LINK_TX),
        ):
            sink.ensure_table(spark, self.path(name), contract)
        days = day_range(first, last)
        sink.replace_partitions(
            bronze.payments(spark, self._files(folder, "payments"), first, last), self.path("bronze/payments"), loaded=days
        )
        sink.replace_partitions(
            read_days(spark, self._files(folder, "merchants"), first, last), self.path("bronze/merchants"), loaded=days
        )
        landing = self.path("landing/link_transactions")
        sink.replace_partitions(
            bronze.land_link_transactions(spark, self._files(folder, "link_transactions"), first, last), landing, loaded=days
        )
        sink.replace_partitions(
            bronze.link_transactions_days(spark, landing, first, last),
            self.path("bronze/link_transactions"), loaded=days,
        )

    def load_all_landed(self, day: Day) -> None:
        """Everything ever landed as the link transactions of one day."""
        rows = bronze.link_transactions_full(self.spark, self.path("landing/link_transactions"), day)
        sink.replace_partitions(rows, self.path("bronze/link_transactions"), loaded=day_range(day, day))

    # ---- silver ----

    def build_silver(self, first: Day, last: Day) -> None:
        """Typed rows of the days; their silver partitions are replaced.

        Rows without a usable id go to ``rejected``.  What the days change is recorded for the
        fact before they are replaced.
        """
        built = {
            name: self._built(name, build, first, last)
            for name, build in (
                ("payments", silver.payments),
                ("link_transactions", silver.link_transactions),
                ("merchants", silver.merchants),
            )
        }

        def change(name: str) -> tuple[DataFrame, DataFrame]:
            return of_days(self.silver(name), first, last), built[name]

        self.increments().record(transactions=change("link_transactions"), payments=change("payments"))
        days = day_range(first, last)
        for name, rows in built.items():
            sink.replace_partitions(rows, self.path(f"silver/{name}"), _SILVER[name][1], loaded=days)
            self._count(name, days)

    def _built(self, name: str, build, first: Day, last: Day) -> DataFrame:
        """Silver rows of the days, stored aside; rejected rows of the same bronze days, in place.

        Bronze days are stored and stay as they are during the run: they are read again, not copied.
        """
        days = day_range(first, last)
        rows = of_days(self._delivered(name), first, last)
        flagged = quality.flagged_ids(rows) if "id" in rows.columns else rows.selectExpr("*", f"'missing id' AS {quality.REASON}")
        sink.replace_partitions(
            align(flagged.where(f"{quality.REASON} IS NOT NULL"), _REJECTED[name]), self.path(f"rejected/{name}"), loaded=days
        )
        stored = self.rejected(name).where(F.col(S.SNAPSHOT).isin(days)).count()
        accepted = flagged.where(f"{quality.REASON} IS NULL")
        read = rows.count()
        if accepted.count() + stored != read:
            raise RuntimeError(f"{name}: {read} rows read, {stored} rejected rows stored")
        self._flagged[name] = flagged
        return self._aside(build(accepted.drop(quality.REASON)), f"silver-{name}")

    def _aside(self, frame: DataFrame, name: str) -> DataFrame:
        path = fresh_path(self.spark, name)
        frame.write.options(**sink.PACKED).parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _count(self, name: str, days: list[dt.date]) -> None:
        """Rows read, accepted and rejected per day, and what became of them."""
        read = self._flagged.pop(name).groupBy(S.SNAPSHOT).agg(
            F.expr("count(*) AS bronze_rows"), F.expr(f"count_if({quality.REASON} IS NULL) AS accepted_rows"),
            F.expr(f"count({quality.REASON}) AS rejected_rows"),
        )
        kept = self.silver(name).where(F.col(S.SNAPSHOT).isin(days)).groupBy(S.SNAPSHOT).agg(F.expr("count(*) AS silver_rows"))
        counts = read.join(kept, S.SNAPSHOT, "left").selectExpr(
            "bronze_rows", "accepted_rows", "rejected_rows", "coalesce(silver_rows, 0L) AS silver_rows", S.SNAPSHOT
        )
        sink.replace_partitions(counts, self.path(f"counts/{name}"), loaded=days)

    def load_counts(self, name: str) -> DataFrame:
        """Per day: rows of bronze, accepted and rejected ones, and the silver rows they became."""
        return read_table(self.spark, self.path(f"counts/{name}"), _COUNTS)

    def rejected(self, name: str) -> DataFrame:
        """Rows that silver did not take, with the reason."""
        return read_table(self.spark, self.path(f"rejected/{name}"), _REJECTED[name])

    def silver(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(f"silver/{name}"), _SILVER[name][0])

    def bronze(self, name: str) -> DataFrame:
        return read_drifted(self.spark, self.path(f"bronze/{name}"), _BRONZE[name])

    def _delivered(self, name: str) -> DataFrame:
        """Bronze rows as silver takes them: those of merchants with the columns that ever came."""
        if name != "merchants":
            return read_table(self.spark, self.path(f"bronze/{name}"), _BRONZE[name])
        found = read_delivered(self.spark, self.path("bronze/merchants"))
        return found if found is not None else empty(self.spark, _BRONZE[name])

    # ---- gold ----

    def build_dimensions(self) -> None:
        spark = self.spark
        sink.rebuild(gold.dim_date(spark), self.path("gold/dim_date"))
        sink.rebuild(gold.dim_payment_method(spark), self.path("gold/dim_payment_method"))
        sink.rebuild(gold.dim_payment_state(spark), self.path("gold/dim_payment_state"))
        built = self._aside(gold.dim_merchants(self.silver("merchants")), "dim-merchants")
        self.increments().record(merchants=(self.merchants(), built))
        sink.rebuild(built.sortWithinPartitions("merchant_sk"), self.path("gold/dim_merchants"))

    def merchants(self) -> DataFrame:
        return read_table(self.spark, self.path("gold/dim_merchants"), S.DIM_MERCHANTS)

    def fact(self) -> DataFrame:
        return sink.read_fact(self.spark, self.path("gold/fact_transactions"))

    def increments(self) -> FactIncrements:
        return FactIncrements(
            self.spark, self.path("increments"), self.path("gold/fact_transactions"), buckets=self.buckets
        )

    def build_fact(self) -> None:
        """Brings the fact up to date with everything recorded since it last was."""
        self.increments().apply(self.merchants())

    # ---- runs ----

    def run(self, folder: str, first: Day, last: Day) -> None:
        """Files of the days to gold."""
        self.load_bronze(folder, first, last)
        self._refine(first, last)

    def run_day(
        self, folder: str, run_day: Day, lag_days: int = 0, override: str | None = None, full_load: bool = False
    ) -> dt.date:
        """One run with the usual options; gives the day that it loaded.

        That is the run day less a lag, or ``override`` (YYYYMMDD).  With ``full_load`` all link
        transactions ever landed count as that day's.
        """
        day = snapshot_day(run_day, lag_days, override)
        self.load_bronze(folder, day, day)
        if full_load:
            self.load_all_landed(day)
        self._refine(day, day)
        return day

    def _refine(self, first: Day, last: Day) -> None:
        self.build_silver(first, last)
        self.build_dimensions()
        self.build_fact()


_BRONZE = {
    "payments": S.BRONZE_PAYMENTS, "link_transactions": S.BRONZE_LINK_TX, "merchants": S.BRONZE_MERCHANTS,
}
_SILVER = {
    "payments": (S.SILVER_PAYMENTS, silver.PAYMENT_KEY),
    "link_transactions": (S.SILVER_LINK_TX, silver.LINK_TX_KEY),
    "merchants": (S.SILVER_MERCHANTS, silver.MERCHANT_KEY),
}
_REJECTED = {
    name: T.StructType([*contract.fields[:-1], T.StructField(quality.REASON, T.StringType()), contract[S.SNAPSHOT]])
    for name, contract in _BRONZE.items()
}
_COUNTS = T.StructType(
    [T.StructField(f"{name}_rows", T.LongType()) for name in ("bronze", "accepted", "rejected", "silver")]
    + [T.StructField(S.SNAPSHOT, T.DateType())]
)
