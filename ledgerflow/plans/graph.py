"""The graph: tables made once from the raw ones, and read by all queries.

Vertices and edges are written as Parquet into the shared folder when a query first asks for them; every later use, in
the same query or another one, reads that table, so the raw tables are scanned once. A stage is kept for a session of the
engine and made anew where the raw files have changed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerflow.operators import build, enrich, summaries, traverse
from ledgerflow.sources.adapter import TABLES, Raw, raw_tables
from ledgerflow.sources.store import fingerprint, stage_path, write_stage

#: (application, raw files, table) -> where it stands, and its schema.
_STAGES: dict[tuple, tuple[str, StructType]] = {}


class Graph:
    """Lazy tables; with a source (what tells its raw files apart) they are staged, without one they are plain plans."""

    def __init__(self, raw: Raw, source: tuple | None = None):
        self.raw, self.source = raw, source

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Graph:
        files = fingerprint(spark, *[f"{sf_dir}/{t}.parquet" for t in TABLES])
        return cls(raw_tables(spark, sf_dir), (spark.sparkContext.applicationId, files))

    def _staged(self, name: str, make: Callable[[], DataFrame], partition: str | None = None) -> DataFrame:
        if self.source is None:
            return make()
        key = (*self.source, name)
        spark = self.raw.cm.sparkSession
        if key not in _STAGES:
            df = make()
            path = stage_path(spark, name)
            _STAGES[key] = path, write_stage(df, path, partition).schema
        path, schema = _STAGES[key]
        return spark.read.schema(schema).parquet(path)

    @cached_property
    def gift_groups(self) -> DataFrame:
        return self._staged("gift_groups", lambda: build.gift_groups(self.raw.indiv))

    @cached_property
    def donors(self) -> DataFrame:
        return self._staged("donors", lambda: enrich.classified_donors(build.donors_of(self.gift_groups)))

    @cached_property
    def base_donors(self) -> DataFrame:
        return self.donors.drop("donor_type", "whale_tier")

    @cached_property
    def employers(self) -> DataFrame:
        return self._staged("employers", lambda: build.employers(self.base_donors))

    @cached_property
    def contributed(self) -> DataFrame:
        return self._staged("contributed", lambda: build.contributed_of(self.gift_groups, self.base_donors, self.raw.cm), "cycle")

    @cached_property
    def transferred(self) -> DataFrame:
        return self._staged("transferred", lambda: build.transferred_to(self.raw.pas2, self.raw.oth, self.raw.cm), "cycle")

    @cached_property
    def affiliated(self) -> DataFrame:
        return self._staged("affiliated", lambda: build.affiliated_with(self.raw.ccl, self.raw.cm, self.raw.cn))

    @cached_property
    def employed(self) -> DataFrame:
        return self._staged("employed", lambda: build.employed_by(self.base_donors, self.employers))

    @cached_property
    def spent(self) -> DataFrame:
        return self._staged("spent", lambda: build.spent_on(self.raw.ie, self.raw.cm, self.raw.cn), "cycle")

    @cached_property
    def typed(self) -> DataFrame:
        return enrich.classified_committees(self.raw.cm)

    @cached_property
    def committees(self) -> DataFrame:
        return self._staged("committees", lambda: enrich.financials(self.typed, self.contributed, self.transferred))

    @cached_property
    def starts(self) -> DataFrame:
        """start (a candidate) and its direct committees."""
        return traverse.direct_committees(self.affiliated, self.typed).withColumnRenamed("cand_id", "start")

    @cached_property
    def all_starts(self) -> DataFrame:
        """start and every committee that is linked to it in any cycle."""
        return self.affiliated.select(F.col("cand_id").alias("start"), "cmte_id").distinct()

    @cached_property
    def lean(self) -> DataFrame:
        return summaries.donor_lean(self.contributed, self.affiliated, self.raw.cn)

    @cached_property
    def ratios(self) -> DataFrame:
        """cmte_id, i, o, h: the source ratio of every committee."""
        return self._staged("ratios", lambda: traverse.source_ratio(self.committees, self.transferred, self.contributed, self.donors))

    def only(self, cycle: str, compat_receipts: bool = False) -> Graph:
        """The graph of one cycle: its edges, and receipts of that cycle; with compat_receipts those of all cycles. Who is a donor,
        what is known of them, and which committees belong to a candidate does not depend on the cycle."""
        return _OneCycle(self, cycle, compat_receipts)


class _OneCycle(Graph):
    def __init__(self, whole: Graph, cycle: str, compat_receipts: bool):
        super().__init__(whole.raw)
        self.whole, self.cycle, self.compat_receipts = whole, cycle, compat_receipts

    def _of_cycle(self, edges: DataFrame) -> DataFrame:
        return edges.filter(F.col("cycle") == self.cycle)

    donors = cached_property(lambda self: self.whole.donors)
    affiliated = cached_property(lambda self: self.whole.affiliated)
    contributed = cached_property(lambda self: self._of_cycle(self.whole.contributed))
    transferred = cached_property(lambda self: self._of_cycle(self.whole.transferred))
    spent = cached_property(lambda self: self._of_cycle(self.whole.spent))

    @cached_property
    def committees(self) -> DataFrame:
        return self.whole.committees if self.compat_receipts else enrich.financials(self.typed, self.contributed, self.transferred)
