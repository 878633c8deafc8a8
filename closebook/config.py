"""Job configuration: the INI file that names reports, their business day and the processors' column mappings.

The file is read through Spark, so it may lie in any storage the cluster reads.
"""

from __future__ import annotations

import ast
from configparser import ConfigParser, ExtendedInterpolation
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import SparkSession

from closebook.functions.dates import partition_of

SECTION = "common"
BUSINESS_DAYS = (1, 2, 3, 4)
MONTHLY = "Monthly"
DAILY = "Daily"


@dataclass(frozen=True)
class ColumnMapping:
    source: str
    source_type: str
    target: str
    target_type: str


@dataclass(frozen=True)
class ReportSpec:
    table: str
    cadence: str = MONTHLY
    sql_name: str | None = None
    partition_column: str | None = None
    mode: str = "overwrite"
    dtypes: dict[str, str] = field(default_factory=dict)
    output_path: str | None = None
    business_day: int | None = None
    schema_name: str | None = None
    sources: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class ProcessorSpec:
    name: str
    source_path: str
    table: str
    mapping: list[ColumnMapping]


# The processors that every configuration knows, and the table each one fills.
PROCESSOR_TABLES = {
    "northcard": "monthly_rpt_northcard_vcard_revenue",
    "fleetpay": "monthly_rpt_fleetpay_vcard_revenue",
}


def parse_mapping(text: str) -> list[ColumnMapping]:
    """A literal list of (source column, source type, target column, target type)."""
    try:
        rows = ast.literal_eval(text)
    except (ValueError, SyntaxError) as error:
        raise ValueError(f"not a list of 4-tuples: {text[:80]}") from error
    if not all(isinstance(row, tuple) and len(row) == 4 and all(isinstance(v, str) for v in row) for row in rows):
        raise ValueError(f"not a list of 4-tuples of text: {text[:80]}")
    return [ColumnMapping(*row) for row in rows]


class CloseConfig:
    def __init__(self, text: str) -> None:
        self._options = ConfigParser(interpolation=ExtendedInterpolation())
        self._options.read_string(text)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CloseConfig:
        return cls(spark.read.text(path, wholetext=True).first().value)

    def get(self, key: str, default: str | None = None) -> str | None:
        return self._options.get(SECTION, key, fallback=default)

    def require(self, key: str) -> str:
        value = self.get(key)
        if value is None:
            raise KeyError(f"[{SECTION}] lacks {key}")
        return value

    def day_list(self, day: int) -> list[str]:
        return [name.strip() for name in self.get(f"day{day}_tables_list", "").split(",") if name.strip()]

    def business_day(self, table: str) -> int | None:
        """The business day the table is bound to: the first list that names it, None when none does."""
        return next((day for day in BUSINESS_DAYS if table in self.day_list(day)), None)

    def report_tables(self) -> list[str]:
        """Every table with a cadence, in file order."""
        return [key.removesuffix("_report") for key in self._options.options(SECTION) if key.endswith("_report")]

    def report(self, table: str) -> ReportSpec:
        partition = self.get(f"{table}_partition_column")
        dtypes = self.get(f"{table}_dtype")
        output_path = self.get(f"{table}_output_path")
        return ReportSpec(
            table=table,
            cadence=self.require(f"{table}_report"),
            sql_name=self.require(f"{table}_sql"),
            partition_column=None if partition in (None, "None") else partition,
            mode=self.get(f"{table}_mode", "overwrite"),
            dtypes=ast.literal_eval(dtypes) if dtypes else {},
            output_path=output_path,
            business_day=self.business_day(table),
            sources=[name.strip() for name in self.get(f"{table}_sources", "").split(",") if name.strip()],
            schema_name="intermediate" if output_path else self.get("dwh_db", self.get("nopii_db")),
        )

    def reports(self) -> list[ReportSpec]:
        return [self.report(table) for table in self.report_tables()]

    def processors(self) -> dict[str, str]:
        """Every processor and its table: the known ones, and those that ``processor_list`` adds.

        ``vcard_<name>_table`` names a processor's table; an added one must have it.
        """
        added = [name.strip() for name in self.get("processor_list", "").split(",") if name.strip()]
        tables = {name: self.get(f"vcard_{name}_table", PROCESSOR_TABLES.get(name)) for name in [*PROCESSOR_TABLES, *added]}
        nowhere = [name for name, table in tables.items() if not table]
        if nowhere:
            raise KeyError(f"[{SECTION}] lacks vcard_{nowhere[0]}_table")
        return tables

    def processor(self, name: str) -> ProcessorSpec:
        tables = self.processors()
        if name not in tables:
            raise ValueError(f"unknown processor: {name}")
        return ProcessorSpec(
            name=name,
            source_path=self.require(f"vcard_{name}_src_path"),
            table=tables[name],
            mapping=parse_mapping(self.require(f"{name}_schema")),
        )

    # Locations. Buckets may be bucket names (with ``storage_scheme``, s3a:// by default) or full paths.

    def _bucket(self, key: str) -> str:
        bucket = self.require(key).rstrip("/")
        if "://" in bucket or bucket.startswith("/"):
            return bucket
        return self.get("storage_scheme", "s3a://") + bucket

    def table_path(self, table: str) -> str:
        return f"{self._bucket('destination_bucketname')}/{self.require('parquet_path')}/{table}"

    def audit(self) -> tuple[str, str] | None:
        """Path and name of the table that runs are recorded in; none unless ``audit_table`` names it."""
        name = self.get("audit_table")
        return (self.table_path(name), f"{self.require('nopii_db')}.{name}") if name else None

    def processor_inbox(self, spec: ProcessorSpec, month: date) -> str:
        return f"{self._bucket('finance_bucketname')}/{spec.source_path}/{partition_of(month)}"

    def journal_outbox(self, month: date) -> str:
        outbox = f"{self._bucket('finance_bucketname')}/{self.require('internal_outbound_path')}"
        return f"{outbox}/{partition_of(month)}/journal_entry/billed_revenue"

    def daily_outbox(self, spec: ReportSpec, month: date) -> str:
        root = self.require("daily_outbound_path")
        return f"{self._bucket('finance_bucketname')}/{root}/{partition_of(month)}/{spec.output_path}"

    def sql_path(self, spec: ReportSpec) -> str:
        root = self.require("sql_file_path").rstrip("/")
        if "://" not in root and not root.startswith("/"):
            root = f"{self._bucket('code_bucket_name')}/{root}"
        return f"{root}/{spec.sql_name}.sql"
