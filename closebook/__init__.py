"""closebook: month-end close and capital-budgeting data work on Spark DataFrames."""

from closebook.config import CloseConfig, ProcessorSpec, ReportSpec
from closebook.session import configure

__all__ = ["CloseConfig", "ProcessorSpec", "ReportSpec", "configure"]
