"""Exceptions raised by the library."""

from __future__ import annotations

from typing import TYPE_CHECKING

if TYPE_CHECKING:
    from pyspark.sql import DataFrame


class DataSourceUnavailable(RuntimeError):
    """A table or path that a query needs does not exist."""


class ContractViolation(ValueError):
    """At least one partition broke its data contract.

    ``failures`` holds ``(partition_key, rule, column_name, violations)`` tuples
    for the first failing checks; ``total`` is the number of failing checks.
    ``report`` is the whole report (a data frame), where the caller kept one.
    """

    def __init__(
        self, suite: str, failures: list[tuple], total: int, report: DataFrame | None = None
    ) -> None:
        self.report = report
        self.suite = suite
        self.failures = failures
        self.total = total
        shown = "; ".join(
            f"{key}: {rule}({column}) broken by {count} row(s)"
            for key, rule, column, count in failures
        )
        more = "" if total <= len(failures) else f"; and {total - len(failures)} more"
        super().__init__(f"contract '{suite}' failed: {shown}{more}")


class UnknownPlaces(ValueError):
    """A load has readings of places that the dimension lacks.

    ``failures`` holds ``(location_id, observation_date, readings)`` of the first pairs;
    ``total`` is the number of pairs, and ``report`` the whole load report.
    """

    def __init__(self, failures: list[tuple], total: int, report: DataFrame) -> None:
        self.failures, self.total, self.report = failures, total, report
        shown = "; ".join(f"{place} on {day}: {count} reading(s)" for place, day, count in failures)
        more = "" if total <= len(failures) else f"; and {total - len(failures)} more"
        super().__init__(f"readings of unknown places: {shown}{more}")


class NoSharedFolder(RuntimeError):
    """Several machines are used and no folder that they share is named."""
