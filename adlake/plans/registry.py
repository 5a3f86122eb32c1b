"""Report types by name. New types can be added by users of the library."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Report = Callable[..., DataFrame | tuple[DataFrame, ...]]


class ReportRegistry:
    def __init__(self, **reports: Report):
        self._reports: dict[str, Report] = {}
        for name, fn in reports.items():
            self.register(name, fn)

    def register(self, name: str, report: Report) -> None:
        if not callable(report):
            raise TypeError(f"{report!r} is not a report function")
        self._reports[name] = report

    def get(self, name: str) -> Report:
        try:
            return self._reports[name]
        except KeyError:
            raise ValueError(f"unknown report type {name!r}; known types: {', '.join(self.types())}") from None

    def types(self) -> list[str]:
        return list(self._reports)


def default_registry() -> ReportRegistry:
    from adlake.plans import ads, shop

    return ReportRegistry(
        creative=shop.creative_report,
        product=shop.product_report,
        facebook_daily=ads.daily_report,
        facebook_performance=ads.performance_report,
        facebook_breakdown=ads.breakdown_report,
    )
