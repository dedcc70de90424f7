"""Registered queries of the library, by the families of operators; the first registered is the flagship."""

from tidewatch.plans import scores  # noqa: F401, I001
from tidewatch.plans import audits, backtests, calendar, clean, experiments, forecasting, linear_models, more, point_in_time, renewables, scenarios, stores, trees  # noqa: F401
