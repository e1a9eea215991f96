from partflow.plans import (
    calendar, customers, demand, enrich, forecast, history, inventory, materials, reports,
    sales, supersession,
)

__all__ = [
    "calendar", "customers", "demand", "enrich", "forecast", "history", "inventory",
    "materials", "reports", "sales", "supersession",
]
