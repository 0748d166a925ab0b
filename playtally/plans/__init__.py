"""Compositions of the operators: the daily KPI plan, the serving load, driver-table bindings."""
