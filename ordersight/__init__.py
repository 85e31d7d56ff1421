"""Spark-native order analytics.

Every operator is a function from DataFrame to DataFrame built from Spark's own
expressions. Nothing in the library collects data to the driver; callers decide
when to run an action.
"""

from ordersight.schema import ORDERS_SCHEMA, conform, present
from ordersight.operators.filters import OrderFilter, apply_filter

__all__ = ["ORDERS_SCHEMA", "conform", "present", "OrderFilter", "apply_filter"]
