"""Running the incremental order table from arriving files."""

from shoplens.streaming.order_feed import follow_orders

__all__ = ["follow_orders"]
