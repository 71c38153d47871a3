"""Log-event indexing jobs for PySpark: filter, render, route, batch, deliver, retain."""

from eventmill.options import BatchOptions, DocumentOptions, RouteOptions, ShippingOptions

__all__ = ["BatchOptions", "DocumentOptions", "RouteOptions", "ShippingOptions"]
