"""Order-event analytics on Spark: running restaurant and menu-item statistics over JSON
streams, and the batch operators around them."""

__version__ = "0.1.0"
