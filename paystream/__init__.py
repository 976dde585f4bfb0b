"""paystream: event-time analytics for payment logs, as Spark DataFrame functions."""
