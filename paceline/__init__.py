"""Endurance race analytics on Spark: race history in batch, runner telemetry live."""
