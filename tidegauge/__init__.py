"""Keyed-stream analytics on PySpark: windows, watermarks, late data, keyed
alerts and control streams, for recorded (batch) and live (streaming) input."""
