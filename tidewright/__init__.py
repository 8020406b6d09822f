"""tidewright: demand-panel analytics on PySpark."""
