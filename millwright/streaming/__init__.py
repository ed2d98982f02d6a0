"""Empty: the workload is batch, with cadence, as-of and ripeness as its concepts of time."""
