"""Sources and sinks (S1-S8, K1, K6) and the driver-table bindings."""
