"""Fleet telemetry analytics on PySpark: speed, headway, status, routes and log metrics."""
