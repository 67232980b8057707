"""odolake - telemetry lake analytics expressed as Spark DataFrame jobs."""
