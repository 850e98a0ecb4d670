"""tidemark: session, history and model features over event telemetry, on Spark."""
