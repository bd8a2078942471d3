"""Language-model providers behind one interface: chain with fallback, retries, limits, structured answers, telemetry."""
