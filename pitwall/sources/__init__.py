"""Sources and sinks: broker, archive, envelope decoding and layer tables."""
