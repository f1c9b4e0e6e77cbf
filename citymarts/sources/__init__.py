"""Sources and sinks: envelope evidence files, dimensions, table IO."""
