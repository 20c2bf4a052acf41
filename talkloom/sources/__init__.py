"""Sources and sinks: JSON lines, text, INI files, versioned tables."""
