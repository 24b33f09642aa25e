"""Sources and sinks: queue lines, fact datasets, views."""
