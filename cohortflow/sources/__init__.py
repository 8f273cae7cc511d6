"""Sources and sinks: raw tables, fixture views, writers."""
