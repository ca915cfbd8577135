"""Sources and sinks: metadata catalog, warehouse views, profile store, JDBC."""
