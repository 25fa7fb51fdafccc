"""Sources and sinks: workspace documents and the test-table fixtures."""
