"""Sources and sinks: test-data bindings, landed files (CSV/JSON), table sinks."""
