"""lexgraph: a PySpark-native engine for legal knowledge graphs held as DataFrames of nodes and edges."""
