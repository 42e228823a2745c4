"""Query plans: TPC-H q01..q22 and the registry of named queries."""
