"""Query plans: the programs (Q1-Q9), the benchmark-table model and its SQL oracle."""
