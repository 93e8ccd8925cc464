"""Column-level building blocks: time arithmetic, scalar rules, keyed randomness."""
