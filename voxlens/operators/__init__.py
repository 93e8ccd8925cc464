"""Operators: ``DataFrame(s) -> DataFrame`` building blocks, all lazy."""
