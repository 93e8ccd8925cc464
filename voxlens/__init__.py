"""voxlens: customer-feedback analytics, account risk and model-lifecycle rules
as plain Spark DataFrame jobs.

Every public operator is ``DataFrame(s) -> DataFrame``, lazy, and takes an
explicit ``as_of`` so that results do not depend on the wall clock.
"""

from voxlens.config import DEFAULT_AS_OF

__all__ = ["DEFAULT_AS_OF"]
