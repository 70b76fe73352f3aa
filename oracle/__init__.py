"""Expected results of the named queries as plain SQL over the same tables."""

from oracle.queries import ORACLES

__all__ = ["ORACLES"]
