"""Named query plans over the shared test tables, their SQL oracles, and the batch job."""

from ebbflow.plans.catalog import QUERIES, flagship
from ebbflow.plans.oracle import ORACLES

__all__ = ["ORACLES", "QUERIES", "flagship"]
