"""Registered queries over the driver's tables, each with the SQL that checks it."""

from newsloom.workload.registry import ORACLES, QUERIES  # noqa: F401
from newsloom.workload import cleaning, digests, enrichment, ingestion, jobs, streams  # noqa: F401, E402
