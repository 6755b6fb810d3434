"""Registered queries of the reference's own operators, bound to the driver's tables."""

from . import change, core, events, evidence, usage

QUERIES = {**core.QUERIES, **usage.QUERIES, **change.QUERIES, **evidence.QUERIES, **events.QUERIES}
ORACLES = {**core.ORACLES, **usage.ORACLES, **change.ORACLES, **evidence.ORACLES, **events.ORACLES}
