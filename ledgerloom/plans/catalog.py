"""All queries of the core, with their SQL."""

from __future__ import annotations

from ledgerloom.plans import changes, flows, relational, scalars, services

QUERIES = {**changes.QUERIES, **scalars.Q, **relational.Q, **flows.Q, **services.Q}
SQL = {**changes.SQL, **scalars.SQL, **relational.SQL, **flows.SQL, **services.SQL}


def flagship(spark, sf):
    return relational.row09_flag(spark, sf)
