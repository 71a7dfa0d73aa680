"""All registered queries over the driver tables."""

from __future__ import annotations

from . import analogues, imaging, records

QUERIES = {**analogues.QUERIES, **imaging.QUERIES, **records.QUERIES}
SQL = {**analogues.SQL, **imaging.SQL, **records.SQL}
