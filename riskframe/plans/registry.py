"""All registered queries and the SQL that checks them."""

from riskframe.plans import credit, evaluation, fraud, loans, retail

_PARTS = (retail, credit, loans, fraud, evaluation)

QUERIES = {k: f for part in _PARTS for k, f in part.QUERIES.items()}
ORACLES = {k: s for part in _PARTS for k, s in part.ORACLES.items()}
