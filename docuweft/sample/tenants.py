"""Two made-up tenants; the first has its own idea of one table."""

from __future__ import annotations

from ..plans.registry import Overrides, resolver
from ..plans.spec import TAKE, party

# Its opportunities have no company of their own; it comes from the party alone.
OVERRIDES: dict[str, Overrides] = {
    "spar": {"sl_opportunity_parties": {"lookups": (party("party_id", "party_name", company=TAKE),)}},
    "dev_env": {},
}

resolve = resolver(OVERRIDES)
