"""All registered queries, and the SQL that each of them must agree with."""

from litfunnel.plans import funnel  # noqa: F401  registers its queries
from litfunnel.plans.queries import ORACLE, QUERIES  # noqa: F401
