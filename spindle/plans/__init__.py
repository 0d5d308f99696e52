from spindle.plans.queries import QUERIES, run_query  # noqa: F401
from spindle.plans.oracle import ORACLE_SQL  # noqa: F401
