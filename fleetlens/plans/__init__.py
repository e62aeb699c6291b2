from fleetlens.plans.catalog import FLAGSHIP
from fleetlens.plans.catalog import QUERIES as BATCH_QUERIES
from fleetlens.plans.oracle import ORACLE_SQL
from fleetlens.plans.replays import REPLAYS

QUERIES = {**BATCH_QUERIES, **REPLAYS}

__all__ = ["BATCH_QUERIES", "FLAGSHIP", "ORACLE_SQL", "QUERIES", "REPLAYS"]
