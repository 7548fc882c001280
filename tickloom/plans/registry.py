"""Where queries and the SQL that checks them are registered."""

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register a query under `name`, with the SQL that gives the same rows."""
    def add(run):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return add
