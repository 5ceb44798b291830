"""Query registry: a callable (spark, folder) -> DataFrame per name, and its SQL statement."""

from skygauge.plans.views import SQL_VIEWS

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query. ``views`` lists the shared views its SQL reads, separated by blanks."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(views, sql)
        return fn
    return register


def with_views(views: str, sql: str) -> str:
    """Prefix ``sql`` with the shared views; a leading WITH in ``sql`` continues the list."""
    wanted: list = []

    def need(view):
        needs, _ = SQL_VIEWS[view]
        for v in needs.split():
            need(v)
        if view not in wanted:
            wanted.append(view)
    for view in views.split():
        need(view)
    sql = sql.strip()
    if not wanted:
        return sql
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v][1].strip()})" for v in wanted)
    if sql[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{sql[5:]}"
    return f"WITH {ctes}\n{sql}"
