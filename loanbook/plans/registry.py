"""Registered queries: name -> (Spark callable, oracle SQL or None)."""

from loanbook.functions.scalars import emit
from loanbook.plans.sqlviews import ctes

AS_OF = "1998-06-30"
PERIOD = ("1998-06-01", "1998-06-30")
CASH_DAY = "2024-01-15"
CASH_RANGE = ("2024-01-08", "2024-01-21")

REGISTRY: dict = {}


def query(name: str, sql: str | None = None, digits: int = 2, recursive: bool = False):
    """Register a function (spark, sf_dir) -> DataFrame; decimals leave as rounded doubles."""
    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = (
            lambda spark, sf_dir: emit(fn(spark, sf_dir), digits),
            None if sql is None else ctes(sql, recursive),
        )
        return fn
    return add


def load_all() -> dict:
    from loanbook.plans import all_queries  # noqa: F401
    return REGISTRY
