"""Import every module that registers queries."""

from loanbook.plans import (  # noqa: F401
    q_balances, q_bridges, q_cash, q_close, q_functions, q_interest, q_migration, q_payments,
    q_quality, q_reports, q_sources, q_statements, q_tax)
