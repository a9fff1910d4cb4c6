"""Fixed values of the lending business. Operators take them as defaults only."""

from dataclasses import dataclass

# Document types and charges of the accounting documents.
DOC_CAPITAL = 1000048
DOC_DISBURSEMENT = 1000049
DOC_RECEIPT = 1000050
DOC_INTEREST = 1000051
DOC_TRANSFER_IN = 1000008
DOC_EXPENSE = 1000009
CHARGE_PRINCIPAL = 1000028
CHARGE_DISBURSEMENT = 1000030
CHARGE_TRANSFER = 1000034

# Payment term code by instalment count, and the default code.
PAYMENT_TERMS = {23: 1000001, 30: 1000002, 50: 1000003}
PAYMENT_TERM_DEFAULT = 1000000

# Risk class by days without payment (upper bound, class, label, provision).
RISK_CLASSES = [
    (15, "A", "Riesgo Normal", "0.01"),
    (30, "B", "Riesgo Potencial", "0.05"),
    (60, "C", "Riesgo Real", "0.20"),
    (90, "D", "Dudosa Recuperación", "0.50"),
    (None, "E", "Irrecuperable", "1.00"),
]

# Upper bounds in days of the regulatory ageing buckets.
TO_MATURE_BOUNDS = [30, 60, 90, 120, 180, 360]
OVERDUE_BOUNDS = [15, 30, 60, 90, 120, 180, 360]

# Label and longest gap in days of a renewal.
LABEL_NEW = "NUEVO"
LABEL_RENEWAL = "RENOVACIÓN"
LABEL_REACTIVATION = "REACTIVACIÖN"
RENEWAL_GAP_DAYS = 30
NO_PREVIOUS_LOAN = -99999


@dataclass(frozen=True)
class FiscalFactors:
    """Factors of the fiscal split of a collection."""

    net: str = "0.85"
    interest: str = "0.13"
    commission: str = "0.02"
    income: str = "0.15"
    divide: bool = False


MULTIPLY_FACTORS = FiscalFactors()
DIVIDE_FACTORS = FiscalFactors("1.15", "0.13", "1.02", "0.15", True)
