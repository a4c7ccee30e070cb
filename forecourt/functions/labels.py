"""Lead labels: ordered array of the products a lead touched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_LABEL = "unclassified"


def _on(flag: Column) -> Column:
    return F.coalesce(flag == 1, F.lit(False))


def lead_labels(
    insurance: Column,
    trade: Column,
    credit_partial: Column,
    credit_verified: Column,
    credit_finance: Column,
    payments: Column,
    test_drive: Column,
    spotlight: Column | None = None,
) -> Column:
    """Labels in fixed order; an unset (NULL) flag counts as off.

    ``credit`` needs an explicit finance flag of 0: with finance unknown a
    credit lead stays without the label.
    """
    plain_credit = F.coalesce(credit_finance == 0, F.lit(False)) & (_on(credit_verified) | _on(credit_partial))
    rules = {
        "finance": _on(credit_finance),
        "credit": plain_credit,
        "testdrive": _on(test_drive),
        "trade": _on(trade),
        "insurance": _on(insurance),
        "payments": _on(payments),
    }
    if spotlight is not None:
        rules["spotlight"] = _on(spotlight)
    found = F.array_compact(F.array(*[F.when(rule, F.lit(label)) for label, rule in rules.items()]))
    return F.when(F.size(found) == 0, F.array(F.lit(NO_LABEL))).otherwise(found)
