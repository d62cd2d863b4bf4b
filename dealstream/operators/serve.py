"""Role-aware serving (C10): masks applied once, at the serving boundary.

Full-access roles see real values; every other role sees the notional
amounts rounded to the nearest million and counterparties replaced by a
deterministic pseudonym. ``notional_usd`` is converted first and masked
afterwards (hazard H12). Masking happens here only, so a report built from
the status view never pseudonymises a pseudonym (hazard H10).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S

MASKED_AMOUNTS = ("notional", "notional_usd")
MASKED_NAMES = ("counterparty",)


class AccessDenied(PermissionError):
    pass


def can_read(role: str, name: str) -> bool:
    allowed = K.ROLE_TABLES.get(role.upper())
    if allowed is None:
        return False
    return allowed == "*" or name in allowed


def apply_masks(df: DataFrame, role: str, salt: str | None = None) -> DataFrame:
    if role.upper() in K.FULL_ACCESS_ROLES:
        return df
    out = df
    for c in MASKED_AMOUNTS:
        if c in out.columns:
            out = out.withColumn(c, S.mask_amount(c))
    for c in MASKED_NAMES:
        if c in out.columns:
            out = out.withColumn(c, S.mask_name(c, salt))
    return out


def serve(objects: dict[str, DataFrame], name: str, role: str, salt: str | None = None) -> DataFrame:
    """The serving object ``name`` as ``role`` may see it; an object outside
    the role's allow-list raises :class:`AccessDenied`."""
    if name not in objects:
        raise KeyError(name)
    if not can_read(role, name):
        raise AccessDenied(f"role {role} may not read {name}")
    return apply_masks(objects[name], role, salt)
