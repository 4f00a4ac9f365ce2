"""Orders example: a flat change log of orders onto a summary table with a user link."""

from __future__ import annotations

from typing import Any

from ..functions.scalars import code_map, date_from_parts, joined_text, rounded_product, text_or
from ..spec import ChangeSpec, Column, Link, Mapping

# Status codes and region of each country code.
STATUS = {"NW": "NEW", "SH": "SHIPPED", "DL": "DELIVERED", "CN": "CANCELLED"}
REGION = {
    "US": "AMERICAS", "CA": "AMERICAS", "BR": "AMERICAS", "MX": "AMERICAS",
    "GB": "EMEA", "DE": "EMEA", "FR": "EMEA", "AE": "EMEA", "SA": "EMEA",
    "IN": "APAC", "JP": "APAC", "CN": "APAC", "AU": "APAC",
}

_NAME = joined_text("trim(:CUST_FIRST_NAME)", "trim(:CUST_LAST_NAME)")

ORDER_COLUMNS = {
    "customer_name": text_or(f"trim({_NAME})", "UNKNOWN"),
    "order_date": date_from_parts(":ORDER_DAY", ":ORDER_MONTH", ":ORDER_YEAR"),
    "total_amount": rounded_product(":UNIT_PRICE", ":QUANTITY"),
    "status": code_map(":STATUS_CODE", STATUS, "UNKNOWN"),
    "region": code_map(":COUNTRY_CODE", REGION, "OTHER"),
}

ORDER_TARGET = {
    "customer_name": Column("string", length=201),
    "order_date": Column("date"),
    "total_amount": Column("decimal(14,2)"),
    "status": Column("string", length=20),
    "region": Column("string", length=20),
}


def user_link(user_id: Any, section: Any) -> Link:
    return Link(
        columns={
            "summary_id": ":NEW_ID",
            "user_id": ":SYNC_USER_ID",
            "user_section": ":SYNC_USER_SECTION",
        },
        schema={
            "summary_id": Column("bigint"),
            "user_id": Column("string", length=64),
            "user_section": Column("string", length=64),
        },
        params={"SYNC_USER_ID": user_id, "SYNC_USER_SECTION": section},
    )


def orders_spec(stamped: bool = False, **changed: Any) -> ChangeSpec:
    """Spec of the example; keyword arguments override its fields.

    ``stamped`` adds the instant of the run that last wrote it to each target row.
    """
    columns, target = dict(ORDER_COLUMNS), dict(ORDER_TARGET)
    if stamped:
        columns["synced_at"], target["synced_at"] = ":AS_OF", Column("timestamp")
    settings: dict[str, Any] = {
        "business_keys": ("order_id",),
        "target": target,
        "insert": Mapping(columns),
        "update": Mapping(columns),
        "id_column": "summary_id",
        "link": user_link("u-100", "orders"),
    }
    return ChangeSpec(**{**settings, **changed})
