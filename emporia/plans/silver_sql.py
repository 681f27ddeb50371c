"""The Silver layer as SQL text over Bronze tables, for catalog views.

Column lists and date-times come from the source schemas, so the statements
and the DataFrame builders of ``silver`` can't drift apart in columns; a test
holds their rows against each other.
"""

from __future__ import annotations

from emporia.plans.silver import SILVER_INPUT
from emporia.sources.catalog import quoted
from emporia.sources.schemas import SOURCE_SCHEMAS, TIMESTAMP_COLUMNS


def _columns(table: str) -> list[str]:
    stamps = TIMESTAMP_COLUMNS.get(table, ())
    return [f"TRY_CAST({c} AS TIMESTAMP_NTZ) AS {c}" if c in stamps else c
            for c in SOURCE_SCHEMAS[table].fieldNames()]


def silver_selects(bronze_namespace: str) -> dict[str, str]:
    """Silver table -> SELECT over ``<bronze_namespace>.<source table>``."""
    out = {}
    for name, table in SILVER_INPUT.items():
        source = f"{quoted(bronze_namespace)}.{quoted(table)}"
        select = f"SELECT {', '.join(_columns(table))} FROM {source}"
        if table == "geolocation":
            select = select.replace("SELECT", "SELECT DISTINCT", 1)
        elif table == "orders":
            select = f"SELECT * FROM ({select}) AS parsed WHERE order_purchase_timestamp IS NOT NULL"
        elif table == "products":
            names = quoted(bronze_namespace) + ".product_category_name_translation"
            rest = [c for c in SOURCE_SCHEMAS[table].fieldNames()[2:]]
            select = (f"SELECT p.product_id, p.product_category_name, "
                      f"NVL(n.product_category_name_english, p.product_category_name) "
                      f"AS product_category_name_english, {', '.join('p.' + c for c in rest)} "
                      f"FROM {source} AS p LEFT JOIN {names} AS n USING (product_category_name)")
        out[name] = select
    return out
