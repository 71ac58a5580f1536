"""The order-item table: raw header names, our column names and their types."""

from __future__ import annotations

import re

# Header names of the raw export, our names, and the Spark types.
RAW_COLUMNS: dict[str, tuple[str, str]] = {
    "Customer Id": ("customer_id", "bigint"),
    "Order Id": ("order_id", "bigint"),
    "Order Item Quantity": ("quantity", "double"),
    "Sales": ("sales", "double"),
    "Order Profit Per Order": ("profit", "double"),
    "Order Item Discount": ("discount_amount", "double"),
    "Order Item Discount Rate": ("discount_rate", "double"),
    "Order Item Product Price": ("unit_price", "double"),
    "Order Item Total": ("order_item_total", "double"),
    "Order Item Profit Ratio": ("profit_ratio", "double"),
    "Latitude": ("latitude", "double"),
    "Longitude": ("longitude", "double"),
    "Benefit per order": ("benefit_per_order", "double"),
    "Late_delivery_risk": ("late_delivery_risk", "int"),
    "Days for shipping (real)": ("real_days", "int"),
    "Days for shipment (scheduled)": ("scheduled_days", "int"),
    "Customer Segment": ("customer_segment", "string"),
    "Market": ("market", "string"),
    "Order Region": ("order_region", "string"),
    "Category Name": ("category_name", "string"),
    "Order Status": ("order_status", "string"),
    "Delivery Status": ("delivery_status", "string"),
    "Product Name": ("product_name", "string"),
    "Order Country": ("order_country", "string"),
    "Shipping Mode": ("shipping_mode", "string"),
    "Department Name": ("department_name", "string"),
    "Customer City": ("customer_city", "string"),
    "Customer Country": ("customer_country", "string"),
    "Order City": ("order_city", "string"),
    "order date (DateOrders)": ("order_date", "timestamp_ntz"),
    "shipping date (DateOrders)": ("ship_date", "timestamp_ntz"),
}

TYPES: dict[str, str] = dict(RAW_COLUMNS.values())
TEXT_COLUMNS = ("customer_city", "customer_country", "order_city")
DATE_COLUMNS = ("order_date", "ship_date")
CRITICAL_COLUMNS = ("sales", "profit", "customer_id")
OUTLIER_COLUMNS = ("sales", "profit", "discount_amount")


def squash(name: str) -> str:
    """Header name without case, underscores, brackets and repeated blanks."""
    return re.sub(r"[^a-z0-9]+", " ", name.lower()).strip()


OUR_NAMES: dict[str, str] = {
    **{squash(ours): ours for ours, _ in RAW_COLUMNS.values()},
    **{squash(raw): ours for raw, (ours, _) in RAW_COLUMNS.items()},
}
