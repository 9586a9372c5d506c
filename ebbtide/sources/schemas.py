"""Declared column types of the source files.

Declaring them saves the extra pass that inference costs, keeps the leading zeros of zip codes and
makes money exact. Columns that are not listed are read as strings.
"""

# Source columns and their types.
COLUMN_TYPES = {
    "order_id": "string",
    "customer_id": "string",
    "order_purchase_timestamp": "timestamp",
    "customer_unique_id": "string",
    "customer_zip_code_prefix": "string",
    "customer_city": "string",
    "customer_state": "string",
    "payment_sequential": "int",
    "payment_type": "string",
    "payment_installments": "int",
    "payment_value": "decimal(12,2)",
    "product_id": "string",
    "shipping_limit_date": "timestamp",
    "price": "decimal(12,2)",
    "freight_value": "decimal(12,2)",
    "review_id": "string",
    "review_score": "int",
}
