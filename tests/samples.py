"""Rows that several test modules share."""

ITEMS = [
    {"sku": "SKU1001", "name": "Whole Milk", "qty": 2, "unit_price": 4.29},
    {"sku": "SKU1010", "name": "Pasta 16oz", "qty": 3, "unit_price": 1.99},
]
