"""The seed shop: rows of the three source tables as change records."""

import json

# Seed rows.
USERS = [
    (1, "John Doe", "john@example.com"),
    (2, "Jane Smith", "jane@company.com"),
    (3, "Bob Wilson", "bob@test.org"),
    (4, "Alice Brown", "alice@demo.com"),
    (5, "Charlie Davis", "charlie@sample.com"),
]
PRODUCTS = [
    (1, "Laptop Pro", 1299.99, "Electronics"),
    (2, "Wireless Mouse", 29.99, "Electronics"),
    (3, "Office Chair", 199.99, "Furniture"),
    (4, "Standing Desk", 449.99, "Furniture"),
    (5, "USB-C Hub", 79.99, "Electronics"),
    (6, "Monitor 4K", 399.99, "Electronics"),
    (7, "Keyboard Mechanical", 149.99, "Electronics"),
    (8, "Webcam HD", 89.99, "Electronics"),
]
ORDERS = [
    (1, 1, 1, 1, 1299.99, "completed"),
    (2, 1, 2, 2, 59.98, "completed"),
    (3, 2, 3, 1, 199.99, "shipped"),
    (4, 2, 4, 1, 449.99, "processing"),
    (5, 3, 5, 3, 239.97, "completed"),
    (6, 3, 6, 1, 399.99, "shipped"),
    (7, 4, 7, 2, 299.98, "processing"),
    (8, 5, 8, 1, 89.99, "completed"),
    (9, 1, 3, 1, 199.99, "completed"),
    (10, 2, 1, 1, 1299.99, "shipped"),
]
COLUMNS = {
    "users": ("id", "name", "email"),
    "products": ("id", "name", "price", "category"),
    "orders": ("id", "user_id", "product_id", "quantity", "total_amount", "status"),
}
START_MS = 1_704_067_200_000


class Feed:
    """Makes change records with rising offsets, log positions and commit times."""

    def __init__(self):
        self.position = 0

    def record(self, table, op, after=None, before=None, ts_ms=None, lsn=None, **source):
        self.position += 1
        envelope = {
            "before": before,
            "after": after,
            "op": op,
            "ts_ms": START_MS + self.position * 1000 if ts_ms is None else ts_ms,
            "source": {
                "db": "shop",
                "schema": "public",
                "table": table,
                "lsn": self.position if lsn is None else lsn,
                "txId": 1,
                **source,
            },
        }
        return self.raw(json.dumps(envelope), f"cdc.public.{table}", offset=self.position)

    def raw(self, value, topic="cdc.public.users", partition=0, offset=None):
        if offset is None:
            self.position += 1
            offset = self.position
        return {
            "topic": topic,
            "partition": partition,
            "offset": offset,
            "timestamp": "2024-01-01T00:00:00.000Z",
            "key": "1",
            "value": value,
        }

    def seeds(self):
        tables = {"users": USERS, "products": PRODUCTS, "orders": ORDERS}
        return [
            self.record(table, "c", dict(zip(COLUMNS[table], row))) for table, rows in tables.items() for row in rows
        ]


def write_records(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records) + "\n")
