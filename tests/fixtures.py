"""Test inputs.

Fixed values: the 25 demo events of the reference (one JSON object per line, in order).
"""

SAMPLE_EVENTS = """\
{"event_id": "evt-001", "event_type": "order.placed", "customer_id": 1001, "amount": 249.99, "occurred_at": "2026-05-25T10:00:00Z"}
{"event_id": "evt-002", "event_type": "order.shipped", "customer_id": 1001, "amount": 249.99, "occurred_at": "2026-05-25T11:30:00Z"}
{"event_id": "evt-003", "event_type": "order.placed", "customer_id": 1002, "amount": 89.50, "occurred_at": "2026-05-25T10:05:00Z"}
{"event_id": "evt-004", "event_type": "click", "customer_id": 1002, "amount": 1, "occurred_at": "2026-05-25T09:55:00Z"}
{"event_id": "evt-005", "event_type": "page.view", "customer_id": 1003, "amount": 1, "occurred_at": "2026-05-25T10:10:00Z"}
{"event_id": "evt-006", "event_type": "order.placed", "customer_id": 1003, "amount": 512.00, "occurred_at": "2026-05-25T10:15:00Z"}
{"event_id": "evt-007", "event_type": "order.delivered", "customer_id": 1001, "amount": 249.99, "occurred_at": "2026-05-26T14:00:00Z"}
{"event_id": "evt-008", "event_type": "order.shipped", "customer_id": 1003, "amount": 512.00, "occurred_at": "2026-05-25T16:00:00Z"}
{"event_id": "evt-009", "event_type": "click", "customer_id": 1004, "amount": 1, "occurred_at": "2026-05-25T10:20:00Z"}
{"event_id": "evt-010", "event_type": "order.placed", "customer_id": 1004, "amount": 34.99, "occurred_at": "2026-05-25T10:25:00Z"}
{"event_id": "evt-011", "event_type": "page.view", "customer_id": 1005, "amount": 1, "occurred_at": "2026-05-25T11:00:00Z"}
{"event_id": "evt-012", "event_type": "order.placed", "customer_id": 1005, "amount": 1200.00, "occurred_at": "2026-05-25T11:05:00Z"}
{"event_id": "evt-013", "event_type": "order.shipped", "customer_id": 1005, "amount": 1200.00, "occurred_at": "2026-05-26T09:00:00Z"}
{"event_id": "evt-014", "event_type": "click", "customer_id": 1006, "amount": 1, "occurred_at": "2026-05-25T12:00:00Z"}
{"event_id": "evt-015", "event_type": "order.placed", "customer_id": 1006, "amount": 67.25, "occurred_at": "2026-05-25T12:05:00Z"}
{"event_id": "evt-016", "event_type": "page.view", "customer_id": 1007, "amount": 1, "occurred_at": "2026-05-25T13:00:00Z"}
{"event_id": "evt-017", "event_type": "order.placed", "customer_id": 1007, "amount": 445.00, "occurred_at": "2026-05-25T13:10:00Z"}
{"event_id": "evt-018", "event_type": "order.delivered", "customer_id": 1003, "amount": 512.00, "occurred_at": "2026-05-27T10:00:00Z"}
{"event_id": "evt-019", "event_type": "click", "customer_id": 1008, "amount": 1, "occurred_at": "2026-05-25T14:00:00Z"}
{"event_id": "evt-020", "event_type": "order.placed", "customer_id": 1008, "amount": 199.99, "occurred_at": "2026-05-25T14:05:00Z"}
{"event_id": "evt-021", "event_type": "order.shipped", "customer_id": 1004, "amount": 34.99, "occurred_at": "2026-05-26T08:00:00Z"}
{"event_id": "evt-022", "event_type": "page.view", "customer_id": 1009, "amount": 1, "occurred_at": "2026-05-25T15:00:00Z"}
{"event_id": "evt-023", "event_type": "order.placed", "customer_id": 1009, "amount": 78.00, "occurred_at": "2026-05-25T15:05:00Z"}
{"event_id": "evt-024", "event_type": "order.placed", "customer_id": 1010, "amount": 320.50, "occurred_at": "2026-05-25T16:00:00Z"}
{"event_id": "evt-025", "event_type": "order.delivered", "customer_id": 1005, "amount": 1200.00, "occurred_at": "2026-05-27T16:00:00Z"}
"""

# Segment per demo event (the warehouse enrichment table), in event order.
SAMPLE_SEGMENTS = [
    ("evt-001", "high_value", 0.92), ("evt-002", "high_value", 0.88), ("evt-003", "standard", 0.45),
    ("evt-004", "engagement", 0.30), ("evt-005", "engagement", 0.25), ("evt-006", "high_value", 0.95),
    ("evt-007", "high_value", 0.90), ("evt-008", "high_value", 0.87), ("evt-009", "engagement", 0.28),
    ("evt-010", "standard", 0.40), ("evt-011", "engagement", 0.22), ("evt-012", "high_value", 0.98),
    ("evt-013", "high_value", 0.91), ("evt-014", "engagement", 0.32), ("evt-015", "standard", 0.42),
    ("evt-016", "engagement", 0.20), ("evt-017", "high_value", 0.85), ("evt-018", "high_value", 0.89),
    ("evt-019", "engagement", 0.35), ("evt-020", "standard", 0.55), ("evt-021", "standard", 0.38),
    ("evt-022", "engagement", 0.18), ("evt-023", "standard", 0.48), ("evt-024", "high_value", 0.75),
    ("evt-025", "high_value", 0.93),
]


def sample_lines() -> list[str]:
    return [line for line in SAMPLE_EVENTS.splitlines() if line.strip()]
