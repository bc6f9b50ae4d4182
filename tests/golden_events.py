"""A made-up shop day of 27 events, small enough to work every expected value
out by hand (FIXTURES.md, section 2): four users, five sessions and two events
without a session, three products, one event of an unknown type, three hours of
2024-03-08.

Each visit: (session, user, device, referrer of its first event, start, seconds
between events, events). An event is (type, product, quantity).
"""

from __future__ import annotations

import datetime as _dt

AS_OF = _dt.date(2024, 3, 8)

TEA = ("t-1", "Green tea", "Pantry", 6.50)
MUG = ("m-1", "Stone mug", "Kitchen", 11.25)
LAMP = ("l-1", "Desk lamp", "Home", 39.98)


def _e(kind, product=None, quantity=None):
    return kind, product, quantity


VISITS = [
    ("A", "ada", "tablet", "https://news.example", "08:05:00", 30, [
        _e("login"), _e("search"), _e("product_view", TEA), _e("product_view", MUG), _e("logout")]),
    ("B", "bo", "desktop", "https://mail.example", "08:40:00", 20, [
        _e("page_view"), _e("product_view", MUG), _e("add_to_cart", MUG, 3), _e("checkout_start"),
        _e("payment_info"), _e("purchase", MUG, 3), _e("purchase", TEA, 2)]),
    ("C", "ada", "mobile", None, "21:10:00", 50, [
        _e("page_view"), _e("add_to_cart", TEA, 1), _e("remove_from_cart", TEA, 1)]),
    ("D", "cy", "desktop", "https://news.example", "21:30:00", 0, [_e("signup")]),
    (None, "cy", None, None, "21:35:00", 40, [_e("page_view"), _e("wishlist")]),
    ("E", "dee", "mobile", "", "23:00:00", 25, [
        _e("category_view"), *[_e("product_view", LAMP)] * 6, _e("add_to_cart", LAMP, 1), _e("purchase", LAMP, 1)]),
]


def raw_rows() -> list[dict]:
    rows = []
    for session, user, device, referrer, start, gap, events in VISITS:
        begin = _dt.datetime.fromisoformat(f"{AS_OF}T{start}")
        for i, (kind, product, quantity) in enumerate(events):
            row = {"event_id": f"{session or 'none'}-{i}", "user_id": user, "session_id": session, "event_type": kind,
                   "timestamp": (begin + _dt.timedelta(seconds=i * gap)).strftime("%Y-%m-%dT%H:%M:%SZ"),
                   "page_url": "https://shop.example/", "device_type": device, "referrer": referrer if i == 0 else None}
            if product is not None:
                row |= dict(zip(("product_id", "product_name", "product_category", "price"), product), quantity=quantity)
            rows.append(row)
    return rows
