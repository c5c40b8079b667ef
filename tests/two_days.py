"""Two invented daily dumps with the shapes a real API sends: bare arrays, one-record files and envelopes."""

from __future__ import annotations

import json
from pathlib import Path


def _write(root: Path, day: str, entity: str, name: str, content) -> None:
    folder = root / day / entity
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))


def _agent(number: int, name: str) -> dict:
    return {
        "id": number,
        "contact": {"name": name, "email": f"{name.lower()}@example.org"},
        "created_at": "2021-01-01T00:00:00Z",
        "updated_at": "2022-01-01T00:00:00Z",
        "type": "agent",
    }


def _details(number: int, name: str, roles: list[int]) -> dict:
    return {**_agent(number, name), "group_ids": [], "role_ids": roles, "skill_ids": []}


def _group(number: int, name: str, parent: int | None, members: list[int]) -> dict:
    return {
        "id": number, "name": name, "description": f"about {name}", "parent_group_id": parent,
        "agent_ids": members, "created_at": "2021-02-02T00:00:00Z", "updated_at": "2022-02-02T00:00:00Z",
    }


def _payment(name: str, amount: str, exponent: int, code: str, card: str, budget: str, **more) -> dict:
    return {
        "id": name, "transactionType": "AUTHORIZATION", "merchantName": f"shop {name}",
        "currencyData": {"exchangeRate": 1, "exponent": exponent, "originalCurrencyAmount": amount,
                         "originalCurrencyCode": code, "symbol": "x"},
        "occurredTime": "2026-01-05T09:15:00.000+00:00", "updatedTime": "2026-01-05T09:20:00.000+00:00",
        "cardId": card, "budgetId": budget, "tags": [{"isRequired": True, "selectedTagValues": ["a"]}], **more,
    }


ROLES = [{"id": n, "name": f"Role {n}", "description": f"does {n}"} for n in range(501, 507)]
CARDS = [{"id": f"c{n}", "lastFour": f"000{n}", "type": "VIRTUAL", "status": "ACTIVE",
          **({"name": f"card {n}"} if n % 2 else {})} for n in range(1, 8)]
BUDGETS = [{"id": f"b{n}", "name": f"budget {n}", **({"description": "first"} if n == 1 else {})}
           for n in range(1, 6)]


def write_days(root: Path) -> None:
    """Day 1: 6 users, 5 groups, 7 transactions. Day 2: 4 of the users, a moved group, no transactions."""
    people = {11: ("Ada", [501]), 12: ("Bo", [502]), 13: ("Cy", [502]), 14: ("Di", [502]),
              15: ("Eva", [501, 503]), 16: ("Flo", [501, 502, 504])}
    for day in ("day1", "day2"):
        for number, (name, roles) in people.items():
            _write(root, day, "agent_details", f"{number}.json", _details(number, name, roles))
        _write(root, day, "roles", "1.json", ROLES)
        _write(root, day, "cards", "1.json", {"results": CARDS})
        _write(root, day, "budgets", "1.json", {"results": BUDGETS})
    _write(root, "day1", "agents", "1.json", [_agent(n, p[0]) for n, p in people.items()])
    # 11 and 16 are gone from the day 2 index, although their details files are still there.
    _write(root, "day2", "agents", "1.json", [_agent(n, people[n][0]) for n in (12, 13, 14, 15)])
    _write(root, "day1", "admin_groups", "1.json", [
        _group(1, "root", None, [12, 13, 11, 15, 16]), _group(2, "ops", 1, [11, 16]),
        _group(3, "sec", 1, [12, 15]), _group(4, "desk", 1, [12, 13, 11, 16]), _group(5, "lab", 1, [14, 13, 11, 16]),
    ])
    # sec moves below ops, which has only users that are gone; member 99 of the root is nobody.
    _write(root, "day2", "admin_groups", "1.json", [
        _group(1, "root", None, [12, 13, 11, 15, 99]), _group(2, "ops", 1, [11, 16]),
        _group(3, "sec", 2, [12, 15]), _group(4, "desk", 1, [12, 13, 11, 16]), _group(5, "lab", 1, [14, 13, 11, 16]),
    ])
    payments = [
        _payment("t1", "2310", 2, "USD", "c1", "b1"), _payment("t2", "99900", 2, "USD", "c2", "b2"),
        _payment("t3", "7500", 2, "USD", "c3", "b2"), _payment("t4", "640", 2, "USD", "c4", "b3"),
        _payment("t5", "21050", 2, "USD", "c5", "b4"), _payment("t6", "130005", 2, "USD", "c6", "b4"),
        _payment("t7", "12559", 2, "GBP", "c6", "b4"),
    ]
    _write(root, "day1", "transactions", "1.json", {"results": payments})
    _write(root, "day1", "rates", "2026-01-05.json", {"date": "2026-01-05", "usd": {"gbp": 0.79, "eur": 0.9, "xyz": 3}})
