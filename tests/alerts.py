"""Alert documents for the tests."""

import json


def alert(n, **override):
    part = f"p{n % 5}"
    doc = {
        "demo_seq": n,
        "data": {"srcip": f"203.0.113.{n % 200}", "srcuser": f"user-{part}"},
        "decoder": {"name": f"decoder-{part}"},
        "rule": {"groups": ["all", part], "id": str(600 + n % 50), "level": n % 17, "description": f"Rule text {n % 50}.",
                 "mitre": {"id": [f"X{n % 50}"], "tactic": [f"Aim {part}"]}},
        "location": f"/data/{part}.log",
        "id": f"id-{n}",
        "manager": {"name": "north"},
        "agent": {"name": f"node-{part}", "ip": "192.0.2.77", "id": part},
        "timestamp": "2025-03-04T05:06:07.123+0000",
    }
    doc.update(override)
    return json.dumps(doc, separators=(",", ":"))
