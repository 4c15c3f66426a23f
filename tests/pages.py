"""Hand-written landed API pages for the rule tests (one file per page)."""

from __future__ import annotations

import json
import os


def write_page(root: str, dataset: str, batch: str, request: str, limit: int, offset: int,
               body) -> None:
    path = os.path.join(root, f"dataset={dataset}", f"batch_id={batch}", f"request_id={request}",
                        f"limit={limit}", f"offset={offset}")
    os.makedirs(path, exist_ok=True)
    text = body if isinstance(body, str) else json.dumps(body, indent=2)
    with open(os.path.join(path, "page.json"), "w") as fh:
        fh.write(text)


def flight(dep="AAAA", arr="BBBB", delay=None, airline=..., departure=..., flight_date="2026-02-13",
           dep_sched="2026-02-13T16:26:40+00:00", dep_actual="2026-02-13T16:41:40+00:00",
           arr_sched="2026-02-13T19:00:00+00:00", arr_actual="2026-02-13T19:05:00+00:00",
           code=None):
    rec = {"flight_date": flight_date}
    if code is not None:
        rec["flight"] = {"icao": code}
    if airline is ...:
        rec["airline"] = {"name": "X"}
    elif airline != "ABSENT":
        rec["airline"] = airline
    if departure is ...:
        rec["departure"] = {"icao": dep, "airport": f"{dep} airport", "timezone": "UTC",
                            "scheduled": dep_sched, "actual": dep_actual, "delay": delay}
    else:
        rec["departure"] = departure
    rec["arrival"] = {"icao": arr, "airport": f"{arr} airport", "timezone": "UTC",
                      "scheduled": arr_sched, "actual": arr_actual}
    return rec


def page(records, total):
    return {"pagination": {"total": total}, "data": records}


def airport(code, name, country):
    rec = {"airport_name": name, "country_name": country}
    if code is not None:
        rec["icao_code"] = code
    return rec
