"""Row-by-row Python models of the history rules, to check the Spark plans against."""

import hashlib


def content(event):
    """The text hash of a decoded (id, status) row."""
    parts = [event["id"], event["status"], "true" if event["op"] != "d" else "false"]
    return hashlib.sha256("||".join("NULL" if p is None else str(p) for p in parts).encode()).hexdigest()


def order(event):
    return (event["lsn"], event["ts_ms"], event["offset"])


def full_history(events):
    """Versions (id, status, start_ms, end_ms, is_active, close_lsn) of each key."""
    versions, current = [], {}
    for event in sorted(events, key=lambda e: (e["id"], *order(e))):
        key, now = event["id"], event["ts_ms"]
        version = current.get(key)
        if event["op"] == "d":
            if version:
                version.update(end=now, active=False, close=event["lsn"])
                del current[key]
            continue
        if version and version["hash"] == content(event):
            continue
        if version:
            version.update(end=now, close=event["lsn"])
        current[key] = {
            "id": key, "status": event["status"], "start": now, "end": None, "active": True, "close": None,
            "hash": content(event),
        }
        versions.append(current[key])
    return sorted(
        ((v["id"], v["status"], v["start"], v["end"], v["active"], v["close"]) for v in versions), key=str
    )


def latest(events):
    newest = {}
    for event in events:
        if event["id"] not in newest or order(event) > order(newest[event["id"]]):
            newest[event["id"]] = event
    return newest


class Silver:
    """Batch-wise refinement: the contract of the merge step, one key at a time."""

    def __init__(self):
        self.open, self.closed, self.fences = {}, [], {}

    def step(self, batch, stamp):
        for key, event in latest(batch).items():
            row = self.open.get(key)
            delete, fence = event["op"] == "d", self.fences.get(key)
            if row is None:
                if not delete and not (fence and order(event) <= fence):
                    self.open[key] = {"event": event, "from": stamp, "last": order(event)}
            elif order(event) > row["last"]:
                if delete or content(event) != content(row["event"]):
                    self.closed.append((key, row["event"]["status"], row["from"], stamp, not delete))
                    del self.open[key]
                    if not delete:
                        self.open[key] = {"event": event, "from": stamp, "last": order(event)}
                else:
                    row["last"] = order(event)
            if delete:
                self.fences[key] = max(order(event), fence or order(event))

    def rows(self):
        still = [(k, r["event"]["status"], r["from"], None, True) for k, r in self.open.items()]
        return sorted(self.closed + still, key=str)
