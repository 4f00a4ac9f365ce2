"""Sequential model of the replay rules, one change at a time. Only for tests."""

from __future__ import annotations


def run(changes, target=None, quarantine=None, *, quarantine_on=True, on_duplicate="fail",
        on_missing="noop", link_ok=True, update_sets=("a", "b")):
    """``changes``: dicts with id, op, key, ok, a, b in key order.

    Returns (outcomes by id, target by key, quarantine, links by parent id).
    """
    target = dict(target or {})
    blocked = set(quarantine or ())
    outcomes, links = {}, {}
    for c in changes:
        key, op = c["key"], c["op"]
        if op not in ("I", "U", "D"):
            outcomes[c["id"]] = "SKIPPED_BADROW"
            continue
        if quarantine_on and key in blocked:
            outcomes[c["id"]] = "SKIPPED_QUARANTINED"
            continue
        row = target.get(key)
        if op == "D":
            if row is not None:
                links.pop(row["id"], None)
                del target[key]
            outcomes[c["id"]] = "DELETED"
        elif op == "I":
            if not c["ok"] or (row is not None and on_duplicate == "fail"):
                outcomes[c["id"]] = "FAILED"
                if quarantine_on:
                    blocked.add(key)
                continue
            if row is None:
                target[key] = {"id": c["id"], "a": c["a"], "b": c["b"]}
            else:
                target[key] = {"id": row["id"], "a": c["a"], "b": c["b"]}
            outcomes[c["id"]] = "INSERTED" if link_ok else "LINK_FAILED"
            if link_ok:
                links[target[key]["id"]] = c["id"]
        else:
            if row is None and on_missing == "noop":
                outcomes[c["id"]] = "UPDATED"
                continue
            if not c["ok"]:
                outcomes[c["id"]] = "FAILED"
                continue
            new = dict(row) if row is not None else {"id": c["id"], "a": None, "b": None}
            for column in update_sets:
                new[column] = c[column]
            target[key] = new
            outcomes[c["id"]] = "UPDATED"
    return outcomes, target, blocked, links
