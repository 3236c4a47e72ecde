"""A sync of one root, row by row in plain Python: what the joins must agree with."""

from __future__ import annotations

from ebbflow.operators.push import Policy


def sync_rows(local, remote, policy, push_time, now, watermarks=None, full=False):
    """Tables are ``{uid: row}``; returns both tables, the log, the watermarks and the uids in error."""
    local = {u: dict(r) for u, r in local.items()}
    remote = {u: dict(r) for u, r in remote.items()}
    log, errors = {}, set()

    for uid in sorted(local):
        row = local[uid]
        if not row["is_dirty"]:
            continue
        theirs = remote.get(uid)
        if not row["created_remotely"]:
            if row["status"] == 3:
                del local[uid]
                log.setdefault(uid, "deleted")
                continue
            remote[uid] = {"entity": row["entity"], "status": row["status"], "name": row["name"], "updated_at": push_time}
            row.update(is_dirty=False, created_remotely=True, last_modified=push_time)
            log.setdefault(uid, "updated")
            continue
        if theirs is None:
            errors.add(uid)
            continue
        conflict = row["last_modified"] is not None and row["last_modified"] != theirs["updated_at"]
        if conflict and policy is Policy.SERVER_WINS:
            row.update(name=theirs["name"], status=theirs["status"], is_dirty=False, last_modified=theirs["updated_at"])
            log.setdefault(uid, "updated")
            continue
        theirs.update(name=row["name"], status=row["status"], updated_at=push_time)
        if conflict and row["status"] == 3:
            del local[uid]
            log.setdefault(uid, "deleted")
        else:
            row.update(is_dirty=False, last_modified=push_time)
            log.setdefault(uid, "updated")

    marks = dict(watermarks or {})
    for uid, theirs in sorted(remote.items(), key=lambda item: item[1]["updated_at"]):
        entity, instant = theirs["entity"], theirs["updated_at"]
        bound = None if full else (watermarks or {}).get(entity)
        if instant >= now or (bound is not None and instant <= bound) or uid in errors:
            continue
        marks[entity] = max(marks.get(entity, instant), instant)
        row = local.get(uid)
        if row is not None and row["last_modified"] == instant:
            continue
        if row is None:
            if theirs["status"] != 3:
                local[uid] = {
                    "entity": entity,
                    "status": theirs["status"],
                    "name": theirs["name"],
                    "last_modified": instant,
                    "is_dirty": False,
                    "created_remotely": True,
                }
                log.setdefault(uid, "inserted")
        elif theirs["status"] == 3:
            del local[uid]
            log.setdefault(uid, "deleted")
        else:
            row.update(name=theirs["name"], status=theirs["status"], last_modified=instant)
            log.setdefault(uid, "updated")
    return local, remote, log, marks, errors
