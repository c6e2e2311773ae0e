"""Literal, one-event-at-a-time versions of the stateful rules, as a second opinion on small input."""

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000
TIMER = 5 * MINUTE
ACTIVITY = {"play": "plays", "browse": "browses", "search": "searches"}


def member_snapshots(events):
    """Snapshots of one member's events, (kind, event_type, channel, ts_ms, seq) in the given order."""
    minutes, hours, sent, last = {}, {}, {}, 0
    out = []
    for kind, event_type, channel, now, seq in events:
        if kind == "ACTIVITY":
            cell = minutes.setdefault(now // MINUTE, {})
            cell[event_type] = cell.get(event_type, 0) + 1
            last = max(last, now)
        elif kind == "MESSAGE":
            cell = hours.setdefault(now // HOUR, {})
            cell[event_type] = cell.get(event_type, 0) + 1
            if event_type == "sent" and channel is not None:
                sent[channel] = now
        out.append({"kind": kind, "seq": seq, **snapshot(now, minutes, hours, sent, last)})
    return out


def snapshot(now, minutes, hours, sent, last):
    def over(cells, name, size, length):
        return sum(c.get(name, 0) for b, c in cells.items() if b >= (now - length) // size)

    row = {"snapshot_ts_ms": now, "last_activity_ts_ms": last,
           "last_sent_ts_by_channel": dict(sent),
           "messages_sent_24h": over(hours, "sent", HOUR, DAY),
           "opens_7d": over(hours, "open", HOUR, 7 * DAY),
           "clicks_7d": over(hours, "click", HOUR, 7 * DAY)}
    for event_type, name in ACTIVITY.items():
        row[f"{name}_1h"] = over(minutes, event_type, MINUTE, HOUR)
        row[f"{name}_24h"] = over(minutes, event_type, MINUTE, DAY)
    row["eligible_push"] = now - sent.get("push", 0) >= 6 * HOUR
    row["eligible_email"] = now - sent.get("email", 0) >= DAY
    row["suppression_reasons"] = {
        c: "cooldown_active" for c in ("push", "email") if not row[f"eligible_{c}"]}
    return row


def versions(mutations):
    """Versions of (key, op) in order: previous plus one, starting over after a delete."""
    live, out = {}, []
    for key, op in mutations:
        version = live.get(key, 0) + 1
        live[key] = 0 if op == "delete" else version
        out.append(version)
    return out


def indexed(changes):
    """Index rows after applying (key, op, payload, version) one by one under the version gate."""
    rows = {}
    for key, op, payload, version in changes:
        if version <= rows.get(key, (None, 0, 0))[1]:
            continue
        rows[key] = (payload or "", version, 0) if op == "upsert" else (None, version, 1)
    return rows
