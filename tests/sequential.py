"""The stop rules told one step at a time: what the set-wise operators are checked against."""


def fold_runs(steps, min_builds, failure_limit):
    """steps: (outcome, list event) pairs in order -> (reason, good logs)."""
    good = failures = 0
    for outcome, event in steps:
        if event not in (None, "probe", "idle"):
            return event, good
        if outcome == "auth":
            return "denied", good
        if outcome == "ok":
            good, failures = good + 1, 0
            if good == min_builds:
                return "enough", good
        elif outcome in ("gone", "error"):
            failures += 1
            if failures == failure_limit:
                return f"{outcome}_run", good
    return "list_end", good


def fold_jobs(outcomes, min_builds):
    good = 0
    for outcome in outcomes:
        if outcome in ("gone", "auth"):
            return ("gone" if outcome == "gone" else "denied"), good
        good += outcome == "ok"
        if good == min_builds:
            return "enough", good
    return "list_end", good


def quota_reset(events, stored):
    """events: (ts, limited, reset header or None) in order -> reset time (None if never set)."""
    reset = None if stored else 0
    for ts, limited, header in events:
        if header is not None:
            reset = header
        if limited and (stored or reset < ts):
            reset = ts + 60
    return reset


def served_bodies(requests):
    """requests: (key, status, has etag, body) in order -> (status, body, origin)."""
    cache, served = {}, []
    for key, status, tagged, body in requests:
        if status == 304:
            served.append((200, cache[key], "cache") if key in cache else (304, body, "open"))
            continue
        if status == 200 and tagged:
            cache[key] = body
        served.append((status, body, "own"))
    return served


def upsert(rows, updates):
    """rows: key -> dict; updates: (key, given fields, values) in order."""
    table = {key: dict(row) for key, row in rows.items()}
    for key, given, given_values in updates:
        table.setdefault(key, {}).update({f: given_values[f] for f in given})
    return table
