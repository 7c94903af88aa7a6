"""Properties that a correct result has, and small builders for inputs."""


def chat(spec):
    """``"su a"`` -> messages: one letter a message (system, user, assistant, tool), texts numbered."""
    names = {"s": "system", "u": "user", "a": "assistant", "t": "tool"}
    return [(names[c], f"{c}{k}") for k, c in enumerate(spec)]


def assert_greedy(rows, quotas, taken):
    """A row is taken exactly when, among the taken rows before it, none has its key and
    fewer than the quota have its bucket."""
    rows = sorted(rows)
    chosen = [r for r in rows if r[0] in taken]
    assert len(taken) == len(chosen)
    for o, key, bucket in rows:
        before = [r for r in chosen if r[0] < o]
        free = sum(r[2] == bucket for r in before) < quotas.get(bucket, 0)
        assert (o in taken) == (free and key not in {r[1] for r in before}), (o, key, bucket)


def assert_rank(values, value, p):
    """``value`` stands at 0-based place ``floor(n * p)`` (the last place at most) of the sorted values."""
    place = min(len(values) - 1, int(len(values) * p))
    assert sum(v < value for v in values) <= place < sum(v <= value for v in values)
