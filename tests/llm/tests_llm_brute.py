"""Brute force shared by the tests."""


def grouped(rows, near):
    """(id, value, smallest id reachable) of rows (id, value), by comparing all pairs."""
    root = list(range(len(rows)))

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            if near(rows[a][1], rows[b][1]) or rows[a][0] == rows[b][0] and rows[a][1] == rows[b][1]:
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    smallest = {}
    for n, (i, _) in enumerate(rows):
        smallest[top(n)] = min(i, smallest.get(top(n), i))
    return [(i, v, smallest[top(n)]) for n, (i, v) in enumerate(rows)]
