"""Plain versions to hold the operators against, and awkward rows."""

import re


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def components(sets, percent=80):
    """sets: list of (id, set). Smallest id reachable over links, by id."""
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}


def words_of(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
