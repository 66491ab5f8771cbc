"""Plain forms of what the operators compute, for small inputs."""


def union_find(nodes, pairs):
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


def repeated_run_lines(documents, min_chars):
    """(document, line) of all lines within a run that stands at an earlier place too."""
    first, gone = {}, set()
    for number, lines in enumerate(documents):
        for start in range(len(lines)):
            for end in range(start + 1, len(lines) + 1):
                run = tuple(lines[start:end])
                if sum(map(len, run)) >= min_chars:
                    if first.setdefault(run, (number, start)) != (number, start):
                        gone.update((number, at) for at in range(start, end))
    return gone


def raked(cells, margins, targets, sweeps=2000):
    """Iterative proportional fitting over a dict of cell to tokens."""
    weights = {cell: float(tokens) for cell, tokens in cells.items()}
    total = sum(weights.values())
    for _ in range(sweeps):
        for at, margin in enumerate(margins):
            held = {}
            for cell, weight in weights.items():
                held[cell[at]] = held.get(cell[at], 0.0) + weight
            weights = {cell: weight * targets[margin][cell[at]] * total / held[cell[at]] if weight else 0.0 for cell, weight in weights.items()}
    return weights


def bm25(texts, queries, k, k1=1.2, b=0.75):
    """Best k (score to six digits, id) for each query id, over all documents but itself."""
    import math
    import re
    from collections import Counter

    words = {key: Counter(re.findall(r"[^\W_]+", (text or "").lower())) for key, text in texts.items()}
    mean = sum(sum(own.values()) for own in words.values()) / len(words)
    frequency = Counter(word for own in words.values() for word in own)
    found = {}
    for query in queries:
        scores = []
        for key, own in words.items():
            shared = sorted(words[query].keys() & own.keys())
            if key != query and shared:
                size = k1 * (1 - b + b * sum(own.values()) / mean)
                score = sum(math.log1p((len(words) - frequency[w] + 0.5) / (frequency[w] + 0.5)) * own[w] * (k1 + 1) / (own[w] + size) for w in shared)
                scores.append((-round(score, 6), key))
        found[query] = [(key, -score) for score, key in sorted(scores)[:k]]
    return found
