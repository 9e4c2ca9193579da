"""A minimum-cost flow for small graphs: successive shortest paths with potentials."""

from __future__ import annotations

import heapq
from collections.abc import Iterable


def min_cost_flow(nodes: int, arcs: Iterable[tuple[int, int, int, int]], source: int, sink: int, amount: int) -> list[int]:
    """The flow of each arc (from, to, capacity, cost >= 0) in the cheapest flow of up to amount from source to sink."""
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to: list[int] = []
    left: list[int] = []
    price: list[int] = []
    for a, b, capacity, cost in arcs:
        for u, v, c, p in ((a, b, capacity, cost), (b, a, 0, -cost)):
            graph[u].append(len(to))
            to.append(v)
            left.append(c)
            price.append(p)
    lift, rest = [0] * nodes, amount
    while rest > 0:
        far: list[float] = [float("inf")] * nodes
        via, far[source], heap = [-1] * nodes, 0, [(0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > far[u]:
                continue
            for e in graph[u]:
                if left[e] and (n := d + price[e] + lift[u] - lift[to[e]]) < far[to[e]]:
                    far[to[e]], via[to[e]] = n, e
                    heapq.heappush(heap, (n, to[e]))
        if far[sink] == float("inf"):
            break
        lift = [x + int(f) if f < float("inf") else x for x, f in zip(lift, far, strict=True)]
        step, v = rest, sink
        while v != source:
            step, v = min(step, left[via[v]]), to[via[v] ^ 1]
        v = sink
        while v != source:
            left[via[v]] -= step
            left[via[v] ^ 1] += step
            v = to[via[v] ^ 1]
        rest -= step
    return left[1::2]
