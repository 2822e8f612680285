"""Connected components against union-find."""

import numpy as np
import pytest

from tidemill.llm.components import components


def union_find(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            p, q = find(a), find(b)
            parent[max(p, q)] = min(p, q)
    return {x: find(x) for x in parent}


_rng = np.random.default_rng(5)
_order = [int(x) for x in _rng.permutation(40)]


@pytest.mark.parametrize("links", [
    [],
    [(4, 4)],
    [(2, 1), (1, 2), (3, 1), (1, 1)],
    [(3, 1), (3, 2)],
    list(zip(_order, _order[1:])),
    [(int(a), int(b)) for a, b in _rng.integers(0, 60, (45, 2))],
], ids=["empty", "own", "star", "two_smaller", "chain", "random"])
def test_components_equal_union_find(spark, links):
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == union_find(links)
