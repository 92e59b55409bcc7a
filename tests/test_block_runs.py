"""Many blocks pass through one task and stay apart."""

from __future__ import annotations

import random

import pytest
from cellscape.operators import components


def reachable(nodes, shape):
    """The smallest id that each node reaches, by a plain search."""
    def around(r, c):
        if shape == "square":
            return [(r, c - 1), (r, c + 1), (r - 1, c), (r + 1, c)]
        s = r % 2
        return [(r, c - 1), (r, c + 1), (r - 1, c + s - 1), (r - 1, c + s), (r + 1, c + s - 1), (r + 1, c + s)]

    out, left = {}, set(nodes)
    while left:
        todo, part = [left.pop()], []
        while todo:
            g, r, c, v = todo.pop()
            part.append((g, r, c, v))
            for n in [(g, *p, v) for p in around(r, c)]:
                if n in left:
                    left.remove(n)
                    todo.append(n)
        low = min((r << 20) + c for _, r, c, _ in part)
        out |= {p: low for p in part}
    return out


@pytest.mark.parametrize("shape", ["hexagon", "square"])
def test_blocks_of_a_task_stay_apart_and_no_task_starts_per_block(spark, shape):
    draw = random.Random(5)
    nodes = {(g, r, c): draw.randrange(2) for g in range(40) for r, c in ((draw.randrange(60, 75), draw.randrange(58, 70)) for _ in range(110))}
    rows = [(None if g == 39 else g, r, c, v) for (g, r, c), v in nodes.items()]
    df = spark.createDataFrame(rows, "city long, row long, col long, v int")
    blocks = components.label_blocks(df, ["city"], shape, "label", "v")
    assert "FlatMapGroupsInArrow" not in blocks._jdf.queryExecution().toString()
    want = reachable({(39 if g is None else g, r, c, v) for g, r, c, v in rows}, shape)
    whole = components.connected_components(df.where("city is not null"), ["city"], shape, "label", "v").collect()
    assert {(x["city"], x["row"], x["col"], x["v"]): x["label"] for x in whole} == {k: v for k, v in want.items() if k[0] != 39}
    inner = {(r["city"], r["block_row"], r["block_col"], r["label"]) for r in blocks.collect()}
    assert blocks.count() == len(rows) and len({k[:3] for k in inner}) > 120
