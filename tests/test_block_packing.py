"""One slot packed by many tasks: equal to the sequential packer, for any block and tree shape."""

import random

import pytest

from zipledger.operators import block_packing as BP
from zipledger.operators import packing as PK

SCHEMA = "archive_id string, slot int, claim_seq long, declared long, actual long"


def sequential(rows, cap):
    out, state = {}, {}
    for aid, slot, seq, dec, act in sorted(rows, key=lambda r: (r[1], r[2])):
        k, fill = state.get(slot, (0, 0))
        dec, act = max(dec or 0, 0), max(act or 0, 0)
        if k == 0 or fill + dec > cap:
            k, fill = k + 1, 0
        state[slot] = (k, fill + act)
        out[aid] = k
    return out


def packed(spark, rows, cap, **kw):
    got = BP.pack_next_fit_blocks(spark.createDataFrame(rows, SCHEMA), cap, **kw).collect()
    assert len(got) == len(rows)
    return {r.archive_id: r.k for r in got}


@pytest.mark.parametrize("block_rows,fan_in,sizes", [
    (7, 8, (0, 60)),       # blocks shorter than an archive: limits pass through whole subtrees
    (64, 4, (0, 60)),
    (50, 4, (90, 400)),    # nearly every item over the cap or alone
    (16, 6, (0, 1)),       # archives over many blocks, sizes of 0
])
def test_equals_sequential(spark, block_rows, fan_in, sizes):
    rnd = random.Random(block_rows)
    rows = [(f"r{i}", rnd.choice([0, 0, 0, 5]), 1000 + 3 * i - 1500, rnd.randint(*sizes), rnd.randint(*sizes)) for i in range(700)]
    assert packed(spark, rows, 100, block_rows=block_rows, fan_in=fan_in) == sequential(rows, 100)


def test_equal_items_keep_their_phase(spark):
    # chains from different first items never meet: each block has as many outcomes as an archive has items
    rows = [(f"r{i}", 0, i, 10, 10) for i in range(500)]
    assert packed(spark, rows, 70, block_rows=33, fan_in=4) == {f"r{i}": i // 7 + 1 for i in range(500)}


def test_tables_stay_bounded():
    # a table has no more rows than fit an archive, however long the stretch
    import pandas as pd
    rnd = random.Random(1)
    at, tables = 0, []
    for node in range(8):
        sizes = [rnd.randint(1, 20) for _ in range(400)]
        before = [at + sum(sizes[:i]) for i in range(400)]
        at = before[-1] + sizes[-1]
        tables.append(BP._block_table(200)(pd.DataFrame({"slot": 0, "node": node, "_seq": range(400), "_before": before,
                                                         "_reach": [b + s for b, s in zip(before, sizes)]})))
    whole = BP._compose(8)(pd.concat(tables))
    assert max(map(len, tables)) <= 60 and len(whole) <= len(tables[0])


def test_edges(spark):
    rows = [("a", 0, 1, None, 100), ("b", 0, 2, 1, None), ("c", 0, 3, 100, 0), ("d", 0, 4, -5, -5), ("e", 0, 5, 101, 101), ("f", 0, 6, 0, 0)]
    assert packed(spark, rows, 100, block_rows=1, fan_in=2) == sequential(rows, 100)
    assert packed(spark, [], 100) == {}
    assert set(packed(spark, rows, PK.C.UNLIMITED_BYTES).values()) == {1}
    assert packed(spark, rows[:1], 1) == {"a": 1}
    with pytest.raises(Exception, match="without a slot"):
        packed(spark, [("a", None, 1, 1, 1)], 10)
    with pytest.raises(ValueError):
        packed(spark, rows, 10, fan_in=1)
