import random

import pytest

from corpusmill.operators import sets


@pytest.mark.parametrize(("rows", "share", "lead"), [(8192, 0.3, 8), (40, 0.6, 4), (40, 0.85, 8)])
def test_no_pair_of_enough_in_common_is_lost(spark, monkeypatch, rows, share, lead):
    monkeypatch.setattr(sets, "ROWS", rows)
    rng = random.Random(3)
    held = [rng.sample(range(30 if i % 2 else 60), rng.randrange(25)) for i in range(300)]
    held += [held[0]] * 100  # more than any list of candidates would hold
    d = spark.createDataFrame([*enumerate(held), (None, held[0])], "id long, t array<long>")
    got = [tuple(r) for r in sets.likely_pairs(d, share, lead).collect()]
    common = {(i, j): len(set(held[i]) & set(held[j])) / max(len(held[i]), len(held[j]), 1) for i in range(400) for j in range(i + 1, 400)}
    assert len(got) == len(set(got)) and {p for p, c in common.items() if c >= share} <= set(got) <= {p for p, c in common.items() if c > 0}
