"""Near copies: sketches keep sets that can't link out of the exchange, and lose no link."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from unisono.llm import jaccard_join as J


@pytest.mark.parametrize("most", [0, 500_000])
def test_sketches_leave_out_pairs_and_no_link(spark, monkeypatch, most):
    monkeypatch.setattr(J, "BROADCAST_IDS", most)
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    sets = []
    for n in (1, 9, 10, 45, 300, 2000, 6000):
        base = np.unique(draw(n))
        sets.append(base)
        for share in (0.0, 0.05, 0.1, 0.11, 0.112, 0.2):  # of 2n / 1.8 tokens that differ, 0.111 is the limit at 80 %
            lose = round(share * len(base))
            sets.append(np.unique(np.concatenate([base[lose:], draw(lose)])))
        sets.append(np.unique(draw(n)))
    pairs = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))]
    table = spark.createDataFrame([(i, len(s), J.sketch(s).tolist(), s.tobytes()) for i, s in enumerate(sets)], "doc_id long, n long, bits array<long>, tokens binary")
    given = spark.createDataFrame(pairs, "a long, b long")
    want = {(a, b) for a, b in pairs if J.linked(sets[a], sets[b], 80)}
    near = {tuple(r) for r in J._near(given, table, 80).collect()}
    assert want <= near and len(near) < len(pairs) / 4
    assert {tuple(r) for r in J._linked(given, table, 80).collect()} == want
    assert len(want) > 20


def test_exchanges_go_when_a_step_ends(spark):
    docs = spark.createDataFrame([(i, "a b c d e f g h " * 3 + str(i // 2)) for i in range(20)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in J.jaccard_components(docs.withColumn("x", F.lit(1)), 3, 90).collect()}
    assert all(got[i] <= i for i in got) and got[1] == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "true"
