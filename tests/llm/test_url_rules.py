"""Mined rules look at all tokens of all rows."""

import itertools
import math
import random

from itemflow.llm.url_rules import mined_rules


def by_hand(rows, support, confidence, most, least=5):
    found = {}
    for size in range(1, most + 1):
        for part in itertools.combinations(sorted({t for tokens, _ in rows for t in tokens}), size):
            hit = [bad for tokens, bad in rows if set(part) <= set(tokens)]
            if sum(hit) >= math.ceil(max(support, least / len(rows)) * len(rows)) and sum(hit) / len(hit) >= confidence:
                found[part] = sum(hit) / len(hit)
    beaten = {p for p, c in found.items() if any(found.get(p[:i] + p[i + 1 :], -1) >= c for i in range(len(p)))}
    return {p: round(c, 6) for p, c in found.items() if p not in beaten}


def test_rows_of_many_tokens_are_mined_whole(spark):
    """Of 16 tokens in each row two are blocked together, and seldom by themselves: they used to be cut as the least blocked ones."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        tokens = {f"often{j:02}" for j in range(14) if rng.random() < 0.9} | {f"other{i % 3}"}
        tokens |= {t for t in ("pair1", "pair2") if rng.random() < 0.5}
        bad = {"pair1", "pair2"} <= tokens or (rng.random() < 0.6 and not {"pair1", "pair2"} & tokens)
        rows.append((sorted(tokens), bad))
    got = mined_rules(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), min_support=0.05, min_confidence=0.9, max_tokens=3)
    got = {tuple(r.tokens): round(r.confidence, 6) for r in got.collect()}
    assert got == by_hand(rows, 0.05, 0.9, 3)
    assert got[("pair1", "pair2")] == 1.0


def test_support_is_the_share_of_blocked_rows_that_hold_the_rule(spark):
    rows = [(["a", "b"], True)] * 6 + [(["a"], False)] * 3 + [(["b", "c"], None)] * 1 + [([], True)] * 5 + [(None, True)]
    got = mined_rules(spark.createDataFrame(rows, "tokens array<string>, blocked boolean"), min_confidence=0.8)
    assert sorted((r.tokens, round(r.confidence, 4), r.support) for r in got.collect()) == [(["a", "b"], 1.0, 0.6), (["b"], 0.8571, 0.6)]
