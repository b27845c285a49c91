"""Rounds of connected components: right on any links, and with plans that stay small."""

import random

import pytest

from quayside.llm import graph, ngram_join
from quayside.sources.tables import stored
from tests.llm.helpers import documents, table


@pytest.fixture
def reads(monkeypatch):
    """How many tables each plan reads that ``components`` and the join of n-grams store."""
    found = []

    def counted(df, name):
        found.append((df._jdf.queryExecution().optimizedPlan().collectLeaves().size(), name))
        return stored(df, name)

    for module in (graph, ngram_join):
        monkeypatch.setattr(module, "stored", counted)
    return found


def brute(links):
    root = {}
    for a, b in links:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)
    for _ in range(len(root)):
        before = dict(root)
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root
    return root


def test_a_round_reads_its_links_four_times(spark, reads):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(30)]
    hub = [(1000, i) for i in range(1001, 1040)] + [(2000, i) for i in range(1960, 2000)]
    loose = [(rng.randrange(3000, 3080), rng.randrange(3000, 3080)) for _ in range(60)]
    links = [*chain, *hub, *loose, (7, 7), (5000, 5000), (4, 3), (-5, 6000), (-(1 << 63), (1 << 63) - 1)]
    got = [tuple(r) for r in graph.components(table(spark, links, "a long, b long")).collect()]
    assert len(got) == len(dict(got)) and dict(got) == brute(links)
    assert max(reads)[0] <= 4, reads


def test_plans_of_the_join_do_not_hold_the_steps_before(spark, reads):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[:30] + [f"x{i // 3}"]) for i in range(9)] + [" ".join(words[10 + i:]) for i in range(4)]
    assert ngram_join.keep_one(documents(spark, texts), n=5, percent=80).count() < len(texts)
    assert max(reads)[0] <= 5, sorted(reads)
