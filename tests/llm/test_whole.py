"""Whole tables of the given sizes against plain implementations."""

from collections import Counter, defaultdict

import pytest

from tests.llm import cases
from vectorloom.llm import queries

SMALL, LARGE = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def exact_components(texts: dict[int, str | None]) -> tuple[dict[int, int], int]:
    """Components and links at 80 %, over all documents: sets that are alike share one of their rarest shingles."""
    sets = {k: cases.shingles(t, 4) for k, t in texts.items()}
    often = Counter(x for own in sets.values() for x in own)
    alike, parent = defaultdict(list), {k: k for k in sets}
    for k in sorted(sets):
        alike[sets[k]].append(k)
    for own, ids in alike.items():
        if own:
            parent.update(dict.fromkeys(ids, ids[0]))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    seen, links = defaultdict(list), 0
    for own, ids in sorted((x for x in alike.items() if x[0]), key=lambda x: x[1][0]):
        order = sorted(own, key=lambda x: (often[x], x))
        rarest = order[: len(order) - (4 * len(order) + 4) // 5 + 1]
        near = {k for x in rarest for k in seen[x]}
        for k in near:
            other = sets[k]
            if 100 * len(own & other) >= 80 * len(own | other):
                links += 1
                x, y = find(ids[0]), find(k)
                parent[max(x, y)] = min(x, y)
        for x in rarest:
            seen[x].append(ids[0])
    return {k: find(k) for k in sets}, links


def test_near_duplicates_of_ten_thousand_documents_are_all_found(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "text").collect()}
    want, links = exact_components(texts)
    got = {r.doc_id: r.component_id for r in queries.op1_minhash_dedup(spark, LARGE).select("doc_id", "component_id").collect()}
    assert len(texts) == 10_000 and links > 100 and sum(k != c for k, c in want.items()) > 800
    assert got == want


@pytest.mark.parametrize("folder", [SMALL])
def test_packing_comes_near_the_bound(spark, folder):
    rows = queries.op4_packing(spark, folder).select("sequence_id", "length").collect()
    bound = max(-(-sum(r.length for r in rows) // 1024), sum(r.length > 512 for r in rows))
    assert len({r.sequence_id for r in rows}) <= 1.02 * bound
