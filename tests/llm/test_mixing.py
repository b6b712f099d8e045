from collections import Counter, defaultdict

from vatio.llm import mixing

from .conftest import ODD


def brute_targets(sizes, weights=mixing.WEIGHTS, total=mixing.TOTAL):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, capped = total * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rate = (budget - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if weight[s] * rate > 2 * sizes[s]}
        if not more:
            return {s: 2.0 * sizes[s] if s in capped else weight[s] * rate for s in order}
        capped |= more


def check(rows):
    """Targets by brute force; totals near the targets; times within two reads."""
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["times"]
    targets, largest = brute_targets(sizes), max((r["size"] for r in rows), default=0)
    for r in rows:
        assert abs(r["target"] - targets[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["times"] <= 2 and (r["size"] > 0 or r["times"] == 0)
    for s, t in targets.items():
        assert abs(taken[s] - t) <= 2 * largest
    assert sum(taken.values()) <= sum(targets.values()) + 1e-6
    return taken


def test_mix_of_sources(spark):
    rows = [(i, "w " * (1 + i * 7919 % 40), f"s{i * i % 5}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_counts(docs).collect()
    check(got)
    again = mixing.mix_counts(docs.repartition(7)).collect()
    assert {(r["doc_id"], r["times"]) for r in got} == {(r["doc_id"], r["times"]) for r in again}


def test_odd_rows(odd, empty):
    got = mixing.mix_counts(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ODD)
    check(got)
    mixed = mixing.mix(odd)
    assert mixed.count() == sum(r["times"] for r in got)
    assert mixing.mix_counts(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_equal_rows_straddling_a_cut(spark):
    rows = [(7, "one two three", "a")] * 90 + [(i, "x y", "b") for i in range(100, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_counts(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, *_ in rows)
    taken = check(got)
    assert taken["a"] == 3 * sum(r["times"] for r in got if r["doc_id"] == 7)
    assert mixing.mix(docs).filter("doc_id = 7").count() == taken["a"] // 3
