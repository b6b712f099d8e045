"""Quality rules, classifiers and the pipeline."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vatio.llm import decontaminate, mixing, quality_classifier, quality_rules, sharding, simhash_dedup, toxicity
from vatio.llm.common import read

from .conftest import LONG, ODD, PLAIN

SMALL, MID = "/root/testdata/sf0.001", "/root/testdata/sf0.1"


def brute_counts(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


def test_counts_by_brute_force():
    for t in (None, "", " \x0b\n\n", PLAIN, "a b c a b c\na b c a b c\n x\n x", "ß# *$ %& |< > é", "a a a a", LONG[:5000]):
        assert quality_rules.counts_of(t)[:5] == brute_counts(t), t


def test_rules_on_odd_rows(odd, empty):
    got = quality_rules.judge(odd).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ODD)
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality_rules.judge(empty).count() == 0


def test_outliers_go_and_others_stay(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(900):
        text = ". ".join(" ".join(word() for _ in range(12)).capitalize() for _ in range(rng.randrange(6, 40)))
        if i % 10 == 0:
            text = text.replace(" ", "### ")
        rows.append((i, text, "en" if i % 3 else None, "hot" if i % 2 else "other"))
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert all(not r["kept"] for r in got if r["doc_id"] % 10 == 0)
    assert sum(r["kept"] for r in got if r["doc_id"] % 10) >= 0.99 * 810


def test_chi_square():
    assert abs(quality_rules.chi_square_quantile(0.05, 1) - 3.841459) < 1e-5
    assert abs(quality_rules.chi_square_quantile(0.01, 8) - 20.090235) < 1e-5


def test_isotonic_is_the_best_monotone_fit():
    values, labels = quality_classifier.np.array([3., 1, 2, 2, 5, 4]), quality_classifier.np.array([1., 0, 1, 0, 1, 0])
    xs, ys = quality_classifier.isotonic(values, labels)
    assert list(quality_classifier.np.interp([1, 2, 3, 4, 5], xs, ys)) == [0, 0.5, 0.5, 0.5, 1]


@pytest.mark.parametrize("module,label,least", [(quality_classifier, "quality", 0.97), (toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, module, label, least):
    docs, labels = read(spark, MID, "documents"), read(spark, MID, "labels")
    model = module.fit(docs, labels)
    kept_out = labels.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    rows = docs.join(kept_out, "doc_id")
    if module is toxicity:
        scored = rows.select(label, toxicity.toxicity(F.col("text"), model)["score"].alias("score"))
        cut = toxicity.THRESHOLD
    else:
        scored, cut = rows.select(label, quality_classifier.quality_score(F.col("text"), model).alias("score")), 0.3
    got = scored.collect()
    assert all(0 <= r["score"] <= 1 for r in got)
    assert sum((r["score"] >= cut) == bool(r[label]) for r in got) >= least * len(got)
    # The labels of the held-out fold are not seen.
    flipped = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                              1 - F.col(label)).otherwise(F.col(label)))
    if module is quality_classifier:
        assert (module.fit(docs, flipped).weights == model.weights).all()


def test_fit_rows_are_bounded_where_ids_repeat(spark):
    rng = random.Random(9)
    text = lambda: " ".join(rng.choice(["one", "two", "three", "four!", "FIVE", "6"]) for _ in range(20))
    rows = [(i, text()) for i in range(1, 80)]
    hot = next(i for i in range(1, 80) if zlib.crc32(str(i).encode()) % 5)
    marks = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 80)], "doc_id long, quality int, toxic int")
    frame = lambda r: spark.createDataFrame(r, "doc_id long, text string")
    plain = quality_classifier.training_rows(frame(rows), marks, "quality")
    copies = quality_classifier.training_rows(frame(rows + [rows[hot - 1]] * 300), marks, "quality")
    seen = lambda df: sorted(tuple(r) for r in df.collect())
    assert seen(copies) == seen(plain) and plain.count() == sum(bool(zlib.crc32(str(i).encode()) % 5) for i in range(1, 80))
    many = frame(rows + [(hot, text()) for _ in range(600)])
    got = Counter(r["doc_id"] for r in quality_classifier.training_rows(many, marks, "quality", 100).collect())
    assert set(got) == {r["doc_id"] for r in plain.collect()} and 80 <= sum(got.values()) <= 130 and got[hot] > 10
    texts = [(i, -i, 10) for i in range(50)] + [(99, 5, 1000)]
    out = toxicity.beyond_bytes(texts, 205)
    assert len(out) == 31 and (99, 5) in out and toxicity.beyond_bytes(texts, 1500) == []


def test_classifiers_on_odd_rows(spark, odd, empty, labels):
    got = quality_classifier.classify(odd, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ODD)
    assert len({r["score"] for r in got if r["text"] in (None, "", " \t\n")}) == 1
    assert len({r["score"] for r in got if r["text"] == PLAIN}) == 1
    assert quality_classifier.classify(empty, labels).count() == 0
    assert {r["score"] for r in quality_classifier.classify(odd, labels.limit(0)).collect()} == {0.5}
    tagged = toxicity.score_documents(odd, labels).collect()
    assert all(0 <= r["toxicity"]["score"] <= 1 and r["toxicity"]["spans"] == [] for r in tagged)
    assert toxicity.score_documents(empty, labels.limit(0)).count() == 0


def test_toxic_spans(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    rows, marks = [], []
    for i in range(300):
        words = [word() for _ in range(40)]
        if i % 3 == 0:
            words[5] = rng.choice(["Vile!", "vile", "nastyish,", "nastyest"])
            words[20] = "vile"
        rows.append((i, " ".join(words[:15]) + "\n" + " ".join(words[15:])))
        marks.append((i, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity.score_documents(docs, spark.createDataFrame(marks, "doc_id long, toxic int")).collect()
    for r in got:
        assert (r["toxicity"]["score"] >= 0.5) == (r["doc_id"] % 3 == 0)
        found = {r["text"][s["start"]:s["end"]].strip("!,") .lower() for s in r["toxicity"]["spans"]}
        assert found <= {"vile", "nastyish", "nastyest"} and bool(found) == (r["doc_id"] % 3 == 0)


def test_chain_against_enumeration():
    import itertools
    np = toxicity.np
    rng = np.random.default_rng(0)
    e, steps, start = rng.normal(size=(1, 6)), rng.normal(size=(2, 2)), 0.3
    weight = {}
    for tags in itertools.product((0, 1), repeat=6):
        weight[tags] = np.exp(start * tags[0] + sum(e[0, i] * t for i, t in enumerate(tags))
                              + sum(steps[a, b] for a, b in zip(tags, tags[1:])))
    odds, _, _ = toxicity.chain(e, np.array([6]), start, steps)
    for i in range(6):
        p = sum(w for t, w in weight.items() if t[i]) / sum(weight.values())
        assert abs(1 / (1 + np.exp(-odds[0, i])) - p) < 1e-9


def test_pipeline_stage_by_stage(spark):
    """Each stage against its operator's own results, worked out row by row."""
    docs = read(spark, SMALL, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "shard"]

    def kept(name, before):
        after = stages[name](spark, before, SMALL)
        assert after.columns[:len(columns)] == columns
        return spark.createDataFrame(after.collect(), after.schema)

    good = kept("quality", docs)
    model = quality_classifier.fit(docs, read(spark, SMALL, "labels"))
    want = [r["doc_id"] for r in docs.select("doc_id", quality_classifier.quality_score(F.col("text"), model)
                                             .alias("s")).collect() if r["s"] >= 0.3]
    assert sorted(r["doc_id"] for r in good.collect()) == sorted(want)

    single = kept("near_dedup", good)
    groups = simhash_dedup.near_duplicates(good).collect()
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({r["component_id"] for r in groups})

    clean = kept("decontaminate", single)
    leaked = {r["doc_id"] for r in decontaminate.leaks(single, read(spark, SMALL, "benchmark")).collect()}
    assert leaked and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - leaked

    mixed = kept("mix", clean)
    times = Counter({r["doc_id"]: r["times"] for r in mixing.mix_counts(clean).collect() if r["times"]})
    assert Counter(r["doc_id"] for r in mixed.collect()) == times

    sharded = kept("shard", mixed)
    assert Counter((r["doc_id"], r["shard"]) for r in sharded.collect()) == Counter(
        (r["doc_id"], r["shard"]) for r in sharding.assign_shards(mixed).collect())
    whole = corpus_pipeline.run(spark, SMALL)
    assert Counter((r["doc_id"], r["shard"]) for r in whole.collect()) == Counter(
        (r["doc_id"], r["shard"]) for r in sharded.collect())
