"""SimHash groups, line classes and benchmark leaks against brute force."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from vatio.llm import decontaminate, line_dedup, simhash_dedup

from .conftest import LONG, ODD, PLAIN


def brute_print(text, width=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    hs = [xxhash.xxh64(" ".join(words[i:i + width]).encode(), 42).intdigest()
          for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(nodes, linked):
    part = {n: n for n in nodes}

    def find(x):
        while part[x] != x:
            x = part[x]
        return x
    nodes = list(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if linked(a, b):
                part[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def test_fingerprints():
    for t in (None, "", "one", "one two", PLAIN, LONG, "É ß\x0bTab joined x", " A  b\tC d "):
        assert simhash_dedup.fingerprint_of(t) == brute_print(t)


def test_groups_of_odd_rows(odd, empty):
    got = simhash_dedup.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    prints = {(r["doc_id"], r["fingerprint"]) for r in got}
    assert prints == {(i, f"{brute_print(t):016x}") for i, t, *_ in ODD}
    roots = components({brute_print(t) for _, t, *_ in ODD}, lambda a, b: (a ^ b).bit_count() <= 2)
    for r in got:
        mine = [i for i, t, *_ in ODD if i is not None and roots[brute_print(t)] == roots[int(r["fingerprint"], 16)]]
        assert r["component_id"] == min(mine, default=None)
    assert simhash_dedup.near_duplicates(empty).count() == 0
    kept = simhash_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted({r["component_id"] for r in got})
    assert simhash_dedup.keep_one(empty).count() == 0


def test_links_with_small_and_crowded_trees(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(150)}
    for v in list(values)[:8]:  # chains and balls around some of them
        for _ in range(25):
            v ^= 1 << rng.randrange(64)
            values.add(v ^ (1 << rng.randrange(64)) if rng.random() < 0.5 else v)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v, i) for i, v in enumerate(signed)], "fp long, doc_id long")
    roots = components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    want = Counter(Counter(roots.values()).values())
    for limit in (3, 512):  # 3: nearly all shards are dealt anew
        got = simhash_dedup.components(fps, 2, limit).collect()
        assert len(got) == len(values)
        assert Counter(Counter(r["component_id"] for r in got).values()) == want


def brute_lines(rows, t=0.8):
    records, seen = {}, []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for n, line in enumerate((text or "").split("\n")):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            if words:
                seen.append((i, n, line))
                records.setdefault(line, ((i, n), words))
    first = {name: words for name, words in records.values()}
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    match = lambda a, b: len(first[a] & first[b]) >= t * len(first[a] | first[b]) - 1e-9
    roots = components(first, match)
    classes = {n: min((m for m in first if roots[m] == roots[n]), key=order) for n in first}
    later = {n for n in first if any(order(m) < order(n) and match(m, n) for m in first)}
    out, used = [], set()
    for i, n, line in seen:
        name = records[line][0]
        out.append((i, n, *classes[name], (i, n) != name or name in later or (i, n) in used))
        used.add((i, n))
    return Counter(out)


def lines_fixture():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(1, 25))]
        text = [" ".join(base)]
        for _ in range(rng.randrange(3)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            text.append(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
        rows.append((i, "\n".join([*text, "", "a shared line of common words"])))
    hub = [f"h{i}" for i in range(30)]
    for i in range(60):  # one text in sixty variants
        copy = list(hub)
        copy[i % 30] = f"v{i}"
        rows.append((100 + i, " ".join(copy)))
    return rows + [(200, None), (201, " \n\t"), (5, rows[5][1]), (None, "a shared line of common words")]


def test_line_classes_against_brute_force(spark, empty):
    rows = lines_fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    for short in (2, 16):  # 2: most lists go through the second comparison
        got = Counter((r["doc_id"], r["line_no"], r["class_doc_id"], r["class_line_no"], r["removed"])
                      for r in line_dedup.line_classes(docs, short_list=short).collect())
        assert got == want
    assert line_dedup.line_classes(empty).count() == 0


def brute_link_counts(rows, t=0.8):
    first = {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        for line in (text or "").split("\n"):
            words = frozenset(w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w)
            if words:
                first.setdefault(line, words)
    sets = list(first.values())
    counts = [sum(len(a & b) >= t * len(a | b) - 1e-9 for b in sets[:i]) for i, a in enumerate(sets)]
    return dict(zip(first, counts))


def test_line_links_are_all_counted(spark):
    rng = random.Random(8)
    rows = lines_fixture()
    wide = [f"x{i}" for i in range(20)]
    for i in range(80):  # matches at up to four changed words: some pairs near the limit
        copy = list(wide)
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(20)] = f"y{rng.randrange(30)}"
        rows.append((300 + i, " ".join(copy)))
    want = brute_link_counts(rows)
    assert max(want.values()) >= 59
    lines = {}
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            lines[i, n] = line
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for short in (2, 16):
        got = line_dedup.line_classes(docs, short_list=short).collect()
        assert [r for r in got if r["n_links"] != want[lines[r["doc_id"], r["line_no"]]]] == []


def test_split_lists_lose_no_link(spark):
    rows = lines_fixture()
    want, counts = brute_lines(rows), brute_link_counts(rows)
    lines = {(i, n): line for i, text in rows for n, line in enumerate((text or "").split("\n"))}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    # Lists of words from eight occurrences are split; the hub's ball fills blocks of its own.
    got = line_dedup.line_classes(docs, short_list=2, hot=8, block=8).collect()
    assert Counter((r["doc_id"], r["line_no"], r["class_doc_id"], r["class_line_no"], r["removed"]) for r in got) == want
    assert [r for r in got if r["n_links"] != counts[lines[r["doc_id"], r["line_no"]]]] == []


def test_copies_of_an_absent_text_are_one_ball(spark):
    """Copies that are no close copies of each other, only of the text they were made from:
    their links are counted, not listed."""
    words = [f"t{i}" for i in range(24)]
    rows = [(i, " ".join([*words[:i % 24], f"own{i}", *words[i % 24 + 1:]])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    prepared = line_dedup._prepared(docs)
    firsts = line_dedup._named_lines(prepared).select("k", F.col("doc").alias("f_doc"), F.col("part").alias("f_part"))
    found, balls = line_dedup.links(prepared, firsts, short_list=8)
    assert balls.groupBy("ball").count().agg(F.max("count")).first()[0] == 60
    assert found.count() < 10 * 60       # of 1,770 links
    got = line_dedup.line_classes(docs, short_list=8).collect()
    assert sorted((r["doc_id"], r["n_links"], r["class_doc_id"]) for r in got) == [(i, i, 0) for i in range(60)]


def test_links_of_loose_copies_are_counted_in_their_cells(spark):
    """Copies of a text that are too far from it for a ball: most of their pairs match, and
    what is listed still grows as the lines do, in long lists as in short ones."""
    rng = random.Random(11)
    words, rows = [f"t{i}" for i in range(40)], []
    for i in range(150):
        copy = list(words)
        for j in rng.sample(range(40), rng.choice((1, 2, 3))):
            copy[j] = f"own{i}_{j}"
        rows.append((i, " ".join(copy)))
    rows += [(1000 + i, text + "\n" + rows[i + 1][1]) for i, (_, text) in enumerate(rows[:20])]
    want, counts = brute_lines(rows), brute_link_counts(rows)
    lines = {(i, n): line for i, text in rows for n, line in enumerate(text.split("\n"))}
    assert sum(counts.values()) > 5000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    prepared = line_dedup._prepared(docs)
    firsts = line_dedup._named_lines(prepared).groupBy("k").agg(F.min(F.struct("doc", "part")).alias("f")).select(
        "k", F.col("f.doc").alias("f_doc"), F.col("f.part").alias("f_part"))
    for short, block in ((512, 2048), (8, 32)):  # dense short lists, cells of two blocks
        found, _ = line_dedup.links(prepared, firsts, short_list=short, block=block)
        assert found.filter("not inside").count() < 8 * 150
        got = line_dedup.line_classes(docs, short_list=short, block=block).collect()
        assert Counter((r["doc_id"], r["line_no"], r["class_doc_id"], r["class_line_no"], r["removed"]) for r in got) == want
        assert [r for r in got if r["n_links"] != counts[lines[r["doc_id"], r["line_no"]]]] == []


def test_documents_are_read_six_times(spark):
    """Twice-used ids, places, occurrences, postings, sets of the pairs and heads, sets of the cells;
    places and sets are written and serve all later steps."""
    words = [f"t{i}" for i in range(24)]
    rows = [(i, " ".join([*words[:i % 24], f"own{i}", *words[i % 24 + 1:]])) for i in range(60)]
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b
    docs = spark.createDataFrame(rows, "doc_id long, text string").mapInPandas(counted, "doc_id long, text string")
    assert line_dedup.line_classes(docs, short_list=8).count() == len(rows)
    assert read.value <= 6 * len(rows)


def test_words_of_texts_with_blanks_at_the_ends():
    row, word, h = line_dedup._words_of(pa.array([" b a\t", "", "a\x0bß b ", " ", "ß a a"]))
    names = {xxhash.xxh64_intdigest(w): w for w in ("a", "b", "ß")}
    assert [(int(r), names[int(h[w])]) for r, w in zip(row, word)] == [
        (0, "b"), (0, "a"), (2, "a"), (2, "ß"), (2, "b"), (4, "ß"), (4, "a"), (4, "a")]
    assert [len(x) for x in line_dedup._words_of(pa.array(["x", ""]).slice(2))] == [0, 0, 0]


def test_lines_of_odd_rows(odd):
    got = line_dedup.line_classes(odd)
    want = brute_lines([(i, t) for i, t, *_ in ODD])
    assert Counter((r["doc_id"], r["line_no"], r["class_doc_id"], r["class_line_no"], r["removed"])
                   for r in got.collect()) == want
    cut = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeats(odd.filter("doc_id in (8, 10, 11)")).collect()}
    assert cut == {8: "ein ß und é\nund mehr\n\n", 10: "a b", 11: PLAIN}


def brute_leaks(docs, items, t=0.8):
    words = lambda x: re.findall(r"[^\W_]+", (x or "").lower())
    out = set()
    for d, text in set(docs):
        w = words(text)
        for item, body in items:
            v = words(body)
            if not v or not w:
                continue
            k, n = min(5, len(v)), len(v)
            bag = lambda x: Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))  # noqa: E731, B023
            own, best = bag(v), None
            for s in range(max(0, len(w) - n) + 1):
                other = bag(w[s:s + n])
                total = sum((own | other).values())
                sim = sum((own & other).values()) / total if total else 0
                if sim >= t and (best is None or sim > best[0]):
                    best = (sim, s, len(w[s:s + n]))
            if best:
                out.add((d, item, round(best[0], 9), *best[1:]))
    return out


def test_leaks_against_brute_force(spark, odd, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau " \
           "upsilon phi chi psi omega one two three four five six seven eight nine ten eleven twelve"
    words = item.split()
    edited = " ".join(words[:2] + ["changed"] + words[3:])
    half = " ".join(words[:18])
    repeated = "go stop " * 12
    items = [(1, item), (2, "Short Item"), (3, repeated), (4, None), (5, " - "), (1, item), (6, PLAIN)]
    docs = [(1, f"before {item.upper()}, after!"), (2, f"x y {edited} z"), (3, half), (4, None), (5, "a short item here"),
            (6, "go stop " * 40), (7, " ".join(words[1:])), (8, PLAIN + " end"), (8, PLAIN + " end"), (9, LONG + " " + item)]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], round(r["similarity"], 9), r["window_start"], r["window_words"])
           for r in decontaminate.leaks(docs_df, items_df).collect()}
    want = brute_leaks(docs, {i for i in items if i[1] is not None})
    assert got == want and {d for d, *_ in got} >= {1, 2, 5, 6, 8, 9} and not {d for d, *_ in got} & {3, 4}
    kept = decontaminate.remove_leaks(odd, items_df)
    assert kept.columns == odd.columns
    gone = {d for d, *_ in brute_leaks([(i, t) for i, t, *_ in ODD], {i for i in items if i[1] is not None})}
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, t, *_ in ODD if (i not in gone or i is None)
                                                                  and t != PLAIN)
    assert decontaminate.leaks(empty, items_df).count() == 0
    assert decontaminate.remove_leaks(docs_df, items_df.limit(0)).count() == len(docs)


def test_leaks_of_null_and_repeated_item_ids(spark):
    words = [f"w{i}" for i in range(120)]
    one, two, three = " ".join(words[:30]), " ".join(words[40:70]), " ".join(words[:45])
    items = [(None, " ".join(words[80:110])), (1, one), (1, two), (2, one), (2, three)]
    docs = [(1, "x " + one), (2, "x " + two + " y"), (3, " ".join(words[78:112])), (4, "a b " + three),
            (5, " ".join(words[:20] + words[40:50]))]
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    best = {}
    for d, i, *r in brute_leaks(docs, items):
        best[d, i] = max(best.get((d, i), (0,)), (r[0], -r[1], r[2]))
    got = {(r["doc_id"], r["item_id"]): (round(r["similarity"], 9), -r["window_start"], r["window_words"])
           for r in decontaminate.leaks(docs_df, items_df).collect()}
    assert got == best and set(got) >= {(1, 1), (1, 2), (2, 1), (3, None), (4, 1), (4, 2)} and got[4, 2][0] == 1
    assert [r["doc_id"] for r in decontaminate.remove_leaks(docs_df, items_df).collect()] == [5]


def test_blocks_guarantee_the_radius(spark):
    rng = random.Random(1)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(decontaminate.RADIUS + 1)):
            b ^= 1 << bit
        pairs.append(tuple(x - 2**64 if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    blocks = lambda c: df.withColumn("id", F.monotonically_increasing_id()).withColumn(
        "x", decontaminate._blocks(c, decontaminate.RADIUS)).select("id", "x.no", "x.value")
    met = blocks("a").join(blocks("b"), ["id", "no", "value"]).select("id").distinct().count()
    assert met == len(pairs) and math.isclose(decontaminate.MIN_SIMILARITY, 0.8)
