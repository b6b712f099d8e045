"""Token counts, secrets and shards: results of one document at a time."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from vatio.llm import queries, secret_scan, sharding, token_counts

from .conftest import ODD, PLAIN

SMALL = "/root/testdata/sf0.001"


def test_tokens_add_up_and_follow_the_rule(spark, odd, empty):
    enc = secret_scan.encoding(secret_scan.read_vocabulary())
    got = token_counts.section_counts(odd).collect()
    assert Counter(r["doc_id"] for r in got if r["section"] == 0) == Counter(r[0] for r in ODD)
    for r in got:
        text = next(t for i, t, *_ in ODD if i == r["doc_id"] and len(enc.encode_ordinary(t or "")) == r["doc_tokens"])
        assert 0 <= r["start"] <= r["end"] <= len(text or "")
    totals = Counter()
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] != 5:
            totals[r["doc_id"]] += r["tokens"]
    for i, t, *_ in ODD:
        if i is not None and i != 5:
            assert totals[i] == len(enc.encode_ordinary(t or ""))
    assert token_counts.section_counts(empty).count() == 0


def test_allocation_against_every_character():
    enc = secret_scan.encoding(secret_scan.read_vocabulary())
    lengths = token_counts.np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)])
    for text in ("ab\n\n\ncd  ß→\n é\n\n \n", "\n\n", "x", "", "日本\n語 text\n\n\nmore"):
        sections, tokens = token_counts.lines(text), enc.encode_ordinary(text)
        # Character offsets, the slow way: of each token's bytes.
        of_byte = [i for i, c in enumerate(text) for _ in c.encode()]
        spans, at = [], 0
        for t in tokens:
            n = len(enc.decode_single_token_bytes(t))
            spans.append((of_byte[at], of_byte[at + n - 1] + 1))
            at += n
        starts, ends = token_counts.token_spans(text, tokens, lengths)
        assert list(zip(starts.tolist(), ends.tolist())) == spans
        for rule in token_counts.RULES:
            want = [0.0] * len(sections)
            for a, b in spans:
                chars = [next(k for k, (s, e) in enumerate(sections) if s <= c < e) for c in range(a, b)]
                if rule == "first":
                    want[chars[0]] += 1
                elif rule == "last":
                    want[chars[-1]] += 1
                elif rule == "most":
                    want[min(chars, key=lambda k: (-chars.count(k), k))] += 1
                else:
                    for k in chars:
                        want[k] += 1 / len(chars)
            got, _ = token_counts.allocate(starts, ends, sections, rule)
            assert [round(x, 9) for x in got] == [round(x, 9) for x in want], (text, rule)


KEYWORDS = re.compile(r"(?i:password|passwd|secret|token|api_?key)")
VALUE = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_.=-")


def brute_secrets(text):
    """The fixed patterns by hand, character by character."""
    spans, at = [], 0
    while m := KEYWORDS.search(text, at):
        i, quote = m.end(), "\"'"
        ok = m.group().isascii()
        i += i < len(text) and text[i] in quote
        while i < len(text) and text[i] == " ":
            i += 1
        ok = ok and i < len(text) and text[i] in ":="
        i += 1
        while i < len(text) and text[i] == " ":
            i += 1
        i += i < len(text) and text[i] in quote
        j = i
        while j < len(text) and text[j] in VALUE:
            j += 1
        if ok and j > i:
            if j - i >= 6:
                spans.append((m.start(), j, "assign"))
            at = j
        else:
            at = m.start() + 1
    for kind, first, chars, least in (("access", "AKIA", set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), 20),
                                      ("hex", "", set("0123456789abcdef"), 24)):
        i = 0
        while i < len(text):
            j = i + len(first) if text.startswith(first, i) else i
            while (first == "" or j > i) and j < len(text) and text[j] in chars:
                j += 1
            if j - i >= least:
                spans.append((i, j, kind))
            i = max(j, i + 1)
    return sorted(spans, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


def test_secrets_against_brute_force(spark, odd, empty):
    texts = ["password = 'abc123' token:short secret=longer", "password=token : abcdef", "API_KEY==xyz", "apikey: ",
             "AKIA" + "A1" * 8, "xAKIAAKIA" + "B" * 16, "AKIA123", "é" * 5 + "a" * 23 + " " + "0f" * 12,
             "TOKEN = zzzzzz secret: \"qqqqqq\"", "", PLAIN, "passwd\t:abcdefg", "secret  =  = abcdef", "ſecret=abcdefg"]
    for t in texts:
        assert secret_scan.base_spans(t) == brute_secrets(t), t
    secret = "a key mK8vQz3xR7tLp2WnJ5yBc9Hd4F and 123e4567-e89b-12d3-a456-426614174000 and snake_case_identifier_names"
    df = spark.createDataFrame([(1, secret), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r["secrets"] for r in secret_scan.find_secrets(df).collect()}
    assert [(s["kind"], secret[s["start"]:s["end"]]) for s in found[1]] == [("random", "mK8vQz3xR7tLp2WnJ5yBc9Hd4F")]
    assert found[2] == []
    assert secret_scan.find_secrets(odd).count() == len(ODD) and secret_scan.find_secrets(empty).count() == 0


def test_letters_alone_can_be_secrets():
    encode = secret_scan.encoding(secret_scan.read_vocabulary()).encode_ordinary
    for run in ("qzxkvjwpqlmzxnvbq", "XKQJZVWPLMNBTRQSHG", "Xqzkvjwpqlmzxnvbq", "abcdqwfp-zxcvplmk-qjwhgnbt"):
        assert secret_scan.random_spans(f"a {run} b", [], encode) == [(2, 2 + len(run), "random")], run
    rng = random.Random(6)
    for letters in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"):
        runs = ["".join(rng.choice(letters) for _ in range(rng.randrange(16, 33))) for _ in range(300)]
        assert sum(bool(secret_scan.random_spans(r, [], encode)) for r in runs) >= 0.95 * len(runs)
    for name in ("snake_case_identifier_names", "src/main/java/example/Handler", "MAX_RETRY_COUNT_2024", "use-the-key-for-the-job",
                 "internationalization", "2024-01-31/10_20_30"):
        assert secret_scan.random_spans(name, [], encode) == [], name


def test_secret_query_digest(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in queries.op3_secret_scan(spark, SMALL).collect()}
    for d in docs:
        spans = brute_secrets(d["text"] or "")
        r, n = got[d["doc_id"]], Counter(k for *_, k in spans)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (n["assign"], n["access"], n["hex"])
        text = ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def brute_shard(key, weights):
    draws = [-math.log((int(hashlib.md5(f"{key}:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52) / w
             for i, w in enumerate(weights)]
    return draws.index(min(draws))


def test_shards_against_brute_force(spark, odd, empty):
    weights = (1.0, 2.0, 0.5)
    got = sharding.assign_shards(odd, "doc_id", weights, "shard", "grown").collect()
    assert len(got) == len(ODD)
    for r in got:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["shard"] == brute_shard(key, weights)
        assert r["grown"] == brute_shard(key, (*weights, 1.0)) and r["grown"] in (r["shard"], 3)
    assert sharding.assign_shards(empty).count() == 0
    ids = spark.range(20_000).select(F.col("id").alias("doc_id"))
    share = {r["shard"]: r["count"] for r in sharding.assign_shards(ids, weights=weights).groupBy("shard").count().collect()}
    assert all(abs(share[i] / 20_000 - w / 3.5) < 0.02 for i, w in enumerate(weights))


def test_slots_are_gapless_with_repeated_rows(spark, tmp_path):
    rows = [(i % 40, "same") for i in range(400)] + [(None, None)] * 50
    path = str(tmp_path / "sf")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    got = queries.op6_rendezvous_shards(spark, path).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert {(r["size"], r["text_crc32"]) for r in got} == {(5, zlib.crc32(b"same")), (1, 0)}


def test_texts_of_one_id_lie_in_many_ranges(spark):
    """The slots' order spreads the different texts of one hot id."""
    from vatio.llm.queries import QUERIES
    import tempfile
    folder = tempfile.mkdtemp()
    spark.createDataFrame([(5, f"text {i}") for i in range(300)] + [(None, "same")] * 20, "doc_id long, text string") \
        .write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op6_rendezvous_shards"](spark, folder)
    rows = got.collect()
    hot = [r for r in rows if r["doc_id"] == 5]
    assert len({r["shard"] for r in hot}) == 1 and sorted(r["slot"] for r in rows if r["shard"] == hot[0]["shard"]) \
        == list(range(sum(r["shard"] == hot[0]["shard"] for r in rows)))
    digest = lambda r: __import__("hashlib").md5(f"5:{r['size']}:{r['text_crc32']}".encode()).hexdigest()
    assert [digest(r) for r in sorted(hot, key=lambda r: r["slot"])] == sorted(map(digest, hot))
    assert len({digest(r)[:3] for r in hot}) > 200
