"""Operators of the subpackage against brute force, round trips and odd tables."""

import base64
import collections
import gzip
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers as hf
from pyspark.sql import functions as F

from tabwright.llm import lines, mixing, ngrams, packing, quality, repeats, sharding, tokens, topk, warc
from tabwright.session import fresh_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefg", k=rng.randint(1, 6))) for _ in range(n))


BASE = prose(1, 120)
ODD = [
    (1, None, "x", None), (2, "", "x", "a"), (3, "  \t\n ", None, "a"), (4, "one", "y", "b"), (5, BASE, "y", "b"),
    (6, BASE, "x", "a"), (6, BASE, "x", "a"), (7, BASE.replace("a", "é", 1), None, None), (None, prose(2, 60), "x", "a"),
    (None, None, None, None), (8, prose(3, 4000), "z", "b"), (9, BASE + "\n" + prose(4, 90), "z", "b"),
]
# names that operators use themselves, as extra columns
SCHEMA = "doc_id long, text string, source string, _row string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# 1 ---------------------------------------------------------------------------------------


def test_warc_roundtrip_and_odd_rows(spark):
    big = "<p>é</p>" * 200
    pages = [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "x"), (6, "u", "x"),
             (7, "u", "a\r\n\r\nWARC/1.1\r\nb"), (None, "u", big), (2, "u", big)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, digest string")
    got = warc.roundtrip(df).collect()
    assert {r["kind"] for r in got} == {"record"} and len(got) == len(pages)
    found = collections.Counter((r["record_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got)
    want = collections.Counter()
    for i, _, html in pages:
        raw = (html or "").encode()
        again = len(raw) >= 1000 and i != 2
        name = "" if i is None else i
        want[f"urn:page:{name}", "revisit" if again else "response", "urn:page:2" if again else None, len(raw), hashlib.sha1(raw).hexdigest()] += 1
    assert found == want
    assert warc.roundtrip(df.limit(0)).count() == 0


def test_archives_are_cut_by_mean_size(spark):
    df = spark.range(200).selectExpr("id AS page_id", "'u' AS url", "concat(id, repeat('x', 5000)) AS html").coalesce(1)
    path = fresh_path(spark, "warc")
    warc.write_warc(df, path, file_bytes=100_000)
    sizes = [r[0] for r in spark.read.format("binaryFile").load(path).select("length").collect()]
    assert len(sizes) > 10 and max(sizes) < 150_000
    assert warc.read_warc(spark, path).where("kind = 'record'").count() == 200


def _record(i, body):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + body
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Type: application/http\r\n"
    head += f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}\r\nContent-Length: {len(block)}\r\n\r\n"
    return head.encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize("packed", [False, True])
def test_salvage_finds_all_but_the_damaged(packed):
    parts = [_record(i, bytes([65 + i]) * (50 + i)) for i in range(6)]
    parts = [gzip.compress(p, mtime=0) for p in parts] if packed else parts
    whole = b"".join(parts)
    starts = np.cumsum([0] + [len(p) for p in parts])
    assert [x[0] for x in warc.salvage(whole)] == ["record"] * 6
    for hurt in (0, 2, 5):
        at = int(starts[hurt] + len(parts[hurt]) - 12)
        bad = whole[:at] + bytes([whole[at] ^ 255]) + whole[at + 1 :]
        got = list(warc.salvage(bad))
        ids = [x[3]["warc-record-id"] for x in got if x[0] == "record"]
        assert ids == [f"<urn:page:{i}>" for i in range(6) if i != hurt]
        assert [(x[1], x[2]) for x in got if x[0] == "gap"] == [(starts[hurt], starts[hurt + 1])]
        assert got[0][1] == 0 and got[-1][2] == len(bad) and all(a[2] == b[1] for a, b in itertools.pairwise(got))
    cut = list(warc.salvage(whole[:-9]))
    assert [x[0] for x in cut] == ["record"] * 5 + ["gap"] and list(warc.salvage(b"")) == []
    assert [x[0] for x in warc.salvage(b"no archive at all")] == ["gap"]


def test_salvage_checks_base32_digests():
    hexa = lambda raw: hashlib.sha1(raw).hexdigest().encode()
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    good = _record(1, b"body").replace(hexa(block), base64.b32encode(hashlib.sha1(block).digest()))
    assert [x[0] for x in warc.salvage(good + _record(2, b""))] == ["record", "record"]
    assert [x[0] for x in warc.salvage(good.replace(b"body", b"bodY") + _record(2, b""))] == ["gap", "record"]
    other = good.replace(b"Digest: sha1:", b"Digest: md5:")  # digests of other kinds are not checked
    assert [x[0] for x in warc.salvage(other.replace(b"body", b"bodY"))] == ["record"]


def test_salvage_skips_records_quoted_in_a_damaged_block():
    outer, after = _record(1, b"x\r\n" + _record(7, b"quoted")), _record(2, b"")
    bad = outer.replace(b"200 OK", b"200 KO", 1)
    found = [(x[0], x[1], x[2]) for x in warc.salvage(bad + after)]
    assert found == [("gap", 0, len(outer)), ("record", len(outer), len(outer) + len(after))]
    # with the length damaged too, the search goes on inside
    short = bad.replace(b"Content-Length: 2", b"Content-Length: 3", 1)
    assert [x[3]["warc-record-id"] for x in warc.salvage(short + after) if x[0] == "record"] == ["<urn:page:7>", "<urn:page:2>"]


# 2 ---------------------------------------------------------------------------------------


def brute_features(text):
    w = WORD.findall(text or "")
    seen = collections.Counter(zip(w, w[1:], w[2:], strict=False))
    mark = {i + d for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for d in range(3)}
    full = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(full) - len(set(full)), len(mark)


def test_quality_features_equal_brute_force(odd):
    texts = [r[1] for r in ODD] + ["a b c a b c #1\n\n \na b\na b a b", "x\x1cy  z " * 30]
    for t in texts:
        assert quality.text_features(t)[:5] == brute_features(t)
    assert quality.with_features(odd, out="f").select("f.n_words").count() == len(ODD)


def test_binomial_bound_is_exact():
    for k, n, d in ((0, 50, 0.05), (3, 200, 0.01), (20, 100, 0.1)):
        p = quality.upper_bound(k, n, d)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(tail - d) < 1e-9
    assert quality.upper_bound(5, 5, 0.05) == quality.upper_bound(0, 0, 0.05) == 1.0


def test_quality_rules_keep_the_promise(spark, none):
    good = [(i, prose(i, 80), "en", 1) for i in range(1200)]
    bad = [(5000 + i, " ".join(w + "###" for w in prose(i, 80).split()), "en", 0) for i in range(60)]
    few = [(9000 + i, prose(i, 80), None, 1) for i in range(20)]
    docs = spark.createDataFrame(good + bad + few, "doc_id long, text string, lang string, quality int")
    f = quality.with_features(docs).drop("quality")
    rules = quality.fit_rules(f, docs.select("doc_id", "quality"))
    assert rules.cutoffs["en"] and rules.cutoffs[None] is None
    assert all(c["bound"] == quality.upper_bound(c["rejected"], c["holdout"], c["share"]) for c in rules.certificates)
    out = f.where(~quality.base_failed() & ~rules.rejects(F.col("lang"))).select("doc_id").collect()
    kept = {r[0] for r in out}
    assert not kept & {b[0] for b in bad} and len(kept & set(range(1200))) >= 0.99 * 1200 and {x[0] for x in few} <= kept
    empty = quality.with_features(none.withColumn("lang", F.lit(None).cast("string")))
    assert quality.fit_rules(empty, spark.createDataFrame([], "doc_id long, quality int")).cutoffs == {}


def brute_levels(rejected, sizes, alpha, delta):
    """Strictest certified level per stratum, by the definition: P(X <= k) at rate alpha is at most the share."""
    at = dict.fromkeys(sizes, 0)
    while True:
        left = [s for s in sizes if at[s] < len(quality.MULTIPLES)]
        share = delta / max(1, len(left))
        tail = lambda s: sum(math.comb(sizes[s], i) * alpha**i * (1 - alpha) ** (sizes[s] - i) for i in range(rejected[s][at[s]] + 1))
        pass_ = [s for s in left if tail(s) <= share]
        if not pass_:
            return {s: quality.MULTIPLES[n - 1] if n else None for s, n in at.items()}
        for s in pass_:
            at[s] += 1


def test_kept_follows_from_certificates_of_each_stratum(spark):
    def words(seed, n=80):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(n))

    def fit(sizes, make=words):
        """Levels, and kept ids by (stratum, label); ten junk documents a stratum; all checked against brute force."""
        data = []
        for no, (s, n) in enumerate(sizes.items()):
            data += [(no * 10_000 + i, make(no * 10_000 + i), s, 1, "x") for i in range(n)]
            data += [(no * 10_000 + 5000 + i, " ".join(w + "#" for w in words(i).split()), s, 0, "x") for i in range(10)]
        docs = spark.createDataFrame(data, "doc_id long, text string, lang string, quality int, i string")
        f = quality.materialize(quality.with_features(docs).drop("quality"), "f")
        rules = quality.fit_rules(f, docs.select("doc_id", "quality", "i"))

        def breaks(text, m):
            v = dict(zip(quality.COUNTS + quality.EXTRA, quality.text_features(text), strict=True))
            pairs = [(v[a] / max(v[b], 1), side, floor) for a, b, side, floor in quality.RULES.values()]
            return any(x > floor * m if side == "high" else x < floor / m for x, side, floor in pairs)

        rejected = {s: [sum(breaks(t, m) for _, t, g, y, _ in data if g == s and y) for m in quality.MULTIPLES] for s in sizes}
        levels = brute_levels(rejected, sizes, 0.01, 0.05)
        assert {s: m for s, m, *_ in rules.report()} == levels
        out = f.where(~quality.base_failed() & ~rules.rejects(F.col("lang"))).select("doc_id").collect()
        stays = {i for i, t, s, _, _ in data if levels[s] is None or not breaks(t, levels[s])}
        assert {r[0] for r in out} == stays
        return levels, collections.Counter((s, y) for i, _, s, y, _ in data if i in stays)

    # what a stratum no longer needs goes to the others: 307 rows alone certify nothing at a quarter of delta
    levels, kept = fit({"en": 900, "fr": 488, "de": 475, "es": 307})
    assert set(levels.values()) == {1.0} and kept == {("en", 1): 900, ("fr", 1): 488, ("de", 1): 475, ("es", 1): 307}
    # too few labels: rules off for that stratum only, never a pool
    levels, kept = fit({"de": 480, "es": 250, None: 240})
    assert levels == {"de": 1.0, "es": None, None: None} and kept["es", 0] == kept[None, 0] == 10
    # good documents with short words break the floors but not a multiple of them
    levels, kept = fit({"en": 480}, lambda i: prose(i, 80))
    assert levels["en"] == 1.5 and kept == {("en", 1): 480}
    # good documents that break every multiple
    assert fit({"en": 480}, lambda i: words(i) + " #" * (80 * (i % 20 == 0)))[0] == {"en": None}


# 3 ---------------------------------------------------------------------------------------


def greedy(word, first, later):
    n, at, known = 0, 0, first
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
        if end is None:
            return 1
        n, at, known = n + 1, end, later
    return n


def test_automaton_equals_greedy_longest_match(spark, odd, none):
    rng = random.Random(0)
    for _ in range(300):
        pieces = lambda k: {"".join(rng.choices("abc", k=rng.randint(1, 5))).encode() for _ in range(k)}
        first, later = pieces(rng.randint(1, 8)), pieces(rng.randint(1, 8))
        automaton = tokens.Automaton(first, later)
        for _ in range(30):
            word = "".join(rng.choices("abc", k=rng.randint(1, 12))).encode()
            assert automaton.count(word) == greedy(word, first, later), (first, later, word)
    first, later = tokens.read_pieces(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    automaton = tokens.Automaton(first, later)
    got = rows(tokens.count_tokens(spark, odd.select("doc_id", "text", F.lit(1).alias("n_words")), automaton))
    sets = set(first), set(later)
    want = sorted(((i, len(w), sum(greedy(b" " + x.encode(), *sets) for x in w)) for i, t, *_ in ODD for w in [WORD.findall(t or "")]), key=repr)
    assert got == want and tokens.count_tokens(spark, none, automaton).count() == 0


# 4 ---------------------------------------------------------------------------------------


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    data = [(i, rng.normal(size=8).round(2).tolist(), 1) for i in range(900)]
    data += [(900 + i, [1.0] * 8, 1) for i in range(400)]
    data += [(5000, None, 1), (5020, [float("nan")] * 8, 1), (5040, [None] * 8, 1), (5060, [float("inf")] + [0.0] * 7, 1), (None, [1.0] * 8, 1)]
    data += [(6000 + 20 * i, [0.5, 0.25], 1) for i in range(4)] + [(20, data[20][1], 1), (7000, [], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, score int")
    got = rows(topk.top_k(df, F.col("vec_id") % 20 == 0))
    fine = [(i, [math.floor(64 * np.float64(np.float32(c))) for c in v]) for i, v, _ in data
            if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    want = []
    for at, (q, x) in enumerate(fine):
        if q % 20 == 0:
            # every row but the query's own, the other row of a repeated id too
            others = [(c, y) for m, (c, y) in enumerate(fine) if m != at and len(y) == len(x)]
            best = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), c) for c, y in others)
            want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best[:20])]
    assert got == sorted(want, key=repr)
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("size", [1, 1 << 19])
def test_kd_rows_that_repeat_an_id(spark, size):
    """Packed and wide scores; each row is its own candidate and its own query."""
    rng = random.Random(4)
    data = [(rng.choice([20, 40, 41, 42]), [float(rng.randint(-9, 9) * size) for _ in range(3)]) for _ in range(60)]
    data += data[:5]
    got = Counter(rows(topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 4)))
    want = Counter()
    for n, (i, v) in enumerate(data):
        if i % 20 == 0:
            others = sorted((-sum(int(64 * a) * int(64 * b) for a, b in zip(v, w, strict=True)), j) for m, (j, w) in enumerate(data) if m != n)
            want.update((i, at, j, -score) for at, (score, j) in enumerate(others[:4], 1))
    assert got == want


def test_kd_huge_components_count_as_the_largest(spark):
    data = [(20, [1e30, -1e30]), (21, [1.0, 0.0]), (22, [-1e300, 0.0]), (23, [3e5, 3e5])]
    got = topk.top_k(spark.createDataFrame(data, "vec_id long, embedding array<double>"), F.col("vec_id") == 20).collect()
    most = math.isqrt(1 << 60)
    assert [(r["vec_id"], r["score"]) for r in got] == [(21, 64 * most), (23, 0), (22, -most * most)]


def test_kd_search_with_small_leaves():
    rng = np.random.default_rng(1)
    x, ids = rng.integers(-9, 9, (3000, 5)), rng.permutation(9000)[:3000]
    q, own = x[:50], ids[:50]
    row, got, score = topk.search(ids, ids, x, own, q, np.full(50, -(1 << 62)), 7)
    for n in range(50):
        want = sorted((-int(s), int(i)) for s, i in zip(x @ q[n], ids, strict=True) if i != own[n])[:7]
        assert sorted((-int(s), int(i)) for s, i in zip(score[row == n], got[row == n], strict=True)) == want


# 5 ---------------------------------------------------------------------------------------


def brute_repeats(texts, length):
    seen = collections.Counter(d[i : i + length] for d in texts for i in range(len(d) - length + 1))
    for d in texts:
        hit = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                hit[i : i + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~hit])
        yield len(d), int(hit.sum()), int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("length", [40, 100])
def test_repeats_equal_brute_force(spark, none, length):
    rng = random.Random(5)
    share = [prose(50 + i, 40) for i in range(4)]
    texts = [None, "", "é" * 300, "a" * 700, "ab" * 200, BASE, BASE, "x" + BASE]
    for i in range(40):
        s = rng.choice(share)
        a = rng.randrange(len(s))
        texts.append(prose(100 + i, 20) + s[a : a + rng.randint(20, 200)] + prose(200 + i, 20) + (BASE[rng.randrange(99) :] if i % 7 == 0 else ""))
    data = [(i, t, "x") for i, t in enumerate(texts)] + [(5, BASE, "y"), (None, texts[-1], None)]
    df = spark.createDataFrame(data, "doc_id long, text string, a string")
    want = sorted(((i, *r) for (i, *_), r in zip(data, brute_repeats([(t or "").encode() for _, t, _ in data], length), strict=True)), key=repr)
    assert rows(repeats.remove_repeats(df, length)) == want
    left = {keep: {(r["id"], r["kept_sha256"]): r[keep] for r in repeats.remove_repeats(df, length, keep=keep).collect()} for keep in ("kept", "text")}
    assert all(hashlib.sha256(raw).hexdigest() == key[1] and left["text"][key] == bytes(raw).decode("utf-8", "ignore") for key, raw in left["kept"].items())
    assert repeats.remove_repeats(none, length).count() == 0


def test_phrases_cover_every_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 97)
    parser, data = repeats.Parser(64), (prose(9, 300) + "a" * 200).encode()
    pos, lo, hi, _ = parser.phrases(data)
    starts = [p - o for p, x, h in zip(pos, lo, hi, strict=True) for o in range(x, h + 1)]
    assert sorted(starts) == list(range(len(data) - 63))


# 6 ---------------------------------------------------------------------------------------


def brute_join(data):
    sets = []
    for _, t in data:
        w = WORD.findall(t or "")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    n = len(data)
    link = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    order = lambda ids: min(ids, key=lambda x: (x is None, x or 0))
    for i in range(n):
        group, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        same = [j for j in range(n) if j == i or sets[i] and sets[i] == sets[j]]
        yield data[i][0], order([data[j][0] for j in group]), order([data[j][0] for j in same]), len(link[i])


def test_join_equals_brute_force(spark, none, monkeypatch):
    rng = random.Random(3)
    data = [(r[0], r[1]) for r in ODD if r[0] is not None]
    for g in range(12):
        words = prose(300 + g, rng.choice([6, 30, 150])).split()
        for i in range(rng.choice([2, 5, 25])):
            w = list(words)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = f"q{rng.random()}"
            data.append((1000 + 100 * g + i, " ".join(w)))
    monkeypatch.setattr(ngrams, "TILE", 8)
    monkeypatch.setattr(ngrams, "BLOCK", 8)
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("key", F.lit("x")).repartition(7)
    assert rows(ngrams.near_duplicates(df)) == sorted(brute_join(data), key=repr)
    assert ngrams.near_duplicates(none).count() == 0
    assert ngrams.near_duplicates(spark.createDataFrame(ODD, SCHEMA)).count() == len(ODD)


def test_least_matches_grow_with_tolerance():
    strict, loose = ngrams.least_matches(1e-2, 0.8), ngrams.least_matches(1e-9, 0.8)
    assert all(a > b for a, b in zip(strict, loose, strict=True)) and loose == sorted(loose)


# 7 ---------------------------------------------------------------------------------------


def test_ids_equal_the_tokenizer():
    path = public_tokenizers.path("word_bpe_49k.json")
    whole, words = hf.Tokenizer.from_file(path), packing.WordIds(path, most=50)
    texts = [r[1] or "" for r in ODD] + ["Foo<|endoftext|>bar's It'S DON'T 12,3 \x1c á  x y ﬁ İx ΣΑΣ ẞ Å, 'll they'll, a.b. 日本語 \U0001f600"]
    for t in texts:
        assert words.text(t) == np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes()


def test_bounds_and_best_fit():
    rng = np.random.default_rng(2)
    for _ in range(60):
        lengths = rng.integers(1, 13, rng.integers(1, 9))
        bins, offsets = packing.best_fit(lengths, 12)
        fill = np.bincount(bins, weights=lengths)
        assert fill.max() <= 12
        for b in range(len(fill)):
            mine = sorted(zip(offsets[bins == b], lengths[bins == b], strict=True))
            assert [o for o, _ in mine] == [0, *np.cumsum([n for _, n in mine])[:-1]]
        best = next(k for k in range(1, 10) for p in itertools.product(range(k), repeat=len(lengths) - 1)
                    if max(np.bincount([0, *p], weights=lengths)) <= 12)
        assert packing.lower_bound(np.bincount(lengths, minlength=13), 12) <= best <= len(fill)


def test_packing_is_whole_and_gapless(spark, odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(odd, path, 64, 0, keep_ids=True)
    short = packing.token_pieces(odd, path, 64, 0, keep_ids=True, task_words=3)
    assert rows(short) == rows(pieces)
    out = packing.pack_best_fit(pieces, 64, group_rows=20).collect()
    whole = hf.Tokenizer.from_file(path)
    by = collections.Counter()
    for i, t, *_ in ODD:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        for n in range(0, len(ids), 64):
            raw = ids[n : n + 64].tobytes()
            by[i, n // 64, n, len(raw) // 4, zlib.crc32(raw)] += 1
    assert by == collections.Counter((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    bins = collections.defaultdict(list)
    for r in out:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert all(a + n == c for (a, n), (c, _) in itertools.pairwise([*sorted(b), (sum(n for _, n in b), 0)]))
        assert sum(n for _, n in b) <= 64
    assert len(bins) <= math.ceil(sum(r["length"] for r in out) / 64) + 3
    assert packing.pack_best_fit(packing.token_pieces(none, path)).count() == 0


# 8 ---------------------------------------------------------------------------------------


def test_lines_equal_brute_force(spark, none):
    long, rare = "  Common " + "x" * 40 + "\t", "y" * 50
    data = [(i, f"{long if i % 2 else long.lower()}\nown {i}\n{long}") for i in range(9)] + [(3, "again\n" + long), (20, None), (21, ""), (22, rare), (None, long), (23, "é" * 39 + "\n" + "É" * 40)]
    df = spark.createDataFrame([(*d, "c") for d in data], "doc_id long, text string, n_lines string")
    got = rows(lines.drop_common_lines(df).select("doc_id", "n_lines", "n_dropped", "text"))
    want = []
    for i, t in data:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if x.strip(" \t").lower() != long.strip().lower() or i == 8]
        want.append((i, len(all_lines), len(all_lines) - len(kept), t if len(kept) == len(all_lines) else "\n".join(kept)))
    assert got == sorted(want, key=repr)
    assert lines.drop_common_lines(none).count() == 0


# 9 ---------------------------------------------------------------------------------------


def test_shards_follow_the_sorted_bytes(spark, none):
    data = [(i, prose(i, 1 + i % 30)) for i in range(300)] + [(1000 + i, BASE) for i in range(200)] + [(None, BASE), (5, None), (1000, BASE), (6, "")]
    df = spark.createDataFrame([(*d, 1) for d in data], "doc_id long, text string, slot int").repartition(5)
    got = sharding.histogram_shards(df, 16).select("doc_id", "text", "size", "shard", "slot").collect()
    key = lambda i, t: (int(hashlib.md5((t or "").encode()).hexdigest()[:15], 16), -(1 << 63) if i is None else i)
    order = sorted(data, key=lambda d: key(*d))
    total, before, want, slots = sum(len((t or "").encode()) + 1 for _, t in data), 0, [], collections.Counter()
    for n, (i, t) in enumerate(order):
        s = want[-1][3] if n and key(i, t) == key(*order[n - 1]) else before * 16 // total
        size = len((t or "").encode()) + 1
        want.append((i, t, size, s, slots[s]))
        slots[s] += 1
        before += size
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert sharding.histogram_shards(none).count() == 0
    loose = collections.Counter(r["shard"] for r in sharding.histogram_shards(df, 4, tolerance=0.1).collect())
    assert sorted(loose) == [0, 1, 2, 3]


def test_cells_follow_the_width_of_the_cluster():
    cells = [sharding.Cell(None, 10 * j, 10 * j + 10, 10, 10) for j in range(1000)]
    hot = sharding.Cell(5, 0, 1, 5000, 5000)
    narrow, wide = sharding._merged(cells, 4, 10_000, 8), sharding._merged(cells, 4, 10_000, 200)
    assert sum(c.rows for c in narrow) == sum(c.rows for c in wide) == 10_000
    assert len(narrow) <= 40 and len(wide) >= 400
    assert max(c.rows for c in sharding._merged([hot, *cells], 4, 15_000, 8)[1:]) <= 15_000 // 32 + 1


# 10 --------------------------------------------------------------------------------------


def test_targets_and_counts():
    got = mixing.fill_targets([100, 100, 100, 1000], [5, 2, 1, 5], 1.5, 2.0)
    assert got[0] == 200 and got[1] == 200 and got[2] <= 200 and abs(sum(got) - 1950) < 1e-6
    assert mixing.fill_targets([0, 0], [1, 1], 1.5, 2.0) == [0, 0]
    wanted = [0, 7, 900, 15, 300]
    drawn = mixing.draw_counts(wanted, 8, 1)
    assert drawn.sum(axis=0).tolist() == wanted and (drawn >= 0).all() and np.ptp(drawn.sum(axis=1)) <= 1
    for n in (1, 2, 5, 1000):
        k = np.arange(n)
        assert sorted(mixing.permuted(k, np.full(n, n), np.full(n, 12345)).tolist()) == k.tolist()


def test_mix_meets_targets(spark, odd, none):
    data = [(i, prose(i, i % 400), f"s{i % 3}", "k") for i in range(600)]
    df = spark.createDataFrame(data, SCHEMA).unionByName(odd)
    first = mixing.taken_words(mixing.mix_sources(df, block=32))
    got = first.collect()
    assert rows(first) == rows(mixing.taken_words(mixing.mix_sources(df.repartition(3), block=32)))
    assert len(got) == len(data) + len(ODD) and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by = collections.defaultdict(int)
    for r in got:
        by[r["source_size"], r["target"]] += r["taken"]
    assert all(abs(taken - target) <= 64 for (_, target), taken in by.items())
    mix = mixing.mix_sources(df, block=32)
    texts = mixing.mixed_documents(df, mix).collect()
    assert sum(len(WORD.findall(r["text"])) for r in texts) == sum(r["taken"] for r in mixing.taken_words(mix).collect())
    assert mixing.taken_words(mixing.mix_sources(none)).count() == 0


@pytest.mark.parametrize("sizes", [(10, 60, 130, 300, 4000), (10, 60, 130), (300, 130, 60, 10), (33, 129, 257)])
def test_small_sources_come_near_their_target(spark, sizes):
    # several documents a source, one of them without a source name; the last of the first case is far larger
    data, n = [], 0
    for s, size in enumerate(sizes):
        for part in (size // 3, size - size // 3):
            n += 1
            data.append((n, prose(n, part), None if s == 1 else f"s{s}", "k"))
    df = spark.createDataFrame(data, SCHEMA)
    mix = mixing.mix_sources(df)
    got = mixing.taken_words(mix).collect()
    by = {}
    for r in got:
        size, target, taken = by.get(r["source_size"], (r["source_size"], r["target"], 0))
        by[r["source_size"]] = size, target, taken + r["taken"]
    assert set(by) == set(sizes) and all(r["taken"] <= 2 * r["size"] for r in got)
    for size, target, taken in by.values():
        assert taken == 2 * size if target == 2 * size else abs(taken - target) <= 1 + 0.01 * target
    texts = mixing.mixed_documents(df, mix).collect()
    assert sum(len(WORD.findall(r["text"])) for r in texts) == sum(taken for _, _, taken in by.values())
    shards = mix.slots.groupBy("shard").count().collect()
    assert np.ptp([r["count"] for r in shards]) <= 1


# pipeline --------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    good = [(i, f"{prose(i, 90)}\n{'License line ' + 'z' * 40}\n{prose(i + 5000, 90)}", "en", f"s{i % 3}", 0) for i in range(60)]
    copies = [(100 + i, prose(0, 90) + "\n" + prose(5000, 90), "en", "s0", 0) for i in range(3)]
    junk = [(200, "a b c " * 60, "en", "s0", 0), (201, None, None, None, 0), (202, "short", "en", "s1", 0)]
    folder = str(tmp_path)
    docs = spark.createDataFrame(good + copies + junk, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    now = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.materialize(stage(spark, now, folder), name)
        seen[name] = now
    ids = lambda n: {r["doc_id"] for r in seen[n].collect()}
    assert ids(names[0]) == set(range(60)) | set(range(100, 103))
    lined = {r["doc_id"]: r["text"] for r in seen[names[1]].collect()}
    assert sum("License" in t for t in lined.values()) == 1 and "License" in lined[59]
    assert ids(names[2]) == set(range(60)) and seen[names[2]].columns == docs.columns
    assert ids(names[3]) <= set(range(60)) and ids(names[4]) == ids(names[3])
    assert corpus_pipeline.run(spark, folder).count() == seen[names[4]].count()
    assert fresh_path(spark, "x")
