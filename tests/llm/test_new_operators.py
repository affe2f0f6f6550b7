"""Fill-in-middle, token alignment and main text against brute force and odd tables."""

import collections
import hashlib
import html as markup
import json
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tokenizers as hf
from pyspark.sql import functions as F

from tabwright.llm import align, html, middle

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, id string, n int, form string, groups string"
LONG = " ".join(random.Random(5).choices(["alpha", "bêta", "gamma\n", "δ", "  ", "x" * 70], k=300))
ODD = [
    (1, None), (2, ""), (3, "  \t\n "), (4, "one"), (5, "the cat  sat on\n the <S mat"), (5, "the cat  sat on\n the <S mat"), (6, "a<P>b c d"),
    (None, "null id here"), (None, None), (7, LONG), (8, "\t\tlead and trail \x1c x\n  \n"), (9, "ﬁne ① text　wide"), (10, "<s> <0x41> <|endoftext|>"),
    (11, "é́ 漢字🙂 ▁ low"), (12, "<S>"), (13, "one"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 1, "f", None) for i, t in ODD], SCHEMA).repartition(3)


# 11 --------------------------------------------------------------------------------------

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute_middle(i, text, seed=42):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    lo, hi = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return i, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_brute_force(spark, odd):
    more = [(100 + i, " ".join(random.Random(i).choices(["a", "bb", "é\n", "<", "<S", "S>"], k=i % 17))) for i in range(120)]
    more.append((99, LONG * 100))
    docs = odd.unionByName(spark.createDataFrame([(i, t, None, None, None, None) for i, t in more], SCHEMA))
    made = middle.fill_in_middle(docs).withColumn("back", middle.restored(F.col("output"), F.col("form")))
    got = sorted(map(tuple, made.select("id", "n", "form", "prefix_chars", "middle_chars", "output").collect()), key=repr)
    assert got == sorted((brute_middle(i, t) for i, t in ODD + more), key=repr)
    assert {r["form"] for r in made.collect()} == {"plain", "spm", "psm"}
    assert made.where("back <> text").count() == 0
    assert middle.fill_in_middle(odd.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["word", "char"])
def test_char_and_word_units_restore(odd, unit):
    made = middle.fill_in_middle(odd, rate=100, spm_rate=50, seed=7, unit=unit)
    assert made.where(middle.restored(F.col("output"), F.col("form")) != F.col("text")).count() == 0
    if unit == "char":
        assert made.where("n <> char_length(text)").count() == 0


def test_boundary_set_uses_all_containers():
    rng = np.random.default_rng(1)
    few = np.sort(rng.choice(65536, 900, replace=False))
    many = np.sort(rng.choice(65536, 30_000, replace=False)) + 65536
    runs = np.concatenate([np.arange(100, 5000), np.arange(9000, 40_000)]) + 5 * 65536
    full = np.arange(65536) + 6 * 65536
    offsets = np.concatenate([few, many, runs, full])
    cuts = middle.BoundarySet(offsets)
    kinds = [type(c).__name__ for c in cuts.containers]
    assert kinds == ["ArrayContainer", "BitmapContainer", "RunContainer", "RunContainer"]
    assert len(cuts) == len(offsets) and list(cuts) == offsets.tolist()
    picks = [0, len(offsets) - 1, 899, 900, 30_899, 30_900, *rng.integers(0, len(offsets), 500).tolist()]
    assert [cuts.select(k) for k in picks] == offsets[picks].tolist()
    for k in (-1, len(offsets)):
        with pytest.raises(IndexError):
            cuts.select(k)
    assert len(middle.BoundarySet(np.zeros(0, np.int64))) == 0


# 12 --------------------------------------------------------------------------------------


def brute_alignment(docs):
    a = hf.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    letters = align._alphabet()
    a_bytes = {i: bytes(letters[c] for c in t) for t, i in json.load(open(A_PATH))["model"]["vocab"].items() if t != "<|endoftext|>"}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        found = re.fullmatch(r"<0x(..)>", piece)
        return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()

    def spans(ids, of):
        at, out = 0, []
        for i in ids:
            out.append((i, at, at + len(of(i))))
            at = out[-1][2]
        return out

    made, holds = [], collections.Counter()
    for i, t in docs:
        raw = f" {t}".encode()
        x = a.encode(" " + t, add_special_tokens=False).ids if t else []
        y = b.encode(t) if t else []
        if not t or b"".join(map(a_bytes.get, x)) != raw or b"".join(map(b_bytes, y)) != raw:
            made.append((i, [], [], [], ""))
            continue
        x, y = spans(x, a_bytes.get), spans(y, b_bytes)
        shared = sorted({e for *_, e in x} & {e for *_, e in y})
        groups = [
            ",".join(str(t) for t, _, e in x if lo < e <= hi) + "|" + ",".join(str(t) for t, _, e in y if lo < e <= hi)
            for lo, hi in zip([0, *shared], shared, strict=False)
        ]
        links = [(p, q) for p, s, e in x for q, u, v in y if s < v and u < e]
        holds.update(set(links))
        made.append((i, x, y, links, ";".join(groups)))
    best = collections.defaultdict(int)
    for (p, _), n in holds.items():
        best[p] = max(best[p], n)
    return [
        (i, len(x), len(y), len(g.split(";")) if g else 0, len(k), sum(holds[p] == best[p[0]] for p in k), sum(holds[p] for p in k), g)
        for i, x, y, k, g in made
    ]


@pytest.mark.parametrize("chunk_bytes", [64, 2 << 20])
def test_alignment_equals_brute_force(spark, odd, chunk_bytes):
    rng = random.Random(3)
    more = [(100 + i, "".join(rng.choices([" ", "the", "ing", "é", "\n", " token", "1", "漢", "  ", "'s", "#"], k=i % 25))) for i in range(80)]
    docs = odd.unionByName(spark.createDataFrame([(i, t, None, None, None, None) for i, t in more], SCHEMA))
    want = sorted(brute_alignment(ODD + more), key=repr)
    got = align.align(docs, A_PATH, B_PATH, keep=True, chunk_bytes=chunk_bytes).drop("groups_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == want
    digests = [(*r[:7], hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "") for r in want]
    got = align.align(docs, A_PATH, B_PATH, chunk_bytes=chunk_bytes)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(digests, key=repr)
    assert align.align(odd.limit(0), A_PATH, B_PATH).count() == 0


def test_words_have_the_ids_of_whole_texts():
    a = hf.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "é", "<s>", "<|endoftext|>", " ", "\x1c", "!", "#1", "漢", "🙂", "é", "▁", "\x00", "the", "'s", "　", "ﬁ", "\r\n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(4000)]
    aligner = align.Aligner(A_PATH, B_PATH)
    assert aligner.by_words
    none = 0
    for t, x, y in zip(texts, *(side.to_pylist() for side in aligner.tokens(texts)), strict=True):
        if x:
            assert x == a.encode(" " + t, add_special_tokens=False).ids and y == b.encode(t)
        else:
            none += 1
            assert b.decode(b.encode(t)) != t or " ".join(t.split()) != t or not t.isascii()
    assert 0 < none < 2000
    # a task that forgets its words, and one that meets them in another order
    for other in (align.Aligner(A_PATH, B_PATH, words=3), aligner):
        found = [[side.to_pylist() for side in other.tokens(texts[lo : lo + 500])] for lo in range(0, len(texts), 500)]
        assert [[x for part in found for x in part[i]] for i in (0, 1)] == [side.to_pylist() for side in aligner.tokens(texts)]


def test_other_byte_level_files_take_their_own_pipeline(tmp_path):
    spec = json.load(open(A_PATH))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    other = align.ByteLevel(str(path))
    assert other.fast is None and other.encode(["the cat"]) == align.ByteLevel(A_PATH).encode([" the cat"])


# 13 --------------------------------------------------------------------------------------

SHELL = (
    '<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var t="</p>no";</script></head><body><nav><ul><li><a href="/a">no</a>'
    '</li></ul></nav><!-- no --><div class="ad">No, buy this long advert text now, it is long.</div>{}<footer>&copy; no</footer></body></html>'
)
PAGES = {
    None: "", "": "", "plain &amp; text\n here": "plain & text here", "<p>a <b>b": "a b", "<p": "", "<!-- never closed <p>x": "",
    SHELL.format("<article><h1>T &eacute;</h1><p><b>T &eacute;<br><p>One&amp;two.</p><p>Be.</p></article>"): "T é T é One&two. Be.",
    SHELL.format("<article></article>"): "",
    # no element of its own for the article: density decides
    SHELL.format(
        "<div><a href=1>home</a> <a href=2>news</a> <a href=3>about us</a></div><div id=x><h1>Head</h1><div>"
        + "<p>Many words stand here, one after another, in a long row.</p>" * 3
        + '</div></div><div class="comments"><p>A reader says so, and says it at great length, as readers do.</p></div><form>Name <input></form>'
    ): "Head " + " ".join(["Many words stand here, one after another, in a long row."] * 3),
    "<body><main><header>no</header><article class='comment'><p>no no no no no no no</p></article><p>yes " + "word " * 30 + "</p><aside>no</aside></main>": "yes "
    + " ".join(["word"] * 30),
    '<article><p>ok</p><div hidden>no</div><p title="hidden notice">stays</p><ul class="share"><li>no</ul><ol><li>first<li>second</ol></article>': "ok stays first second",
    "<article><p>a<br>b  c<wbr>d</p><textarea><p>no</textarea><table><tr><td>x<td>y</table></article>": "a b cd x y",
}


def test_main_text_of_small_pages():
    for source, text in PAGES.items():
        assert html.main_text(source) == text, source


def brute_density(page):
    """Densities by walking the subtree of every element anew."""
    nodes = page.nodes
    children = collections.defaultdict(list)
    for i, n in enumerate(nodes):
        if n.parent >= 0 and not n.out:
            children[n.parent].append(i)

    def inside(i):
        return [i, *(k for c in children[i] for k in inside(c))]

    whole = {}
    for i, n in enumerate(nodes):
        if not n.out:
            chars = sum(len(t) for k, t in page.blocks if k in inside(i))
            whole[i] = chars, n.tags, n.link_chars, n.link_tags
            assert chars == n.chars
    return whole


def test_totals_cover_whole_subtrees():
    for source in PAGES:
        if source:
            brute_density(html.Page(source))


def test_density_formula():
    assert html.density(0, 0, 0, 0, 0.0) == 0
    assert html.density(100, 4, 0, 0, 0.0) == pytest.approx(25 * np.log(400) / np.log(2))
    linked = 20 * np.log(100 / 60 * 5 / 2) / np.log(np.log(100 / 40 * 60 + 0.3 * 100 + np.e))
    assert html.density(100, 5, 60, 2, 0.3) == pytest.approx(linked)
    assert html.density(50, 3, 50, 3, 0.5) == 0


def test_whole_pages_in_spark(spark):
    long = "<article>" + "".join(f"<p>w{i} é</p>" for i in range(60_000)) + "</article>"
    sources = [*PAGES, long, long]
    rows = [(i, None, s, "old") for i, s in enumerate(sources)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    got = {r["page_id"]: r["text"] for r in html.extract_main_text(df).collect()}
    want = {i: html.main_text(s) for i, s in enumerate(sources)} | {None: ""}
    assert got == want and got[len(PAGES)] == " ".join(f"w{i} é" for i in range(60_000))
    assert html.extract_main_text(df.limit(0)).count() == 0


def test_article_of_every_test_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in html.extract_main_text(pages).collect():
        inner = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        plain = markup.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner)))
        assert r["text"] == " ".join(plain.split())


def test_pieces_of_arrow_batches():
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2, 3]), "text": pa.array(["aa", None, "b" * 10])})
    assert [(i.to_pylist(), t) for i, t in align._batches(iter([batch]), 3)] == [([1, 2], ["aa", None]), ([3], ["b" * 10])]
