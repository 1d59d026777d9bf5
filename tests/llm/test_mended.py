"""Cases that earlier forms of the operators lost or took too long over."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vertexrank.llm import decontaminate, html_extract, line_dedup, secrets, suffix_dedup

from .test_operators import SF, Sets, prose

BASE = {
    "assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def base_spans(text):
    least = {"assign": lambda m: len(m[2]) >= 12, "access": lambda m: len(m[0]) >= 18, "hex": lambda m: len(m[0]) >= 16}
    return sorted((m.start(), list(BASE).index(k), f"{k}:{m.start()}:{m.end()}") for k, p in BASE.items() for m in p.finditer(text) if least[k](m))


def many_secrets(n):
    return "".join(f"é{i} token: {'x' * (8 + i % 9)} user: bob\n" + ("0123456789abcdef" + "f" * (i % 5) + " ") * (i % 2) for i in range(n))


def test_secrets_of_a_text_with_many_matches(spark):
    texts = [many_secrets(n) for n in (0, 1, 255, 256, 257, 511, 512, 513, 3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.find_secrets(df).collect():
        spans = [s for s in r["spans"].split(",") if s.split(":")[0] in BASE]
        assert spans == [s for _, _, s in base_spans(texts[r["doc_id"]])]


def test_secret_scan_is_linear_in_the_matches(spark):
    def seconds(n):
        df = spark.createDataFrame([(1, "user: bob " * n)], "doc_id long, text string")
        begun = time.time()
        assert secrets.part_table(df).select(F.size("weak").alias("n")).first()["n"] == n
        return time.time() - begun

    seconds(1000)
    assert seconds(40_000) < 4 * seconds(10_000) + 3


def test_lines_equal_exact_jaccard_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = sorted((r["doc_id"], pos, line) for r in docs.collect() if r["text"] for pos, line in enumerate(r["text"].split("\n")))
    def shown(line):
        return re.sub(r"[\x20\x09-\x0d]+", " ", "".join(c.lower() if c.isascii() else c for c in line)).strip(" ")
    texts = sorted({t for _, _, line in rows if (t := shown(line))})
    sets = [frozenset(t[i : i + 7] for i in range(max(1, len(t) - 6))) for t in texts]
    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    groups, by_size = Sets(), [len(s) for s in sets]
    for i, s in enumerate(sets):
        shared = {}
        for g in s:
            for j in holders[g]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, both in shared.items():
            if len(texts[i]) >= 7 <= len(texts[j]) and 100 * both >= 80 * (by_size[i] + by_size[j] - both):
                groups.join(i, j)
    place, first, want = {t: i for i, t in enumerate(texts)}, set(), set()
    for d, pos, line in rows:
        if t := shown(line):
            family = groups.find(place[t])
            if family in first:
                want.add((d, pos))
            first.add(family)
    got = {(r["doc_id"], r["pos"]) for r in line_dedup.line_families(docs).collect()}
    assert got == want and want


def test_items_in_many_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(i, prose(100 + i, 30)) for i in range(12)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{prose(300 + i, 50)} {prose(100 + i, 30)}") for i in range(12)] + [(50, prose(7, 90))], "doc_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 60)
    alive, most = set(), []

    class Watched(decontaminate.ItemIndex):
        def __init__(self, rows):
            alive.add(id(self))
            most.append(len(alive))
            super().__init__(rows)

        def __del__(self):
            alive.discard(id(self))

    monkeypatch.setattr(decontaminate, "ItemIndex", Watched)
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, items).collect()}
    assert got == {(i, i) for i in range(12)} and len(most) >= 6


def test_pages_without_head_or_body_tags():
    shown = lambda page: [b[0] for b in html_extract.blocks(page)]
    assert shown("<html><head><title>T</title><article><p>Text of the story") == ["Text of the story"]
    assert shown("<head><meta charset=utf-8><title>T</title>loose text") == ["loose text"]
    assert shown("<title>T</title><p>a</p>") == ["a"]
    assert shown("<head><noscript><p>n</p></noscript><style>s</style><script>x</script></head><body><p>b</p>") == ["b"]
    assert shown("<p>x <math><mi>E</mi><mo>=</mo><mi>m</mi></math> y</p>") == ["x E=m y"]
    assert shown("<p>a <object data=f>fall</object> <canvas>back</canvas></p><noscript><p>text</p></noscript>") == ["a fall back", "text"]


def test_pages_that_teach_nothing():
    pages = ["<nav>m</nav><article><p>a</p><aside>s</aside></article>", "<p>only</p><footer>f</footer>", None, ""]
    assert html_extract.extract_text(pages, None) == ["a", "only", "", ""]


def test_page_sample_has_one_page_per_id(spark):
    page = "<article><h1>Title of it</h1><p>{}</p><p>{}</p></article><footer>foot {}</footer>"
    rows = [(1, page.format(prose(i, 20), prose(i + 50, 30), i)) for i in range(5)] * 3
    rows += [(i, page.format(prose(i, 20), prose(i + 50, 30), i)) for i in range(2, 12)] + [(99, None), (None, "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumns({c: F.lit("u") for c in ("url", "s_id", "h", "text", "a.b")})
    got = html_extract.extract(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] not in (None, 99):
            assert "foot" not in r["text"] and r["n_chars"] > 100


@pytest.mark.parametrize("collection", [3_000, 1_000_000])
def test_suffix_dedup_passage_in_many_texts(spark, collection, monkeypatch):
    """One passage in many texts: its anchor has too much context for a collection."""
    monkeypatch.setattr(suffix_dedup, "COLLECTION_BYTES", collection)
    rng = random.Random(7)
    letters = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared, long, dots = letters(450), letters(1500), "." * 700
    rows = [(k, letters(rng.randint(0, 300)) + shared[rng.randint(0, 40) :] + letters(rng.randint(0, 300))) for k in range(60)]
    rows += [(100 + k, letters(200) + long + letters(200)) for k in range(10)]
    rows += [(200 + k, letters(rng.randint(0, 90)) + dots[: rng.randint(380, 700)] + letters(rng.randint(0, 90)) + "ab" * rng.randint(150, 300)) for k in range(25)]
    rows += [(300, letters(900))] * 2 + [(300, shared), (None, long), (301, None), (302, ""), (303, letters(2000))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert Counter(map(tuple, out.collect())) == Counter(suffix_dedup_by_force(rows))


def test_suffix_dedup_common_anchor_is_spread(spark, monkeypatch):
    """The rows of an anchor that many texts use are not dealt to one task."""
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = letters(450)
    rows = [(k, letters(rng.randint(0, 300)) + shared + letters(rng.randint(0, 300))) for k in range(300)]
    rows += [(1000 + k // 2, t) for k in range(0, 60, 2) for t in [letters(700)] * 2]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    tables = []

    def watched(df):
        out = real(df)
        if "anchor" in out.columns and {"lo", "at"} & set(out.columns):
            files = [r["n"] for r in out.groupBy("anchor", F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
            anchors = [r["count"] for r in out.groupBy("anchor").count().collect()]
            tables.append((max(files, default=0), max(anchors, default=0)))
        return out

    real = suffix_dedup.cut
    # tables this small would be broadcast
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in conf}
    monkeypatch.setattr(suffix_dedup, "cut", watched)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert Counter(map(tuple, out)) == Counter(suffix_dedup_by_force(rows))
    assert max(total for _, total in tables) >= 250
    assert all(most <= 0.5 * total for most, total in tables if total >= 250)


def suffix_dedup_by_force(rows):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i : i + 400] for _, b in texts for i in range(len(b) - 399))
    for d, b in texts:
        cover = bytearray(len(b))
        for i in range(len(b) - 399):
            if count[b[i : i + 400]] > 1:
                cover[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        yield d, len(b), sum(cover), len([x for x in bytes(cover).split(b"\0") if x]), hashlib.sha256(kept).hexdigest()
