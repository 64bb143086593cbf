"""The operators against brute force, round trips, held-out accuracy and DuckDB, with edge cases."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from mixlens.llm import (exact_dedup, html_text, language, mixing, neighbours, ngram_join, packing, quality,
                         substring_dedup, url_filter)
from mixlens.llm.common import held_out, word_count

SF = "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long, score double, place long, key string"


def rows_of(spark, texts, schema=DOC):
    """Edge table: null ids, sources and texts, repeated rows, and columns with clashing names."""
    return spark.createDataFrame([(i, t, None if i == 3 else "en", None if i == 2 else f"s{i % 3}" if i is not None else "s0", None, 0.5, 7, "k")
                                  for i, t in texts], schema)


LONG = " ".join(f"w{i % 977}x{i}" for i in range(20_000))
EDGE = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "one  two\tthree four five six"), (5, "one two three four five six"),
        (5, "one two three four five six"), (6, LONG), (7, LONG + " tail"), (None, "one two three four five six"), (8, "$$$ 123 !!!")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    return rows_of(spark, EDGE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


def duck(sql, **tables):
    con = duckdb.connect()
    for name, pdf in tables.items():
        con.register(name, pdf)
    return con.execute(sql).df()


def same(a, b):
    def plain(v):
        return None if v is None or pd.isna(v) else float(v) if isinstance(v, (int, float, np.number)) else v

    def rows(d):
        return sorted((tuple(map(plain, r)) for r in d[sorted(d.columns)].astype(object).itertuples(index=False)), key=repr)

    assert sorted(a.columns) == sorted(b.columns) and rows(a) == rows(b)


# ------------------------------------------------------------------ mixing

def test_mixing_equals_sql(spark, docs, edge):
    for d in (docs, edge):
        same(mixing.mix(d).toPandas(), duck(mixing.oracle_sql(), documents=d.select("doc_id", "text", "source").toArrow()))


def test_mixing_by_groups_of_shards_equals_sql(spark, docs):
    small = {"docs_per_shard": 8, "shards_per_group": 5}
    got = mixing.mix(docs, **small).toPandas()
    same(got, duck(mixing.oracle_sql(**small), documents=docs.select("doc_id", "text", "source").toArrow()))
    per = got.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"))
    # A shard's words are a whole number of blocks but for half a block, which counts in each of at most three passes.
    shards = got.groupby("source", dropna=False).size() / 8 + 1
    assert (abs(per.taken - per.target) <= mixing.BLOCK_WORDS * (1 + 1.5 * shards)).all()


def test_mixing_of_a_repeated_id_and_of_a_source_of_few_words(spark, monkeypatch):
    rows = [(None if i % 2 else 7, "a b c d", "s0") for i in range(400)] + [(1000 + i, "x y z " * (i % 9), "s1") for i in range(200)]
    d = spark.createDataFrame([*rows, (1, "one two three four five", "tiny")], "doc_id long, text string, source string")
    want = duck(mixing.oracle_sql(), documents=d.toArrow())
    for chunk in (100_000, 7):
        monkeypatch.setattr(mixing, "CHUNK_ROWS", chunk)
        same(mixing.mix(d).toPandas(), want)
    tiny = want[want.source == "tiny"].iloc[0]
    assert tiny.target == 15 and tiny.taken == 15
    out = mixing.mixed_documents(d).groupBy("source").agg(F.sum(word_count(F.col("text"))).alias("w")).toPandas()
    assert dict(zip(out.source, out.w)) == want.groupby("source").taken.sum().to_dict()


def test_mixing_reaches_targets_and_mixed_rows_hold_the_taken_words(docs, edge, empty):
    for d in (docs, edge):
        m = mixing.mix(d).toPandas()
        assert (m.taken <= 3 * m["size"]).all()
        per = m.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"))
        assert (abs(per.taken - per.target) <= 2 * mixing.BLOCK_WORDS).all() and (per.target <= 3 * per["size"] + 1e-6).all()
        assert per.target.sum() == pytest.approx(m["size"].sum())
        out = mixing.mixed_documents(d)
        assert out.columns == d.columns
        words = out.groupBy("doc_id").agg(F.sum(word_count(F.col("text"))).alias("w")).toPandas()
        want = m[m.taken > 0].groupby("doc_id", dropna=False).taken.sum()
        assert sorted(words.w) == sorted(want)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mixed_rows_hold_the_taken_words_where_the_cut_falls_among_equal_rows(spark):
    texts = [" ".join(f"{k}{j}" for j in range(50)) for k in "abc"]
    rows = [(None if i % 2 else 7, texts[i // 2 % 3], "s0") for i in range(60)] + [(100 + i, "x y z " * 40, f"s{1 + i % 2}") for i in range(20)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    checked = 0
    for weights in [(1, 2, 3), (5, 1, 1), (2, 1, 1)]:
        taken = mixing.mix(d, weights=weights).collect()
        want, part = defaultdict(int), [r["taken"] % r["size"] for r in taken if r["source"] == "s0"]
        for r in taken:
            want[r["doc_id"]] += r["taken"]
        got, sizes = defaultdict(int), []
        for r in mixing.mixed_documents(d, weights=weights).collect():
            got[r["doc_id"]] += len(r["text"].split())
            sizes += [len(r["text"].split())] if r["source"] == "s0" else []
        assert got == {k: v for k, v in want.items() if v} and sorted(s for s in sizes if s != 50) == sorted(x for x in part if x)
        checked += any(part)
    assert checked


def test_highest_quotients_give_the_textbook_seats(spark):
    votes = [53000, 24000, 23000, 1, 0]
    p = spark.createDataFrame(list(enumerate(votes)), "rank long, votes long").withColumn("total", F.lit(sum(votes)))
    got = mixing.highest_quotients(p, votes="votes", seats=F.lit(7), total="total", parties_in_house=F.lit(5), house=(), tie="rank", out="won")
    quotients = sorted(((-v / (2 * k + 1), i) for i, v in enumerate(votes) for k in range(7)))[:7]
    want = {i: sum(1 for _, j in quotients if i == j) for i in range(len(votes))}
    assert {r["rank"]: r["won"] for r in got.collect()} == want


# ------------------------------------------------------------- url filter

URLS = [None, "", "abc", "http://EXAMPLE.com/en/x", "http://a.b.net", "https://net/es/", "http://x.net?/es/", "http://evil.org/a.com/",
        "http://u:p@example.com:80/en/", "http://www.example.com/en/", "http://é.com/", "http://xexample.com/en/", "://com/#a",
        "http://a.example.com/en/" + "z" * 5000, "x://y://com/", "http://a.www.example.com/en/?q"]


def test_url_filter_equals_sql(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    more = spark.createDataFrame([(10**6 + i, u) for i, u in enumerate([*URLS, *URLS[3:5]])], "page_id long, url string")
    both = pages.unionByName(more)
    same(url_filter.url_verdicts(both).toPandas(), duck(url_filter.oracle_sql(), pages=both.toArrow()))
    assert url_filter.url_verdicts(both.limit(0)).count() == 0


def test_automaton_of_many_words_equals_a_plain_search():
    rng = np.random.default_rng(3)
    hosts = ["".join(rng.choice(list("ab."), 6)).strip(".") or "a" for _ in range(60)]
    rules = [("allow" if i % 2 else "block", h, "/" + h[:2]) for i, h in enumerate(dict.fromkeys(hosts))]
    a = url_filter.Automaton(rules)
    assert a.words > 4
    urls = [(f"{x}.{y}", f"/{x}") for x, y in itertools.product(hosts[:30], hosts[:20])]
    got = a.first_fits([f".{h}{p}".encode() for h, p in urls])
    for (h, p), g in zip(urls, got):
        fits = [k for k, (_, rh, rp) in enumerate(a.rules) if (h == rh or h.endswith("." + rh)) and p.startswith(rp)]
        assert g == (fits[0] if fits else -1)


# ------------------------------------------------------------ exact dedup

def test_exact_dedup_equals_brute_force(docs, edge, empty):
    for d in (docs, edge):
        rows = d.select("doc_id", "text").collect()
        groups = defaultdict(list)
        for i, t in rows:
            groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(i)
        want = []
        for text, ids in groups.items():
            known = [i for i in ids if i is not None]
            keep = min(known) if known else None
            sha = hashlib.sha256(text.encode()).hexdigest()
            first = sorted(ids, key=lambda i: (i is None, i)).index(keep)
            want += [(i, keep, len(ids), k == first, sha) for k, i in enumerate(sorted(ids, key=lambda i: (i is None, i)))]
        for size in (exact_dedup.BUCKET_BYTES, 20_000):
            got = [tuple(r) for r in exact_dedup.dedup(d, bucket_bytes=size, run_bytes=50_000).collect()]
            assert sorted(got, key=repr) == sorted(want, key=repr)
        out = exact_dedup.without_copies(d)
        assert out.columns == d.columns and out.count() == len(groups)
    assert exact_dedup.dedup(empty).count() == 0 and exact_dedup.without_copies(empty).count() == 0


def test_content_table_compares_contents_not_digests():
    table = exact_dedup.ContentTable(4)
    for i in range(50):
        table.add("0" * 64, b"%d" % (i % 25), i, 1)
    assert len(table.texts) == 25 and set(table.counts) == {2} and sorted(table.ids) == list(range(25))


# ---------------------------------------------------------------- packing

def check_packing(d, size=2048, **options):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    out = packing.pack(d, TOKENIZER, size=size, **options).toPandas()
    ids = sorted([i, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]] for i, t in d.select("doc_id", "text").collect() if i is not None)
    whole = defaultdict(list)
    for i, x in ids:
        whole[i].append(np.array(x, "<u4"))
    for i, g in out[out.doc_id.notna()].groupby("doc_id"):
        pieces = sorted(g[["start", "length", "ids_crc32", "doc_tokens"]].itertuples(index=False, name=None))
        left = [(x, len(x)) for x in whole[i]]
        for start, length, crc, n in pieces:
            assert any(len(x) == n and zlib.crc32(x[start:start + length].tobytes()) == crc for x, _ in left)
        assert sum(p[1] for p in pieces) == sum(n for _, n in left)
    assert set(whole) == set(out.doc_id.dropna())
    padding = 0
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.concatenate(([0], np.cumsum(g.length.to_numpy())[:-1]))).all()
        used = int(g.length.sum())
        assert used <= size
        padding += size - used if used & (used - 1) else 0
    return out, padding


def test_packing_holds_every_token_once_without_padding(docs):
    out, padding = check_packing(docs.repartition(7), fan_in=3)
    assert padding == 0 and len(out) < 1.6 * docs.count()
    check_packing(docs.limit(60).repartition(3), size=128, windows=2, fan_in=2)


def test_packing_edge_cases(spark, edge, empty):
    odd = ["  a  b\n c", "x<|endoftext|> y", "a \n b", " a", "a ", "　 b   c  d", "don't we'll I'M 12 34", "née ÇA", "日本語 テキスト", "😀 a"]
    more = rows_of(spark, [*EDGE, *((100 + i, t) for i, t in enumerate(odd))])
    assert check_packing(more)[1] == 0
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_ranked_encoder_equals_the_tokenizer(docs):
    encoder, slow = packing.Encoder(TOKENIZER), packing.Encoder(TOKENIZER)
    assert encoder.fast is not None
    slow.fast = None
    for r in docs.select("text").collect():
        assert (encoder.encode(r[0], 1) == slow.encode(r[0], 1)).all()


# ------------------------------------------------------------- neighbours

def test_neighbours_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = neighbours.nearest(table, block=100, leaf=16).toPandas()
    pdf = table.toPandas().sort_values("vec_id")
    v, ids = np.stack(pdf.embedding.to_numpy()).astype(float), pdf.vec_id.to_numpy()
    hits = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = v @ v[i]
        s[i] = -np.inf
        got = out[out.query_id == ids[i]].sort_values("rank")
        assert got["rank"].tolist() == list(range(1, 21))
        assert np.allclose(got.score, s[np.searchsorted(ids, got.vec_id)], atol=1e-12) and got.score.is_monotonic_decreasing
        hits += len(set(got.vec_id) & set(ids[np.argsort(-s, kind="stable")[:20]]))
    assert hits >= 0.9 * len(out)


def test_neighbours_verify_a_part_of_the_points_and_keep_recall():
    """The registered settings on one block: projected order rules out more than two fifths."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, x = table.column("vec_id").to_numpy(), neighbours.as_matrix(table.column("embedding"), 64)
    matrix, most = neighbours.projection(64, neighbours.DIMS, neighbours.SEED), (x * x).sum(1).max()
    block = neighbours.Block([[i] for i in ids], x, neighbours.project(x, most, matrix), neighbours.LEAF)
    asked = x[ids % 20 == 0]
    q = neighbours.of_length(asked, most)
    gap, quantile = neighbours.gaps(q @ matrix[:-1], block.low, block.high), neighbours.chi_square(neighbours.CONFIDENCE, neighbours.DIMS)
    hits = 0
    for i in range(len(q)):
        near = block.search(q[i], q[i] @ matrix[:-1], gap[i], np.inf, most, 21, quantile)
        hits += len(set(block.first[near]) & set(ids[np.argsort(-(x @ asked[i]))[:21]]))
    assert hits >= 0.93 * 21 * len(q)
    assert block.verified <= 0.6 * len(q) * len(x)


def test_neighbours_of_a_vector_that_most_rows_share_and_lengths_that_differ(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 6)) * rng.uniform(0.1, 9, size=(600, 1))
    x[::2] = x[0]
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(d, k=5, every=10, block=40, leaf=8, sample=200).toPandas()
    hits = 0
    for i in range(0, 600, 10):
        s = x @ x[i]
        best = [j for j in np.lexsort((np.arange(600), -s.round(9))) if j != i][:5]
        got = out[out.query_id == i].sort_values("rank")
        assert np.allclose(got.score, s[got.vec_id]) and len(got) == 5
        hits += len(set(best) & set(got.vec_id))
    assert hits >= 0.9 * len(out) and len(out) == 300


def test_neighbours_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (None, [1.0, 0.0]),
            (7, [0.0, 1.0]), (8, [1.0]), (9, [1.0, 0.0]), (9, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [2.0, 2.0])]
    rows += [(100 + i, [1.0, 0.0]) for i in range(1, 60)]
    d = spark.createDataFrame([(*r, 5, 1) for r in rows], "vec_id long, embedding array<float>, label int, block int")
    out = neighbours.nearest(d).toPandas()
    assert set(out.query_id) == {0, 20, 40, 120, 140}
    first = out[out.query_id == 0].sort_values("rank")
    # The same vector 62 times and one longer: ties go to the smaller id.
    assert first.vec_id.tolist() == [40, 8, 9, 20, *range(101, 117)] and first.score.iloc[0] == 2.0
    assert neighbours.nearest(d.limit(0)).count() == 0
    two = neighbours.nearest(d.where("vec_id in (0, 7)")).toPandas()
    assert two.vec_id.tolist() == [7] and two.score.tolist() == [0.0]


# --------------------------------------------------------------- language

def test_language_held_out_accuracy(docs):
    out = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    out = out[out.held_out]
    assert (out.lang == out.lang_pred).mean() > 0.97 and out.score.between(0, 1).all()
    assert out.doc_id.map(held_out).all()


def test_language_edge_cases(spark, docs, edge, empty):
    out = {r["doc_id"]: r for r in language.languages(edge).collect()}
    assert out[0]["lang_pred"] == out[1]["lang_pred"] == out[8]["lang_pred"] == "und" and out[8]["score"] == 0
    assert out[4]["lang_pred"] == "en" and out[4]["score"] == 1
    none = language.languages(edge.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in none.collect()} == {"und"}
    assert language.languages(empty).count() == 0


def test_language_reads_only_the_text(docs):
    model = language.fit(docs)
    task = language.predict_task(model)
    text = docs.select("text").limit(5).collect()
    import pyarrow as pa
    for ids in ([1, 2, 3, 4, 5], [9, 9, 9, 9, 9]):
        batch = pa.RecordBatch.from_pydict({"doc_id": ids, "held_out": [False] * 5, "letters": [True] * 5, "text": [t[0] for t in text]})
        got = next(task(iter([batch]))).to_pydict()
        assert got["doc_id"] == ids
        one = [next(task(iter([batch.slice(i, 1)]))).to_pydict()["lang_pred"][0] for i in range(5)]
        assert one == got["lang_pred"]


# ------------------------------------------------------------------- html

def test_html_rendering():
    page = ("<html><head><title>x</title><style>p{}</style></head><body><h1>T &amp; u</h1><p>a<b>b</b>\n c<p>d<br>e<ul><li>x<li>y<ol><li>1<li>2</ol>"
            "</ul><table><tr><td>aa<td>b<tr><td>c<td>dddd</table><div hidden>no</div><div style='display: none'>no</div><script>no</script>"
            "<pre>k  l\n m</pre>end")
    assert html_text.html_to_text(page) == ("T & u\n\nab c\n\nd\ne\n\n- x\n- y\n 1. 1\n 2. 2\n\naa  b\nc   dddd\n\nk  l\n m\n\nend")


@pytest.mark.parametrize("page,text", [
    ("a<![ endif]>b<![foo]>c<p>d", "abc\n\nd"),
    ("<p>a<![if !IE]>b<![endif]>c<![CDATA[x>y", "abcy"),
    ("<head><title>T</title><body>Hello <b>x</b>", "Hello x"),
    ("<head><title>T</title>Hello <b>x</b>", "Hello x"),
    ("<head><meta charset=x>\n<title>T</title>\n<style>s</style><br>Hello", "Hello"),
    ("<head><template><body>no</template><title>T</title></head>yes", "yes"),
    ("<div>a<svg width=1 />b</div>c", "ab\nc"),
    ("a<svg><path/><g/><circle r=1></circle></svg>b<math><mi/><![CDATA[x>]]></math>c", "abx>c"),
    ("<div/>a<p/>b", "a\n\nb"),
    ("<p>a</p><!-->visible<p>more</p><!-- x --><p>end", "a\n\nvisible\n\nmore\n\nend"),
    ("<p>a</p><!--->b<!-- x --!>c", "a\n\nbc"),
    ("a<!-- open comment <b>secret</b> rest", "a"),
    ('a</foo bar="x>y">z</b c=\'>\' d>e', "aze"),
    ("a</p", "a"),
    ("<textarea>a <b>c</b> &amp; d</TEXTAREA >e", "a <b>c</b> & de"),
    ("<title>a <!-- </title>b<svg><title>n</title></svg><xmp><i>&lt;</xmp>c", "b<i>&lt;c"),
    ("<table><tr><td>k<td><pre>x\n  y\nz</pre><td>q<tr><td>1<td>2<td>3</table>end", "k  x    q\n     y\n   z\n1  2    3\n\nend")])
def test_html_malformed_parts_hide_no_text_after_them(page, text):
    assert html_text.html_to_text(page) == text


def test_html_keeps_every_visible_word(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html")
    got = {r["page_id"]: r["text"] for r in html_text.page_texts(pages).collect()}
    hidden = re.compile(r"<(head|script|style)\b.*?</\1>|<!--.*?-->|<!DOCTYPE[^>]*>", re.S)
    import html as entities
    for page_id, html in pages.collect():
        want = entities.unescape(re.sub(r"<[^>]*>", " ", hidden.sub(" ", html))).split()
        marks = re.compile(r"^ *(?:- |\d+\. )", re.M)
        assert sorted("".join(want)) == sorted("".join(marks.sub("", got[page_id]).split()))


def test_html_edge_cases(spark):
    odd = [None, "", "<![foo", "</p></div>x", "<table><tr><td colspan=999999999999>a<td>b", "<div>" * 20_000 + "deep", "<li>q<ul></li></ul>r",
           "a&nbsp;b &#x110000; &bogus;", "<!-- never closed", "<script>never closed", "<td>lone</td>"]
    d = spark.createDataFrame([(i, h, "t") for i, h in enumerate([*odd, odd[3]])], "page_id long, html string, text string")
    out = {r["page_id"]: r["text"] for r in html_text.page_texts(d).collect()}
    assert out[0] is None and out[1] == "" and out[3] == "x" == out[11] and out[5] == "deep" and "a" in out[4] and out[10] == "lone"
    assert out[8] == out[9] == ""
    assert html_text.page_texts(d.limit(0)).count() == 0


# ------------------------------------------------------------- n-gram join

def brute_components(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(words, len(w))
        sets[i] = sets.get(i, set()) | ({tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if w else set())
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    common = defaultdict(int)
    for ids in holders.values():
        for pair in itertools.combinations(ids, 2):
            common[pair] += 1
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("words,percent,block", [(4, 85, 1024), (5, 80, 1024), (4, 85, 3)])
def test_ngram_components_equal_brute_force(docs, words, percent, block):
    got = {r[0]: (r[1], r[2]) for r in ngram_join.ngram_components(docs, words=words, percent=percent, block=block).collect()}
    assert got == brute_components(docs.select("doc_id", "text").collect(), words, percent)


def test_ngram_components_of_a_large_family(spark):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 5)):
            w[at] = f"x{rng.integers(0, 40)}"
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows, 4, 85)
    assert 1 < len({c for _, c in want.values()}) < 400
    for block in (1024, 64):
        assert {r[0]: (r[1], r[2]) for r in ngram_join.ngram_components(d, block=block).collect()} == want


def test_ngram_edge_cases(edge, empty):
    out = ngram_join.ngram_components(edge).collect()
    got = {r[0]: (r[1], r[2]) for r in out if r[0] is not None}
    assert got[0] == (0, 0) and got[2] == (0, 2) and got[3] == (1, 3) and got[5] == (3, 4) and got[4] == (3, 4) and got[7][1] == 6
    assert len(out) == len(EDGE) and [r[2] for r in out if r[0] is None] == [4]
    kept = ngram_join.one_of_each(edge)
    assert kept.columns == edge.columns and {r["doc_id"] for r in kept.collect()} == {0, 1, 2, 3, 4, 6, 8}
    assert ngram_join.ngram_components(empty).count() == 0 and ngram_join.one_of_each(empty).count() == 0


def test_near_copies_go_row_by_row_with_null_and_repeated_ids(spark):
    def text(k, *changed):
        return " ".join("changed" if i in changed else f"{k}w{i}" for i in range(60))

    rows = [(1, text("a")), (None, text("a").upper()), (None, text("b")), (None, text("c")), (None, text("c", 59)), (2, text("c", 0)),
            (3, text("d")), (4, text("d", 59)), (4, text("e")), (None, text("f")), (None, text("f", 59)),
            (5, text("g")), (5, text("g", 59)), (None, text("h")), (None, text("h").upper())]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r[0], r[1]) for r in ngram_join.one_of_each(d).collect()]
    assert sorted(t.lower()[0] for _, t in kept) == list("abcdefgh") and all(r in rows for r in kept)
    assert {r for r in kept if r[0] is not None and r[0] < 5} == {rows[0], rows[5], rows[6], rows[8]} and rows[2] in kept
    got = defaultdict(list)
    for r in ngram_join.ngram_components(d, words=5, percent=80).collect():
        got[r[0]].append(r[2])
    assert sorted(got[4]) == [3, 4] and got[5] == [5, 5] and sorted(got[None], key=str) == [1, 2, 2] + [None] * 5


# --------------------------------------------------------- substring dedup

def test_substring_dedup_finds_shared_passages_and_spares_others(spark):
    rng = np.random.default_rng(7)
    words = [f"v{i}" for i in range(5000)]

    def prose(n):
        return " ".join(rng.choice(words, n))

    passages = [prose(70) for _ in range(40)]
    rows = [(i, f"{prose(int(rng.integers(20, 300)))} {passages[i % 40]} {prose(int(rng.integers(20, 300)))}") for i in range(120)]
    rows += [(1000 + i, prose(200)) for i in range(100)]
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, spans string")
    found = {r["doc_id"]: r["spans"] for r in substring_dedup.repeated_spans(d).collect()}
    assert all(not found[i] for i in [*range(40), *range(1000, 1100)])
    assert sum(1 for i in range(40, 120) if found[i]) >= 78
    by_id = dict(rows)
    for i, spans in found.items():
        for s in spans:
            assert by_id[i].encode()[s["start"]:s["end"]].decode() in by_id[i % 40]
    out = {r["doc_id"]: r["text"] for r in substring_dedup.without_repeats(d).collect()}
    assert all(out[i] == by_id[i] for i in [*range(40), *range(1000, 1100)])
    assert np.mean([len(out[i]) < len(by_id[i]) - 200 for i in range(40, 120)]) > 0.9


def brute_spans(rows, at_least):
    """Per document the runs of words covered by windows of ``at_least`` words that a document of smaller id holds too."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        words = text.split()
        windows = [tuple(words[j:j + at_least]) for j in range(len(words) - at_least + 1)]
        inside = sorted({k for j, w in enumerate(windows) if w in seen for k in range(j, j + at_least)})
        seen |= set(windows)
        runs = [list(g) for _, g in itertools.groupby(inside, key=lambda k, c=itertools.count(): k - next(c))]
        out[i] = [[words[k] for k in r] for r in runs]
    return out


@pytest.mark.parametrize("length", [51, 60, 90])
def test_substring_dedup_finds_passages_to_their_ends(spark, length):
    rng = np.random.default_rng(length)

    def prose(n):
        return ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(1, 10))) for _ in range(n)]

    rows = []
    for i in range(400):
        passage, short = prose(length), prose(45)  # 45 words are a stock phrase, which stays
        rows += [(i + k, " ".join(prose(int(rng.integers(5, 60))) + passage + prose(int(rng.integers(5, 60))) + short + prose(3))) for k in (0, 1000)]
    rows = [(i, t if i % 3 else t.replace(" ", "\n ", 40)) for i, t in rows]  # white space does not matter
    got = {r["doc_id"]: r["spans"] for r in substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want, by_id = brute_spans(rows, 51), dict(rows)
    found = 0
    for i, spans in got.items():
        cut = [by_id[i].encode()[s["start"]:s["end"]].decode().split() for s in spans]
        assert cut in ([], want[i]) and [len(c) for c in cut] == [s["words"] for s in spans]
        found += len(cut)
    assert sum(map(len, want.values())) == 400 and found >= 0.99 * 400


def test_substring_dedup_of_repeated_rows_many_followers_and_several_sources(spark):
    rng = np.random.default_rng(3)

    def prose(n):
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))

    a, b, c = prose(80), prose(70), prose(60)
    rows = [(0, f"{prose(9)} {a} {prose(9)}"), (1, f"{b} {prose(5)}"), (2, c)]
    rows += [(10 + i, f"{prose(4)} {a} {prose(3)} {b}") for i in range(30)]  # two sources, more followers than a block
    rows += [(100, f"{prose(7)} {c} {prose(7)}")] * 50 + [(100, f"{c} {prose(9)}")]  # repeated rows, and two texts of one id
    rows += [(200, f"{a} {b} {c}"), (None, a), (None, a)]
    for block in (256, 4):
        got = substring_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()
        assert len(got) == len(rows)
        words = defaultdict(set)
        for r in got:
            words[r["doc_id"]].add(tuple(s["words"] for s in r["spans"]))
        assert all(words[i] == {()} for i in (0, 1, 2, None)) and all(words[10 + i] == {(80, 70)} for i in range(30))
        assert words[100] == {(60,)} and words[200] == {(210,)}


def test_chunks_that_cannot_lie_in_a_long_repeat_are_left_out():
    starts, words = np.arange(0, 400, 40), np.arange(0, 60, 6)
    none = np.zeros(10, bool)
    assert not substring_dedup.possible(starts, words, 60, none, 51).any()
    assert substring_dedup.possible(starts, words, 60, ~none, 51).all() and not substring_dedup.possible(starts, words, 60, ~none, 62).any()
    held = none.copy()
    held[4] = True  # between two bars: 6 words, those of the bars, and 16 for the window before
    assert substring_dedup.possible(starts, words, 60, held, 35).tolist() == held.tolist() and not substring_dedup.possible(starts, words, 60, held, 36).any()


def test_substring_edge_cases(edge, empty):
    out = substring_dedup.repeated_spans(edge)
    got = {r["doc_id"]: r["spans"] for r in out.collect()}
    assert out.count() == len(EDGE) and not got[0] and not got[1] and not got[6] and got[7][0]["words"] > 19_000
    cut = substring_dedup.without_repeats(edge)
    assert cut.columns == edge.columns and cut.count() == len(EDGE)
    assert substring_dedup.repeated_spans(empty).count() == 0 and substring_dedup.without_repeats(empty).count() == 0


def test_chunks_resist_insertions():
    rng = np.random.default_rng(11)
    text = " ".join(f"w{i}" for i in rng.integers(0, 10_000, 2000))
    parts = []
    for raw, ends in substring_dedup.chunks([text, "inserted " + text[:3000] + " more " + text[3000:], "x" * 3000, None]):
        parts.append([raw[s:e] for s, e in zip(ends[:-1], ends[1:])])
        assert b"".join(parts[-1]) == raw and all(0 < len(p) <= substring_dedup.MAX_BYTES for p in parts[-1])
    assert len(set(parts[0]) & set(parts[1])) > 0.97 * len(set(parts[0]))


# ---------------------------------------------------------------- quality

def test_quality_held_out_accuracy(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.quality_scores(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    pdf = out.join(labels, "doc_id").toPandas()
    assert (pdf[pdf.held_out].predicted == pdf[pdf.held_out].quality).mean() > 0.95
    good = quality.good_documents(docs, labels)
    assert good.columns == docs.columns
    assert good.count() == out.where("predicted = 1").count()


def test_quality_network_gradients():
    rng = np.random.default_rng(0)
    net = quality.Network(np.zeros(quality.FEATURES), np.ones(quality.FEATURES))
    x, bags, y, w = rng.normal(size=(9, quality.FEATURES)), np.array([3, 1, 5]), np.array([1.0, 0, 1]), np.array([1.0, 2, 0.5])

    def loss():
        z = net.forward(x, bags)[0]
        return (w * (np.log1p(np.exp(z)) - y * z)).sum() / w.sum()

    grad = net.gradients(x, bags, y, w)
    for name, p in net.p.items():
        at = tuple(0 for _ in p.shape)
        p[at] += 1e-6
        up = loss()
        p[at] -= 2e-6
        assert grad[name][at] == pytest.approx((up - loss()) / 2e-6, abs=1e-6)
        p[at] += 1e-6


def test_quality_edge_cases(spark, edge, empty):
    labels = spark.createDataFrame([(3, 1), (4, 1), (5, 0), (6, 0), (None, 1), (7, None), (99, 0)], "doc_id long, quality int")
    out = quality.quality_scores(edge, labels).collect()
    assert len(out) == len(EDGE) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in out)
    texts = {r["doc_id"]: r["score"] for r in out}
    assert texts[0] == texts[1] == pytest.approx(texts[2])
    assert {r["score"] for r in quality.quality_scores(edge, labels.limit(0)).collect()} == {1.0}
    assert quality.good_documents(edge, labels.limit(0)).count() == len(EDGE)
    assert quality.quality_scores(empty, labels).count() == 0


def test_passages_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["a b c", "", None, "  X y. 12 ||", "q " * 500, "\u00e9t\u00e9 x"]
    whole, bags = quality.passages(texts)
    at = 0
    for t, n in zip(texts, bags):
        assert np.allclose(whole[at:at + n], quality.passages([t])[0])
        at += n


def test_rows_sharing_an_id_teach_once(spark, monkeypatch):
    """However many rows share an id, each fit sees one of them: the samples keep their bounds."""
    ids = [i for i in range(1, 60) if not held_out(i)][:6]
    rows = [(i, f"plain words number {i} here", "en", k) for i in ids for k in range(300 if i == ids[0] else 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, place int")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality.Network, "train", lambda self, x, bags, label, weight, **kw: seen.append(len(bags)))
    assert quality.quality_scores(docs, labels).count() == len(rows) and seen == [len(ids)]
    monkeypatch.setattr(language, "fit_duels", lambda rows, column, classes: seen.append(rows.count()))
    language.fit(docs)
    assert seen == [len(ids)] * 3
