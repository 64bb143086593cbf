"""Line dedup, Merkle manifest and conversation repair against DuckDB and brute force, with edge cases."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixlens.llm import conversations, line_dedup, merkle, ngram_join
from mixlens.llm.components import components
from mixlens.llm.ordering import positions
from tests.llm.test_operators import DOC, duck, rows_of, same

SF = "/root/testdata/sf0.01"
LONG = "\n".join(f"line {i % 977} of {i}" for i in range(20_000))
EDGE = [(0, None), (1, ""), (2, " \t\n"), (3, "One line\n one LINE\t"), (4, "one line"), (5, "a\n\n\nb"), (5, "a\n\n\nb"), (5, "ONE LINE\na"),
        (6, LONG), (7, LONG + "\ntail"), (None, "one line\nx"), (None, None), (8, "É\né\n\x0bone line"), (9, "one line\r\nb")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def edge(spark):
    return rows_of(spark, EDGE).withColumns({"a": F.lit(1), "shard": F.lit("x"), "tree": F.lit("y"), "pos": F.lit(0), "digest": F.lit(2)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


# ------------------------------------------------------------------ line dedup

def test_perfect_hash_is_minimal_perfect_and_rejects_foreign_keys():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 5000):
        a, b = rng.integers(-1 << 63, 1 << 63, (2, n), dtype=np.int64)
        sizes, levels, slots = line_dedup.perfect_hash(a, b)
        assert sorted(slots) == list(range(n))
        fingerprints, counts = np.zeros(n, np.int64), np.zeros(n, np.uint32)
        fingerprints[slots], counts[slots] = b, np.arange(1, n + 1)
        shard = line_dedup.Shard(sizes, b"".join(np.packbits(x).tobytes() for x in levels), fingerprints.tobytes(), counts.tobytes())
        assert (shard.probe(a, b) == np.arange(1, n + 1)).all()
        assert not shard.probe(*rng.integers(-1 << 63, 1 << 63, (2, 20_000), dtype=np.int64)).any()
    # Keys that share one half are told apart.
    sizes, levels, slots = line_dedup.perfect_hash(np.zeros(500, np.int64), np.arange(500))
    assert sorted(slots) == list(range(500))


@pytest.mark.parametrize("options", [{}, {"index_bytes": -1, "shard_keys": 20}])
def test_line_dedup_equals_sql(spark, docs, edge, monkeypatch, options):
    monkeypatch.setattr(line_dedup, "HOT", 3)  # few lines are hot, so the shards are probed too
    for d, least in ((docs, 10), (edge, 4)):
        sql = line_dedup.ORACLE_SQL.replace(">= 10", f">= {least}")
        found = line_dedup.line_report(d, min_docs=least, **options).toPandas()
        assert found.n_dropped.sum() > 0
        same(found, duck(sql, documents=d.select("doc_id", "text").toArrow()))


@pytest.mark.parametrize("options", [{}, {"index_bytes": -1}])
def test_texts_without_common_lines(edge, empty, options):
    out = line_dedup.without_common_lines(edge, min_docs=4, **options)
    assert out.columns == edge.columns
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in out.where("doc_id <> 6 and doc_id <> 7 or doc_id is null").collect())
    # "one line" stands in six rows, "a" and "b" in four and three of them.
    want = [(0, ""), (1, ""), (2, " \t\n"), (3, ""), (4, ""), (5, "\n\nb"), (5, "\n\nb"), (5, "a"), (8, "É\né"), (9, "b")]
    texts = {k: [t for n, i, t in got if not n and i == k] for k, _ in want}
    assert texts[3] == [""] and texts[4] == [""] and texts[8] == ["É\né"] and texts[9] == ["b"]
    assert out.where("doc_id = 0 and text is null").count() == 1
    assert sorted(texts[5]) == sorted(["a", "a\n\n\nb", "a\n\n\nb"])
    assert line_dedup.line_report(empty, **options).count() == 0 and line_dedup.without_common_lines(empty, **options).count() == 0


def test_short_keys_and_characters(edge):
    out = line_dedup.line_report(edge, min_docs=1, min_chars=9).toPandas()
    by_id = {k: int(v) for k, v in out.groupby("doc_id").n_dropped.sum().items()}
    assert by_id[3] == 0 and by_id[6] == 20_000  # "one line" has eight characters


def test_a_line_in_a_third_of_all_rows(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.when(F.col("id") % 3 == 0, F.lit("the footer\n")).otherwise(F.lit("")),
                                                                     F.concat(F.lit("line "), F.col("id") % 700)).alias("text"))
    for least in (4, 5, 6):
        a, b = (line_dedup.line_report(d, min_docs=least, index_bytes=x).toPandas() for x in (1 << 20, -1))
        same(a, b)
        assert a.n_dropped.sum() == 1000 + sum(n for k in range(700) if (n := len(range(k, 3000, 700))) >= least)


# ------------------------------------------------------------------ merkle manifest

def brute_merkle(rows):
    def sha(x):
        return hashlib.sha256(x.encode()).hexdigest()

    def leaf(r, more=0):
        fields = [r["doc_id"], r["source"], r["lang"], r["n_chars"] if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
        return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def proofs(nodes):
        found = [[] for _ in nodes]
        at = list(range(len(nodes)))
        while len(nodes) > 1:
            for i, j in enumerate(at):
                found[i].append((j % 2, nodes[j ^ 1] if j ^ 1 < len(nodes) else None))
            nodes, at = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)], [j // 2 for j in at]
        return nodes[0], found

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r["lang"] == g), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for g in langs]
    trees = [proofs([leaf(r) for r in g]) for g in groups]
    root, above = proofs([t[0] for t in trees])
    out = []
    for g, (sub, found), up in zip(groups, trees, above):
        for r, path in zip(g, found):
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            d = leaf(r, int(bad))
            for odd, sibling in path + up:
                d = sha(d if sibling is None else sibling + d if odd else d + sibling)
            out.append((r["doc_id"], leaf(r), sub, root, sha("".join(s or "" for _, s in path + up)), d, d == root))
    return sorted(out, key=repr)


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("step", [1, 2, 6])
def test_merkle_equals_brute_force_and_sql(spark, docs, edge, step):
    many = edge.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id"))).withColumn("n_chars", F.col("doc_id"))  # a NULL lang, some of one leaf
    for d in [edge, many] + ([docs.limit(300), docs.where("doc_id = 5")] if step == 2 else []):
        rows = [r.asDict() for r in d.collect()]
        got = merkle.audit(d, step=step)
        assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        assert plain(got) == brute_merkle(rows)
    if step == 6:
        same(merkle.audit(docs).toPandas(), duck(merkle.oracle_sql(), documents=docs.toArrow()))


def test_merkle_tampering_is_found_and_empty(docs, empty):
    out = merkle.audit(docs).toPandas()
    want = [zlib.crc32(str(i).encode()) % 7 == 0 for i in out.doc_id]
    assert (out.verified != np.array(want)).all() and sum(want) > 100
    assert merkle.audit(empty).count() == 0


def test_paths_lead_from_every_leaf_to_the_root(docs):
    found = merkle.proofs(merkle.tree_of(docs, step=3)).collect()
    assert len(found) == docs.count() and all(merkle.folded(r["digest"], r["path"]) == r["root"] for r in found)


def test_positions_split_repeated_rows(spark):
    rows = spark.createDataFrame([("hot", 1)] * 900 + [("cold", i) for i in range(30)] + [(None, None)] * 3, "g string, x int")
    out = positions(rows, ["g"], ["x"], "test").toPandas()
    for g, n in (("hot", 900), ("cold", 30)):
        part = out[out.g == g]
        assert sorted(part.pos) == list(range(n)) and (part["size"] == n).all()
    assert sorted(out[out.g.isna()].pos) == [0, 1, 2]
    cold = out[out.g == "cold"].sort_values("pos")
    assert list(cold.x) == list(range(30))


# ------------------------------------------------------------------ conversation repair

def brute_audit(kinds):
    """Least (cost, audit) by trying every edit, state by state, with the audits written out."""
    best = {0: (0, "")}
    due, keeps = {0: 2, 1: 2, 2: 3, 3: 2}, {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def inserted(found):
        for _ in range(3):
            for s, (c, a) in list(found.items()):
                found[due[s]] = min(found.get(due[s], (10**9, "")), (c + 3, a + "I"))
        return found

    for initial, cut in kinds:
        nxt = {}
        for s, (c, a) in inserted(dict(best)).items():
            moves = [(s, c + 4, "D")]
            if initial is not None:
                moves.append((due[s], c + 3 + 3 * cut, "R"))
                if (s, initial) in keeps:
                    moves.append((keeps[s, initial], c + 3 * cut, "K"))
            for t, cost, e in moves:
                nxt[t] = min(nxt.get(t, (10**9, "")), (cost, a + e))
        best = nxt
    return min(v for s, v in inserted(dict(best)).items() if s in (0, 3))


def test_solver_equals_brute_force_whole_and_in_blocks():
    kinds = [(i, c) for i in ("s", "u", "a", "") for c in (False, True)] + [(None, False)]
    rng = random.Random(5)
    cases = [list(c) for n in range(4) for c in itertools.product(kinds, repeat=n)] + [rng.choices(kinds, k=rng.randint(4, 40)) for _ in range(300)]
    for case in cases:
        cost, audits = conversations.solved(case)
        assert (cost, "".join(audits)) == brute_audit(case)
        items = [conversations.KINDS[k] for k in case]
        if len(items) > 3:
            blocks = [items[i:i + 3] for i in range(0, len(items), 3)]
            ends = conversations.crossings([conversations.composed(b) for b in blocks], 0, None)
            starts, states = [0, *ends[:-1]], []
            for b, s, t in zip(blocks, starts, [*ends[:-1], None]):
                states += conversations.crossings(b, s, t)
            assert states == conversations.crossings(items, 0, None)


TURNS = "conv_id long, turn long, role string, text string, pos int, block string, audit int"


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(9)
    texts = [None, "", " \n", "Yes.", "Yes.", "No!", "What?", "cut off", "ends. \t", "a.b", "x" * 50_000 + ".", "tail. "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for c in [*range(60), None]:
        for t in range(rng.randint(1, 14)):
            rows.append((c, rng.choice([t, t, t, 3 * t, None]), rng.choice(roles), rng.choice(texts), 1, "b", 2))
    rows += [(70, 0, "user", "Hi.", 1, "b", 2)] * 300 + [(71, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.", 1, "b", 2) for t in range(500)]
    dropped = next(i for i in range(100, 10_000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    return spark.createDataFrame([*rows, (dropped, 0, "user", "Gone.", 1, "b", 2), *[(dropped + 0, 0, "user", "Gone.", 1, "b", 2)] * 9], TURNS)


@pytest.mark.parametrize("block", [4096, 7, 2])
def test_repair_equals_sql(spark, turns, block):
    same(conversations.report(conversations.damaged(turns), block=block).toPandas(),
         duck(conversations.ORACLE_SQL, conversations=turns.select("conv_id", "turn", "role", "text").toArrow()))


def test_repair_of_given_table_and_empty(spark, turns):
    d = spark.read.parquet(f"{SF}/conversations.parquet")
    same(conversations.report(conversations.damaged(d)).toPandas(), duck(conversations.ORACLE_SQL, conversations=d.toArrow()))
    assert conversations.report(conversations.damaged(turns.limit(0))).count() == 0


@pytest.mark.parametrize("block", [4096, 5])
def test_repaired_turns_are_well_formed_and_have_the_reported_digest(turns, block):
    rows = conversations.as_given(turns)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in conversations.report(rows, block=block).collect()}
    found = {}
    for r in conversations.repaired(rows, block=block).orderBy("pos", "part").collect():
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for c, digest in digests.items():
        said = found.get(c, [])
        initials = "".join(role[0] for role, _ in said)
        rest = initials.removeprefix("s")
        assert rest == "ua" * (len(rest) // 2) and (rest or not initials)
        assert hashlib.sha256("\n".join(f"{role}:{text}" for role, text in said).encode()).hexdigest() == digest


# ------------------------------------------------------------------ components, large families

def test_components_of_a_path_in_order_and_of_a_star(spark):
    path = [(i, i + 1) for i in range(1000)]
    star = [(5000, 5000 + i) for i in range(1, 300)] + [(7000 - i, 7000) for i in range(1, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(path + star + [(9000, 9000)], "a long, b long")).collect()}
    assert {v for k, v in got.items() if k <= 1000} == {0} and len([k for k in got if k <= 1000]) == 1001
    assert {v for k, v in got.items() if 5000 <= k < 6000} == {5000} and {v for k, v in got.items() if 6000 <= k <= 7000} == {6701}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_families_are_cut_by_shingles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in rng.integers(0, 5000, 600)]
    rows = []
    for i in range(40):
        words = list(base)
        for k in rng.integers(0, 600, 6):
            words[k] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"y{v}" for v in rng.integers(0, 5000, 600))) for i in range(5)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, ngram_join.ngram_components(d).collect()))
    assert sum(r[2] == 0 for r in want) >= 35
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 3000)  # about five sets
    assert sorted(map(tuple, ngram_join.ngram_components(d).collect())) == want
