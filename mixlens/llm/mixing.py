"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

Method. The words of a source are cut into equal blocks of ``block_words``, or fewer where the least
target holds under ``LEAST_BLOCKS`` of them. All blocks of the mix go to the sources by highest quotients
(target / 1, 3, 5, ...); each source's blocks go in the same way to its groups of shards, by size, and
each group's to its shards (one group up to ``shards_per_group`` shards). A shard is a hash class of about
``docs_per_shard`` documents, laid end to end in seeded order, and its quota takes the
first blocks of that order, after as many whole passes over the shard as the quota holds.
So a document is taken whole once or several times, and at most one document of a shard
is cut.

Everything is DataFrame code. The only wide steps run on narrow rows (no text). Rows equal in source, id
and size are one row with a count, so however many rows share an id (or have none), a shard's window holds its
distinct ids and sizes; the counted rows are dealt out again afterwards, in chunks. Windows over shares
hold all sources, one source's groups or one group's shards.

Cases: NULL or empty texts have size 0 and take nothing. A NULL source is a source of its
own, last in order. Repeated rows count as documents of their own; rows equal in id
and size are numbered where a cut falls among them, so one of them is cut. An empty table gives an empty mix. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlens.llm.common import SPACE, WORD, seeded_order, stored, tasks_for, word_count

SEED = 17
BLOCK_WORDS = 16
DOCS_PER_SHARD = 1024
SHARDS_PER_GROUP = 4096
#: The source of least target gets so many blocks, if it has so many words.
LEAST_BLOCKS = 32
#: Rows counted as one are dealt out in chunks of so many.
CHUNK_ROWS = 100_000
#: Up to so many rows (of under 100 bytes) a table of sources or shards is broadcast.
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame) -> DataFrame:
    """Mark a stored table for broadcast if its row count is within the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def source_targets(sizes: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """One row per source: rank, size, documents, weight and target.

    Targets fill up like water: the excess above ``cap`` times a source's size is shared
    again by weight, which ends at ``min(cap * size, level * weight)`` for one level.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"))
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    per = per.withColumn("ratio", F.col("most") / F.col("weight"))
    order = Window.orderBy("ratio", "rank")
    everything = Window.partitionBy()
    per = per.withColumns({
        "total": F.sum("source_size").over(everything),
        "full": F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "rest": F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    per = per.withColumn("level", (F.col("total") - F.col("full")) / F.col("rest"))
    fits = F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))
    per = per.withColumn("level", F.min(fits).over(everything)["level"])
    target = F.least(F.col("most"), F.col("level") * F.col("weight"))
    return per.withColumn("target", target).select("source", "rank", "source_size", "docs", "weight", "target", "total")


def highest_quotients(parties: DataFrame, *, votes: str, seats: Column, total: str, parties_in_house: Column,
                      house: Sequence[str], tie: str, out: str) -> DataFrame:
    """Sainte-Lague: add ``out``, the seats of each party, ``seats`` per house in all.

    A seat's quotient is votes / (2k + 1). Seats far below a party's exact share are won and
    far above are lost for sure, so only those near it are ranked: the share plus or minus
    (the party's part of the house's party count, plus 2), about 7 quotients a party.
    """
    p = parties.withColumn("__share", F.when(F.col(total) > 0, F.col(votes) / F.col(total)).otherwise(F.lit(0.0)))
    exact, slack = F.col("__share") * seats, F.ceil(F.col("__share") * parties_in_house) + 2
    p = p.withColumn("__low", F.greatest(F.lit(0), F.floor(exact) - slack).cast("long")) \
        .withColumn("__high", (F.floor(exact) + slack).cast("long"))
    per_house = Window.partitionBy(*house)
    p = p.withColumn("__open", seats - F.sum("__low").over(per_house))
    seat = p.withColumn("__k", F.explode(F.sequence("__low", "__high")))
    seat = seat.withColumn("__q", F.col(votes) / (F.col("__k") * 2 + 1))
    place = F.row_number().over(per_house.orderBy(F.col("__q").desc(), F.col(tie), F.col("__k")))
    won = ((place <= F.col("__open")) & (F.col(votes) > 0)).cast("long")
    return (seat.withColumn("__won", won).groupBy(*parties.columns, "__low")
            .agg(F.sum("__won").alias("__won")).withColumn(out, F.col("__low") + F.col("__won"))
            .drop("__low", "__won"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (1.0, 2.0, 3.0), cap: int = 3, block_words: int = BLOCK_WORDS,
        docs_per_shard: int = DOCS_PER_SHARD, shards_per_group: int = SHARDS_PER_GROUP, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    rows, cuts = _plan(docs, id_col, text_col, source_col, weights, cap, block_words, docs_per_shard, shards_per_group, seed)
    rows = each_row(rows.join(small_side(cuts), ["rank", "shard"]))
    end = F.col("end") - (F.col("n") - F.col("among")) * F.col("size")
    part = F.greatest(F.lit(0), F.least(end, F.col("part")) - (end - F.col("size")))
    return (rows
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("passes") * F.col("size") + part).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    weights: Sequence[float] = (1.0, 2.0, 3.0), cap: int = 3, block_words: int = BLOCK_WORDS,
                    docs_per_shard: int = DOCS_PER_SHARD, shards_per_group: int = SHARDS_PER_GROUP, seed: int = SEED) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each copy that is taken; a cut
    copy holds the first words that fall into the quota. Texts are not shuffled: a shard's
    quota is a position in seeded order, which each document compares with its own."""
    rows, cuts = _plan(docs, id_col, text_col, source_col, weights, cap, block_words, docs_per_shard, shards_per_group, seed)
    start = F.col("end") - F.col("n") * F.col("size")
    inside = (F.col("end") > F.col("part")) & (start <= F.col("part"))
    at = (rows.join(small_side(cuts), ["rank", "shard"]).where(inside)
          .withColumn("among", F.floor((F.col("part") - start) / F.col("size")).cast("long") + 1)
          .withColumn("end", start + F.col("among") * F.col("size"))
          .groupBy("rank", "shard").agg(F.min(F.struct("place", "doc_id", "size", "end", "among", F.col("n").alias("equals"))).alias("cut")))
    quota = stored(cuts.join(at, ["rank", "shard"], "left"), "mix-quota")
    ranks = small_side(stored(rows.select("source", "rank", "shards").distinct(), "mix-ranks"))
    own = {"__size": word_count(F.col(text_col)), "__place": seeded_order(F.col(id_col), seed)}
    d = docs.withColumns(own).join(ranks.withColumnsRenamed({"source": "__source", "rank": "__rank", "shards": "__shards"}),
                                   F.col(source_col).cast("string").eqNullSafe(F.col("__source")))
    d = d.withColumn("__shard", F.pmod("__place", "__shards").cast("long"))
    q = small_side(quota.select(F.col("rank").alias("__rank"), F.col("shard").alias("__shard"),
                                F.struct("passes", "part", "cut").alias("__q")))
    d = d.join(q, ["__rank", "__shard"])
    key = F.struct(F.col("__place").alias("place"), F.col(id_col).cast("long").alias("doc_id"), F.col("__size").alias("size"))
    c = F.col("__q.cut")
    at_cut = c.isNotNull() & (key == F.struct(c["place"], c["doc_id"], c["size"]))
    if quota.where("cut.equals > 1").isEmpty():
        d = d.withColumn("__among", c["among"])
    else:
        # Rows equal in the key are numbered like those of the plan, in the shards cut among such rows only.
        tied = F.coalesce(at_cut & (c["equals"] > 1), F.lit(False))
        number = F.row_number().over(Window.partitionBy("__rank", "__shard").orderBy(F.xxhash64(text_col)))
        d = d.where(~tied).withColumn("__among", c["among"]).unionByName(d.where(tied).withColumn("__among", number))
    before = c.isNull() | (key < F.struct(c["place"], c["doc_id"], c["size"])) | at_cut & (F.col("__among") < c["among"])
    at_cut = at_cut & (F.col("__among") == c["among"])
    words = F.when(F.col("__q.part") <= 0, F.lit(0)).when(before, F.col("__size")) \
        .when(at_cut, F.col("__q.part") - (c["end"] - c["size"])).otherwise(F.lit(0)).cast("int")
    d = d.withColumn("__words", words)
    first_words = F.array_join(F.slice(F.regexp_extract_all(F.col(text_col), F.lit(f"{SPACE}*{WORD}"), F.lit(0)),
                                       F.lit(1), F.greatest(F.lit(1), F.col("__words"))), "")
    part = F.when(F.col("__words") <= 0, F.array().cast("array<string>")) \
        .when(F.col("__words") >= F.col("__size"), F.array(F.col(text_col))).otherwise(F.array(first_words))
    copies = F.concat(F.array_repeat(F.col(text_col), F.col("__q.passes").cast("int")), part)
    d = d.withColumn("__copy", F.explode(F.when(F.col("__size") > 0, copies)))
    out = {text_col: F.col("__copy")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.length("__copy").cast(docs.schema["n_chars"].dataType)
    return d.withColumns(out).select(*docs.columns)


def each_row(counted: DataFrame) -> DataFrame:
    """A row for each of the ``n`` that a row stands for, numbered from 1 in ``among``."""
    if counted.where(F.col("n") > CHUNK_ROWS).isEmpty():
        return counted.withColumn("among", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    chunks = counted.withColumn("__from", F.explode(F.sequence(F.lit(1).cast("long"), "n", F.lit(CHUNK_ROWS).cast("long"))))
    chunks = chunks.repartition(tasks_for(counted), "rank", "shard", "place", "size", "__from")
    last = F.least(F.col("n"), F.col("__from") + CHUNK_ROWS - 1)
    return chunks.withColumn("among", F.explode(F.sequence(F.col("__from"), last))).drop("__from")


def _plan(docs, id_col, text_col, source_col, weights, cap, block_words, docs_per_shard, shards_per_group, seed):
    """Rows (one per source, id and size: how many documents, their place and the words up to the end of
    the last in their shard) and cuts (one per shard: whole passes, and the words of the partial one)."""
    sizes = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                        word_count(F.col(text_col)).alias("size"), seeded_order(F.col(id_col), seed).alias("place"))
    sizes = stored(sizes.groupBy(*sizes.columns).agg(F.count("*").alias("n")), "mix-sizes")
    targets = source_targets(sizes, weights, cap)
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(Window.partitionBy())
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(least / LEAST_BLOCKS))).cast("long")
    shards = F.greatest(F.lit(1), F.ceil(F.col("docs") / docs_per_shard)).cast("long")
    targets = targets.withColumns({"block": block, "shards": shards})
    sources = highest_quotients(targets, votes="target", seats=F.round(F.col("total") / F.col("block")).cast("long"),
                                total="total", parties_in_house=F.count("*").over(Window.partitionBy()), house=(),
                                tie="rank", out="blocks")
    groups = F.ceil(F.col("shards") / shards_per_group).cast("long")
    sources = stored(sources.withColumn("groups", groups), "mix-sources")
    named = sources.select(F.col("source").alias("__source"), "rank", "source_size", "target", "shards")
    rows = (sizes.join(small_side(named), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
            .withColumn("shard", F.pmod("place", "shards").cast("long")))
    order = Window.partitionBy("rank", "shard").orderBy("place", "doc_id", "size")
    words = F.col("size") * F.col("n")
    end = F.sum(words).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    per_shard = rows.groupBy("rank", "shard").agg(F.sum(words).alias("words"))
    per_shard = per_shard.join(small_side(sources.select("rank", "source_size", "blocks", "block", "groups")), "rank")
    per_shard = stored(per_shard.withColumn("group", F.pmod("shard", "groups").cast("long")), "mix-shards")
    house = ("rank", "group", "source_size", "blocks", "block", "groups")
    per_group = per_shard.groupBy(*house).agg(F.sum("words").alias("group_words"), F.count("*").alias("group_shards"))
    per_group = highest_quotients(per_group, votes="group_words", seats=F.col("blocks"), total="source_size",
                                  parties_in_house=F.col("groups"), house=("rank",), tie="group", out="group_blocks")
    quotas = per_shard.select("rank", "group", "shard", "words").join(
        small_side(stored(per_group.select("rank", "group", "block", "group_words", "group_shards", "group_blocks"), "mix-groups")),
        ["rank", "group"])
    quotas = highest_quotients(quotas, votes="words", seats=F.col("group_blocks"), total="group_words",
                               parties_in_house=F.col("group_shards"), house=("rank", "group"), tie="shard", out="quota")
    blocks = F.greatest(F.lit(1), F.round(F.col("words") / F.col("block"))).cast("long")
    q = quotas.withColumn("blocks", blocks).withColumn("passes", F.floor(F.col("quota") / F.col("blocks")).cast("long"))
    whole = F.col("passes") >= cap
    part = F.floor(F.col("words") * (F.col("quota") - F.col("passes") * F.col("blocks")) / F.col("blocks")).cast("long")
    cuts = stored(q.select("rank", "shard", F.when(whole, F.lit(cap)).otherwise(F.col("passes")).cast("long").alias("passes"),
                           F.when(whole, F.lit(0)).otherwise(part).cast("long").alias("part")), "mix-cuts")
    return rows.withColumn("end", end), cuts


def oracle_sql(weights=(1, 2, 3), cap: int = 3, block_words: int = BLOCK_WORDS, docs_per_shard: int = DOCS_PER_SHARD,
               shards_per_group: int = SHARDS_PER_GROUP, seed: int = SEED) -> str:
    """The same mix as DuckDB SQL, with every seat's quotient written out and ranked."""
    w = "[" + ", ".join(f"{float(x)}::DOUBLE" for x in weights) + "]"
    return f"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
  ('0x' || substr(md5('{seed}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS place FROM documents),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS docs FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM per),
wt AS (SELECT *, ({w})[CAST((rk - 1) % {len(weights)} + 1 AS INT)] AS w, source_size * {float(cap)}::DOUBLE AS most FROM r),
lv AS (SELECT *, most / w AS ratio, CAST(sum(source_size) OVER () AS BIGINT) AS total,
  coalesce(sum(most) OVER (ORDER BY most / w, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
  sum(w) OVER (ORDER BY most / w, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM wt),
lev AS (SELECT arg_min((total - full_) / rest, ratio * 1e6 + rk) AS level FROM lv WHERE (total - full_) / rest <= ratio),
t AS (SELECT lv.*, least(most, level * w) AS target,
  CAST(greatest(1, ceil(docs / {float(docs_per_shard)})) AS BIGINT) AS shards FROM lv, lev),
blk AS (SELECT CAST(greatest(1, least({block_words}, floor(min(target) / {LEAST_BLOCKS}))) AS BIGINT) AS b FROM t WHERE target > 0),
seat AS (SELECT rk, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rk, k) AS pos, total
  FROM (SELECT *, unnest(range(0, CAST(floor(target / (SELECT b FROM blk)) AS BIGINT) + 3 + (SELECT count(*) FROM t))) AS k FROM t WHERE target > 0)),
won AS (SELECT rk, count(*) AS blocks FROM seat WHERE pos <= CAST(round(total / CAST((SELECT b FROM blk) AS DOUBLE)) AS BIGINT) GROUP BY rk),
x AS (SELECT d.*, t.rk, t.source_size, t.target, t.shards, coalesce(won.blocks, 0) AS blocks, d.place % t.shards AS shard
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN won ON won.rk = t.rk),
sh AS (SELECT rk, shard, CAST(sum(size) AS BIGINT) AS words, any_value(source_size) AS source_size, any_value(blocks) AS blocks,
  shard % CAST(ceil(any_value(shards) / {float(shards_per_group)}) AS BIGINT) AS grp FROM x GROUP BY rk, shard),
gr AS (SELECT rk, grp, CAST(sum(words) AS BIGINT) AS words, any_value(source_size) AS source_size, any_value(blocks) AS blocks,
  count(*) AS shards, count(*) OVER (PARTITION BY rk) AS grps FROM sh GROUP BY rk, grp),
gseat AS (SELECT rk, grp, blocks, row_number() OVER (PARTITION BY rk ORDER BY words / (2 * k + 1) DESC, grp, k) AS pos
  FROM (SELECT *, unnest(range(0, CAST(floor(blocks * words / source_size) AS BIGINT) + 3 + grps)) AS k FROM gr WHERE words > 0)),
gq AS (SELECT rk, grp, count(*) FILTER (WHERE pos <= blocks) AS blocks FROM gseat GROUP BY rk, grp),
sseat AS (SELECT rk, shard, blocks, row_number() OVER (PARTITION BY rk, grp ORDER BY words / (2 * k + 1) DESC, shard, k) AS pos
  FROM (SELECT sh.rk, sh.grp, sh.shard, sh.words, gq.blocks,
    unnest(range(0, CAST(floor(gq.blocks * sh.words / gr.words) AS BIGINT) + 3 + gr.shards)) AS k
    FROM sh JOIN gr USING (rk, grp) JOIN gq USING (rk, grp) WHERE sh.words > 0)),
q AS (SELECT rk, shard, count(*) FILTER (WHERE pos <= blocks) AS quota FROM sseat GROUP BY rk, shard),
c AS (SELECT sh.rk, sh.shard, sh.words, coalesce(q.quota, 0) AS quota,
  CAST(greatest(1, round(sh.words / CAST((SELECT b FROM blk) AS DOUBLE))) AS BIGINT) AS n FROM sh LEFT JOIN q USING (rk, shard)),
cut AS (SELECT rk, shard, least({cap}, quota // n) AS passes,
  CASE WHEN quota // n >= {cap} THEN 0 ELSE CAST(floor(words * (quota - (quota // n) * n) / n) AS BIGINT) END AS part FROM c),
e AS (SELECT x.*, sum(size) OVER (PARTITION BY rk, shard ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) AS fin FROM x)
SELECT e.doc_id, e.source, e.size, e.source_size, e.target,
  CAST(cut.passes * e.size + greatest(0, least(e.fin, cut.part) - (e.fin - e.size)) AS BIGINT) AS taken
FROM e JOIN cut USING (rk, shard)"""
