"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words. Whole copies that every document of
the source is sure of are dealt first; what is left is a sample of fixed size in
each size class of the source. In a class of which n are taken, a document's
chance grows with its words; documents are ranked by random odds over the odds
of that chance, and the n first are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import fresh, positions
from tidemark.session import materialize

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix"
#: Rows of one class of a source meet its figures in so many tasks, however many they are.
SALTS = 16


def targets(sources: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """Sources (source, source_size) with ``target``: shares by weight, at most ``most`` times the source.

    Weights repeat over the sources by code point, null last. Together the
    targets make ``share`` of all words; what a full source cannot take goes to
    the others by weight, again until none is above its limit. Each round reads
    one row of sums, and fills at least one source more.
    """
    ranked = positions(sources, [F.col("source").asc_nulls_last()], "_at")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_at") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumns({"_weight": weight, "_most": F.col("source_size") * float(most)}), "mix-sources")
    total = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        above = F.col("_most") <= F.col("_weight") * F.lit(level)
        capped, free, now = ranked.agg(
            F.coalesce(F.sum(F.when(above, F.col("_most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0.0)),
            F.count_if(above),
        ).first()
        if now == full or not free:
            break
        level, full = (total - capped) / free, now
    return ranked.select("source", "source_size", F.least(F.col("_weight") * F.lit(level), F.col("_most")).alias("target"))


def size_class(size: str) -> Column:
    """Four classes to each doubling; whole numbers only, so every engine agrees."""
    bits = f"length(bin({size}))"
    return F.expr(f"cast({bits} * 4 + shiftright({size}, greatest({bits} - 3, 0)) % 4 as int)")


def taken_per_class(classes: DataFrame) -> DataFrame:
    """Classes (source, class, n, words, squares, share) with ``take``: how many units of each are sampled.

    From the largest class down; what rounding leaves over or under is carried
    to the next smaller class, so a source ends within about half a small
    document of its target. A source has at most 256 classes.
    """
    listed = classes.groupBy("source").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("class")).alias("order"), "n", "words", "squares", "share"))).alias("_all")
    )
    fold = """
      aggregate(_all, named_struct('left', 0D, 'takes', cast(array() as array<struct<class:int,take:bigint>>)),
        (s, c) -> named_struct(
          'left', s.left + c.share * c.words
            - least(greatest(floor((s.left + c.share * c.words) * c.words / c.squares + 0.5D), 0), c.n) * c.squares / c.words,
          'takes', concat(s.takes, array(named_struct('class', -c.order, 'take',
            cast(least(greatest(floor((s.left + c.share * c.words) * c.words / c.squares + 0.5D), 0), c.n) as bigint))))))"""
    return listed.select("source", F.explode(F.expr(fold)["takes"]).alias("_take")).select("source", "_take.class", "_take.take")


def with_class(rows: DataFrame, classes: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` (source, _class) with the figures of their class (_source, _of), of which each salt has a copy."""
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
    classes = classes.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_class") == F.col("_of")) & (F.col("_salt") == F.col("_copy"))
    return rows.join(classes, same, how).drop("_salt", "_copy")


def unit_draw() -> Column:
    """A number in (0, 1) that depends on the document's id and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def plan(docs: DataFrame, share: float = SHARE, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """How often the mix takes each document: (doc_id, source, size, rows, source_size, target, copies).

    One row per distinct (doc_id, source, size); ``rows`` says how many rows of
    ``docs`` it stands for, which are taken alike. Size is the number of words,
    0 for a null or empty text; such documents get the sure copies only. A null
    source is a source of its own. ``copies`` is at most ``most`` rounded up,
    and a source's copies times words come near its target. The draw depends on
    the id alone, so reruns agree. No rows give no rows.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint")
    units = docs.select("doc_id", "source", words.alias("size")).groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    units = materialize(units, "mix-units")
    unit_words = F.col("size") * F.col("rows")
    aims = targets(units.groupBy("source").agg(F.sum(unit_words).alias("source_size")), share, weights, most)
    aims = aims.withColumn("_ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    aims = materialize(aims.withColumn("_sure", F.floor("_ratio")).withColumn("_share", F.col("_ratio") - F.col("_sure")), "mix-targets")

    aim = aims.withColumnRenamed("source", "_source")
    classed = units.withColumn("_words", unit_words).withColumn("_class", size_class("_words"))
    classes = classed.where("_words > 0").groupBy("source", F.col("_class").alias("class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_words").alias("words"), F.sum(F.col("_words").cast("double") * F.col("_words")).alias("squares")
    )
    classes = classes.join(aim, F.col("source").eqNullSafe(F.col("_source"))).withColumn("share", F.col("_share"))
    takes = classes.drop("_source").join(
        taken_per_class(classes).select(F.col("source").alias("_source"), F.col("class").alias("_class"), "take"),
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("class") == F.col("_class")),
    )
    takes = takes.select(
        F.col("source").alias("_source"), F.col("class").alias("_of"), "take", F.col("words").alias("_sum"), "source_size", "target", "_sure"
    )
    drawn = with_class(classed, takes, "left")
    # Documents without words belong to no class; their source's figures come from the targets.
    bare = drawn.where("_of is null").drop(*takes.columns).join(aim, F.col("source").eqNullSafe(F.col("_source"))).withColumn("copies", F.col("_sure"))
    chance = F.col("take") * F.col("_words") / F.col("_sum")
    odds = F.when(chance >= 1, F.lit(0.0)).when(chance <= 0, F.lit(float("inf"))).otherwise(F.col("_u") / (1 - F.col("_u")) / (chance / (1 - chance)))
    ranked = drawn.where("_of is not null").withColumn("_u", unit_draw()).withColumn("_rank", odds)
    ranked = positions(
        ranked.drop("_source", "_of", "_sum"),
        [F.col("source").asc_nulls_last(), F.col("_class").desc(), F.col("_rank"), F.col("doc_id"), F.col("size")],
        "_at",
    )
    first = ranked.groupBy(F.col("source").alias("_source"), F.col("_class").alias("_of")).agg(F.min("_at").alias("_first"))
    ranked = with_class(ranked, first)
    ranked = ranked.withColumn("copies", F.col("_sure") + F.when(F.col("_at") - F.col("_first") < F.col("take"), 1).otherwise(0))
    columns = ["doc_id", "source", "size", "rows", "source_size", "target", "copies"]
    return ranked.select(columns).unionByName(bare.select(columns)).withColumn("copies", F.col("copies").cast("int"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the plan takes it; rows taken no time go. Columns stay, whatever their names.

    Null and empty texts and null sources count as in :func:`plan`; rows that
    repeat id, source and size are taken alike; an empty table stays empty.
    """
    names = {n: fresh(docs, f"_mix_{n}") for n in ("doc_id", "source", "size", "copies")}
    chosen = plan(docs, **options).where("copies > 0").select(*(F.col(n).alias(to) for n, to in names.items()))
    words = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint")
    same = F.col("doc_id").eqNullSafe(F.col(names["doc_id"])) & F.col("source").eqNullSafe(F.col(names["source"])) & (words == F.col(names["size"]))
    copies = names["copies"]
    return docs.join(chosen, same).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def taken(docs: DataFrame) -> DataFrame:
    """Per document of the mix: its size, its source's size and target, and the words taken of it. Cases as in :func:`plan`."""
    planned = plan(docs).withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


ORACLE = """
with recursive sizes as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
units as (select doc_id, source, size, count(*) as n_rows, size * count(*) as words from sizes group by doc_id, source, size),
src as (select source, sum(words)::double as source_size from units group by 1),
ranked as (select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::double as w, 2.0 * source_size as most from src),
-- Full sources are those with the smallest limit per weight; the level is that of the first source under its limit.
filling as (select *, (1.5 * sum(source_size) over () - coalesce(sum(most) over (order by most / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by most / w, source nulls last rows between current row and unbounded following) as level_here from ranked),
aims as (select source, source_size, least(w * (select arg_min(level_here, most / w) from filling where most / w > level_here), most) as target
  from ranked),
ratios as (select *, case when source_size > 0 then target / source_size else 0 end as ratio from aims),
parts as (select *, floor(ratio) as sure, ratio - floor(ratio) as share from ratios),
classed as (select *, length(bin(words)) * 4 + (words >> greatest(length(bin(words)) - 3, 0)) % 4 as class from units),
classes as (select c.source, class, count(*) as n, sum(words)::double as words, sum(words::double * words) as squares, any_value(share) as share,
    row_number() over (partition by c.source order by class desc) as k
  from classed c join parts p on c.source is not distinct from p.source where words > 0 group by c.source, class),
fold as (
  select source, class, k, 0.0::double as before, least(greatest(floor(share * words * words / squares + 0.5), 0), n) as take,
    share * words - least(greatest(floor(share * words * words / squares + 0.5), 0), n) * squares / words as rest
  from classes where k = 1
  union all
  select c.source, c.class, c.k, rest, least(greatest(floor((rest + share * words) * words / squares + 0.5), 0), n),
    rest + share * words - least(greatest(floor((rest + share * words) * words / squares + 0.5), 0), n) * squares / words
  from fold f join classes c on f.source is not distinct from c.source and c.k = f.k + 1),
drawn as (select u.*, f.take, (('0x' || substr(md5('mix:' || coalesce(u.doc_id::varchar, 'null')), 1, 12))::bigint + 0.5) / 281474976710656.0 as r,
    f.take * u.words / c.words as chance
  from classed u join fold f on u.source is not distinct from f.source and u.class = f.class
  join classes c on c.source is not distinct from f.source and c.class = f.class where u.words > 0),
placed as (select *, row_number() over (partition by source, class order by
    case when chance >= 1 then 0 when chance <= 0 then 'infinity'::double else r / (1 - r) / (chance / (1 - chance)) end, doc_id, size) as place from drawn)
select s.doc_id, s.size, p.source_size::bigint as source_size, p.target,
  (s.size * (p.sure + case when d.place <= d.take then 1 else 0 end))::bigint as taken
from sizes s join parts p on s.source is not distinct from p.source
left join placed d on d.doc_id is not distinct from s.doc_id and d.source is not distinct from s.source and d.size = s.size
"""
