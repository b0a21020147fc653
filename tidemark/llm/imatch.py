"""I-Match fingerprints: hashes of the mid-frequency terms of a document, once per random lexicon.

Terms whose share of all documents lies in a band make the lexicon. A
fingerprint has one part for each random subset of the lexicon: the hash of the
document's distinct terms in that subset, sorted. Two documents that differ in a
few terms still agree on the subsets that those terms are not in, so the share
of equal parts tells how alike they are. Subsets of several sizes serve short and
long documents. DataFrame functions only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

PARTS = 64
#: Part r keeps a term with the chance SHARES[r % 6] / 4096.
SHARES = (128, 64, 32, 16, 8, 4)
#: The band: shares of all documents that a lexicon term stands in, ends included. A document has so many distinct
#: terms on average, T; the lexicon then has at most T / LEAST terms, however many documents there are.
LEAST = 0.001
MOST = 0.3
#: What stands between terms.
BETWEEN = r"[^\p{L}\p{N}]+"
#: Hexadecimal digits of a part, and what stands for a part without terms.
DIGITS = 4
NOTHING = "-" * DIGITS
#: Documents that stand in order in one task, about.
ORDERED = 50_000


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, and always the empty one, which stands for the document."""
    return F.array_union(F.split(F.lower(text), BETWEEN), F.array(F.lit("")))


def digests(term: Column) -> Column:
    """Hashes of a term one after another; each gives three hexadecimal digits to ten parts."""
    return F.concat(*(F.md5(F.concat(F.lit(f"{i}:"), term).cast("binary")) for i in range(-(-PARTS // 10))))


def subset_mask(hashes: Column) -> Column:
    """Bit r says whether part r keeps the term: its three digits, read as a number, are below the part's share."""
    bits = [
        F.when(F.substring(hashes, 1 + 32 * (part // 10) + 3 * (part % 10), 3) < f"{SHARES[part % len(SHARES)]:03x}", F.lit(1 << part if part < 63 else -(1 << 63)))
        .otherwise(F.lit(0))
        .cast("bigint")
        for part in range(PARTS)
    ]
    return reduce(Column.bitwiseOR, bits)


def lexicon(docs: DataFrame, text: str = "text", least: float = LEAST, most: float = MOST) -> DataFrame:
    """(term, mask) of the terms in the band over all documents that any part keeps, and the empty term.

    Every row of ``docs`` counts as a document, null texts too.
    """
    count = docs.count()
    terms = docs.select(F.explode(terms_of(F.coalesce(F.col(text), F.lit("")))).alias("term")).where("term <> ''")
    band = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") >= least * count) & (F.col("n") <= most * count))
    # Written first, so that each hash is made once and not once for every part.
    band = materialize(band.select("term", digests(F.col("term")).alias("hashes")), "band")
    kept = band.select("term", subset_mask(F.col("hashes")).alias("mask")).where("mask <> 0")
    return kept.unionByName(docs.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(0).cast("bigint").alias("mask")))


def parts_of(kept: Column) -> Column:
    """The parts of a fingerprint from the sorted (term, mask) pairs of a document; null for a part without terms."""

    def terms(part: int) -> Column:
        return F.transform(F.filter(kept, lambda t: F.getbit(t["mask"], F.lit(part)) == 1), lambda t: t["term"])

    return F.array(*(F.nullif(F.concat_ws(" ", terms(part)), F.lit("")) for part in range(PARTS)))


def hashed(parts: Column) -> Column:
    return F.transform(parts, lambda p: F.substring(F.md5(p.cast("binary")), 1, DIGITS))


def likeness(a: Column, b: Column) -> Column:
    """Equal parts over parts that either document has; null where neither has any."""
    pairs = F.zip_with(a, b, lambda x, y: F.when(x.isNull() & y.isNull(), F.lit(None)).otherwise(F.coalesce(x == y, F.lit(False)).cast("int")))
    total = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("same"), F.lit(0).alias("all")),
        lambda s, p: F.struct((s["same"] + F.coalesce(p, F.lit(0))).alias("same"), (s["all"] + p.isNotNull().cast("int")).alias("all")),
    )
    return F.when(total["all"] > 0, total["same"].cast("double") / total["all"])


def written(parts: Column, digest: Column) -> Column:
    """A fingerprint as text: its parts one after another; without any part the MD5 of the whole text."""
    return F.when(F.exists(parts, lambda p: p.isNotNull()), F.concat_ws("", F.transform(parts, lambda p: F.coalesce(p, F.lit(NOTHING))))).otherwise(digest)


def fingerprints(texts: DataFrame, keys: list[str], bodies: dict[str, str], words: DataFrame, carried: Column) -> DataFrame:
    """(keys, ``carried`` as a struct ``_info``, one array of hashed parts for each of ``bodies`` {column: name}).

    ``keys`` tell the rows of ``texts`` apart. The lexicon goes to every task,
    which its band allows; the terms of a row meet again in the task that has the row,
    if ``texts`` is partitioned by some of the keys.
    """
    each = texts.withColumn("_info", carried)
    each = each.select(*keys, "_info", F.explode(F.array(*(F.struct(F.lit(i).alias("kind"), F.col(c).alias("body")) for i, c in enumerate(bodies)))).alias("_b"))
    each = each.select(*keys, F.when(F.col("_b.kind") == 0, F.col("_info")).alias("_info"), F.col("_b.kind").alias("_kind"), F.explode(terms_of(F.col("_b.body"))).alias("term"))
    each = each.join(F.broadcast(words), "term")
    pair = F.struct("term", "mask")
    met = each.select(*keys, F.when(F.col("term") == "", F.col("_info")).alias("_info"), "_kind", "term", "mask").groupBy(*keys).agg(
        F.any_value("_info", F.lit(True)).alias("_info"),
        *(F.sort_array(F.collect_list(F.when((F.col("_kind") == i) & (F.col("mask") != 0), pair))).alias(name) for i, name in enumerate(bodies.values())),
    )
    return met.select(*keys, "_info", *(hashed(parts_of(F.col(name))).alias(name) for name in bodies.values()))


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(bucket, place, extra, key, text) in which the row after any row, by key and then text, is the next of its bucket.

    Buckets are ranges of keys. The first row of each is also the last, as an
    ``extra`` row, of the bucket before it, and the first of all that of the last. Null keys come first.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    count, nulls = rows.agg(F.count(F.lit(1)), F.count_if(F.col("key").isNull())).first()
    wanted = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(count / ORDERED))
    ranks = [i / wanted for i in range(wanted)]
    cuts = rows.agg(F.percentile_approx("key", F.array(*map(F.lit, ranks)), F.lit(max(10_000, 10 * wanted)))).first()[0] if count > nulls else []
    if cuts:
        cuts = sorted({*cuts, rows.agg(F.min("key")).first()[0]})
    step = max(1, math.isqrt(len(cuts)))
    listed, coarse = F.array(*map(F.lit, cuts)).cast("array<bigint>"), F.array(*map(F.lit, cuts[::step])).cast("array<bigint>")
    # Cuts at or below the key, counted in two steps; 0 for a null key.
    jumps = F.size(F.filter(coarse, lambda c: c <= F.col("_k")))
    bucket = F.when(jumps == 0, 0).otherwise((jumps - 1) * step + F.size(F.filter(F.slice(listed, (jumps - 1) * step + 1, F.lit(step)), lambda c: c <= F.col("_k"))))
    rows = rows.withColumn("_k", F.col("key").cast("bigint")).withColumn("bucket", F.when(F.col("_k").isNull(), 0).otherwise(bucket))
    begins = (F.col("bucket") > 0) & (F.element_at(listed, F.greatest(F.col("bucket"), F.lit(1))) == F.col("_k")) if cuts else F.lit(False)
    rows = rows.withColumn("extra", F.explode(F.when(begins, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    rows = rows.select((F.col("bucket") - F.col("extra")).alias("bucket"), "extra", "key", "text")
    first = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).where(F.col("key").isNull() if nulls else F.col("key") == (cuts[0] if cuts else None))
    first = first.orderBy("text").limit(1).select(F.lit(len(cuts)).alias("bucket"), F.lit(2).alias("extra"), "key", "text")
    rows = rows.unionByName(first)
    order = Window.partitionBy("bucket").orderBy("extra", F.col("key").asc_nulls_first(), "text")
    return rows.withColumn("place", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))


def compared(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    Edited: the last quarter of the characters, rounded down, gives way to as
    many from the start of the next text (or all of it). Rows stand in the order
    of their keys (null first), rows of one key in that of their texts; after the
    last comes the first, which for a single row is itself. A null text counts as
    empty: it has no parts, its fingerprint is the MD5 of nothing, and it is like
    itself. Columns other than ``key`` and ``text`` are not read. No rows give no rows.
    """
    words = materialize(lexicon(docs, text), "lexicon")
    rows = in_order(docs, key, text)
    length = F.length("text")
    quarter = F.floor(length / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), length - quarter), F.substring(F.coalesce(F.col("next"), F.lit("")), F.lit(1), quarter))
    rows = rows.withColumn("edited", edited)
    info = F.struct(
        F.col("extra").alias("extra"),
        F.col("key").alias("key"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"),
        F.md5(F.col("edited").cast("binary")).alias("edited_md5"),
    )
    marked = fingerprints(rows, ["bucket", "place"], {"text": "parts", "edited": "edited_parts"}, words, info)
    order = Window.partitionBy("bucket").orderBy("place")
    marked = marked.withColumns({"next_parts": F.lead("parts").over(order), "next_md5": F.lead("_info.text_md5").over(order)})
    same = lambda other, digest: F.coalesce(likeness(F.col("parts"), F.col(other)), (F.col("_info.text_md5") == digest).cast("double"))
    return marked.where("_info.extra = 0").select(
        F.col("_info.key").alias(key),
        F.col("_info.n_chars").alias("n_chars"),
        F.col("_info.edited_sha256").alias("edited_sha256"),
        written(F.col("parts"), F.col("_info.text_md5")).alias("fingerprint"),
        written(F.col("edited_parts"), F.col("_info.edited_md5")).alias("edited_fingerprint"),
        same("edited_parts", F.col("_info.edited_md5")).alias("near_edited"),
        same("next_parts", F.col("next_md5")).alias("near_next"),
    )


def _oracle() -> str:
    bits = " | ".join(
        f"(case when substr(md5('{r // 10}:' || term), {1 + 3 * (r % 10)}, 3) < '{SHARES[r % len(SHARES)]:03x}' then {1 << r}::hugeint else 0::hugeint end)"
        for r in range(PARTS)
    )
    return f"""
with docs as (select doc_id, coalesce(text, '') as text, row_number() over (order by doc_id nulls first, coalesce(text, '')) as k, count(*) over () as n from documents),
nexts as (select a.*, b.text as follower from docs a join docs b on b.k = a.k % a.n + 1),
texts as (select *, text[1:length(text) - length(text) // 4] || case when length(text) >= 4 then follower[1:length(text) // 4] else '' end as edited from nexts),
cut as (select k, list_distinct(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) as a,
  list_distinct(regexp_split_to_array(lower(edited), '[^\\p{{L}}\\p{{N}}]+')) as b from texts),
band as (select term from (select unnest(a) as term from cut) where term <> '' group by term
  having count(*) >= {LEAST} * (select count(*) from docs) and count(*) <= {MOST} * (select count(*) from docs)),
masks as (select term, {bits} as mask from band),
rows_of as (select k, 0 as kind, unnest(a) as term from cut union all select k, 1, unnest(b) from cut),
pieces as (select k, kind, r, substr(md5(string_agg(term, ' ' order by term collate "C")), 1, {DIGITS}) as piece
  from rows_of join masks using (term) join range({PARTS}) p(r) on (mask >> r::int) & 1 = 1 group by all),
prints as (select k, kind, map(list(r), list(piece)) as m from pieces group by all),
whole as (select t.*, [a.m[r] for r in range({PARTS})] as p, [b.m[r] for r in range({PARTS})] as e
  from texts t left join prints a on a.k = t.k and a.kind = 0 left join prints b on b.k = t.k and b.kind = 1),
follow as (select w.*, v.p as f, v.text as ftext from whole w join whole v on v.k = w.k % w.n + 1),
tallied as (select *, len([1 for i in range({PARTS}) if p[i + 1] is not null or e[i + 1] is not null]) as ne,
  len([1 for i in range({PARTS}) if p[i + 1] is not null or f[i + 1] is not null]) as nf from follow)
select doc_id, length(text)::bigint as n_chars, sha256(edited) as edited_sha256,
  case when len([1 for x in p if x is not null]) > 0 then list_aggregate([coalesce(x, '{NOTHING}') for x in p], 'string_agg', '') else md5(text) end as fingerprint,
  case when len([1 for x in e if x is not null]) > 0 then list_aggregate([coalesce(x, '{NOTHING}') for x in e], 'string_agg', '') else md5(edited) end as edited_fingerprint,
  case when ne > 0 then len([1 for i in range({PARTS}) if p[i + 1] = e[i + 1]]) / ne::double else (text = edited)::int::double end as near_edited,
  case when nf > 0 then len([1 for i in range({PARTS}) if p[i + 1] = f[i + 1]]) / nf::double else (text = ftext)::int::double end as near_next
from tallied
"""


ORACLE = _oracle()
