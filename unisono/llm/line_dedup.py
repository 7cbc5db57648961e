"""Removal of lines that stand on many sites.

A line's spread is the number of distinct sites that have it. HyperLogLog sketches of the sites, one for each line hash,
are merged by aggregation, so a line that a third of all rows share costs each task one small sketch. Lines whose
estimate lies near the limit are counted exactly. DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read_table

MIN_SITES = 5
LG_K = 12
_HASH = ["_h1", "_h2"]


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """Hashes (_h1, _h2) of the lines on at least `min_sites` distinct sites; `lines` has _h1, _h2 and _site (nulls count as no site).

    The sketch's relative standard error is 1.04 / 2^(LG_K / 2). Estimates within four of it, and at least one, of
    the limit are settled by an exact distinct count, the others by the sketch.
    """
    margin = max(1, math.ceil(4 * 1.04 / 2 ** (LG_K / 2) * min_sites))
    estimate = lines.where("_site is not null").groupBy(*_HASH).agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", LG_K)).alias("_n")).where(F.col("_n") >= min_sites - margin)
    estimate = materialize(estimate)  # used twice; a small part of all lines
    sure = estimate.where(F.col("_n") > min_sites + margin).select(*_HASH)
    near = estimate.where(F.col("_n") <= min_sites + margin).select(*_HASH)
    pairs = lines.where("_site is not null").join(near, _HASH, "left_semi").select(*_HASH, "_site").distinct()
    exact = pairs.groupBy(*_HASH).agg(F.count("*").alias("_n")).where(F.col("_n") >= min_sites).select(*_HASH)
    return sure.unionByName(exact)


def dedup_lines(docs: DataFrame, site: str = "source", text: str = "text", key: str = "doc_id", min_sites: int = MIN_SITES, min_words: int = 1, max_share: float | None = None) -> DataFrame:
    """`docs` with widely spread lines taken out of `text`, and two columns more: n_lines and n_removed.

    Lines end at newlines and are compared without spaces, tabs and returns at either end. Blank lines and lines of
    fewer than `min_words` words are left alone. A document that would lose more than `max_share` of its characters keeps all its lines; without
    a `max_share` (None) every widely spread line goes. No row is dropped. Null text stays null (no lines), an empty one is one empty line. Rows are told apart by
    key and text, so repeated rows fare alike. Columns of other names pass through; `n_lines` and `n_removed` of the input are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    row_id = F.xxhash64(F.col(key).cast("string"), F.col(text))
    line = F.btrim(F.col("_line"), F.lit(" \t\r"))
    lines = (
        docs.where(F.col(text).isNotNull())
        .select(row_id.alias("_row"), F.col(key).cast("string").alias("_key"), F.col(site).cast("string").alias("_site"), F.length(text).alias("_all"), F.posexplode(_lines(F.col(text))).alias("_at", "_line"))
        .where((line != "") & (F.regexp_count(F.regexp_replace(line, r"[ \t\r]+", " "), F.lit(" ")) >= min_words - 1))
        .select("_row", "_key", "_site", "_all", "_at", F.length("_line").alias("_len"), F.xxhash64(line).alias("_h1"), F.hash(line).alias("_h2"))
    )
    lines = materialize(lines)  # narrow; the texts are split once
    found = spread_lines(lines, min_sites)
    cut = (
        lines.join(found, _HASH, "left_semi")
        .groupBy("_row", "_key")
        .agg(F.collect_set("_at").alias("_cut"), F.max("_all").alias("_all"), F.sum(F.col("_len") + 1).alias("_lost"), F.count("*").alias("_n"))
    )
    if max_share is not None:
        cut = cut.where(F.col("_lost") * (F.size("_cut") / F.col("_n")) <= max_share * F.col("_all"))  # repeated rows count each line again
    cut = cut.select("_row", "_key", "_cut")
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_in"), row_id.alias("_row"), F.col(key).cast("string").alias("_key"))
    joined = base.join(cut, ["_row", "_key"], "left")
    t = F.col("_in").getField(text)
    parts = _lines(t)
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_cut"))  # keeps the order
    # the parts are bound once; named within the inner function they would be split again for every line
    joined_up = F.element_at(F.transform(F.array(parts), lambda p: F.array_join(F.transform(left, lambda i: F.element_at(p, i + 1)), "\n")), 1)
    cleaned = F.when(F.col("_cut").isNull(), t).otherwise(joined_up)
    out = [cleaned.alias(c) if c == text else F.col("_in").getField(c).alias(c) for c in kept]
    n = F.when(t.isNull(), 0).otherwise(F.size(parts)).cast("long")
    return joined.select(*out, n.alias("n_lines"), F.coalesce(F.size("_cut"), F.lit(0)).cast("long").alias("n_removed"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


CLEANED_SQL = f"""
with parts as (
  select doc_id, source, text, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos from {{docs}} where text is not null
), keyed as (
  select *, trim(line, ' ' || chr(9) || chr(13)) as k from parts
), able as (
  select * from keyed where k <> ''
), wide as (
  select k from able where source is not null group by k having count(distinct source) >= {MIN_SITES}
), cut as (
  select doc_id, list(distinct pos) as gone from able where k in (select k from wide) group by doc_id
)
select d.* exclude (text), coalesce(len(c.gone), 0)::bigint as n_removed, coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines,
  case when c.doc_id is null then d.text else array_to_string(list_transform(list_filter(range(len(string_split(d.text, chr(10)))), lambda i: not list_contains(c.gone, i)), lambda i: string_split(d.text, chr(10))[i + 1]), chr(10)) end as text
from {{docs}} d left join cut c using (doc_id)
"""

ORACLE_SQL = f"select doc_id, n_lines, n_removed, sha256(coalesce(text, '')) as kept_sha256 from ({CLEANED_SQL.format(docs='documents')})"
