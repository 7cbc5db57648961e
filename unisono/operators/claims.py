"""Fragments, clusters of fragments that share a content gram, claims and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from unisono.functions.text import contains_gram, content_words, is_verbatim, is_weak_label, kept_ngrams, scaffold_reason, sentences
from unisono.operators.grams import frequent
from unisono.operators.identity import components
from unisono.params import P
from unisono.sources.shared import cut


def cluster_grams(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Content 4- and 5-grams of each fragment."""
    g = rows.select(key, "party", "day", sentences(F.col(text)).alias("_s")).select(key, "party", "day", F.explode(kept_ngrams(F.col("_s"), 4, 5)).alias("gram"))
    return g.where(content_words(F.col("gram")) >= 2)


def shared_grams(rows: DataFrame, key: str) -> DataFrame:
    """The rows (key, party, day, gram) of `cluster_grams` whose gram several fragments of a party day may share, and few others. Hashes
    are counted first, so other grams never become strings or rows of a table."""
    return frequent(rows.withColumn("unit", F.col(key)), [key, "party", "day"], 4, 5, 2).withColumnRenamed("ngram", "gram")


def fragment_components(grams: DataFrame, key: str) -> DataFrame:
    """Components of fragments of a party day that share a gram. Each fragment is joined to the gram's least one, so a gram's holders cost one edge each."""
    least = grams.groupBy("party", "day", "gram").agg(F.min(key).alias("a"), F.count("*").alias("n")).where("n > 1")
    edges = grams.join(least, ["party", "day", "gram"]).where(F.col(key) != F.col("a")).select("a", F.col(key).alias("b")).distinct()
    return components(edges)


def support_of_shared(shared: DataFrame, comp: DataFrame, units: DataFrame, key: str, quorum: int = P.quorum) -> tuple[DataFrame, DataFrame]:
    """(best, rest): `support_phrase` of the components in which `shared` (see `shared_grams`) has an admissible gram of two units or more, and
    the others (id, component). Such a gram comes before any that one statement alone has, so its component needs no other grams."""
    best = cut(support_phrase(shared, comp, units, key, quorum).where((F.col("units") >= 2) & _admissible(F.col("gram"))))
    rest = _enough(comp, units, key, quorum).join(best.select("component"), "component", "left_anti")
    return best, comp.join(rest.select("component"), "component", "left_semi")


def _enough(comp: DataFrame, units: DataFrame, key: str, quorum: int) -> DataFrame:
    return comp.select(F.col("id").alias(key), "component").join(units.select(key, "unit"), key).groupBy("component").agg(F.count_distinct("unit").alias("n_units")).where(F.col("n_units") >= quorum)


def _admissible(gram: Column) -> Column:
    return ~is_weak_label(gram) & scaffold_reason(gram).isNull()


def support_phrase(grams: DataFrame, comp: DataFrame, units: DataFrame, key: str, quorum: int = P.quorum) -> DataFrame:
    """Per component of enough units the gram that the most units support: admissible ones first, then units, statements, words, text."""
    rows = grams.join(comp.select(F.col("id").alias(key), "component"), key).join(units.select(key, "unit"), key)
    # every member of a component has a gram
    size = _enough(comp, units, key, quorum)
    per = rows.join(size, "component").groupBy("component", "gram").agg(F.count_distinct("unit").alias("units"), F.count_distinct(key).alias("statements"))
    ok = _admissible(F.col("gram")).cast("int")
    w = Window.partitionBy("component").orderBy(F.desc("ok"), F.desc("units"), F.desc("statements"), F.desc("words"), "gram")
    return per.withColumn("ok", ok).withColumn("words", F.size(F.split("gram", " "))).withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "ok", "words")


def claim_counts(claims: DataFrame, occ: DataFrame) -> DataFrame:
    """Distinct statements, offices and units behind each claimed gram."""
    return occ.join(claims.select(F.col("gram").alias("ngram")).distinct(), "ngram", "left_semi").groupBy("ngram").agg(F.count_distinct("doc_id").alias("publications"), F.count_distinct("bioguide").alias("offices"), F.count_distinct("unit").alias("support_units"))


def verify(claims: DataFrame, quorum: int = P.quorum) -> DataFrame:
    """Reasons why a claim (gram, member_count, units, fragment, source_text) fails; none: it holds."""
    reasons = F.array_compact(
        F.array(
            F.when(F.col("units") < quorum, "quorum"),
            F.when(F.col("member_count") != F.col("units"), "count"),
            F.when(~is_verbatim(F.col("fragment"), F.col("source_text")), "verbatim"),
            F.when(~contains_gram(F.col("source_text"), F.col("gram")), "support"),
            F.when(is_weak_label(F.col("gram")), "label"),
            scaffold_reason(F.col("gram")),
        )
    )
    return claims.withColumn("reasons", reasons)


def citations(support: DataFrame, k: int = 3) -> DataFrame:
    """The first statement of each unit, for the first k units of a claim."""
    one = support.groupBy("claim", "unit").agg(F.min("doc_id").alias("doc_id"))
    w = Window.partitionBy("claim").orderBy("unit")
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def select_disjoint(claims: DataFrame, limit: int = 2) -> DataFrame:
    """By day and party the best claim, and the best further ones, those without a topic in common first."""
    import pandas as pd

    def pick(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sorted(pdf.to_dict("records"), key=lambda r: (-r["units"], r["gram"]))
        out, seen = [], set()
        while rows and len(out) < limit:
            best = next((r for r in rows if not seen & set(r["topics"])), rows[0])
            out.append(best)
            seen |= set(best["topics"])
            rows.remove(best)
        return pd.DataFrame(out, columns=pdf.columns)

    return claims.groupBy("day", "party").applyInPandas(pick, claims.schema)
