"""Names in texts, however many names there are, and what share of a phrase's documents they explain.

Names are never gathered anywhere. A filter of at most FILTER_BITS bits, built by aggregation, says which windows of a text may
be a name; those windows meet the names by an exchange that compares strings, so a collision of hashes costs a row and changes
nothing. A window belongs to a text, and so do its runs: leftmost, longest, not overlapping, with a year that follows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unisono.functions.text import TOKEN
from unisono.operators.grams import SLICE, slices
from unisono.operators.spans import covered
from unisono.params import P
from unisono.sources.shared import cut, drop

FILTER_BITS = 1 << 26  # 8 MB at most, whatever the number of names; more names let more windows pass, all of which are compared
BITS_A_NAME = 32
BUCKET = 1 << 15  # bits of one bitmap row
BROADCAST_NAMES = 200_000
SALTS = 8
RUNS = "array<struct<first:int,last:int,cite:string>>"
_HIT = "doc_id long, first int, n int, year int, name string"
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(31)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def dictionary(names: DataFrame, congress: int) -> DataFrame:
    """(name, cite): names as tokens with spaces, known up to `congress`, each with its earliest cite (ties: the smallest).
    Names without a token or a cite don't enter: nothing would show where a tag comes from."""
    known = names.where((F.col("congress") <= congress) & F.col("cite").isNotNull())
    toks = known.select(F.array_join(tokens(F.col("name")), " ").alias("name"), F.struct("congress", "cite").alias("_c"))
    return toks.where("name <> ''").groupBy("name").agg(F.min("_c").alias("_c")).select("name", "_c.cite")


def glosses(titles: DataFrame) -> DataFrame:
    """(bill, name): long titles with the same bill's acronym before the noun that both end with, as members write them:
    'Clean Air For Everyone Act' and 'CAFE Act' give 'Clean Air For Everyone CAFE Act'. Long: four words or more; short: two or three."""
    words = F.split(F.trim(F.regexp_replace("title", r"\s+", " ")), " ")
    t = titles.where("title is not null").select("bill", words.alias("w")).distinct().withColumn("head", F.lower(F.element_at("w", -1)))
    long = t.where("size(w) >= 4").select("bill", "head", F.col("w").alias("long"))
    short = t.where("size(w) between 2 and 3").where(F.col("w")[0].rlike("^[A-Z][A-Z0-9.-]+$")).select("bill", "head", F.col("w").alias("short"))
    body = lambda c: F.slice(c, 1, F.size(c) - 1)
    return long.join(short, ["bill", "head"]).select("bill", F.array_join(F.concat(body(F.col("long")), body(F.col("short")), F.array(F.element_at("long", -1))), " ").alias("name")).distinct()


def _code(words: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little") for w in words], np.uint64)


def _grown(run: np.ndarray, code: np.ndarray) -> np.ndarray:
    run = (run ^ code) * _MULTIPLY
    return run ^ (run >> _SHIFT)


def _batch_codes(lists: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Words of a batch, each token's word, its hash, and the list that it stands in."""
    coded = lists.flatten().dictionary_encode()
    words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    code = _code(words)[at] if words else np.zeros(0, np.uint64)
    sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
    return words, at, code, np.repeat(np.arange(len(sizes)), sizes)


def _name_hashes(batches):
    for b in batches:
        words, at, code, _ = _batch_codes(b.column("toks"))
        sizes = pc.list_value_length(b.column("toks")).to_numpy(zero_copy_only=False)
        begin = np.cumsum(sizes) - sizes
        run = np.zeros(len(sizes), np.uint64)
        for n in range(int(sizes.max(initial=0))):
            some = sizes > n
            run[some] = _grown(run[some], code[begin[some] + n])
        yield pa.RecordBatch.from_pydict({"h": run.view(np.int64), "n": pa.array(sizes, pa.int32())})


def window_filter(names: DataFrame) -> tuple[np.ndarray, list[int]]:
    """(bytes of the filter, lengths of names). Both are bounded: FILTER_BITS / 8 bytes, one number for each length."""
    hashes = names.select(F.split("name", " ").alias("toks")).mapInArrow(_name_hashes, "h long, n int")
    made = hashes.groupBy("n").agg(F.count("*").alias("c")).collect()
    bits = BUCKET
    while bits < FILTER_BITS and bits < BITS_A_NAME * sum(r.c for r in made):
        bits *= 2
    place = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        out[(r.b - 1) * (BUCKET // 8) : r.b * (BUCKET // 8)] = np.frombuffer(r.m, np.uint8)
    return out, sorted(r.n for r in made)


def _windows(bits, lengths: list[int]):
    """Windows of texts that may be names, with the number of tokens of a year that follows (1970 or of 1970)."""

    def run(batches):
        seen = bits.value
        mask = np.uint64(len(seen) * 8 - 1)
        for b in (part for whole in batches for part in slices(whole, pc.list_value_length(whole.column("toks")).fill_null(0).to_numpy(zero_copy_only=False), SLICE)):
            words, at, code, text = _batch_codes(b.column("toks"))
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            begin = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(ids)))])
            is_year = np.array([len(w) == 4 and w.isascii() and w.isdigit() and w[:2] in ("19", "20") for w in words] or [False])
            is_of = np.array([w == "of" for w in words] or [False])

            def token(i, of, flags, at=at, text=text):
                ok = (i < len(at)) & (text[np.minimum(i, len(at) - 1)] == of)
                return ok & flags[at[np.minimum(i, len(at) - 1)]]

            h = np.zeros(len(code), np.uint64)
            for n in range(1, (lengths[-1] if lengths else 0) + 1):
                if len(code) < n:
                    break
                h = _grown(h[: len(code) - n + 1], code[n - 1 :])
                if n not in lengths:
                    continue
                place = h & mask
                hit = np.flatnonzero((seen[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1)
                hit = hit[text[hit] == text[hit + n - 1]]
                of = text[hit]
                year = np.where(token(hit + n, of, is_of) & token(hit + n + 1, of, is_year), 2, token(hit + n, of, is_year).astype(int))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(ids[of], pa.int64()),
                        "first": pa.array(hit - begin[of], pa.int32()),
                        "n": pa.array(np.full(len(hit), n), pa.int32()),
                        "year": pa.array(year, pa.int32()),
                        "name": pa.array([" ".join(words[w] for w in at[i : i + n]) for i in hit.tolist()], pa.string()),
                    }
                )

    return run


def _fold(hits: Column) -> Column:
    """Leftmost and, among those, longest hits that don't overlap."""

    @F.pandas_udf(RUNS)
    def fold(s):
        def one(found):
            out, free = [], 0
            for h in sorted(found, key=lambda h: (h["first"], -h["n"])):
                if h["first"] >= free:
                    free = h["first"] + h["n"] + h["year"]
                    out.append({"first": h["first"], "last": free - 1, "cite": h["cite"]})
            return out

        return s.map(one)

    return fold(hits)


def name_runs(docs: DataFrame, names: DataFrame, broadcast_names: int = BROADCAST_NAMES) -> DataFrame:
    """(doc_id, runs) of the documents that hold a name; `names` as `dictionary` gives them, `doc_id` unique and long.

    Places are numbers of tokens. The runs of a document are of its own length at most. Documents without text or name give no row,
    an empty table of names none at all. Names found are few beside names known: up to `broadcast_names` of them are broadcast; beyond, windows
    of a frequent name are salted, so no task gets all of them.
    """
    spark = docs.sparkSession
    names = cut(names)
    bits, lengths = window_filter(names)
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), tokens(F.col("text")).alias("toks"))
    hits = cut(texts.mapInArrow(_windows(spark.sparkContext.broadcast(bits), lengths), _HIT))
    found = cut(names.join(hits.select("name").distinct(), "name"))
    if found.count() <= broadcast_names:
        real = hits.join(F.broadcast(found), "name")
    else:
        salted = found.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        real = hits.withColumn("_s", F.pmod(F.xxhash64("doc_id", "first"), F.lit(SALTS)).cast("int")).join(salted, ["name", "_s"])
    out = cut(real.groupBy("doc_id").agg(F.collect_list(F.struct("first", "n", "year", "cite")).alias("_h")).select("doc_id", _fold(F.col("_h")).alias("runs")))
    for done in (names, hits, found):
        drop(done)
    return out


def verdicts(docs: DataFrame, wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """Per phrase the share of its documents in which every occurrence is covered by a name; tagged from P.nomenclature_ratio on.

    `wanted` (doc_id, ngram) says which phrases to look for where, `runs` comes from `name_runs`. A document's windows of a wanted
    length are looked up once, so the cost grows with its length, not with its phrases. `cite` is the smallest of the names that it touches.
    """

    def find(batches):
        for pdf in batches:
            rows = []
            for doc, toks, phrases, found in zip(pdf.doc_id, pdf.toks, pdf.wanted, pdf.runs, strict=True):
                toks, phrases = list(toks), set(phrases)
                spans = [(r["first"], r["last"], r["cite"]) for r in (found if found is not None else ())]
                firsts, lasts = [r[0] for r in spans], [r[1] for r in spans]
                seen: dict[str, bool] = {}
                cite: dict[str, str] = {}
                for n in {p.count(" ") + 1 for p in phrases}:
                    for i in range(len(toks) - n + 1):
                        g = " ".join(toks[i : i + n])
                        if g in phrases and seen.get(g, True):
                            near = spans[bisect_left(lasts, i) : bisect_left(firsts, i + n)]
                            seen[g] = bool(near) and covered(i, toks[i : i + n], near) is not None
                            if seen[g]:
                                cite[g] = min(cite.get(g, near[0][2]), *(r[2] for r in near))
                rows += [(doc, g, ok, cite.get(g) if ok else None) for g, ok in seen.items()]
            yield pd.DataFrame(rows, columns=["doc_id", "ngram", "covered", "cite"])

    some = docs.where("text is not null").join(wanted.groupBy("doc_id").agg(F.collect_set("ngram").alias("wanted")), "doc_id")
    some = some.select("doc_id", tokens(F.col("text")).alias("toks"), "wanted").join(runs, "doc_id", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "toks", "wanted", "runs")
    occ = some.mapInPandas(find, "doc_id long, ngram string, covered boolean, cite string")
    out = occ.groupBy("ngram").agg(F.count("*").alias("docs"), F.count_if("covered").alias("name_docs"), F.min("cite").alias("cite"))
    return out.withColumn("ratio", F.round(F.col("name_docs") / F.col("docs"), 6)).withColumn("tagged", F.col("ratio") >= P.nomenclature_ratio)


def is_procedural(ngram: Column, formulas: tuple[str, ...], seeds: tuple[str, ...], protected: tuple[str, ...] = ()) -> Column:
    """A run of words of a formula, unless protected, or a phrase that holds a seed; words are compared whole. Columns only."""
    g = F.concat(F.lit(" "), F.array_join(F.filter(F.split(F.lower(ngram), r"\s+"), lambda w: w != ""), " "), F.lit(" "))
    inside = F.lit(False)
    for f in formulas:
        inside = inside | F.lit(f" {' '.join(f.lower().split())} ").contains(g)
    holds = F.lit(False)
    for s in seeds:
        holds = holds | g.contains(f" {' '.join(s.lower().split())} ")
    return F.coalesce((F.trim(g) != "") & ((inside & ~F.trim(g).isin(*map(str.lower, protected) if protected else ("",))) | holds), F.lit(False))

